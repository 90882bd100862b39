"""Compositions of operators into whole tables."""
