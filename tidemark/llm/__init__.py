"""Preparing text for language models: ten operators, one module each."""
