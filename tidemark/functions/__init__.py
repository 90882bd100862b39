"""Column expressions: keys, titles, text features, dates and percentages."""
