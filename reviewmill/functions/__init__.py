"""Column functions: names, text, dates, nested values and rating labels."""
