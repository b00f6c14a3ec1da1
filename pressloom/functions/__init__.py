"""Column functions: text, authors, dates, URLs, labels."""
