"""Column functions: names, headers, dates, text, scales and projections."""
