"""Column functions: HTML regions, text cleaning, token lists and dates."""
