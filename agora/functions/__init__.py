"""Column functions: text cleaning and post attributes."""
