"""Column functions: text cleaning, hashing, places, dates and similarity."""
