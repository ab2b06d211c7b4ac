"""Training-data operators: quality, duplicates, formatting, mixing and tokens."""
