"""Training-data operators: counting, filtering, deduplicating, mixing and writing text corpora."""
