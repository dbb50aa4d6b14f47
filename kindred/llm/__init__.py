"""Training-data operators: counting, cleaning, de-duplication, search and
mixing of large text corpora. Nothing else in the package imports this."""
