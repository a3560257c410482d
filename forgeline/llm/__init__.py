"""Training-data operators: deduplication, scoring, mixing, filtering,
tokenization. Nothing else in the library imports this subpackage."""
