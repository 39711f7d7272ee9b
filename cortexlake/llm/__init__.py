"""Training-data operators: extraction, deduplication, language ID, packing,
tokenizing and exact search over the corpus tables. Nothing else in the
library imports this subpackage."""
