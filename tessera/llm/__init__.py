"""Training-data operators: deduplication, decontamination, privacy, scoring,
search, mixing, extraction and token counting over document tables.

Nothing else in the library imports this subpackage."""
