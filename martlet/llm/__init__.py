"""Training-data pipeline operators: deduplication, scoring, decontamination, packing."""
