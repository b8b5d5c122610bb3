"""Training-data operators: dedup, filters, decontamination, mixing, extraction."""
