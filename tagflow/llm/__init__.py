"""Training-data operators: quality, near duplicates, decontamination, mixing, sharding."""
