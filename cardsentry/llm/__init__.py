"""Training-data pipeline operators (packing, decontamination, dedup, ...)."""
