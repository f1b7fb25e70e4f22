"""Training-data operators: formatting, sharding, dedup, packing and scoring."""
