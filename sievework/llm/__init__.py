"""Training-data operators: tokenising, dedup, packing, archives, filtering, sharding."""
