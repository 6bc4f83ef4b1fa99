"""Training-data operators: deduplication, filtering, packing, tokenisation, sharding."""
