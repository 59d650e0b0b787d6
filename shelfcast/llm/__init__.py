"""Training-data operators: filtering, deduplication, tokenisation, packing and sharding of a text corpus."""
