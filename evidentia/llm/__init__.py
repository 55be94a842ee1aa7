"""Training-data operators: filtering, deduplication, packing, sharding and scoring of documents."""
