"""Training-data operators: scoring, de-duplication, mixing, packing and fingerprints of documents."""
