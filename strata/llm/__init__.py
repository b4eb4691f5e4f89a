"""Training-data operators: deduplication, packing, quality, extraction,
encoding, secrets, fingerprints, toxicity and near-duplicate joins."""
