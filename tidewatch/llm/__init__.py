"""Training-data operators: near-duplicate joins, sharding, search, text models, PII, mixing, tokens."""
