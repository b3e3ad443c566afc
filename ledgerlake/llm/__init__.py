"""Training-data operators: scoring, dedup, filtering, tokens, shards and search over a corpus."""
