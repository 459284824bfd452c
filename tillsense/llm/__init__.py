"""Training-data operators (language ID, sharding, mixing, packing,
fingerprints, similarity joins, line dedup, secret scan, toxicity).

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.
"""
