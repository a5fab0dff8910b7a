"""Training-data operators: license and secret scans, byte-level BPE, quality
and language models, near-duplicate groups, URL rules, token attribution,
document fingerprints and benchmark decontamination.

Each module holds one operator; ``queries`` applies them to the given tables.
Nothing else in the library imports this subpackage.
"""
