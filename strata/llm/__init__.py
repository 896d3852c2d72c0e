"""Operators for preparing training text at scale (language ID, near-duplicates, repeated
passages, fingerprints, nearest neighbours, personal data, packing, quality, byte pairs, lexical
search, pieces, whitening).

Nothing outside this package imports it. Every operator takes and returns DataFrames, cuts
lineage only through the shared folder the session names, and keeps whole results: no caps,
prefixes or samples beyond the documented training samples of the two classifiers.
"""
