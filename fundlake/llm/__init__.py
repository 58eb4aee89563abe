"""Operators of a training-data pipeline: mixing, personal data, dedup, quality, packing, url rules, fingerprints.

Nothing else in the library imports this subpackage.
"""
