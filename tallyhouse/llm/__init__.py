"""Operators of a training-data pipeline: packing, licence and secret scans,
fingerprints, near-duplicates, language and quality models, mixing and WARC.

Nothing else in the library imports this subpackage.
"""
