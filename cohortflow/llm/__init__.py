"""Operators of a training-data pipeline: counts, scans, filters, mixes, classifiers, duplicates and language models."""
