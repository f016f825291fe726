"""Operators of a training-data pipeline: licences, language-model scores, token
files, quality, neighbours, archives, shards, near-duplicates, packing and
benchmark decontamination.  Nothing else in the library imports this package."""
