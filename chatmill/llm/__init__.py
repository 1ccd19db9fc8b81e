"""Operators for training-data pipelines: cleaning, de-duplication, scoring, token counting and mixing of text corpora."""
