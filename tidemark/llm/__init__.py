"""Operators for preparing a training corpus: search, filters, de-duplication, tokens and shards."""
