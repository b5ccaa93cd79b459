"""Operators for large training corpora: mixing, languages, tokens, packing, duplicates, quality, licences."""
