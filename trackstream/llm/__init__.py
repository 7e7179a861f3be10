"""Operators of a training-data pipeline (quality, licences, language, tokens,
near-duplicates, mixing).  Nothing else in the library imports this subpackage."""
