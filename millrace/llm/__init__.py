"""Operators for preparing training text: sketches, filters, extraction, search, tokens, mixing and near copies."""
