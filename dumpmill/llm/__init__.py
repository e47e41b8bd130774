"""Operators for preparing language-model training data (filters, dedup, tokenizers, mixing)."""
