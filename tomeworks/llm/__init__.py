"""Operators for cleaning and preparing text for language-model training."""
