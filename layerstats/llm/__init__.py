"""Operators for preparing language-model training data, DataFrame in, DataFrame out."""
