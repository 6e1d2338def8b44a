"""Operators for text that is to train language models. Nothing outside this package imports it."""
