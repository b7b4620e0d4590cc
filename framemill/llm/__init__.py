"""Operators on text corpora for language models. Nothing outside this folder imports it."""
