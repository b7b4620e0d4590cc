"""Readers and writers of the dataset layouts."""
