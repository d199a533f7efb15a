"""Operators on texts and entities for training data; nothing outside this package imports it."""
