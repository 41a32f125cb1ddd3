"""Operators on the training-data side; nothing outside this subpackage imports it."""
