"""Operators on text and names for training data; nothing outside this subpackage imports it."""
