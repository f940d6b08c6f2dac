"""Operators for the text of training data. Nothing else in the library imports this subpackage."""
