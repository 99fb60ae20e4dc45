"""Operators for training data.  Nothing else in quire imports this package."""
