"""Operators of a training-data pipeline over whole corpora; nothing else in the library imports them."""
