"""Operators of a training-data pipeline; nothing else in docloom imports this folder."""
