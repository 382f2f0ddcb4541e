"""Operators a training-data pipeline needs (problems 1 to 10).  Nothing outside this package imports it."""
