"""Operators of a training-data pipeline: nothing outside this part imports it."""
