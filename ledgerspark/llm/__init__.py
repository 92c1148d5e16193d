"""Operators of a training-data pipeline: counting, scoring, packing, filtering, joining."""
