"""Operators of a training-data pipeline: text in, kept, scored, encoded or stored text out."""
