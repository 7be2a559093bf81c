"""Merge staff records of two companies into one golden table, as Spark plans."""
