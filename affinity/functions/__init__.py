"""Column-level building blocks; everything here is a built-in Spark expression."""

from affinity.functions import draws, encode, lists, pairs

__all__ = ["draws", "encode", "lists", "pairs"]
