"""Adoption analytics for subscription and consumption businesses, on Spark.

Everything is a function from DataFrame to DataFrame (or Column to Column);
nothing runs until the caller acts on a result or asks the store to write one.
"""

from uptake.params import Override, ScoreParams

__all__ = ["Override", "ScoreParams"]
