"""Sell-in / sell-out report analytics expressed as Spark DataFrame plans.

Every public operator takes DataFrames and returns a DataFrame; nothing reads a
global session and nothing writes unless its name says so (``sources.sinks``).
"""

__version__ = "0.1.0"
