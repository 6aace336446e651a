"""Layered ("medallion") analytics on Spark DataFrames.

The package is a set of pure ``DataFrame -> DataFrame`` operators plus thin
readers and writers at the edges.  Column names are always parameters.
"""

__version__ = "0.1.0"
