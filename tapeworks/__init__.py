"""Market-data analytics as functions from DataFrames to DataFrames."""

#: Stored read models of another version are built anew.
__version__ = "0.3"
