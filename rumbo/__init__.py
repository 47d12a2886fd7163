"""rumbo: customer-journey analytics for retail banking on Spark DataFrames."""

__version__ = "0.1.0"
