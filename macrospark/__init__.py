"""Analytics for revisable economic time series, written as Spark DataFrame operators."""

__version__ = "0.1.0"
