"""Sales forecasting and workforce planning on Spark DataFrames."""

__version__ = "0.1.0"
