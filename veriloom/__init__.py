"""Data-quality, risk and forecasting jobs over operational data, written for Spark DataFrames."""
