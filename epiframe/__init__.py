"""Time-series, geometry and dataset-audit operators on Spark DataFrames."""
