"""Daily-bar analytics and forecasting on Spark DataFrames."""
