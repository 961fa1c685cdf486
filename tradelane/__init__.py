"""Freight, trade, port-weather and vessel analytics on Spark DataFrames."""
