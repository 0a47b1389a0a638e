"""Windowed, joined and running analytics over event tables and event streams, on PySpark DataFrames."""
