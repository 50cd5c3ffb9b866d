"""Whole reports. Each takes its tables as DataFrames and returns one lazy DataFrame."""
