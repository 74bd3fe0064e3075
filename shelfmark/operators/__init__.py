"""Reusable report building blocks; every one takes and returns DataFrames."""
