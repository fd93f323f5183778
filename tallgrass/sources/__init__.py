"""Readers that give DataFrames."""
