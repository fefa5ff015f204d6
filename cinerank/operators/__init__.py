"""Recommender operators.  Every function takes and returns DataFrames."""
