"""Operators: plain functions and Spark ML stages over DataFrames."""
