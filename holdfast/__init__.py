"""Delay analytics, chunk-table integrity and key-ring jobs on Spark DataFrames."""
