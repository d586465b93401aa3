"""Identification and annotation of biological sequences, and corpus preparation, on Spark DataFrames."""
