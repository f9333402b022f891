"""Operators of a training-data pipeline, on DataFrames of documents and vectors."""
