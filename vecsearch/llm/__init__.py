"""Operators of a training-data pipeline on Spark tables, and their registered queries."""
