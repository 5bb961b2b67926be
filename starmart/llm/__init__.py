"""Operators of a training-data pipeline, each a Spark job of its own.  Nothing else in the library imports these."""
