"""Operators a training-data pipeline needs, on Spark. Nothing else in the library imports this package."""
