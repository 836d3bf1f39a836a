"""Operators of a training-data pipeline over large text tables.

Every operator takes the columns it needs by name and leaves other columns alone, gives NULL and
empty inputs a defined result, and returns a DataFrame.
"""
