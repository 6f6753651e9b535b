"""Training-data operators: each takes a DataFrame and returns a DataFrame.

Nothing else in the library imports this package.
"""
