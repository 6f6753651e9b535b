"""Checks of the library: input projections, registered queries, reference SQL, comparison."""
