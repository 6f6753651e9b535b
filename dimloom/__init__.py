"""dimloom: dimension loading and load monitoring as plain Spark plans.

Every data function maps DataFrames to DataFrames, takes its load date and run
id as arguments, and starts no job.  Only ``dimloom.plans.runner`` and
``dimloom.plans.scoped`` write tables and read scalars back to the driver.
"""
