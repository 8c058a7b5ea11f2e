"""Daily market-data and portfolio analytics as PySpark table operators.

Layers: ``sources`` read and write tables, ``functions`` are column expressions,
``operators`` are DataFrame -> DataFrame steps, ``plans`` chain them into jobs.
"""
