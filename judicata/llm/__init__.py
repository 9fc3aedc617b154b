"""Training-data operators: deduplication, quality, sharding, mixing and packing.

Each operator is a module with a general interface over DataFrames; ``queries``
registers one query per operator.  Nothing else in the library imports this
subpackage.
"""
