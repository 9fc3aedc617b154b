"""judicata: justice-statistics analytics as Spark DataFrame operators.

Layout
------
functions/   column builders (tolerant numbers, keys, dates, classifiers, indicators)
operators/   DataFrame -> DataFrame operators (cleaning, aggregation, windows, matching, top-k, sets, audits)
sources/     scans (tolerant CSV, latin-1 text lines, zip members, JSON, parquet snapshots, XLSX cells)
sinks/       tidy parquet, contract JSON, manifest upsert, catalog tables, run log
streaming/   request limiter, trailing rates, snapshot arrival
ml/          delay model, drift, priority index
plans/       named queries over the driver tables (the registry behind __spark_entry__.py)
"""

__all__ = ["session"]

# Functions of this package that run in Python workers travel with the task, so
# that executors need no copy of the package on their path.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except ImportError:      # a worker without PySpark's cloudpickle cannot get here through Spark
    pass
