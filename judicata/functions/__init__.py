"""Column builders: every function takes/returns ``pyspark.sql.Column``.

All of them are built-in Spark expressions (no Python UDF), so they stay
inside whole-stage codegen and push down where Catalyst can push them.
"""

from judicata.functions import classify, dates, metrics, numbers, provenance, text  # noqa: F401
