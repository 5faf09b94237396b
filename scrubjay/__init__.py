"""scrubjay: Spark-native cleaning, key validation, enrichment, profiling and
data-quality checks for large tables with an unreliable key column.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions, joins and aggregates; Python runs only inside the
pluggable external lookup (``operators.lookup.lookup_udf``).
"""

__version__ = "0.1.0"
