"""strata: layered (bronze / silver / gold) analytics on open-source Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Column expressions, joins, aggregates and windows, usable in batch jobs and
inside ``foreachBatch`` of a Structured Streaming query.
"""

__version__ = "0.1.0"
