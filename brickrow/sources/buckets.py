"""Tables dealt by a key as they are written, so that joins and first rows by that key move nothing later.

They are Spark's own bucketed tables in the session's catalog; with ``path`` their files lie where the caller
says. An append adds one file to each bucket and leaves the others alone, so a run writes what it brings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Number of the run that wrote a row.
RUN = "run"


def _put(table: DataFrame, name: str, key: str, buckets: int, mode: str, path: str | None) -> DataFrame:
    # Dealt like the buckets, a task writes one bucket.
    writer = table.repartition(buckets, key).write.format("parquet").mode(mode).bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return table.sparkSession.table(name)


def write(table: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """A new table, in buckets by ``key``; it must not be there."""
    return _put(table, name, key, buckets, "error", path)


def append_run(table: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> int:
    """Add the rows as one more run, to a new table or one that this function made; the number of the run."""
    number = last_run(table.sparkSession, name) + 1
    _put(table.withColumn(RUN, F.lit(number).cast("long")), name, key, buckets, "append", path)
    return number


def last_run(spark: SparkSession, name: str) -> int:
    """The last run of a table, 0 for none."""
    if not spark.catalog.tableExists(name):
        return 0
    return spark.table(name).agg(F.max(RUN).alias("last")).first().last or 0
