"""Row numbers without one task per key.

A plain ``row_number`` over a key sorts all rows of the key in one task. Here a key is cut
into buckets: rows are numbered inside a bucket, and a bucket starts where the ones before it
end. No task sees more than one bucket of rows, or one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ponloom.operators.lineage import cut

ID_BUCKETS = 4096


def numbered(
    df: DataFrame, keys: list[str], bucket: Column, order: list[Column | str], name: str
) -> DataFrame:
    """Add a 1-based row number per key.

    ``bucket`` must rise with ``order`` inside a key, unless the order across buckets is free.
    """
    part = [*keys, "_bucket"]
    inside = df.withColumn("_bucket", bucket).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*part).orderBy(*order)).cast("bigint")
    )
    sizes = inside.groupBy(*part).agg(F.max("_rank").alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*part, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    same = [F.col(f"i.{c}").eqNullSafe(F.col(f"s.{c}")) for c in part]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return inside.alias("i").join(starts.alias("s"), condition).select(
        *[F.col(f"i.{c}") for c in df.columns], (F.col("i._rank") + F.col("s._start")).alias(name)
    )


def with_new_ids(
    new: DataFrame, current: DataFrame, key: list[str], id_: str = "id", last_id: int = 0
) -> DataFrame:
    """Give new rows dense ids above the largest one in use, or ever used (``last_id``).

    Ids depend only on the keys, so a task that runs again hands out the same ones.
    """
    bucket = F.pmod(F.xxhash64(*key), F.lit(ID_BUCKETS))
    top = F.greatest(current.agg(F.max(id_)).scalar(), F.lit(last_id))
    ranked = numbered(new, [], bucket, list(key), "_n")
    return ranked.withColumn(id_, (F.col("_n") + top).cast("bigint")).drop("_n")


def with_record_number(df: DataFrame, name: str = "line", first: int = 2) -> DataFrame:
    """Number the records of text files, per file, in file order.

    ``df`` comes straight from a file source and still has the ``_metadata`` column. A large
    file is read as several splits; each split starts where the ones before it end.
    """
    columns = df.columns
    at = df.select(
        *columns,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"),
    )
    splits = at.groupBy("file", "_split").agg(F.count("*").alias("_size"), F.min("_at").alias("_first"))
    before = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(splits.select(
        "file", "_split", "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    ))
    return at.join(starts, ["file", "_split"]).select(
        *columns, "file", (F.col("_start") + F.col("_at") - F.col("_first") + first).alias(name)
    )
