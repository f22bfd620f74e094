"""Two-level running aggregates.

A running sum/min over a whole table (or over one hot key that may hold a
third of all rows) must not be a single window partition.  We split the order
into *chunks* (a column that never decreases along the order, e.g.
``floor(doc_id / width)``), compute each row's running value inside its
(key, chunk) and add the carry of all earlier chunks, which comes from a
table with one row per (key, chunk).  Every task therefore sees at most one
chunk; only the per-chunk table is scanned as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK = "__chunk"
_LOCAL = "__local"
_TOTAL = "__ctotal"
_BASE = "__cbase"


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def running_agg(
    df: DataFrame,
    value: str | Column,
    order: Sequence[str | Column],
    out: str,
    chunk: Column,
    keys: Sequence[str] = (),
    agg: str = "sum",
    inclusive: bool = True,
) -> DataFrame:
    """Add ``out`` = running ``agg`` (sum|min|max) of ``value`` along ``order``.

    ``chunk`` must be non-decreasing along ``order`` within ``keys``.  With
    ``inclusive=False`` the current row is left out (exclusive scan); an empty
    sum is 0 and an empty min/max is null.
    """
    fn = {"sum": F.sum, "min": F.min, "max": F.max}[agg]
    v = F.col(value) if isinstance(value, str) else value
    d = df.withColumn(_CHUNK, chunk).withColumn("__v", v)
    local_w = Window.partitionBy(*keys, _CHUNK).orderBy(*_cols(order)).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    d = d.withColumn(_LOCAL, fn("__v").over(local_w))
    # One row per (key, chunk); the carry is the aggregate of earlier chunks.
    chunk_w = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(
        Window.unboundedPreceding, -1
    )
    base = (
        d.groupBy(*keys, _CHUNK)
        .agg(fn("__v").alias(_TOTAL))
        .withColumn(_BASE, fn(_TOTAL).over(chunk_w))
        .drop(_TOTAL)
    )
    d = d.join(base, [*keys, _CHUNK], "inner")
    if agg == "sum":
        res = F.coalesce(F.col(_BASE), F.lit(0)) + F.coalesce(F.col(_LOCAL), F.lit(0))
    elif agg == "min":
        res = F.least(F.col(_BASE), F.col(_LOCAL))
    else:
        res = F.greatest(F.col(_BASE), F.col(_LOCAL))
    return d.withColumn(out, res).drop(_CHUNK, _LOCAL, _BASE, "__v")


def lead_across(
    df: DataFrame,
    value: str | Column,
    order: Sequence[str],
    out: str,
    chunk: Column,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add ``out`` = ``value`` of the next row along ``order`` (null on the last).

    Inside a chunk this is ``lead``; the last row of a chunk takes the first
    value of the next non-empty chunk from a one-row-per-chunk table.
    """
    v = F.col(value) if isinstance(value, str) else value
    d = df.withColumn(_CHUNK, chunk).withColumn("__v", v)
    ow = [F.col(o) for o in order]
    d = d.withColumn(_LOCAL, F.lead("__v").over(Window.partitionBy(*keys, _CHUNK).orderBy(*ow)))
    first = (
        d.groupBy(*keys, _CHUNK)
        .agg(F.min_by("__v", F.struct(*ow)).alias(_TOTAL))
        .withColumn(_BASE, F.lead(_TOTAL).over(Window.partitionBy(*keys).orderBy(_CHUNK)))
        .drop(_TOTAL)
    )
    d = d.join(first, [*keys, _CHUNK], "inner")
    return d.withColumn(out, F.coalesce(F.col(_LOCAL), F.col(_BASE))).drop(
        _CHUNK, _LOCAL, _BASE, "__v"
    )


def lag_tail_across(
    df: DataFrame,
    tail: str,
    order: Sequence[str],
    out: str,
    chunk: Column,
    k: int,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add ``out`` = the last ``k`` elements of the concatenation of ``tail``
    arrays of all earlier rows along ``order`` (the carried-in context),
    within ``keys`` if given.

    Requires every row's ``tail`` to be non-empty, so ``k`` earlier rows (and
    ``k`` earlier chunks) always suffice.
    """
    ow = [F.col(o) for o in order]
    d = df.withColumn(_CHUNK, chunk)
    prev_w = Window.partitionBy(*keys, _CHUNK).orderBy(*ow).rowsBetween(-k, -1)
    d = d.withColumn(_LOCAL, F.flatten(F.collect_list(tail).over(prev_w)))
    last_w = Window.partitionBy(*keys, _CHUNK).orderBy(*ow).rowsBetween(-(k - 1), 0)
    # The chunk's own tail: last k over its last k rows.
    ends = (
        d.withColumn("__ct", F.flatten(F.collect_list(tail).over(last_w)))
        .groupBy(*keys, _CHUNK)
        .agg(F.max_by("__ct", F.struct(*ow)).alias("__ct"))
    )
    carry_w = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(-k, -1)
    ends = ends.withColumn(_BASE, F.flatten(F.collect_list("__ct").over(carry_w))).drop("__ct")
    d = d.join(ends, [*keys, _CHUNK], "inner")
    joined = F.concat(F.col(_BASE), F.col(_LOCAL))
    n = F.size(joined)
    res = F.when(n <= k, joined).otherwise(F.slice(joined, n - k + 1, k))
    return d.withColumn(out, res).drop(_CHUNK, _LOCAL, _BASE)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str,
                partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based rank of each row along ``order`` within ``keys``
    (ties must not exist in ``order``), skew-proof.

    ``repartitionByRange`` samples balanced ranges of (keys, order), so even a
    key holding a third of all rows is cut into many partitions; the partition
    id is non-decreasing along the order within a key and serves as the chunk
    of the two-level count.  The id is stored with the rows (a table in the
    checkpoint folder) before use: read twice from a live shuffle, adaptive
    coalescing could number the partitions differently for each reader.
    """
    from corpusloom.session import cut_lineage
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = cut_lineage(df.repartitionByRange(n, *keys, *order).withColumn("__pid", F.spark_partition_id()))
    return running_agg(r, F.lit(1), list(order), out, F.col("__pid"), keys=list(keys)).drop("__pid")


def id_chunk(col: str, width: int) -> Column:
    """Chunk of an integer id: ``floor(id / width)``; at most ``width`` ids each."""
    return F.floor(F.col(col) / F.lit(width))
