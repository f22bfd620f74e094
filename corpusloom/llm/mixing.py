"""Mixing sources to target weights along a time-varying curriculum (native).

Every source has a weight schedule over training time [0, 1].  Its integral is
the source's share; the cumulative demand, inverted, gives each document the
time at which the source has consumed all the words before it.  Sorting by that
time is the training order.

The words before a document come from a two-level scan: documents are dealt by
a hash into buckets of about sqrt(rows) rows, summed per (source, bucket), and
only then scanned inside a bucket, so a source with a third of all rows is
split like any other.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_ROWS = 512  # least rows of a bucket; sqrt(rows) beyond 262,144 rows
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def cycle_weight(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating along the ranks 1, 2, ..."""
    return ((rank - 1) % 3 + 1).cast("double")


def ramp_knots(rank: Column) -> Column:
    """Linear schedules of integral 1: every first source fades, every second is level, every third grows."""
    a = (F.lit(2) - cycle_weight(rank)) * 0.5
    return F.array(F.struct(F.lit(0.0).alias("t"), (1 + a).alias("w")), F.struct(F.lit(1.0).alias("t"), (1 - a).alias("w")))


def segments(knots: Column) -> Column:
    """Segments of a piecewise linear schedule with the area c0 before each (few knots per source)."""
    area = lambda i: (knots[i]["w"] + knots[i + 1]["w"]) / 2 * (knots[i + 1]["t"] - knots[i]["t"])
    idx = F.sequence(F.lit(0), F.size(knots) - 2)
    return F.transform(idx, lambda i: F.struct(
        knots[i]["t"].alias("t0"), knots[i]["w"].alias("w0"),
        ((knots[i + 1]["w"] - knots[i]["w"]) / (knots[i + 1]["t"] - knots[i]["t"])).alias("k"),
        F.aggregate(F.filter(idx, lambda j: j < i), F.lit(0.0), lambda s, j: s + area(j)).alias("c0"),
        area(i).alias("a")))


def time_of(segs: Column, share: Column) -> Column:
    """The time at which the integral of the schedule reaches ``share`` of its whole area."""
    x = share * F.aggregate(segs, F.lit(0.0), lambda s, g: s + g["a"])
    seg = F.element_at(F.filter(segs, lambda g: g["c0"] <= x), -1)
    rest = x - seg["c0"]
    under = seg["w0"] + F.sqrt(F.greatest(seg["w0"] * seg["w0"] + 2 * seg["k"] * rest, F.lit(0.0)))
    return F.when(under > 0, seg["t0"] + 2 * rest / under).otherwise(seg["t0"])


def source_plan(sizes: DataFrame, weight=cycle_weight, knots=ramp_knots, max_repeats: int = 3) -> DataFrame:
    """Targets per source: (__null, __s, source_size, target, segs).

    One row per source, so the windows over all rows here stay as small as the
    list of sources.  Targets are min(max_repeats * size, level * weight): the
    level at which the targets add up to all words, found on the sources in the
    order of cap / weight.
    """
    by_name = W.orderBy("__null", "__s")
    s = (sizes.withColumn("__rank", F.row_number().over(by_name)).withColumn("__w", weight(F.col("__rank")))
         .withColumn("__cap", F.col("source_size") * max_repeats).withColumn("__ratio", F.col("__cap") / F.col("__w")))
    order = W.orderBy("__ratio", "__null", "__s")
    everything = W.partitionBy()
    s = (s.withColumn("__i", F.row_number().over(order))
         .withColumn("__before", F.coalesce(F.sum("__cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("__from", F.sum("__w").over(order.rowsBetween(0, W.unboundedFollowing)))
         .withColumn("__level", (F.sum("source_size").over(everything) - F.col("__before")) / F.col("__from")))
    first = F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__i", "__level"))).over(everything)["__level"]
    return s.withColumn("__lam", first).select(
        "__null", "__s", "source_size",
        F.least(F.col("__cap").cast("double"), F.coalesce(F.col("__lam") * F.col("__w"), F.col("__cap").cast("double"))).alias("target"),
        segments(knots(F.col("__rank"))).alias("segs"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None,
        weight=cycle_weight, knots=ramp_knots, max_repeats: int = 3, row_key: Column | None = None) -> DataFrame:
    """One row per document: (id, size, source_size, target, taken, position).

    ``size`` is the number of words by default; null texts have 0 and are never
    taken.  A null source is a source of its own, last.  A source whose target
    is q times its size and r words more is read q times in whole and then up to
    r words, in the order of md5(id); the document at the end of r gives just
    the words that are left, so the words taken are the target, rounded.
    ``position`` is the training time of the first reading (null if nothing is
    taken).  Rows with equal id and size are interchangeable, unless
    ``row_key`` tells them apart: it then comes last in their order and is returned as ``row_key``.  Other columns of
    ``docs`` are not read, so their names cannot clash.
    """
    size = word_count("text") if size is None else size
    u = F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    base = docs.select(F.col(id_col).alias("__id"), F.col(source_col).isNull().alias("__null"),
                       F.coalesce(F.col(source_col), F.lit("")).alias("__s"), size.alias("size"), u.alias("__u"), *([] if row_key is None else [row_key.alias("row_key")]))
    tell = [] if row_key is None else ["row_key"]
    rows = docs.select(id_col).count()
    buckets = max(1, ceil(rows / max(BUCKET_ROWS, sqrt(rows))))
    base = base.withColumn("__k", F.floor(F.col("__u") * buckets / F.lit(2.0 ** 32)).cast("long"))
    key = ["__null", "__s", "__k"]
    per_bucket = base.groupBy(*key).agg(F.sum("size").alias("__sum"))
    plan = source_plan(per_bucket.groupBy("__null", "__s").agg(F.sum("__sum").alias("source_size")), weight, knots, max_repeats)
    before = W.partitionBy("__null", "__s").orderBy("__k").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("__off", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    inside = W.partitionBy(*key).orderBy("__u", "__id", "size", *tell).rowsBetween(W.unboundedPreceding, -1)
    d = (base.withColumn("__in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
         .join(offsets, key).join(plan, ["__null", "__s"])
         .withColumn("__cum", F.col("__in") + F.col("__off")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    d = d.withColumn("__q", whole).withColumn("__r", F.floor(F.col("target") - F.col("__q") * F.col("source_size") + 0.5).cast("long"))
    d = d.withColumn("taken", F.col("__q") * F.col("size")
                     + F.least(F.greatest(F.col("__r") - F.col("__cum"), F.lit(0)), F.col("size")))
    total = F.greatest(F.col("__q") * F.col("source_size") + F.col("__r"), F.lit(1))
    return d.select(
        F.col("__id").alias(id_col), *tell, "size", "source_size", "target", "taken",
        F.when(F.col("taken") > 0, time_of(F.col("segs"), F.col("__cum") / total)).alias("position"),
        F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1))) - 1).cast("int")),
                    lambda i: F.struct((i + 1).alias("reading"),
                                       F.least(F.col("taken") - i * F.col("size"), F.col("size")).alias("words"),
                                       time_of(F.col("segs"), (i * F.col("source_size") + F.col("__cum")) / total).alias("position"))).alias("readings"))


def training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per reading of a document, range-sorted by training time."""
    return (mixed.where("taken > 0").select(id_col, F.inline("readings"))
            .select(id_col, "reading", "words", "position").orderBy("position", id_col, "reading"))
