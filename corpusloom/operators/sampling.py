"""Sampling rules over long-form distributions (F1-F5) and request
normalisation (F8).

    dist(<key...>, id INT, logit DOUBLE)

Every rule is a window over one key's distribution (V rows: bounded by the
vocabulary), never over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.det import unit

# ---------------------------------------------------------------------------
# Request defaults and clamp of the reference's server.
# ---------------------------------------------------------------------------
DEFAULT_PROMPT = ""
EMPTY_PROMPT = "\n"
DEFAULT_TEMPERATURE = 0.8
DEFAULT_TOP_K = 40
DEFAULT_MAX_NEW_TOKENS = 240
MAX_NEW_TOKENS_CAP = 600
# ---------------------------------------------------------------------------


def _kw(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys)


def temper(dist: DataFrame, t: float | Column | str, logit: str = "logit") -> DataFrame:
    """divide logits by the temperature; rows with ``t <= 0`` keep their
    logits (they take the greedy path, F5)."""
    tc = F.col(t) if isinstance(t, str) else (t if isinstance(t, Column) else F.lit(float(t)))
    return dist.withColumn(logit, F.when(tc > 0, F.col(logit) / tc).otherwise(F.col(logit)))


def top_k(dist: DataFrame, keys: Sequence[str], k: int | Column | str | None,
          logit: str = "logit") -> DataFrame:
    """keep logits >= the k-th largest (ties all kept): ``rank() <= k``.
    ``k`` null or <= 0 keeps everything; ``k`` above V keeps everything."""
    if k is None:
        return dist
    kc = F.col(k) if isinstance(k, str) else (k if isinstance(k, Column) else F.lit(int(k)))
    r = F.rank().over(_kw(keys).orderBy(F.col(logit).desc()))
    d = dist.withColumn("__rank", r)
    return d.filter(kc.isNull() | (kc <= 0) | (F.col("__rank") <= kc)).drop("__rank")


def softmax(dist: DataFrame, keys: Sequence[str], logit: str = "logit", out: str = "p") -> DataFrame:
    """stable softmax per key: exp(l - max) / sum."""
    w = _kw(keys)
    e = F.exp(F.col(logit) - F.max(logit).over(w))
    return dist.withColumn("__e", e).withColumn(out, F.col("__e") / F.sum("__e").over(w)).drop("__e")


def cumulative(dist: DataFrame, keys: Sequence[str], p: str = "p") -> DataFrame:
    """Running sum of ``p`` by id inside each key (the categorical CDF)."""
    w = _kw(keys).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    return dist.withColumn("cum", F.sum(p).over(w))


def draw(dist: DataFrame, keys: Sequence[str], u: Column) -> DataFrame:
    """categorical draw per key: the first id (by id) whose running
    probability exceeds ``u`` (a keyed uniform in [0, 1)); if rounding leaves
    ``u`` above the total, the last id with mass.  Returns ``(keys, id)``."""
    c = cumulative(dist, keys).withColumn("__u", u)
    hit = c.filter(F.col("cum") > F.col("__u")).groupBy(*keys).agg(F.min("id").alias("__hit"))
    last = c.filter(F.col("p") > 0).groupBy(*keys).agg(F.max("id").alias("__last"))
    return (last.join(hit, list(keys), "left")
            .select(*keys, F.coalesce("__hit", "__last").alias("id")))


def greedy(dist: DataFrame, keys: Sequence[str], logit: str = "logit") -> DataFrame:
    """argmax per key; ties go to the lowest id."""
    return dist.groupBy(*keys).agg(
        F.max_by("id", F.struct(F.col(logit), -F.col("id"))).alias("id"))


def sample_next(dist: DataFrame, keys: Sequence[str], temperature: float, k: int | None,
                seed: int, draw_keys: Sequence[Column | str]) -> DataFrame:
    """F1-F5 composed: greedy when ``temperature <= 0``, else temper -> top-k ->
    softmax -> draw with ``u = unit(seed, *draw_keys)``."""
    if temperature <= 0:
        return greedy(dist, keys)
    d = softmax(top_k(temper(dist, temperature), keys, k), keys)
    return draw(d, keys, unit(seed, *[F.col(x) if isinstance(x, str) else x for x in draw_keys]))


# ---------------------------------------------------------------------------
# F8: requests
# ---------------------------------------------------------------------------
_INTEGER_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"


def _field(value, kind, name: str, whole: bool):
    """(number, bad) of a JSON field: numbers and booleans count (whole ones cut toward zero), and strings that
    are written as such a number; null, arrays and objects are bad.  A missing field is null and not bad."""
    path, typ = F.lit(f"$.{name}"), "bigint" if whole else "double"
    text = F.try_variant_get(value, path, "string")
    number = F.try_variant_get(value, path, "double")
    parsed = F.when(text.rlike(_INTEGER_TEXT), F.regexp_replace(F.trim(text), "[_+]", "")) if whole else F.trim(text)
    plain = F.coalesce(F.try_variant_get(value, path, "bigint"), number.try_cast(typ)) if whole else number
    out = (F.when(kind == "BOOLEAN", F.try_variant_get(value, path, "boolean").cast("int").cast(typ))
           .when(kind == "STRING", parsed.try_cast(typ))
           .when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), plain))
    return out, kind.isNotNull() & out.isNull()


def normalize_requests(requests: DataFrame, body: str = "body") -> DataFrame:
    """F8: parse JSON bodies into typed requests with the server's defaults.

    Empty body = ``{}``; prompt "" -> "\\n"; temperature 0.8; top_k 40;
    max_new_tokens 240 clamped to [1, 600].  Whole numbers are cut toward zero
    (3.7 -> 3, 1e2 -> 100, true -> 1).  A body that is not a JSON object (blanks
    are none), a number that is null or not a number, or a prompt that is no
    string marks the row ``bad``; bad rows carry nulls.
    """
    v = F.try_parse_json(F.when(F.coalesce(body, F.lit("")) == "", F.lit("{}")).otherwise(F.col(body)))
    kind = lambda name: F.schema_of_variant(F.try_variant_get(v, F.lit(f"$.{name}"), "variant"))
    bad = ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    r, vals = requests, {}
    for key, whole in (("temperature", False), ("top_k", True), ("max_new_tokens", True)):
        vals[key], wrong = _field(v, kind(key), key, whole)
        bad = bad | wrong
    bad = bad | ~F.coalesce(kind("prompt").isin("STRING", "VOID"), F.lit(True))
    prompt = F.when(kind("prompt").isNull(), F.lit(DEFAULT_PROMPT)).otherwise(
        F.coalesce(F.try_variant_get(v, F.lit("$.prompt"), "string"), F.lit("")))
    prompt = F.when(prompt == "", F.lit(EMPTY_PROMPT)).otherwise(prompt)
    n = F.coalesce(vals["max_new_tokens"], F.lit(DEFAULT_MAX_NEW_TOKENS))
    out = r.withColumn("bad", F.coalesce(bad, F.lit(False)))
    good = ~F.col("bad")
    return out.select(
        "req_id",
        F.when(good, prompt).alias("prompt"),
        F.when(good, F.coalesce(vals["temperature"], F.lit(DEFAULT_TEMPERATURE))).alias("temperature"),
        F.when(good, F.coalesce(vals["top_k"], F.lit(DEFAULT_TOP_K))).alias("top_k"),
        F.when(good, F.greatest(F.lit(1), F.least(n, F.lit(MAX_NEW_TOKENS_CAP)))).alias("max_new_tokens"),
        "bad")
