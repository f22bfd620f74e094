"""One registered query per operator, with the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import bpe_stream as B
from corpusloom.llm import chat_format as C
from corpusloom.llm import collocations as N
from corpusloom.llm import decontaminate as D
from corpusloom.llm import exact_dedup as X
from corpusloom.llm import language_id as L
from corpusloom.llm import mixing as M
from corpusloom.llm import ngram_join as J
from corpusloom.llm import periodic_runs as R
from corpusloom.llm import sanitise as P
from corpusloom.llm import suffix_dedup as S
from corpusloom.llm import token_counts as K
from corpusloom.llm import toxicity as T
from corpusloom.llm.common import held_out, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = D.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda s, r: s + r["to"] - r["from"])
    return c.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.size("hit_words") > 0).alias("contaminated"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = T.fit(docs, table(spark, sf_dir, "labels"), usable=~held_out())
    return T.score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                       (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = M.mix(table(spark, sf_dir, "documents")).drop("readings")
    return m.withColumn("position", F.round("position", 9)).orderBy("position", "doc_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.exact_dedup(table(spark, sf_dir, "documents"))


def op5_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = P.personal_data(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "term")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda x: x == F.lit(k))).cast("long").alias(f"n_{k}") for k in P.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = L.fit(docs.where(~held_out()))
    return L.identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = S.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = K.load_encoder(K.vocabulary_path(spark.sparkContext))
    return (K.token_counts(table(spark, sf_dir, "documents"), encoder, rule="majority").drop("name")
            .withColumn("tokens", F.col("tokens").cast("long")))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = C.gather_turns(table(spark, sf_dir, "conversations"))
    pairs = conv.select(F.col("conv").alias("pair_id"), F.col("turns").alias("chosen"), C.echo_negative(F.col("turns")).alias("rejected"))
    mask = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(c)
    return C.format_pairs(pairs).select("pair_id", "n_prefix", "prompt", "chosen", "rejected", mask("chosen_mask"), mask("rejected_mask"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.collocations(table(spark, sf_dir, "documents"), min_count=10, max_words=3, top=2000, cover_percent=50)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The query's texts: with h = crc32(doc_id) and h % 10 = 0, the words from a on repeat p words (a, p from h); a null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    g = F.floor(h / 10)
    docs = docs.select("doc_id", "text", words.alias("w"), g.alias("g")).withColumn("n", F.size("w").cast("long"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("w", source(i).cast("int"))), " ")
    return docs.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), F.sha2(lines, 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("top.length"), -F.col("top.short")
    return found.select("doc_id", "n_runs", (-F.col("top.before")).alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = B.load(B.vocabulary_path(spark.sparkContext))
    both = B.decode(B.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), spec), spec)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_sanitisation": op5_sanitisation,
    "op6_language_id": op6_language_id,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_ngram_join": op9_ngram_join,
    "op10_chat_format": op10_chat_format,
    "op11_collocations": op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_bpe_stream": op13_bpe_stream,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op1_decontamination": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM iw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
hit AS (
  SELECT DISTINCT doc_id, item_id, i, z.k
  FROM (SELECT DISTINCT k FROM win) z, dw, unnest(range(1, len(w) - z.k + 2)) AS r(i)
  JOIN win ON win.k = z.k AND win.g = list_slice(dw.w, i, i + z.k - 1)),
pos AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM hit, unnest(range(i, i + k)) AS r(p) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id)::BIGINT AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
       FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
""",
    "op3_mixing": r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS sn, coalesce(source, '') AS s,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS u
  FROM documents),
src AS (
  SELECT sn, s, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY sn, s) AS rnk FROM d GROUP BY sn, s),
w AS (SELECT *, ((rnk - 1) % 3 + 1)::DOUBLE AS w, source_size * 3 AS cap FROM src),
lv AS (
  SELECT *, cap / w AS ratio,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, sn, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER (ORDER BY cap / w, sn, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w),
lam AS (SELECT arg_min(lev, ratio) AS l FROM lv WHERE lev <= ratio),
plan AS (
  SELECT sn, s, source_size, least(cap::DOUBLE, l * w) AS target, (2 - w) * 0.5 AS a FROM lv, lam),
c AS (
  SELECT doc_id, size, source_size, target, a,
    coalesce(sum(size) OVER (PARTITION BY d.sn, d.s ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS cum,
    (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END)::BIGINT AS q
  FROM d JOIN plan USING (sn, s)),
t AS (SELECT *, floor(target - q * source_size + 0.5)::BIGINT AS r FROM c),
k AS (SELECT *, q * size + least(greatest(r - cum, 0), size) AS taken, cum / (q * source_size + r) AS x FROM t)
SELECT doc_id, size, source_size, target, taken,
  CASE WHEN taken > 0 THEN round(2 * x / (1 + a + sqrt((1 + a) * (1 + a) + 2 * ((1 - a) - (1 + a)) * x)), 9) END AS position
FROM k
""",
    "op4_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, ''))::BIGINT AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY norm)::BIGINT AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g
""",
    "op10_chat_format": r"""
WITH c AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations GROUP BY conv_id),
l AS (SELECT conv_id, t, coalesce(list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')), 0) AS la FROM c),
u AS (SELECT *, list_max(list_filter(range(1, la), lambda i: t[i].role = 'user')) AS lu FROM l),
x AS (
  SELECT conv_id, t AS a, list_transform(t, lambda e, i: CASE WHEN i = la THEN {'role': e.role, 'text':
         CASE WHEN lu IS NULL THEN '' ELSE t[lu].text END} ELSE e END) AS b FROM u),
n AS (SELECT *, coalesce(list_min(list_filter(range(1, len(a) + 1), lambda i: a[i] != b[i])) - 1, len(a)) AS n FROM x),
r AS (
  SELECT conv_id, n, list_transform(a, lambda e: '<|' || e.role || '|>' || chr(10) || e.text || '<|end|>' || chr(10)) AS ra,
         list_transform(b, lambda e: '<|' || e.role || '|>' || chr(10) || e.text || '<|end|>' || chr(10)) AS rb, a, b FROM n),
m AS (
  SELECT *, list_transform(list_filter(range(n + 1, len(a) + 1), lambda i: a[i].role = 'assistant'),
    lambda i: {'e': list_sum(list_transform(ra[n + 1 : i], lambda s: length(s))), 'k': length(a[i].text) + 8}) AS ma,
    list_transform(list_filter(range(n + 1, len(b) + 1), lambda i: b[i].role = 'assistant'),
    lambda i: {'e': list_sum(list_transform(rb[n + 1 : i], lambda s: length(s))), 'k': length(b[i].text) + 8}) AS mb FROM r)
SELECT conv_id AS pair_id, n::BIGINT AS n_prefix, array_to_string(ra[1 : n], '') AS prompt,
       array_to_string(ra[n + 1 :], '') AS chosen, array_to_string(rb[n + 1 :], '') AS rejected,
       array_to_string(list_transform(ma, lambda s: (s.e - s.k)::BIGINT || ':' || s.e::BIGINT), ',') AS chosen_mask,
       array_to_string(list_transform(mb, lambda s: (s.e - s.k)::BIGINT || ':' || s.e::BIGINT), ',') AS rejected_mask
FROM m
""",
    "op11_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) > 1
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w WHERE len(w) > 2),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
i AS (
  SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE k = 3
  UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE k = 3),
m AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN m USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
cuts AS (
  SELECT lang, phrase, a, 1 AS j, w[1] AS x, array_to_string(w[2 :], ' ') AS y FROM kept
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM kept WHERE k = 3),
s AS (SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y),
one AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM one)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""",
}

if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
