"""Tokenizer / config artifacts (A4) and the dataset release manifest (A5).

Artifacts are tables with fixed schemas plus a one-row JSON config, so a later
job needs no flags.  Char vocabularies are saved too (the reference rebuilds
them from the data).  A ``tokenizer.json`` in the public ``tokenizers`` layout
(``model.vocab``, ``model.merges``, ``added_tokens``) is written alongside; it
is at most vocabulary-sized.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOCAB_SCHEMA = "id int, token string, bytes binary, type string"
MERGES_SCHEMA = "rank int, left string, right string, new_id int"
# the parts of a tokenizer.json that are read; merges stay JSON text, as they are spelled in two ways
TOKENIZER_SCHEMA = ("added_tokens array<struct<id:int,content:string,special:boolean>>, "
                    "model struct<type:string,unk_token:string,vocab:map<string,int>,merges:array<string>>")


def _hadoop(spark: SparkSession, path: str):
    """The path and its file system, whichever store it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    at, fs = _hadoop(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def save_artifacts(out_dir: str, vocab: DataFrame, merges: DataFrame | None, config: dict) -> None:
    """A4: vocab / merges as Parquet (one file each, vocabulary-sized), the
    config as JSON, and ``tokenizer.json``."""
    vocab.select("id", "token", "bytes", "type").coalesce(1).write.mode("overwrite").parquet(
        os.path.join(out_dir, "vocab"))
    if merges is not None:
        merges.select("rank", "left", "right", "new_id").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(out_dir, "merges"))
    spark = vocab.sparkSession
    _write_text(spark, os.path.join(out_dir, "config.json"), json.dumps(config, indent=2, sort_keys=True))
    toks = vocab.orderBy("id").select("id", "token", "type").collect()
    mg = [] if merges is None else [f"{r['left']} {r['right']}" for r in merges.orderBy("rank").collect()]
    tj = {
        "added_tokens": [{"id": r["id"], "content": r["token"], "special": True}
                         for r in toks if r["type"] in ("UNKNOWN", "CONTROL")],
        "model": {"type": "BPE" if merges is not None else "char", "unk_token": "<unk>",
                  "vocab": {r["token"]: r["id"] for r in toks}, "merges": mg},
    }
    _write_text(spark, os.path.join(out_dir, "tokenizer.json"), json.dumps(tj, ensure_ascii=False))


def load_artifacts(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame | None, dict]:
    """A4: read back with the fixed schemas (no inference)."""
    vocab = spark.read.schema(VOCAB_SCHEMA).parquet(os.path.join(out_dir, "vocab"))
    mpath = os.path.join(out_dir, "merges")
    at, fs = _hadoop(spark, mpath)
    merges = spark.read.schema(MERGES_SCHEMA).parquet(mpath) if fs.exists(at) else None
    config = json.loads(spark.read.text(os.path.join(out_dir, "config.json"), wholetext=True).first()["value"])
    return vocab, merges, config


def _symbol_bytes(token):
    """The bytes that a token of byte symbols stands for; other tokens are their own UTF-8."""
    from corpusloom.operators.bpe import byte_symbols
    code = F.create_map(*[F.lit(x) for b, c in enumerate(byte_symbols()) for x in (c, f"{b:02X}")])
    codes = F.transform(F.split(token, ""), lambda c: F.element_at(code, c))
    plain = F.exists(codes, lambda c: c.isNull())
    return F.when(plain, F.encode(token, "UTF-8")).otherwise(F.unhex(F.array_join(codes, "")))


def load_tokenizer(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A4: (vocab, merges) of a ``tokenizer.json`` in the public ``tokenizers`` layout, from any file system.

    The file is one JSON document of vocabulary size.  Merges may be spelled ``["a", "b"]`` or ``"a b"``.
    Added tokens that the vocabulary lacks are added; ``unk_token`` is UNKNOWN, other special tokens are CONTROL.
    A file without a BPE model raises ValueError.
    """
    from corpusloom.session import cut_lineage
    doc = cut_lineage(spark.read.text(path, wholetext=True).select(F.from_json("value", TOKENIZER_SCHEMA).alias("j")).select("j.*"))
    if doc.where("model.type = 'BPE' AND model.vocab IS NOT NULL").isEmpty():
        raise ValueError(f"no BPE model in {path}")
    own = doc.select(F.explode("model.vocab").alias("token", "id"), "model.unk_token")
    added = doc.select(F.explode("added_tokens").alias("t"), "model.unk_token").select(F.col("t.content").alias("token"), "t.id", "unk_token", "t.special")
    unk = F.col("token") == F.col("unk_token")
    tokens = (own.withColumn("special", F.lit(False)).unionByName(added)
              .groupBy("id", "token").agg(F.max("special").alias("special"), F.max(F.coalesce(unk, F.lit(False))).alias("unk")))
    vocab = tokens.select("id", "token", F.when(F.col("unk"), F.lit(None)).otherwise(_symbol_bytes(F.col("token"))).cast("binary").alias("bytes"),
                          F.when(F.col("unk"), "UNKNOWN").when(F.col("special"), "CONTROL").otherwise("NORMAL").alias("type"))
    pair = F.transform("model.merges", lambda m: F.from_json(m, "array<string>"))
    lists = F.forall(pair, lambda p: F.coalesce(F.size(p) == 2, F.lit(False)))
    both = doc.select(F.posexplode(F.when(lists, pair).otherwise(F.transform("model.merges", lambda m: F.split(m, " ", 2)))).alias("rank", "p"))
    both = both.select("rank", F.col("p")[0].alias("left"), F.col("p")[1].alias("right"))
    merges = (both.join(own.select(F.col("token").alias("made"), F.col("id").alias("new_id")), F.concat("left", "right") == F.col("made"))
              .select("rank", "left", "right", "new_id"))
    return cut_lineage(vocab), cut_lineage(merges)


def table_manifest(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """A5 (tables): per table its row count and a checksum of the multiset of its rows, whatever their order.

    Each row's hash goes into an xor and into a sum: in the xor alone two equal rows would cancel out.  One
    aggregate per table, partial per task, and parts of a table can be summed; nothing is gathered.
    """
    parts = []
    for name, df in tables.items():
        h = F.xxhash64(*df.columns)
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s"))
                     .select(F.lit(name).alias("name"), "rows", F.xxhash64("rows", "x", "s").alias("checksum")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def file_manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """A5 (files): name and size of each artifact in ``path``, a file or a folder of part files (their sizes summed).

    Sizes come from the ``binaryFile`` source; only ``path``/``length`` are selected, so file contents are not read.
    Hidden files (``_SUCCESS``) do not count, as in Spark's other readers.
    """
    at, fs = _hadoop(spark, path)
    found = spark._jvm.org.apache.hadoop.fs.Path(at, pattern)
    if not fs.globStatus(found):
        return spark.createDataFrame([], "name string, bytes long")
    root = fs.makeQualified(at).toString().rstrip("/")
    name = F.substring_index(F.substring("path", len(root) + 2, 1 << 30), "/", 1)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(found.toString())
            .select(name.alias("name"), F.col("length").alias("bytes")).where(~F.col("name").rlike("^[_.]"))
            .groupBy("name").agg(F.sum("bytes").alias("bytes")))


def release_manifest(spark: SparkSession, manifest: DataFrame, required: list[str]) -> DataFrame:
    """A5: fail naming every required artifact that is missing (or listed
    twice); otherwise return the manifest rows of the required names.

    The manifest has one row per artifact; it is materialised once (the
    per-table aggregates run once) and its names are checked on the driver.
    """
    from corpusloom.session import cut_lineage
    m = cut_lineage(manifest)
    names = [r["name"] for r in m.select("name").collect()]
    missing = sorted(set(required) - set(names))
    if missing:
        raise FileNotFoundError(f"missing artifacts: {', '.join(missing)}")
    dups = sorted({n for n in names if n in set(required) and names.count(n) > 1})
    if dups:
        raise ValueError(f"artifacts listed more than once: {', '.join(dups)}")
    return m.filter(F.col("name").isin(list(required)))
