"""A1 read works, A3 write corpus (read-back equality), A4 artifacts round trip."""
import os

from pyspark.sql import functions as F

from corpusloom.operators import bpe as BP
from corpusloom.operators.corpus import assemble_corpus
from corpusloom.sources.artifacts import load_artifacts, save_artifacts
from corpusloom.sources.files import read_corpus, read_documents, read_works, write_corpus


def test_read_works_and_write_corpus(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "books")
    os.makedirs(src)
    texts = {3327: "first book\r\nline", 677: "second\nbook", 999: "no work for this"}
    for wid, t in texts.items():
        with open(os.path.join(src, f"pg{wid}.txt"), "w", encoding="utf-8", newline="") as f:
            f.write(t)
    works = spark.createDataFrame([(3327, "A", 1), (677, "B", 2)], "work_id long, title string, ord int")
    w = {r["work_id"]: r for r in read_works(spark, src, works).collect()}
    assert set(w) == {3327, 677} and w[3327]["text"] == texts[3327] and w[677]["ord"] == 2
    docs = read_documents(spark, src, fmt="text")
    assert sorted(r["text"] for r in docs.collect()) == sorted(t.replace("\r\n", "\n") for t in texts.values())
    pieces = read_works(spark, src, works).select("ord", "work_id", F.col("work_id").alias("doc_id"),
                                                  F.col("text").alias("body"))
    corpus = assemble_corpus(pieces)
    out = os.path.join(tmpdir_path, "corpus")
    write_corpus(corpus, out, partitions=2)
    back = read_corpus(spark, out).orderBy("ord", "doc_id").collect()
    assert "".join(r["text"] for r in back) == texts[3327] + "\n\n\n" + texts[677] + "\n"


def test_artifacts_round_trip(spark, tmpdir_path):
    docs = spark.createDataFrame([(1, "the cat sat on the mat\n"), (2, "the hat\n")], "doc_id long, text string")
    vocab, merges, _ = BP.fit_bpe(BP.piece_counts(docs), 40)
    save_artifacts(tmpdir_path, vocab, merges, {"tokenizer": "bpe", "vocab_size": 40, "block_size": 8})
    v2, m2, cfg = load_artifacts(spark, tmpdir_path)
    assert cfg["vocab_size"] == 40
    before = BP.bpe_encode(docs, BP.Codec.from_frames(vocab, merges)).orderBy("doc_id").collect()
    after = BP.bpe_encode(docs, BP.Codec.from_frames(v2, m2)).orderBy("doc_id").collect()
    assert [list(r["ids"]) for r in before] == [list(r["ids"]) for r in after]
    assert os.path.exists(os.path.join(tmpdir_path, "tokenizer.json"))


def test_release_manifest_names_missing(spark):
    import pytest

    from corpusloom.sources.artifacts import release_manifest, table_manifest
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    m = table_manifest(spark, {"vocab": a, "merges": a.limit(1)})
    got = {r["name"]: r["rows"] for r in release_manifest(spark, m, ["vocab", "merges"]).collect()}
    assert got == {"vocab": 2, "merges": 1}
    with pytest.raises(FileNotFoundError, match="config.json, model.safetensors"):
        release_manifest(spark, m, ["vocab", "model.safetensors", "config.json"])
    dup = m.unionByName(m)
    with pytest.raises(ValueError, match="more than once: merges, vocab"):
        release_manifest(spark, dup, ["vocab", "merges"])


def test_artifacts_on_a_uri(spark, tmp_path):
    from corpusloom.operators.bpe import vocab_frame
    from corpusloom.sources.artifacts import load_artifacts, save_artifacts
    uri = f"file://{tmp_path}/model"
    merges = spark.createDataFrame([(0, "a", "b", 3)], "rank int, left string, right string, new_id int")
    save_artifacts(uri, vocab_frame(spark, ["<unk>", "a", "b", "ab"]), merges, {"tokenizer": "bpe", "note": "\u03b1"})
    vocab, back, config = load_artifacts(spark, uri)
    assert vocab.count() == 4 and [tuple(r) for r in back.collect()] == [(0, "a", "b", 3)]
    assert config == {"tokenizer": "bpe", "note": "\u03b1"}
    assert (tmp_path / "model" / "tokenizer.json").is_file()


def test_checksum_counts_repeated_rows_and_ignores_order(spark):
    from corpusloom.sources.artifacts import table_manifest
    a = spark.createDataFrame([(i % 5, f"v{i}") for i in range(40)], "id long, v string")
    one = a.limit(1)
    sums = [r["checksum"] for r in table_manifest(spark, {
        "a": a, "shuffled": a.repartition(7, "v"), "doubled": a.unionByName(one), "tripled": a.unionByName(one).unionByName(one),
        "changed": a.withColumn("v", F.when(F.col("v") == "v3", "w").otherwise(F.col("v")))}).orderBy("name").collect()]
    a_, changed, doubled, shuffled, tripled = sums
    assert a_ == shuffled and len({a_, changed, doubled, tripled}) == 4
    assert table_manifest(spark, {"none": a.limit(0)}).first()["rows"] == 0


def test_load_tokenizer_written_by_the_library(spark, tmp_path):
    import json

    import pytest
    from tokenizers import AddedToken, Tokenizer, models, pre_tokenizers, trainers

    from corpusloom.sources.artifacts import load_tokenizer
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    tok = Tokenizer(models.BPE(unk_token="<unk>"))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.train_from_iterator(list(texts.values()), trainers.BpeTrainer(vocab_size=300, special_tokens=["<unk>"], show_progress=False))
    tok.add_special_tokens([AddedToken("<end>", special=True)])
    path = tmp_path / "tokenizer.json"
    tok.save(str(path))
    spec = json.loads(path.read_text(encoding="utf-8"))
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    for merges in (pairs, [" ".join(p) for p in pairs]):  # both spellings
        spec["model"]["merges"] = merges
        path.write_text(json.dumps(spec, ensure_ascii=False), encoding="utf-8")
        vocab, found = load_tokenizer(spark, f"file://{path}")
        rows = {r["token"]: r for r in vocab.collect()}
        assert {t: r["id"] for t, r in rows.items()} == tok.get_vocab(with_added_tokens=True)
        assert rows["<unk>"]["type"] == "UNKNOWN" and rows["<end>"]["type"] == "CONTROL" and rows["e"]["type"] == "NORMAL"
        assert bytes(rows["\u0120"]["bytes"]) == b" " and bytes(rows["e"]["bytes"]) == b"e"
        assert [[r["left"], r["right"]] for r in found.orderBy("rank").collect()] == pairs
        codec = BP.Codec.from_frames(vocab, found)
        for r in BP.bpe_encode(docs, codec).collect():
            assert list(r["ids"]) == tok.encode(texts[r["doc_id"]]).ids
    path.write_text('{"model": {"type": "WordPiece"}}')
    with pytest.raises(ValueError):
        load_tokenizer(spark, f"file://{path}")


def test_pieces_keep_documents_without_source_or_text(spark):
    from corpusloom.operators.corpus import work_report
    from corpusloom.plans.fixtures import NO_SOURCE, pieces_of
    rows = [(0, "zero", None), (1, "one", "b"), (2, None, None), (3, "three", "a"), (4, None, "b"), (6, "six", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = pieces_of(docs).collect()
    assert sorted(r["doc_id"] for r in got) == [0, 1, 2, 3, 4, 6] and all(r["body"] is not None for r in got)
    assert {r["title"]: r["ord"] for r in got} == {NO_SOURCE: 1, "a": 2, "b": 3}
    report = {r["title"]: r["chars"] for r in work_report(pieces_of(docs)).collect()}
    assert report[NO_SOURCE] == sum(len(r["body"]) for r in got if r["title"] == NO_SOURCE)
    assert report[None] == sum(len(r["body"]) for r in got)
    corpus = assemble_corpus(pieces_of(docs)).orderBy("char_off").collect()
    assert [r["char_off"] for r in corpus] == [sum(len(x["text"]) for x in corpus[:i]) for i in range(6)]


def test_release_files_counts_tables_stored_as_folders(spark, tmp_path):
    import shutil

    from corpusloom.plans.queries import q_release_files
    from corpusloom.sources.artifacts import file_manifest
    from corpusloom.sources.tables import TABLES
    for t in TABLES:
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    whole = {r["name"]: r for r in q_release_files(spark, str(tmp_path)).collect()}
    assert {n: r["bytes"] for n, r in whole.items()} == {t: (tmp_path / f"{t}.parquet").stat().st_size for t in TABLES}
    folder = tmp_path / "folders"
    folder.mkdir()
    for t in TABLES:
        if t != "documents":
            shutil.copy(tmp_path / f"{t}.parquet", folder)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    docs.repartition(3).write.parquet(str(folder / "documents.parquet"))  # with _SUCCESS and check sums beside three parts
    for where in (str(folder), f"file://{folder}/"):
        got = {r["name"]: r for r in q_release_files(spark, where).collect()}
        assert {n: (r["rows"], r["checksum"]) for n, r in got.items()} == {n: (r["rows"], r["checksum"]) for n, r in whole.items()}
        assert got["documents"]["bytes"] == sum(f.stat().st_size for f in (folder / "documents.parquet").glob("part-*"))
    assert file_manifest(spark, str(folder), "*.nothing").count() == 0
