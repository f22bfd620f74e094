"""The driver contract: entry runs on sf0.001; every oracle has a query."""
import __spark_entry__ as entry


def test_entry_and_registry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["targets"] > 0 and rows[0]["ce"] > 0
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 50


def test_monitor_stream_equals_batch(spark, tmpdir_path):
    import os

    from corpusloom.operators import runs as H
    from corpusloom.plans import fixtures as X
    from corpusloom.streaming.monitor import monitor_stream
    hist = X.history(spark, "/root/testdata/sf0.001")
    src = os.path.join(tmpdir_path, "hist")
    for lo, hi in [(0, 2000), (2000, 5000), (5000, 10 ** 9)]:  # evals arrive in order, in 3 files
        hist.filter(f"it >= {lo} and it < {hi}").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(hist.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(tmpdir_path, "mon")
    q = (monitor_stream(stream, 10).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(
        "run_id", "it", "improved", "evals_since", "stopped").collect())
    want = sorted(tuple(r) for r in H.early_stop(hist, 10).select(
        "run_id", "it", "improved", "evals_since", "stopped").collect())
    assert got == want
