"""H1/H2/H8 against a plain loop with the training loop's semantics."""
import math
import random

import pytest

from corpusloom.operators import runs as H

NAN = float("nan")
HIST = {
    1: [3.0, 2.0, 2.5, 2.0, 1.5, 1.6, 1.7, 1.8],
    2: [NAN, 5.0, NAN, 4.0, 4.0, 4.5],
    3: [1.0],
}


def _loop(vals, patience):
    best, since, out = math.inf, 0, []
    for i, v in enumerate(vals):
        imp = v < best
        if imp:
            best, since = v, 0
        else:
            since += 1
        stop = bool(patience) and since >= patience
        out.append((250 * i, imp, since, stop))
        if stop:
            break
    return out


def _df(spark):
    rows = [(r, 250 * i, 0.9 * v if v == v else NAN, v, float(i)) for r, vs in HIST.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "run_id long, it int, train_loss double, val_loss double, secs double")


@pytest.mark.parametrize("patience", [0, 1, 2, 3])
def test_early_stop_and_improvements(spark, patience):
    got = {}
    for r in H.early_stop(_df(spark), patience).collect():
        got.setdefault(r["run_id"], []).append((r["it"], r["improved"], r["evals_since"], r["stopped"]))
    for run, vals in HIST.items():
        assert sorted(got[run]) == _loop(vals, patience), (run, patience)


def test_best_checkpoint_and_progress(spark):
    best = {r["run_id"]: (r["best_it"], r["best_val"]) for r in H.best_checkpoint(_df(spark)).collect()}
    assert best == {1: (1000, 1.5), 2: (750, 4.0), 3: (0, 1.0)}
    lines = {(r["run_id"], r["it"]): r["line"] for r in H.progress(_df(spark)).collect()}
    assert lines[(1, 0)] == "iter     0 | train 2.7000 | val 3.0000 | 0.0s  *best"
    assert lines[(1, 500)] == "iter   500 | train 2.2500 | val 2.5000 | 2.0s"


def test_ablation_compares_configurations(spark):
    runs = spark.createDataFrame([(1, "rmsnorm", "rope", "swiglu"), (2, "layernorm", "rope", "swiglu"),
                                  (3, "rmsnorm", "learned", "gelu")], "run_id long, norm string, pos string, mlp string")
    best = spark.createDataFrame([(1, 0, 2.0), (2, 0, 2.5), (3, 0, 9.0)], "run_id long, best_it int, best_val double")
    rows = H.ablation(best, runs).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["flag"] == "norm" and r["a_value"] == "layernorm" and r["delta"] == pytest.approx(-0.5)


def test_loss_curve_and_report(spark):
    df = _df(spark)
    assert H.loss_curve(df).count() == 2 * df.count()
    runs = spark.createDataFrame([(1, "rmsnorm", "rope", "swiglu")], "run_id long, norm string, pos string, mlp string")
    card = H.report_card(H.run_summary(H.early_stop(df.filter("run_id = 1"), 10)), runs, 32, 64).first()
    assert card["iters"] == 1750 and card["best_val"] == 1.5
    assert card["tokens_per_s"] == pytest.approx(1750 * 32 * 64 / 7.0)
    assert card["loss_line"] == "- **loss**: final train 1.6200 / val 1.8000, best val 1.5000"


def _random_runs(seed):
    rnd = random.Random(seed)
    pick = [NAN, None, 1.0, 1.0, 2.0, 2.5, 3.0, 4.0, 0.5]
    runs = {r: [rnd.choice(pick) for _ in range(rnd.randrange(1, 30))] for r in range(8)}
    runs[8] = [5.0 - i / 100 for i in range(60)] + [4.6] * 60  # one long run
    return runs


def _rows(runs):
    return [(r, 250 * i, v) for r, vals in runs.items() for i, v in enumerate(vals)]


def _want(runs, patience):
    return {(r, *t) for r, vals in runs.items()
            for t in _loop([NAN if v is None else v for v in vals], patience)}


@pytest.mark.parametrize("patience,evals", [(0, 3), (4, 1), (4, 7)])
def test_one_scan_over_chunks(spark, monkeypatch, patience, evals):
    """Chunks of 1, 3 and 7 evals, NaN, null and equal losses, against the loop."""
    monkeypatch.setattr(H, "IT_CHUNK", 250 * evals)
    runs = _random_runs(patience + evals)
    df = spark.createDataFrame(_rows(runs), "run_id long, it int, val_loss double")
    got = {(r["run_id"], r["it"], r["improved"], r["evals_since"], r["stopped"])
           for r in H.early_stop(df, patience).collect()}
    assert got == _want(runs, patience)


def test_monitor_batches_continue_from_state(spark, monkeypatch):
    """Micro-batches with a state table joined in give the rows of the whole history."""
    from corpusloom.streaming import monitor as M
    monkeypatch.setattr(H, "IT_CHUNK", 500)
    runs = _random_runs(11)
    rows = _rows(runs)
    got, state = set(), None
    for lo, hi in ((0, 1500), (1500, 2000), (2000, 10 ** 6)):
        df = spark.createDataFrame([x for x in rows if lo <= x[1] < hi], "run_id long, it int, val_loss double")
        out = M.monitor_batch(df, 4, state)
        got |= {(r["run_id"], r["it"], r["improved"], r["evals_since"], r["stopped"]) for r in out.collect()}
        kept = M.next_state(out, state).collect()
        state = spark.createDataFrame(kept, "run_id long, best double, since long, stopped boolean")
    assert got == _want(runs, 4)


def test_monitor_tables_stream(spark, tmpdir_path):
    """The stream of tables, one file a micro-batch, equals the batch form."""
    from corpusloom.streaming import monitor as M
    runs = {r: [v for v in vals if v is not None] for r, vals in _random_runs(3).items()}
    rows = _rows(runs)
    for b, (lo, hi) in enumerate(((0, 2000), (2000, 10 ** 6))):
        df = spark.createDataFrame([x for x in rows if lo <= x[1] < hi], "run_id long, it int, val_loss double")
        df.coalesce(1).write.parquet(f"{tmpdir_path}/in/{b}")
        stream = (spark.readStream.schema("run_id long, it int, val_loss double")
                  .option("recursiveFileLookup", "true").parquet(f"{tmpdir_path}/in"))
        M.monitor_tables(stream, 4, f"{tmpdir_path}/out", f"{tmpdir_path}/ck").awaitTermination()
    got = {(r["run_id"], r["it"], r["improved"], r["evals_since"], r["stopped"])
           for r in spark.read.parquet(f"{tmpdir_path}/out/rows").collect()}
    assert got == _want(runs, 4)
