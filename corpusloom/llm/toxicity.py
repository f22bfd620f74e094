"""Toxicity by weak supervision.

Many voters look at a text: fixed lexicons, patterns, and words that labelled
rows show to be telling; the label itself is one more, noisy, voter.  A
generative label model (each voter has its own confusion probabilities given
the hidden class) is fitted by expectation maximisation.  Correlations that are
left between voters given the class are estimated, and correlated voters share
their weight.  A logistic regression on words and voters is then trained on the
posterior labels and scores every whole text.

Fitting uses a bounded sample of labelled rows (``SAMPLE_ROWS``, in the order of
a hash).  Words are found and counted in tasks; the driver gets the chosen
features and sparse rows of them.  Scoring reads every document and needs only
the small linear model.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Shared, map_batches
from corpusloom.llm.tables import stored

SAMPLE_ROWS = 8_000
LEARNED_VOTERS = 96
FEATURES = 1_000
STEMS = (4, 5, 6, 7)
MIN_DF = 5
WORD = re.compile(r"[^\W\d_]+")
LEXICONS = {
    "insult_noun": "idiot idiots moron morons fool fools clown clowns loser losers jerk scum trash garbage imbecile dunce pig pigs rat vermin".split(),
    "insult_adjective": "stupid dumb pathetic worthless disgusting useless ugly ignorant brainless vile filthy lazy despicable".split(),
    "profanity": "damn hell crap shit fuck fucking bastard bitch ass asshole bullshit".split(),
    "hostile_verb": "hate hates despise kill die shut destroy hurt".split(),
    "other_languages": "dumm blöd trottel schwachkopf arschloch stupide imbécile connard merde crétin estúpido idiota tonto imbécil mierda".split(),
}
PATTERNS = {
    "shouting": re.compile(r"(?:\b[A-Z]{3,}\b\W{1,3}){3}"),
    "exclaiming": re.compile(r"!{2,}"),
    "masked_word": re.compile(r"\b[A-Za-z]\*{2,}[A-Za-z]*\b"),
    "addressed": re.compile(r"\b[Yy]ou(?:'re| are| is)?\s+(?:a |an |so |such )?(?:" + "|".join(LEXICONS["insult_noun"] + LEXICONS["insult_adjective"]) + r")\b"),
    "go_away": re.compile(r"\b(?:shut up|go away|get lost|drop dead)\b", re.I),
}
_LEX = {k: frozenset(v) for k, v in LEXICONS.items()}


def observed(text: str) -> tuple[set[str], np.ndarray]:
    """The distinct lower-cased words, and the votes (1 fires, 0 abstains) of lexicons and patterns."""
    words = set(WORD.findall(text.lower()))
    votes = [not v.isdisjoint(words) for v in _LEX.values()] + [bool(p.search(text)) for p in PATTERNS.values()]
    return words, np.array(votes, np.float64)


def stems(words: set[str], size: int) -> set[str]:
    """Beginnings of the longer words, marked with a hyphen: inflected and compound words share them."""
    return {w[:size] + "-" for w in words if len(w) > size}


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Posterior probability of class 1 per row.

    ``votes`` (rows x voters, 0/1) and ``gold`` (0/1, a voter with a prior for
    being mostly right) depend on a hidden class.  Each round estimates the
    class share, every voter's rates, and the residual correlations between
    voters; a voter's evidence is divided by one plus its correlations.
    """
    v = np.column_stack([votes, gold]).astype(np.float64)
    post = np.where(gold > 0, 0.9, 0.1)
    silent = votes.sum(1) == 0
    pi = np.clip(gold.mean(), 1e-3, 1 - 1e-3)  # the labels give the class share; left free, it drifts to one class
    prior = np.full(v.shape[1], 0.5)
    prior[-1] = 0.1 * len(v)  # the label: as if seen right on 97 of 100 rows, a tenth of the sample, beforehand
    for _ in range(rounds):
        base = (v.mean(0) * prior * 2 + 0.5) / (2 * prior + 1)
        up1, up0 = base * 2 * prior, base * 2 * prior
        up1[-1], up0[-1] = 1.94 * prior[-1], 0.06 * prior[-1]
        r1 = (post @ v + up1) / (post.sum() + 2 * prior)
        r0 = ((1 - post) @ v + up0) / ((1 - post).sum() + 2 * prior)
        r1, r0 = np.clip(r1, 1e-4, 1 - 1e-4), np.clip(r0, 1e-4, 1 - 1e-4)
        rest = v - (post[:, None] * r1 + (1 - post)[:, None] * r0)
        sd = np.sqrt((rest ** 2).mean(0)) + 1e-6
        rho = np.abs(rest.T @ rest / len(v) / np.outer(sd, sd))
        np.fill_diagonal(rho, 0)
        rho[rho < 0.1] = 0
        weight = 1 / (1 + rho.sum(1))
        weight[-1] = 1
        evidence = v * (np.log(r1 / r0) * weight)
        evidence[:, -1] += (1 - v[:, -1]) * np.log((1 - r1[-1]) / (1 - r0[-1]))  # only the label says no; other voters abstain
        q1, q0 = (post @ silent + 0.5) / (post.sum() + 1), ((1 - post) @ silent + 0.5) / ((1 - post).sum() + 1)
        evidence[:, 0] += silent * np.log(q1 / q0)  # that all of them abstain is evidence once
        post = 1 / (1 + np.exp(-np.clip(evidence.sum(1) + np.log(pi / (1 - pi)), -30, 30)))
    return post


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 2.0, steps: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the log loss plus l2 * |w|^2 / 2, by Newton's method."""
    n, k = x.shape
    parts = [(np.column_stack([x[i:i + 512], np.ones(len(x[i:i + 512]), x.dtype)]), slice(i, i + 512)) for i in range(0, n, 512)]
    w = np.zeros(k + 1)
    w[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    ridge = np.full(k + 1, l2)
    ridge[-1] = 1e-6
    margin = lambda w: x @ w[:-1] + w[-1]
    loss = lambda w: float((np.logaddexp(0, m := margin(w)) - y * m).sum() + (ridge * w * w).sum() / 2)
    at = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(margin(w), -30, 30)))
        h, slope = np.diag(ridge), ridge * w
        for part, at_rows in parts:  # float64 for some rows at a time
            b, q = part.astype(np.float64), p[at_rows]
            h += (b * (q * (1 - q))[:, None]).T @ b
            slope += b.T @ (q - y[at_rows])
        move, step = np.linalg.solve(h, slope), 1.0
        while (to := loss(w - step * move)) > at and step > 1e-3:
            step /= 2
        if at - to < 1e-6 * at:
            break
        w, at = w - step * move, to
    return w[:-1], float(w[-1])


def with_stems(seen: tuple[set[str], np.ndarray]) -> tuple[set[str], np.ndarray]:
    words, votes = seen
    return words.union(*(stems(words, k) for k in STEMS)), votes


class Model:
    """A linear model over words and the fixed voters."""

    def __init__(self, words: dict[str, float], votes: np.ndarray, bias: float):
        self.words, self.votes, self.bias = words, votes, bias

    def score(self, text: str) -> float:
        found, votes = observed(text)
        z = self.bias + sum(self.words[w] for w in self.words.keys() & found) + float(votes @ self.votes)
        for size in STEMS:
            z += sum(self.words[w] for w in self.words.keys() & stems(found, size))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def share_model(y: np.ndarray) -> Model:
    """The smoothed share of the labels, for rows without both labels."""
    share = (y.sum() + 1) / (len(y) + 2)
    return Model({}, np.zeros(len(LEXICONS) + len(PATTERNS)), float(np.log(share / (1 - share))))


def train(y: np.ndarray, votes: np.ndarray, found: list, chosen: list[str], telling: list[str]) -> Model:
    """A model from labels, fixed votes and, per row, the places in ``chosen`` + ``telling`` of the features it has."""
    has = np.zeros((len(y), len(chosen) + len(telling)), np.float32)
    for i, at in enumerate(found):
        has[i, at] = 1
    post = label_model(np.column_stack([votes, has[:, len(chosen):]]), y)
    w, b = logistic(np.column_stack([has[:, :len(chosen)], votes.astype(np.float32)]), post)
    return Model({k: float(w[i]) for i, k in enumerate(chosen) if abs(w[i]) > 1e-4}, w[len(chosen):].astype(float), b)


def fit_rows(rows: list[tuple[str, int]]) -> Model:
    """A model from (text, label) rows held in memory; without both labels it is their smoothed share."""
    y = np.array([r[1] for r in rows], np.float64)
    if len(rows) == 0 or y.min() == y.max():
        return share_model(y)
    codes = np.random.default_rng(7).integers(0, 1 << 62, len(rows)).tolist()
    count: dict[str, list] = {}
    for (text, label), code in zip(rows, codes):
        for w in with_stems(observed(text or ""))[0]:
            c = count.setdefault(w, [0, 0, 0])
            c[0], c[1], c[2] = c[0] + 1, c[1] + int(label > 0), c[2] ^ code
    best: dict[int, str] = {}  # of features that the same rows have, such as a word and its stems, the shortest one
    for w, (c, _, sig) in count.items():
        if c >= MIN_DF and (sig not in best or (len(w), w) < (len(best[sig]), best[sig])):
            best[sig] = w
    n, n1 = len(y), y.sum()
    far = lambda c, c1: (c1 - c * n1 / n) / np.sqrt(max(c * n1 / n * (1 - c / n), 0.25))
    z = {w: far(count[w][0], count[w][1]) for w in best.values()}
    order = sorted(z, key=lambda w: (-abs(z[w]), w))
    chosen, telling = order[:FEATURES], [w for w in order if z[w] >= 4][:LEARNED_VOTERS]
    seen = [with_stems(observed(r[0] or "")) for r in rows]
    return train(y, np.array([v for _, v in seen]), [_places(words, chosen, telling) for words, _ in seen], chosen, telling)


def _places(words: set[str], chosen: list[str], telling: list[str]) -> list[int]:
    return [i for i, w in enumerate(chosen + telling) if w in words]


def sampled_rows(docs: DataFrame, labels: DataFrame, usable=None, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, y, t) of at most ``sample_rows`` labelled rows, those first by a hash of the id; one row per id."""
    lab = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    lab = lab if usable is None else lab.where(usable)
    lab = lab.groupBy(F.col(id_col).alias("id")).agg(F.min(F.col(label_col)).cast("int").alias("y"))
    few = lab.orderBy(F.xxhash64(F.col("id").cast("string"), F.lit(2)), "id").limit(sample_rows)  # broadcast: ids only
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("t"))
    return texts.join(F.broadcast(few), "id").groupBy("id").agg(F.min("y").alias("y"), F.min("t").alias("t"))


def features(rows: DataFrame) -> DataFrame:
    """(w, z) of the features of (id, y, t) rows: of those that the same rows have the shortest, and how far from chance its toxic rows are."""
    n, n1 = rows.agg(F.count("*"), F.sum((F.col("y") > 0).cast("long"))).first()

    def run(b: pa.RecordBatch) -> dict:
        count: dict[str, list] = {}
        for code, y, t in zip(*(b.column(i).to_pylist() for i in range(3))):
            for w in with_stems(observed(t))[0]:
                c = count.setdefault(w, [0, 0, 0])
                c[0], c[1], c[2] = c[0] + 1, c[1] + int(y > 0), c[2] ^ code
        c = list(count.values())
        return {"w": list(count), "c": [x[0] for x in c], "c1": [x[1] for x in c], "sig": [x[2] for x in c]}

    coded = rows.select(F.xxhash64(F.col("id").cast("string"), F.lit(7)).alias("code"), "y", "t")
    words = (map_batches(coded, run, "w string, c long, c1 long, sig long")
             .groupBy("w").agg(F.sum("c").alias("c"), F.sum("c1").alias("c1"), F.bit_xor("sig").alias("sig"))
             .where(F.col("c") >= MIN_DF))
    best = words.groupBy("sig").agg(F.min(F.struct(F.char_length("w").alias("l"), "w", "c", "c1")).alias("b")).select("b.*")
    expect = F.col("c") * F.lit(n1 / max(n, 1))
    z = (F.col("c1") - expect) / F.sqrt(F.greatest(expect * (1 - F.col("c") / F.lit(max(n, 1))), F.lit(0.25)))
    return best.select("w", z.alias("z"))


def fit(docs: DataFrame, labels: DataFrame, usable=None, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``sample_rows`` labelled rows (those first by a hash of the id) whose id passes ``usable``.

    Null ids and null labels teach nothing; a repeated id teaches once, by its smallest label and text.
    """
    rows = stored(sampled_rows(docs, labels, usable, id_col, text_col, label_col, sample_rows))
    if len(shares := rows.groupBy("y").count().collect()) < 2:
        return share_model(np.concatenate([np.zeros(0)] + [np.full(r["count"], float(r["y"])) for r in shares]))
    words = stored(features(rows))
    chosen = [r["w"] for r in words.orderBy(F.abs("z").desc(), "w").limit(FEATURES).collect()]
    telling = [r["w"] for r in words.where("z >= 4").orderBy(F.desc("z"), "w").limit(LEARNED_VOTERS).collect()]

    def run(b: pa.RecordBatch) -> dict:
        seen = [with_stems(observed(t)) for t in b.column(2).to_pylist()]
        return {"id": b.column(0), "y": b.column(1), "votes": [v for _, v in seen],
                "found": [_places(words, chosen, telling) for words, _ in seen]}

    id_type = dict(rows.dtypes)["id"]
    out = map_batches(rows, run, f"id {id_type}, y int, votes array<double>, found array<int>").orderBy("id").toArrow()
    return train(out.column("y").to_numpy().astype(float), np.array(out.column("votes").to_pylist()),
                 [x.values.to_numpy() for c in out.column("found").chunks for x in c], chosen, telling)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text; null and empty texts are scored by the bias alone, repeated rows equally."""
    shared = Shared(docs.sparkSession, model)
    id_type = dict(docs.dtypes)[id_col]

    def run(b: pa.RecordBatch) -> dict:
        m = shared.value
        return {id_col: b.column(0), "score": [m.score(t) for t in b.column(1).fill_null("").to_pylist()]}

    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {id_type}, score double")
