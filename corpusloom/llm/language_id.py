"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled reference text.  A
document is parsed greedily into the longest phrases that occur in a reference;
the language that needs the fewest phrases, normalised by the logarithm of its
reference length (the cross-parsing estimate c * log n / letters), wins.

The automata are fitted on a bounded sample: ``REF_CHARS`` characters of each
language, of documents in the order of a hash.  Every document is parsed whole:
all texts of a block advance through all automata in step, one NumPy gather per
character position, the longest texts for the most steps.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Shared, blocks, map_batches

REF_CHARS = 24_000   # characters of reference text per language
REF_DOCS = 64        # expected documents drawn per language to fill them
MAX_CLASSES = 1_024  # letters told apart; rarer ones are one class
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts exactly the substrings of ``symbols``; state 0 is the start."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Model:
    """The automata of all languages: their transitions (state, class, next state), which travel to the tasks."""

    def __init__(self, reference: dict[str, str]):
        self.langs = sorted(reference)
        texts = {k: _code_points(reference[k]) for k in self.langs}
        every = np.concatenate([*texts.values(), np.zeros(0, np.uint32)])
        found, n = np.unique(every[_letters()[every]], return_counts=True)
        found = found[np.lexsort((found, -n))][:MAX_CLASSES]
        self.classes = len(found) + 2  # 0: a gap between words, 1: other letters
        self.codes = {int(c): i + 2 for i, c in enumerate(found)}
        self.moves, self.sizes = [], []
        for k in self.langs:
            nxt = suffix_automaton(self.symbols(texts[k])[0].tolist())
            self.moves.append(np.fromiter((x for s, out in enumerate(nxt) for c, to in out.items() for x in (s, c, to)),
                                          np.int32).reshape(-1, 3))
            self.sizes.append(len(nxt))
        if sum(self.sizes) * self.classes >= 1 << 30:
            raise ValueError("too many languages or letters for one table: lower ref_chars")
        self.bases = np.cumsum([0, *self.sizes])[:-1]
        self.roots = (self.bases * self.classes).astype(np.uint32)
        self.log_n = np.array([math.log(max(2, len(texts[k]))) for k in self.langs])

    def table(self) -> np.ndarray:
        """All automata as one table, laid out in the task: entry ``state * classes + class`` is the next state
        (times classes); the top two bits say how many phrases begin at or right after this character."""
        if not hasattr(self, "_table"):
            table = np.empty((sum(self.sizes), self.classes), np.uint32)
            for moves, base, size in zip(self.moves, self.bases.tolist(), self.sizes, strict=True):
                state, letter, to = moves.T.astype(np.int64)
                start = np.zeros(self.classes, np.int64)
                start[letter[state == 0]] = to[state == 0]
                part = table[base: base + size]
                # a letter the reference lacks is a phrase of its own
                part[:] = (start + base) * self.classes | np.where(start == 0, 2, 1) << 30
                part[0] = base * self.classes | 1 << 30
                part[state, letter] = (to + base) * self.classes
            self._table = table.ravel()
        return self._table

    def symbols(self, points: np.ndarray, doc: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Classes of the characters; what is no letter becomes one gap (never two in a row)."""
        if not hasattr(self, "_lut"):
            lut = _letters().astype(np.uint16)
            for c, i in self.codes.items():
                lut[c] = i
            self._lut = lut
        s = self._lut[points]
        keep = s > 0
        if len(keep) > 1:
            keep[1:] |= s[:-1] > 0
        if doc is not None and len(doc) > 1:
            keep[1:] |= doc[1:] != doc[:-1]
        return s[keep], None if doc is None else doc[keep]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_lut", "_table")}

    def parse(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters of each text, and its phrases under each language (texts x languages)."""
        points = [_code_points(t) for t in texts]
        doc = np.repeat(np.arange(len(texts)), [len(p) for p in points])
        s, doc = self.symbols(np.concatenate([*points, np.zeros(0, np.uint32)]), doc)
        letters = np.bincount(doc[s > 0], minlength=len(texts))
        n, k = np.bincount(doc, minlength=len(texts)), len(self.langs)
        owner = np.argsort(-n, kind="stable")
        owner = owner[n[owner] > 0]  # the longest first: those still going are a prefix
        begin, size = (np.cumsum(n) - n)[owner], n[owner]
        state = np.repeat(self.roots[None, :], len(owner), 0)
        phrases = np.ones((len(owner), k), np.int32)
        table = self.table()
        live = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")  # texts longer than j
        for j, m in enumerate(live.tolist()):
            v = table[state[:m] + s[begin[:m] + j][:, None]]
            phrases[:m] += (v >> 30).astype(np.int32)
            state[:m] = v & 0x3FFFFFFF
        total = np.zeros((len(texts), k), np.int64)
        total[owner] = phrases
        return letters, total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language and a score in [0, 1] per text: the winner's margin over the runner-up, from 0.5 (a tie) up."""
        letters, phrases = self.parse(texts)
        if not self.langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        cost = phrases * self.log_n
        best = cost.argmin(1)
        ranked = np.sort(cost, 1)
        second = ranked[:, 1] if len(self.langs) > 1 else ranked[:, 0]
        score = second / np.maximum(second + ranked[:, 0], 1e-12)
        none = letters == 0
        return [UNDETERMINED if none[i] else self.langs[best[i]] for i in range(len(texts))], np.where(none, 0.0, score)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        ref_chars: int = REF_CHARS, ref_docs: int = REF_DOCS) -> Model:
    """A model from labelled rows; null languages and null or empty texts teach nothing.

    All rows are counted per language; a hash then draws about ``ref_docs``
    documents of each, and their texts, in hash order, fill ``ref_chars``
    characters.  That sample is the only thing that reaches the driver.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & (F.length(F.trim(F.col(text_col))) > 0)).select(
        F.col(lang_col).cast("string").alias("l"), F.col(text_col).alias("t"),
        (F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(6)), F.lit(1 << 30)) / float(1 << 30)).alias("u"))
    rates = rows.groupBy("l").agg((F.lit(2.0 * ref_docs) / F.count("*")).alias("rate"))
    drawn = (rows.join(rates, "l").where("u < rate")
             .select("l", "u", F.substring("t", 1, ref_chars).alias("t")).collect())
    ref: dict[str, str] = {}
    for r in sorted(drawn, key=lambda r: (r["l"], r["u"], r["t"])):
        have = ref.get(r["l"], "")
        if len(have) < ref_chars:
            ref[r["l"]] = (have + " " + r["t"])[:ref_chars]
    return Model(ref)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text; ``und`` where a text is null or has no letter.

    Ties go to the language first by name.  Without any labelled text every
    language is ``und``.  Repeated rows give repeated, equal results.
    """
    shared = Shared(docs.sparkSession, model)
    id_type = dict(docs.dtypes)[id_col]

    def run(b: pa.RecordBatch) -> dict:
        lang, score = predict_column(shared.value, b.column(1))
        return {id_col: b.column(0), "lang_pred": lang, "score": score}

    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {id_type}, lang_pred string, score double")


def predict_column(model: Model, col: pa.Array) -> tuple[list[str], np.ndarray]:
    texts = col.fill_null("").to_pylist()
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    lang, score = [], []
    for i, j in blocks(off):
        a, b = model.predict(texts[i:j])
        lang += a
        score.append(b)
    return lang, np.concatenate([*score, np.zeros(0)])


def drop_undetermined(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose language is determined, with all their columns; a null language becomes the predicted one."""
    shared = Shared(docs.sparkSession, model)
    at, lang = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches):
        for b in batches:
            found = pa.array(predict_column(shared.value, b.column(at))[0], pa.string())
            cols = list(b.columns)
            cols[lang] = pa.compute.coalesce(cols[lang], found.cast(cols[lang].type))
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names).filter(pa.compute.not_equal(found, UNDETERMINED))

    return docs.mapInArrow(run, docs.schema)
