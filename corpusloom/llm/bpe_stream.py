"""BPE encoding and decoding as streaming transducers with bounded lookahead.

**Sufficient lookahead.** Let a prefix of a piece (a pre-token) be known.  Merges are applied by
rank; up to the rank looked at, the tokens left of some boundary are equal whatever follows.  A rule
(u, v) can move that boundary left, over the u before it, if what follows begins with v in one
continuation and not in another.  A second such move needs a later rule (u', v') whose v' begins
with u, that is, has u on the left spine of its derivation (``v' = u`` included).  The longest chain

    reach(u, v) = |u| + max reach(earlier rules (t, ...) with t on the left spine of v)

over all rules, in symbols, is the merge list's sufficient lookahead: a token that ends so many
symbols before the end of what is known is final.  No merge crosses a final boundary, so the rest
is encoded as if it began there, and the encoder's state is the symbols after the last final token.

**Encoding** reads a text in chunks.  Characters are held back only until a safe cut: the end of a word,
or a place inside a run of letters, digits or signs that the normalizer
and the pre-tokenizer pass over.  Pieces go to the merge transducer, an unfinished one symbol by
symbol.  Text without any safe cut (say, a long run of combining marks) is held until one comes.

**Decoding** joins the tokens' bytes and feeds a UTF-8 state machine that holds at most three bytes;
bytes that are no UTF-8 become U+FFFD, one for each maximal part of a character.

The vocabulary files are those of the public ``tokenizers`` library; the library itself is only used for
its normalizer and pre-tokenizer where a chunk has characters that newer Unicode versions treat
differently.  Nothing is trained.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.functions.merge import merge_ids
from corpusloom.llm.common import blocks, utf8

CHUNK = 1 << 15      # characters that are read at a time
MEMO = 1 << 16       # finished pieces kept per task
STAND_IN = {"L": "xxxx", "S": "!!"}  # a run that a run goes on with
DECODE_IDS = 1 << 14  # ids that are decoded at a time
# characters that the library and this module class alike, in any version of Unicode since 12
COMMON = "\x00-՗Ḁ-῿ -⁯₠-₿←-⇿　-ヿ一-鿯가-힣＀-￯"
# letters that do not compose with what precedes them, and whose lower case is a letter too
LETTER = "A-Za-zÀ-ÖØ-öø-įı-ȳЀ-ҁҊ-ԯぁ-ゖァ-ヺ一-鿯"
SIGN = r"!-&(-/:-@\[-`{-~"  # ASCII signs but the apostrophe
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: the byte-level pre-tokenizer's own


def byte_symbols() -> list[str]:
    """The printable character of each byte in byte-level vocabularies (the published map)."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


def lookahead(merges: list[tuple[int, int, int]], size: dict[int, int]) -> int:
    """The sufficient lookahead, in symbols, of merges (left, right, result) in rank order; ``size`` has the base symbols."""
    size, first, best, most = dict(size), {}, {}, 0
    for a, b, c in merges:
        far, t = 0, b
        while t is not None:  # down the left spine of b
            far = max(far, best.get(t, 0))
            t = first.get(t)
        reach = size[a] + far
        best[a] = max(best.get(a, 0), reach)
        most = max(most, reach)
        first.setdefault(c, a)
        size.setdefault(c, size[a] + size[b])
    return most


def load(path: str) -> dict:
    """A ``tokenizers`` BPE file as plain data, read on the driver (about 2 MB); other kinds raise ValueError."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, vocab = spec["model"], spec["model"]["vocab"]
    suffix = model.get("end_of_word_suffix") or ""
    parts = lambda x: (x or {}).get("normalizers") or (x or {}).get("pretokenizers") or ([x] if x else [])
    steps = [(n["type"], (n.get("pattern") or {}).get("Regex"), n.get("content")) for n in parts(spec["normalizer"])]
    if any(s not in (("NFC", None, None), ("Lowercase", None, None), ("Replace", r"\s+", " ")) for s in steps):
        raise ValueError(f"normalizer not covered: {steps}")
    pattern, dropped, byte_level = None, False, False
    for p in parts(spec["pre_tokenizer"]):
        if p["type"] == "Split" and p["behavior"] == "Removed" and p["invert"]:
            pattern, dropped = p["pattern"]["Regex"], True
        elif p["type"] == "ByteLevel" and not p["add_prefix_space"]:
            byte_level = True
            if p.get("use_regex", True) and pattern is None:
                pattern = BYTE_LEVEL
        else:
            raise ValueError(f"pre-tokenizer not covered: {p}")
    if not byte_level or model["type"] != "BPE" or model.get("continuing_subword_prefix") or pattern is None:
        raise ValueError("only byte-level BPE files are covered")
    symbols = byte_symbols()
    inner = [vocab[s] for s in symbols]
    last = [vocab[s + suffix] for s in symbols]
    merges = []
    for m in model["merges"]:
        a, b = m if isinstance(m, list) else m.split(" ")
        merges.append((vocab[a], vocab[b], vocab[a + b]))
    made = [c for *_, c in merges]
    if len(set(made)) < len(made) or set(made) & {*inner, *last}:
        raise ValueError("a token with two derivations: the lookahead does not hold")
    decoder = (spec.get("decoder") or {}).get("type")
    if decoder not in (None, "ByteLevel"):
        raise ValueError(f"decoder not covered: {decoder}")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added tokens with options are not covered")
    known = {s: bytes([b]) for b, s in enumerate(symbols)}

    def raw(t: str) -> bytes:
        if decoder is None or any(c not in known for c in t):
            return t.encode("utf-8")
        return b"".join(known[c] for c in t)

    tokens = {i: raw(t) for t, i in vocab.items()} | {i: raw(t) for t, i in special.items()}
    return {"inner": inner, "last": last, "merges": merges, "special": special, "pattern": pattern, "dropped": dropped,
            "nfc": any(s[0] == "NFC" for s in steps), "lower": any(s[0] == "Lowercase" for s in steps),
            "tokens": tokens, "joint": b" " if decoder is None else b"",
            "lookahead": lookahead(merges, {i: 1 for i in [*inner, *last]})}


class Merger:
    """The merge transducer: symbols in, tokens out as soon as they are final."""

    def __init__(self, spec: dict):
        self.rank = {(a, b): (r, c) for r, (a, b, c) in enumerate(spec["merges"])}
        self.size = {i: 1 for i in [*spec["inner"], *spec["last"]]}
        for a, b, c in spec["merges"]:
            self.size[c] = self.size[a] + self.size[b]
        self.inner, self.last, self.ahead = spec["inner"], spec["last"], spec["lookahead"]
        self.window = 4 * self.ahead + 16
        self.memo: dict[str, tuple[int, ...]] = {}
        self.held: list[int] = []  # symbols after the last final token, but the last symbol
        self.byte = -1             # the last byte: whether it ends the piece is not known yet

    def feed(self, raw: bytes, out: list[int]) -> None:
        """More bytes of an unfinished piece; final tokens go to ``out``."""
        if not raw:
            return
        if self.byte >= 0:
            self.held.append(self.inner[self.byte])
        self.byte = raw[-1]
        for i in range(0, len(raw) - 1, self.window):
            self.held += [self.inner[b] for b in raw[i:min(i + self.window, len(raw) - 1)]]
            if len(self.held) >= self.window:
                known, end = len(self.held) - self.ahead, 0
                for t in merge_ids(self.held, self.rank):
                    if end + self.size[t] > known:
                        break
                    out.append(t)
                    end += self.size[t]
                self.held = self.held[end:]

    def finish(self, out: list[int]) -> None:
        if self.byte >= 0:
            out += merge_ids([*self.held, self.last[self.byte]], self.rank)
        self.held, self.byte = [], -1

    def piece(self, text: str) -> tuple[int, ...]:
        """A whole piece."""
        got = self.memo.get(text)
        if got is None:
            out: list[int] = []
            self.feed(text.encode("utf-8"), out)
            self.finish(out)
            got = tuple(out)
            if len(text) < 64:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[text] = got
        return got


class Encoder:
    """The whole transducer: chunks of a text in, ids out; ``finish`` ends the text."""

    def __init__(self, spec: dict):
        import regex
        import unicodedata

        self.spec, self.merger, self.ids, self.unicode = spec, Merger(spec), spec["special"], unicodedata
        self.find = regex.compile(spec["pattern"]).findall
        self.rare = regex.compile(f"[^{COMMON}]").search
        names = sorted(self.ids, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names)) if names else "(?!)")
        self.reach = max(map(len, names), default=1)
        # the last place: before white space, else inside a run of letters, of signs, or of digits (if they are single pieces)
        self.space = regex.compile(r"(?r)(?<=\S)(?=[ \t\n\r])")
        self.inside = regex.compile(rf"(?r)(?<=[{LETTER}]{{4}})(?=[{LETTER}])|(?<=[{SIGN}]{{2}})(?=[{SIGN}])" + (r"|(?<=[0-9])(?=[0-9])" if spec["dropped"] else ""))
        self.buf, self.open = "", None
        self.library = None

    def _rare_pieces(self, text: str) -> list[str]:
        from tokenizers import Regex, normalizers, pre_tokenizers

        if self.library is None:
            steps = ([normalizers.NFC()] if self.spec["nfc"] else []) + ([normalizers.Lowercase()] if self.spec["lower"] else [])
            self.library = (normalizers.Sequence(steps), pre_tokenizers.Split(Regex(self.spec["pattern"]), "removed", invert=True))
        return [p for p, _ in self.library[1].pre_tokenize_str(self.library[0].normalize_str(text))]

    def _normal(self, text: str) -> str:
        if self.spec["nfc"] and not text.isascii():
            text = self.unicode.normalize("NFC", text)
        return text.replace("Σ", "σ").lower() if self.spec["lower"] else text

    def _pieces(self, text: str) -> list[str]:
        return self._rare_pieces(text) if self.rare(text) else self.find(self._normal(text))

    def _part(self, text: str, runs_on: str | None, out: list[int]) -> None:
        """A part of the text between safe cuts; its last piece runs on if ``runs_on`` names the class of its run."""
        if self.open:  # the run of the piece before goes on; a stand-in for it tells how far
            stand_in = STAND_IN[self.open]
            first, *pieces = self._pieces(stand_in + text)
            self.merger.feed(first[len(stand_in):].encode("utf-8"), out)
            if runs_on and not pieces:
                return
            self._end(out)
        else:
            pieces = self._pieces(text) if text else []
        tail = pieces.pop() if runs_on and pieces else None
        memo, piece = self.merger.memo.get, self.merger.piece
        for p in pieces:
            out += memo(p) or piece(p)
        if tail is not None:
            self.merger.feed(tail.encode("utf-8"), out)
            self.open = runs_on

    def _cut(self, limit: int) -> tuple[int, str | None]:
        m = self.space.search(self.buf, 0, limit + 1) if limit > 0 else None
        if m and 0 < m.start() <= limit:
            return m.start(), None
        m = self.inside.search(self.buf, 0, limit + 1) if limit > 0 else None
        if not m or not 0 < m.start() <= limit:
            return 0, None
        c = self.buf[m.start() - 1]
        return m.start(), None if c.isdigit() else "S" if c.isascii() and not c.isalpha() else "L"

    def feed(self, chunk: str) -> list[int]:
        """More text; returns the ids that are final."""
        out: list[int] = []
        self.buf += chunk
        while m := self.special.search(self.buf):
            self._part(self.buf[:m.start()], None, out)
            self._end(out)
            out.append(self.ids[m.group()])
            self.buf = self.buf[m.end():]
        if len(self.buf) >= CHUNK:
            cut, runs_on = self._cut(len(self.buf) - self.reach)
            if cut:
                self._part(self.buf[:cut], runs_on, out)
                self.buf = self.buf[cut:]
        return out

    def _end(self, out: list[int]) -> None:
        if self.open:
            self.merger.finish(out)
            self.open = None

    def finish(self) -> list[int]:
        """The end of the text; the encoder is then ready for another one."""
        out: list[int] = []
        self._part(self.buf, None, out)
        self._end(out)
        self.buf = ""
        return out

    def encode(self, text: str) -> Iterator[list[int]]:
        for i in range(0, len(text), CHUNK):
            yield self.feed(text[i:i + CHUNK])
        yield self.finish()


class Decoder:
    """Ids in, text out; at most three bytes are held back."""

    def __init__(self, spec: dict):
        self.tokens, self.joint = spec["tokens"], spec["joint"]
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids: Iterable[int]) -> str:
        raw = [t for t in map(self.tokens.get, ids) if t is not None]  # unknown ids are passed over
        if not raw:
            return ""
        text = self.machine.decode((self.joint if self.begun else b"") + self.joint.join(raw))
        self.begun = True
        return text

    def finish(self) -> str:
        text = self.machine.decode(b"", True)
        self.begun = False
        return text


def encode(docs: DataFrame, spec: dict, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` without its text, with ``out``: the token ids of the whole text, array<int>.

    Null and empty texts have no ids.  Special tokens' strings in a text become their ids, as the library does by
    default; none are added.  Repeated rows are encoded each, other columns (null or not) are kept; one of the name
    ``out`` raises ValueError.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    keep = [c for c in docs.columns if c != text_col]
    shared = docs.sparkSession.sparkContext.broadcast({k: v for k, v in spec.items() if k not in ("tokens", "joint")})

    def run(batches):
        enc = Encoder(shared.value)
        for b in batches:
            text = b.column(len(keep)).fill_null("")
            _, off = utf8(text)
            for i, j in blocks(off):  # bounded output, texts whole
                ids = [list(chain.from_iterable(enc.encode(t))) for t in text.slice(i, j - i).to_pylist()]
                cols = [c.slice(i, j - i) for c in b.columns[:-1]] + [pa.array(ids, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, out])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.IntegerType()))])
    return docs.select(*[f"`{c}`" for c in keep], f"`{text_col}`").mapInArrow(run, schema)


def decode(df: DataFrame, spec: dict, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of ``ids_col``; special tokens are kept, unknown ids passed over, null ids give an empty text."""
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    shared = df.sparkSession.sparkContext.broadcast({k: spec[k] for k in ("tokens", "joint")})
    at, names = df.columns.index(ids_col), [*df.columns, out]

    def run(batches):
        dec = Decoder(shared.value)
        for b in batches:
            col = b.column(at).cast(pa.large_list(pa.int32()))
            flat, off = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
            none, texts = col.is_null().to_pylist(), []
            for r in range(len(col)):
                lo, hi = (0, 0) if none[r] else (int(off[r]), int(off[r + 1]))
                parts = [dec.feed(flat[x:min(hi, x + DECODE_IDS)].tolist()) for x in range(lo, hi, DECODE_IDS)]
                texts.append("".join([*parts, dec.finish()]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))


def vocabulary_path(spark_context: SparkContext, name: str = "word_bpe_49k.json") -> str:
    """The file in the folder that ``spark.corpusloom.tokenizers`` names (default /opt/tokenizers)."""
    return spark_context.getConf().get("spark.corpusloom.tokenizers", "/opt/tokenizers").rstrip("/") + "/" + name
