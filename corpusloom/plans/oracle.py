"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code: plain SQL over the driver tables
(global windows, range joins and string aggregation are fine here, the oracle
only runs at small scale).  Derived inputs are rebuilt from the same fixed
values as ``plans.fixtures``.
"""

from __future__ import annotations

from corpusloom.functions import clean as CL
from corpusloom.plans import fixtures as X
from corpusloom.plans import queries as Q


def lit(s: str) -> str:
    """A DuckDB string expression for ``s`` (control/non-ASCII chars via chr())."""
    parts, buf = [], []
    for ch in s:
        if 32 <= ord(ch) < 127:
            buf.append("''" if ch == "'" else ch)
        else:
            if buf:
                parts.append("'" + "".join(buf) + "'")
                buf = []
            parts.append(f"chr({ord(ch)})")
    if buf or not parts:
        parts.append("'" + "".join(buf) + "'")
    return "(" + " || ".join(parts) + ")"


NL = "chr(10)"

# Python's whitespace set written out for RE2 (whose \s is ASCII-only).
WS = (r"[\t\n\x0b\x0c\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def _re2(p: str) -> str:
    return p.replace(r"\s", WS)


def sq(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


def B1(t):
    return (f"CASE WHEN regexp_matches({t}, {sq(CL.START_MARKER)}, 's') "
            f"THEN regexp_replace({t}, {sq('^.*?' + CL.START_MARKER)}, '', 's') ELSE {t} END")


def B2(t):
    return f"regexp_replace({t}, {sq(CL.END_MARKER + '.*$')}, '', 's')"


def B3(t):
    return f"regexp_replace({t}, {sq(_re2(CL.CREDIT))}, '', 'gs')"


def B4(t):
    return f"regexp_replace({t}, {sq(_re2(CL.NOTE))}, '', 'gs')"


def B5(t):
    return f"regexp_replace({t}, {sq('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def B6(t):
    return B5(B4(B3(B2(B1(t)))))


RAW = f"""raw AS (
  SELECT doc_id, source, CASE doc_id % 6
    WHEN 0 THEN {lit(X.S0)} || source || {lit(' ***' + chr(10))} || text || {NL} || {lit(X.E0)} || source
                || {lit(' ***' + chr(10))} || {lit(X.LICENCE)}
    WHEN 1 THEN {lit('Title: ')} || source || {NL} || {lit(X.S1)} || source || {lit(chr(10) + '***' + chr(10))} || text
    WHEN 2 THEN text || {lit(chr(10) * 2)} || {lit(X.E1)} || source || {lit(' ***' + chr(10))} || {lit(X.LICENCE)}
    WHEN 3 THEN {lit(' ' + chr(9) + chr(10) + chr(0xA0))} || text || {lit(chr(0x3000) + chr(10) + ' ' + chr(0x1C))}
    WHEN 4 THEN {lit(X.CREDIT_TOP)} || text || {lit(X.NOTES)} || {lit(X.CREDIT_PGDP)}
    ELSE {lit(X.S0 + 'A ***' + chr(10) + X.PREFACE + X.S0 + 'B ***' + chr(10))} || text
  END AS t FROM (SELECT doc_id, coalesce(source, {lit(X.NO_SOURCE)}) AS source, coalesce(text, '') AS text FROM documents) d)"""

WORKS = f"""works AS (
  SELECT CAST(row_number() OVER (ORDER BY source) AS BIGINT) AS work_id, source AS title,
         CAST(row_number() OVER (ORDER BY source) AS INTEGER) AS ord
  FROM (SELECT DISTINCT coalesce(source, {lit(X.NO_SOURCE)}) AS source FROM documents) d)"""

PIECES = f"""{RAW}, {WORKS},
pieces AS (SELECT w.ord, w.work_id, w.title, r.doc_id, {B6('r.t')} AS body
           FROM raw r JOIN works w ON r.source = w.title)"""

# Char corpus: documents in doc_id order, each followed by a newline.
SEQ = f"""d AS (SELECT doc_id, text || {NL} AS t FROM documents),
o AS (SELECT doc_id, t, length(t) AS n,
             coalesce(sum(length(t)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
      FROM d),
seq AS (SELECT doc_id, i - 1 AS pos, off + i - 1 AS gpos, c
        FROM (SELECT doc_id, off, unnest(string_split(t, '')) AS c,
                     generate_subscripts(string_split(t, ''), 1) AS i FROM o)),
stats AS (SELECT count(*) AS n_all, CAST(floor({Q.TRAIN_FRAC}::DOUBLE * count(*)) AS BIGINT) AS ntr,
                 count(DISTINCT c) AS v FROM seq),
lagged AS (SELECT gpos, c, lag(c, 1) OVER (ORDER BY gpos) AS c1,
                  lag(c, 2) OVER (ORDER BY gpos) AS c2 FROM seq),
tr AS (SELECT l.* FROM lagged l, stats s WHERE l.gpos >= 1 AND l.gpos < s.ntr),
va AS (SELECT l.*, l.gpos - s.ntr AS rel FROM lagged l, stats s WHERE l.gpos >= s.ntr + 1),
uni AS (SELECT c AS w, count(*) AS n FROM tr GROUP BY c),
bi AS (SELECT c1, c AS w, count(*) AS n FROM tr GROUP BY c1, c),
bic AS (SELECT c1, sum(n) AS nc FROM bi GROUP BY c1),
ntr_t AS (SELECT count(*) AS nt FROM tr)"""

def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def starts(split: str) -> str:
    n = "s.ntr" if split == "train" else "(s.n_all - s.ntr)"
    return f"""SELECT '{split}' AS split, it.range AS it, rw.range AS row,
  CAST(('0x' || substr(md5(concat_ws('|', {Q.SEED}, '{split}', it.range, rw.range)), 1, 15))::BIGINT
       % ({n} - {Q.BLOCK_SIZE}) AS BIGINT) AS start,
  {'0' if split == 'train' else 's.ntr'} AS base
FROM range({Q.EVAL_BATCHES}) it, range({Q.BATCH_SIZE}) rw, stats s"""


WINDOWS = f"""st AS ({starts('train')} UNION ALL {starts('val')}),
win AS (SELECT st.split, st.it, st.row, st.start, string_agg(q.c, '' ORDER BY q.gpos) AS ws
        FROM st JOIN seq q ON q.gpos BETWEEN st.base + st.start AND st.base + st.start + {Q.BLOCK_SIZE}
        GROUP BY st.split, st.it, st.row, st.start)"""

# Bigram probability as a join (for set-based use).
PROB_JOIN = """
  LEFT JOIN uni u ON u.w = X.w
  LEFT JOIN bi b ON b.c1 = X.c1 AND b.w = X.w
  LEFT JOIN bic bc ON bc.c1 = X.c1"""


def bigram_p(alias: str = "X") -> str:
    return (f"((coalesce(b.n, 0) + ((coalesce(u.n, 0) + 1.0 / s.v) / (t.nt + 1.0))) "
            f"/ (coalesce(bc.nc, 0) + 1.0))")


SQL: dict[str, str] = {}

SQL["normalize_newlines"] = f"""
WITH n AS (SELECT doc_id, regexp_replace(text, '\\r\\n?', {NL}, 'g') AS t FROM documents)
SELECT CAST(doc_id AS BIGINT) AS doc_id, t AS text, CAST(length(t) AS BIGINT) AS n_chars FROM n"""

for _name, _fn in [("after_start", B1), ("before_end", B2), ("drop_credits", B3),
                   ("drop_notes", B4), ("strip_ws", B5), ("strip_boilerplate", B6)]:
    SQL[_name] = with_(RAW) + f"SELECT CAST(doc_id AS BIGINT) AS doc_id, {_fn('t')} AS body FROM raw"

SQL["work_report"] = with_(PIECES) + """
SELECT CAST(title AS VARCHAR) AS title, CAST(sum(length(body)) AS BIGINT) AS chars
FROM pieces GROUP BY ROLLUP (title)"""

SQL["assemble_corpus"] = with_(PIECES, f"""lst AS (SELECT ord, max(doc_id) AS last_doc FROM pieces GROUP BY ord),
mx AS (SELECT max(ord) AS maxord FROM pieces),
tx AS (SELECT p.ord, p.work_id, p.doc_id, p.body || CASE WHEN p.doc_id <> l.last_doc THEN {NL}
              WHEN p.ord <> m.maxord THEN {lit(chr(10) * 3)} ELSE {NL} END AS text
       FROM pieces p JOIN lst l ON p.ord = l.ord, mx m)""") + """
SELECT CAST(ord AS BIGINT) AS ord, CAST(work_id AS BIGINT) AS work_id, CAST(doc_id AS BIGINT) AS doc_id,
  CAST(coalesce(sum(length(text)) OVER (ORDER BY ord, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_off,
  CAST(length(text) AS BIGINT) AS n_chars, text
FROM tx"""

SQL["char_vocab"] = f"""
SELECT CAST(row_number() OVER (ORDER BY c) - 1 AS BIGINT) AS id, c AS token
FROM (SELECT DISTINCT unnest(string_split(text || {NL}, '')) AS c FROM documents)"""

SQL["char_encode"] = with_(SEQ, """vocab AS (SELECT row_number() OVER (ORDER BY c) - 1 AS id, c
  FROM (SELECT DISTINCT c FROM seq))""") + """
SELECT CAST(q.doc_id AS BIGINT) AS doc_id, CAST(q.pos AS BIGINT) AS pos, CAST(v.id AS BIGINT) AS id
FROM seq q JOIN vocab v ON q.c = v.c"""

SQL["char_decode"] = f"SELECT CAST(doc_id AS BIGINT) AS doc_id, text || {NL} AS text FROM documents"

SQL["tokenizer_stats"] = f"""
WITH c AS (SELECT sum(length(text) + 1) AS chars FROM documents),
v AS (SELECT count(DISTINCT x) AS v FROM (SELECT unnest(string_split(text || {NL}, '')) AS x FROM documents))
SELECT 'char' AS tokenizer, CAST(v.v AS BIGINT) AS vocab_size, CAST(c.chars AS BIGINT) AS chars,
  CAST(c.chars AS BIGINT) AS tokens, round(c.chars::DOUBLE / c.chars::DOUBLE, 6) AS chars_per_token,
  CAST(round({Q.BLOCK_SIZE} * (c.chars::DOUBLE / c.chars::DOUBLE), 0) AS BIGINT) AS context_chars
FROM c, v"""

SQL["vocab_listing"] = f"""
SELECT CAST(row_number() OVER (ORDER BY c) - 1 AS BIGINT) AS id, c AS token,
  CASE WHEN c = '<unk>' THEN 'UNKNOWN' ELSE 'NORMAL' END AS type
FROM (SELECT DISTINCT unnest(string_split(text || {NL}, '')) AS c FROM documents)"""

SQL["global_positions"] = with_(SEQ) + """
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(n AS BIGINT) AS n, CAST(off AS BIGINT) AS off FROM o WHERE n > 0"""

SQL["split_by_position"] = with_(SEQ) + """
SELECT CAST(q.doc_id AS BIGINT) AS doc_id, CASE WHEN q.gpos < s.ntr THEN 'train' ELSE 'val' END AS split,
  CAST(count(*) AS BIGINT) AS tokens, CAST(min(q.gpos) AS BIGINT) AS first_gpos, CAST(max(q.gpos) AS BIGINT) AS last_gpos
FROM seq q, stats s GROUP BY 1, 2"""

SQL["sample_starts"] = with_(SEQ, f"st AS ({starts('train')} UNION ALL {starts('val')})") + """
SELECT split, CAST(it AS BIGINT) AS it, CAST(row AS BIGINT) AS row, CAST(start AS BIGINT) AS start FROM st"""

SQL["gather_windows"] = with_(SEQ, WINDOWS) + f"""
SELECT split, CAST(it AS BIGINT) AS it, CAST(row AS BIGINT) AS row, CAST(start AS BIGINT) AS start,
  substr(ws, 1, {Q.BLOCK_SIZE}) AS x, substr(ws, 2, {Q.BLOCK_SIZE}) AS y FROM win"""

SQL["next_token"] = with_(SEQ, """pr AS (SELECT gpos, c AS tok, lead(c) OVER (ORDER BY gpos) AS nxt FROM seq)""") + """
SELECT CASE WHEN p.gpos < s.ntr THEN 'train' ELSE 'val' END AS split, p.tok, p.nxt, CAST(count(*) AS BIGINT) AS pairs
FROM pr p, stats s WHERE p.nxt IS NOT NULL AND (p.gpos + 1 < s.ntr OR p.gpos >= s.ntr)
GROUP BY 1, 2, 3"""

SQL["fit_counts"] = with_(SEQ) + """
SELECT CAST(j AS BIGINT) AS j, ctx, tgt, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 0 AS j, '' AS ctx, c AS tgt FROM tr
  UNION ALL SELECT 1, c1, c FROM tr
  UNION ALL SELECT 2, c2 || c1, c FROM tr WHERE gpos >= 2)
GROUP BY j, ctx, tgt"""

SQL["next_dist"] = with_(SEQ, "vocab AS (SELECT row_number() OVER (ORDER BY c) - 1 AS id, c FROM (SELECT DISTINCT c FROM seq))",
                         "X AS (SELECT a.c AS c1, b.id, b.c AS w FROM vocab a, vocab b)") + f"""
SELECT X.c1 AS ctx, CAST(X.id AS BIGINT) AS id, X.w AS token, round(ln({bigram_p()}), 6) AS logit
FROM X {PROB_JOIN}, stats s, ntr_t t"""

SQL["cross_entropy"] = with_(SEQ, "X AS (SELECT c1, c AS w FROM va)") + f"""
SELECT 'val' AS split, CAST(count(*) AS BIGINT) AS targets, round(avg(-ln({bigram_p()})), 6) AS ce
FROM X {PROB_JOIN}, stats s, ntr_t t"""

# Order-2 model: interpolate the trigram over the bigram.
SQL["cross_entropy_k2"] = with_(SEQ, """tri AS (SELECT c2, c1, c AS w, count(*) AS n FROM tr WHERE gpos >= 2 GROUP BY 1, 2, 3),
tric AS (SELECT c2, c1, sum(n) AS nc FROM tri GROUP BY 1, 2),
X AS (SELECT CASE WHEN rel >= 2 THEN c2 END AS c2, c1, c AS w FROM va)""") + f"""
SELECT 'val' AS split, CAST(count(*) AS BIGINT) AS targets, round(avg(-ln(
  CASE WHEN X.c2 IS NULL THEN {bigram_p()}
       ELSE (coalesce(tr3.n, 0) + {bigram_p()}) / (coalesce(tc.nc, 0) + 1.0) END)), 6) AS ce
FROM X {PROB_JOIN}
  LEFT JOIN tri tr3 ON tr3.c2 = X.c2 AND tr3.c1 = X.c1 AND tr3.w = X.w
  LEFT JOIN tric tc ON tc.c2 = X.c2 AND tc.c1 = X.c1, stats s, ntr_t t"""

SQL["eval_loss"] = with_(SEQ, WINDOWS, f"""X AS (SELECT split, it, substr(ws, k.range + 1, 1) AS c1, substr(ws, k.range + 2, 1) AS w
  FROM win, range({Q.BLOCK_SIZE}) k),
pb AS (SELECT X.split, X.it, avg(-ln({bigram_p()})) AS l FROM X {PROB_JOIN}, stats s, ntr_t t GROUP BY 1, 2)""") + """
SELECT split, round(avg(l), 6) AS loss FROM pb GROUP BY split"""

SQL["score_documents"] = with_(SEQ, """X AS (SELECT item_id, c1, w FROM (
    SELECT item_id, c AS w, lag(c) OVER (PARTITION BY item_id ORDER BY i) AS c1
    FROM (SELECT item_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS i
          FROM benchmark)) WHERE c1 IS NOT NULL)""") + f"""
SELECT CAST(item_id AS BIGINT) AS item_id, CAST(count(*) AS BIGINT) AS targets, round(avg(-ln({bigram_p()})), 6) AS ce
FROM X {PROB_JOIN}, stats s, ntr_t t GROUP BY item_id"""

# ----------------------------------------------------------------------------- F
U52 = "4503599627370496.0"


def unit_sql(*keys: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(keys)})), 1, 13))::BIGINT / {U52})"


# Bigram distribution over every vocabulary context (and, for generation, the
# empty context and any prompt character outside the vocabulary).
VOCAB = "vocab AS (SELECT row_number() OVER (ORDER BY c) - 1 AS id, c FROM (SELECT DISTINCT c FROM seq))"
DIST = f"""X AS (SELECT a.c1, b.id, b.c AS w FROM ctxs a, vocab b),
dist AS (SELECT X.c1 AS ctx, X.id, X.w AS token, ln({bigram_p()}) AS logit
         FROM X {PROB_JOIN}, stats s, ntr_t t),
tdist AS (SELECT ctx, id, token, logit / {Q.TEMPERATURE} AS lt FROM dist),
kdist AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY lt DESC) AS rk FROM tdist)
          WHERE rk <= {Q.TOP_K}),
edist AS (SELECT ctx, id, token, exp(lt - max(lt) OVER (PARTITION BY ctx)) AS e FROM kdist),
sdist AS (SELECT ctx, id, token, e / sum(e) OVER (PARTITION BY ctx) AS p FROM edist)"""

SQL["temper"] = with_(SEQ, VOCAB, "ctxs AS (SELECT c AS c1 FROM vocab)", DIST) + """
SELECT ctx, CAST(id AS BIGINT) AS id, round(lt, 6) AS logit FROM tdist"""

SQL["top_k"] = with_(SEQ, VOCAB, "ctxs AS (SELECT c AS c1 FROM vocab)", DIST) + """
SELECT ctx, CAST(id AS BIGINT) AS id, round(lt, 6) AS logit FROM kdist"""

SQL["softmax"] = with_(SEQ, VOCAB, "ctxs AS (SELECT c AS c1 FROM vocab)", DIST) + """
SELECT ctx, CAST(id AS BIGINT) AS id, round(p, 6) AS p FROM sdist"""

SQL["draw"] = with_(SEQ, VOCAB, "ctxs AS (SELECT c AS c1 FROM vocab)", DIST,
                    f"""cd AS (SELECT ctx, id, p, sum(p) OVER (PARTITION BY ctx ORDER BY id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
                          {unit_sql(str(Q.SEED), 'ctx')} AS u FROM sdist)""") + """
SELECT ctx, CAST(coalesce(min(CASE WHEN cum > u THEN id END), max(CASE WHEN p > 0 THEN id END)) AS BIGINT) AS id
FROM cd GROUP BY ctx"""

SQL["greedy"] = with_(SEQ, VOCAB, "ctxs AS (SELECT c AS c1 FROM vocab)", DIST) + """
SELECT ctx, CAST(id AS BIGINT) AS id FROM (
  SELECT ctx, id, row_number() OVER (PARTITION BY ctx ORDER BY logit DESC, id) AS rn FROM dist) WHERE rn = 1"""

PROMPTS = """prompts AS (SELECT conv_id * 1000 + turn AS prompt_id, text AS prompt FROM conversations WHERE role = 'user'),
ctxs AS (SELECT c AS c1 FROM vocab UNION SELECT right(prompt, 1) FROM prompts)"""

GEN_GREEDY = f"""best AS (SELECT ctx, token FROM (
  SELECT ctx, token, row_number() OVER (PARTITION BY ctx ORDER BY logit DESC, id) AS rn FROM dist) WHERE rn = 1),
gen AS (SELECT prompt_id, 0 AS step, '' AS new, right(prompt, 1) AS last FROM prompts
        UNION ALL
        SELECT g.prompt_id, g.step + 1, g.new || b.token, b.token FROM gen g JOIN best b ON b.ctx = g.last
        WHERE g.step < {Q.GEN_STEPS})"""

GEN_SAMPLED = f"""cd AS (SELECT ctx, id, token, p,
    coalesce(sum(p) OVER (PARTITION BY ctx ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo,
    CASE WHEN id = max(id) OVER (PARTITION BY ctx) THEN 2.0
         ELSE sum(p) OVER (PARTITION BY ctx ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS hi
  FROM sdist),
gen AS (SELECT prompt_id, 0 AS step, '' AS new, right(prompt, 1) AS last, CAST(NULL AS VARCHAR) AS tok FROM prompts
        UNION ALL
        SELECT g.prompt_id, g.step + 1, g.new || c.token, c.token, c.token FROM gen g JOIN cd c ON c.ctx = g.last
          AND {unit_sql(str(Q.SEED), 'g.prompt_id', 'g.step')} >= c.lo
          AND {unit_sql(str(Q.SEED), 'g.prompt_id', 'g.step')} < c.hi
        WHERE g.step < {Q.GEN_STEPS})"""

SQL["generate_greedy"] = "WITH RECURSIVE " + ",\n".join([SEQ, VOCAB, PROMPTS, DIST, GEN_GREEDY]) + f"""
SELECT CAST(prompt_id AS BIGINT) AS prompt_id, new AS completion FROM gen WHERE step = {Q.GEN_STEPS}"""

SQL["generate_sampled"] = "WITH RECURSIVE " + ",\n".join([SEQ, VOCAB, PROMPTS, DIST, GEN_SAMPLED]) + f"""
SELECT CAST(prompt_id AS BIGINT) AS prompt_id, new AS completion FROM gen WHERE step = {Q.GEN_STEPS}"""

SQL["token_deltas"] = "WITH RECURSIVE " + ",\n".join([SEQ, VOCAB, PROMPTS, DIST, GEN_SAMPLED]) + f"""
SELECT CAST(prompt_id AS BIGINT) AS prompt_id, CAST(step - 1 AS BIGINT) AS step, tok AS delta, false AS done
FROM gen WHERE step >= 1
UNION ALL
SELECT CAST(prompt_id AS BIGINT), CAST({Q.GEN_STEPS} AS BIGINT), CAST(NULL AS VARCHAR), true FROM prompts"""

SQL["normalize_requests"] = """
WITH e AS (SELECT *, event_id % 7 = 6 AS empty, event_id % 5 AS m FROM events)
SELECT CAST(event_id AS BIGINT) AS req_id,
  CASE WHEN empty OR m = 0 OR event_type IS NULL OR event_type = '' THEN chr(10) ELSE event_type END AS prompt,
  round(CASE WHEN empty OR m = 1 THEN 0.8 ELSE coalesce(value / 400.0, 0.8) END, 6) AS temperature,
  CAST(CASE WHEN empty OR m = 2 THEN 40 ELSE coalesce(user_id % 50, 40) END AS BIGINT) AS top_k,
  CAST(greatest(1, least(CASE WHEN empty OR m = 3 THEN 240 ELSE coalesce(event_id, 240) END, 600)) AS BIGINT) AS max_new_tokens,
  false AS bad
FROM e"""

# ----------------------------------------------------------------------------- H
HIST = """hist AS (SELECT user_id AS run_id,
    CAST(250 * (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) AS INTEGER) AS it,
    0.9::DOUBLE * value AS train_loss, value AS val_loss,
    (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 1e6 AS secs FROM events),
imp AS (SELECT *, val_loss < best_before AND NOT isnan(val_loss) AS improved FROM (
    SELECT *, coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY it
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'inf'::DOUBLE) AS best_before FROM hist)),
best AS (SELECT run_id, max(it) AS best_it, arg_max(val_loss, it) AS best_val FROM imp WHERE improved GROUP BY run_id),
grp AS (SELECT *, sum(CAST(improved AS INTEGER)) OVER (PARTITION BY run_id ORDER BY it
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM imp),
since AS (SELECT *, CASE WHEN g = 0 THEN rn ELSE rn - 1 END AS evals_since FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id, g ORDER BY it) AS rn FROM grp)),
stop AS (SELECT run_id, min(it) AS stop_it FROM since WHERE evals_since >= 10 GROUP BY run_id),
kept AS (SELECT s.*, coalesce(s.it = t.stop_it, false) AS stopped FROM since s LEFT JOIN stop t ON s.run_id = t.run_id
         WHERE t.stop_it IS NULL OR s.it <= t.stop_it),
summary AS (SELECT run_id, max(it) AS iters, max(secs) AS elapsed, arg_max(train_loss, it) AS final_train,
                   arg_max(val_loss, it) AS final_val, min(val_loss) AS best_val FROM kept GROUP BY run_id),
runs AS (SELECT DISTINCT user_id AS run_id,
    CASE WHEN user_id & 1 = 1 THEN 'rmsnorm' ELSE 'layernorm' END AS norm,
    CASE WHEN user_id & 2 = 2 THEN 'rope' ELSE 'learned' END AS pos,
    CASE WHEN user_id & 4 = 4 THEN 'swiglu' ELSE 'gelu' END AS mlp FROM events)"""


def fixed_sql(x: str, d: int) -> str:
    sc = f"CAST(floor({x} * {10.0 ** d} + 0.5) AS BIGINT)"
    return (f"(CAST({sc} // {10 ** d} AS VARCHAR) || '.' || lpad(CAST({sc} % {10 ** d} AS VARCHAR), {d}, '0'))")


TPS = f"CASE WHEN elapsed > 0 THEN iters * {Q.BATCH_SIZE * Q.BLOCK_SIZE} / elapsed END"

SQL["best_checkpoint"] = with_(HIST) + """
SELECT CAST(run_id AS BIGINT) AS run_id, CAST(best_it AS BIGINT) AS best_it, round(best_val, 6) AS best_val FROM best"""

SQL["early_stop"] = with_(HIST) + """
SELECT CAST(run_id AS BIGINT) AS run_id, CAST(it AS BIGINT) AS it, round(train_loss, 6) AS train_loss,
  round(val_loss, 6) AS val_loss, CAST(evals_since AS BIGINT) AS evals_since, stopped FROM kept"""

SQL["monitor"] = with_(HIST) + """
SELECT CAST(run_id AS BIGINT) AS run_id, CAST(it AS BIGINT) AS it, round(val_loss, 6) AS val_loss,
  evals_since = 0 AS improved, CAST(evals_since AS BIGINT) AS evals_since, stopped FROM kept"""

SQL["throughput"] = with_(HIST) + f"""
SELECT CAST(run_id AS BIGINT) AS run_id, CAST(iters AS BIGINT) AS iters, round(elapsed, 6) AS elapsed,
  round({TPS}, 6) AS tokens_per_s FROM summary"""

SQL["report_card"] = with_(HIST) + f"""
SELECT CAST(s.run_id AS BIGINT) AS run_id, r.norm, r.pos, r.mlp, CAST(s.iters AS BIGINT) AS iters,
  round(s.elapsed / 60, 6) AS minutes, round(s.final_train, 6) AS final_train, round(s.final_val, 6) AS final_val,
  round(s.best_val, 6) AS best_val, round({TPS}, 6) AS tokens_per_s,
  '- **architecture**: norm=' || r.norm || ', pos=' || r.pos || ', mlp=' || r.mlp || '' AS architecture_line,
  '- **loss**: final train ' || {fixed_sql('s.final_train', 4)} || ' / val ' || {fixed_sql('s.final_val', 4)}
    || ', best val ' || {fixed_sql('s.best_val', 4)} AS loss_line
FROM summary s JOIN runs r ON s.run_id = r.run_id"""

SQL["loss_curve"] = with_(HIST) + """
SELECT CAST(run_id AS BIGINT) AS run_id, CAST(it AS BIGINT) AS it, 'train' AS series, round(train_loss, 6) AS loss FROM hist
UNION ALL
SELECT CAST(run_id AS BIGINT), CAST(it AS BIGINT), 'val', round(val_loss, 6) FROM hist"""

_ABL = []
for _f, _o in [("norm", ("pos", "mlp")), ("pos", ("norm", "mlp")), ("mlp", ("norm", "pos"))]:
    _ABL.append(f"""SELECT '{_f}' AS flag, '{_o[0]}=' || a.{_o[0]} || ',{_o[1]}=' || a.{_o[1]} AS fixed,
  a.{_f} AS a_value, b.{_f} AS b_value, CAST(a.runs AS BIGINT) AS a_runs, CAST(b.runs AS BIGINT) AS b_runs,
  round(b.v - a.v, 6) AS delta
FROM cfg a JOIN cfg b ON a.{_o[0]} = b.{_o[0]} AND a.{_o[1]} = b.{_o[1]} AND a.{_f} < b.{_f}""")
SQL["ablation"] = with_(HIST, """cfg AS (SELECT r.norm, r.pos, r.mlp, count(*) AS runs, avg(b.best_val) AS v
  FROM best b JOIN runs r ON b.run_id = r.run_id GROUP BY 1, 2, 3)""") + "\nUNION ALL\n".join(_ABL)

SQL["progress"] = with_(HIST) + f"""
SELECT CAST(run_id AS BIGINT) AS run_id, CAST(it AS BIGINT) AS it, improved,
  printf('iter %5d', it) || ' | train ' || {fixed_sql('train_loss', 4)} || ' | val ' || {fixed_sql('val_loss', 4)}
  || ' | ' || {fixed_sql('secs', 1)} || 's' || CASE WHEN improved THEN '  *best' ELSE '' END AS line
FROM imp"""

# ----------------------------------------------------------------------------- C (BPE), A5
# The GPT-2 pre-tokenizer rewritten for RE2 (no lookahead): a \x01 is put
# before the last blank of a blank run that precedes a non-blank, so `\s+`
# stops there; \x01 is then never part of a piece.  RE2's \s is ASCII-only,
# which is enough for `documents`.
PRETOK = (r"regexp_extract_all(regexp_replace(t, '(\s+)(\s\S)', '\1' || chr(1) || '\2', 'g'), "
          r"'''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x01]+|\s+')")

PIECES_T = f"""pt AS (SELECT doc_id, {PRETOK} AS ps FROM (SELECT doc_id, text || chr(10) AS t FROM documents)),
pc AS (SELECT p AS piece, count(*) AS n FROM (SELECT unnest(ps) AS p FROM pt) GROUP BY p)"""

SQL["pretokenize"] = with_(PIECES_T) + """
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(i - 1 AS BIGINT) AS pos, p AS piece
FROM (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM pt)"""

SQL["piece_counts"] = with_(PIECES_T) + "SELECT piece, CAST(n AS BIGINT) AS n FROM pc"

SQL["pair_counts"] = with_(PIECES_T, """cs AS (SELECT string_split(piece, '') AS c, n FROM pc)""") + """
SELECT c[i] AS left, c[i + 1] AS right, CAST(sum(n) AS BIGINT) AS n
FROM (SELECT c, n, unnest(range(1, len(c))) AS i FROM cs) GROUP BY 1, 2"""

SQL["bpe_decode"] = "SELECT CAST(doc_id AS BIGINT) AS doc_id, text || chr(10) AS text FROM documents"

SQL["release_manifest"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS name, CAST(count(*) AS BIGINT) AS rows FROM {t}"
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split())

# ----------------------------------------------------------------------------- E5
# Loss history of the char bigram: training windows of every step counted per
# eval segment (step // interval); the model at eval e has the segments < e.
_NE = Q.MAX_ITERS // Q.EVAL_INTERVAL + 1


def _h60(split: str, it: str, row: str) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', {Q.SEED}, '{split}', {it}, {row})), 1, 15))::BIGINT AS BIGINT)"


SQL["loss_history"] = with_(SEQ, f"""tst AS (SELECT it.range AS it, {_h60('train', 'it.range', 'rw.range')} % (s.ntr - {Q.BLOCK_SIZE}) AS start
  FROM range({Q.MAX_ITERS}) it, range({Q.BATCH_SIZE}) rw, stats s),
tp AS (SELECT t.it // {Q.EVAL_INTERVAL} AS seg, q1.c AS c1, q2.c AS w
  FROM tst t, range({Q.BLOCK_SIZE}) k, seq q1, seq q2
  WHERE q1.gpos = t.start + k.range AND q2.gpos = t.start + k.range + 1),
segc AS (SELECT seg, c1, w, count(*) AS n FROM tp GROUP BY ALL),
segc1 AS (SELECT seg, c1, count(*) AS n FROM tp GROUP BY ALL),
segw AS (SELECT seg, w, count(*) AS n FROM tp GROUP BY ALL),
segt AS (SELECT seg, count(*) AS n FROM tp GROUP BY ALL),
est AS (
  SELECT 'train' AS split, it.range // {Q.EVAL_BATCHES} AS e, it.range % {Q.EVAL_BATCHES} AS b, 0 AS base,
         {_h60('eval-train', 'it.range', 'rw.range')} % (s.ntr - {Q.BLOCK_SIZE}) AS start
  FROM range({_NE * Q.EVAL_BATCHES}) it, range({Q.BATCH_SIZE}) rw, stats s
  UNION ALL
  SELECT 'val', it.range // {Q.EVAL_BATCHES}, it.range % {Q.EVAL_BATCHES}, s.ntr,
         {_h60('eval-val', 'it.range', 'rw.range')} % (s.n_all - s.ntr - {Q.BLOCK_SIZE})
  FROM range({_NE * Q.EVAL_BATCHES}) it, range({Q.BATCH_SIZE}) rw, stats s),
ep AS (SELECT t.split, t.e, t.b, q1.c AS c1, q2.c AS w
  FROM est t, range({Q.BLOCK_SIZE}) k, seq q1, seq q2
  WHERE q1.gpos = t.base + t.start + k.range AND q2.gpos = q1.gpos + 1),
keys AS (SELECT DISTINCT e, c1, w FROM ep),
n_cw AS (SELECT k.e, k.c1, k.w, sum(CASE WHEN x.seg < k.e THEN x.n ELSE 0 END) AS n
  FROM keys k LEFT JOIN segc x ON x.c1 = k.c1 AND x.w = k.w GROUP BY ALL),
n_c AS (SELECT k.e, k.c1, sum(CASE WHEN x.seg < k.e THEN x.n ELSE 0 END) AS n
  FROM (SELECT DISTINCT e, c1 FROM keys) k LEFT JOIN segc1 x ON x.c1 = k.c1 GROUP BY ALL),
n_w AS (SELECT k.e, k.w, sum(CASE WHEN x.seg < k.e THEN x.n ELSE 0 END) AS n
  FROM (SELECT DISTINCT e, w FROM keys) k LEFT JOIN segw x ON x.w = k.w GROUP BY ALL),
n_t AS (SELECT k.e, sum(CASE WHEN x.seg < k.e THEN x.n ELSE 0 END) AS n
  FROM (SELECT DISTINCT e FROM keys) k, segt x GROUP BY ALL),
pr AS (SELECT a.e, a.c1, a.w,
    (coalesce(a.n, 0) + (coalesce(w.n, 0) + 1.0 / s.v) / (coalesce(t.n, 0) + 1.0)) / (coalesce(c.n, 0) + 1.0) AS p
  FROM n_cw a JOIN n_c c ON c.e = a.e AND c.c1 = a.c1 JOIN n_w w ON w.e = a.e AND w.w = a.w
  LEFT JOIN n_t t ON t.e = a.e, stats s),
pb AS (SELECT ep.split, ep.e, ep.b, avg(-ln(pr.p)) AS l FROM ep JOIN pr ON pr.e = ep.e AND pr.c1 = ep.c1 AND pr.w = ep.w
  GROUP BY ALL),
pe AS (SELECT e, split, avg(l) AS l FROM pb GROUP BY ALL)""") + f"""
SELECT CAST(e * {Q.EVAL_INTERVAL} AS BIGINT) AS it,
  round(max(CASE WHEN split = 'train' THEN l END), 6) AS train_loss,
  round(max(CASE WHEN split = 'val' THEN l END), 6) AS val_loss
FROM pe GROUP BY e"""
