"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judicata.llm import (chat, embeddings, hard_negatives, katz, line_dedup, mixing, ngram_join, packing, repetition,
                          sharding, structure_repair, substring_dedup, toxicity)
from judicata.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql.strip()
        return fn
    return add


SPLIT_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(rf"""
WITH w AS (SELECT doc_id, {SPLIT_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM w WHERE len(ws) >= 20)),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, unnest(range(p, p + 20)) AS q FROM rep)),
ww AS (SELECT doc_id, q, ws[q] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS q FROM w)),
kept AS (SELECT ww.doc_id, count(g.q) AS n_removed, string_agg(word, ' ' ORDER BY ww.q) FILTER (g.q IS NULL) AS t
         FROM ww LEFT JOIN gone g ON ww.doc_id = g.doc_id AND ww.q = g.q GROUP BY ww.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole, cut = substring_dedup.substring_dedup(documents(spark, sf_dir, "doc_id", "text"))
    whole = whole.select(F.col("id").alias("doc_id"), "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
    return whole.unionByName(cut.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                                        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")))


@query(rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {SPLIT_WORDS} AS ws FROM documents),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w),
win AS (SELECT doc_id, p, k, array_to_string(ws[p:p + k - 1], ' ') AS s
        FROM g, (VALUES (5), (10), (51)) AS v(k) WHERE p + k - 1 <= len(ws)),
rep AS (SELECT doc_id, k, unnest(list(p)) AS p FROM win GROUP BY doc_id, k, s HAVING count(*) > 1),
cov AS (SELECT doc_id, k, count(DISTINCT q) AS n
        FROM (SELECT doc_id, k, unnest(range(p, p + k)) AS q FROM rep) GROUP BY 1, 2),
ln AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n
       FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1),
f AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      coalesce(ln.n, 0)::BIGINT AS n_dup_lines, coalesce(c5.n, 0)::BIGINT AS n_repeat_words,
      coalesce(c10.n, 0)::BIGINT AS n_covered, c51.n IS NOT NULL AS long_repeat
      FROM w LEFT JOIN ln USING (doc_id) LEFT JOIN (SELECT * FROM cov WHERE k = 5) c5 ON w.doc_id = c5.doc_id
      LEFT JOIN (SELECT * FROM cov WHERE k = 10) c10 ON w.doc_id = c10.doc_id
      LEFT JOIN (SELECT * FROM cov WHERE k = 51) c51 ON w.doc_id = c51.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND 100 * n_covered <= 10 * n_words AND NOT long_repeat AS kept
FROM f
""")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repetition.repetition_features(documents(spark, sf_dir, "doc_id", "text"))
    return repetition.quality_rules(rows).drop("longest_repeat")


NORMAL = (r"trim(regexp_replace(translate(regexp_replace(line, '^(?:[ \t]*>)+', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'))")
ATTRIBUTED = r"(?i)^.*\b(?:wrote|schrieb|écrit|escribió)[ \t]*:[ \t]*$"


@query(rf"""
WITH l AS (SELECT conv_id, turn, role, text IS NULL AS none, i, string_split(coalesce(text, ''), chr(10))[i] AS line,
           string_split(coalesce(text, ''), chr(10))[i + 1] AS nxt
           FROM (SELECT *, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM conversations)),
n AS (SELECT *, length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+', 0), '[^>]', '', 'g')) AS lvl, {NORMAL} AS unit,
      line ~ '^(?:[ \t]*>)+.*' AS q, coalesce(nxt ~ '^(?:[ \t]*>)+.*', false) AS qn,
      regexp_matches(line, '{ATTRIBUTED}') AS att FROM l),
r AS (SELECT *, CASE WHEN lvl > 0 THEN i - row_number() OVER (PARTITION BY conv_id, turn, lvl ORDER BY i) END AS run FROM n),
u AS (SELECT conv_id, turn, lvl, unit, 0 AS kind FROM n UNION ALL
      SELECT conv_id, turn, lvl, string_agg(unit, ' ' ORDER BY i), 1 FROM r WHERE unit <> '' GROUP BY conv_id, turn, lvl, run),
v AS (SELECT * FROM u WHERE length(unit) >= 8),
o AS (SELECT a.conv_id, a.turn, a.lvl, a.unit, a.kind, max(b.turn) AS orig FROM (SELECT * FROM v WHERE lvl > 0) a
      JOIN (SELECT DISTINCT conv_id, turn, unit, kind FROM v WHERE lvl = 0) b
      ON a.conv_id = b.conv_id AND a.unit = b.unit AND a.kind = b.kind AND b.turn < a.turn
      GROUP BY ALL),
w AS (SELECT a.conv_id, a.turn, a.lvl, o.orig, sum(length(a.unit)) AS chars FROM (SELECT * FROM v WHERE lvl > 0) a
      JOIN o USING (conv_id, turn, lvl, unit, kind) GROUP BY ALL),
p AS (SELECT conv_id, turn, arg_max(orig, row(-lvl, chars, orig)) AS parent_turn FROM w GROUP BY ALL),
t AS (SELECT conv_id, turn, role, none, bool_or(q) AS anyq, sum(q::INT)::BIGINT AS n_quoted,
      string_agg(line, chr(10) ORDER BY i) AS whole,
      coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT q AND NOT (att AND qn)), '') AS own
      FROM n GROUP BY conv_id, turn, role, none)
SELECT t.conv_id, t.turn, t.role,
       CASE WHEN NOT none THEN CASE WHEN anyq THEN trim(own, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))
            ELSE whole END END AS text,
       p.parent_turn, n_quoted,
       row_number() OVER (PARTITION BY t.conv_id ORDER BY coalesce(p.parent_turn, t.turn), t.turn) - 1 AS position
FROM t LEFT JOIN p USING (conv_id, turn)
""")
def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return chat.reply_ordered(messages.select("conv_id", "turn", "role", "text"))


@query(r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS g FROM
      (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS p FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id FROM w LEFT JOIN n USING (doc_id)
JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) m ON m.x = w.doc_id
""")
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.ngram_jaccard_join(documents(spark, sf_dir, "doc_id", "text"))
    return out.withColumnRenamed("id", "doc_id")


@query()
def op5_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return embeddings.near_duplicates(vectors.select("vec_id", "embedding", "label"))


@query(r"""
WITH l AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
           FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(documents(spark, sf_dir, "doc_id", "text"))
    text = F.coalesce("kept_text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    scored = toxicity.fit(docs, labels.select("doc_id", "toxic")).score(docs, ["doc_id"])
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query()
def op8_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir, "doc_id", "text"), [1.0] * 40)


@query()
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    docs = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    rows, sources = mixing.mix(docs, F.array("source"), F.col("words"))
    rows = rows.select("doc_id", "source", "size", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
    return (rows.join(F.broadcast(sources), rows["source"].eqNullSafe(sources["source"]))   # one row per source
            .select("doc_id", "size", "source_size", "target", "taken"))


@query()
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir, "doc_id", "text"))


def _state(of: str, cost: str, edit: str, turn: str | None = None) -> str:
    """SQL of a state of the repair's recursion: cost, edits and turns so far."""
    turns = f"list_append({of}.t, {turn})" if turn else f"{of}.t"
    return f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{edit}', 't': {turns}}}"


def _least(*states: str) -> str:
    return f"list_sort([{', '.join(states)}])[1]"


def _closing(states: str) -> str:
    """Insertions before the next turn."""
    user = _least("u", *[_state(x, "3", "I", "'user:'") for x in ("z", "s", "a")])
    return (f"SELECT conv_id, i, z, s, u, {_least('a', _state('u', '3', 'I', chr(39) + 'assistant:' + chr(39)))} AS a "
            f"FROM (SELECT conv_id, i, z, s, {user} AS u, a FROM ({states}))")


_FAR = "{'c': 1000000, 'a': '', 't': []::VARCHAR[]}"
_KEEP, _REROLE = "role || ':' || text", "':' || text"
_STEP = ", ".join([
    _state("z", "4", "D") + " AS z",
    _least(_state("s", "4", "D"), f"CASE WHEN NOT gone AND ini = 's' THEN {_state('z', 'more', 'K', _KEEP)} ELSE {_FAR} END") + " AS s",
    _least(_state("u", "4", "D"), *[f"CASE WHEN gone THEN {_FAR} WHEN ini = 'u' THEN {_state(x, 'more', 'K', _KEEP)} "
                                    f"ELSE {_state(x, '3 + more', 'R', chr(39) + 'user' + chr(39) + ' || ' + _REROLE)} END"
                                    for x in ("z", "s", "a")]) + " AS u",
    _least(_state("a", "4", "D"), f"CASE WHEN gone THEN {_FAR} WHEN ini = 'a' THEN {_state('u', 'more', 'K', _KEEP)} "
                                  f"ELSE {_state('u', '3 + more', 'R', chr(39) + 'assistant' + chr(39) + ' || ' + _REROLE)} END") + " AS a"])


@query(rf"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS tb),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' ||
          coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT)),
          lambda x, y: xor(x >> 8, tb[(xor(x, y) & 255) + 1])), 4294967295) % 20 AS act FROM conversations, tab),
d AS (SELECT conv_id, turn, CASE act WHEN 4 THEN 'user' ELSE role END AS role,
      CASE act WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(CASE act WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM h),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, coalesce(nullif(left(role, 1), ''), ' ') AS ini, NOT regexp_matches(text, '[^ 	-
]') AS blank,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
      NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut FROM n),
r AS (SELECT *, blank OR again AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS more,
      coalesce(lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS odd FROM f),
m AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, sum(blank::INT)::BIGINT AS blank,
      sum((again AND NOT blank)::INT)::BIGINT AS duplicate, sum((cut AND NOT gone)::INT)::BIGINT AS truncated,
      sum(odd::INT)::BIGINT AS illegal, count(*) AS n FROM r GROUP BY conv_id),
dp AS (
  {_closing(f"SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS z, {_FAR} AS s, {_FAR} AS u, {_FAR} AS a FROM conversations")}
  UNION ALL
  {_closing(f"SELECT conv_id, i, {_STEP} FROM (SELECT dp.conv_id, r.i, z, s, u, a, role, text, ini, gone, more FROM dp JOIN r ON dp.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = dp.i + 1)")}
),
e AS (SELECT conv_id, {_least('z', 'a')} AS best FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.a AS audit,
       sha256(array_to_string(best.t, chr(10))) AS repaired_sha256
FROM e LEFT JOIN m ON e.conv_id IS NOT DISTINCT FROM m.conv_id
""")
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return structure_repair.summary(structure_repair.repair(damaged(rows))).withColumnRenamed("conv", "conv_id")


def damaged(rows: DataFrame) -> DataFrame:
    """The turns that op11 repairs: (conv, turn, role, text, n), damaged by the checksum of conversation and turn."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    act = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    empty = F.lit("")
    return rows.select(
        F.col("conv_id").alias("conv"), F.when(act != 0, F.col("turn")).alias("turn"),
        F.when(act == 0, empty).when(act == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(act.isin(0, 1), empty).when(act == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(act == 0, 0).when(act == 3, 2).otherwise(1).alias("n"))


def _discounts(counts: str) -> str:
    """SQL of the Good-Turing ratios from a list of counts of counts: of the most counts for which they are usable."""
    ratios = "list_transform(range(1, m + 1), lambda r: ((r + 1) * n[r + 1] / (r * n[r]) - (m + 1) * n[m + 1] / n[1]) / (1 - (m + 1) * n[m + 1] / n[1]))"
    return (f"(SELECT arg_max(ds, m) FROM (SELECT m, {ratios} AS ds FROM (SELECT unnest(range(1, 6)) AS m, n FROM ({counts})) "
            "WHERE list_min(n[1:m + 1]) > 0 AND (m + 1) * n[m + 1] <> n[1]) WHERE list_min(ds) > 0 AND list_max(ds) < 1)")


def _counts(table: str) -> str:
    return f"SELECT [{', '.join(f'count(*) FILTER (c = {r})::DOUBLE' for r in range(1, 7))}] AS n FROM {table}"


_D = "CASE WHEN {0} IS NULL THEN (c - 0.5) / c WHEN c <= len({0}) THEN {0}[c] ELSE 1 END"


@query(rf"""
WITH tab AS (SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS tb),
docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
             lambda x, y: xor(x >> 8, tb[(xor(x, y) & 255) + 1])), 4294967295) % 7 = 2, false) AS held_out,
         list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+'), ' ') AS ws FROM documents, tab),
t AS (SELECT k, held_out, unnest(ws) AS w, unnest(list_prepend(' ', ws[:-2])) AS h FROM docs),
u AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
b AS (SELECT h, w, count(*) AS c FROM t WHERE NOT held_out GROUP BY h, w),
ds AS (SELECT {_discounts(_counts("u"))} AS d1, {_discounts(_counts("b"))} AS d2),
ud AS (SELECT w, c, {_D.format("d1")} AS d FROM u, ds),
un AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v, coalesce(sum((1 - d) * c), 0) AS l FROM ud),
up AS (SELECT w, c, d * c / (n + (l = 0)::INT) AS p FROM ud, un),
bd AS (SELECT h, w, c, {_D.format("d2")} AS d FROM b, ds),
bh AS (SELECT h, sum(bd.c) AS n, sum((1 - d) * bd.c) AS l, sum(p) AS s FROM bd JOIN up USING (w) GROUP BY h),
x AS (SELECT k, u.c AS c, un.n AS n, un.v AS v,
      log10(CASE WHEN bd.c > 0 THEN bd.d * bd.c / (bh.n + (bh.l = 0)::INT)
                 ELSE coalesce((bh.l + (bh.l = 0)::INT) / (bh.n + (bh.l = 0)::INT) / (1 - bh.s), 1)
                      * coalesce(up.p, (un.l + (un.l = 0)::INT) / (un.n + (un.l = 0)::INT)) END) AS lp
      FROM t CROSS JOIN un LEFT JOIN u ON t.w = u.w LEFT JOIN up ON t.w = up.w
      LEFT JOIN bd ON t.h = bd.h AND t.w = bd.w LEFT JOIN bh ON t.h = bh.h),
y AS (SELECT k, count(*) AS n_tokens, count(c) AS n_known, any_value(n)::BIGINT AS train_tokens,
      sum(log10((coalesce(c, 0) + 1) / (n + v + 1))) AS base_score, sum(lp) AS score FROM x GROUP BY k)
SELECT doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score FROM y JOIN docs USING (k)
""")
def op12_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model = katz.fit(documents(spark, sf_dir, "doc_id", "text"), held)
    return model.score().select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known",
                                F.lit(model.levels[0].total).cast("long").alias("train_tokens"), "base_score", "score")


@query(r"""
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS a, b.id AS b, a.lab = b.lab AS same, list_inner_product(a.e, b.e)::BIGINT AS score
      FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b)::INT AS rank,
       n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.a = n.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) <= 5
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)
