"""One query per corpus operator, over its whole table, and its SQL text."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import license_scan as licenses
from loanlens.llm import quality_rules as rules
from loanlens.llm import periodic_runs as periodic
from loanlens.llm import secret_scan as secrets
from loanlens.llm import sentencepiece_codec, simhash, warc
from loanlens.llm import spelling_variants as variants
from loanlens.llm.chunk_dedup import chunk_dedup
from loanlens.llm.common import table
from loanlens.llm.decontamination import benchmark_hits, n_hit
from loanlens.llm.line_dedup import MIN_SITES, line_dedup
from loanlens.llm.lm_scoring import ADDED, WEIGHT, lm_scores
from loanlens.llm.quality_rules import quality_rules
from loanlens.llm.suffix_dedup import suffix_dedup
from loanlens.session import use_recommended

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL_TEXTS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = lambda spark, sf_dir: f(use_recommended(spark), sf_dir)
        if sql is not None:
            SQL_TEXTS[name] = sql
        return f

    return register


def _op2_sql(rounds: int = 100) -> str:
    """Measures, votes and the estimation as a recursive query over the vote patterns."""
    blank, word = "[\\x20\\x09-\\x0D]", "[^\\x20\\x09-\\x0D]"
    stop = ", ".join(f"'{w}'" for w in sorted(set(rules.STOP_WORDS)))
    numbers = range(len(rules.RULES))
    v = ", ".join(f"v{j}" for j in numbers)
    votes = ", ".join(
        f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS v{j}" for j, r in enumerate(rules.RULES)
    )

    def within(x: str, low: str, high: str) -> str:
        return f"least(greatest({x}, {low}), {high})"

    least, most = f"{rules.LEAST:e}", f"{1 - rules.LEAST:.3e}"
    sums = ", ".join(
        f"sum(n * q) FILTER (WHERE v{j} > 0) OVER () AS p{j}, sum(n * q) FILTER (WHERE v{j} <> 0) OVER () AS a{j},"
        f" sum(n * (1 - q)) FILTER (WHERE v{j} > 0) OVER () AS r{j}, sum(n * (1 - q)) FILTER (WHERE v{j} <> 0) OVER () AS c{j}"
        for j in numbers
    )
    good = ", ".join(within(f"(1 + coalesce(p{j}, 0)) / (2 + coalesce(a{j}, 0))", least, most) + f" AS g{j}" for j in numbers)
    bad = ", ".join(within(f"(1 + coalesce(r{j}, 0)) / (2 + coalesce(c{j}, 0))", least, f"g{j}") + f" AS b{j}" for j in numbers)
    odds = "ln(s / (1 - s))" + "".join(
        f" + CASE WHEN v{j} > 0 THEN ln(g{j} / b{j}) WHEN v{j} < 0 THEN ln((1 - g{j}) / (1 - b{j})) ELSE 0 END" for j in numbers
    )
    n_bad = " + ".join(f"CAST(v{j} < 0 AS INTEGER)" for j in numbers)
    n_good = " + ".join(f"CAST(v{j} > 0 AS INTEGER)" for j in numbers)
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{word}+') AS ws FROM documents),
tokens AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
windows AS (
  SELECT id, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS t FROM tokens
  WINDOW o AS (PARTITION BY id ORDER BY i)),
twice AS (SELECT id, t FROM windows WHERE t IS NOT NULL GROUP BY id, t HAVING count(*) > 1),
repeated AS (
  SELECT id, count(DISTINCT p) AS n FROM (
    SELECT id, unnest([i, i + 1, i + 2]) AS p FROM windows JOIN twice USING (id, t)) GROUP BY id),
texts AS (
  SELECT d.*, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls FROM d),
m AS (
  SELECT id, doc_id, len(ws) AS n_words, length(regexp_replace(text, '{blank}', '', 'g')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[0-9]')) AS n_digits,
    len(list_filter([{stop}], lambda x: list_contains(ws, x))) AS n_stop_words
  FROM texts LEFT JOIN repeated r USING (id)),
voted AS (SELECT m.*, {votes} FROM m),
em AS (
  SELECT 0 AS round, {v}, n, 1 / (1 + exp(-2e0 * (1.5e0 - ({n_bad}) * 1.5e0 + 0.25e0 * ({n_good})))) AS q
  FROM (SELECT {v}, count(*) AS n FROM voted GROUP BY {v})
  UNION ALL
  SELECT round + 1, {v}, n, 1 / (1 + exp(-({odds}))) FROM (
    SELECT *, {bad} FROM (
      SELECT *, {within("sum(n * q) OVER () / sum(n) OVER ()", least, most)} AS s, {good}
      FROM (SELECT *, {sums} FROM em WHERE round < {rounds}))))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND q >= 0.5 AS kept,
  round(q, 6) + 0.0 AS quality
FROM voted JOIN (SELECT * FROM em WHERE round = {rounds}) USING ({v})
"""


@query("op2_quality_rules", _op2_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    judged = quality_rules(docs, keep=["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "row.doc_id", *[f"m.{c}" for c in counts], "base_failed", "kept", F.round("quality", 6).alias("quality")
    )


OP4_SQL = f"""
WITH parts AS (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
all_lines AS (SELECT doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM parts),
spread AS (
  SELECT line, min(row(doc_id, pos)) AS place FROM all_lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (
  SELECT a.*, s.line IS NOT NULL AND row(a.doc_id, a.pos) <> s.place AS gone
  FROM all_lines a LEFT JOIN spread s ON a.line = s.line)
SELECT d.doc_id, coalesce(k.n, 0) AS n_lines, coalesce(k.gone, 0) AS n_removed,
  length(coalesce(k.kept, '')) AS kept_chars, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS gone,
    string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS kept
  FROM marked GROUP BY doc_id) k ON d.doc_id = k.doc_id
"""


@query("op4_line_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    clean = F.coalesce("clean", F.lit(""))
    return line_dedup(docs).select(
        "row.doc_id",
        "n_lines",
        "n_removed",
        F.length(clean).cast("long").alias("kept_chars"),
        F.sha2(clean.cast("binary"), 256).alias("kept_sha256"),
    )


def _op5_sql() -> str:
    """The brute force of op 5: of two near templates the one goes that differs from the block in more words."""
    near, said = [], []
    numbered = licenses.near_templates(licenses.TEMPLATES, licenses.THRESHOLD)
    sets = [sorted(set(licenses.words_of(text))) for _, text, _ in numbered]
    for number, (_, text, others) in enumerate(numbered):
        said.append(f"({number}, ' {' '.join(licenses.words_of(text))} ')")
        for mine, theirs, every, _ in others:
            other = sets.index(every)
            near += [f"({number}, {other}, '{w}', {side})" for side, ws in ((1, mine), (-1, theirs)) for w in ws]
    found = "found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(part) AS best FROM hits GROUP BY doc_id)"
    sql = _op5_matches_sql()
    assert found in sql
    return sql.replace(
        found,
        f"""near(tid, other, w, side) AS (VALUES {", ".join(near)}),
said(tid, ws) AS (VALUES {", ".join(said)}),
worse AS (
  SELECT DISTINCT doc_id, number, tid FROM (
    SELECT h.doc_id, h.number, h.tid FROM hits h JOIN near n ON n.tid = h.tid
    JOIN hits u ON u.doc_id = h.doc_id AND u.number = h.number AND u.tid = n.other
    LEFT JOIN block_words x ON x.doc_id = h.doc_id AND x.number = h.number AND x.w = n.w
    GROUP BY h.doc_id, h.number, h.tid, n.other HAVING sum(CASE WHEN x.w IS NULL THEN side ELSE -side END) > 0)),
verbatim AS (
  SELECT DISTINCT h.doc_id, h.number, h.tid FROM hits h JOIN said USING (tid)
  JOIN blocks b ON b.doc_id = h.doc_id AND b.number = h.number
  WHERE contains(' ' || array_to_string(regexp_extract_all(
    translate(bs[b.number], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), ' ') || ' ', ws)),
left_over AS (
  SELECT hits.* FROM hits ANTI JOIN (SELECT * FROM worse EXCEPT SELECT * FROM verbatim) USING (doc_id, number, tid)),
{found.replace("FROM hits", "FROM left_over")}""",
    )


def _op5_matches_sql() -> str:
    """Brute force: all words of all blocks against all words of all templates."""
    number, rows = 0, []
    for label, texts in sorted(licenses.TEMPLATES.items()):
        for text in texts:
            words = sorted(set(licenses.words_of(text)))
            need = licenses.needed_words(len(words), licenses.THRESHOLD)
            rows += [f"({number}, '{label}', {len(words)}, {need}, '{w}')" for w in words]
            number += 1
    word, lower = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", "translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    phrase_rows = ", ".join(
        "({}, '{}', {})".format(i, label, str(phrase.split(" ")))
        for i, (phrase, label) in enumerate(licenses.PHRASES.items())
    )
    return f"""
WITH t(tid, label, size, need, w) AS (VALUES {", ".join(rows)}),
p(pid, label, ws) AS (VALUES {phrase_rows}),
d AS (SELECT doc_id, regexp_extract_all({lower.replace("x,", "coalesce(text, ''),")}, '{word}') AS ws, coalesce(text, '') AS text FROM documents),
tokens AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM d),
places AS (
  SELECT DISTINCT d.doc_id, tokens.pos - 1 AS start, p.label
  FROM tokens JOIN p ON tokens.w = p.ws[1] JOIN d ON d.doc_id = tokens.doc_id
  WHERE list_slice(d.ws, tokens.pos, tokens.pos + len(p.ws) - 1) = p.ws),
base AS (
  SELECT doc_id, count(*) AS n, min(start) AS a, max(start) AS b, list(DISTINCT label) AS labels
  FROM places GROUP BY doc_id),
blocks AS (SELECT doc_id, bs, generate_subscripts(bs, 1) AS number FROM (SELECT doc_id, regexp_split_to_array(text, '\\n[ \\t\\r]*\\n') AS bs FROM d)),
block_words AS (
  SELECT DISTINCT doc_id, number, unnest(regexp_extract_all({lower.replace("x,", "bs[number],")}, '{word}')) AS w FROM blocks),
hits AS (
  SELECT doc_id, number, tid, t.label, count(*) / any_value(size) AS part
  FROM block_words JOIN t ON block_words.w = t.w
  GROUP BY doc_id, number, tid, t.label HAVING count(*) >= any_value(need)),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(part) AS best FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(base.n, 0) AS n_base, base.a AS first_word, base.b AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, found.labels))), ','), '') AS labels,
  CASE WHEN base.n > 0 THEN 1e0 ELSE coalesce(best, 0e0) END AS score
FROM d LEFT JOIN base ON d.doc_id = base.doc_id LEFT JOIN found ON d.doc_id = found.doc_id
"""


@query("op5_license_scan", _op5_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    codes = F.array_join(F.col("coded.ids").cast("array<string>"), " ")
    return sentencepiece_codec.encode(docs, keep=["doc_id"]).select(
        "row.doc_id",
        "coded.n_tokens",
        "coded.n_byte_tokens",
        F.sha2(codes.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("coded.decoded").cast("binary"), 256).alias("decoded_sha256"),
        "coded.round_trip",
    )


OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
tokens AS (SELECT id, doc_id, unnest(ws) AS b, generate_subscripts(ws, 1) AS i FROM d),
size AS (SELECT {ADDED:e} * (1 + count(DISTINCT b)) AS added FROM tokens),
pairs AS (
  SELECT id, coalesce(lag(b) OVER (PARTITION BY id ORDER BY i), '') AS a, b,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0) AS is_target FROM tokens),
cells AS (SELECT a, b, count(*) FILTER (WHERE is_target) AS t, count(*) AS g FROM pairs GROUP BY a, b),
sums AS (
  SELECT *, sum(t) OVER (PARTITION BY a) AS ta, sum(g) OVER (PARTITION BY a) AS ga, sum(t) OVER (PARTITION BY b) AS tb,
    sum(g) OVER (PARTITION BY b) AS gb, sum(t) OVER () AS tn, sum(g) OVER () AS gn FROM cells),
shares AS (
  SELECT *, (tb + {ADDED:e}) / (tn + added) AS tu, (gb * CAST(tn AS DOUBLE) / gn + {ADDED:e}) / (tn + added) AS gu
  FROM sums, size),
losses AS (
  SELECT a, b, CASE WHEN tn = 0 THEN 0e0 ELSE
    ln(CASE WHEN ta > 0 THEN {WEIGHT:e} * t / ta + {1 - WEIGHT:e} * tu ELSE tu END)
      - ln({WEIGHT:e} * g / ga + {1 - WEIGHT:e} * gu) END AS x FROM shares),
scored AS (SELECT id, count(*) AS n, avg(x) AS score FROM pairs JOIN losses USING (a, b) GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_tokens, round(coalesce(score, 0e0), 6) + 0.0 AS score
FROM d LEFT JOIN scored USING (id)
"""


@query("op3_lm_scoring", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what people labelled as good and not toxic."""
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 and toxic = 0")
    scored = lm_scores(table(spark, sf_dir, "documents", "doc_id", "text"), good)
    return scored.select("row.doc_id", "n_tokens", F.round("score", 6).alias("score"))


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def _base32_sql(digest: str) -> str:
    """Base32 of 40 hex digits: every 5 of them are 4 letters."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    part = f"CAST('0x' || substr({digest}, 5 * (i // 4) + 1, 5) AS INTEGER)"
    return (
        "array_to_string(list_transform(range(32), lambda i: "
        f"substr({letters}, 1 + ({part} >> (15 - 5 * (i % 4))) % 32, 1)), '')"
    )


OP7_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, payload_bytes, {_base32_sql("h")} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (h)
"""


@query("op7_warc_archives", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return warc.round_trip(pages, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _cut_texts(cut: DataFrame) -> DataFrame:
    """Digest columns of what is left of each document."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + F.get(s, 1) - F.get(s, 0))
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("clean", 256).alias("kept_sha256"),
    )


@query("op8_chunk_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return _cut_texts(chunk_dedup(docs))


OP9_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS w FROM (
    SELECT item_id, ws, least(10, len(ws)) AS size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
    FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (
  SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d JOIN sizes ON len(ws) >= size),
found AS (
  SELECT doc_id, i, s.size, item_id FROM starts s
  JOIN windows w ON s.size = w.size AND array_to_string(list_slice(s.ws, i, i + s.size - 1), ' ') = w.w),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
"""


@query("op9_decontamination", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return benchmark_hits(docs, items, keep=["doc_id"]).select(
        "row.doc_id",
        "hits.n_words",
        n_hit().alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit() > 0).alias("contaminated"),
    )


OP10_SQL = """
WITH d AS (SELECT row_number() OVER () AS id, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT id, doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT *, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
hit AS (SELECT id, i FROM w JOIN f USING (s) WHERE first < doc_id),
runs AS (
  SELECT id, i, sum(new) OVER (PARTITION BY id ORDER BY i) AS run FROM (
    SELECT id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM hit)),
spans AS (SELECT id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY id, run),
parts AS (SELECT id, a, b, coalesce(lag(b) OVER (PARTITION BY id ORDER BY a), 0) AS since FROM spans),
kept AS (
  SELECT id, sum(b - a) AS n, count(*) AS spans, max(b) AS last,
    string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS before
  FROM parts JOIN d USING (id) GROUP BY id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (id)
"""


@query("op10_suffix_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut_texts(suffix_dedup(table(spark, sf_dir, "documents", "doc_id", "text")))


def _op11_sql() -> str:
    """All matches of each pattern with running sums of the lengths between them, and owners by value."""
    found = "\n  UNION ALL ".join(
        f"SELECT id, {k} AS k, string_split_regex(text, $p{k}$) AS gaps, regexp_extract_all(text, $p{k}$, 0) AS ms,"
        f" regexp_extract_all(text, $p{k}$, {group}) AS vs FROM d WHERE regexp_matches(text, $p{k}$)"
        for k, (_, _, group, _) in enumerate([*secrets.BASE, ("", "", 0, 0)])
    )
    for k, pattern in enumerate([*[p for _, p, _, _ in secrets.BASE], secrets.ADDED_PATTERN]):
        found = found.replace(f"$p{k}$", "'" + pattern.replace("'", "''") + "'")
    added, base = len(secrets.BASE), secrets._BASE_TAKEN.replace("'", "''")
    kinds = "".join(
        f" WHEN regexp_full_match(m, '{p}')"
        + (" AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')" if name == "opaque" else "")
        + f" THEN {k}"
        for k, (name, p) in enumerate(secrets.ADDED, added)
    )
    least = "".join(f" WHEN k = {k} THEN CASE WHEN length(v) >= {n} THEN {k} END" for k, (_, _, _, n) in enumerate(secrets.BASE))
    names = str(secrets.KINDS)
    counts = ", ".join(
        f"count(*) FILTER (WHERE kind = {k}) AS n_{name}" for k, (name, *_) in enumerate(secrets.BASE)
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS text FROM documents),
found AS (
  {found}),
parts AS (SELECT id, k, unnest(gaps) AS g, unnest(ms) AS m, unnest(vs) AS v, generate_subscripts(gaps, 1) AS i FROM found),
placed AS (
  SELECT *, sum(length(g) + coalesce(length(m), 0)) OVER (PARTITION BY id, k ORDER BY i) AS stop FROM parts),
spans AS (
  SELECT id, CAST(stop - length(m) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, v,
    CASE{least} WHEN regexp_full_match(m, '{base}') OR len(list_distinct(string_split(m, ''))) < {secrets.MIN_DISTINCT} THEN NULL{kinds} END AS kind
  FROM placed WHERE m IS NOT NULL),
owned AS (
  SELECT v, count(DISTINCT source) AS owners, count(DISTINCT row(source, doc_id)) AS repositories
  FROM spans JOIN d USING (id) WHERE kind IS NOT NULL GROUP BY v),
told AS (
  SELECT id, start, kind, ({names})[kind + 1] || ':' || start || ':' || stop AS span,
    owners >= {secrets.MIN_OWNERS} AND repositories >= {secrets.MIN_REPOSITORIES} AS copied
  FROM spans JOIN owned USING (v) WHERE kind IS NOT NULL),
summed AS (
  SELECT id, {counts}, string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < {added}) AS base,
    string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < {added} OR NOT copied) AS spans,
    count(*) FILTER (WHERE copied) AS n_copied
  FROM told GROUP BY id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN summed USING (id)
"""


@query("op11_secret_scan", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a repository of its source."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")

    def those(chosen) -> Column:
        return F.filter("secrets", chosen)

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def n_of(kind: str) -> Column:
        return F.size(those(lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = [k for k, *_ in secrets.BASE]

    return secrets.secret_scan(docs, keep=["doc_id"]).select(
        "row.doc_id",
        *[n_of(k) for k in base],
        F.sha2(listed(those(lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        listed(those(lambda s: s["reported"])).alias("spans"),
        F.size(those(lambda s: s["copied"])).cast("long").alias("n_copied"),
    )


def _crc_sql(text: str) -> str:
    """CRC-32 of a text in UTF-8; the table is worked out by rule."""
    steps = [zlib.crc32(bytes([b])) ^ 0xFFFFFFFF ^ (zlib.crc32(bytes([0])) ^ 0xFFFFFFFF) for b in range(256)]
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * j + 1, 2) AS BIGINT)"
    every = f"list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(strlen({text})), lambda j: {byte}))"
    return f"xor(4294967295, list_reduce({every}, lambda c, b: xor(c >> 8, ({steps})[1 + (xor(c, b) & 255)])))"


OP12_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    {_crc_sql("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
a AS (SELECT id, doc_id, ws, h, len(ws) AS n, h // 10 AS g, (h // 10) % greatest(len(ws), 1) AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
w AS (
  SELECT id, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws FROM p),
grams AS (
  SELECT id, i, array_to_string(list_slice(ws, i + 1, i + 16), ' ') AS s
  FROM (SELECT id, ws, unnest(range(n - 15)) AS i FROM w WHERE n >= 24)),
pairs AS (SELECT x.id, x.i - y.i AS q, x.i FROM grams x JOIN grams y ON x.id = y.id AND x.s = y.s AND y.i < x.i),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS island FROM pairs),
long AS (
  SELECT id, min(i) - q AS start, max(i) + 16 - min(i) + q AS length, q FROM islands GROUP BY id, q, island
  HAVING max(i) + 16 - min(i) + q >= greatest(24, 3 * q)),
runs AS (
  SELECT * FROM long x WHERE NOT EXISTS (
    SELECT 1 FROM long y WHERE y.id = x.id AND y.q < x.q AND y.start <= x.start AND y.start + y.length >= x.start + x.length)),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY id ORDER BY length / q DESC, start, q) = 1),
summed AS (
  SELECT id, count(*) AS n, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS runs
  FROM runs GROUP BY id),
dropped AS (SELECT DISTINCT id, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (
  SELECT id, string_agg(word, ' ' ORDER BY i) AS rest
  FROM (SELECT id, unnest(ws) AS word, unnest(range(n)) AS i FROM w) ANTI JOIN dropped USING (id, i) GROUP BY id)
SELECT w.doc_id, coalesce(summed.n, 0) AS n_runs, best.start, best.length, best.q AS period,
  1000 * best.length // best.q AS exponent_milli, sha256(coalesce(summed.runs, '')) AS runs_sha256,
  sha256(coalesce(kept.rest, '')) AS collapsed_sha256
FROM w LEFT JOIN summed USING (id) LEFT JOIN best USING (id) LEFT JOIN kept USING (id)
"""


@query("op12_periodic_runs", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    docs = docs.withColumn("text", periodic.repeat_tail(F.col("text"), F.col("doc_id")))
    found = periodic.periodic_runs(docs, keep=["doc_id"])
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), periodic.strongest(F.col("runs")).alias("best"), line.alias("line"), "collapsed"
    ).select(
        "doc_id",
        "n_runs",
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join("line", "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# Near words share a word with one letter missing, or with one letter blotted out at one place.
OP13_SQL = f"""
WITH RECURSIVE each AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id || ':' || run AS name, run, length(run) AS size, count(*) AS n FROM each GROUP BY doc_id, run),
hashed AS (SELECT run, size, n, {_crc_sql("name")} AS h FROM counted),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= {variants.MIN_LETTERS} GROUP BY word HAVING sum(n) >= {variants.MIN_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
blots AS (SELECT word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS b FROM places),
shorter AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS s FROM places),
near AS (
  SELECT x.word, y.word AS other, y.n FROM blots x JOIN blots y ON x.b = y.b AND x.i = y.i AND x.word <> y.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.s = w.word
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.s = w.word),
best AS (
  SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= {variants.TIMES} * w.n THEN other END AS form,
    CASE WHEN b.n >= {variants.TIMES} * w.n THEN b.n END AS form_n FROM words w LEFT JOIN best b USING (word)),
walk AS (
  SELECT word, word AS here, 0 AS steps FROM formed
  UNION ALL SELECT walk.word, formed.form, steps + 1 FROM walk JOIN formed ON walk.here = formed.word WHERE formed.form IS NOT NULL)
SELECT word, form, arg_max(here, steps) AS root, n, n_near, form_n
FROM formed JOIN walk USING (word) GROUP BY ALL
"""


@query("op13_spelling_variants", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    words = variants.counted_words(docs, change=variants.drop_letters)
    return variants.spelling_variants(variants.frequent_words(words))
