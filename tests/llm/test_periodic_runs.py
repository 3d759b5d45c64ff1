import random
import zlib

import pytest
from pyspark.sql import functions as F

from loanlens.llm import periodic_runs as P


def smallest_period(words):
    for q in range(1, len(words) + 1):
        if all(words[i] == words[i - q] for i in range(q, len(words))):
            return q
    return 0


def brute(words):
    """All lags, all stretches that keep them, the smallest period worked out from the words."""
    found = set()
    for q in range(1, len(words) // 3 + 1):
        i = q
        while i < len(words):
            start = i - q
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - start >= max(24, 3 * q) and smallest_period(words[start:i]) == q:
                found.add((start, i - start, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def rest(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(seed):
    """Nested and adjoining repetitions of small blocks, with errors in some."""
    rng = random.Random(seed)
    words = []
    while len(words) < 250:
        block = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 9, 17, 20]))]
        if rng.random() < 0.3:
            block = block * rng.randrange(2, 12) + [rng.choice("xyz")]
        words += block * rng.randrange(1, 9) + block[: rng.randrange(len(block) + 1)]
        if rng.random() < 0.3:
            words.append(rng.choice("abcxyz"))
    return words


@pytest.mark.parametrize("seeds", [range(0, 40), range(40, 80)])
def test_equals_brute_force_on_repetitive_words(seeds):
    texts = [repetitive(s) for s in seeds]
    got = P.runs_of([[w.encode() for w in ws] for ws in texts])
    assert sum(map(len, got)) > 100
    for ws, runs in zip(texts, got):
        assert runs == brute(ws)


@pytest.mark.parametrize("q", [1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 100])
def test_bounds_of_length_and_periods(q):
    rng = random.Random(q)
    block = [f"w{i}" for i in range(q)]
    least = max(24, 3 * q)
    for length, n in ((least - 1, 0), (least, 1), (least + 1, 1)):
        run = [block[i % q].encode() for i in range(length)]
        before, after = ([f"{side}{i}{rng.random()}".encode() for i in range(9)] for side in "lr")
        assert P.runs_of([[*before, *run, *after]]) == [[(9, length, q)] * n]


def test_a_common_word_and_a_constant_text_visit_few_occurrences():
    import numpy as np

    n = 60_000
    constant = np.zeros(n, np.int64)
    assert sum(map(len, P.occurrences(constant, constant))) <= 3 * n
    spaced = np.arange(n) * (np.arange(n) % 2)  # every other word is the same one
    assert len(P.occurrences(spaced, constant)[0]) == 0
    lines = np.arange(n)
    lines[np.arange(n) % 40 < 39] = -1 - (np.arange(n) % 40)[np.arange(n) % 40 < 39]  # lines that differ in one word
    assert len(P.occurrences(lines - lines.min(), constant)[0]) <= 16 * n


def test_documents_do_not_share_occurrences(docs_of):
    block = " ".join(f"w{i}" for i in range(12))
    got = P.periodic_runs(docs_of([(i, block) for i in range(9)])).select("runs").collect()
    assert all(r.runs == [] for r in got)


def planted(doc_id, text):
    words = [w for w in (text or "").split(" ") if w]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_equals_brute_force(spark, docs_of, prose):
    rows = [(i, prose(i, 30 + 7 * i % 300).replace("\n", " ")) for i in range(120)]
    docs = docs_of(rows).withColumn("text", P.repeat_tail(F.col("text"), F.col("doc_id")))
    got = P.periodic_runs(docs).select("row.doc_id", "n_words", "runs", "collapsed", P.strongest(F.col("runs")).alias("best")).collect()
    assert sum(bool(r.runs) for r in got) > 5
    texts = dict(rows)
    for r in got:
        words = planted(r.doc_id, texts[r.doc_id])
        runs = brute(words)
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(words)
        assert r.collapsed == rest(words, runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (r.best and tuple(r.best)) == best


def test_awkward_rows(docs_of, awkward):
    docs = docs_of(awkward)
    changed = docs.withColumn("text", P.repeat_tail(F.col("text"), F.col("doc_id")))
    for some in (docs, changed):
        got = P.periodic_runs(some)
        assert got.select("row.*").columns == docs.columns
        rows = {(r.doc_id, r.text): r for r in got.select("row.doc_id", "row.text", "n_words", "runs", "collapsed").collect()}
        assert got.count() == len(awkward)
        assert rows[None, None].runs == [] and rows[None, None].collapsed == "" and rows[3, None].n_words == 0
    long = next(r for (k, _), r in rows.items() if k == 10)
    assert [tuple(x) for x in long.runs] == [(0, 40_000, 1)] and long.collapsed == "x"


def test_empty_table(docs_of):
    assert P.periodic_runs(docs_of([])).count() == 0
