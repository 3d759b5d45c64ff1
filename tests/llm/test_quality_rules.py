import random
import re
from collections import Counter

import pytest

from loanlens.llm import quality_rules as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_measures_equal_brute_force(docs_of, awkward):
    more = [(100, "a b c a b c a b"), (101, "a a a a"), (102, "x|y\nx|y\n\n\nx|y "), (103, "a b\nc d\na b"), (104, "a b c d a b")]
    docs = docs_of(awkward + more)
    got = Q.quality_rules(docs, keep=["doc_id", "text"]).select("row.*", "m.*", "base_failed", "kept").collect()
    assert len(got) == len(awkward) + len(more)
    for r in got:
        expected = brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r.kept and r.base_failed)


def test_clashing_columns_come_back(docs_of, awkward):
    docs = docs_of(awkward)
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["kept"] for r in kept.collect()} <= {"k"} and kept.count() > 0


def test_empty_table(docs_of):
    assert Q.quality_rules(docs_of([])).count() == 0


def test_fit_finds_planted_rates():
    rng = random.Random(5)
    good, bad, counts = (0.95, 0.9, 0.99, 0.9), (0.2, 0.3, 0.1, 0.4), Counter()
    truth = {}
    for _ in range(20_000):
        y = rng.random() < 0.8
        votes = tuple(0 if rng.random() < 0.2 else (1 if rng.random() < (good if y else bad)[j] else -1) for j in range(4))
        counts[votes] += 1
        truth.setdefault(votes, []).append(y)
    model = Q.fit(sorted(counts.items()))
    assert model.prior == pytest.approx(0.8, abs=0.05)
    assert model.good == pytest.approx(good, abs=0.05) and model.bad == pytest.approx(bad, abs=0.1)
    right = sum((model.log_odds(v) > 0) == y for v, ys in truth.items() for y in ys)
    assert right / 20_000 > 0.93


def test_fit_without_votes():
    assert Q.fit([]).prior == 0.5
    model = Q.fit([((0, 0), 7)])
    assert model.log_odds((0, 0)) > 0


def test_posterior_column_equals_the_model(spark):
    model = Q.Model(0.7, (0.9, 0.8), (0.2, 0.4))
    rows = [((a, b),) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    df = spark.createDataFrame(rows, "_votes array<int>")
    import math

    for r in df.select("_votes", Q._posterior(model).alias("p")).collect():
        assert r.p == pytest.approx(1 / (1 + math.exp(-model.log_odds(r["_votes"]))))


def test_judges_agree_with_labels(spark):
    """Held against the labelled documents, which the rules never see."""
    sf = "/root/testdata/sf0.01"
    judged = Q.quality_rules(spark.read.parquet(f"{sf}/documents.parquet"), keep=["doc_id"])
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = judged.where("not base_failed").selectExpr("row.doc_id", "kept").join(labels, "doc_id").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.99
    assert sum(bad) / len(bad) < 0.6
