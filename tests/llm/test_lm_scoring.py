import math
import re
from collections import Counter

import pytest

from loanlens.llm import lm_scoring as M


def brute(rows, targets, size, weight=M.WEIGHT, added=M.ADDED):
    texts = [(d, (t or "").encode().lower().split()) for d, t in rows]
    counts = Counter(w for _, ws in texts for w in ws)
    known = {w: i + 1 for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: size - 1])}
    coded = [(d, [0, *[known.get(w, 0) for w in ws]] if ws else []) for d, ws in texts]
    models = []
    for which in (lambda d: d in targets, lambda d: True):
        models.append(Counter((a, b) for d, c in coded if which(d) for a, b in zip(c, c[1:])))
    target, background = models
    if not target:
        return [(len(ws), 0.0) for _, ws in texts]
    scale = sum(target.values()) / sum(background.values())
    background = {k: n * scale for k, n in background.items()}

    def loss(model, a, b):
        total = sum(model.values())
        uni = (sum(n for (_, y), n in model.items() if y == b) + added) / (total + added * size)
        before = sum(n for (x, _), n in model.items() if x == a)
        return -math.log(weight * model.get((a, b), 0) / before + (1 - weight) * uni if before else uni)

    out = []
    for _, c in coded:
        diffs = [loss(background, a, b) - loss(target, a, b) for a, b in zip(c, c[1:])]
        out.append((len(diffs), sum(diffs) / len(diffs) if diffs else 0.0))
    return out


def test_no_target_and_empty_tables(spark, docs_of, awkward):
    none = spark.createDataFrame([], "doc_id long")
    assert {r.score for r in M.lm_scores(docs_of(awkward), none).collect()} == {0.0}
    some = spark.createDataFrame([(1,)], "doc_id long")
    assert M.lm_scores(docs_of([]), some).count() == 0


def test_scores_tell_held_out_documents_apart(spark, docs_of, prose):
    """Targets use some words more often; documents not listed are ranked by that."""

    def text(seed):
        return re.sub("[0-9]", "", prose(seed, 200))  # 64 words, which twenty targets show often enough

    good = [(i, text(i).replace("garden", "window")) for i in range(40)]
    other = [(100 + i, text(200 + i).replace("window", "garden")) for i in range(40)]
    listed = spark.createDataFrame([(i,) for i in range(20)], "doc_id long")
    scores = {r.row.doc_id: r.score for r in M.lm_scores(docs_of(good + other), listed).collect()}
    assert min(scores[i] for i in range(20, 40)) > max(scores[100 + i] for i in range(40))


@pytest.mark.parametrize("block_bytes", [1, 300, 1 << 20])
def test_equals_brute_force(spark, docs_of, prose, block_bytes):
    rows = [(i, prose(i, 30)) for i in range(12)] + [(20, None), (21, ""), (None, prose(3, 20)), (3, prose(5, 25)), (22, "x" * 999)]
    listed = spark.createDataFrame([(t,) for t in [1, 3, 3, 5, None, 999]], "doc_id long")
    got = M.lm_scores(docs_of(rows), listed, keep=["doc_id", "text"], block_bytes=block_bytes).collect()
    size = 1 + len({w for _, t in rows for w in (t or "").encode().lower().split()})
    expected = {(d, t): e for (d, t), e in zip(rows, brute(rows, {1, 3, 5}, size))}
    assert len(got) == len(rows)
    for r in got:
        n, score = expected[r.row.doc_id, r.row.text]
        assert r.n_tokens == n and r.score == pytest.approx(score, abs=1e-9)


def test_tells_rare_words_apart(spark, docs_of):
    """Two documents differ in rare words only."""
    common = " ".join(f"w{i} w{i}" for i in range(2048))
    rows = [(1, common), (2, "rare"), (3, "other"), (4, "rare"), (5, "other")]
    listed = spark.createDataFrame([(4,)], "doc_id long")
    scores = {r.row.doc_id: r.score for r in M.lm_scores(docs_of(rows), listed).collect()}
    assert scores[2] > scores[3]
    none = spark.createDataFrame([], "doc_id long")
    assert {r.score for r in M.lm_scores(docs_of(rows), none).collect()} == {0.0}
    assert M.lm_scores(docs_of([]), listed).count() == 0


def test_names_of_results_may_be_columns(spark, docs_of, awkward):
    docs = docs_of(awkward).selectExpr("*", "1 as score", "2 as n_tokens", "3 as block", "4 as key", "5 as text_")
    listed = spark.createDataFrame([(1,)], "doc_id long")
    got = M.lm_scores(docs, listed, keep=docs.columns)
    assert got.select("row.*").columns == docs.columns and got.count() == len(awkward)
