import random
import re

import pytest

from loanlens.llm import decontamination as D


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text, items, window=10):
    ws, hit, found = words(text), set(), set()
    for item, item_text in items:
        its = words(item_text)
        size = min(window, len(its))
        grams = {tuple(its[i : i + size]) for i in range(len(its) - size + 1)} if its else set()
        for i in range(len(ws) - size + 1):
            if tuple(ws[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    return len(ws), hit, sorted(found)


def longest_brute(ws, items):
    subs = {tuple(words(t)[i:j]) for _, t in items for i in range(len(words(t))) for j in range(i + 1, len(words(t)) + 1)}
    return max((j - i for i in range(len(ws)) for j in range(i + 1, len(ws) + 1) if tuple(ws[i:j]) in subs), default=0)


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_automaton_equals_brute_force(window):
    """Few distinct words make many overlaps, repeats and nested items."""
    rng = random.Random(window)
    for _ in range(60):
        letters = "ab" if rng.random() < 0.5 else "abcd"
        items = [(i % 4, " ".join(rng.choices(letters, k=rng.randrange(0, 9)))) for i in range(rng.randrange(1, 6))]
        machine = D.Automaton([([str(i)], D.normal_words(t.encode())) for i, t in items], window)
        for _ in range(5):
            text = " ".join(rng.choices(letters + "z", k=rng.randrange(0, 25)))
            got = machine.hits(D.normal_words(text.encode()))
            _, hit, found = brute(text, items, window)
            assert {p for a, b in got.spans for p in range(a, b)} == hit
            assert sorted(got.items) == found
            assert got.longest == longest_brute(words(text), items)
            assert all(x[1] < y[0] for x, y in zip(got.spans, got.spans[1:]))


@pytest.fixture
def tables(spark, docs_of, awkward, prose):
    items = [(1, prose(1, 40)), (2, prose(1, 15)), (3, "SHORT item, here"), (3, prose(50, 30)), (4, None), (5, " ,. "),
             (None, prose(60, 20)), (6, prose(1, 40))]
    docs = awkward + [
        (20, "a Short-ITEM; here! and short item here"),
        (21, prose(70, 100) + " " + prose(50, 30).upper() + " " + prose(71, 100)),
        (22, prose(60, 20)),
        (23, prose(50, 30)[:60]),
    ]
    return docs_of(docs), docs, spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("block_words, most_broadcast", [(100_000, 1 << 20), (45, 1 << 20), (45, 1), (1, 30_000)])
def test_equals_brute_force_in_any_blocks(tables, block_words, most_broadcast):
    docs, rows, items_df, items = tables
    options = {"block_words": block_words, "most_broadcast": most_broadcast}
    got = D.benchmark_hits(docs, items_df, keep=["doc_id", "text"], **options).collect()
    assert len(got) == len(rows)
    for r in got:
        n, hit, found = brute(r.row.text, items)
        assert r.hits.n_words == n and r.hits["items"] == found
        assert {p for a, b in r.hits.spans for p in range(a, b)} == hit


def test_spans_are_cut(tables):
    docs, rows, items_df, items = tables
    got = {(r.doc_id, r.text): r.clean for r in D.decontaminate(docs, items_df).select("row.doc_id", "row.text", "clean").collect()}
    for doc_id, text in rows:
        n, hit, _ = brute(text, items)
        if 2 * len(hit) > n:
            assert (doc_id, text) not in got
            continue
        clean = got[doc_id, text]
        assert (clean is None) == (text is None)
        assert words(clean) == [w for i, w in enumerate(words(text)) if i not in hit]
        if not hit:
            assert clean == text
    assert D.decontaminate(docs, items_df).select("row.*").columns == docs.columns


def test_empty_tables(spark, docs_of, awkward):
    items = spark.createDataFrame([], "item_id long, text string")
    assert {len(r.hits.spans) for r in D.benchmark_hits(docs_of(awkward), items).collect()} == {0}
    some = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    assert D.benchmark_hits(docs_of([]), some).count() == 0


def test_entries_grow_with_the_items():
    """Many equal short items, and items that end in them, hold each id once or twice."""
    sizes = []
    for n in (200, 400, 800):
        machine = D.Automaton([([f"a{i}"], [b"yes"]) for i in range(n)] + [([f"b{i}"], [b"w%d" % i, b"yes"]) for i in range(n)])
        sizes.append(sum(len(ids) for by_size in machine.ends.values() for ids in by_size.values()))
        found = machine.hits([b"w1", b"yes"])
        assert found.items == {f"a{i}" for i in range(n)} | {"b1"} and found.spans == [(0, 2)]
    assert sizes == [400, 800, 1600]


def test_names_of_results_may_be_columns(spark, docs_of, awkward):
    docs = docs_of(awkward).selectExpr("*", "1 as hits", "2 as whole", "3 as _hits")
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    got = D.benchmark_hits(docs, items)
    assert got.select("row.*").columns == docs.columns and got.count() == len(awkward)
    assert D.decontaminate(docs, items).select("row.*").columns == docs.columns
