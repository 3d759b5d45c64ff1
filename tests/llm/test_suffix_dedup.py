import random

import numpy as np
import pytest

from loanlens.llm import suffix_dedup as S
from loanlens.llm.blocks import stored_blocks, unpacked
from loanlens.session import stored


def brute(rows, length=50):
    """(doc_id, bytes) -> removed ranges."""
    first = {}
    order = lambda d: (d is None, d or 0)
    for doc_id, data in rows:
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            first[s] = min(first.get(s, order(doc_id)), order(doc_id))
    out = []
    for doc_id, data in rows:
        ranges = []
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < order(doc_id):
                if ranges and i <= ranges[-1][1]:
                    ranges[-1][1] = i + length
                else:
                    ranges.append([i, i + length])
        out.append(ranges)
    return out


def compare(docs, rows, **options):
    rows = [(d, (t or "").encode()) for d, t in rows]
    got = S.suffix_dedup(docs, **options).collect()
    expected = []
    for (doc_id, data), ranges in zip(rows, brute(rows)):
        rest, done = b"", 0
        for a, b in ranges:
            rest, done = rest + data[done:a], b
        expected.append((str(doc_id), len(data), ranges, rest + data[done:]))
    assert sorted((str(r.doc_id), r.n_bytes, r.spans, bytes(r.clean)) for r in got) == sorted(expected)
    return sum(len(r.spans) for r in got)


def test_awkward_rows(docs_of, awkward):
    rows = [(d, t) for d, t in awkward if t is None or len(t) < 50_000]
    assert compare(docs_of(rows), rows) > 0
    assert S.suffix_dedup(docs_of([])).count() == 0


@pytest.mark.parametrize("block_bytes", [1, 700, 1 << 20])
def test_shared_passages_equal_brute_force(docs_of, prose, block_bytes):
    rng = random.Random(block_bytes)
    passages = [prose(900 + i, rng.randrange(8, 60)) for i in range(12)]
    rows = []
    for i in range(60):
        text = prose(i, rng.randrange(0, 120))
        for _ in range(rng.randrange(0, 4)):
            p, at = rng.choice(passages), rng.randrange(len(text) + 1)
            a = rng.randrange(0, len(p) // 2)
            text = text[:at] + p[a : a + rng.randrange(30, 400)] + text[at:]
        rows.append((rng.randrange(40) if i % 9 else None, text))
    rows += [(i, prose(3, 80)) for i in range(100, 130)]
    assert compare(docs_of(rows).repartition(5), rows, block_bytes=block_bytes) > 20


def test_few_letters_make_long_ties(docs_of):
    """Runs and periods: many equal prefixes, equal minimisers and overlapping windows."""
    rng = random.Random(8)
    rows = [(i, "".join(rng.choices("ab", weights=[9, 1], k=rng.randrange(40, 300)))) for i in range(40)]
    rows += [(50, "a" * 500), (51, "ab" * 200), (52, "a" * 49), (53, "a" * 50), (49, "é" * 60), (60, "xé" + "é" * 40)]
    assert compare(docs_of(rows), rows) > 5


def test_equal_windows_equal_brute_force():
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab", k=rng.randrange(50, 200))).encode() for _ in range(30)]
    texts += [b"x" * 24 + bytes(rng.choices(b"ab", k=2)) + b"y" * 30 for _ in range(40)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    begins = np.cumsum([0, *map(len, texts)])
    ends = np.repeat(begins[1:], list(map(len, texts)))
    windows = np.concatenate([np.arange(a, b - 49) for a, b in zip(begins, begins[1:])])
    bucket = S.BUCKET
    for S.BUCKET in (1, 50, bucket):
        classes = S.equal_windows(data, ends, windows)
        strings = [data[w : w + 50].tobytes() for w in windows]
        pairs = set(zip(strings, classes.tolist()))
        assert len(pairs) == len(set(strings)) == len(set(classes.tolist()))


def test_cover_has_every_difference():
    table = S._shift_table()
    for a in range(S.PERIOD):
        for b in range(S.PERIOD):
            k = table[a, b]
            assert (a + k) % S.PERIOD in S.COVER and (b + k) % S.PERIOD in S.COVER and k < S.PERIOD


def test_equal_windows_have_equal_minimisers():
    numbers = S._byte_numbers()
    rng = random.Random(4)
    data = np.frombuffer(bytes(rng.choices(b"abc", k=500)), np.uint8)
    least = S.minimisers(data, numbers)
    assert len(least) == 451
    for i in range(0, 451, 50):
        alone = S.minimisers(data[i : i + 50], numbers)
        assert alone[0] == least[i]
    chunk = S.CHUNK
    try:
        S.CHUNK = 64
        assert (S.minimisers(data, numbers) == least).all()
    finally:
        S.CHUNK = chunk


def test_a_block_sends_equal_runs_once(docs_of, prose):
    """Copies and common passages add places, but no runs to the part of their minimiser."""
    passage = prose(1, 40)
    rows = [(i, passage) for i in range(300)] + [(400 + i, f"{prose(i, 3)} {passage}") for i in range(20)]
    written, parts = stored_blocks(docs_of(rows).coalesce(1), "doc_id", "text")
    bits = S._sent_minimisers(written, parts, S.LENGTH, S.SHORT).groupBy("part")
    bits = bits.applyInArrow(S._shared_bits(S.HOT_RUNS), "block long, part int, bits binary")
    bits = bits.selectExpr("block", "struct(part, bits) as a").groupBy("block").agg({"a": "collect_list"})
    answered = written.join(bits.toDF("block", "answers"), "block")
    texts = []
    for r in S._sent_runs(answered, parts, S.LENGTH, S.SHORT).collect():
        (_, _, sizes), data = unpacked(bytes(r.runs), 3)
        ends = np.cumsum(sizes)
        texts += [(r.block, data[b - n : b]) for b, n in zip(ends.tolist(), sizes.tolist())]
    assert len(texts) == len(set(texts)) > 0
    assert compare(docs_of(rows), rows) > 300


def test_parts_have_about_as_many_minimisers():
    data = np.frombuffer(random.Random(5).randbytes(200_000), np.uint8)
    counts = np.bincount(S._part_of(np.unique(S.minimisers(data, S._byte_numbers())), 16), minlength=16)
    assert counts.max() < 1.3 * counts.mean()
    assert len(set(S._mixed(np.arange(1 << 16, dtype=np.uint64)).tolist())) == 1 << 16


def common_passage(n, passage=70):
    """Different texts around one passage, whose minimisers have a run for each text."""
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz "
    middle = "".join(rng.choices(letters, k=passage))
    around = ["".join(rng.choices(letters, k=200)) for _ in range(n)]
    return [(i, x[:100] + middle + x[100:]) for i, x in enumerate(around)]


@pytest.mark.parametrize("block_bytes", [2000, 1 << 20])
def test_hot_minimisers_cut_into_windows_equal_brute_force(docs_of, prose, awkward, block_bytes):
    rows = [*common_passage(60), *((100 + i, "ab" * (30 + i)) for i in range(40)), (None, "b" + "ab" * 50)]
    rows += [(d, t) for d, t in awkward if t is None or len(t) < 50_000]
    rows += [(200 + i, prose(i, 30) + " the same long line of text that many documents hold " + prose(50 + i, 30)) for i in range(40)]
    assert compare(docs_of(rows).repartition(3), rows, block_bytes=block_bytes, hot_runs=3) > 100


def test_runs_of_a_common_passage_are_spread(docs_of):
    """The largest part gets less than five times what the median part gets."""
    rows = common_passage(8000)
    written, _ = stored_blocks(docs_of(rows).coalesce(1), "doc_id", "text")
    parts, hot_runs = 32, 200
    bits = stored(S._answers(S._sent_minimisers(written, parts, S.LENGTH, S.SHORT), hot_runs), "bits")
    hot = S._by_block(bits.where("substring(bits, 1, 1) = X'01'"))
    more = S._answers(S._sent_windows(written.join(hot, "block"), parts, S.LENGTH, S.SHORT), hot_runs)

    def sent(bits):
        each = np.zeros(parts, np.int64)
        for r in S._sent_runs(written.join(S._by_block(bits), "block"), parts, S.LENGTH, S.SHORT).collect():
            each[r.part] += len(unpacked(bytes(r.runs), 3)[1])
        return each

    together = S._answers(S._sent_minimisers(written, parts, S.LENGTH, S.SHORT), 1 << 40)
    assert sent(together).max() > 50 * np.median(sent(together))
    spread = sent(bits.union(more))
    assert 0 < spread.max() < 5 * np.median(spread)
