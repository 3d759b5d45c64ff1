import hashlib
import random

import numpy as np
import pytest

from loanlens.llm import chunk_dedup as C

TABLE = C.gear_table()


def brute_cuts(text):
    h, start, out = 0, 0, []
    mask = ((1 << C.AVERAGE_BITS) - 1) << (32 - C.AVERAGE_BITS)
    for i, b in enumerate(text):
        h = ((h << 1) + int(TABLE[b])) & 0xFFFFFFFF
        size = i + 1 - start
        if size >= C.LEAST and (h & mask == 0 or size == C.MOST) or i + 1 == len(text):
            out.append(i + 1)
            start = i + 1
    return out


def brute(rows):
    """Removed [start, end) runs of (doc_id, text) rows."""
    order = lambda d: (d is None, d or 0)
    least, parts = {}, []
    for doc_id, text in rows:
        data, start, own = (text or "").encode(), 0, []
        for end in brute_cuts(data):
            d = hashlib.md5(data[start:end]).digest()
            own.append((d, start, end))
            least[d] = min(least.get(d, order(doc_id)), order(doc_id))
            start = end
        parts.append(own)
    out = []
    for (doc_id, _), own in zip(rows, parts):
        runs, seen = [], set()
        for d, start, end in own:
            if least[d] < order(doc_id) or d in seen:
                if runs and runs[-1][1] == start:
                    runs[-1][1] = end
                else:
                    runs.append([start, end])
            seen.add(d)
        out.append([r for r in runs if r[1] - r[0] >= C.LEAST_RUN])
    return out


def test_cuts_equal_the_rolling_hash(prose):
    rng = random.Random(1)
    for text in [prose(1, 900).encode(), rng.randbytes(20_000), b"a" * 3000, b"", b"x", prose(2, 5).encode()]:
        cuts = C.cuts(text, TABLE)
        assert cuts == brute_cuts(text)
        sizes = np.diff([0, *cuts])
        assert all(s <= C.MOST for s in sizes) and all(s >= C.LEAST for s in sizes[:-1])


def test_cuts_settle_after_an_insertion(prose):
    text = prose(5, 2000).encode()
    other = text[:500] + b"inserted words" + text[500:]
    ends = {c + 14 for c in C.cuts(text, TABLE)}
    shared = [c for c in C.cuts(other, TABLE) if c in ends]
    assert len(shared) > 0.9 * len(ends) - 12


@pytest.mark.parametrize("block_bytes", [1, 3000, 1 << 22])
def test_equals_brute_force(docs_of, prose, awkward, block_bytes):
    passages = [prose(800 + i, 70) for i in range(3)]
    rows = awkward + [(100 + i // 2, prose(i, 150) + passages[i % 3] + prose(i + 500, 50)) for i in range(20)]
    rows += [(200, prose(1, 120)), (201, passages[0] + passages[0])]
    got = C.chunk_dedup(docs_of(rows), block_bytes=block_bytes).collect()
    expected = []
    for (doc_id, text), spans in zip(rows, brute(rows)):
        data, rest, done = (text or "").encode(), b"", 0
        for a, b in spans:
            rest, done = rest + data[done:a], b
        expected.append((str(doc_id), len(data), spans, rest + data[done:]))
    assert sorted((str(r.doc_id), r.n_bytes, r.spans, bytes(r.clean)) for r in got) == sorted(expected)


def test_passages_are_caught_and_others_kept(docs_of, prose):
    passage = prose(77, 60)
    rows = [(i, prose(i, 100) + " " + passage + " " + prose(i + 300, 100)) for i in range(10)]
    rows += [(50 + i, prose(i + 900, 200)) for i in range(10)]
    got = {r.doc_id: sum(b - a for a, b in r.spans) for r in C.chunk_dedup(docs_of(rows)).collect()}
    assert got[0] == 0 and all(got[i] > len(passage) // 3 for i in range(1, 10))
    assert all(got[50 + i] == 0 for i in range(10))


def test_empty_table(docs_of):
    assert C.chunk_dedup(docs_of([])).count() == 0


def test_rows_sent_grow_with_the_blocks(docs_of, prose):
    from loanlens.llm.blocks import stored_blocks

    rows = []
    for n in (12, 48):
        docs = docs_of([(i, prose(i, 300)) for i in range(n)]).coalesce(1)
        written, parts = stored_blocks(docs, "doc_id", "text", block_bytes=1)
        assert written.count() == n and parts == 8
        rows.append(C._sent_digests(written, parts, 6, 32, 256).count())
    assert rows[1] <= 4.2 * rows[0]
    written, parts = stored_blocks(docs, "doc_id", "text", part_bytes=5_000)
    assert parts == -(-written.selectExpr("sum(n_bytes)").first()[0] // 5_000) > 8
