import random
import zlib
from collections import Counter

import pytest

from loanlens.llm import spelling_variants as V


def edits(word, letters):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out.add(word[:i] + word[i + 1 :])
            out |= {word[:i] + c + word[i + 1 :] for c in letters}
    return out - {word}


def brute(counts, times=5):
    letters = set("".join(counts))
    near = {w: [x for x in edits(w, letters) if x in counts] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= times * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def vocabulary(seed, n):
    """Words that differ little, many of them anagrams of each other, some with letters beyond ASCII."""
    rng = random.Random(seed)
    letters = "abcdeéÀ÷"
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(6, 9))) for _ in range(n)}
    for w in sorted(words)[: n // 2]:
        words |= set(rng.sample(sorted(edits(w, letters)), 3))
    return {w: rng.choice([5, 6, 25, 26, 30, 125, 700, 3000]) for w in sorted(words) if len(w) >= 6}


def result(spark, counts):
    df = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    return {tuple(r) for r in V.spelling_variants(df).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    counts = vocabulary(seed, 700)
    got = result(spark, counts)
    assert got == brute(counts)
    assert sum(r[2] != r[0] and r[2] != r[1] for r in got) > 5  # roots beyond the form


def test_parts_of_a_block_meet(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_BYTES", 1 << 13)  # eight words to a part
    counts = vocabulary(3, 500)
    assert result(spark, counts) == brute(counts)


def test_long_words_and_chains(spark):
    long = "ab" * 4000
    counts = {long: 5, long[:-1]: 25, long + "z": 7, long[:100] + "x" + long[101:]: 9}
    chain = {"a" * 6 + "b" * i: 5 ** (1 + i) for i in range(10)}
    assert result(spark, counts | chain) == brute(counts | chain)


def test_no_words(spark):
    assert result(spark, {}) == set()
    assert result(spark, {"lonely": 9}) == {("lonely", None, "lonely", 9, 0, None)}


def test_blocks_meet_whatever_the_edit():
    steps = {tuple(s) for s in V._neighbours()}
    assert len(steps) == 16

    def block(word):
        return [len(word), *[sum(c in letters for c in word) for letters in V.CLASSES]]

    rng = random.Random(5)
    letters = "".join(V.CLASSES)
    assert len(letters) == len(set(letters)) == 90
    for _ in range(2000):
        word = "".join(rng.choice(letters) for _ in range(7))
        other = rng.choice(sorted(edits(word, rng.choice(letters))))
        a, b = block(word), block(other)
        assert tuple(y - x for x, y in zip(a, b)) in steps or tuple(x - y for x, y in zip(a, b)) in steps


def test_counted_words(docs_of, awkward, prose):
    rows = [*awkward, (13, "Ärger ÄRGER éclairs Éclairs naïveté x÷y÷z×w don't"), (14, prose(14, 3000))]
    expected = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c <= "Z" else c
                continue
            h = None if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if run and h is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                expected[run] += 1
            run = ""
    got = V.counted_words(docs_of(rows), change=V.drop_letters).collect()
    assert {r.word: r.n for r in got} == expected
    assert V.counted_words(docs_of([])).count() == 0
