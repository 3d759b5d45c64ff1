import random

import xxhash

from loanlens.llm import simhash as S


def brute_print(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """Component ids of (doc_id, fingerprint) rows by comparing all pairs."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(rows))]


def test_hash_is_the_one_spark_has(spark):
    for text in ("", "a", "ab cd ef", "x" * 31, "y" * 32, "Ünïcode " * 20):
        value = spark.sql("select xxhash64(?)", args=[text]).first()[0]
        assert value & (2**64 - 1) == xxhash.xxh64_intdigest(text.encode(), 42)


def test_every_near_pair_meets_in_a_table():
    for radius in (1, 2, 3):
        masks = S.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        rng = random.Random(radius)
        for _ in range(3000):
            flips = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(flips & m == 0 for m in masks)
    pairs = [(1 << a) | (1 << b) for a in range(64) for b in range(a)]
    assert all(any(p & m == 0 for m in S.covering_masks(2)) for p in pairs)


def test_equals_brute_force(docs_of, awkward, prose):
    base = prose(7, 400).split(" ")
    near = []
    for i in range(60):
        words = list(base)
        rng = random.Random(i)
        for _ in range(1 + i % 4):
            words[rng.randrange(len(words))] = f"changed{i}"
        near.append((200 + i, " ".join(words)))
    rows = awkward + near + [(400 - i, t) for i, (_, t) in enumerate(near[:20])]
    got = S.near_duplicates(docs_of(rows))
    prints = [(doc_id, brute_print(text)) for doc_id, text in rows]
    expected = sorted((d is None, d or 0, f"{p:016x}", c) for (d, p), c in zip(prints, brute_components(prints)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in got.collect()) == expected


def _linked(spark, prints, most):
    df = spark.createDataFrame([(S._signed(p),) for p in prints], "_print long")
    from loanlens.llm.components import connected

    roots = {r.a: r.b for r in connected(S.links(df, 2, most)).collect()}
    groups = {}
    for p in prints:
        groups.setdefault(roots.get(S._signed(p), S._signed(p)), set()).add(p)
    return sorted(map(sorted, groups.values()))


def test_large_buckets_lose_no_link(spark):
    """A ball of near fingerprints and long chains, with buckets far above the limit and below it."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    ball = {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)} | {centre}
    chain, x = set(), rng.getrandbits(64)
    for _ in range(60):
        x ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        chain.add(x)
    far = {rng.getrandbits(64) for _ in range(200)}
    prints = sorted(ball | chain | far)
    ids = brute_components(list(enumerate(prints)))
    expected = {}
    for p, c in zip(prints, ids):
        expected.setdefault(c, []).append(p)
    for most in (4, 64, 10_000):
        assert _linked(spark, prints, most) == sorted(map(sorted, expected.values()))


def test_one_of_each_group_stays(docs_of, awkward):
    docs = docs_of(awkward)
    kept = S.keep_first(docs).collect()
    # row numbers in key order tell components apart that share their smallest key
    ordered = sorted(awkward, key=lambda x: (x[0] is None, x[0] or 0))
    firsts = set(brute_components([(i, brute_print(t)) for i, (_, t) in enumerate(ordered)]))
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(ordered[i][0]) for i in firsts)
    assert S.keep_first(docs).columns == docs.columns


def test_empty_table(docs_of):
    assert S.near_duplicates(docs_of([])).count() == 0 and S.keep_first(docs_of([])).count() == 0
