"""Benchmark passages in training text, by a generalised suffix automaton.

The automaton of all test items takes the documents' words one by one and
always knows the longest suffix that some item holds.  Wherever that is as long
as a window, the window's words are hit and its items are known.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.common import LOWER, UPPER, as_bytes, slices
from loanlens.session import stored

WINDOW = 10
MOST_COVERAGE = 0.5
BLOCK_WORDS = 100_000
MOST_BROADCAST = 128 << 20  # bytes of automata that one pass sends to the tasks

_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_NORMAL = bytes.maketrans(UPPER.encode() + _SEPARATORS, LOWER.encode() + b" " * len(_SEPARATORS))
_WORD = re.compile(rb"[^ ]+")


def normal_words(text: bytes) -> list[bytes]:
    """Words of the UTF-8 text: runs of ASCII letters and digits, lower-cased, and of other code points."""
    return text.translate(_NORMAL).split()


class Hits(NamedTuple):
    spans: list[tuple[int, int]]  # word ranges, end excluded, sorted and apart
    items: set[str]
    longest: int


class Automaton:
    """Generalised suffix automaton over the words of (item ids, words) pairs.

    A window is ``window`` consecutive words of an item; a shorter item is one
    window.  ``at`` maps a state to the items that hold the state's substring of
    window length; ``ends`` maps one to the shorter items that are among its
    substrings, by their size, and ``near`` gives the nearest such state on each
    state's chain of suffixes.  A chain has at most ``window`` - 1 of them, so
    entries are linear in the items' words.
    """

    def __init__(self, items: Sequence[tuple[Iterable[str], list[bytes]]], window: int = WINDOW):
        self.window, self.ids = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        coded = [(named, [self.ids.setdefault(w, len(self.ids)) for w in words]) for named, words in items if words]
        for _, words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.at: dict[int, set[str]] = {}
        self.ends: dict[int, dict[int, set[str]]] = {}
        for named, words in coded:
            size = min(window, len(words))
            state = matched = 0
            for i, w in enumerate(words):
                state, matched = self._step(state, matched, w)
                if i + 1 >= size:
                    s = self._holding(state, size)
                    if len(words) < window:
                        self.ends.setdefault(s, {}).setdefault(size, set()).update(named)
                    else:
                        self.at.setdefault(s, set()).update(named)
        self.holder = [self._holding(s, window) if self.length[s] >= window else -1 for s in range(len(self.next))]
        self.near = [0] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.near[s] = s if s in self.ends else self.near[self.link[s]]

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, q, w)
        current = self._new({}, -1, length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = current
            p = link[p]
        if p < 0:
            link[current] = 0
        else:
            q = nxt[p][w]
            link[current] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
        return current

    def _new(self, moves: dict, link: int, length: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, w: int) -> int:
        clone = self._new(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _step(self, state: int, matched: int, w: int) -> tuple[int, int]:
        nxt = self.next
        while state and w not in nxt[state]:
            state = self.link[state]
            matched = self.length[state]
        if w in nxt[state]:
            return nxt[state][w], matched + 1
        return 0, 0

    def _holding(self, state: int, size: int) -> int:
        """The state of the suffix of the given size."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def hits(self, words: Sequence[bytes]) -> Hits:
        """Streams the words; windows that occur, as merged word ranges."""
        spans: list[list[int]] = []
        items: set[str] = set()
        seen: set[int] = set()
        seen_short: set[tuple[int, int]] = set()
        state = matched = longest = 0
        window, near, ends, link = self.window, self.near, self.ends, self.link
        get, nxt = self.ids.get, self.next
        for i, w in enumerate(map(get, words)):
            if w is None:
                state = matched = 0
                continue
            if w in nxt[state]:
                state, matched = nxt[state][w], matched + 1
            else:
                state, matched = self._step(state, matched, w)
            if matched > longest:
                longest = matched
            size = 0
            if matched >= window:
                size = window
                if (h := self.holder[state]) not in seen:
                    seen.add(h)
                    items |= self.at.get(h, set())
            s = near[state]
            while s:
                for length, named in ends[s].items():
                    if length <= matched:
                        size = max(size, length)
                        if (s, length) not in seen_short:
                            seen_short.add((s, length))
                            items |= named
                s = near[link[s]]
            if size:
                start = i + 1 - size
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
        return Hits([(a, b) for a, b in spans], items, longest)


def automata(items: DataFrame, item: str, text: str, window: int, block_words: int) -> DataFrame:
    """(block, machine): pickled automata of blocks of items, each of about ``block_words`` words, built in tasks.

    Equal texts are one item with several ids.  A text longer than a block is a
    part of one block.  Null item ids take part in hits but have no name.
    """
    texts = items.select(F.col(f"`{item}`").cast("string").alias("i"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    texts = texts.groupBy("t").agg(F.collect_set("i").alias("ids"))
    words = F.size(F.split("t", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    blocks = max(1, -(-(texts.agg(F.sum(words)).first()[0] or 0) // block_words))

    def build(block: pa.Table) -> pa.Table:
        taken = [
            (ids, normal_words(t)) for ids, t in zip(block.column("ids").to_pylist(), as_bytes(block.column("t")).to_pylist())
        ]
        machine = pickle.dumps(Automaton(taken, window))
        return pa.table({"block": block.column("block").slice(0, 1), "machine": pa.array([machine], pa.binary())})

    placed = texts.select("ids", "t", F.pmod(F.xxhash64("t"), F.lit(blocks)).alias("block"))
    return stored(placed.groupBy("block").applyInArrow(build, "block long, machine binary"), "automata")


def _loads(machines: DataFrame, most_bytes: int) -> Iterator[list[bytes]]:
    """The pickled automata in lists of at most ``most_bytes``, or of a single one; one empty list if there are none."""
    taken, held = [], 0
    for row in machines.toLocalIterator():
        if taken and held + len(row["machine"]) > most_bytes:
            yield taken
            taken, held = [], 0
        taken.append(bytes(row["machine"]))
        held += len(row["machine"])
    yield taken


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what lies between those words."""
    at = [m.span() for m in _WORD.finditer(text.translate(_NORMAL))]
    out, done = [], 0
    for a, b in spans:
        out.append(text[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, text[done:]])


_HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", T.LongType()),
        T.StructField("clean", T.StringType()),
    ]
)
_HITS_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int64()))),
        ("items", pa.list_(pa.string())),
        ("longest", pa.int64()),
        ("clean", pa.string()),
    ]
)


def _pass(docs: DataFrame, packed, last: bool, cut: bool) -> DataFrame:
    """One pass over (row, whole, hits of earlier passes) with some automata, loaded in turn for each batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = packed.value
        alone = [pickle.loads(blob) for blob in blobs] if len(blobs) == 1 else None
        for batch in slices(batches, "whole", 8 << 20):
            texts = as_bytes(batch.column("whole")).to_pylist()
            words = [normal_words(t) for t in texts]
            found = batch.column("hits").to_pylist()
            found = [Hits([], set(), 0) if x is None else Hits(x["spans"], set(x["items"]), x["longest"]) for x in found]
            for machine in alone or map(pickle.loads, blobs):
                for i, ws in enumerate(words):
                    spans, items, longest = machine.hits(ws)
                    old = found[i]
                    spans = _merged([*spans, *map(tuple, old.spans)]) if old.spans else spans
                    found[i] = Hits(spans, items | old.items, max(longest, old.longest))
            out = [
                {
                    "n_words": len(ws),
                    "spans": x.spans,
                    "items": sorted(x.items),
                    "longest": x.longest,
                    "clean": _cut(t, x.spans).decode("utf-8", "replace") if cut and last and x.spans else None,
                }
                for t, ws, x in zip(texts, words, found)
            ]
            carried = ["row"] if last else ["row", "whole"]
            columns = [batch.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, _HITS_ARROW)], [*carried, "hits"])

    kept = docs.schema[:1] if last else docs.schema[:2]
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField("hits", _HITS)]))


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: Sequence[str] | None = None,
    block_words: int = BLOCK_WORDS,
    cut: bool = False,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """``row`` (a struct of the columns ``keep``, default all) with ``hits``: words, hit word ranges, items, longest match.

    With ``cut``, ``hits.clean`` is the text without the hits, null where there
    are none.  A window is ``window`` consecutive words of an item, or all words
    of a shorter item.  Test sets of any size are taken in blocks of about
    ``block_words`` words, whose automata tasks build and store.  The documents
    pass once for every ``most_broadcast`` bytes of automata, which are sent to
    the tasks together; a task holds one at a time.

    A null or empty text has no words and no hits; an item without words has no
    window.  Rows of one item id add up, as do repeated ones; an item without id
    hits words but is not named.  Repeated documents are treated alike; an empty
    table of either kind gives no hits.
    """
    context = docs.sparkSession.sparkContext
    kept = docs.columns if keep is None else list(keep)
    current = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.col(f"`{text}`").alias("whole"),
        F.lit(None).cast(_HITS).alias("hits"),
    )
    waiting = None
    for machines in _loads(automata(items, item, item_text, window, block_words), most_broadcast):
        if waiting is not None:  # more automata follow, so the text is needed again
            current = stored(_pass(current, waiting, False, cut), "hits")
        waiting = context.broadcast(machines)
    return _pass(current, waiting, True, cut)


def n_hit(hits: str = "hits"):
    """Number of hit words."""
    return F.aggregate(F.col(f"{hits}.spans"), F.lit(0).cast("long"), lambda n, s: n + F.get(s, 1) - F.get(s, 0))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    most_coverage: float = MOST_COVERAGE,
    **options,
) -> DataFrame:
    """Documents without benchmark passages: the column ``clean`` beside the struct ``row``.

    Every hit span is cut from the text, from its first word to its last.  A
    document with more than ``most_coverage`` of its words hit goes as a whole;
    one without words (null, empty) stays as it is.  Nulls, repeats, items and
    empty tables are treated as in ``benchmark_hits``.
    """
    found = benchmark_hits(docs, items, text, window=window, cut=True, **options)
    covered = n_hit() > F.lit(most_coverage) * F.col("hits.n_words")
    return found.where(~covered).select("row", F.coalesce("hits.clean", f"row.`{text}`").alias("clean"))
