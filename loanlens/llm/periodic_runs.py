"""Periodic runs of words, by an online sparse diagonal DP.

A diagonal is a lag: for each word, its earlier occurrences increment the match
lengths of the lags they stand at, and a lag that a word does not increment has
ended; if it was long enough, its run is emitted there and then.

Few earlier occurrences can matter, so few are visited.  A run of period q has
at least max(24 - q, 2 q) words that agree with the word q before, so every one
of them stands in a context of equal words: 16 for q up to 16, and the next
power of two from q on for greater ones.  Such a context is at least q long,
hence the nearest earlier place of it inside the run is exactly q back (a
primitive block occurs nowhere else in its repetition).  So a word needs one
occurrence for each size of context, 16, 32, 64 and so on: the nearest one, if
its lag belongs to that size.  A lag of a size starts with the whole context
matched.  That gives at most log2(n) active lags a word, whatever the text, and
it finds every run: all words of the run are visited with lag q.  Nor is
anything else emitted: a stretch of three periods q has no smaller period, as
that would give a nearer place, and one that could be extended would have been.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.common import as_bytes, bind, blank_split, slices

LEAST_WORDS = 24
LEAST_PERIODS = 3
CONTEXT = 16  # words that agree at least, in any run of that many words and periods

Run = tuple[int, int, int]  # start, length, period; in words


def occurrences(words: np.ndarray, doc: np.ndarray, context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, lag, context size): earlier occurrences to visit, in the order of the words.

    ``words`` are numbers that are equal for equal words, ``doc`` the documents
    they stand in; documents follow each other and share no occurrence.
    """
    names, alive, size = words, np.arange(len(words)), 1
    found = [(np.empty(0, np.int64),) * 3]
    if len(words):
        names = doc * (int(words.max()) + 1) + words
    while len(alive):
        order = alive[np.argsort(names[alive], kind="stable")]
        same = names[order[1:]] == names[order[:-1]]
        before, at = order[:-1][same], order[1:][same]
        if size >= context:
            lag = at - before
            fits = (lag <= size) & (lag > (size // 2 if size > context else 0))
            found.append((at[fits] + size - 1, lag[fits], np.full(int(fits.sum()), size)))
        # places whose context has another place in the document take part in the next size
        group = np.concatenate([[0], np.cumsum(~same)])
        shared = np.zeros(len(order), bool)
        shared[1:] |= same
        shared[:-1] |= same
        dense = np.full(len(words), -1)
        dense[order[shared]] = group[shared]
        alive = np.sort(order[shared])
        alive = alive[alive + size < len(words)]
        alive = alive[(dense[alive + size] >= 0) & (doc[alive + size] == doc[alive])]
        names = np.full(len(words), -1)
        names[alive] = dense[alive] * len(words) + dense[alive + size]
        size *= 2
    end, lag, sizes = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(end, kind="stable")
    return end[order], lag[order], sizes[order]


def online_runs(
    ends: Iterable[int],
    lags: Iterable[int],
    contexts: Iterable[int],
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> Iterator[Run]:
    """Runs in the order in which they end, from the occurrences to visit."""
    now, before, active = -2, {}, {}

    def ended(lengths: dict[int, int], last: int, going: dict[int, int]) -> Iterator[Run]:
        for lag, matched in lengths.items():
            if lag not in going and matched + lag >= max(least_words, least_periods * lag):
                yield last - matched - lag + 1, matched + lag, lag

    for word, lag, context in zip(ends, lags, contexts):
        if word != now:
            yield from ended(before, now - 1, active)
            if word != now + 1:
                yield from ended(active, now, {})
                active = {}
            now, before, active = word, active, {}
        active[lag] = before.get(lag, context - 1) + 1
    yield from ended(before, now - 1, active)
    yield from ended(active, now, {})


def runs_of(texts: Sequence[list[bytes]]) -> list[list[Run]]:
    """The runs of each text's words, by start and period."""
    ids: dict[bytes, int] = {}
    sizes = np.array([len(ws) for ws in texts], np.int64)
    words = np.fromiter((ids.setdefault(w, len(ids)) for ws in texts for w in ws), np.int64, int(sizes.sum()))
    ids.clear()
    begins = np.cumsum(sizes) - sizes
    found: list[list[Run]] = [[] for _ in texts]
    visited = occurrences(words, np.repeat(np.arange(len(texts)), sizes))
    for start, length, period in online_runs(*(x.tolist() for x in visited)):
        doc = int(np.searchsorted(begins, start, side="right")) - 1
        found[doc].append((start - int(begins[doc]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: Sequence[Run]) -> bytes:
    """The words with one period kept of each run, joined by blanks."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def periodic_runs(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``keep``, default all) with ``n_words``, ``runs`` and ``collapsed``.

    A run is a stretch of words with smallest period q, of at least 24 words and
    three periods, that no neighbouring word extends; ``runs`` lists (start,
    length, period) by start and period.  ``collapsed`` is the text's words but
    for those that a run holds after its first period, with one blank between.

    Words are what stands between blanks and are compared as they are.  A null
    or empty text has no words, no runs and an empty ``collapsed``.  Every row
    is looked at on its own: keys are not read, and repeated rows are treated
    alike.  Overlapping runs are all listed.  Memory is bounded by the longest
    text; an empty table gives an empty result.
    """
    kept = docs.columns if keep is None else list(keep)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("_whole"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_whole", 8 << 20):
            texts = [t.split() for t in as_bytes(batch.column("_whole")).to_pylist()]
            runs = runs_of(texts)
            rest = [collapsed(ws, rs) for ws, rs in zip(texts, runs)]
            listed = [[dict(zip(_RUN.names, r)) for r in rs] for rs in runs]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([len(ws) for ws in texts], pa.int64()),
                    pa.array(listed, pa.list_(pa.struct([(c, pa.int64()) for c in _RUN.names]))),
                    pa.array(rest, pa.binary()).cast(pa.string()),
                ],
                ["row", "n_words", "runs", "collapsed"],
            )

    schema = T.StructType(
        [
            packed.schema["row"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(_RUN)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    return packed.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run of greatest length / period; of equal ones the first.  Null without runs."""

    def better(best: Column, r: Column) -> Column:
        more = r["length"] * best["period"] > best["length"] * r["period"]
        return F.when(more, r).otherwise(best)

    return F.aggregate(runs, F.get(runs, 0), better)


def repeat_tail(text: Column, key: Column) -> Column:
    """The text with its tail made periodic, in one of ten documents, as its key's CRC-32 says.

    With h the CRC-32 of the decimal key and g = h // 10: where h % 10 is 0 and
    there are n > 0 words, each word from a = g % n on becomes word
    a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).  Other texts stay as they
    are, also those with a null key.
    """
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(words, lambda _, i: F.get(words, place(i))), " ")

    chosen = (h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]")
    return F.when(chosen, bind(blank_split(text), repeated)).otherwise(text)
