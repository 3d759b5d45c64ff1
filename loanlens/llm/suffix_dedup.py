"""Exact removal of byte strings that an earlier document holds, by suffix sorting.

A text of n bytes has n suffixes, far too many to shuffle, so memory and
traffic are bounded in four steps, all exact:

1. Documents are packed into blocks of a few megabytes and written once.
2. Every window of ``length`` bytes has a minimiser, the smallest hash of the
   short strings in it.  Equal windows have equal minimisers, so windows whose
   minimiser occurs in one document alone are settled.  Blocks send each
   minimiser once, and get one bit back for each.
3. The other windows go, as runs that share a minimiser, to that minimiser's
   part; a block sends equal runs once, with their smallest key, and keeps a
   list of their places.  There the distinct runs are suffix-sorted by blockwise construction:
   one bucket of leading bytes at a time is sorted to a fixed depth, and longer
   ties are resolved by the ranks of a difference-cover sample, computed
   beforehand.  So a bucket needs a few words per suffix, not its bytes.
4. Each window's smallest document decides; removed ranges go back to the blocks.

A minimiser in a common passage or phrase may have any number of distinct runs.
Beyond ``HOT_RUNS`` of them they are cut into windows, each filed under a number
of its own whole bytes in place of the minimiser, and step 2 is done anew
for these numbers.  Equal windows have equal minimisers and equal numbers, so no
pair is lost, and no part gets more of such a minimiser than of others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.blocks import BLOCK_BYTES, NO_KEY, Spans, cleaned, opened, packed, rows_of, stored_blocks, unpacked
from loanlens.session import stored

LENGTH = 50
SHORT = 20  # bytes of the strings that are hashed
CHUNK = 1 << 17
PART_BYTES = 8 << 20  # of text; a part's suffixes are sorted at once, so it is smaller than where digests meet
BUCKET = 1 << 18  # suffixes sorted at a time
HOT_RUNS = 1024  # distinct runs of one minimiser, beyond one for each block, that stay together

# A difference cover of 0 to 6: any two residues differ by a difference of two members.
COVER, PERIOD = (0, 1, 3), 7
DEPTH = 24


def _byte_numbers() -> np.ndarray:
    """256 odd-looking 64-bit numbers, the same everywhere."""
    return np.array(
        [int.from_bytes(hashlib.md5(bytes([b])).digest()[:8], "little") for b in range(256)], np.uint64
    )


def _string_hashes(data: np.ndarray, numbers: np.ndarray, size: int) -> np.ndarray:
    """A hash of data[i : i + size] for every i, built by doubling."""
    base = 0x9E3779B97F4A7C15
    whole = None  # hash of the first `covered` bytes after each i
    covered, bit, power = 0, 1, numbers[data]
    while True:
        if size & bit:
            if whole is None:
                whole = power
            else:
                n = len(data) - covered - bit + 1
                whole = whole[:n] * np.uint64(pow(base, bit, 1 << 64)) + power[covered : covered + n]
            covered += bit
        if covered == size:
            break
        power = power[:-bit] * np.uint64(pow(base, bit, 1 << 64)) + power[bit:]
        bit *= 2
    whole = whole ^ (whole >> np.uint64(31))
    whole = whole * np.uint64(0xBF58476D1CE4E5B9)
    return whole ^ (whole >> np.uint64(29))


def _sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    if rest := size - width:
        values = np.minimum(values[:-rest], values[rest:])
    return values


def minimisers(data: np.ndarray, numbers: np.ndarray, length: int = LENGTH, short: int = SHORT) -> np.ndarray:
    """For every window of ``length`` bytes its minimiser, as a number of 48 bits.

    The smallest of many hashes is a small number, so its bits are mixed, one to
    one, and ranges of the result hold about as many minimisers each.
    """
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    for i in range(0, n, CHUNK):
        part = data[i : i + CHUNK + length - 1]
        found = _sliding_least(_string_hashes(part, numbers, short), length - short + 1)
        out[i : i + len(found)] = _mixed(found >> np.uint64(16))
    return out


def _mixed(values: np.ndarray) -> np.ndarray:
    """Other numbers of 48 bits, different for different ones."""
    low = np.uint64((1 << 48) - 1)
    for factor in (0x9E3779B97F4B, 0xBF58476D1CE5):
        values = (values ^ (values >> np.uint64(25))) * np.uint64(factor) & low
    return values ^ (values >> np.uint64(25))


def window_numbers(data: np.ndarray, at: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A number of 48 bits for each string data[i : i + length], i of ``at``; equal strings, equal number."""
    numbers, base = _byte_numbers(), np.uint64(0x9E3779B97F4A7C15)
    out = np.empty(len(at), np.uint64)
    for i in range(0, len(at), CHUNK):
        starts = at[i : i + CHUNK]
        value = np.zeros(len(starts), np.uint64)
        for j in range(length):
            value = value * base + numbers[data[starts + j]]
        out[i : i + len(starts)] = _mixed((value ^ (value >> np.uint64(31))) >> np.uint64(16))
    return out


def _part_of(values: np.ndarray, parts: int) -> np.ndarray:
    """The part of a 48-bit number; parts are ranges, so sorted numbers are sorted by part."""
    return ((values >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


class Block:
    """Runs of windows with one minimiser in the documents of a block."""

    def __init__(self, text: bytes, sizes: np.ndarray, length: int, short: int):
        self.length = length
        self.data = np.frombuffer(text, np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else np.empty(0, np.int64)
        least = minimisers(self.data, _byte_numbers(), length, short)
        n = len(least)
        # windows that start in a document's last length - 1 bytes reach into the next one
        inside = np.zeros(len(self.data) + 1, np.int8)
        whole = sizes >= length
        np.add.at(inside, self.starts[whole], 1)
        np.add.at(inside, (self.starts + sizes - length + 1)[whole], -1)
        inside = np.cumsum(inside, dtype=np.int8)[:n] > 0
        new = np.empty(n, bool)
        if n:
            new[0] = True
            new[1:] = least[1:] != least[:-1]
            first = self.starts[self.starts < n]
            new[first] = True  # a run never goes on in another document
        edge = np.flatnonzero(inside & (new | ~np.concatenate([[False], inside[:-1]]))) if n else np.empty(0, np.int64)
        # a run ends where the next begins or the windows inside end
        stop = np.flatnonzero(~inside)
        following = np.concatenate([edge[1:], [n]]) if len(edge) else edge
        at = np.searchsorted(stop, edge)
        bound = np.concatenate([stop, [n]])[at] if len(edge) else edge
        self.run = edge
        self.count = np.minimum(following, bound) - edge
        self.value = least[edge]
        self.doc = np.searchsorted(self.starts, edge, side="right") - 1
        self.values, self.of = np.unique(self.value, return_inverse=True)

    def in_many(self) -> np.ndarray:
        """For each distinct minimiser whether several documents of the block have it."""
        low = np.full(len(self.values), np.iinfo(np.int64).max)
        high = np.full(len(self.values), -1)
        np.minimum.at(low, self.of, self.doc)
        np.maximum.at(high, self.of, self.doc)
        return low < high

    def further(self) -> np.ndarray:
        """For each distinct minimiser how many distinct runs it has beyond the first.

        Runs are told apart by their first and last windows, which are all of a
        run unless its minimiser stands in it more than once.
        """
        of = np.flatnonzero(np.bincount(self.of, minlength=len(self.values))[self.of] > 1)
        first = window_numbers(self.data, self.run[of], self.length)
        last = window_numbers(self.data, self.run[of] + self.count[of] - 1, self.length)
        told = np.unique(np.stack([self.of[of].astype(np.uint64), first, last]), axis=1)
        found = np.bincount(told[0].astype(np.int64), minlength=len(self.values))
        return np.maximum(found - 1, 0)

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The starts, documents and numbers of the windows of some runs."""
        n = self.count[chosen]
        at = np.arange(n.sum()) + np.repeat(self.run[chosen] - (np.cumsum(n) - n), n)
        return at, np.repeat(self.doc[chosen], n), window_numbers(self.data, at, self.length)


def _opened(row: dict, length: int, short: int) -> tuple[Block, np.ndarray]:
    text, sizes, keys = opened(row)
    return Block(text, sizes, length, short), keys


_SENT = "part int, block long, values binary, many binary, further binary"


def _by_part(block: int, values: np.ndarray, many: np.ndarray, further: np.ndarray, parts: int, first: int = 0) -> pa.RecordBatch:
    """A block's sorted numbers, cut into parts that are numbered from ``first``."""
    edges = np.searchsorted(_part_of(values, parts), np.arange(parts + 1))
    full = np.flatnonzero(np.diff(edges)).tolist()
    cut = [slice(edges[p], edges[p + 1]) for p in full]
    six = values.view(np.uint8).reshape(-1, 8)[:, :6]
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array([first + p for p in full], pa.int32()),
            "block": pa.array([block] * len(full), pa.int64()),
            "values": pa.array([six[c].tobytes() for c in cut], pa.binary()),
            "many": pa.array([np.packbits(many[c]).tobytes() for c in cut], pa.binary()),
            "further": pa.array([packed([further[c]]) if further[c].any() else None for c in cut], pa.binary()),
        }
    )


def _sent_minimisers(written: DataFrame, parts: int, length: int, short: int) -> DataFrame:
    """(part, block, values, many, further): each block's distinct minimisers by part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block, _ = _opened(row, length, short)
            yield _by_part(row["block"], block.values, block.in_many(), block.further(), parts)

    return written.select("block", "keys", "sizes", "texts").mapInArrow(run, _SENT)


def _sent_windows(answered: DataFrame, parts: int, length: int, short: int) -> DataFrame:
    """The same for the numbers of the windows of hot minimisers; their parts follow those of the minimisers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block, _ = _opened(row, length, short)
            _, hot = _told(row["answers"], block.values, parts)
            _, doc, number = block.windows(np.flatnonzero(hot[block.of]))
            values, of = np.unique(number, return_inverse=True)
            low, high = np.full(len(values), np.iinfo(np.int64).max), np.full(len(values), -1)
            np.minimum.at(low, of, doc)
            np.maximum.at(high, of, doc)
            yield _by_part(row["block"], values, low < high, np.zeros(len(values), np.int64), parts, parts)

    return answered.select("block", "keys", "sizes", "texts", "answers").mapInArrow(run, _SENT)


def _shared_bits(hot_runs: int):
    """For each block's numbers of a part, whether another document has them too, and whether they are hot.

    ``bits`` begins with a byte that is 1 if bits of the hot ones follow.
    """

    def run(table: pa.Table) -> pa.Table:
        lists = []
        for x in table.column("values").to_pylist():
            wide = np.zeros((len(x) // 6, 8), np.uint8)
            wide[:, :6] = np.frombuffer(x, np.uint8).reshape(-1, 6)
            lists.append(wide.view(np.uint64).ravel())
        sizes = np.array(list(map(len, lists)))
        many = np.concatenate(
            [np.unpackbits(np.frombuffer(b, np.uint8))[:n].astype(bool) for b, n in zip(table.column("many").to_pylist(), sizes)]
        )
        values, of, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        shared = counts > 1
        shared[of[many]] = True
        further, begins = np.zeros(len(values), np.int64), np.cumsum(sizes) - sizes
        for blob, begin, n in zip(table.column("further").to_pylist(), begins.tolist(), sizes.tolist()):
            if blob is not None:
                further[of[begin : begin + n]] += unpacked(blob, 1)[0][0]
        hot = further > hot_runs
        bits = [
            b"\x01" + np.packbits(shared[x]).tobytes() + np.packbits(hot[x]).tobytes()
            if hot[x].any()
            else b"\x00" + np.packbits(shared[x]).tobytes()
            for x in np.split(of, begins[1:])
        ]
        return pa.table({"block": table.column("block"), "part": table.column("part"), "bits": pa.array(bits, pa.binary())})

    return run


def _told(answers: list[dict], values: np.ndarray, parts: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each of a block's sorted numbers whether it is shared and whether it is hot, from the parts from ``first`` on."""
    edges = np.searchsorted(_part_of(values, parts), np.arange(parts + 1))
    shared, hot = np.zeros(len(values), bool), np.zeros(len(values), bool)
    for answer in answers:
        p = answer["part"] - first
        if 0 <= p < parts:
            n, bits = edges[p + 1] - edges[p], np.frombuffer(answer["bits"], np.uint8)
            end = 1 + -(-n // 8)
            shared[edges[p] : edges[p + 1]] = np.unpackbits(bits[1:end])[:n]
            if bits[0]:
                hot[edges[p] : edges[p + 1]] = np.unpackbits(bits[end:])[:n]
    return shared, hot


def _sent_runs(answered: DataFrame, parts: int, length: int, short: int, places: bool = False) -> DataFrame:
    """Distinct runs of each block whose minimiser several documents share, by part, with their bytes.

    Runs of hot minimisers are cut into windows, and those that several
    documents share are sent, under the windows' own numbers.

    ``runs`` packs, for each run, bits of its minimiser, its smallest key and its
    size.  With ``places`` a block gives instead, as part -1, the places of
    the runs: part, number of the run there, document, start and size.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block, keys = _opened(row, length, short)
            shared, hot = _told(row["answers"], block.values, parts)
            chosen = np.flatnonzero((shared & ~hot)[block.of])
            found = [(block.run[chosen], block.count[chosen], block.doc[chosen], block.value[chosen])]
            if hot.any():
                at, doc, number = block.windows(np.flatnonzero(hot[block.of]))
                values, of = np.unique(number, return_inverse=True)
                both = _told(row["answers"], values, parts, parts)[0][of]
                found.append((at[both], np.ones(both.sum(), np.int64), doc[both], number[both]))
            start, count, doc, value = map(np.concatenate, zip(*found))
            order = np.argsort(value, kind="stable")
            start, count, doc, value = start[order], count[order], doc[order], value[order]
            ends = np.searchsorted(_part_of(value, parts), np.arange(parts + 1))
            full = np.flatnonzero(np.diff(ends)).tolist()
            raw, runs, numbers = block.data.tobytes(), [], []
            for p in full:
                mine = slice(ends[p], ends[p + 1])
                sizes = count[mine] + length - 1
                ids: dict[bytes, int] = {}
                of = np.array([ids.setdefault(raw[a : a + s], len(ids)) for a, s in zip(start[mine].tolist(), sizes.tolist())], np.int64)
                if places:
                    numbers.append(of)
                    continue
                least, told = np.full(len(ids), NO_KEY), np.empty(len(ids), np.uint64)
                np.minimum.at(least, of, keys[doc[mine]])
                told[of] = value[mine]
                # a part is a range of minimisers, so the low bits tell most of them apart
                low = (told & np.uint64(0xFFFFFFFF)).astype(np.int64)
                runs.append(packed([low, least, np.array(list(map(len, ids)), np.int64)], b"".join(ids)))
            if places:
                part = np.repeat(full, np.diff(ends)[full]).astype(np.int64)
                number = np.concatenate([np.empty(0, np.int64), *numbers])
                full = [-1]
                runs = [packed([part, number, doc, start - block.starts[doc], count + length - 1])]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(full, pa.int32()),
                    "block": pa.array([row["block"]] * len(full), pa.int64()),
                    "runs": pa.array(runs, pa.binary()),
                }
            )

    chosen = answered.select("block", "keys", "sizes", "texts", "answers")
    return chosen.mapInArrow(run, "part int, block long, runs binary")


def _words(data: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """The bytes data[at : at + size] as big-endian numbers of up to 8 bytes each."""
    out = []
    for i in range(0, size, 8):
        value = np.zeros(len(at), np.uint64)
        for j in range(i, min(i + 8, size)):
            value = (value << np.uint64(8)) | data[at + j]
        out.append(value)
    return out


def _shift_table() -> np.ndarray:
    """For two residues the smallest shift that takes both into the cover."""
    return np.array(
        [
            [next(k for k in range(PERIOD) if (a + k) % PERIOD in COVER and (b + k) % PERIOD in COVER) for b in range(PERIOD)]
            for a in range(PERIOD)
        ]
    )


def cover_ranks(data: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Ranks of the cover sample: equal exactly where ``size`` bytes from there are equal.

    ``ends`` gives for every position the end of its string; positions with
    fewer bytes left, and those outside the sample, have rank -1.
    """
    at = np.flatnonzero(np.isin(np.arange(len(ends)) % PERIOD, COVER) & (np.arange(len(ends)) + size <= ends))
    ranks = np.full(len(ends), -1, np.int64)
    if len(at):
        words = _words(data, at, size)
        order = np.lexsort(words[::-1])
        differs = np.zeros(len(at), bool)
        for w in words:
            w = w[order]
            differs[1:] |= w[1:] != w[:-1]
        ranks[at[order]] = np.cumsum(differs)
    return ranks


def equal_windows(data: np.ndarray, ends: np.ndarray, windows: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every window (its start) the number of its class; equal bytes, equal class.

    One bucket of the suffixes, a range of first two bytes, is sorted at a time:
    by the first ``DEPTH`` and the last ``PERIOD - 1`` bytes.  What is still
    tied is compared with the first of its tie by the sample's ranks, at the
    shift at which both are in the sample.
    """
    tail = PERIOD - 1
    if length < DEPTH + tail:
        raise ValueError(f"windows must have at least {DEPTH + tail} bytes")
    padded = np.concatenate([data, np.zeros(length, np.uint8)])
    ranks = cover_ranks(padded, ends, length - tail)
    shifts = _shift_table()
    classes, made = np.empty(len(windows), np.int64), 0
    lead = (padded[windows].astype(np.int64) << 8) | padded[windows + 1]
    by_lead = np.argsort(lead, kind="stable")
    # neighbouring leads share a bucket of about BUCKET suffixes; a lead is never divided
    begins = np.concatenate([[0], np.flatnonzero(np.diff(lead[by_lead])) + 1])
    for bucket in np.split(by_lead, begins[1:][np.diff(begins // BUCKET) > 0]):
        at = windows[bucket]
        columns = [*_words(padded, at, DEPTH), *_words(padded, at + length - tail, tail)]
        order = np.lexsort(columns[::-1])
        differs = np.ones(len(at), bool)
        differs[1:] = False
        for c in columns:
            c = c[order]
            differs[1:] |= c[1:] != c[:-1]
        tie = np.cumsum(differs) - 1
        at, own = at[order], np.full(len(at), -1, np.int64)
        open_ = np.arange(len(at))
        while len(open_):
            ties = tie[open_]
            first = np.ones(len(open_), bool)
            first[1:] = ties[1:] != ties[:-1]
            leader = open_[first][np.cumsum(first) - 1]
            k = shifts[at[open_] % PERIOD, at[leader] % PERIOD]
            same = (open_ == leader) | (ranks[at[open_] + k] == ranks[at[leader] + k])
            own[open_[same]] = leader[same]
            open_ = open_[~same]
        classes[bucket[order]] = made + own
        made += len(at)
    return classes


def _removed(table: pa.Table, length: int) -> dict[str, np.ndarray]:
    """Byte ranges (block, run, offset, size) to remove from the runs the blocks sent, found in one part."""
    sent = [unpacked(x, 3) for x in table.column("runs").to_pylist()]
    value, key, size = (np.concatenate(x) for x in zip(*[arrays for arrays, _ in sent]))
    texts = b"".join(text for _, text in sent)
    each = [len(arrays[0]) for arrays, _ in sent]
    number = np.concatenate([np.arange(n) for n in each])
    block = np.repeat(np.array(table.column("block").to_pylist(), np.int64), each)
    del sent
    begin = np.cumsum(size) - size
    # distinct runs, and the smallest document of each
    ids: dict[bytes, int] = {}
    of = np.array([ids.setdefault(texts[a : a + s], len(ids)) for a, s in zip(begin.tolist(), size.tolist())], np.int64)
    least = np.full(len(ids), NO_KEY)
    np.minimum.at(least, of, key)
    later = key > least[of]
    found = [(block[later], number[later], np.zeros(later.sum(), np.int64), size[later])]
    # only runs of one minimiser can share windows; a minimiser with one run has nothing to sort
    run_value = np.empty(len(ids), np.int64)
    run_value[of] = value
    _, group, members = np.unique(run_value, return_inverse=True, return_counts=True)
    sorted_runs = np.flatnonzero(members[group] > 1)
    if len(sorted_runs):
        runs = list(ids)
        mine = [runs[r] for r in sorted_runs.tolist()]
        sizes = np.array(list(map(len, mine)))
        data = np.frombuffer(b"".join(mine), np.uint8)
        begins = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        run = np.repeat(np.arange(len(mine)), counts)
        windows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begins[run]
        classes = equal_windows(data, np.repeat(begins + sizes, sizes), windows, length)
        own = least[sorted_runs][run]
        smallest = np.full(classes.max() + 1, NO_KEY)
        np.minimum.at(smallest, classes, own)
        out = np.flatnonzero(smallest[classes] < own)
        if len(out):
            # ranges of neighbouring windows in one run
            breaks = np.flatnonzero((np.diff(out) != 1) | (np.diff(run[out]) != 0)) + 1
            first, last = out[np.concatenate([[0], breaks])], out[np.concatenate([breaks - 1, [len(out) - 1]])]
            range_run = sorted_runs[run[first]]
            offset, spread = windows[first] - begins[run[first]], last - first + length
            # for the blocks that have these runs in their smallest document
            place = np.flatnonzero(~later)
            place = place[np.argsort(of[place], kind="stable")]
            low, high = np.searchsorted(of[place], range_run), np.searchsorted(of[place], range_run, side="right")
            n = high - low
            which = np.repeat(np.arange(len(first)), n)
            target = place[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
            found.append((block[target], number[target], offset[which], spread[which]))
    return {name: np.concatenate(x) for name, x in zip(("block", "run", "offset", "size"), zip(*found))}


def _ranges(length: int):
    def run(table: pa.Table) -> pa.Table:
        found = _removed(table, length)
        order = np.argsort(found["block"], kind="stable")
        names, first = np.unique(found["block"][order], return_index=True)
        pieces = [np.split(found[c][order], first[1:]) if len(names) else [] for c in ("run", "offset", "size")]
        ranges = [packed(list(x)) for x in zip(*pieces)]
        part = pa.array([table.column("part")[0].as_py()] * len(names), pa.int32())
        return pa.table({"block": pa.array(names, pa.int64()), "part": part, "ranges": pa.array(ranges, pa.binary())})

    return run


def _answers(sent: DataFrame, hot_runs: int) -> DataFrame:
    return sent.groupBy("part").applyInArrow(_shared_bits(hot_runs), "block long, part int, bits binary")


def _by_block(bits: DataFrame) -> DataFrame:
    return bits.groupBy("block").agg(F.collect_list(F.struct("part", "bits")).alias("answers"))


def suffix_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    short: int = SHORT,
    block_bytes: int = BLOCK_BYTES,
    hot_runs: int = HOT_RUNS,
) -> DataFrame:
    """Removes every byte in a ``length``-byte string that also starts in a document of smaller key.

    Returns the key (as a long), ``n_bytes``, ``spans`` (maximal removed
    [start, end) in bytes) and ``clean`` (the remaining bytes; a cut may fall
    inside a character).  Strings are judged on the input and never cross
    documents.  ``hot_runs`` sets when the runs of a minimiser are cut into
    windows, not what is found.

    A null or empty text has no bytes; a text shorter than ``length`` stays.  A
    null key is larger than any other.  Rows of one key are no earlier than each
    other, so repeated rows are treated alike.  An empty table gives an empty
    result; other columns are not read.
    """
    written, parts = stored_blocks(docs, key, text, block_bytes, PART_BYTES)
    bits = stored(_answers(_sent_minimisers(written, parts, length, short), hot_runs), "bits")
    hot = _by_block(bits.where(F.substring("bits", 1, 1) == F.lit(b"\x01")))
    more = stored(_answers(_sent_windows(written.join(hot, "block"), parts, length, short), hot_runs), "bits")
    answered = written.join(_by_block(bits.union(more)), "block")
    ranges = (
        _sent_runs(answered, parts, length, short)
        .groupBy("part")
        .applyInArrow(_ranges(length), "block long, part int, ranges binary")
    )
    # the places go straight back to their block
    places = _sent_runs(answered, parts, length, short, places=True).select("block", "part", F.col("runs").alias("ranges"))
    ranges = ranges.union(places).groupBy("block").agg(F.collect_list(F.struct("part", "ranges")).alias("answers"))

    def spans(answers, text, sizes, keys) -> Spans:
        found: Spans = {}
        sent = {answer["part"]: answer["ranges"] for answer in answers}
        if -1 not in sent:
            return found
        part, number, doc, start, size = unpacked(sent.pop(-1), 5)[0]
        order = np.lexsort((number, part))
        part, number, doc, start, size = (x[order] for x in (part, number, doc, start, size))
        new = np.ones(len(part), bool)
        new[1:] = (part[1:] != part[:-1]) | (number[1:] != number[:-1])
        first = np.flatnonzero(new)
        bounds = np.append(first, len(part))
        of = np.cumsum(new) - 1
        least = np.full(len(first), NO_KEY)
        np.minimum.at(least, of, keys[doc])
        # a run that an earlier document of the block has goes whole
        later = keys[doc] > least[of]
        whole = zip(doc[later].tolist(), start[later].tolist(), size[later].tolist())
        for d, a, n in whole:
            found.setdefault(d, []).append((a, a + n))
        parts_at = part[first]
        for p, blob in sent.items():
            base = np.searchsorted(parts_at, p)
            for run, offset, n in zip(*[x.tolist() for x in unpacked(blob, 3)[0]]):
                for i in range(bounds[base + run], bounds[base + run + 1]):
                    if not later[i]:
                        a = int(start[i]) + offset
                        found.setdefault(int(doc[i]), []).append((a, a + n))
        return found

    return cleaned(written.join(ranges, "block", "left"), key, spans)
