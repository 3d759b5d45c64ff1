"""Repeated passages, by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where the hash's upper bits are
all zero, so cuts depend on the last few bytes only and settle again soon after
an insertion.  Chunks are compared by digest: the first place of each stays and
all others go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.blocks import BLOCK_BYTES, Spans, cleaned, opened, packed, rows_of, stored_blocks, unpacked

AVERAGE_BITS = 5  # a cut at every 32nd byte on average: short enough to fit in passages of 50 words
LEAST, MOST = 8, 512
LEAST_RUN = 64
REACH = 32  # bytes a hash depends on


def gear_table() -> np.ndarray:
    """256 numbers of 32 bits, the same everywhere: the start of each byte's MD5."""
    return np.array([int.from_bytes(hashlib.md5(bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)


def gear_hashes(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """h[i] = (h[i - 1] << 1) + table[data[i]] modulo 2 ** 32, for all i at once.

    After 32 bytes a byte has left the hash, so it is a sum over 32 places,
    built by doubling.
    """
    h = table[data]
    step = 1
    while step < REACH:
        # h[i] covers `step` bytes that end at i; the older half moves up by as many bits
        older = h[:-step] << np.uint32(step)
        h[step:] += older
        step *= 2
    return h


def cuts(text: bytes, table: np.ndarray, bits: int = AVERAGE_BITS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks, the last being the text's length.

    A chunk has at least ``least`` and at most ``most`` bytes; the last may be
    shorter.
    """
    if not text:
        return []
    # the upper bits depend on all of the last 32 bytes
    mask = np.uint32(((1 << bits) - 1) << (32 - bits))
    ends = (np.flatnonzero((gear_hashes(np.frombuffer(text, np.uint8), table) & mask) == 0) + 1).tolist()
    found, start = [], 0
    for end in [*ends, len(text)]:
        while end - start > most:
            start += most
            found.append(start)
        if end - start >= least or end == len(text) and end > start:
            found.append(end)
            start = end
    return found


class Chunks:
    """All chunks of a block's documents, and their distinct digests."""

    def __init__(self, text: bytes, sizes: np.ndarray, keys: np.ndarray, bits: int, least: int, most: int):
        table, begins = gear_table(), (np.cumsum(sizes) - sizes).tolist()
        doc, start, end, digests = [], [], [], []
        for i, (begin, size) in enumerate(zip(begins, sizes.tolist())):
            whole, a = text[begin : begin + size], 0
            for b in cuts(whole, table, bits, least, most):
                doc.append(i)
                start.append(a)
                end.append(b)
                digests.append(hashlib.blake2b(whole[a:b], digest_size=12).digest())
                a = b
        both = np.frombuffer(b"".join(digests), [("d", "<i8"), ("e", "<i4")])
        d, e = both["d"].copy(), both["e"].astype(np.int64)
        self.doc, self.start, self.end = (np.array(x, np.int64) for x in (doc, start, end))
        key = keys[self.doc] if len(doc) else np.empty(0, np.int64)
        order = np.lexsort((self.start, self.doc, key, e, d.view(np.uint64)))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(d[order]) != 0) | (np.diff(e[order]) != 0)
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        first = order[new]
        # per distinct digest: its two numbers and the smallest key in the block
        self.d, self.e, self.key = d[first], e[first], key[first]
        # an earlier chunk of the same document, or a document of smaller key in the block
        again = np.zeros(len(order), bool)
        again[1:] = ~new[1:] & (np.diff(self.doc[order]) == 0)
        self.repeated = np.empty(len(order), bool)
        self.repeated[order] = again
        self.repeated |= key > self.key[self.of] if len(order) else False

    def edges(self, parts: int) -> np.ndarray:
        """Where each part begins among the distinct digests, which are in order of d."""
        part = (self.d.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        return np.searchsorted(part.astype(np.int64), np.arange(parts + 1))


def _sent_digests(written: DataFrame, parts: int, *sizes_of_chunks: int) -> DataFrame:
    """(part, block, digests): each block's distinct digests with their smallest keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            found = Chunks(*opened(row), *sizes_of_chunks)
            edges = found.edges(parts)
            full = np.flatnonzero(np.diff(edges)).tolist()
            sent = [packed([x[edges[p] : edges[p + 1]] for x in (found.d, found.e, found.key)]) for p in full]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(full, pa.int32()),
                    "block": pa.array([row["block"]] * len(full), pa.int64()),
                    "digests": pa.array(sent, pa.binary()),
                }
            )

    return written.mapInArrow(run, "part int, block long, digests binary")


def _earlier(table: pa.Table) -> pa.Table:
    """For each block's digests of a part, whether another block has a smaller key with them."""
    sent = [unpacked(x, 3)[0] for x in table.column("digests").to_pylist()]
    d, e, key = (np.concatenate(x) for x in zip(*sent))
    order = np.lexsort((key, e, d))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(d[order]) != 0) | (np.diff(e[order]) != 0)
    least = key[order][new][np.cumsum(new) - 1]
    earlier = np.empty(len(order), bool)
    earlier[order] = least < key[order]
    ends = np.cumsum([len(x[0]) for x in sent])
    bits = [np.packbits(x).tobytes() for x in np.split(earlier, ends[:-1])]
    return pa.table({"block": table.column("block"), "part": table.column("part"), "bits": pa.array(bits, pa.binary())})


def chunk_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    bits: int = AVERAGE_BITS,
    least: int = LEAST,
    most: int = MOST,
    least_run: int = LEAST_RUN,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Removes chunks that an earlier place holds, in runs of ``least_run`` bytes or more.

    A place is earlier if its document has a smaller key, or if it comes before
    in the same document.  Blocks of documents send each distinct digest once,
    so a chunk that a third of all documents hold is one entry per block, and
    get one bit back for each.  Neighbouring repeated chunks form a run; shorter
    runs stay.

    Returns the key (as a long), ``n_bytes``, ``spans`` (removed [start, end) in
    bytes) and ``clean`` (the remaining bytes; a cut may fall inside a
    character).  A null or empty text has no chunks and an empty rest.  A null
    key is larger than any other.  Rows of one key are no earlier than each
    other, so repeated rows are treated alike.  An empty table gives an empty
    result; other columns are not read.
    """
    written, parts = stored_blocks(docs, key, text, block_bytes)
    answers = (
        _sent_digests(written, parts, bits, least, most)
        .groupBy("part")
        .applyInArrow(_earlier, "block long, part int, bits binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("part", "bits")).alias("answers"))
    )

    def spans(answers, whole, sizes, keys) -> Spans:
        found = Chunks(whole, sizes, keys, bits, least, most)
        edges, earlier = found.edges(parts), np.zeros(len(found.d), bool)
        for answer in answers:
            c = slice(edges[answer["part"]], edges[answer["part"] + 1])
            earlier[c] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8))[: c.stop - c.start]
        gone = np.flatnonzero(found.repeated | earlier[found.of]) if len(found.of) else found.of
        doc, start, end = found.doc[gone], found.start[gone], found.end[gone]
        # a run goes on where the next chunk of the same document begins at its end
        new = np.ones(len(gone), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != end[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(gone))[: len(first)] - 1
        out: Spans = {}
        for i, a, b in zip(doc[first].tolist(), start[first].tolist(), end[last].tolist()):
            if b - a >= least_run:
                out.setdefault(i, []).append((a, b))
        return out

    return cleaned(written.join(answers, "block", "left"), key, spans)
