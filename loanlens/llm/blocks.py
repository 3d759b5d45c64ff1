"""Documents in blocks, for operators that exchange small arrays about large texts.

A block holds a few megabytes of whole documents, compressed, in one row that
is written once.  An operator sends what it needs to compare as packed arrays,
a row for each block and part, and gets its answers back by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import as_bytes, partitions, slices
from loanlens.session import stored

BLOCK_BYTES = 4 << 20
PART_BYTES = 32 << 20  # of text whose entries meet in a part
NO_KEY = np.iinfo(np.int64).max


def packed(arrays: list[np.ndarray], text: bytes = b"") -> bytes:
    """Arrays of one length, each in as few bytes as its spread needs, and a text; compressed."""
    out = [len(arrays[0]).to_bytes(8, "little")]
    for values in arrays:
        low = int(values.min()) if len(values) else 0
        spread = values.astype(np.int64).view(np.uint64) - np.uint64(low % 2**64)
        spread = spread.astype(np.min_scalar_type(int(spread.max()) if len(spread) else 0))
        # bytes of one weight side by side compress better
        planes = spread.view(np.uint8).reshape(len(spread), -1).T.tobytes() if len(spread) else b""
        out += [bytes([spread.itemsize]), low.to_bytes(8, "little", signed=True), planes]
    return zstandard.ZstdCompressor(3).compress(b"".join([*out, text]))


def unpacked(blob: bytes, arrays: int) -> tuple[list[np.ndarray], bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for _ in range(arrays):
        width, low = data[at], int.from_bytes(data[at + 1 : at + 9], "little", signed=True)
        at += 9
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T
        out.append((wide.view(np.uint64).ravel() + np.uint64(low % 2**64)).view(np.int64))
        at += n * width
    return out, data[at:]


def parts_for(written: DataFrame, part_bytes: int) -> int:
    """A number of parts for blocks with a column ``n_bytes``: as many as the text fills, whatever the number of blocks.

    A block sends at most a row to each part, so below ``part_bytes`` for each
    shuffle partition the rows grow with the blocks alone.
    """
    total = written.agg(F.sum("n_bytes")).first()[0] or 0
    return max(partitions(written.sparkSession), -(-total // part_bytes))


def stored_blocks(
    docs: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES
) -> tuple[DataFrame, int]:
    """Documents in scan order as rows (block, n_bytes, keys, sizes, texts), and a number of parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, number = zstandard.ZstdCompressor(3), TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", block_bytes):
            texts = as_bytes(batch.column("text")).to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([number], pa.int64()),
                    "n_bytes": pa.array([sum(map(len, texts))], pa.int64()),
                    "keys": pa.array([batch.column("key").to_pylist()], pa.list_(pa.int64())),
                    "sizes": pa.array([np.array(list(map(len, texts)), np.int64).tobytes()], pa.binary()),
                    "texts": pa.array([packer.compress(b"".join(texts))], pa.binary()),
                }
            )
            number += 1

    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    written = stored(slim.mapInArrow(run, "block long, n_bytes long, keys array<long>, sizes binary, texts binary"), "blocks")
    return written, parts_for(written, part_bytes)


def opened(row: dict) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The text, the documents' sizes and their keys; a null key is larger than any other."""
    text = zstandard.ZstdDecompressor().decompress(row["texts"])
    keys = np.array([NO_KEY if k is None else k for k in row["keys"]], np.int64)
    return text, np.frombuffer(row["sizes"], np.int64), keys


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


Spans = dict[int, list[tuple[int, int]]]


def cleaned(answered: DataFrame, key: str, spans_of: Callable[..., Spans]) -> DataFrame:
    """(key, n_bytes, spans, clean) per document, from what ``spans_of`` a block removes.

    ``spans_of`` gets a block's answers, text, sizes and keys, and returns, by
    number of the document, the byte ranges [start, end) to remove, in any
    order; they are merged here.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            text, sizes, keys = opened(row)
            starts, ranges = np.cumsum(sizes) - sizes, spans_of(row["answers"] or (), text, sizes, keys)
            spans, rest = [], []
            for doc, (begin, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
                merged: list[list[int]] = []
                for a, b in sorted(ranges.get(doc, ())):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                left, done = [], 0
                for a, b in merged:
                    left.append(text[begin + done : begin + a])
                    done = b
                left.append(text[begin + done : begin + size])
                spans.append(merged)
                rest.append(b"".join(left))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["keys"], pa.int64()),
                    pa.array(sizes),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                    pa.array(rest, pa.binary()),
                ],
                [key, "n_bytes", "spans", "clean"],
            )

    schema = f"`{key}` long, n_bytes long, spans array<array<long>>, clean binary"
    return answered.select("keys", "sizes", "texts", "answers").mapInArrow(run, schema)
