"""Language-model scoring by cross-entropy difference.

Two bigram models of the same order, smoothing and vocabulary are counted over
all documents: one on the target documents, one on all.  The background counts
are scaled to the number of target tokens, so smoothing weighs alike in both.
A document's score is the mean over its tokens of background loss less target
loss: the higher, the more it reads like the target.

Every word of the documents is in the vocabulary, and the counts stay in Spark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.blocks import packed, parts_for, rows_of, unpacked
from loanlens.llm.common import as_bytes, slices
from loanlens.session import stored

WEIGHT = 0.7  # of the bigram estimate, against the unigram's
ADDED = 0.5  # to every word count
BLOCK_BYTES = 8 << 20  # of text
PART_BYTES = 8 << 20  # of text whose words and bigrams meet in a part


def words_of(text: bytes) -> list[bytes]:
    """Words between blanks, with ASCII letters lower-cased."""
    return text.lower().split()


def _token_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(row, key, text) in scan order as rows (block, n_bytes, keys, rows, sizes, words, tokens); tokens number the block's words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, number = zstandard.ZstdCompressor(3), TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", block_bytes):
            ids: dict[bytes, int] = {}
            tokens: list[np.ndarray] = []
            texts = as_bytes(batch.column("text")).to_pylist()
            for t in texts:
                tokens.append(np.array([ids.setdefault(w, len(ids)) for w in words_of(t)], np.int32))
            some = batch.select(["row"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, some.schema) as out:
                out.write_batch(some)
            keys = batch.column("key")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([sum(map(len, texts))], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                    pa.array([packer.compress(sink.getvalue().to_pybytes())], pa.binary()),
                    pa.array([np.array(list(map(len, tokens)), np.int64).tobytes()], pa.binary()),
                    pa.array([packer.compress(b" ".join(ids))], pa.binary()),
                    pa.array([packed([np.concatenate(tokens)])], pa.binary()),
                ],
                ["block", "n_bytes", "keys", "rows", "sizes", "words", "tokens"],
            )
            number += 1

    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("keys", T.ArrayType(docs.schema["key"].dataType)),
            *[T.StructField(c, T.BinaryType()) for c in ("rows", "sizes", "words", "tokens")],
        ]
    )
    return stored(docs.mapInArrow(run, schema), "token_blocks")


def _by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by part, the bounds of the parts in it, and the parts that have something."""
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    return order, bounds, np.flatnonzero(np.diff(bounds))


def _words_by_part(row: dict, parts: int):
    words = zstandard.ZstdDecompressor().decompress(row["words"]).split()
    return words, *_by_part(np.array([zlib.crc32(w) % parts for w in words], np.int64), parts)


def _word_numbers(written: DataFrame, parts: int) -> DataFrame:
    """(block, part, ids, n): numbers from 1 for the words each block sent to a part, which numbers n words."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            words, order, bounds, full = _words_by_part(row, parts)
            blobs = [b" ".join(words[i] for i in order[bounds[p] : bounds[p + 1]].tolist()) for p in full.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([row["block"]] * len(full), pa.int64()), pa.array(blobs, pa.binary())],
                ["part", "block", "words"],
            )

    def number(table: pa.Table) -> pa.Table:
        part, known = table.column("part")[0].as_py(), {}
        ids = [
            packed([np.array([known.setdefault(w, len(known)) for w in blob.split()], np.int64) * parts + part + 1])
            for blob in table.column("words").to_pylist()
        ]
        return pa.table(
            {
                "block": table.column("block"),
                "part": table.column("part"),
                "ids": pa.array(ids, pa.binary()),
                "n": pa.array([len(known)] * len(ids), pa.int64()),
            }
        )

    sent = written.select("block", "words").mapInArrow(send, "part int, block long, words binary")
    return sent.groupBy("part").applyInArrow(number, "block long, part int, ids binary, n long")


def _numbered(written: DataFrame, marks: DataFrame, numbers: DataFrame, parts: int) -> DataFrame:
    """(block, rows, sizes, tokens, target, ids, n, n_target): blocks with their words' numbers and target documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            words, order, bounds, _ = _words_by_part(row, parts)
            ids = np.empty(len(words), np.int64)
            for answer in row["numbers"] or ():
                p = answer["part"]
                ids[order[bounds[p] : bounds[p + 1]]] = unpacked(answer["ids"], 1)[0][0]
            sizes = np.frombuffer(row["sizes"], np.int64)
            target = np.zeros(len(sizes), bool)
            target[row["places"] or []] = True
            out = {c: [row[c]] for c in ("block", "rows", "sizes", "tokens")}
            out |= {"target": [target.tobytes()], "ids": [packed([ids])], "n": [int(sizes.sum())], "n_target": [int(sizes[target].sum())]}
            yield pa.RecordBatch.from_pydict(out, schema)

    binary = ["rows", "sizes", "tokens", "target", "ids"]
    schema = pa.schema([("block", pa.int64()), *[(c, pa.binary()) for c in binary], ("n", pa.int64()), ("n_target", pa.int64())])
    by_block = numbers.groupBy("block").agg(F.collect_list(F.struct("part", "ids")).alias("numbers"))
    joined = written.drop("keys", "n_bytes").join(by_block, "block", "left").join(marks, "block", "left")
    kind = "block long, " + ", ".join(f"{c} binary" for c in binary) + ", n long, n_target long"
    return stored(joined.mapInArrow(run, kind), "numbered_blocks")


class _Counted:
    """Bigram and word counts of a block; number 0 comes before each text's first word."""

    def __init__(self, row: dict, parts: int):
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        tokens = unpacked(row["tokens"], 1)[0][0] + 1
        self.ids = np.concatenate([[0], unpacked(row["ids"], 1)[0][0]])
        n = len(self.ids)
        before = np.zeros(len(tokens), np.int64)
        before[1:] = tokens[:-1]
        begins = np.cumsum(self.sizes) - self.sizes
        before[begins[self.sizes > 0]] = 0
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        is_target = np.frombuffer(row["target"], bool)[self.doc]
        pairs, self.of = np.unique(before * n + tokens, return_inverse=True)
        self.a, self.b = pairs // n, pairs % n
        self.counts = [np.bincount(self.of[is_target], minlength=len(pairs)), np.bincount(self.of, minlength=len(pairs))]
        self.words = [
            np.bincount(x, weights=c, minlength=n).astype(np.int64) for x in (self.a, self.b) for c in self.counts
        ]
        mixed = (self.ids[self.a].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.ids[self.b].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        self.pair_parts = _by_part(((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64), parts)
        self.word_parts = _by_part(self.ids % parts, parts)


def _sent_counts(coded: DataFrame, parts: int) -> DataFrame:
    """(part, block, pairs, words): each block's distinct bigrams and words with their counts, by part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = _Counted(row, parts)
            (pair_order, pair_bounds, some), (word_order, word_bounds, others) = block.pair_parts, block.word_parts
            full = np.union1d(some, others).tolist()
            pairs, words = [], []
            for p in full:
                i = pair_order[pair_bounds[p] : pair_bounds[p + 1]]
                pairs.append(packed([block.ids[block.a[i]], block.ids[block.b[i]], *[c[i] for c in block.counts]]))
                i = word_order[word_bounds[p] : word_bounds[p + 1]]
                words.append(packed([block.ids[i], *[c[i] for c in block.words]]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(full, pa.int32()),
                    pa.array([row["block"]] * len(full), pa.int64()),
                    pa.array(pairs, pa.binary()),
                    pa.array(words, pa.binary()),
                ],
                ["part", "block", "pairs", "words"],
            )

    return coded.mapInArrow(run, "part int, block long, pairs binary, words binary")


def _totals(sent: list[list[np.ndarray]], names: int) -> list[bytes]:
    """For what each block sent, the sums over all blocks, in its order; the first arrays name a thing."""
    columns = [np.concatenate(x) for x in zip(*sent)]
    order = np.lexsort(columns[:names][::-1])
    new = np.zeros(len(order), bool)
    for c in columns[:names]:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new)
    # bincount adds doubles, exact for counts below 2^53
    sums = [np.bincount(of, weights=c).astype(np.int64)[of] for c in columns[names:]]
    cuts = np.cumsum([len(x[0]) for x in sent])[:-1]
    return [packed(list(x)) for x in zip(*[np.split(c, cuts) for c in sums])]


def _answered(table: pa.Table) -> pa.Table:
    pairs = [unpacked(x, 4)[0] for x in table.column("pairs").to_pylist()]
    words = [unpacked(x, 5)[0] for x in table.column("words").to_pylist()]
    return pa.table(
        {
            "block": table.column("block"),
            "part": table.column("part"),
            "pairs": pa.array(_totals(pairs, 2), pa.binary()),
            "words": pa.array(_totals(words, 1), pa.binary()),
        }
    )


def lm_scores(
    docs: DataFrame,
    targets: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    weight: float = WEIGHT,
    added: float = ADDED,
    keep: Sequence[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row`` (a struct of the columns ``keep``, default the key) with ``n_tokens`` and ``score``.

    ``targets`` lists the keys of the target documents; the background is all
    documents.  The vocabulary is every word of the documents, and an entry for
    what precedes a text.  Documents are coded in blocks.  Words get their
    numbers, then bigrams and words their counts, from parts of the word and
    bigram space that grow with the text; a block sends each word and bigram
    once, so a frequent one is no larger than a rare one.  Only two sums of
    tokens and the number of words come to the driver.

    A null or empty text has no tokens and score 0.  A null key is no target;
    repeated rows count and are scored each; listed keys may repeat or be
    missing.  Without any target all scores are 0.  Extra columns are not read;
    an empty table gives an empty result.
    """
    kept = [key] if keep is None else list(keep)
    packed_rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")
    )
    written = _token_blocks(packed_rows, block_bytes)
    parts = parts_for(written, PART_BYTES)
    listed = targets.select(F.col(key).alias("_target")).where("_target is not null").distinct()
    # the list may be long, so the join takes the same form at every size
    places = written.select("block", F.posexplode("keys").alias("place", "_key"))
    marks = places.join(listed.hint("merge"), F.col("_key") == F.col("_target"))
    marks = marks.groupBy("block").agg(F.collect_list("place").alias("places"))
    numbers = stored(_word_numbers(written, parts), "word_numbers")
    size = 1 + (numbers.groupBy("part").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0] or 0)
    coded = _numbered(written, marks, numbers, parts)
    total, all_total = (x or 0 for x in coded.agg(F.sum("n_target"), F.sum("n")).first())
    answers = (
        _sent_counts(coded, parts)
        .groupBy("part")
        .applyInArrow(_answered, "block long, part int, pairs binary, words binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("part", "pairs", "words")).alias("answers"))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = _Counted(row, parts)
            pairs, words = np.zeros((2, len(block.a))), np.zeros((4, len(block.ids)))
            for answer in row["answers"] or ():
                p = answer["part"]
                for out, blob, (order, bounds, _) in (
                    (pairs, answer["pairs"], block.pair_parts),
                    (words, answer["words"], block.word_parts),
                ):
                    out[:, order[bounds[p] : bounds[p + 1]]] = unpacked(blob, len(out))[0]
            difference = np.zeros(len(block.a))
            if total and len(difference):
                (t, g), (ta, ga), (tb, gb) = pairs, words[:2, block.a], words[2:, block.b]
                unigram = (tb + added) / (total + added * size)
                share = np.divide(t, ta, out=np.zeros(len(t)), where=ta > 0)
                near = np.where(ta > 0, weight * share + (1 - weight) * unigram, unigram)
                far = weight * g / ga + (1 - weight) * (gb * (total / all_total) + added) / (total + added * size)
                difference = np.log(near) - np.log(far)
            sums = np.bincount(block.doc, weights=difference[block.of], minlength=len(block.sizes))
            with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(row["rows"])) as stream:
                some = stream.read_next_batch()
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(block.sizes), pa.array(sums / np.maximum(block.sizes, 1))],
                ["row", "n_tokens", "score"],
            )

    schema = T.StructType(
        [packed_rows.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())]
    )
    return coded.join(answers, "block", "left").mapInArrow(run, schema)
