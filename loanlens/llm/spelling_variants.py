"""Spelling variants among frequent words, by blocked Gram matrices of letter counts.

One inserted or deleted letter changes a word's vector of letter counts by a
squared distance of 1, one replaced letter by 2.  Words are put into blocks by
length; the product of two blocks' count matrices gives all their squared
distances at once, and only pairs at a distance of 1 or 2 are verified letter
by letter.  Only blocks of equal or adjacent length can hold such pairs.

Blocks of one length are divided further by how many letters of five fixed
classes a word has: an edit moves at most one letter from one class to another,
so a block meets sixteen kinds of blocks, however the words are spread, and
pairs of other blocks are too far apart.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import LOWER, UPPER
from loanlens.session import stored

MIN_LETTERS = 6
MIN_COUNT = 5
TIMES = 5  # a word's form is at least so much more frequent
BLOCK_WORDS = 1024
BLOCK_BYTES = 1 << 20
RUN = "[a-zÀ-ÿ]+"  # after A-Z are lower-cased

# letters by how common they are, dealt to five classes
CLASSES = ["".join("etaoinsrhldcumfpgwybvkxjqz"[i::5]) for i in range(5)]
CLASSES[4] += "".join(map(chr, range(0xC0, 0x100)))


def counted_words(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    change: Callable[[Column, Column], Column] | None = None,
    min_letters: int = MIN_LETTERS,
) -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z lower-cased, of at least ``min_letters`` code points.

    ``change`` may shorten a run, from its document's key and the run.  A null
    text has none.  Column functions only; occurrences are added up in the map
    tasks.
    """
    runs = F.regexp_extract_all(F.translate(F.col(f"`{text}`"), UPPER, LOWER), F.lit(RUN), 0)
    each = docs.select(F.col(f"`{key}`").alias("_key"), F.explode(runs).alias("_run"))
    word = F.col("_run") if change is None else change(F.col("_key"), F.col("_run"))
    return (
        each.where(F.length("_run") >= min_letters)
        .select(word.alias("word"))
        .where(F.length("word") >= min_letters)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def _neighbours() -> list[list[int]]:
    """What is added to (length, class counts) for the blocks a block meets, each pair of blocks once."""
    k = len(CLASSES)
    steps = [[0] * (k + 1)]
    for x in range(k):
        steps.append([1, *[int(i == x) for i in range(k)]])
        steps += [[0, *[(i == x) - (i == y) for i in range(k)]] for y in range(x)]
    return steps


def letter_blocks(words: DataFrame) -> DataFrame:
    """(block, part, words, counts): the words of a block in even parts of a bounded size."""
    n_of = [F.length("word") - F.length(F.translate("word", letters, "")) for letters in CLASSES]
    placed = words.select("word", "n", F.array(F.length("word"), *n_of).alias("block"))
    # a longer word takes more of a part
    room = F.greatest(F.lit(BLOCK_BYTES // BLOCK_WORDS), F.get("block", 0))
    sizes = placed.groupBy("block").agg(F.ceil(F.count("*") * F.any_value(room) / BLOCK_BYTES).alias("parts"))
    dealt = placed.join(sizes, "block").select(
        "block", "word", "n", F.pmod(F.xxhash64("word"), F.col("parts")).alias("part")
    )
    return dealt.groupBy("block", "part").agg(
        F.collect_list("word").alias("words"), F.collect_list("n").alias("counts")
    )


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points as a matrix, and how often each holds each code point."""
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
    kinds = np.zeros((len(words), 256), np.int64)
    np.add.at(kinds, (np.arange(len(words))[:, None], codes), 1)
    # squares of lengths are exact up to 2^24 in single precision
    return codes, kinds.astype(np.float32 if codes.shape[1] <= 4096 else np.float64)


def near_pairs(a: list[str], b: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of words one edit apart; ``same`` blocks give each pair once.

    The words of a block have one length, and those of ``b`` are as long as
    those of ``a`` or one letter longer.
    """
    (codes, x), (others, y) = _letters(a), _letters(b)
    used = x.any(axis=0) | y.any(axis=0)
    x, y = x[:, used], y[:, used]
    squared = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    longer = others.shape[1] - codes.shape[1]
    close = (squared > 0) & (squared <= 2)
    if same:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    right = np.zeros(len(i), bool)
    step = max(1, BLOCK_BYTES // codes.shape[1])
    for at in range(0, len(i), step):
        p, q = codes[i[at : at + step]], others[j[at : at + step]]
        if longer:
            size = p.shape[1]
            ahead, behind = p != q[:, :size], p != q[:, 1:]
            first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), size)
            last = np.where(behind.any(axis=1), size - 1 - behind[:, ::-1].argmax(axis=1), -1)
            right[at : at + step] = last < first
        else:
            right[at : at + step] = (p != q).sum(axis=1) == 1
    return i[right], j[right]


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every pair of words one edit apart, both ways.

    ``words`` is (word, n), each word once, of code points up to U+00FF.
    """
    blocks = stored(letter_blocks(words), "letter_blocks")
    parts = blocks.groupBy("block").agg(F.max("part").alias("_last"))
    steps = F.array(*[F.array(*[F.lit(s) for s in step]) for step in _neighbours()])
    met = blocks.select(
        F.col("block").alias("a"), F.col("part").alias("i"), F.explode(steps).alias("_step")
    ).select("a", "i", F.zip_with("a", "_step", lambda x, y: x + y).alias("b"))
    pairs = (
        met.join(parts.withColumnRenamed("block", "b"), "b")
        .select("a", "i", "b", F.explode(F.sequence(F.lit(0).cast("long"), "_last")).alias("j"))
        .where((F.col("a") != F.col("b")) | (F.col("i") <= F.col("j")))
    )
    left = blocks.select(F.col("block").alias("a"), F.col("part").alias("i"), F.struct("words", "counts").alias("x"))
    right = blocks.select(F.col("block").alias("b"), F.col("part").alias("j"), F.struct("words", "counts").alias("y"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                x, y = row["x"], row["y"]
                i, j = near_pairs(x["words"], y["words"], row["same"])
                i, j = i.tolist(), j.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x["words"][p] for p in i] + [y["words"][q] for q in j], pa.string()),
                        pa.array([y["words"][q] for q in j] + [x["words"][p] for p in i], pa.string()),
                        pa.array([y["counts"][q] for q in j] + [x["counts"][p] for p in i], pa.int64()),
                    ],
                    ["word", "near", "near_n"],
                )

    # the parts of a frequent block are met one by one, so no key of these joins is hot
    both = pairs.join(left, ["a", "i"]).join(right, ["b", "j"])
    same = (F.col("a") == F.col("b")) & (F.col("i") == F.col("j"))
    return both.select("x", "y", same.alias("same")).mapInArrow(run, "word string, near string, near_n long")


def spelling_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``words`` (word, n).

    Two words are near if one inserted, deleted or replaced code point makes
    them equal.  A word's ``form`` is its near word of largest n (of equal ones
    the smallest by code points) if that is at least ``times`` the word's n,
    else null; ``root`` is where the forms lead, or the word itself.

    Words are distinct, not null and of code points up to U+00FF; ``n`` is
    positive.  A word without near words has ``n_near`` 0.  Extra columns are
    not read; an empty table gives an empty result.  Forms grow ``times`` fold,
    so the largest n bounds how far they lead, and the number of joins.
    """
    words = words.select("word", F.col("n").cast("long").alias("n"))
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    best_n = -F.col("best.less")
    is_form = best_n >= times * F.col("n")
    formed = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, best_n).alias("form_n"),
        ),
        "formed_words",
    )
    most = formed.agg(F.max("form_n")).first()[0]
    rooted = formed.where("form is not null").select("word", F.col("form").alias("root"))
    if most:
        steps = 1 + int(math.log(most, times))
        for _ in range(max(1, steps).bit_length()):
            further = rooted.select(F.col("word").alias("root"), F.col("root").alias("_further"))
            rooted = stored(
                rooted.join(further, "root", "left").select("word", F.coalesce("_further", "root").alias("root")), "roots"
            )
    return formed.join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def drop_letters(key: Column, run: Column, every: int = 199) -> Column:
    """The run without one code point, for one of ``every`` pairs of key and run.

    With h the CRC-32 of ``<key>:<run>``: where h is divisible by ``every``, code
    point h % length goes.  A null key leaves the run as it is.
    """
    h = F.crc32(F.concat(key.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def frequent_words(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """The words with at least ``min_count`` occurrences, written once."""
    return stored(words.where(F.col("n") >= min_count), "frequent_words")
