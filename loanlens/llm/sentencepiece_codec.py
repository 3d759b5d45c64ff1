"""SentencePiece encoding and decoding with the Tokenizers library.

The model file is parsed here, field by field, and rebuilt as a tokenizer: the
normaliser from its character map and flags, the marker for blanks, unigram
scores or ranked merges, and byte fallback.  The result is the same ids as the
SentencePiece library gives, at the speed of batches on several threads.
"""

from __future__ import annotations

import codecs
import functools
import itertools
import os
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MOST_MODEL_BYTES = 64 << 20
THREADS = 2
BATCH_BYTES = 1 << 18
MARK = "▁"

# Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BYTE_CUT = "<0"
UNKNOWN_TEXT = " ⁇ "
BYTE_ERRORS = "loanlens-each-byte"

# a byte that belongs to no character stands for one replacement character, each on its own
codecs.register_error(BYTE_ERRORS, lambda e: ("\ufffd", e.start + 1))


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; strings and messages as bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind == 5:
            value, at = data[at : at + 4], at + 4
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield tag >> 3, value


@dataclass
class Model:
    """What encoding needs of a SentencePiece model."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_mark: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    collapse_blanks: bool = True
    escape_blanks: bool = True
    unknown_text: str = UNKNOWN_TEXT


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in fields(value):
                if n == 3:
                    model.kind = v
                elif n == 24:
                    model.suffix_mark = bool(v)
                elif n == 35:
                    model.byte_fallback = bool(v)
                elif n == 44:
                    model.unknown_text = v.decode()
        elif number == 3:
            for n, v in fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.dummy_prefix = bool(v)
                elif n == 4:
                    model.collapse_blanks = bool(v)
                elif n == 5:
                    model.escape_blanks = bool(v)
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be rebuilt")
    if model.suffix_mark or not model.escape_blanks:
        raise ValueError("models without a leading blank marker are not supported")
    if any(kind == USER for _, _, kind in model.pieces):
        raise ValueError("models with user-defined pieces are not supported")
    if model.kind == UNIGRAM and model.byte_fallback and any(BYTE_CUT in p for p, _, k in model.pieces if k == NORMAL):
        raise ValueError(f"pieces with {BYTE_CUT!r} cannot be told from byte pieces")
    return model


def _merges(model: Model, ids: dict[str, int]) -> list[tuple[str, str]]:
    """All pairs of pieces that make a piece, best score first, then by length of the left part."""
    usable = {p for p, _, kind in model.pieces if kind in (NORMAL, UNUSED)}
    ranked = []
    for piece, score, kind in model.pieces:
        if kind != NORMAL:
            continue
        for i in range(1, len(piece)):
            if piece[:i] in usable and piece[i:] in usable:
                ranked.append((-score, ids[piece], i, piece))
    return [(p[:i], p[i:]) for _, _, i, p in sorted(ranked)]


def build(model: Model):
    """The tokenizer that gives the model's ids."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    ids = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
    unknown = next((i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN), None)
    if model.kind == UNIGRAM:
        # pieces that text must not match get a blank, which no normalised text has
        vocabulary = [(p if kind in (NORMAL, BYTE) else f" {p}", s) for p, s, kind in model.pieces]
        core = models.Unigram(vocabulary, unknown, model.byte_fallback)
    else:
        name = None if unknown is None else model.pieces[unknown][0]
        core = models.BPE(ids, _merges(model, ids), unk_token=name, fuse_unk=True, byte_fallback=model.byte_fallback)
    made = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.collapse_blanks:
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    made.normalizer = normalizers.Sequence(steps)
    cuts = []
    # where no piece goes on past a blank, the text can be cut before blanks, and words are cached
    if not any(MARK in piece.lstrip(MARK) for piece, _, kind in model.pieces if kind == NORMAL):
        cuts.append(pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated"))
    if model.kind == UNIGRAM and model.byte_fallback:  # a byte piece's name in a text is ordinary text
        cuts.append(pre_tokenizers.Split(Regex("<(?=0x[0-9A-F]{2}>)"), "isolated"))
    if cuts:
        made.pre_tokenizer = pre_tokenizers.Sequence(cuts)
    parts = [decoders.Replace(MARK, " ")]
    if model.byte_fallback:
        parts.append(decoders.ByteFallback())
    parts.append(decoders.Fuse())
    if model.dummy_prefix or model.collapse_blanks:
        parts.append(decoders.Strip(" ", 1 << 30 if model.collapse_blanks else 1, 0))
    made.decoder = decoders.Sequence(parts)
    return made


def byte_ids(model: Model) -> np.ndarray:
    return np.array([kind == BYTE for _, _, kind in model.pieces], bool)


def piece_bytes(model: Model) -> list[bytes]:
    """What each id stands for in decoded text: a byte piece's byte, nothing for control, else the piece with blanks."""

    def one(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return (model.unknown_text if kind == UNKNOWN else piece.replace(MARK, " ")).encode()

    return [one(piece, kind) for piece, _, kind in model.pieces]


class Codec:
    """A model made ready for a worker."""

    def __init__(self, data: bytes):
        self.model = parse_model(data)
        self.made, self.is_byte = build(self.model), byte_ids(self.model)
        self._bytes = piece_bytes(self.model)
        self._control = {i for i, (_, _, kind) in enumerate(self.model.pieces) if kind == CONTROL}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.made.encode_batch_fast(texts, add_special_tokens=False)]

    def _blanks_before(self, ids: list[int]) -> int:
        """How many blanks at the start are markers and no text: one of the first piece that is not empty.

        Where blanks are collapsed, a piece that is a marker and nothing else
        leaves the next one at the start, too.
        """
        if not (self.model.dummy_prefix or self.model.collapse_blanks):
            return 0
        cut = 0
        for i in ids:
            piece, _, kind = self.model.pieces[i]
            if kind == CONTROL:
                continue
            if kind in (UNKNOWN, BYTE) or not piece.startswith(MARK):
                break
            cut += 1
            if not self.model.collapse_blanks or piece != MARK:
                break
        return cut

    def decode(self, ids: list[int]) -> str:
        """The text of ids of any origin, as the SentencePiece library gives it.

        Control ids give nothing, an unknown one the model's own sign for it,
        and bytes that make no character a replacement character each.
        """
        parts = [ids]
        if not self._control.isdisjoint(ids):  # bytes on both sides of a control id make no character
            parts = [list(part) for control, part in itertools.groupby(ids, self._control.__contains__) if not control]
        text = "".join(b"".join([self._bytes[i] for i in part]).decode("utf-8", BYTE_ERRORS) for part in parts)
        return text[self._blanks_before(ids) :]

    def has(self, ids: list[int | None]) -> bool:
        return all(i is not None and 0 <= i < len(self._bytes) for i in ids)

    def plain(self, text: str) -> str:
        """The normalised text, as decoding should give it."""
        if not self.model.charsmap and not self.model.collapse_blanks:
            return text.replace(MARK, " ")
        found = self.made.normalizer.normalize_str(text).replace(MARK, " ")
        return found.lstrip(" ") if self.model.collapse_blanks else found[self.model.dummy_prefix :]


@functools.lru_cache(maxsize=1)
def _ready(data: bytes) -> Codec:
    """Built once in a worker, for all its tasks."""
    return Codec(data)


def model_bytes(path: str = MODEL) -> bytes:
    """The model file, of a checked size, as it goes to the executors."""
    if (size := os.path.getsize(path)) > MOST_MODEL_BYTES:
        raise ValueError(f"the model has {size} bytes, more than {MOST_MODEL_BYTES}")
    with open(path, "rb") as f:
        return f.read()


_CODED = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_byte_tokens", T.LongType()),
        T.StructField("decoded", T.StringType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
)
_CODED_ARROW = pa.struct(
    [
        ("ids", pa.list_(pa.int32())),
        ("n_tokens", pa.int64()),
        ("n_byte_tokens", pa.int64()),
        ("decoded", pa.string()),
        ("round_trip", pa.bool_()),
    ]
)


def _coded(codec: Codec, texts: list[str | None], codes: list[list[int]]) -> pa.StructArray:
    """The result column: one flat array of ids with offsets, and a value per text."""
    null = np.array([t is None for t in texts], bool)
    sizes = np.array([len(c) for c in codes], np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.fromiter((i for c in codes for i in c), np.int32, int(offsets[-1]))
    byte_sums = np.concatenate(([0], np.cumsum(codec.is_byte[flat])))
    decoded = [None if t is None else codec.decode(c) for t, c in zip(texts, codes)]
    same = [None if t is None else d == codec.plain(t) for t, d in zip(texts, decoded)]
    columns = [
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat), mask=pa.array(null)),
        pa.array(sizes, pa.int64(), mask=null),
        pa.array(byte_sums[offsets[1:]] - byte_sums[offsets[:-1]], pa.int64(), mask=null),
        pa.array(decoded, pa.string()),
        pa.array(same, pa.bool_()),
    ]
    return pa.StructArray.from_arrays(columns, fields=list(_CODED_ARROW))


def encode(
    docs: DataFrame,
    text: str = "text",
    model: bytes | None = None,
    keep: list[str] | None = None,
    threads: int = THREADS,
) -> DataFrame:
    """``row`` (a struct of the columns ``keep``, default all) with ``coded``: ids, counts, the decoded text.

    ``n_byte_tokens`` counts byte pieces; ``round_trip`` says whether decoding
    gave the normalised text back.  Texts are encoded whole, in small batches on
    ``threads`` threads of the task.

    A null text gives null ids, counts and decoded text; an empty one no ids and
    an empty text.  Keys may be null or repeat; each row is coded.  An empty
    table gives an empty result.
    """
    kept = docs.columns if keep is None else list(keep)
    packed = docs.sparkSession.sparkContext.broadcast(model_bytes() if model is None else model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        codec = _ready(packed.value)
        for batch in slices(batches, "whole", BATCH_BYTES):
            texts = batch.column("whole").to_pylist()
            codes = codec.encode([t or "" for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column("row"), _coded(codec, texts, codes)], ["row", "coded"])

    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("whole"))
    return carried.mapInArrow(run, T.StructType([carried.schema["row"], T.StructField("coded", _CODED)]))


def decode(
    coded: DataFrame,
    ids: str = "ids",
    model: bytes | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """``row`` (a struct of the columns ``keep``, default all) with ``decoded``, the text of the ids.

    The ids may be of any origin: see ``Codec.decode``.  Null ids give a null
    text, and so do lists with a null or with an id the model does not have; an
    empty list gives an empty text.  Rows are decoded one by one, repeated ones
    alike.  An empty table gives an empty result.
    """
    kept = coded.columns if keep is None else list(keep)
    packed = coded.sparkSession.sparkContext.broadcast(model_bytes() if model is None else model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _ready(packed.value)
        for batch in batches:
            texts = [None if c is None or not codec.has(c) else codec.decode(c) for c in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "decoded"])

    carried = coded.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{ids}`").alias("ids"))
    return carried.mapInArrow(run, T.StructType([carried.schema["row"], T.StructField("decoded", T.StringType())]))
