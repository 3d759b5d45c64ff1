import struct

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from loanlens.llm import sentencepiece_codec as C


def _field(number, kind, data):
    def varint(x):
        out = b""
        while True:
            out += bytes([x & 0x7F | (0x80 if x > 0x7F else 0)])
            x >>= 7
            if not x:
                return out

    tag = varint(number << 3 | kind)
    return tag + (varint(data) if kind == 0 else varint(len(data)) + data if kind == 2 else data)


def unigram_model(collapse=True):
    """A hand-written unigram model: pieces with scores, byte pieces, no training."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = {"▁the": -2.0, "▁th": -4.0, "e": -3.5, "▁": -3.0, "t": -5.0, "h": -5.1, "▁cat": -6.0, "ca": -6.5, "a": -4.5, "c": -5.5,
             "s": -4.0, "at": -5.2, "▁a": -3.9, "n": -4.9, "an": -5.0, "▁an": -5.5, "▁▁": -6.6, "é": -7.0}
    pieces += [(p, s, 1) for p, s in words.items()]
    body = b""
    for piece, score, kind in pieces:
        message = _field(1, 2, piece.encode()) + _field(2, 5, struct.pack("<f", score)) + _field(3, 0, kind)
        body += _field(1, 2, message)
    trainer = _field(3, 0, 1) + _field(4, 0, len(pieces)) + _field(35, 0, 1)
    normal = _field(1, 2, b"identity") + _field(3, 0, 1) + _field(4, 0, int(collapse)) + _field(5, 0, 1)
    return body + _field(2, 2, trainer) + _field(3, 2, normal)


TEXTS = [
    "", " ", "the cat sat", "  the   cat  ", "thecat an éa", "漢字 😀 the", "a\nb\tc", "▁ the", "<s> the </s> <0x41>", "aaaa tttt",
    "The quick brown fox — jumps; over 123,456.78 lazy dogs!", "x" * 3000, " " * 50, "=" * 70 + "\n" * 9, "a" * 101,
]


@pytest.mark.parametrize("collapse", [True, False])
def test_unigram_parity(collapse):
    data = unigram_model(collapse)
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    made = C.build(C.parse_model(data))
    codec = C.Codec(data)
    for text in TEXTS:
        ids = made.encode(text, add_special_tokens=False).ids
        assert ids == reference.encode(text), text
        assert made.decode(ids, skip_special_tokens=False) == reference.decode(ids), text
        assert codec.encode([text]) == [ids]
        assert codec.decode(ids) == reference.decode(ids) == codec.plain(text), text


def test_bpe_parity_on_corpus_and_odd_texts(spark):
    data = C.model_bytes()
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    made = C.build(C.parse_model(data))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    texts = TEXTS + [r.text for r in docs]
    texts += [f"{c * n} {c * n}x" for c in " a=-.\n\t0▁é" for n in range(1, 40)]
    ids = [e.ids for e in made.encode_batch(texts, add_special_tokens=False)]
    expected = reference.encode(texts, num_threads=4)
    assert [t for t, a, b in zip(texts, ids, expected) if a != b] == []
    codec = C.Codec(data)
    for text, codes, back in zip(texts, ids, made.decode_batch(ids, skip_special_tokens=False)):
        assert back == reference.decode(codes) == text.replace("▁", " ") == codec.decode(codes) == codec.plain(text)


@pytest.mark.parametrize("data", [unigram_model(True), unigram_model(False), C.model_bytes()], ids=["collapse", "blanks", "bpe"])
def test_decode_ids_of_any_origin(data):
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = C.Codec(data)
    size, pick = reference.get_piece_size(), np.random.default_rng(5)
    marks = [i for i in range(size) if set(reference.id_to_piece(i)) == {"▁"}]
    lists = [[], [0], [1], [2, 2], [0, 0, 1], [1, *marks], [0, *marks], [*marks, *marks, 0], [marks[0]] * 4, [marks[0], 1, marks[0], size - 1]]
    for n in range(3000):
        pool = (np.arange(size), np.array([0, 1, 2, *marks, size - 1]), np.arange(262))[n % 3]
        lists.append(pick.choice(pool, pick.integers(1, 12)).tolist())
    lists += [[3 + 32, size - 1], [3 + 0xE6, 3 + 0xBC, size - 1], [3 + 0xE6, 3 + 0xBC, 3 + 0xA2, 3 + 0xBC], [3 + 0xED, 3 + 0xA0, 3 + 0x80]]
    assert [x for x in lists if codec.decode(x) != reference.decode(x)] == []


def test_decode_a_column(spark):
    rows = [(1, [5, 400, 0, 1]), (2, None), (3, []), (4, [7, None]), (5, [40_000]), (6, [-1]), (1, [5, 400, 0, 1]), (None, [290, 300])]
    coded = spark.createDataFrame(rows, "decoded long, ids array<int>")
    got = C.decode(coded).select("row.*", F.col("decoded").alias("text")).collect()
    reference = sentencepiece.SentencePieceProcessor(model_proto=C.model_bytes())
    bad = (2, 4, 5, 6)
    expected = [(k, None if k in bad else reference.decode(i)) for k, i in rows]
    assert sorted(((r[0], r.text) for r in got), key=repr) == sorted(expected, key=repr)
    assert C.decode(coded.where("false")).count() == 0


def test_encode_then_decode(docs_of, awkward):
    back = C.decode(C.encode(docs_of(awkward)).select("row", "coded.ids"), keep=["row"]).select("row.row.text", "decoded").collect()
    assert len(back) == len(awkward) and all(r.text == r.decoded for r in back)


def test_encode_awkward_rows(docs_of, awkward):
    docs = docs_of(awkward)
    got = C.encode(docs)
    assert got.select("row.*").columns == docs.columns
    rows = got.select("row.text", "coded.*").collect()
    assert len(rows) == len(awkward)
    reference = sentencepiece.SentencePieceProcessor(model_proto=C.model_bytes())
    for r in rows:
        if r.text is None:
            assert r.ids is None and r.n_tokens is None and r.n_byte_tokens is None and r.decoded is None and r.round_trip is None
            continue
        assert r.ids == reference.encode(r.text) and r.n_tokens == len(r.ids)
        assert r.decoded == r.text and r.round_trip
        assert r.n_byte_tokens == sum(reference.is_byte(i) for i in r.ids)
    assert C.encode(docs_of([])).count() == 0


def test_threads_do_not_change_the_ids(docs_of, prose):
    docs = docs_of([(i, prose(i, 50)) for i in range(50)])
    one, four = (sorted((r.doc_id, tuple(r.ids)) for r in C.encode(docs, threads=n).select("row.doc_id", "coded.ids").collect()) for n in (1, 4))
    assert one == four


def test_unsupported_models_raise():
    with pytest.raises(ValueError):
        C.parse_model(_field(2, 2, _field(3, 0, 3)))
    with pytest.raises(ValueError):
        C.parse_model(_field(2, 2, _field(24, 0, 1)))


def test_byte_ids():
    assert int(np.sum(C.byte_ids(C.parse_model(C.model_bytes())))) == 256
