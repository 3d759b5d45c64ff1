import pytest
import sentencepiece

import corpus_pipeline
from loanlens.llm import queries, sentencepiece_codec
from testbed.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    if name in queries.SQL_TEXTS:
        assert compare(df, connect(SF_DIR).sql(queries.SQL_TEXTS[name])) == ""
    else:
        assert df.count() == connect(SF_DIR).sql("select count(*) from documents").fetchall()[0][0]


def test_one_query_for_each_operator():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("rows", ["tables", "awkward", "none"])
def test_run_equals_brute_force(spark, docs_of, awkward, tmp_path, rows):
    """Each stage's decisions recomputed by the brute-force versions of the operators' tests."""
    from tests.llm.test_decontamination import brute as hits
    from tests.llm.test_decontamination import words
    from tests.llm.test_line_dedup import brute as lines
    from tests.llm.test_simhash import brute_components, brute_print

    sf = SF_DIR
    if rows != "tables":
        docs_of(awkward if rows == "awkward" else []).write.parquet(f"{tmp_path}/documents.parquet")
        spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
        sf = str(tmp_path)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    judged = stages["quality_rules"](spark, docs, sf)
    assert judged.columns == docs.columns
    current = [(r.doc_id, r.text, r.source) for r in judged.collect()]  # the votes' model has tests of its own
    clean = lines(current, 5)
    current = [
        (d, *clean[d, t]) for d, t, _ in current if not (clean[d, t][1] and not (clean[d, t][0] or "").split())
    ]
    # row numbers in key order tell components apart that share their smallest key
    current.sort(key=lambda x: (x[0] is None, x[0] or 0))
    firsts = set(brute_components([(i, brute_print(t)) for i, (_, t, _) in enumerate(current)]))
    reference = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_codec.model_bytes())
    expected = []
    for i in firsts:
        d, t, _ = current[i]
        n, hit, _ = hits(t, items)
        if 2 * len(hit) <= n:
            left = None if t is None else [w for k, w in enumerate(words(t)) if k not in hit]
            expected.append(repr((d, left if hit or t is None else t)))
    got = []
    plain = {(d, t) for d, t, _ in current}
    for r in corpus_pipeline.run(spark, sf).collect():
        text = None if r.ids is None else reference.decode(r.ids)
        got.append(repr((r.doc_id, text if (r.doc_id, text) in plain or text is None else words(text))))
        assert r.n_tokens == (None if r.ids is None else len(r.ids)) and r.round_trip in (None, True)
        assert text is None or r.ids == reference.encode(text)
    assert sorted(got) == sorted(expected)
    assert (len(got) == 0) == (rows == "none")
