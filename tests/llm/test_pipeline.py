"""Each stage against brute force on the rows it was given."""

import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tallystar.llm import common, contamination, secrets
from tallystar.llm.queries import QUERIES, piece_model
from tests.llm.test_contamination import brute as brute_windows
from tests.llm.test_secrets import brute_base
from tests.llm.util import documents, odd_rows, sentence


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """A folder with documents and a benchmark."""
    root = str(tmp_path_factory.mktemp("pipeline"))
    passage = sentence(500, 40)
    rows = [*odd_rows(), *((300 + k, sentence(k, 90) + ".") for k in range(40))]
    rows += [(400, rows[-1][1]), (401, sentence(77, 70) + ". " + passage + " " + sentence(78, 70))]
    rows += [(402, sentence(79, 90) + " token = 0123456789abcdef0123456789 end")]
    rows += [(403, " ".join(w + "###" for w in sentence(80, 90).split()))]
    documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages(spark, given):
    docs = spark.read.parquet(f"{given}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{given}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "secret_scans", "encoding",
    ]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, given)
        docs = spark.createDataFrame(out.collect(), out.schema)
        after = docs.collect()
        seen[name] = (before, after)
        if name != "encoding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = seen["quality_rules"]
    ids = {r.doc_id for r in after}
    assert {300 + k for k in range(40)} <= ids and 403 not in ids and 9 not in ids

    before, after = seen["near_duplicates"]
    groups = {}
    for r in before:
        if r.doc_id is not None:
            groups.setdefault(r.text.lower(), []).append(r.doc_id)
    least = {i: min(g) for g in groups.values() for i in g}
    near = {7: 6, 302: 6}  # a passage with few words around it, or ten more
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(
        i for i in least if least[i] == i and near.get(i) not in least
    )
    assert 400 not in {r.doc_id for r in after}

    before, after = seen["decontamination"]
    assert len(before) == len(after)
    old = {r.doc_id: r.text for r in before}
    for r in after:
        words = contamination.split_words(old[r.doc_id])
        if brute_windows(benchmark, words)[0]:
            assert not brute_windows(benchmark, contamination.split_words(r.text))[0] and r.n_chars == len(r.text)
        else:
            assert r.text == old[r.doc_id]
    assert {r.doc_id for r in after if r.text != old[r.doc_id]} == {401}

    before, after = seen["secret_scans"]
    old = {r.doc_id: r.text for r in before}
    assert {r.doc_id for r in after if r.text != old[r.doc_id]} == {402}
    assert all(not brute_base(r.text) for r in after)

    before, after = seen["encoding"]
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    old = {r.doc_id: r.text for r in before}
    for r in after:
        want = library.encode(old[r.doc_id], add_eos=True)
        assert r.ids == want
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want).encode()).hexdigest()


def test_run_and_registration(spark, given):
    before = common.written()
    out = corpus_pipeline.run(spark, given)
    assert common.written() == before + 1  # the scratch tables of finished stages are gone
    assert out.where(F.col("doc_id") == 401).count() == 1
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert "pipeline" in queries and set(QUERIES) <= set(queries) and set(sql) <= set(queries)
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 11))
    assert secrets.KINDS[:3] == ("assign", "access", "hex")


def test_an_empty_table_goes_through(spark, given):
    docs = spark.read.parquet(f"{given}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, given)
    assert docs.count() == 0
