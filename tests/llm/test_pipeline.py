import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from shiftloom.llm import bpe, texts
from shiftloom.llm.queries import VOCABULARY

from .conftest import ODD, words

TONGUES = {"xx": "an el ti on re".split(), "yy": "ßu öz ver sch mü".split()}


@pytest.fixture
def folder(spark, stored, tmp_path):
    rows = [(100 + k, words(k, 40 + k, TONGUES["xy"[k % 2] * 2]), "xy"[k % 2] * 2) for k in range(60)]
    boiler = "please accept all cookies of site {} to read on and on"
    rows += [(200 + k, f"{words(300 + k, 60, TONGUES['xx'])}\n{boiler.format(k)}\n{words(400 + k, 60, TONGUES['xx'])}", "xx") for k in range(6)]
    rows += [(300 + k, words(7, 300, TONGUES["yy"]), "yy") for k in range(5)]
    item = words(900, 30, TONGUES["xx"])
    rows += [(400, f"{words(500, 50, TONGUES['xx'])} {item} {words(501, 50, TONGUES['xx'])}", "xx")]
    stored(rows + [(d, t, None) for d, t in ODD]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_and_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, folder)
        found.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        assert number == 4 or docs.columns == columns, name
        kept[name] = {r.doc_id for r in docs.collect()}
    assert {1, 2, 3} & kept["language"] == set() and set(range(100, 160)) <= kept["language"]
    assert kept["line_templates"] == kept["language"]
    texts_now = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/1").where("doc_id >= 200 and doc_id < 206").collect()}
    assert ["cookies" in texts_now[200 + k] for k in range(6)] == [True] + [False] * 5
    assert len(kept["near_copies"] & set(range(300, 305))) == 1 and set(range(100, 160)) <= kept["near_copies"]
    assert kept["near_copies"] - kept["benchmark"] == {400}
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/3").collect()}
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in docs.where("doc_id <> 4").collect():
        assert r["ids"] == own.encode_ordinary(before[r.doc_id]) and r.n_tokens == len(r["ids"])
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, again.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))


def test_a_run_leaves_other_results_and_no_tables(spark, folder):
    from shiftloom.llm.queries import QUERIES

    lazy = QUERIES["op7_simhash"](spark, folder)
    before, tables = lazy.count(), {t.name for t in spark.catalog.listTables()}
    assert corpus_pipeline.run(spark, folder).count() > 0 and lazy.count() == before
    with texts.scratch() as made:
        assert QUERIES["op1_byte_bpe"](spark, folder).count() == before
    texts.forget(spark, made)
    # The ids of a run are read when its rows are asked for, so its own table stays.
    assert len({t.name for t in spark.catalog.listTables()} - tables) <= 1 and lazy.count() == before


def test_empty_table(spark, stored, tmp_path):
    stored([], 1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_query_reads_whole_tables(spark, folder):
    from shiftloom.llm.queries import QUERIES

    for name in ("op1_byte_bpe", "op4_language_id", "op9_decontamination"):
        found = QUERIES[name](spark, folder)
        assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count(), name
        assert found.where(F.col("doc_id") == 100).count() == 1
