"""Every query of the subpackage against its SQL, and the pipeline as a whole."""

import os

import oracle
import pytest

import corpus_pipeline
from gridsight.llm.queries import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLE = {"op3_warc": "pages", "op6_extraction": "pages"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, FOLDER), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op13_spelling"}))
def test_one_row_for_each_of_the_table(spark, name):
    table = TABLE.get(name, "documents")
    key = "page_id" if table == "pages" else "doc_id"
    got = sorted(r[0] for r in QUERIES[name](spark, FOLDER).select(key).collect())
    assert got == sorted(r[0] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect())


def test_all_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert names >= set(QUERIES) | {"pipeline"} and [int(n[2:].split("_")[0]) for n in QUERIES] and len(QUERIES) == len({n.split("_")[0] for n in QUERIES})


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids, columns = {r.doc_id for r in docs.collect()}, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.kept(stage(spark, docs, FOLDER), name)
        left = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and left <= ids and len(left) > 0.5 * len(ids), name
        ids = left
    mixed = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in mixed.collect()} <= ids and "epoch" in mixed.columns


def test_stages_on_empty_and_odd_tables(spark, folder):
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "token=abcdefgh here", None, "t", 19)]
    for rows, want in (([], 0), (odd, 2)):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.kept(stage(spark, docs, folder), name)
        assert {r.doc_id for r in docs.collect()} == ({2} if want else set())
    assert docs.first().text == "[secret] here" and docs.first().n_chars == 13


def test_stages_with_further_columns(spark, folder):
    """Columns named as the stages name their own, one of a type without an order."""
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    extra = ["fp", "blob", "spans", "score", "toxic", "key", "component", "epoch", "_doc"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in extra) + ", row map<string, int>"
    rows = [(i, t, "en", "s", 0, *extra, {"k": i % 2}) for i, t in enumerate(["token=abcdefgh here and there", "quite another text", "quite another text"])]
    docs = spark.createDataFrame(rows + rows[1:2], schema)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.kept(stage(spark, docs, folder), name)
        assert docs.columns == columns + (["epoch_"] if name == "mixing" else []), name
    assert {(r.doc_id, r.text, r.fp, r.row["k"]) for r in docs.collect()} == {
        (0, "[secret] here and there", "fp", 0), (1, "quite another text", "fp", 1)}
