"""A training corpus from raw documents, in five stages.

Toxic documents go; of each group of near-duplicates one document stays; documents with passages of the
benchmark go; secrets are cut out of the texts; the sources are mixed to their target weights. A stage
takes (spark, docs, sf_dir) and works on all that the one before it kept, which is written as Parquet and
read again in between. All but the last return the columns of ``documents``.

Cases: a NULL id or source is a value like others; NULL and empty texts are near-duplicates of one another and
not used by the mix; of rows alike in all columns one stays; ties between copies go to the least id; very long
texts are processed whole; an empty table gives no rows. Further columns of any name and type pass through
every stage; where one is called ``epoch``, the mix's number is ``epoch_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridsight.llm import decontamination, mixing, secret_scan, simhash, toxicity
from gridsight.llm.common import kept, table
from gridsight.session import new_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every finding of the ledger becomes a mark; a document's ``n_chars`` follows its text."""
    ledger = new_folder(spark, "ledger")
    secret_scan.scan_load(docs, ledger, "1")
    return secret_scan.redact(docs, ledger, length="n_chars", load="1")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: A learnt classifier and 64-bit fingerprints have no SQL form; tests/llm holds the stages against
#: plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
