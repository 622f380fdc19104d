"""Corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm import language, mixing, near_dup, pieces, pii
from strataframe.llm.common import DOCUMENT_COLUMNS, documents_only, drop, materialize, remove, scratch_made, table

PII_KEY, WORKER_SHARE = "corpus key", 0.3
_SCRATCH: list[str] = []  # folders that the stages so far wrote for themselves


def _stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that first deletes what earlier stages wrote for themselves: their results are tables of their own by now.

    Folders that docs still reads from stay, so stages that are chained without a table between them work too.
    """

    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = {name.rsplit("/", 2)[-2] for name in docs.inputFiles()}
        done = [p for p in _SCRATCH if p.rsplit("/", 1)[-1] not in read]
        remove(spark, *done)
        _SCRATCH[:] = [p for p in _SCRATCH if p not in done]
        with scratch_made() as made:
            out = f(spark, docs, sf_dir)
        _SCRATCH.extend(made)
        return out

    return run


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts, those without letters and unlikely ones go.

    Null languages are not learned from; without any labelled document none is recognised. Repeated rows are judged
    alike and each stay or go; null ids and sources do no harm; further columns are left out.
    """
    docs = documents_only(docs)
    return documents_only(language.predict(docs, language.fit(docs), keep=DOCUMENT_COLUMNS).where("NOT rejected"))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, at a similarity of 0.8 or more over five words: that with the
    smallest id, null last.

    Repeated rows are one group; texts without a word, null ones included, all stay; further columns are left out.
    """
    return documents_only(near_dup.deduplicated(documents_only(docs)))


@_stage
def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for the entities in their texts; n_chars follows a text that changed.

    Null and empty texts and those without an entity stay as they are; repeated rows change alike; null ids do no harm;
    further columns are left out.
    """
    found = pii.replace_pii(documents_only(docs), PII_KEY)
    return documents_only(found.withColumn("n_chars", F.when(F.size("__found") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))))


@_stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them and in its order, the last of a source cut to what is
    taken; files and rows in them follow the schedule.

    Null and blank texts are never taken; a null source is a source; repeated rows and null ids are taken like others,
    in the order of a keyed hash; further columns are left out.
    """
    return documents_only(mixing.mixed_documents(documents_only(docs)))


@_stage
def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of every text, and the text that they decode to.

    A null text has null ids, an empty one none; every row is encoded, repeated ones alike; further columns are left out.
    """
    # executors are fullest in the last stage: its workers keep fewer words than op6's, which costs time alone
    return pieces.encode_documents(documents_only(docs), pieces.load(share=WORKER_SHARE), keep=("doc_id", "lang", "source"))


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("PII surrogates", pii_surrogates),
    ("mixing sources to target weights", source_mixing),
    ("SentencePiece encoding and decoding", sentencepiece),
]
#: The first stage's model and the last one's search are beyond SQL: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; a stage's table goes when the next one's is there."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name.split()[0], "snappy")
        if k:
            drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
