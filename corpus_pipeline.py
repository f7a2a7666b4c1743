"""A training corpus from raw documents: five stages, each of which works on all that the one before it kept.

Each stage takes (session, documents, folder of the tables) and returns documents with the same columns; the last
returns packed sequences. The result of a stage is written as Parquet in the shared folder and read again, so that a
stage that fails can be run anew from the one before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statledger.llm import decontaminate, language_id, near_duplicates, packing, secret_scan
from statledger.llm.cluster import ship, table, written
from statledger.llm.vocabularies import public_path

#: Languages are rejected below this probability.
MIN_LANGUAGE_SCORE = 0.4
#: A value is a published example, and stays, only if more sources and more documents than these have it.
MAX_OWNERS, MAX_REPOSITORIES = 5, 20
TOKENIZER = "word_bpe_49k.json"
END_ID = 2

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels of this corpus teach; the others go.

    Null and empty texts and those without a letter have no language and go. If no document has both a language and a
    text, nothing can be told of any, and all stay. Copies share their answer; an empty table stays empty.
    """
    model = language_id.train(docs)
    if not model.languages:
        return docs
    found = language_id.identify(docs, model)
    return found.filter(~language_id.rejected(MIN_LANGUAGE_SCORE)).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, a similarity of 0.8).

    It is the one with the smallest id. Texts without words are like no other and stay. Rows that repeat in full stay
    once; rows that share an id, or have none, stay or go together. An empty table stays empty.
    """
    return near_duplicates.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item.

    Null and empty texts share none. Rows that share an id, or have none, go together if one of them does. With an empty
    benchmark all stay; an empty table stays empty.
    """
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets taken out of their texts, unless many sources and many documents have them.

    Null and empty texts stay as they are, and so does an empty table. A missing source counts as one source. Spans are
    those of the id: rows that share an id should be copies.
    """
    return secret_scan.redact(docs, secret_scan.scan(docs, max_owners=MAX_OWNERS, max_repositories=MAX_REPOSITORIES))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' tokens in full sequences.

    Null and empty texts are the end id alone. Repeated rows are packed as often as they occur; an empty table gives no
    pieces.
    """
    return packing.pack_documents(docs, public_path(TOKENIZER), END_ID)


def _shipped(stage: Stage) -> Stage:
    """The stage, on a session whose executors have this package."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(ship(spark), docs, sf_dir)

    run.__doc__ = stage.__doc__
    return run


STAGES: list[tuple[str, Stage]] = [
    ("language ID", _shipped(known_language)),
    ("near-duplicates", _shipped(one_of_each)),
    ("benchmark decontamination", _shipped(without_benchmark)),
    ("secrets", _shipped(without_secrets)),
    ("packing", _shipped(packed)),
]

# A trained model and a tokeniser take part, which SQL cannot express; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
