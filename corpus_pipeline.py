"""Five stages from raw documents to packed training sequences.

Each stage works on all that the one before it kept, and is written as Parquet and read again between them.  All but the
last return the columns of ``documents``; a replaced text's ``n_chars`` is counted anew.

Edge cases: documents with a null, empty or letterless text go at the language stage; rows without an id stay if their text does; of equal texts one
stays; further columns are carried through whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import jaccard, langid, packing, pii, toxicity
from tapeloom.llm.common import table, written
from tapeloom.llm.queries import PSEUDONYM_KEY


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, trained on the labelled ones, rejects go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those that no language's model explains, go."""
    return langid.keep_known(docs, langid.fit(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their 5-word shingles (Jaccard similarity of at least 0.75), the one of the smallest id stays."""
    return jaccard.keep_first(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers and dates are replaced within their format."""
    return pii.pseudonymise(docs, PSEUDONYM_KEY).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, of balanced cost."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [("toxicity", clean), ("language ID", known_language), ("n-gram Jaccard join", one_of_each), ("PII", pseudonyms), ("packing", pack)]
#: Trained models and a tokenizer decide the rows, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir).select(*docs.columns), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
