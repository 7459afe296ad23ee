"""The corpus pipeline: documents in, packed training sequences out.

Five stages, each one operator of ``rowsmith.llm``. A stage gets what its
predecessor kept, written as Parquet and read again, and returns the columns of
documents; the last one returns packed pieces with their ids.

Defined results, besides those of the operators: rows repeating a ``doc_id`` count
as one document for near-dedup, of which the least row stays; rows without a key
are linked with nothing and stay; empty documents go with the language stage (no
letter, no language); an empty table packs into nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowsmith.llm import byte_cnn, host_rules, minhash, packing, pii, tables, tokens
from rowsmith.session import ship_package

#: Texts whose best language scores less are taken for no language at all: this, or with
#: more than four learned languages this much times chance, which is less.
MIN_LANGUAGE_SCORE, MIN_OVER_CHANCE = 0.35, 1.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, null ones and those that look like no learned language.

    Without a labelled row to learn from, every text with a letter stays.
    """
    ship_package(spark)
    net = byte_cnn.fit(docs)
    if net is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    least = min(MIN_LANGUAGE_SCORE, MIN_OVER_CHANCE / len(net.languages))
    names = tables.fresh(docs, "lang_pred"), tables.fresh(docs, "lang_score")
    found = byte_cnn.identify(docs, net, names=names)
    return found.where((F.col(names[0]) != byte_cnn.UNKNOWN) & (F.col(names[1]) >= least)).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules, or the strict ones on a bad host."""
    return host_rules.judged(docs).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least key."""
    ship_package(spark)
    found = minhash.near_duplicates(docs)
    stay = found.where(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"])
    nth = tables.fresh(docs, "nth")
    named = docs.join(stay, "doc_id", "left_semi").withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1)
    return named.select(*docs.columns).union(docs.where("doc_id is null"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; lengths follow."""
    ship_package(spark)
    out = pii.redacted(docs, pii.fit(docs))
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.coalesce(length, F.col("n_chars"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences: ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``."""
    ship_package(spark)
    return packing.pack(docs, tokens.vocabulary_path())


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("redact_pii", redact_pii),
    ("pack_sequences", pack_sequences),
]

#: SQL cannot express the trained stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = tables.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
