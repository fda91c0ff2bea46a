"""From raw documents to packed training sequences: each stage works on what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barorail.llm.common import keyed, saved, table
from barorail.llm.compression import accepted
from barorail.llm.minhash import near_duplicate_rows
from barorail.llm.packing import pack_documents
from barorail.llm.secrets import redact_secrets
from barorail.llm.suffixes import cut_passages, repeated_passages


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text the compression classifier does not reject, whatever their id."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates, that with the smallest id; NULL ids come last.

    Every row is a document of its own, so of a row that is there twice one stays. Rows without a word
    belong to no class and all stay.
    """
    rows, row = keyed(docs)
    classes = near_duplicate_rows(rows, row)
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.xxhash64("text").alias("hash"), row)
    ranked = rows.select(row, place.alias("place")).join(classes, row)
    first = ranked.groupBy("class_row").agg(F.min("place").alias("place")).select(F.col(f"place.{row}").alias(row))
    dropped = classes.join(first, row, "left_anti")
    return rows.join(dropped.hint("merge"), row, "left_anti").select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that an earlier place holds already, in any row."""
    rows, row = keyed(docs)
    return cut_passages(rows, repeated_passages(rows, by=row), by=row).select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced by a mark."""
    return redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


STAGES = [
    ("quality classifier", good_documents),
    ("minhash near-dedup", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: SQL can say none of these models and signatures; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
