"""The corpus pipeline: documents through stages, each written as Parquet and read as the next one's input.

Every stage but the last returns the columns of documents; each works on all that its predecessor kept.
Empty tables pass through; further columns of the input are kept by the filtering stages. Each stage says what
it does with nulls, ties and repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkspan.llm import linededup, neardup, packing, pii, quality
from inkspan.llm.common import discard, documents, keep, scope, set_up, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps, each row by itself; a null text has no words and goes."""
    set_up(spark)
    return quality.apply_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another line stands for; those of such lines alone go. Of equal lines
    the first by doc_id, then line, stays. Rows of equal doc_id are one document with the text that comes first
    in byte order, and rows with that text lose lines; a null text or doc_id passes."""
    set_up(spark)
    return linededup.drop_duplicate_lines(docs, emptied=False)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word shingles, similarity 0.8): the one of the smallest
    doc_id. Rows of equal doc_id stay or go together; a null text or doc_id, and a text without words, passes."""
    set_up(spark)
    return neardup.drop_near_duplicates(docs)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, each row by itself; a null text stays null."""
    set_up(spark)
    return pii.redact(docs, pii.fit(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' pieces in sequences, each row by itself; a null text is the end id alone."""
    set_up(spark)
    return packing.pack_documents(docs, forget=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("pii_redaction", pii_redaction),
    ("best_fit_packing", best_fit_packing),
]
#: Fuzzy links, a trained tagger and a tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        before = docs
        with scope():  # what the stage has stored meanwhile goes, its result stays
            made = stage(spark, before, sf_dir)
            docs = keep(stored(made))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
