"""Corpus pipeline: language identification, near-duplicates, repeated passages, benchmark items, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of documents, and each stage's table is written and
read again before the next.  Null and empty texts are rejected by the first stage; empty tables pass through all of them.  Rows that are equal in
all columns are near-duplicates of each other; of documents with equal texts the least doc_id stays.  Only doc_id and text are judged, and further columns
pass through all stages but the last, also if they have the name of an operator's result.  Long texts are read as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import decontaminate, language_id, near_dedup, packing, passages
from fieldspark.llm.common import ready, stage
from fieldspark.llm.queries import tokenizer_path

WINDOW = 4096
END_ID = 2
PASSAGE_BYTES = 240  # just under the bytes of 50 words


def _with_text(docs: DataFrame, out: DataFrame, text: str) -> DataFrame:
    """The columns of documents, with the stage's text and its length in characters."""
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return out.select(*[new[c].alias(c) if new.get(c) is not None else F.col(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are near a language's centroids stay; the others, and those without a letter, go."""
    ready(spark)
    model = language_id.fit(docs)
    return language_id.identify(docs, model).where(~F.col("rejected")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the least doc_id."""
    ready(spark)
    return near_dedup.near_duplicates(docs).where("kept").select(*docs.columns)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated passages go; documents of which nothing but white space is left go with them."""
    ready(spark)
    out = passages.remove_repeats(docs, least=PASSAGE_BYTES)
    left = (F.col("n_removed") == 0) | F.col("clean_text").rlike(r"[^\x20\x09-\x0D]")
    return _with_text(docs, out.where(left), "clean_text")


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of benchmark items go; documents that are mostly benchmark go as a whole."""
    out = decontaminate.decontaminate(docs, ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _with_text(docs, out.where(~F.col("dropped")), "clean_text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their ids."""
    ready(spark)
    return packing.pack(docs, tokenizer_path(), end_id=END_ID, window=WINDOW)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("passages", remove_passages),
    ("decontaminate", remove_benchmark),
    ("packing", pack_sequences),
]

#: SQL cannot express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
