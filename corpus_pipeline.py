"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what one
returns is written as Parquet and read again as the next one's ``docs``.  All
but the last return the columns of ``docs``, whatever they are named: only
doc_id and text are required.  Empty tables pass through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import classifier, decontam, linededup, packing, simhash
from touchline.llm.bloom import without
from touchline.llm.common import stash, table

#: No stage pair decides by SQL alone: the classifier is a trained model.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier accepts, each judged on its own text: repeated
    rows alike, those with a null doc_id too.  A null or empty text has the
    share of good labels as its score."""
    return classifier.accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without lines that a document with a smaller doc_id holds;
    n_chars follows the text.  Rows of one doc_id lose the same lines, rows
    without one none; a null text becomes an empty one."""
    names = docs.columns
    inner = [f"in_{i}" for i in range(len(names))]
    own = docs.toDF(*inner)
    doc_id, text = (inner[names.index(c)] for c in ("doc_id", "text"))
    new = linededup.dedup_lines(own, id_col=doc_id, text_col=text, keep=[c for c in inner if c != text])
    if "n_chars" in names:
        at = inner[names.index("n_chars")]
        new = new.withColumn(at, F.length("text").cast(own.schema[at].dataType))
    return new.select(*(F.col("text" if c == text else c).alias(n) for c, n in zip(inner, names, strict=True)))


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of one document of each group of near-duplicates: the smallest
    doc_id.  Null and blank texts are one group; repeated rows of the document
    that stays all stay; rows without doc_id stay."""
    return without(docs, simhash.near_duplicates(docs).select(F.col("doc_id").alias("id")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of documents that contain no benchmark item.  Rows without doc_id
    are searched row by row."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of 4096 tokens, repeated rows and those
    without doc_id one by one; a null text is its end token."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("quality", quality), ("lines", lines), ("near_dups", near_dups), ("decontaminate", decontaminate), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
