"""The corpus pipeline: documents to packed training bins, in five stages.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
``documents``.  ``run`` applies them one after the other, each to what its
predecessor kept, written to the shared folder and read again in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.decontaminate import decontaminate
from salescope.llm.near_dedup import deduplicate
from salescope.llm.packing import pack
from salescope.llm.quality_rules import quality_rules
from salescope.llm.store import Stages
from salescope.llm.toxicity import toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _judged(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], keep: Column) -> DataFrame:
    """The rows of ``docs`` that ``keep`` picks after ``judge`` has added its
    columns.  The documents' other columns wait in a struct, so that none of
    theirs is replaced."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    aside = docs.select("doc_id", "text", F.struct(*[F.col(c) for c in rest]).alias("rest")) if rest else docs
    kept = judge(aside).where(keep)
    return (kept.select("doc_id", "text", "rest.*") if rest else kept).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine doesn't call toxic.

    A null or empty text has no strings and stays.  Equal texts share a score,
    so repeated rows stay or go together; ties at the threshold count as toxic.
    Other columns are handed on, whatever their names; an empty table stays
    empty, and without labels nothing goes."""
    labels = _read(spark, sf_dir, "labels").select("doc_id", "toxic")
    return _judged(docs, lambda d: toxicity(d, labels), F.col("predicted") == 0)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base counts and the likelihood ratio.

    A null text has no words and goes, as do all texts under 50 words.  Equal
    texts share a score, so repeated rows stay or go together; a score at the
    threshold stays.  Other columns are handed on, whatever their names; an
    empty table stays empty, and without labels the base counts alone decide."""
    labels = _read(spark, sf_dir, "labels").select("doc_id", "quality")
    return _judged(docs, lambda d: quality_rules(d, labels), F.col("kept"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8).

    Texts without words (null too) are in no group and stay.  Of a group one
    row stays, of the smallest doc_id (nulls last), ties by the text; rows that
    repeat are members of their group.  Other columns are handed on; an empty
    table stays empty."""
    return deduplicate(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with the benchmark.

    A null text has no words and stays.  Repeated rows stay or go together.
    Other columns are handed on, whatever their names; an empty table stays
    empty, and an empty benchmark drops nothing."""
    return decontaminate(docs, _read(spark, sf_dir, "benchmark").select("item_id", "text"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their bins.

    A null or empty text is a piece of no bytes; rows that repeat are packed
    each, in bins of their own as copies; a null doc_id or source is a value
    like others.  Other columns are left out; an empty table gives no pieces."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: The stages train models and search by hashing, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``.  A stage's own tables are removed once its
    result is written, and that result once the next one is."""
    docs, stages = _read(spark, sf_dir, "documents"), Stages(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = stages.run(name, lambda f=stage, d=docs: f(spark, d, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
