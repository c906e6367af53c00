"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes into the shared
scratch folder and reads again. All but the last return the columns of ``docs``; where a stage
changes texts, ``n_chars`` follows. Null texts pass where a stage does not reject them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import language_id, line_dedup, minhash_dedup, mixing, packing
from panelspark.llm.common import done_with, saved, table


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    sized = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return docs.select(*(F.coalesce(sized, F.col(c)).alias(c) if c == "n_chars" else c for c in columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents; drops those without a letter and those that the best
    language codes far worse than its own. Texts that several languages code alike stay. Where no
    document has a language to learn from, all with a letter stay."""
    model = language_id.train(docs)
    if not model["langs"]:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    model["usual"] = language_id.usual(docs)
    told = language_id.predict(docs, model, "text", *docs.columns)
    return told.filter(F.col("lang_pred") != language_id.UNDETERMINED).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated multi-line chunks out of the texts; every document stays."""
    return _measured(line_dedup.dedup_lines(docs), docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates (five-word shingles)."""
    kept = minhash_dedup.near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings the sources to their target weights; documents repeat where a source has to."""
    return _measured(mixing.copies(docs, mixing.mix(docs)), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: doc_id, piece, start, length, bin, offset, capacity."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Language identification and MinHash cannot be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            done_with(before)
        before = docs
    return docs
