"""The corpus pipeline: five stages from raw documents to a source mix, each applying one operator of ``hourwise.llm``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns documents with the same
columns; the last returns the mix (doc_id, source, size, source_size, target, taken).  ``run`` writes every stage as
Parquet in the shared checkpoint folder and reads it again, so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourwise.llm import decontaminate, lang_id, mixing, near_dup, pii
from hourwise.llm.common import lean_workers, read, stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that operator 1 leaves undetermined (``und``: without a letter).  Mixed-language text
    stays, whatever the share of its largest language.  Where no labelled row teaches a language, letters decide."""
    model = lang_id.fit(docs, where=~lang_id.held_out())
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return lang_id.label(docs, model).where(F.col("lang_pred") != lang_id.UNKNOWN).select("_row.*")


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8 or more)."""
    return near_dup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages cover a twentieth of the words or more go."""
    found = decontaminate.judged(decontaminate.find_windows(docs, read(spark, sf_dir, "benchmark")))
    return found.where(~F.col("contaminated")).select("_row.*")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their texts is replaced by its kind, and n_chars counted anew."""
    out = pii.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document that is left."""
    return mixing.mix_documents(docs, read(spark, sf_dir, "labels"))


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

#: Language models and sketches are beyond SQL: the tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    lean_workers(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
