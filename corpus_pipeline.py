"""The corpus pipeline: raw documents to packed training batches, in five stages.

Every stage but the last returns the columns of ``documents``; what it rejects or
changes is what the next one sees. A stage's result is written and read again
before the next begins, so a lost executor repeats one stage at most.

Cases, beyond those of the operators: documents of null id or text pass the
filters like any other (a text without a letter is rejected as no language);
repeated rows leave one row at the near-duplicate stage; extra columns are
carried to the last stage; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.llm import langid, line_dedup, packing, quality, simhash
from promoledger.llm.common import fold, table
from promoledger.session import stage

#: Documents whose n-grams no profile knows better than this are in no learned language.
LEAST_LANGUAGE_SCORE = 0.1
_LAST_ID = (1 << 63) - 1


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the classifier does not reject; it learns from all labelled documents but the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model, out="__quality")
    return scored.where(F.col("__quality") >= quality.THRESHOLD).drop("__quality")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the learned languages."""
    profiles = langid.fit(docs.where(fold("doc_id", 3) != 1))
    found = langid.identify(docs, profiles, names=("__lang", "__score"))
    wanted = (F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= LEAST_LANGUAGE_SCORE)
    return found.where(wanted).drop("__lang", "__score")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's boilerplate lines out of its documents and count characters anew; copies count as one page."""
    cut = line_dedup.drop_boilerplate(docs, dropped_col="__dropped", copies_once=True)
    changed = F.when(F.col("__dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", changed).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, that of least id (rows without id come last).

    Near is what ``op4`` calls near: fingerprints of three-word shingles that differ in three bits or fewer,
    found by its operator with its contract's shingle length and distance.
    """
    key = F.struct(F.coalesce(F.col("doc_id"), F.lit(_LAST_ID)).cast("long").alias("id"), F.xxhash64("text").alias("text"))
    keyed = docs.withColumn("__key", key)
    groups = simhash.near_duplicates(keyed, "__key", words=simhash.SHINGLE)
    first = groups.where(F.col("id") == F.col("component")).select(F.col("id").alias("__key")).distinct()
    return keyed.join(first, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into batches of equal padded length."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("packing", packing_stage),
]

#: The learned stages have no SQL form; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs, _ = stage(docs, f"pipeline-{number}")
    return docs
