"""A corpus pipeline: quality, near duplicates, benchmark passages, secrets, tokens.

Each stage is a function (spark, docs, sf_dir) -> DataFrame and works on all rows that the stage
before it kept. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergelens.llm import bpe, contamination, neardup, quality, secret_scan
from mergelens.llm.queries import table, vocabulary_path
from mergelens.session import new_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Scores from which a document is kept.
QUALITY = 0.3
#: Words of a shingle in the near-duplicate stage.
SHINGLE_WORDS = 5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at least QUALITY."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs.select(*COLUMNS), model, "score")
    return scored.where(F.col("score") >= QUALITY).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of every group of near duplicates."""
    judged = neardup.near_duplicates(docs, neardup.NearDuplicates(shingle=SHINGLE_WORDS))
    dropped = judged.where(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make less than a twentieth of the words."""
    found = contamination.contaminated_ids(docs, table(spark, sf_dir, "benchmark"))
    return docs.select(*COLUMNS).join(found, "doc_id", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a sign and n_chars counted anew."""
    model = secret_scan.fit_secrets(secret_scan.weak_findings(docs))
    scanned = secret_scan.scan_secrets(docs, model, ["doc_id", "lang", "source", "n_chars"])
    changed = F.col("spans") != ""
    return scanned.select(
        "doc_id",
        F.col("redacted").alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("redacted").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the token ids of every text, with their digests."""
    return bpe.encode_texts(docs, vocabulary_path(), ["doc_id", "source"], with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("tokens", encode),
]
#: The model stages cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
