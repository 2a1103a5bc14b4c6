"""From raw documents to token ids: quality rules, near-dedup, personal data, mixing, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage
before has kept; what it returns is written and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from deedmill.llm import bpe, minhash, mixing, pii, quality
from deedmill.llm.queries import LANG_SHARES
from deedmill.llm.tokenizers import default_path
from deedmill.session import staged


#: Documents are near-duplicates if five-word shingles agree in so many of a hundred.
SIMILARITY = 80


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns``, and each whole row as one value: no name of the caller's can meet one of an operator's."""
    return docs.select(F.struct(F.col("*")).alias("row"), *columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    judged = quality.judge(_packed(docs, "text", "lang", "source"), ["row"])
    return judged.where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.one_of_each(docs, per_hundred=SIMILARITY)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, entities replaced by their kind and disclosing terms generalised or removed."""
    clean = pii.sanitise_documents(docs)
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", n_chars).select(*pii.named(docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn towards the target shares, each once: short of them where the draw has several copies of one."""
    mixed = mixing.mix(_packed(docs, "doc_id", "text", "source", "lang"), keep_cols=["row"], lang_shares=LANG_SHARES)
    return mixed.where("sampled").select("row.*")


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document, and a digest of what they decode to."""
    path = default_path("byte_bpe_50k.json")
    return bpe.decode(bpe.encode(docs, path), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("bpe_round_trip", bpe_round_trip),
]

#: SQL can express neither the near-duplicate groups nor BPE; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
