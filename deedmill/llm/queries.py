"""The queries of this subpackage over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from deedmill.llm import alignment, bpe, line_dedup, minhash, mixing, pii, quality, sharding, spelling, token_counts, token_files, urls, vector_dedup
from deedmill.llm.tokenizers import default_path
from deedmill.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_pii(spark, sf_dir):
    return pii.find_pii(_table(spark, sf_dir, "documents"))


URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


@query
def op2_url_filters(spark, sf_dir):
    return urls.judge_urls(_table(spark, sf_dir, "pages"), urls.make_rules(spark, URL_RULES))


@query
def op3_bpe_round_trip(spark, sf_dir):
    path = default_path("byte_bpe_50k.json")
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), path)
    return bpe.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"))


@query
def op5_minhash_near_dedup(spark, sf_dir):
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


#: The id that closes a document in the token files.
END_OF_DOCUMENT = 1


@query
def op6_token_files(spark, sf_dir):
    folder = scratch_path(spark, "token-files")
    path = default_path("word_bpe_49k.json")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, path, end_id=END_OF_DOCUMENT)
    return token_files.with_crc32(token_files.read_token_files(spark, folder)).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


@query
def op7_sharding(spark, sf_dir):
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


@query
def op8_vector_near_dedup(spark, sf_dir):
    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


@query
def op9_quality_rules(spark, sf_dir):
    return quality.judge(_table(spark, sf_dir, "documents"), ["doc_id"])


#: Target shares of languages; others share the rest by their tokens.
LANG_SHARES = {"en": 0.5, "de": 0.15, "es": 0.15, "fr": 0.15}


@query
def op10_source_mixing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix(docs, keep_cols=["doc_id", "source", "lang"], lang_shares=LANG_SHARES)


@query
def op11_line_dedup(spark, sf_dir):
    found = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_spelling_variants(spark, sf_dir):
    # 31: of the runs of letters about one in as many is misspelt on purpose
    return spelling.spelling_forms(_table(spark, sf_dir, "documents"), noise=31)


@query
def op13_tokenizer_alignment(spark, sf_dir):
    paths = default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model")
    return alignment.align_tokenizers(_table(spark, sf_dir, "documents"), *paths)
