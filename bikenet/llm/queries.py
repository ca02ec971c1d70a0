"""The text queries by name, each over its whole table, and SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikenet.llm import bpe
from bikenet.llm.decontamination import find_leaks
from bikenet.llm.jaccard_join import similar_texts
from bikenet.llm.lexical_search import SEARCH_SQL, search
from bikenet.llm.licenses import scan_licenses
from bikenet.llm.merkle import manifest, manifest_sql, without_line_ends
from bikenet.llm.permutation_index import nearest_neighbours
from bikenet.llm.personal_data import personal_data
from bikenet.llm.quality import quality
from bikenet.llm.revisits import PAGES_SQL, captures_of_pages, header_lines, resolve_revisits
from bikenet.llm.secrets import find_secrets
from bikenet.llm.token_counts import token_counts
from bikenet.llm.toxicity import toxicity
from bikenet.session import shared_folder, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register under the function's name; the package goes to the executors first."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document, encoded and decoded by the merge automaton."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, counted through a new digest cache."""
    return token_counts(
        table(spark, sf_dir, "documents"), shared_folder(spark, "token-counts"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query
def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every revisit of the captures of ``pages`` stands for."""
    pages = table(spark, sf_dir, "pages").filter("page_id IS NOT NULL")
    return resolve_revisits(captures_of_pages(pages)).select(
        "capture_id", "url_key", "status", "response_id", header_lines(F.col("headers")).alias("header_lines"))


ORACLE["op4_warc_revisits"] = PAGES_SQL


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of similarity 0.8 on five-word shingles."""
    return similar_texts(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license statements of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of secrets in every document."""
    return find_secrets(table(spark, sf_dir, "documents"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof and check of every document against the root of all; every other one is shown without line ends."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return manifest(table(spark, sf_dir, "documents"), without_line_ends(tampered))


ORACLE["op11_merkle_manifest"] = manifest_sql()


@query
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of personal data in every document."""
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that rank highest for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_lexical_search"] = SEARCH_SQL
