"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.bpe import encode_digests
from tagloom.llm.common import table
from tagloom.llm.decontaminate import contaminated
from tagloom.llm.embedding_dedup import near_vectors
from tagloom.llm.fingerprints import compare_edited
from tagloom.llm.fingerprints import digest as fingerprint_digest
from tagloom.llm.language_id import identify
from tagloom.llm.license_scan import scan_licenses
from tagloom.llm.line_dedup import dedup_lines
from tagloom.llm.minhash import near_duplicates
from tagloom.llm.pii import digest, scan_pii
from tagloom.llm.prefix_trie import prefix_trie
from tagloom.llm.resample import resample
from tagloom.llm.source_divergence import audit
from tagloom.llm.toxicity import score_toxicity


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), inside=True)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).drop("n_pass_links")


def op7_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan_pii(table(spark, sf_dir, "documents"), scope="text"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_digest(compare_edited(table(spark, sf_dir, "documents")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_license_scan": op4_license_scan,
    "op5_line_dedup": op5_line_dedup,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_resample": op7_resample,
    "op8_pii": op8_pii,
    "op9_minhash": op9_minhash,
    "op10_language_id": op10_language_id,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fingerprints": op12_fingerprints,
    "op13_source_divergence": op13_source_divergence,
}
