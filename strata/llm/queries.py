"""The registered queries ``opN_<name>`` and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import read
from strata.llm.decontam import contamination_digest, find_contamination
from strata.llm.filter_audit import audit_filters
from strata.llm.fingerprints import fingerprint_documents
from strata.llm.jaccard import jaccard_result
from strata.llm.licences import scan_licences
from strata.llm.mixing import mix_result
from strata.llm.packing import pack_documents
from strata.llm.perplexity import perplexity_scores
from strata.llm.resampling import resample
from strata.llm.secrets import scan_secrets, secret_digest
from strata.llm.tokens import token_counts
from strata.llm.toxicity import toxicity_result
from strata.llm.warc import warc_round_trip

#: The vocabulary files' names; the folder is the installed package's (a parameter).
TOKEN_MODEL = "piece_bpe_32k.model"
PACKING_MODEL = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKEN_MODEL) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_result(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_round_trip(read(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan_secrets(read(spark, sf_dir, "documents")))


def op6_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read(spark, sf_dir, "documents"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(read(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_result(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), tokenizer_path())


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_result(read(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path(PACKING_MODEL))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from strata.llm import oracle

    return oracle.oracle_sql()
