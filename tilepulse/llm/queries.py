"""The registered queries of the subpackage: each applies one operator to its whole table.

A query reads ``sf_dir`` through Spark only, calls the operator with production parameters and
derives the contract's digest columns from the operator's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, filter_audit, html_text, importance, lexical, neighbours, pii, quality_rules, secret_scan
from . import simhash, substrings, toxicity


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _span_digests(found: DataFrame, base_kinds: tuple[str, ...]) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*base_kinds))
    return found.select(
        "doc_id",
        *[_count(spans, k) for k in base_kinds],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return _span_digests(pii.find_pii(read(spark, sf_dir, "documents")), pii.BASE_KINDS)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, symbol, line and repetition measures of every document, and the verdict."""
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract_main_text(read(spark, sf_dir, "pages"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it leaks."""
    leaks = decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return leaks.drop("text_hash")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy group of every document."""
    return simhash.simhash_groups(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 20-word windows that started earlier."""
    return substrings.remove_repeats(read(spark, sf_dir, "documents"), window=20, with_text=False).drop("text")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample of documents that resembles the labelled good ones."""
    return importance.importance_sample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels that are not held out."""
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def tokenizer_file() -> str:
    """The public tokenizer of the encoding query (a parameter of the operator)."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op9_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    return bpe.encode_digests(read(spark, sf_dir, "documents"), tokenizer_file())


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return _span_digests(secret_scan.find_secrets(read(spark, sf_dir, "documents")), secret_scan.BASE_KINDS)


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found of every fiftieth vector."""
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), every=50, k=5)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return lexical.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=50)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors, removals, redundancies and label losses of five filters in every order."""
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_quality_rules": op2_quality_rules,
    "op3_html_extraction": op3_html_extraction,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_toxicity": op8_toxicity,
    "op9_bpe_encoding": op9_bpe_encoding,
    "op10_secret_scans": op10_secret_scans,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_ranked_search": op12_ranked_search,
    "op13_filter_audit": op13_filter_audit,
}
