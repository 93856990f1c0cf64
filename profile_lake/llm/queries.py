"""The operators of this package as queries over the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profile_lake.llm import (
    alignment,
    bpe,
    decontaminate,
    fixity,
    jaccard,
    language,
    licences,
    pii,
    quality,
    seeds,
    sharding,
    spelling,
    suffix_dedup,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rank_file() -> tuple[str, str]:
    """Path of the merge ranks and the pattern that goes with them."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["exact"])
    joined = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first_word"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["first_word"])).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)).alias("score"),
    )


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.trained(docs, ~held_out())
    return language.identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(documents(spark, sf_dir))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] < 4)
    count = lambda n: F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")
    return found.select(
        "doc_id",
        *[count(n).alias(f"n_{kind.name}") for n, kind in enumerate(pii.KINDS[:4])],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), *rank_file())


def damaged(pages: DataFrame) -> DataFrame:
    """A second replica: one page in sixteen has a changed first character, others are lost.

    The sample tables hold one copy of each page; which are damaged follows from the MD5
    of page_id, so the result grows with the table.
    """
    key = F.md5(F.col("page_id").cast("string").cast("binary"))
    changed = F.coalesce(key.startswith("0"), F.lit(False))
    lost = F.coalesce(key.startswith("1f"), F.lit(False))
    html = F.when(changed, F.concat(F.lit("?"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    return pages.filter(~lost).select("page_id", "url", html.alias("html"))


def op7_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return fixity.compare(fixity.manifest(pages), fixity.manifest(damaged(pages)))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, sf_dir), benchmark(spark, sf_dir))
    n_hit = decontaminate.covered_words(F.col("spans")).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeds.removal_digests(documents(spark, sf_dir))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.component_ids(documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.forms(spelling.counted_words(documents(spark, sf_dir)))


def tokenizer_files() -> tuple[str, str, str]:
    """Paths of the two vocabularies that are aligned, and the pattern that goes with the first."""
    import public_tokenizers

    path = public_tokenizers.path
    return path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), public_tokenizers.PATTERN


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(documents(spark, sf_dir), *tokenizer_files())
    total = F.aggregate("links", F.lit(0).cast("long"), lambda sum, link: sum + link["n"])
    return found.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.size("links").cast("long").alias("n_links"),
        F.size(F.filter("links", lambda link: link["best"])).cast("long").alias("n_best"),
        total.alias("count_sum"),
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
    )


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_licences": op2_licences,
    "op3_language": op3_language,
    "op4_suffixes": op4_suffixes,
    "op5_pii": op5_pii,
    "op6_bpe": op6_bpe,
    "op7_fixity": op7_fixity,
    "op8_decontaminate": op8_decontaminate,
    "op9_repeats": op9_repeats,
    "op10_jaccard": op10_jaccard,
    "op11_spelling": op11_spelling,
    "op12_alignment": op12_alignment,
    "op13_sharding": op13_sharding,
}
