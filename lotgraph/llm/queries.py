"""The contract queries of the training-data operators over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, incremental_join, jaccard_join, language_id, license_scan, mixing, pii_surrogates, quality_classifier, quality_rules, sharding, suffix_dedup, token_alignment, url_filters
from .oracles import ORACLES

#: Rules of the contract: (verdict, host, path).
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
N_SHARDS = 40
N_BATCHES = 5
#: From this score on a document counts as good.
GOOD = 0.7
#: Surrogates of the registered query; a production run passes its own secret.
SURROGATE_KEY = b"registered query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language_id.remainder("doc_id") == 1, F.lit(False))
    model = language_id.fit(docs, F.coalesce(language_id.remainder("doc_id") != 1, F.lit(False)))
    return language_id.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    out = quality_rules.apply_rules(docs, rules)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule_fired")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_classes(table(spark, sf_dir, "documents"), k=3, percent=90)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), length=100)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.byte_shards(table(spark, sf_dir, "documents"), N_SHARDS)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = token_alignment.align(docs, token_alignment.byte_bpe(), token_alignment.piece_bpe(), digest=lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256)))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rest = table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), learn_from=F.coalesce(rest != 2, F.lit(False)))
    out = quality_classifier.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op13_incremental_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc, shown = F.col("doc_id"), lambda c: F.coalesce(c.cast("string"), F.lit("null"))

    def moving(name: str, side: str, key, part) -> DataFrame:
        draw = lambda t: F.crc32(F.concat(F.lit(f"{side}:"), doc.cast("string"), F.lit(f":{t}")).cast("binary"))
        event = F.array(*[(draw(t) % 11).cast("int") for t in range(1, N_BATCHES + 1)])
        told = incremental_join.states(N_BATCHES, key, F.coalesce(draw(0) % 3 != 0, F.lit(True)), event, part)
        return incremental_join.versions(table(spark, sf_dir, name), told)

    half = F.expr("(doc_id - pmod(doc_id, 2)) div 2")
    docs = moving("documents", "d", lambda n: half + n, lambda n: shown(F.col("lang")))
    flipped = lambda n: F.when(n % 2 == 1, 1 - F.col("quality")).otherwise(F.col("quality"))
    labels = moving("labels", "l", lambda n: half, lambda n: F.concat(shown(flipped(n)), F.lit(","), shown(F.col("toxic"))))
    out = incremental_join.maintain(docs, labels, N_BATCHES, how="left")
    part = F.when(F.col("right_padded"), "-").otherwise(F.col("right_part"))
    return out.select("batch", F.col("key").alias("join_key"), F.col("left_part").alias("doc_part"), part.alias("label_part"), "weight", "total")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_language_id,
        op3_pii_surrogates,
        op4_quality_rules,
        op5_jaccard_join,
        op6_url_filters,
        op7_suffix_dedup,
        op8_license_scan,
        op9_mixing,
        op10_sharding,
        op11_token_alignment,
        op12_quality_classifier,
        op13_incremental_join,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
