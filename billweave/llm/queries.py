"""The registered queries of this subpackage, with the operators' production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.llm import (
    decontaminate,
    line_crf,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    pii,
    quality_rules,
    secrets,
    spelling,
    suffix_index,
    warc_audit,
    whitening,
)
from billweave.llm.oracle import ORACLES
from billweave.staging import staged

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_spans(table(spark, sf_dir, "documents")))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.verdicts(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_index.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def _damaged(records: DataFrame) -> DataFrame:
    """A replica with bad records: by their digests one in 64 changed, one in 256 lost."""
    lost, changed = F.col("digest").startswith("ff"), F.substring("digest", 1, 2).isin("00", "01", "02", "03")
    worse = F.sha2(F.concat(F.lit("damaged "), "digest").cast("binary"), 256)
    return records.where(~lost).withColumn("digest", F.when(changed, worse).otherwise(F.col("digest")))


def op5_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC files and a damaged replica: per file its roots and the damage."""
    primary = staged(warc_audit.warc_layout(table(spark, sf_dir, "pages")), "warc-primary")
    replica = staged(_damaged(primary), "warc-replica")
    trees = warc_audit.merkle_tree(primary), warc_audit.merkle_tree(replica)
    found = warc_audit.audit(primary, replica, trees).groupBy("file").agg(
        F.count_if(F.col("status") == "changed").alias("n_changed"),
        F.count_if(F.col("status") == "missing").alias("n_missing"),
        F.array_join(F.sort_array(F.collect_list("offset")).cast("array<string>"), ",").alias("offsets"),
    )
    files = primary.groupBy("file").agg(F.count(F.lit(1)).alias("n_records"), F.sum("length").alias("n_bytes"))
    root = lambda tree, name: warc_audit.roots(tree).withColumnRenamed("hash", name)
    return (
        files.join(root(trees[0], "primary_root"), "file")
        .join(root(trees[1], "replica_root"), "file", "left")
        .join(found, "file", "left")
        .na.fill(0, ["n_changed", "n_missing"])
        .na.fill("", ["offsets"])
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.keep_bitmaps(table(spark, sf_dir, "documents"))
    kept = line_dedup.kept_text(F.col("text"), F.col("_keep"))
    return found.select(
        "doc_id",
        F.col("_lines").alias("n_lines"),
        F.col("_dropped").alias("n_dropped"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.secret_spans(table(spark, sf_dir, "documents")))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_line_crf": op1_line_crf,
        "op2_pii": op2_pii,
        "op3_quality_rules": op3_quality_rules,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_warc_audit": op5_warc_audit,
        "op6_mixing": op6_mixing,
        "op7_line_dedup": op7_line_dedup,
        "op8_secret_scan": op8_secret_scan,
        "op9_near_dedup": op9_near_dedup,
        "op10_decontaminate": op10_decontaminate,
        "op11_packing": op11_packing,
        "op12_spelling_groups": op12_spelling_groups,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
