"""The registered queries of the subpackage, with production parameters, and
DuckDB SQL for those that SQL can express (``playstats.llm.oracle``)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.llm import (
    bpe_codec,
    decontaminate,
    fingerprints,
    histogram_shards,
    language_id,
    lm_score,
    minhash_dedup,
    oracle,
    prefix_trie,
    quality,
    token_alignment,
    token_counts,
    token_orc,
    warc_fixity,
)
from playstats.llm.common import find_package, shared_path


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf, "documents"))


def damaged(kept: DataFrame) -> DataFrame:
    """(file_no, record) of a replica with damage, sorted by file: by the first byte of the
    id's SHA-256, 00-03 first character overwritten, 04 and 05 record lost, 06 last
    character lost, 07 record twice.

    A file is read whole by one task, so its records are put in order there; no record is
    shuffled."""
    rec = F.col("record")
    draw = F.substring(F.sha2(warc_fixity.record_id(rec).cast("string"), 256), 1, 2)
    head = F.concat(F.substring_index(rec, warc_fixity.GAP, 1), F.lit(warc_fixity.GAP))
    body = F.substring(rec, F.char_length(head) + 1, F.char_length(rec))
    bitten = F.when(F.char_length(body) > 0, F.concat(head, F.lit("~"), F.substring(body, F.lit(2), F.char_length(body)))).otherwise(rec)
    short = F.when(F.char_length(body) > 0, F.concat(head, F.substring(body, F.lit(1), F.char_length(body) - 1))).otherwise(rec)
    rows = (kept.withColumn("draw", draw)
            .filter(~F.coalesce(F.col("draw"), F.lit("")).isin("04", "05"))
            .withColumn("record", F.when(F.col("draw") < "04", bitten).when(F.col("draw") == "06", short).otherwise(rec))
            .withColumn("copy", F.explode(F.when(F.col("draw") == "07", F.array(F.lit(1), F.lit(2)))
                                          .otherwise(F.array(F.lit(1))))))
    return rows.sortWithinPartitions("file_no", "block", "seq", "copy").select("file_no", "record")


def op3_warc_fixity(spark: SparkSession, sf: str) -> DataFrame:
    """Archives ``pages`` as WARC files and a second replica of them with damage
    (:func:`damaged`); returns the audit of every record."""
    first, second = shared_path(spark, "warc-first"), shared_path(spark, "warc-second")
    warc_fixity.write_warc(table(spark, sf, "pages"), first)
    kept = warc_fixity.read_warc(spark, first)
    warc_fixity.write_records(damaged(kept), second)
    trees = warc_fixity.build_trees(kept, warc_fixity.read_warc(spark, second))
    return warc_fixity.audit(*trees).select("page_id", "n_bytes", "sha256", "found_sha256", "status")


def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination_digest(
        decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


def op5_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_codec.codec_digest(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprint_digest(fingerprints.fingerprint_pairs(table(spark, sf, "documents")))


def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.held_out_predictions(table(spark, sf, "documents"))


def op9_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    """Target: the documents labelled good (labels.quality = 1)."""
    good = table(spark, sf, "labels").filter("quality = 1")
    out = lm_score.cross_entropy_difference(table(spark, sf, "documents"), good, words=None)
    return out.withColumns({c: F.round(c, 6) for c in ("ce_target", "ce_background", "score")})


def op10_token_orc(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "token-orc")
    token_orc.write_token_orc(table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_orc.token_digest(spark, path)


def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return token_alignment.token_alignment(
        table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), digest=True)


def op12_histogram_shards(spark: SparkSession, sf: str) -> DataFrame:
    return histogram_shards.sharded(table(spark, sf, "documents"), shards=16)


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf, "conversations")).drop("turn_md5")


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline  # lies beside the package, which can be used without it

    return corpus_pipeline.run(spark, sf)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_warc_fixity": op3_warc_fixity,
    "op4_decontaminate": op4_decontaminate,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_quality": op6_quality,
    "op7_fingerprints": op7_fingerprints,
    "op8_language_id": op8_language_id,
    "op9_lm_score": op9_lm_score,
    "op10_token_orc": op10_token_orc,
    "op11_token_alignment": op11_token_alignment,
    "op12_histogram_shards": op12_histogram_shards,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": pipeline,
}

LLM_ORACLE_SQL: dict[str, str] = dict(oracle.ORACLE_SQL)
