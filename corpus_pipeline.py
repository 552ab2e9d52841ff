"""The corpus pipeline: documents -> cleaned, deduplicated, decontaminated, encoded.

Each stage is (name, function); a function takes (spark, docs, sf_dir), works on
all rows it is given and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of
``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.llm import bpe_codec, decontaminate, language_id, minhash_dedup, quality
from playstats.llm.common import find_package, shared_path

def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a 128-bit digest of id and text, and the name of that column, which
    ``docs`` does not have. The operators hand it on: ids may be null or repeated, so a
    verdict goes by both."""
    key = "_key"
    while key in docs.columns:
        key += "_"
    whole = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                     F.when(F.col("text").isNull(), ":").otherwise("="), F.coalesce("text", F.lit("")))
    return docs.withColumn(key, F.unhex(F.md5(whole))), key


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _keep(docs: DataFrame, keyed: DataFrame, key: str, verdicts: DataFrame, condition) -> DataFrame:
    """The rows of ``docs`` whose verdict meets the condition."""
    good = verdicts.filter(condition).select(F.col("row").alias(key)).distinct()
    # a shuffle join at every size: the verdicts are as many as the documents
    return keyed.join(good.hint("merge"), key, "left_semi").select(*_columns(docs))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the other documents teach: those whose letters
    fit the chosen mixture of languages better than noise (``language_id.LEAST_FIT``).

    A null, empty or letterless text goes. Repeated rows, null and repeated ids: each row
    by its own text. A very long text is judged as a whole. Without any row that names a
    language all go."""
    keyed, key = _keyed(docs)
    found = language_id.held_out_predictions(keyed, row_col=key)
    fits = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("fit") >= language_id.LEAST_FIT)
    return _keep(docs, keyed, key, found, fits)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the quality classifier accepts.

    Null and empty texts, repeated rows and very long texts have a score like any other;
    equal texts have equal scores, so they stay or go together."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    keyed, key = _keyed(docs)
    return _keep(docs, keyed, key, quality.quality_scores(keyed, labels, row_col=key), F.col("predicted") == 1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates: that with the smallest id, null
    last, then the smallest digest. Of rows with equal id and text, which may differ in
    other columns, the one whose other columns come first as JSON stays. Null, empty and
    wordless texts are near to nothing: one row of each id stays."""
    keyed, key = _keyed(docs)
    kept = minhash_dedup.one_of_each(keyed, key).withColumnRenamed("row", key)
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]), {"ignoreNullFields": "false"})
    # repeated rows become one before the shuffle, so no key is frequent in the join
    one = keyed.groupBy(key).agg(F.min_by(F.struct(*_columns(docs)), rest).alias("_one"))
    return one.join(kept, key, "left_semi").select(*[F.col("_one")[c].alias(c) for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which no benchmark window occurs, whatever their length. Null and
    empty texts have no window and stay; repeated rows stay or go together."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed, key = _keyed(docs)
    dirty = (decontaminate.contamination(keyed, benchmark, id_col=key).filter("contaminated")
             .select(F.col("doc_id").alias(key)).distinct())
    return keyed.join(dirty, key, "left_anti").select(*_columns(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document; a null text is
    encoded as the empty one, repeated rows give a row each."""
    return bpe_codec.codec_digest(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("bpe", encoded),
]

#: The learned stages and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage."""
    find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
