"""The corpus pipeline: each stage works on what its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import bpe, decontamination, jaccard_join, language_id, pii, tables
from tillwork.session import new_folder, remove_folder, scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is undetermined or ambiguous go.

    Null and empty texts, and such without a letter, have no language; texts of any length are read whole; equal texts are judged alike;
    a tie between languages is ambiguous; an empty table stays empty.
    """
    tables.use_small_batches(spark)
    rows, restore = tables.set_aside(docs, language_id.ADDED)
    judged = language_id.predict(rows, language_id.train(language_id.learning_rows(docs)))
    return restore(judged.where((F.col("lang_pred") != language_id.UNDETERMINED) & ~F.col("ambiguous")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; documents without an id all stay.

    Differing texts of one id are documents of their own: all but one get an id above all others for this stage.
    """
    digest = F.coalesce(F.sha2("text", 256), F.lit(""))
    texts = docs.where("doc_id is not null").select("doc_id", digest.alias("_text_digest")).distinct()
    several = texts.groupBy("doc_id").agg(F.min("_text_digest").alias("first"), F.count("*").alias("n")).where("n > 1")
    further = texts.join(several, "doc_id").where("_text_digest <> first").select("doc_id", "_text_digest")
    further = tables.cut(spark, further.withColumn("_number", F.monotonically_increasing_id()), "further-texts")
    if further.isEmpty():
        return _first_of_each(spark, docs)
    above = docs.agg(F.max("doc_id")).first()[0] + 1
    named = docs.withColumn("_text_digest", digest).join(further, ["doc_id", "_text_digest"], "left")
    named = named.withColumn("_given_id", F.col("doc_id")).withColumn("doc_id", F.coalesce(F.col("_number") + F.lit(above), F.col("doc_id")))
    kept = _first_of_each(spark, tables.cut(spark, named, "named-texts"))
    return kept.withColumn("doc_id", F.col("_given_id")).select(*docs.columns)


def _first_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    joined = jaccard_join.join(spark, docs)
    first = joined.where("doc_id = component_id").select("doc_id")
    # Equal rows of one id are copies too.
    one_each = docs.where("doc_id is not null").join(first, "doc_id", "left_semi")
    return one_each.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents that mostly consist of them go.

    Null and empty texts stay as they are, repeated rows are treated alike, texts of any length are read whole, a text of which just half
    the words are hit stays, and an empty benchmark changes nothing.
    """
    tables.use_small_batches(spark)
    rows, restore = tables.set_aside(docs, ("decontamination",))
    marked = decontamination.mark(rows, tables.read(spark, sf_dir, "benchmark"))
    return tables.with_length(restore(decontamination.remove_spans(marked)))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by a mark of its kind.

    Null and empty texts stay as they are, repeated rows are treated alike, texts of any length are read whole; where finds overlap the
    one that begins first, then the longer one, gives its mark to both.
    """
    tables.use_small_batches(spark)
    return tables.with_length(pii.mask(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to.

    Null and empty texts have no ids and decode to an empty text, repeated rows stay, texts of any length are encoded whole.
    """
    tables.use_small_batches(spark)
    encoded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), bpe.vocabulary_path())
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language id", identify_language),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("personal data", mask_personal_data),
    ("byte pair encoding", tokenize),
]

#: SQL cannot express the trained language models and the pair merges; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written and read again.

    What a stage writes for itself goes when its result is written, and the result when its successor's is. Only the last one
    stays, until the process ends.
    """
    docs, before = tables.read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = new_folder(spark, name.replace(" ", "-"))
        try:
            with scratch(spark):
                stage(spark, docs, sf_dir).write.parquet(folder)
        except BaseException:
            remove_folder(spark, folder)
            raise
        finally:
            if before is not None:
                remove_folder(spark, before)
        docs, before = spark.read.parquet(folder), folder
    return docs
