"""A corpus made ready for training: toxic and poor documents go, repeated lines and near copies go, the rest is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm import line_dedup, minhash, packing, quality, toxicity
from wardloom.llm.common import reachable, settle, table, text_scores


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that are not predicted to be toxic; with nothing to learn from, all."""
    reachable(spark)
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return docs.filter(text_scores(model.scores)(F.col("text")) < 0.5) if model else docs


def of_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that are predicted to be good; with nothing to learn from, all."""
    reachable(spark)
    model = quality.fit(docs, table(spark, folder, "labels"))
    return docs.filter(text_scores(lambda texts: model.scores(quality.features(texts)))(F.col("text")) >= 0.5) if model else docs


def without_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents with the lines that stay; those of which only blank lines stay go, empty ones stay as they are."""
    reachable(spark)
    left = line_dedup.rebuilt(docs, "doc_id", "text")
    emptied = (F.col("removed") > 0) & ~F.col("body").rlike(line_dedup.INK)
    kept = left.filter(~F.coalesce(emptied, F.lit(False)))
    made = {c: F.col("doc").getField(c) for c in docs.columns} | {"text": F.col("body")}
    if "n_chars" in docs.columns:
        size = F.when(F.col("removed") > 0, F.length("body")).otherwise(made["n_chars"])
        made["n_chars"] = size.cast(docs.schema["n_chars"].dataType)
    return kept.select(*(made[c].alias(c) for c in docs.columns))


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies, of equal rows one; those without words stay.

    The document with the smallest id stays, one without an id only where no other has one; of several with that id the
    first by a hash of the whole row. Columns may have any name.
    """
    reachable(spark)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # ids may be null or repeat with other texts: a row goes by its id and a hash of all its columns
    own = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(*columns).alias("row"))
    found = minhash.near_duplicates(docs.select(own.alias("own"), "text"), key="own", width=5)
    kept = found.filter(F.col("own") == F.col("component_id")).select("own").distinct()
    whole = docs.select(F.struct(*columns).alias("doc"), own.alias("own"))
    return whole.join(kept, "own", "left_semi").dropDuplicates(["own"]).select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of the documents in training sequences, with their ids."""
    reachable(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("quality classifier", of_quality),
    ("line dedup", without_repeated_lines),
    ("MinHash near-dedup", without_near_copies),
    ("packing", packed),
]

#: SQL can't express the models, the fuzzy matches and the tokenizer; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages, each over all that the one before it kept."""
    docs = table(spark, folder, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if k < len(STAGES) - 1:
            docs = settle(docs)
    return docs
