"""The corpus pipeline: five stages over the documents, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next stage's docs. All but the last return the columns of
docs. Null and empty texts have no language and go in the first stage; an empty
table passes through every stage; further columns are carried along whatever
their names; a null id or source is a value like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biasloom.llm import cube_mix, decontaminate, language_id, simhash, token_blocks
from biasloom.llm.common import Scratch, output_folder, row_key, table
from biasloom.llm.queries import TOKENIZER

#: No SQL expresses the stages; tests/llm holds them against plain versions.
ORACLE_SQL = None
LAST_ID = (1 << 63) - 1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language of which it is sure go.

    The verdict comes with the row itself.
    """
    carried = {f"cp__{k}": c for k, c in enumerate(docs.columns)}
    judged = language_id.identify(docs, Scratch(spark, "language"), carry=carried)
    return judged.filter("kept").select(*(F.col(k).alias(c) for k, c in carried.items()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group the document with the least id stays.

    Rows without an id come last in that order; among rows of one id the least
    hash of all columns and their nulls decides, and of rows alike in everything one
    stays.
    """
    name = F.struct(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        row_key(docs).alias("key"),
    )
    named = docs.withColumn("cp__name", name)
    found = simhash.near_duplicates(named, Scratch(spark, "simhash"), id="cp__name")
    first = found.filter("cp__name = component_id").select(
        F.col("cp__name.id").alias("cp__a"), F.col("cp__name.key").alias("cp__b")
    )
    kept = named.join(
        first.distinct(),
        (F.col("cp__name.id") == F.col("cp__a")) & (F.col("cp__name.key") == F.col("cp__b")),
    )
    alike = Window.partitionBy("cp__a", "cp__b").orderBy("cp__b")
    return (
        kept.withColumn("cp__n", F.row_number().over(alike))
        .filter("cp__n = 1")
        .select(*docs.columns)
    )


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: passages of test items are cut out of the texts.

    ``n_chars`` follows the text. A document that is mostly test items goes.
    """
    inner = {c: f"cp__{i}" for i, c in enumerate(docs.columns)}
    scratch = Scratch(spark, "decontaminate")
    found = decontaminate.find(
        docs.withColumnsRenamed(inner),
        table(spark, sf_dir, "benchmark"),
        scratch,
        text=inner["text"],
    )
    # Written, or a task would hold a Python worker for each of the two steps.
    found = scratch.keep(found, "found")
    clean = decontaminate.remove(found, text=inner["text"])
    if "n_chars" in inner:
        length = F.length(inner["text"]).cast(docs.schema["n_chars"].dataType)
        changed = F.when(F.col("n_hit") > 0, length).otherwise(F.col(inner["n_chars"]))
        clean = clean.withColumn(inner["n_chars"], changed)
    return clean.select(*(F.col(i).alias(c) for c, i in inner.items()))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: rows come as often as the mix takes them."""
    return cube_mix.mixed(docs, Scratch(spark, "mix"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID output: writes files that stay, returns a row for each document in them."""
    scratch = Scratch(spark, "tokens")
    folder = output_folder(spark, "pipeline")
    token_blocks.write(docs, scratch, TOKENIZER, folder=folder)
    return token_blocks.by_document(folder, scratch=scratch).withColumnRenamed("doc", "doc_id")


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for turn, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{turn}")
        if turn:
            scratch.drop(f"stage-{turn - 1}")
    return docs
