"""The registered queries: each operator over its whole table.

They call the operators with their production parameters and derive the digest
columns from what the operators return.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biasloom.llm import (
    cube_mix,
    decontaminate,
    hard_negatives,
    html_extract,
    language_id,
    oracles,
    pii,
    quality,
    secret_scan,
    simhash,
    spelling,
    suffix_dedup,
    token_blocks,
    url_filter,
)
from biasloom.llm.common import Scratch, output_folder, table

#: The tokenizer file, by its name in the collection of public tokenizers.
TOKENIZER = "byte_bpe_50k.json"

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: SQL twins, where SQL can express a query.
ORACLES: dict[str, str] = {
    "op1_decontaminate": oracles.OP1,
    "op10_suffix_dedup": oracles.OP10,
    "op13_hard_negatives": oracles.OP13,
}


def query(f: Callable[[SparkSession, str], DataFrame]):
    REGISTRY[f.__name__] = f
    return f


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark")
    found = decontaminate.find(docs, items, Scratch(spark, "decontaminate"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), Scratch(spark, "urls"))


@query
def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    host, _ = url_filter.address(F.col("url"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html", host.alias("host"))
    found = html_extract.main_text(pages, Scratch(spark, "html"))
    return found.select("page_id", "url", "text", "n_chars")


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, Scratch(spark, "language"))


@query
def op5_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "tokens")
    folder = output_folder(spark, "op5_token_blocks")
    token_blocks.write(docs, scratch, TOKENIZER, folder=folder)
    return token_blocks.by_document(folder, scratch=scratch).withColumnRenamed("doc", "doc_id")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality.judge(docs, Scratch(spark, "quality"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    return judged.select(*columns, "n_repeat_words", "posterior", "base_failed", "kept")


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    model = secret_scan.KINDS.index("model")
    base = F.filter("spans", lambda s: s["kind"] != model)
    return found.select(
        "doc_id",
        *(
            secret_scan.counted(F.col("spans"), kind).alias(f"n_{kind}")
            for kind in ("assign", "access", "hex")
        ),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


@query
def op8_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cube_mix.mix(docs, Scratch(spark, "mix")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


@query
def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, Scratch(spark, "simhash"))


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = suffix_dedup.deduplicate(docs, Scratch(spark, "suffixes"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.scan(docs, tagger=pii.train(docs))

    def counted(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(counted(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)),
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spelling.group(docs, Scratch(spark, "spelling"), deleting=31)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(
        rows.withColumn("label", noisy), Scratch(spark, "negatives"), F.col("vec_id") % 100 == 0
    )


@query
def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, from its text, markup, address and host."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ").alias("text"),
        F.regexp_extract("html", r"<html[^>]*\slang=[\"']?([A-Za-z-]+)", 1).alias("lang"),
    )
    return language_id.identify(
        pages, Scratch(spark, "pages"), id="page_id", host=None, address="url"
    )
