"""Documents to training tokens: quality, language, near copies, source mix, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from seqprep.llm import bpe, language_id, mixing, ngram_join, quality
from seqprep.sources.package import ship_package
from seqprep.sources.spool import spool

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NEAR_WORDS, NEAR_PERCENT = 5, 80  # shingles of the near-copy stage, and the share of the union that links; op9 has its own
ORACLE_SQL = None  # the first two stages score with fitted models; stages are tested one by one


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on at most ``quality.TRAIN_DOCS`` labelled ones, accepts.

    Null texts are scored as empty ones; the whole text counts at any length; equal texts are judged alike and
    repeated rows each for itself. An empty table stays empty; columns other than those of documents go.
    """
    ship_package(spark)
    machine = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs.select(*COLUMNS), machine, output="quality_score")
    return scored.filter(F.col("quality_score") >= quality.THRESHOLD).select(*COLUMNS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is nearer to a language's codeword than a text that says nothing.

    Null and empty texts and those without a letter go, and so do texts in letters of no language of the model.
    A close call between two languages stays. The whole text counts, in windows; equal texts and repeated rows
    are judged alike; without any labelled document all go. Columns other than those of documents go.
    """
    ship_package(spark)
    found = language_id.predict(docs.select(*COLUMNS), language_id.train(docs), output="found")
    return found.filter("found.known").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked texts the row with the smallest id.

    Texts link from ``NEAR_PERCENT`` percent of common ``NEAR_WORDS``-word shingles on. Rows are compared, not
    ids: a hash of id and text stands for a row, so rows that repeat both stay once, rows that share an id only
    are decided apart, and rows without an id take part (they come after those with one). Null texts, empty
    ones and those without words are linked with nothing. Texts are compared whole; an empty table stays empty;
    columns other than those of documents go.
    """
    ship_package(spark)
    row_key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    keyed = docs.select(*COLUMNS, row_key.alias("row_key"))
    found = ngram_join.ngram_join(keyed, identity="row_key", size=NEAR_WORDS, percent=NEAR_PERCENT)
    names = keyed.select(F.col("row_key").alias("doc_id"), F.col("doc_id").alias("own_id")).distinct()
    order = F.struct(F.col("own_id").isNull(), "own_id", "doc_id")
    groups = found.select("doc_id", "component_id").distinct().join(names, "doc_id").groupBy("component_id")
    first = groups.agg(F.min_by("doc_id", order).alias("row_key")).select("row_key")
    return keyed.join(first, "row_key", "left_semi").dropDuplicates(["row_key"]).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, each row decided by its own hash and its source's threshold.

    Null and empty texts and those without words are not taken. A null source is a source of its own; rows of
    one id stand or fall together, null ids share a hash. Texts of any length count whole; an empty table stays
    empty; columns other than those of documents go. The texts are not shuffled.
    """
    ship_package(spark)
    _, limits = mixing.mix_limits(docs)
    sized = docs.select(
        *COLUMNS, mixing.size_of(F.col("text")).alias("size"), mixing.hash_digits(F.col("doc_id")).alias("digits")
    )
    taken = mixing.take_by_limits(sized.filter("size > 0"), limits).filter("taken > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return taken.withColumn("copy", copies).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and whether they decode to the text again.

    Null and empty texts have no ids and decode to the empty text. Whole texts are encoded; every row is
    answered for itself, repeated ones too; an empty table stays empty; further columns go.
    """
    ship_package(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, ids="ids", decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    number = F.size("ids").cast("bigint")
    return encoded.select("doc_id", "lang", "source", number.alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources", mixed_sources),
    ("BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; what each keeps is stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = spool(docs, "pipeline")
    return docs
