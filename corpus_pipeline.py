"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, repeated passages
are cut, sources are mixed to their targets, and what remains is encoded as SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm import mixing, ngramjoin, pieces, suffixdedup, toxicity
from strandline.llm.common import materialize, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; its language model counts all of docs."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model, keep=COLUMNS).where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """The document of smallest id of each group that shingle similarity links."""
    return ngramjoin.one_of_each(docs.select(*COLUMNS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Texts without the strings of 100 bytes that also start earlier; n_chars follows the new text."""
    cut = suffixdedup.dedup_substrings(docs, keep=("lang", "source"))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Each document as often as its source's repetition rate asks for."""
    return mixing.mix_sources(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """doc_id, copy, ids and n_pieces of each document, checked to decode to its text; copies of a document are numbered, and
    each has a segmentation of its own."""
    # texts without words or id may stand in any number of rows: they are not gathered, and all count as first copies
    plain = F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    w = Window.partitionBy("doc_id", F.xxhash64("text"), F.when(plain, F.monotonically_increasing_id())).orderBy(F.lit(0))
    numbered = docs.select("doc_id", "text", F.row_number().over(w).alias("copy"))
    return pieces.encode_sampled(numbered, copy="copy").select("doc_id", "copy", "ids", "n_pieces", "lossless")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: SQL cannot express the sampled encoding or the toxicity model; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
