"""The training-corpus pipeline: five stages from ``documents`` to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next one's ``docs``. The last stage returns
digests of the ids and of the decoded text; the others return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm import line_dedup, mixing, quality, sentencepiece_codec, simhash
from airlake.llm.common import materialize, table
from airlake.llm.queries import piece_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels table.

    Null and empty texts are one empty line and scored like others; texts of any
    length are read whole; equal rows get equal scores and stay or go together; with labels
    of one kind or none every document has their share of label 1 (0.5 without labels) as its score.
    An empty table gives no rows; other columns of ``docs`` are not looked at."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that an earlier one holds; n_chars follows the text.

    Null text becomes empty; rows with one id are one document and keep the lines
    they share; rows with a null id keep all lines; a document that loses all its lines stays, empty.
    An empty table gives no rows; other columns stay as they are."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id.

    Texts without a word (null, empty, blanks) are one group; of rows with one id that
    are in one group one stays, chosen by a hash of the text; a group of null ids only keeps one row.
    An empty table gives no rows; other columns stay as they are."""
    return simhash.one_per_group(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all documents by source weight; a document taken twice is two rows.

    Texts without a word (null, empty, blanks) take no part; null sources are one
    source; equal rows are taken one by one; a document is taken whole, however long, three times at most.
    An empty table gives no rows; other columns stay as they are."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every row's SentencePiece ids and of their decoded text.

    Null and empty texts have no ids; texts of any length are encoded whole; repeated
    rows and null ids pass through one to one. An empty table gives no rows."""
    return sentencepiece_codec.codec_digest(docs, piece_model())


STAGES = [
    ("quality classifier", drop_low_quality),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("source mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: SQL cannot express the classifier or the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table to the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
