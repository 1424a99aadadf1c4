"""The corpus pipeline: language, near copies, repeated passages, mixture, packing.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame; what it returns is
written as Parquet and read again as the next stage's documents. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketspark.llm import language, minhash, mixing, packing, suffixes
from marketspark.llm.common import kept, table, tokenizer


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter have no language and go; a null ``lang`` becomes the predicted language.

    So null and empty texts go. Other values, repeated rows and rows without an id stay as they are; texts of
    any length are read whole; further columns, whatever their names, are kept; no rows give no rows.
    """
    return language.known_language(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of least id: five words, 0.8.

    Texts without a word, null and empty ones too, resemble nothing and stay, and so do rows without an id. Of
    rows that repeat an id one stays, by a hash of its values. Texts are compared whole; rows keep all their
    columns, whatever their names; no rows give no rows.
    """
    return minhash.one_of_each(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes that a document of smaller id has are cut out; every row stays, ``n_chars`` follows.

    Null texts stay null, empty ones empty. Rows without an id lose nothing and take nothing away; rows that
    repeat an id do not cut each other. Texts of up to 256 MB are read whole; of a character that is cut in the
    middle nothing stays; other columns, whatever their names, are kept; no rows give no rows.
    """
    return suffixes.without_passages(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, so some not at all and some twice.

    A null source is one source, the last. Texts without a word, null and empty ones too, have size 0 and are
    drawn like others. Ties of the draw go by id; repeated rows are drawn alike and count each. Columns stay,
    whatever their names; no rows give no rows.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece of a training sequence; every token of every row lies in exactly one.

    A null or empty text is its closing id only. Texts of any length are cut freely; repeated rows and rows
    without an id are packed like others; further columns are not looked at; no rows give no rows.
    """
    return packing.pack(docs, tokenizer=tokenizer())


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_passages),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs


#: Tokenising, profiles and signatures have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None
