"""A corpus from raw documents to tokens, in five stages.

1. ``toxicity``: documents that the toxicity model rejects go;
2. ``line_dedup``: lines that repeat an earlier line, or differ from one by a word, go;
3. ``ngram_join``: of each class of near-duplicate documents the first stays;
4. ``mixing``: documents are taken as often as the source weights ask for;
5. ``bpe``: every text is encoded, and decoded again; the result has a row per text taken.

Each stage works on what the one before it wrote. Labels come from the given tables.
SQL cannot express the learned model, so ``ORACLE_SQL`` is None; ``tests/llm`` holds the stages
against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm import bpe, line_dedup, mixing, ngram_join, toxicity
from linkrank.llm.common import Scratch, cut, table
from linkrank.llm.queries import TOKENIZER, tokenizer_path

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(docs, min_words=5, near_words=10)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, threshold=0.8, n=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs, weights=(3.0, 1.0, 2.0), share=1.5, cap=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, tokenizer_path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_each_class),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir))
    result = cut(STAGES[-1][1](spark, docs, sf_dir))
    scratch.release()
    return result
