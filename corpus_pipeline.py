"""The training-data pipeline over ``documents``: each stage works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scdstar.llm import contain, jaccard, mixing, quality, tokenfiles
from scdstar.llm.common import table
from scdstar.session import stage

#: Expected tokens by domain. What is poor has gone by then, so two domains are left.
DOMAINS = {"good": 0.93, "toxic": 0.07}
#: Follows every document in the token files.
END_ID = 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list let pass."""
    _, rules = quality.judge(docs, table(spark, sf_dir, "labels"))
    return quality.apply_rules(docs, rules)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.8."""
    return jaccard.keep_one(docs, 5, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without four fifths of a benchmark item."""
    return contain.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates for the target weights say."""
    return mixing.take(docs, table(spark, sf_dir, "labels"), DOMAINS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, and what they hold for each document."""
    folder = tokenfiles.new_folder(spark, "pipeline-tokens")
    tokenfiles.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), folder, END_ID)
    return tokenfiles.read_tokens(spark, folder)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing_to_weights),
    ("token-id output", token_output),
]

#: SQL cannot express learned rules and rates; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
