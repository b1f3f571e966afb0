"""The corpus pipeline: the stages from raw documents to token files."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketweave.llm import decontaminate, minhash, mixing, tokens, toxicity
from basketweave.llm.common import table, workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER, END_ID = "word_bpe_49k.json", 1
REPEATS = 2.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels, does not reject."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(table(spark, sf_dir, "documents"), labels, workspace(spark))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return minhash.deduplicate(docs, workspace(spark))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to REPEATS times."""
    mixed = mixing.mix(docs, workspace(spark), max_repeats=REPEATS, budget="keep")
    return mixed.select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, read back as one row per document."""
    files = tokens.write_token_files(
        docs, workspace(spark), public_tokenizers.path(TOKENIZER), END_ID, words=True
    )
    return tokens.read_token_files(files)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

# No SQL: the toxicity model and the tokenizer are not SQL. tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    ws = workspace(spark)
    for name, stage in STAGES:
        docs = ws.write(name, stage(spark, docs, sf_dir)).df
    return docs
