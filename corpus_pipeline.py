"""The corpus pipeline: stages from raw documents to token ids.

Defined cases, in every stage: rows are judged one by one, by their own text, whatever others share their id or have
none; null and empty texts are clean for every stage but the first; ties and repeated rows have the same result at every
run; an empty table gives an empty table; columns that a stage does not name pass through it, whatever they are called.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tallgrass.llm import contamination, language, mixing, near_dups, tokens
from tallgrass.llm.queries import tokenizer_file
from tallgrass.plans.durable import passing, remove, scratch
from tallgrass.plans.workers import lean_batches
from tallgrass.sources.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; rows without text, without a letter or without a likely language go.

    Labels of any rows with an id are learned from; rows without a label are judged like the others.
    """
    return language.accepted(docs, language.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the least id, one without an id only if all are.

    Of rows that repeat id and text one stays; rows without a word are nobody's duplicates and all stay.
    """
    return near_dups.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; an item spread over several rows of one id is in none of them.

    Items without text or with fewer words than a shingle are in no document.
    """
    return contamination.without_items(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repetitions are rows of their own.

    A null source is one of its own, ranked last; rows without words count nothing and are taken like their neighbours.
    """
    return mixing.repeated(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what was kept, write the token files and return them as read back.

    Null and empty texts have the end id alone; null ids come first; rows with one id are ordered by text.
    """
    path = scratch(spark, "pipeline-tokens")
    tokens.write_tokens(docs, path, tokenizer_file())
    found = tokens.read_tokens(spark, path)
    found.token_paths = [path]
    return found


def _lean(stage):
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        lean_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language ID", _lean(language_id)),
    ("MinHash near-dedup", _lean(near_duplicates)),
    ("benchmark decontamination", _lean(decontamination)),
    ("mixing sources to target weights", _lean(source_mix)),
    ("token-ID / binary output", _lean(token_output)),
]
#: Language scores and near-duplicate signatures have no SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again, and deleted after the next."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage-{k}")
        with passing(spark) as keep:
            docs = stage(spark, docs, sf_dir)
            if k == len(STAGES) - 1:
                keep(*docs.token_paths)
            else:
                docs.write.parquet(path)
        if before:
            remove(spark, before)
        if k < len(STAGES) - 1:
            docs, before = spark.read.parquet(path), path
    return docs
