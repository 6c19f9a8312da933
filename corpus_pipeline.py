"""The corpus pipeline: documents in, encoded documents out.

Quality rules reject documents; of near-duplicate groups (five words, a similarity of 0.8) one document stays; secrets are
replaced by a mark; the sources are mixed to target weights, so documents leave, stay or repeat (their order is lost
when the rows are written and reread; how often each comes is not); the last stage gives each document's token ids and the text that they decode to. run() chains the stages; a caller that wants
to restart in between writes each stage's result and hands it on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import backtrack_bpe, mixing, prefix_tree, quality, secrets
from marketlake.llm.common import written
from marketlake.llm.queries import tokenizer_file
from marketlake.shipping import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules keep. A null or short text goes; groups without fences go; see quality.report."""
    return quality.keep_good(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies. Rows without words or without an id link with nothing and stay."""
    ship(spark)
    return prefix_tree.keep_one(docs, size=5, threshold="4/5")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets in their texts replaced; null texts stay null."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; a null source is a source, a text without words is taken once if its source is taken at all."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, decoded of every row; a null text gives no ids and an empty string."""
    ship(spark)
    return backtrack_bpe.encode(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_join),
    ("secret scans", secret_scan),
    ("mixing sources", mix),
    ("BPE encoding", encode),
]
#: A random forest and an order by hashes have no counterpart in SQL; tests/llm/test_pipeline.py has a plain version of each stage's decisions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and reread as the next one's input. An empty table gives an empty result."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        df = stage(spark, df, sf_dir)
        if k < len(STAGES) - 1:
            df = written(df, name.replace(" ", "-"))
    return df
