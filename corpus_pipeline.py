"""A training corpus from ``documents``: five stages, each one operator of ``turnstile.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs.  All but the last return the columns of documents, in order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm import decontaminate, packing, quality, secrets, simhash
from turnstile.llm.queries import read, tokenizer_file
from turnstile.session import scratch_path


def _apart(docs: DataFrame) -> tuple[DataFrame, list[str], str, str]:
    """The columns under names no operator uses; those names, and which have the id and the text."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names, names[docs.columns.index("doc_id")], names[docs.columns.index("text")]


def _back(rows: DataFrame, names: list[str], docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(a).alias(b) for a, b in zip(names, docs.columns, strict=True)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    rows, names, doc_id, text = _apart(docs)
    labels = read(spark, sf_dir, "labels").withColumnRenamed("doc_id", doc_id)
    return _back(quality.judge(rows, labels, text_col=text, id_col=doc_id).where("kept"), names, docs)


def simhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    rows, names, _, text = _apart(docs)
    found = decontaminate.find_items(rows, read(spark, sf_dir, "benchmark"), text_col=text)
    return _back(found.where(~decontaminate.contaminated()), names, docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; a text that had one gets a new n_chars. Other documents stay as they are."""
    rows, names, _, text = _apart(docs)
    made = secrets.mask_secrets(rows, text_col=text)
    found = F.col("masked").isNotNull()
    new = {text: F.coalesce("masked", text)}
    if "n_chars" in docs.columns:
        size = names[docs.columns.index("n_chars")]
        new[size] = F.when(found, F.length("masked").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(size))
    return _back(made.withColumns(new), names, docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_neardup", simhash_neardup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Learned rules, fingerprints' components and the tokenizer are beyond SQL; tests hold a brute-force version against run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    base = scratch_path(spark, f"corpus/{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
