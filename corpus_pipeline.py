"""A corpus pipeline of five stages over documents (counted as part of the subpackage for training data).

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the columns of documents; the last returns the
pieces of the packed documents. n_chars follows the text where a stage changes it. A stage's result is written and read again
before the next one starts, so each works on all that its predecessor kept, and nothing is computed twice. Then the tables of the stage
before it are deleted, and those that it made on its way.

Odd rows, of every stage: null and empty texts have nothing to judge, link, repeat, replace or pack, and pass to the end, where they are
rows without a piece; only a text of which all words were cut as repeats goes. Rows that repeat are one document to the second stage,
which keeps one of them, and so does it of documents that link, the one of the smallest doc_id (a null one comes last). A score equal to
the classifier's threshold is accepted, a similarity equal to the join's is a link. Texts are taken whole, however long. Empty tables
give empty tables. Columns beside those of documents go along, whatever their names; a column `text` or `doc_id` is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import common, compact_windows, length_buckets, pii, prefix_tree_join, queries, weak_labels


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects, for their form or for abuse."""
    return weak_labels.accepted(docs, common.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a Jaccard similarity of 0.8 or more over 5-word shingles."""
    return prefix_tree_join.deduplicated(docs, k=5, num=80, den=100)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words and more that an earlier document has."""
    return _sized(compact_windows.without_repeats(docs))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms."""
    return _sized(pii.pseudonymised(docs, counts=False))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in batches of like length, counted in ids of the tokenizer, which each task lets go of when it ends."""
    return length_buckets.packed(docs, vocabulary=queries.vocabulary_path())


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("PII", private_data),
    ("packing", packing),
]

#: No stage but the fourth can be put in SQL over whole tables; tests hold the pipeline against a version by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    last = None
    for i, (name, stage) in enumerate(STAGES):
        before = common.mark()
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.staged(docs, name.replace(" ", "-"))
            common.discard_since(before, docs)
            if last is not None:
                common.discard(last)
            last = docs
    return docs
