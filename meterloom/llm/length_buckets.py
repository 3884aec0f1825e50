"""Packing into optimal length buckets.

Texts are cut into pieces of at most MOST_TOKENS tokens: ids of the tokenizer file (counted by exact merging, see bpe) where a
vocabulary is given, else words. Over the histogram of all pieces' lengths (at most MOST_TOKENS entries) dynamic programming chooses the bucket lengths for which the padding is least. Inside each bucket, batches are formed of as many
pieces as the token budget takes: a piece's place is its number within (bucket, salt) plus the pieces of the salts before, so no
bucket, however large, is numbered in one task, and each bucket has one batch that isn't full at most.

Null and empty texts, and those without a token, have no pieces: they come back as one row with 0 tokens and null bucket. Rows
that repeat are packed each. Nothing is dropped: a text's pieces cover it whole, however long it is. Pieces of equal length
follow each other by key and number. An empty table gives an empty one, and columns beside key and text are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import token_counts
from .common import staged

MOST_TOKENS, BUCKETS, BATCH_TOKENS = 2048, 8, 1 << 14
#: Pieces that one task numbers, about.
EACH_SALT = 10_000


def optimal_lengths(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """At most so many bucket lengths, ascending, of least total padding; the last is the longest length there is."""
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    c, s = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * lengths)])
    m = len(lengths)
    # cost of one bucket over lengths[i:j], of length lengths[j - 1]
    best = lengths * c[1:] - s[1:]
    best = np.concatenate([[0], best])
    choices = []
    for _ in range(min(buckets, m) - 1):
        new, choice = np.empty_like(best), np.zeros(m + 1, np.int64)
        new[0] = 0
        for j in range(1, m + 1):
            total = best[:j] + lengths[j - 1] * (c[j] - c[:j]) - (s[j] - s[:j])
            choice[j] = i = int(total.argmin())
            new[j] = total[i]
        choices.append(choice)
        best = new
    out, j = [], m
    for choice in reversed(choices):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(choice[j])
    if j:
        out.append(int(lengths[j - 1]))
    return sorted(set(out))


def packed(docs: DataFrame, most: int = MOST_TOKENS, buckets: int = BUCKETS, budget: int = BATCH_TOKENS, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Per piece: key, piece, start (in tokens), n_tokens, bucket_len, batch_id, slot. vocabulary: path of a tokenizer file."""
    spark = docs.sparkSession
    n = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    counted = token_counts(docs, vocabulary, key, text) if vocabulary else docs.select(F.col(key), n.cast("long").alias("n"))
    lengths = staged(counted, "lengths")
    sizes = F.when(F.col("n") > 0, F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    pieces = lengths.select(key, "n", F.explode(sizes).alias("piece"))
    pieces = pieces.select(key, "piece", (F.col("piece") * most).alias("start"), F.least(F.col("n") - F.col("piece") * most, F.lit(most)).alias("n_tokens"))
    histogram = {r[0]: r[1] for r in pieces.filter("n_tokens > 0").groupBy("n_tokens").count().collect()}  # at most `most` rows
    chosen = optimal_lengths(histogram, buckets)
    bucket = F.lit(None).cast("int")
    for i in reversed(range(len(chosen))):
        bucket = F.when((F.col("n_tokens") > 0) & (F.col("n_tokens") <= chosen[i]), F.lit(i)).otherwise(bucket)
    salts = max(sum(histogram.values()) // EACH_SALT + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64(F.col(key).cast("string"), "piece"), F.lit(salts))
    rows = pieces.withColumns({"bucket": bucket, "salt": salt})
    counts = rows.filter("bucket is not null").groupBy(F.col("bucket").alias("_b"), F.col("salt").alias("_s")).agg(F.count("*").alias("c"))
    before = counts.select("_b", "_s", (F.sum("c").over(Window.partitionBy("_b").orderBy("_s")) - F.col("c")).alias("before"))
    numbered = rows.withColumn("own", F.row_number().over(Window.partitionBy("bucket", "salt").orderBy(F.desc("n_tokens"), key, "piece")))
    # pieces without a bucket are numbered per salt like the others, and find no offset
    place = numbered.join(before, (F.col("bucket") == F.col("_b")) & (F.col("salt") == F.col("_s")), "left").withColumn("place", F.col("own") - 1 + F.col("before"))
    length = F.lit(None).cast("int")
    for i in range(len(chosen)):
        length = F.when(F.col("bucket") == i, F.lit(chosen[i])).otherwise(length)
    each = F.greatest(F.floor(F.lit(budget) / F.col("bucket_len")), F.lit(1)).cast("long")
    out = place.withColumn("bucket_len", length).withColumn("each", each)
    batch = F.col("bucket").cast("long") * F.lit(1 << 40) + F.floor(F.col("place") / F.col("each")).cast("long")
    return out.select(key, "piece", "start", "n_tokens", "bucket_len", batch.alias("batch_id"), (F.col("place") % F.col("each")).cast("int").alias("slot"))
