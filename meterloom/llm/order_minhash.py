"""Order MinHash: signatures of texts that tell how alike they are in edit distance.

A text's k-mers of code points are numbered by occurrence, so that repeats differ. Each of SKETCHES hash functions takes the two
numbered k-mers of least hash, puts them back in text order, and hashes that ordered pair: moving passages about changes the
signature, which a set-based sketch wouldn't notice. Likeness is the share of equal entries.

A text shorter than K is one k-mer; a text with a single k-mer has pairs of it alone. Empty and null texts have a signature of
zeros, alike to each other (1.0) and to nothing else. Texts of any length are taken whole; memory is in proportion to one text. Of
equal hash values the first in the text counts. Rows that repeat have equal signatures; an empty table gives an empty one, and columns
beside id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, kept, mix

K, SKETCHES = 5, 24
#: Hash values held at once; longer texts go through them one hash function at a time.
MOST_VALUES = 1 << 21


def _multipliers(n: int) -> np.ndarray:
    return kept(("multipliers", n), lambda: mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))


def fingerprint(text: str, k: int = K, sketches: int = SKETCHES) -> np.ndarray:
    """The signature as int64 values."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(code):
        return np.zeros(sketches, np.int64)
    k = min(k, len(code))
    n = len(code) - k + 1
    h = np.full(n, np.uint64(k))
    for j in range(k):
        h *= np.uint64(0x100000001B3 + 2 * j)
        h += code[j : j + n]
    h = mix(h)
    # occurrence numbers: sorting (hash, position) brings equal k-mers together in text order; 40 bits of hash tell them apart
    if n < 1 << 24:  # both in one number
        both = np.sort((h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n, dtype=np.uint64))
        at, key = (both & np.uint64(0xFFFFFF)).astype(np.int64), both >> np.uint64(24)
    else:
        at = np.argsort(h >> np.uint64(24), kind="stable")
        key = h[at] >> np.uint64(24)
    number = np.arange(n)
    first = np.zeros(n, np.int64)
    new = np.flatnonzero(key[1:] != key[:-1]) + 1
    first[new] = new
    number = number - np.maximum.accumulate(first)
    occurrence = np.empty(n, np.uint64)
    occurrence[at] = number.astype(np.uint64)
    x = mix(h + occurrence * np.uint64(0xD1B54A32D192ED03))
    a = _multipliers(sketches)
    one, two = np.empty(sketches, np.int64), np.empty(sketches, np.int64)
    most = np.uint64((1 << 64) - 1)
    step = max(1, min(sketches, MOST_VALUES // n))
    for s in range(0, sketches, step):
        v = x[None, :] * a[s : s + step, None]
        rows = np.arange(len(v))
        one[s : s + step] = i = v.argmin(1)
        v[rows, i] = most
        two[s : s + step] = v.argmin(1)
    if n == 1:
        two[:] = 0
    lo, hi = np.minimum(one, two), np.maximum(one, two)
    out = mix(mix(h[lo] + a) * np.uint64(0x9FB21C651E98DF25) + h[hi]).view(np.int64)
    return np.where(out == 0, 1, out)


def shown(signature: np.ndarray) -> str:
    """A signature as hexadecimal digits, 16 for each entry."""
    return signature.astype(">i8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = K, sketches: int = SKETCHES) -> DataFrame:
    """id, fingerprint of each text."""

    def run(batches):
        for b in batches:
            got = [fingerprint(t or "", k, sketches) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int64()))], names=[id_column, "fingerprint"])

    return docs.select(id_column, text).mapInArrow(run, f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}, fingerprint array<long>")


def edited(text: str, after: str) -> str:
    """The last quarter (rounded down) of text replaced by as many of the first code points of `after`, or all of them."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n] if n else text


def in_order(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, is_next, part): docs dealt out over ranges of key and sorted by (key, text) within each; the first row of the range
    that follows (after the last: the first) stands at the end of each range, marked is_next. Texts are shuffled once.

    Null keys come first. Bounds are quantiles of the keys, so there are as many of them as partitions and no more.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    cuts = rows.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0] or []
    cuts = sorted({c for c in cuts if c is not None})
    wide = max(1, int(len(cuts) ** 0.5))
    coarse = F.array(*[F.lit(c).cast("long") for c in cuts[wide - 1 :: wide]]) if cuts else F.array().cast("array<long>")
    fine = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    upto = lambda x: F.size(F.filter(x, lambda c: c <= F.col("k")))
    rows = rows.withColumn("c", upto(coarse) * wide).withColumn("part", (F.col("c") + upto(F.slice(fine, F.col("c") + 1, F.lit(wide)))).cast("int")).drop("c")
    first = sorted((r[0], r[1]) for r in rows.groupBy("part").agg(F.min(F.struct(F.col("k").isNotNull().alias("v"), "k"))["k"].alias("k")).collect())
    if not first:
        return rows.select(F.col("k").alias(key), F.col("t").alias(text), F.lit(False).alias("is_next"), "part")
    before = [(first[i - 1][0], k) for i, (_, k) in enumerate(first)]  # the range before each first key; the last one's for the first
    heads = F.broadcast(spark.createDataFrame(before, "part int, k long"))  # a row for each partition
    peeks = rows.drop("part").join(heads.withColumnRenamed("k", "hk"), F.col("k").eqNullSafe(F.col("hk"))).select("part", "k", "t").groupBy("part").agg(F.min(F.struct("k", "t")).alias("x")).select(F.col("x.k").alias("k"), F.col("x.t").alias("t"), F.lit(True).alias("is_next"), "part")
    dealt = rows.select("k", "t", F.lit(False).alias("is_next"), "part").unionByName(peeks).repartitionById(len(cuts) + 1, F.col("part"))
    return dealt.sortWithinPartitions("part", "is_next", "k", "t").select(F.col("k").alias(key), F.col("t").alias(text), "is_next", "part")


def against_edits(docs: DataFrame, k: int = K, sketches: int = SKETCHES) -> DataFrame:
    """Per document its signature, that of its edited text (both as hexadecimal digits), and the likeness of its own to that and to the
    next document's.

    Ids that repeat follow each other in the order of their texts (null first).
    """

    batch_rows(docs.sparkSession)

    def run(batches):
        pending: list = []  # rows whose next isn't known yet: at most the last one of a block

        def block(rows, after):
            """rows: (id, text); after: the text that follows the last."""
            texts = [t for _, t in rows]
            nexts = [*texts[1:], after]
            own = [fingerprint(t, k, sketches) for t in [*texts, after]]
            out: dict = {x: [] for x in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
            for i, (d, t) in enumerate(rows):
                e = edited(t, nexts[i])
                f = own[i] if e == t else fingerprint(e, k, sketches)
                for name, x in zip(out, (d, len(t), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), shown(own[i]), shown(f), likeness(own[i], f), likeness(own[i], own[i + 1])), strict=True):
                    out[name].append(x)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(out.values(), kinds, strict=True)], names=list(out))

        part = None
        for b in batches:
            for d, t, is_next, p in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                t = t or ""
                if p != part or is_next:
                    # a range's rows end with the next range's first one
                    if p == part and pending:
                        yield block(pending, t)
                        pending = []
                    part = p
                    if is_next:
                        continue
                pending.append((d, t))
                if len(pending) > 256:
                    yield block(pending[:-1], t)
                    pending = pending[-1:]

    return in_order(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
