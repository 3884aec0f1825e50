"""Parts that several operators share: staged tables, word hashing, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import sys
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space and 0x09 to 0x0D.
SPACES = bytes([9, 10, 11, 12, 13, 32])
#: Bytes of text that the vectorised functions hold at once; a longer text is held alone.
SLICE_BYTES = 1 << 20
#: Edges that one task takes at the end of components: some 100 MB there.
FINISH = 1_000_000
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. Where it names none, a temporary folder serves local
    sessions, as in tests; on a cluster that is an error, as executors couldn't see it."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get().rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = "file://" + tempfile.mkdtemp(prefix="meterloom-")
    sc.setCheckpointDir(path)
    return path


#: Whether Spark deletes a query's shuffle files when it ends, instead of when the driver next collects garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str, **observed) -> DataFrame:
    """df written once as a table in the shared folder and read again: lineage ends there, and a lost executor costs nothing. Its shuffle
    files are deleted once it stands. observed: aggregates, whose values the table has as `observed`; they cost no job of their own."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    seen = Observation() if observed else None
    if seen:
        df = df.observe(seen, *[x.alias(k) for k, x in observed.items()])
    was = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if was is None else spark.conf.set(_CLEAN_UP, was)
    out = spark.read.schema(schema).parquet(path)
    out._staged_at = path
    out.observed = seen.get if seen else {}
    _staged.add(path)
    return out


#: Staged tables of this process that are still there.
_staged: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _staged.discard(path)


def discard(df: DataFrame) -> None:
    """Deletes a staged table that nothing reads any more."""
    _delete(df.sparkSession, df._staged_at)


def mark() -> frozenset[str]:
    """For discard_since: the tables that there are."""
    return frozenset(_staged)


def discard_since(before: frozenset[str], but: DataFrame) -> None:
    """Deletes the tables staged since mark(), apart from one, once nothing reads them."""
    for path in _staged - before - {but._staged_at}:
        _delete(but.sparkSession, path)


def sweep(spark: SparkSession) -> None:
    """Deletes all staged tables that are left, once the results that read them have been written."""
    for path in list(_staged):
        _delete(spark, path)


def in_pieces(batch: pa.RecordBatch, rows: int = 100_000):
    """A batch in slices, so that neither side holds all of it again on its way to Spark."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def arrays_of(column) -> list[np.ndarray]:
    """A list column of an Arrow table as one array for each row."""
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        values, at = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        out += [values[a:z] for a, z in zip(at[:-1], at[1:], strict=True)]
    return out


def batch_rows(spark: SparkSession) -> None:
    """Spark hands 1000 rows to Python at a time. Texts may be long, and both sides hold a whole batch. All operators here that use
    Python set the same number, so it doesn't matter which of them is built first."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def bitmap_of(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A set of hashes as a bitmap of 2 ** bits bits, which is of one size whatever the input; 64 bits come to the driver in a row."""
    at = F.pmod(column, F.lit(1 << bits))
    cells = keys.select((at / 64).cast("int").alias("i"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("b"))
    got = cells.groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[got.column("i").to_numpy()] = got.column("b").to_numpy()
    return table


def gathered(batches, rows: int = 4000, most: int = 1 << 24):
    """Batches put together to so many rows or bytes, for work that pays on larger ones."""
    held, n, size = [], 0, 0
    for b in batches:
        held.append(b)
        n, size = n + b.num_rows, size + b.nbytes
        if n >= rows or size >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n, size = [], 0, 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def hand_back() -> None:
    """Gives the system what this process's allocators hold free. They keep most of what a task freed, and workers stay for later tasks, so
    over the stages of a pipeline every worker would hold the largest of its tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def frugal(run):
    """A function for mapInArrow that hands its memory back when its task ends."""

    def g(batches):
        try:
            yield from run(batches)
        finally:
            hand_back()

    return g


def kept(key, make, most: int = 8):
    """make()'s value, made once in a process, where the last few stay. Functions travel by value, so their own globals don't outlive a
    task."""
    cache = sys.__dict__.setdefault("_meterloom_kept", {})
    if key not in cache:
        while len(cache) >= most:
            del cache[next(iter(cache))]
        cache[key] = make()
    return cache[key]


def shielded(needed: tuple[str, ...] = ("doc_id", "text")):
    """For operators from a table to a table: columns that they don't need are out of their sight under other names, so no name of
    theirs can clash; a column that the operator adds replaces one of that name. `key` and `text` arguments are needed too."""

    def wrap(f):
        @functools.wraps(f)
        def g(docs: DataFrame, *args, **named) -> DataFrame:
            own = {*needed, *(v for k, v in named.items() if k in ("key", "text", "url"))}
            mark = uuid.uuid4().hex[:12]
            hidden = {c: f"_{mark}_{i}" for i, c in enumerate(docs.columns) if c not in own}
            out = f(docs.withColumnsRenamed(hidden), *args, **named)
            seen = set(out.columns)
            out = out.drop(*[h for c, h in hidden.items() if c in seen])
            return out.withColumnsRenamed({h: c for c, h in hidden.items() if h in seen and c not in seen})

        return g

    return wrap


# -- hashing -----------------------------------------------------------------------------------------------------------


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift-multiply rounds)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _power_table(base: int, n: int) -> np.ndarray:
    usual = SLICE_BYTES + 1

    def make(size):
        out = np.ones(size, np.uint64)
        done = 1
        while done < size:  # doubling: out[done:2*done] = out[:done] * base**done
            step = min(done, size - done)
            out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        return out

    return kept(("powers", base), lambda: make(usual)) if n <= usual else make(n)


def byte_tables() -> tuple[np.ndarray, dict[str, np.ndarray]]:
    def make():
        lower = np.arange(256, dtype=np.uint64)
        lower[65:91] += np.uint64(32)  # A-Z only
        between = {k: np.zeros(256, bool) for k in ("words", "letters", "lines")}
        between["words"][list(SPACES)] = True
        between["letters"][:128] = True  # runs of letters; what isn't ASCII counts as letters
        between["letters"][65:91] = between["letters"][97:123] = False
        between["lines"][10] = True
        return mix(lower + np.uint64(0x1234567)), between

    return kept("bytes", make)


def slices(texts: pa.Array, most: int = SLICE_BYTES):
    """(first row, rows, bytes as uint8, offsets of the rows in them): runs of rows of about so many bytes. Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    bufs = texts.buffers()
    offsets = np.frombuffer(bufs[1], np.int64, n + 1 + texts.offset)[texts.offset :]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        end = min(end, n)
        yield at, end - at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words_of(data: np.ndarray, offsets: np.ndarray, kind: str = "words") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice: a 64-bit hash of each word with A-Z lower-cased, its first byte, the byte after it, and per row the index of its first word (one more at the end). kind: what counts as a word (words, letters, lines)."""
    value, between = byte_tables()
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64)
    inside = ~between[kind][data]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = ~inside[:-1]
    cut = offsets[1:-1]
    first[cut[cut < n]] = True  # a row's first byte begins a word whatever stands before
    first &= inside
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = ~inside[1:]
    cut = offsets[1:-1] - 1
    last[cut[cut >= 0]] = True
    last &= inside
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _power_table(_BASE, n + 1), _power_table(pow(_BASE, -1, 1 << 64), n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value[data] * power[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    h = mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h, starts, ends, np.searchsorted(starts, offsets)


def shingles_of(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows; the caller drops those that cross rows."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(k):
        out += h[j : j + m] * np.uint64((0x9E3779B97F4A7C15 * (2 * j + 3)) & _MASK | 1)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
    return mix(out)


def hash_words(words: list[str], kind: str = "words") -> np.ndarray:
    """The hashes that words_of gives these words."""
    data = np.frombuffer("\n".join(words).encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]), kind)[0]


def repeats(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether an equal value stands in the same row elsewhere, whether it does so before)."""
    order = np.lexsort((values, rows))  # stable: equal ones stay in order
    v, r = values[order], rows[order]
    same = np.zeros(len(v), bool)
    if len(v) > 1:
        same[1:] = (v[1:] == v[:-1]) & (r[1:] == r[:-1])
    again = np.zeros(len(v), bool)
    again[order] = same
    either = same.copy()
    either[:-1] |= same[1:]
    twice = np.zeros(len(v), bool)
    twice[order] = either
    return twice, again


# -- connected components ----------------------------------------------------------------------------------------------


def components(edges: DataFrame, most_rounds: int = 60, finish: int = FINISH) -> DataFrame:
    """(node, root): root is the smallest node that edges (a, b) reach. Nodes are longs; nodes without an edge don't appear.

    Every map task first contracts its own edges to stars, of which `finish` or fewer are contracted by one task at last. While there
    are more, two star operations alternate (each node hands its neighbours the smallest neighbour): grouped minima and joins, so no
    group is ever collected, and none is hot (see met). Each round is
    staged. It takes a logarithmic number of rounds; most_rounds is far above that, and to exceed it is an error.
    """
    sums = {"n": F.count(F.lit(1)), "x": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))}
    edges = staged(_contracted(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")), "cc", **sums)
    before = None
    for _ in range(most_rounds):
        now = edges.observed
        if now == before or not now["n"]:
            break
        last, before = edges, now
        if now["n"] <= finish:
            edges = staged(_contracted(edges.coalesce(1), finish), "cc")
            discard(last)
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"), F.count("*").alias("c")).withColumn("m", F.least("k", "m"))
        # large star: neighbours above a node point to its least one
        large = met(both.filter("b > a"), "a", least, "k", "c", 2 * now["n"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.distinct(), "cc")
        # small star: neighbours below a node, and itself, point to the least of them
        small = large.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"), F.count("*").alias("c"))
        stars = met(large, "a", small, "k", "c", 2 * now["n"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = stars.unionByName(small.select(F.col("k").alias("a"), F.col("m").alias("b")))
        edges = staged(stars.filter("a <> b").distinct(), "cc", **sums)
        discard(last)
        discard(large)
    else:
        raise RuntimeError("components: too many rounds")
    out = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return out.unionByName(out.select(F.col("root").alias("node"), "root").distinct())


def met(rows: DataFrame, on: str, table: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """rows with the columns of table (one row for each key) where rows[on] = table[key]; rows without one go. `weight` says how many of
    the `total` rows have a key: those of most rows (2 ** 15 at most) come by a broadcast, so none is hot in a shuffle."""
    heavy = max(1000, total >> 15)
    hot = table.filter(F.col(weight) > heavy).drop(weight)
    few = table.filter(F.col(weight) <= heavy).drop(weight)
    apart = rows.join(F.broadcast(hot.select(F.col(key).alias("_hot"))), F.col(on) == F.col("_hot"), "left_anti")
    return rows.join(F.broadcast(hot), F.col(on) == F.col(key)).unionByName(apart.join(few, F.col(on) == F.col(key)))


def _contracted(edges: DataFrame, most: int = 2_000_000) -> DataFrame:
    """Each task's edges as stars around the least node that they reach; blocks of edges bound the memory."""

    def run(batches):
        held, rows = [], 0
        for x in batches:
            a, b = x.column(0).to_numpy(zero_copy_only=False), x.column(1).to_numpy(zero_copy_only=False)
            held.append((a, b))
            rows += len(a)
            if rows >= max(most, 1) + 1:
                yield stars(held)
                held, rows = [], 0
        if rows:
            yield stars(held)

    def stars(held):
        nodes, at = np.unique(np.concatenate([x for pair in held for x in (pair[0], pair[1])]), return_inverse=True)
        a, b, at_ = [], [], 0
        for x, _ in held:
            n = len(x)
            a.append(at[at_ : at_ + n])
            b.append(at[at_ + n : at_ + 2 * n])
            at_ += 2 * n
        root = labels(len(nodes), np.concatenate(a), np.concatenate(b))
        keep = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(nodes[root[keep]])], names=["a", "b"])

    return edges.mapInArrow(frugal(run), "a long, b long")


def labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of n nodes reaches, by vectorised hooking and pointer jumping."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
        off = lo != hi
        if not off.any():
            return root
        np.minimum.at(root, hi[off], lo[off])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
