"""N-gram Jaccard self-join by prefix trees.

A document's set are its distinct word shingles (64-bit hashes); with fewer words than a shingle has, the whole sequence is one.
Documents with equal sets form a class, told by a digest of the set; classes are joined, copies never expanded.

All sets are ordered by one global order: the shingles of a hash-chosen part of the universe first, rarest (fewest classes) first,
then the others by hash. For a threshold t, classes that link share one of the first n - ceil(t n) + 1 shingles of each (n: set size).
Shingles that only one class has can't be shared, and rarest-first puts them first; so a class whose own shingles fill its prefix
has no partner and is done. What remains are classes with common rare shingles. Components of classes and shared prefix shingles
split them into clusters that no link leaves; each class goes to one cluster, so its set is shipped once, and a cluster too large for
one task is cut into size bands and blocks whose pairs cover every possible link.

Within a task the sets, in global order, stand in a prefix tree. Each set is matched against the tree of those before it: overlap is
counted once for all sets that share a path, subtrees are left when the shingles missed so far exceed what the threshold allows or
when their lengths can't match, or when all their sets are linked with the one at hand already. So a task hands on a forest of
links and not all pairs. Components of the links are the result; no link between different sets is lost.

Null and empty texts have an empty set and are linked with nothing. Repeated rows are members of their class. Texts are taken whole.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_rows, bitmap_of, components, discard, frugal, hand_back, met, mix, shielded, shingles_of, slices, staged, words_of

#: Shingles in one block of a large cluster, about.
BLOCK_SHINGLES = 400_000
#: Shingles that are known as frequent at most; those that a task hands on, and from how many of its classes on.
FREQUENT, FREQUENT_TASK, FREQUENT_FROM = 50_000, 2_000, 16
#: Bands of large clusters up to which they are broadcast (some MB), and the salts by which rows meet them beyond it.
MOST_BANDS, SALTS = 50_000, 64
#: Bits of a set's size in a packed number.
PACK = 30
#: Bits of the filter that keeps the second reading of the texts to classes that matter; 2 MB at every size.
FILTER_BITS = 24
EMPTY = np.int64(0)


def sets_of(data: np.ndarray, offsets: np.ndarray, k: int):
    """Sorted distinct shingle hashes of each text of a slice."""
    h, _, _, at = words_of(data, offsets)
    s = shingles_of(h, k)
    for i in range(len(offsets) - 1):
        a, b = int(at[i]), int(at[i + 1])
        if b - a >= k:
            yield np.unique(s[a : b - k + 1])
        elif b > a:
            part = h[a:b] * np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, b - a + 1, dtype=np.uint64)
            yield mix(part.sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def class_of(values: np.ndarray) -> int:
    """A signed 64-bit digest of a set; 0 is the empty set's alone."""
    if not len(values):
        return int(EMPTY)
    return (xxhash.xxh3_64_intdigest(values.tobytes()) >> 1) - (1 << 62) or 1


def prefix_length(n, num: int, den: int):
    """Shingles of which a set of n shares one with each partner: n - ceil(n num / den) + 1."""
    return n - (n * num + den - 1) // den + 1


def _first_part(values: np.ndarray, one_in: int) -> np.ndarray:
    return mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(one_in) == 0


def _read(docs: DataFrame, k: int, num: int, den: int, key: str, text: str) -> DataFrame:
    """The first reading of the texts, staged. Rows with a class: (id, d, n, class) of each document, where d tells texts of one id apart.
    Rows without: shingles (d) that many of a task's classes (n) have.

    Each task counts its classes' shingles of the first part and hands on the most frequent.
    """
    batch_rows(docs.sparkSession)
    one_in = first_part_of(num, den)

    def run(batches):
        seen: set[int] = set()
        total_s, total_n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            sizes, classes, held = [], [], []
            for _, _, data, offsets in slices(b.column(1)):
                for v in sets_of(data, offsets, k):
                    c = class_of(v)
                    sizes.append(len(v))
                    classes.append(c)
                    if len(v) and c not in seen:
                        seen.add(c)
                        held.append(v[_first_part(v, one_in)])
            if held:
                s, n = np.unique(np.concatenate(held), return_counts=True)
                s, at = np.unique(np.concatenate([total_s, s[n > 1]]), return_inverse=True)
                total_n = np.bincount(at, weights=np.concatenate([total_n, n[n > 1]]), minlength=len(s)).astype(np.int64)
                total_s = s
                if len(s) > 20 * FREQUENT_TASK:
                    best = np.argpartition(-total_n, FREQUENT_TASK)[:FREQUENT_TASK]
                    best.sort()
                    total_s, total_n = total_s[best], total_n[best]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64())], names=["id", "d", "n", "class"])
        keep = np.flatnonzero(total_n >= FREQUENT_FROM)
        keep = keep[np.argsort(-total_n[keep], kind="stable")[:FREQUENT_TASK]]
        none = pa.nulls(len(keep), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array(total_s[keep].view(np.int64)), pa.array(total_n[keep]), none], names=["id", "d", "n", "class"])

    rows = docs.select(F.col(key).cast("long").alias("id"), text, _row_key(key, text).alias("d"))
    return staged(rows.mapInArrow(frugal(run), "id long, d long, n long, class long"), "members", members=F.count("class"))


def first_part_of(num: int, den: int) -> int:
    """One shingle in so many is of the first part, which is some more than the longest prefix."""
    return max(1, math.floor(den / (1.6 * (den - num)))) if num < den else 8


def _row_key(key: str, text: str):
    return F.xxhash64(F.col(key).cast("long"), F.col(text))


def _frequent(read: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingles in order, classes that have each, as counted): those that many classes have, at most FREQUENT of them. A count that misses
    some tasks is still the same number for everyone, which is all that an order needs."""
    counts = read.filter("class is null").groupBy(F.col("d").alias("s")).agg(F.sum("n").alias("n"))
    got = counts.orderBy(F.desc("n"), "s").limit(FREQUENT).toArrow()
    s, n = got.column("s").to_numpy(), got.column("n").to_numpy()
    order = np.argsort(s, kind="stable")
    return s[order], n[order]


def _candidates(docs: DataFrame, read: DataFrame, k: int, num: int, den: int, text: str) -> DataFrame:
    """(s, class, meta, df): each class's shingles of the first part, and as many of the others as its prefix needs.

    meta: the set's size, how many of it are of the first part (PACK bits each), and 1 for a shingle of the others; df: classes that
    have the shingle, for frequent ones, else null. A task hands on a class once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(read))  # at most FREQUENT pairs
    one_in = first_part_of(num, den)

    def run(batches):
        known, counts = shared.value
        seen: set[int] = set()
        for b in batches:
            for _, _, data, offsets in slices(b.column(0)):
                held: list = []
                for v in sets_of(data, offsets, k):
                    c = class_of(v)
                    if not len(v) or c in seen:
                        continue
                    seen.add(c)
                    need = prefix_length(len(v), num, den)
                    front = _first_part(v, one_in)
                    a = v[front]
                    rest = v[~front][: max(0, need - len(a))]
                    held.append((np.concatenate([a, rest]), len(a), c, len(v)))
                if not held:
                    continue
                sizes = np.array([len(x[0]) for x in held])
                values = np.concatenate([x[0] for x in held]).view(np.int64)
                firsts, classes, whole = (np.array([x[i] for x in held], np.int64) for i in (1, 2, 3))
                within = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                firsts_ = np.repeat(firsts, sizes)
                cols = [values, np.repeat(classes, sizes), (np.repeat(whole, sizes) << (PACK + 1)) | (firsts_ << 1) | (within >= firsts_)]
                if len(known):
                    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                    df = pa.array(counts[at], mask=known[at] != values)
                else:
                    df = pa.nulls(len(values), pa.int64())
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), df], names=["s", "class", "meta", "df"])

    return docs.select(text).mapInArrow(frugal(run), "s long, class long, meta long, df long")


def _shared(rows: DataFrame) -> DataFrame:
    """rows whose shingle at least two classes have, with df: how many do. One shuffle: rows of a frequent shingle, whose df is known,
    are dealt by class instead of by shingle, so no shingle is hot."""
    columns = ["deal", "s", "class", "meta", "df"]
    dealt = rows.withColumn("deal", F.when(F.col("df").isNull(), F.col("s")).otherwise(F.xxhash64("class"))).repartition("deal")
    one = dealt.groupBy(*columns).agg(F.count("*").alias("copies"))  # several tasks may have handed on a class
    counted = one.withColumn("found", F.count("*").over(Window.partitionBy("deal", "s")))
    df = F.coalesce(F.col("df"), F.col("found"))
    return counted.withColumn("df", df).filter("df > 1").select("s", "class", "meta", "df")


def linked(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_shingles, component_id (the smallest key that links reach), links threshold num / den."""
    read = _read(docs, k, num, den, key, text)
    members = read.filter("class is not null")
    groups = components(class_links(docs, read, k, num, den, text)).select(F.col("node").alias("g"), "root")
    classes = members.groupBy("class").agg(F.min("id").alias("least"), F.count("*").alias("rows")).join(groups, F.col("class") == F.col("g"), "left")
    classes = staged(classes.select("class", "least", "rows", "root"), "classes", linked=F.count("root"))
    some = classes.filter("root is not null")
    least = some.groupBy(F.col("root").alias("g")).agg(F.min("least").alias("component"), F.count("*").alias("classes"))
    found = met(some, "root", least, "g", "classes", classes.observed["linked"]).select(F.col("class").alias("c"), "component", "rows")
    found = found.unionByName(classes.filter("root is null").select(F.col("class").alias("c"), F.col("least").alias("component"), "rows"))
    got = met(members, "class", found, "c", "rows", read.observed["members"])
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component"))
    return got.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))


@shielded()
def deduplicated(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one document of each group that links connect: the one of the smallest key. Rows that repeat count as one document;
    documents without words are in no group and stay."""
    read = _read(docs, k, num, den, key, text)
    members = read.filter("class is not null")
    found = components(class_links(docs, read, k, num, den, text))
    first = lambda: F.min(F.struct(F.col("id").isNull().alias("none"), "id", "d"))
    least = members.filter("n > 0").groupBy("class").agg(first().alias("x"))
    least = least.join(found, F.col("class") == F.col("node"), "left").groupBy(F.coalesce("root", "class").alias("g")).agg(F.min("x").alias("x"))
    kept = least.select(F.col("x.d").alias("_d")).unionByName(members.filter("n = 0").select(F.col("d").alias("_d")).distinct())
    copies = members.groupBy(F.col("d").alias("_e")).agg(F.count("*").alias("c")).filter("c > 1")
    kept = staged(kept.join(copies, F.col("_d") == F.col("_e"), "left").select("_d", F.coalesce("c", F.lit(1)).alias("_c")), "kept", most=F.max("_c"))
    rows = docs.withColumn("_k", _row_key(key, text)).join(kept, F.col("_k") == F.col("_d"))
    if (kept.observed["most"] or 0) > 1:
        # the rows that repeat, of which one is taken, are few beside the others, or the table is mostly copies
        once = rows.filter("_c > 1").dropDuplicates(["_k"])
        rows = rows.filter("_c = 1").unionByName(once)
    return rows.select(*docs.columns)


def class_links(docs: DataFrame, read: DataFrame, k: int, num: int, den: int, text: str = "text") -> DataFrame:
    """(a, b): links between classes, staged, enough of them to connect all that link."""
    edges = _prefixes(docs, read, k, num, den, text)
    found = components(_hung(edges, num, den))
    sizes = edges.select(F.col("class").alias("c"), "n").distinct()
    clusters = found.join(sizes, F.col("node") == F.col("c")).select(F.col("c").alias("class"), "n", F.col("root").alias("cluster"))
    clusters = staged(clusters, "clusters")
    discard(edges)
    links = staged(_matched(_sets_in(docs, clusters, k, text), _meetings(clusters, num, den), num, den), "links")
    discard(clusters)
    return links


def _band(num: int, den: int):
    """A size's band: sizes that can link are in one band or in neighbouring ones. A little wider than the greatest ratio, so that
    rounding never makes a link skip a band."""
    wide = math.log(den / num) * 1.001 if num < den else 1e-9
    return F.floor(F.log(F.col("n").cast("double")) / wide).cast("long")


def _prefixes(docs: DataFrame, read: DataFrame, k: int, num: int, den: int, text: str) -> DataFrame:
    """(class, n, s): the shingles of each class's prefix that another class has too, for classes that may have a partner."""
    df = _shared(_candidates(docs, read, k, num, den, text))
    part, n, first = F.col("meta") % 2, F.shiftright("meta", PACK + 1), F.shiftright("meta", 1) % (1 << PACK)
    shared = F.array_sort(F.collect_list(F.struct(part.alias("part"), "df", "s")))
    per_class = df.groupBy("class").agg(F.first(n).alias("n"), F.first(first).alias("first"), shared.alias("x"))
    need = F.expr(f"n - (n * {num} + {den - 1}) div {den} + 1")
    # shingles of the first part that nobody shares come first of all
    n_front = F.size(F.filter("x", lambda e: e["part"] == 0))
    alone = F.greatest(F.col("first") - n_front, F.lit(0))
    wanted = F.greatest(need - alone, F.lit(0)).cast("int")
    prefix = per_class.withColumn("wanted", wanted).filter("wanted > 0").select("class", "n", F.explode(F.slice("x", F.lit(1), F.col("wanted"))).alias("e"))
    return staged(prefix.select("class", "n", F.col("e.s").alias("s")), "prefixes")


def _hung(edges: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): classes that have a prefix shingle in common and sizes that may link, each hung on the least of its kind. Tasks hang
    their own rows first and send on one for each shingle and band, so a common one is not hot."""
    band = _band(num, den)
    keyed = edges.select("class", F.explode(F.array(band, band + 1)).alias("band"), "s").select("class", F.xxhash64("s", "band").alias("key"))

    def run(batches):
        held, rows = [], 0
        for b in batches:
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
            rows += b.num_rows
            if rows >= 2_000_000:
                yield hang(held)
                held, rows = [], 0
        if rows:
            yield hang(held)

    def hang(held):
        c, key = (np.concatenate([x[i] for x in held]) for i in (0, 1))
        order = np.lexsort((c, key))
        c, key = c[order], key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        least = np.repeat(c[starts], np.diff(np.append(starts, len(c))))
        first = np.zeros(len(c), bool)
        first[starts] = True
        settled = ~first & (c != least)
        keep = first | settled
        deal = np.where(first, key, mix(c.view(np.uint64)).view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(deal[keep]), pa.array(c[keep]), pa.array(least[keep], mask=first[keep])], names=["deal", "a", "b"])

    rows = keyed.mapInArrow(frugal(run), "deal long, a long, b long").repartition("deal")
    rows = rows.withColumn("b", F.coalesce("b", F.min(F.when(F.col("b").isNull(), F.col("a"))).over(Window.partitionBy("deal"))))
    return rows.filter("a <> b").select("a", "b").distinct()


def _sets_in(docs: DataFrame, cluster: DataFrame, k: int, text: str) -> DataFrame:
    """(class, v): sets of the classes in clusters, and of a few others that their filter lets through; of each task once."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap_of(cluster, "class", FILTER_BITS))

    def run(batches):
        bitmap = shared.value.view(np.uint64)
        seen: set[int] = set()
        for b in batches:
            c, v = [], []
            for _, _, data, offsets in slices(b.column(0)):
                for x in sets_of(data, offsets, k):
                    y = class_of(x)
                    at = y % (1 << FILTER_BITS)
                    if len(x) and int(bitmap[at >> 6]) >> (at & 63) & 1 and y not in seen:
                        seen.add(y)
                        c.append(y)
                        v.append(x.view(np.int64))
            if c:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(v, pa.list_(pa.int64()))], names=["class", "v"])

    return docs.select(text).mapInArrow(frugal(run), "class long, v array<long>")


def _meetings(clusters: DataFrame, num: int, den: int) -> DataFrame:
    """(class, m): the tasks that see a class. Small clusters go to tasks several at a time; large ones are cut into bands of sizes and
    blocks, and a task sees two blocks that can link."""
    spark = clusters.sparkSession
    rows = clusters.withColumn("band", _band(num, den))
    w = Window.partitionBy("cluster")  # a cluster has some hundred bands at most
    bands = rows.groupBy("cluster", "band").agg(F.sum("n").alias("mass")).withColumn("all", F.sum("mass").over(w))
    parts = F.ceil(F.col("mass") / BLOCK_SHINGLES).cast("long")
    near = lambda step: F.when(F.lag("band", step).over(w.orderBy("band")) == F.col("band") - step, F.lag(parts, step).over(w.orderBy("band")))
    bands = bands.select(F.col("cluster").alias("c3"), F.col("band").alias("b3"), "mass", "all", parts.alias("parts"), near(-1).alias("above"), near(1).alias("below"))
    is_big = F.col("all") > BLOCK_SHINGLES
    bands = staged(bands, "bands", big=F.count_if(is_big), small=F.sum(F.when(~is_big, F.col("mass"))))
    groups = max((bands.observed["small"] or 0) // BLOCK_SHINGLES + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    big = bands.filter(is_big).drop("mass", "all")
    on = (F.col("cluster") == F.col("c3")) & (F.col("band") == F.col("b3"))
    if bands.observed["big"] <= MOST_BANDS:
        rows = rows.join(F.broadcast(big), on, "left")
    else:  # a large cluster's rows are dealt by salt
        big = big.withColumn("salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("class", F.lit(7)), F.lit(SALTS)).cast("int")).join(big, on & (F.col("salt") == F.col("salt2")), "left")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")))

    def meeting(lo, i, hi, j):
        return F.struct(F.col("cluster").alias("c"), lo.cast("long").alias("lo"), i.cast("long").alias("i"), hi.cast("long").alias("hi"), j.cast("long").alias("j"))

    def others(n: str, of):
        return F.when(F.col(n).isNotNull(), F.transform(F.sequence(F.lit(0).cast("long"), F.col(n) - 1), of))

    band, part, zero = F.col("band"), F.col("part"), F.lit(0)
    none = F.filter(F.array(meeting(zero, zero, zero, zero)), lambda m: F.lit(False))
    # a block meets itself, the other blocks of its band, and those of the bands beside it
    own = others("parts", lambda j: meeting(band, F.least(part, j), band, F.greatest(part, j)))
    up = others("above", lambda j: meeting(band, part, band + 1, j))
    down = others("below", lambda j: meeting(band - 1, j, band, part))
    together = F.array(F.struct(F.pmod(F.xxhash64("cluster"), F.lit(groups)).alias("c"), *[F.lit(-1).cast("long").alias(x) for x in ("lo", "i", "hi", "j")]))
    meetings = F.when(F.col("parts").isNull(), together).otherwise(F.concat(own, F.coalesce(up, none), F.coalesce(down, none)))
    return rows.select("class", meetings.alias("m"))


def _matched(sets: DataFrame, meetings: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): links among sets (class, v), found by the tasks that see them."""
    one = sets.groupBy("class").agg(F.first("v").alias("v"))  # several tasks may have handed on a class
    dealt = one.join(meetings, "class").select("class", "v", F.explode("m").alias("m")).select("m.*", "class", "v")

    def match(t: pa.Table) -> pa.Table:
        try:
            return matched(t)
        finally:
            hand_back()

    def matched(t: pa.Table) -> pa.Table:
        c = t.column("class").to_numpy()
        first = np.argsort(c)
        v = t.column("v").combine_chunks()
        if isinstance(v, pa.ChunkedArray):
            v = v.chunk(0)
        offsets, values = v.offsets.to_numpy(), v.values.to_numpy()
        pairs = match_sets([values[offsets[i] : offsets[i + 1]] for i in first], num, den)
        return pa.table({"a": pa.array(c[first[pairs[:, 0]]], pa.int64()), "b": pa.array(c[first[pairs[:, 1]]], pa.int64())})

    return dealt.groupBy("c", "lo", "i", "hi", "j").applyInArrow(match, "a long, b long")


# -- the tree ----------------------------------------------------------------------------------------------------------


class _Node:
    """A run of shingles, what follows it, the sets that end there, and of all sets below: least and largest size, one of them, and
    one that isn't linked with that one (None: all are linked)."""

    __slots__ = ("run", "children", "sets", "least", "most", "one", "other")

    def __init__(self, run, least=sys.maxsize, most=0, one=None, other=None):
        self.run, self.children, self.sets = run, {}, []
        self.least, self.most, self.one, self.other = least, most, one, other


def match_sets(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Index pairs of distinct sets with intersection / union >= num / den, enough to connect all that link.

    Sets are put in rarest-first order of the shingles among them and added to a tree in the order of their sizes; each is matched
    against the tree first.
    """
    if len(sets) < 2:
        return np.zeros((0, 2), np.int64)
    values = np.concatenate(sets)
    sizes = np.array([len(x) for x in sets])
    _, code, count = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    ranks, counts = rank[code], count[code]
    ends = np.cumsum(sizes)
    ordered, own = [], []
    for e, n in zip(ends, sizes, strict=True):
        r = ranks[e - n : e]
        ordered.append(np.sort(r[counts[e - n : e] > 1]).tolist())  # shingles that no other set here has are only counted
        own.append(int(n) - len(ordered[-1]))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    pairs: list[tuple[int, int]] = []
    root = _Node([])
    for x in sorted(range(len(sets)), key=lambda i: (sizes[i], i)):
        r, n = ordered[x], int(sizes[x])
        if own[x] < prefix_length(n, num, den):
            _probe(root, r, n, own[x], x, sizes, num, den, find, parent, pairs)
            _insert(root, r, n, x, find)
    return np.array(pairs, np.int64).reshape(-1, 2)


def _insert(root: _Node, r: list[int], n: int, x: int, find) -> None:
    node, at = root, 0
    while True:
        node.least, node.most = min(node.least, n), max(node.most, n)
        if node.one is None:
            node.one = x
        elif node.other is None and find(node.one) != find(x):
            node.other = x
        if at == len(r):
            node.sets.append(x)
            return
        child = node.children.get(r[at])
        if child is None:
            child = node.children[r[at]] = _Node(r[at:], n, n, x)
            child.sets.append(x)
            return
        run = child.run
        same, most = 0, min(len(run), len(r) - at)
        if run[:most] == r[at : at + most]:
            same = most
        else:
            while run[same] == r[at + same]:
                same += 1
        if same < len(run):  # the path forks inside the run
            upper = _Node(run[:same], child.least, child.most, child.one, child.other)
            child.run = run[same:]
            upper.children[child.run[0]] = child
            node.children[r[at]] = upper
            child = upper
        at += same
        node = child


def _linked_whole(node: _Node, mine: int, find) -> bool:
    """Whether all sets below are in one component, that of `mine`. Links only ever join components, so what is one stays one."""
    one = find(node.one)
    if node.other is not None:
        if find(node.other) != one:
            return False
        node.other = next((s for s in node.sets if find(s) != one), None)
        if node.other is None:
            node.other = next((c.one if find(c.one) != one else c.other for c in node.children.values() if not _linked_whole(c, one, find)), None)
        if node.other is not None:
            return False
    return one == mine


def _probe(root, r, n, own, x, sizes, num, den, find, parent, pairs) -> None:
    """Links x with the sets of the tree that match it. State of a walk: shingles of r passed, overlap, shingles missed on the tree's side."""
    small = -(-n * num // den)  # a partner's least size; none in the tree is larger than n
    stack = [(root, 0, 0, 0)]
    total = len(r)
    while stack:
        node, at, overlap, missed = stack.pop()
        if node.most < small:
            continue
        # r[at:] is the part above node's path; walk the run
        run = node.run
        if run:
            if run == r[at : at + len(run)]:
                at += len(run)
                overlap += len(run)
            else:
                # with m the larger of the sizes (n) and y the smaller, overlap must reach (num (n + y)) / (num + den); on x's side
                # at most n - that may be missed, which is most for the least y
                allowed = n - -(-num * (n + max(small, node.least)) // (num + den))
                gone = own + at - overlap
                dead = False
                for t in run:
                    while at < total and r[at] < t:
                        at += 1
                        gone += 1
                    if gone > allowed:
                        dead = True
                        break
                    if at < total and r[at] == t:
                        at += 1
                        overlap += 1
                    else:
                        missed += 1
                        if missed > node.most - -(-num * (n + node.most) // (num + den)):
                            dead = True
                            break
                if dead:
                    continue
        if node.sets:
            mine = find(x)
            for y in node.sets:
                m = int(sizes[y])
                if den * overlap >= num * (n + m - overlap):
                    other = find(y)
                    if other != mine:
                        parent[max(other, mine)] = min(other, mine)
                        pairs.append((y, x))
                        mine = find(x)
        if node.children:
            mine = find(x)
            for child in node.children.values():
                if child.most >= small and not _linked_whole(child, mine, find):
                    stack.append((child, at, overlap, missed))
