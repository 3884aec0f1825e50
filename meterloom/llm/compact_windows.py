"""Passages that repeat across documents, by compact windows.

A document is the sequence of its 5-word shingles (A-Z lower-cased). For each of HASHES hash functions a Cartesian tree stands over
the shingles' hash values: its node (l, c, r) stands for all subsequences within l..r that hold c, whose least value is that of c, and
c's shingle is their signature. However a passage of 46 shingles and more is edited, at a Jaccard similarity of 0.8 it keeps a run of
21 in a row (see run_of), so only nodes of at least that width are made, about 2 n / 21 of them for each function.

Signatures that several documents have are kept. A run that two documents share has the same least shingle in both, under any function,
so it lies in a node with a kept signature in every tree: an interval join of a text's kept nodes across the functions leaves the
places where ENOUGH of them agree, and loses no shared run even if that is all of them. Common phrases seldom pass it, as they would
have to hold the least value of every function. What is left, and what lies about it as far as a passage can reach that holds it (see
reached), are a text's candidate regions. There the passages are verified exactly: a shingle counts as repeated if an earlier document (by id) has it in a
region too, and a passage is a span of at least MIN_WORDS words of whose shingles so many are repeated that the Jaccard similarity
is 0.8 or more (edits leave gaps, of any length that the similarity allows). Its source is the earlier document that most of its shingles come from. The earliest copy itself
is no repeat. Exact repeats are all found, and edited ones wherever the edits are.

No pairs of documents are made at any point: a passage in a third of all documents costs one row per document and signature, and
tasks settle what they can among their own rows, so that a hot signature or shingle sends one row from each.

Null and empty texts, and those under MIN_WORDS words, have no passages. Rows with equal ids count as one document, whose texts are
kept apart; null ids count as one id, before all others. Texts are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_rows, bitmap_of, frugal, in_pieces, mix, shielded, shingles_of, slices, staged, words_of

K, MIN_WORDS = 5, 50
#: Hash functions, and how many must agree that a run of shingles is shared. One that is gives all of them a signature that two texts have.
HASHES, ENOUGH = 4, 4
#: Repeated shingles for each of the union that isn't: |A & B| / |A | B| >= 0.8.
EACH = 4
#: Shingles up to which a gap is an edit whatever stands in the source; across more, both sides must come from one document, in order.
GAP = 2 * K
_NEVER = 1 << 40
#: Size of the regions up to which they are broadcast.
BROADCAST_BYTES = 16 << 20
#: Keys that the passages of one source are dealt over.
SALTS = 16
#: Rows that a task settles among themselves.
BLOCK_ROWS = 2_000_000
#: Bits of the filter that keeps the second reading of the texts to documents that matter; 2 MB at every size.
FILTER_BITS = 24
_NULL_ID = -(1 << 63)


def run_of(width: int) -> int:
    """Shingles in a row that a passage of `width` and more shares with its source at a Jaccard similarity of 0.8, at least. An edit, be
    it a word or a part moved, takes K - 1 shingles or more from either side, so with e edits there are e + 1 runs of 32 e shingles or
    more (c / (c + 8 e) >= 0.8), and of width - 4 e or more; words that recur at an edit are not considered."""
    lost = K - 1
    return max(2, min(-(-max(8 * lost * e, width - lost * e) // (e + 1)) for e in range(width)))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row, by the rows of a sparse table: ranges of 2, 4, 8 ..., and two of them at last."""
    out, have = values, 1
    while 2 * have <= width:
        out, have = np.minimum(out[:-have], out[have:]), 2 * have
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def windows(values: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, least): compact windows of all texts of a slice, of which row tells the text of each value.

    A node of a text's Cartesian tree at c holds the subsequences whose least value is that of c. Those of `width` values in a row
    follow each other, as their starts do, from first to last: runs of equal minima. So the tree's nodes of at least that width come
    from the minima in linear time, whatever its depth; a node's reach is clipped to `width` around c. Equal values in reach of each
    other are one node, so a text of one word has one.
    """
    if len(values) < width:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    least = least_of(values, width)
    at = np.flatnonzero(row[: len(least)] == row[width - 1 :])
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    least = least[at]
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (row[at[1:]] != row[at[:-1]])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[last], least[first]


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, d, t): d tells texts of one id apart."""
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NULL_ID)).alias("id"), F.col(text).alias("t"))
    return rows.select("id", F.xxhash64("id", "t").alias("d"), "t")


def _shingles(column: pa.Array):
    """(row, shingles) of texts."""
    for first, n, data, offsets in slices(column):
        h, _, _, at = words_of(data, offsets)
        s = shingles_of(h, K)
        for i in range(n):
            a, b = int(at[i]), int(at[i + 1]) - K + 1
            if b > a:
                yield first + i, s[a:b]


def _signatures(rows: DataFrame, width: int, hashes: int) -> DataFrame:
    """(deal, sig, d, node): signatures of compact windows; node: first and last start, function and whether two texts of one task have
    the signature, packed. deal: the signature, but for rows whose signature is known to be shared: these are dealt by text, all but
    one that tells the other tasks."""
    a = mix(np.arange(1, hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def run(batches):
        held: list[tuple] = []
        size = 0
        for b in batches:
            ds = b.column(1).to_numpy()
            for at, n, data, offsets in slices(b.column(2)):
                h, _, _, begins = words_of(data, offsets)
                s = shingles_of(h, K)
                row = np.repeat(np.arange(n), np.diff(begins))
                inside = row[: len(s)] == row[K - 1 :] if len(s) else np.zeros(0, bool)
                s, row = s[inside], row[: len(inside)][inside]
                begin = np.searchsorted(row, np.arange(n))
                for f in range(hashes):
                    x = s * a[f]
                    x ^= x >> np.uint64(32)
                    first, last, least = windows(x, row, width)
                    own = row[first]
                    held.append((mix(least + a[f]), ds[at + own], (first - begin[own]) << 34 | (last - begin[own]) << 4 | f << 1))
                    size += len(first)
                if size >= BLOCK_ROWS:
                    yield from in_pieces(settled(held))
                    held, size = [], 0
        if size:
            yield from in_pieces(settled(held))

    def settled(held):
        sig = np.concatenate([x[0] for x in held]).view(np.int64)
        d, node = (np.concatenate([x[i] for x in held]) for i in (1, 2))
        order = np.lexsort((d, sig))
        sig, d, node = sig[order], d[order], node[order]
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        ends = np.append(starts[1:], len(sig)) - 1
        known = np.repeat(d[starts] != d[ends], ends - starts + 1)
        away = known.copy()
        away[starts] = False
        deal = np.where(away, mix(d.view(np.uint64) ^ mix(sig.view(np.uint64))).view(np.int64), sig)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (deal, sig, d, node | known)], names=["deal", "sig", "d", "node"])

    return rows.mapInArrow(frugal(run), "deal long, sig long, d long, node long")


def _regions(signatures: DataFrame, enough: int, margin: int, run_: int) -> DataFrame:
    """(d, regions): shingle ranges of each text that passages can lie in; the last may end beyond the text."""
    w = Window.partitionBy("deal", "sig")
    shared = signatures.repartition("deal").withColumns({"a": F.min("d").over(w), "z": F.max("d").over(w)}).filter("node % 2 = 1 or a <> z")
    nodes = shared.groupBy("d").agg(F.collect_set(F.shiftright("node", 1)).alias("x"))  # no more than a text has

    def run(batches):
        for b in batches:
            x = b.column(1)
            offsets, node = x.offsets.to_numpy(), x.values.to_numpy()
            found = covered(np.repeat(np.arange(b.num_rows), np.diff(offsets)), node >> 33, (node >> 3 & ((1 << 30) - 1)) + 1, enough)
            d, regions = [], []
            for i, ranges in found:
                d.append(i)
                regions.append(reached([y + (run_ - 1) * (j % 2) for j, y in enumerate(ranges)], margin))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(d, pa.int64())), pa.array(regions, pa.list_(pa.int32()))], names=["d", "regions"])

    return nodes.mapInArrow(frugal(run), "d long, regions array<int>")


def covered(text: np.ndarray, left: np.ndarray, right: np.ndarray, enough: int):
    """The interval join across functions, as (text, ends of ranges l, r, l, r, ...): where intervals l..r - 1 of `enough` functions meet.
    Intervals of one function and text don't overlap, so so many of any kind are of so many functions."""
    if not len(text):
        return
    points = np.concatenate([text << 32 | left, text << 32 | right])
    change = np.repeat(np.array([1, -1]), len(left))
    order = np.argsort(points, kind="stable")
    points, depth = points[order], np.cumsum(change[order])
    settled = np.append(points[1:] != points[:-1], True)  # the depth behind all changes at a place
    points, on = points[settled], depth[settled] >= enough
    before = np.concatenate([[False], on[:-1]])
    starts, ends = points[on & ~before], points[~on & before]
    owners, first = np.unique(starts >> 32, return_index=True)
    if not len(owners):
        return
    for i, a, z in zip(owners.tolist(), first.tolist(), np.append(first[1:], len(starts)).tolist(), strict=True):
        yield i, np.column_stack([starts[a:z], ends[a:z]]).ravel().__and__((1 << 32) - 1).tolist()


def reached(ranges: list[int], margin: int) -> list[int]:
    """Ranges as far as passages reach that hold some of them. Beside shared runs stand others too short to be known, each 20 shingles
    at most and an edit, together 28 or more of the union: with 20 / 28 of u shared the similarity is 0.8 for u up to 2.34 c. So what is
    known reaches 5 / 2 of its length and a margin to either side; ranges that meet reach as far as their sum says."""
    out: list[list[int]] = []  # first, last, known
    for l, r in zip(ranges[0::2], ranges[1::2], strict=True):  # noqa: E741
        one = [l, r, r - l]
        while out and out[-1][1] + out[-1][2] * 5 // 2 + margin >= one[0] - one[2] * 5 // 2 - margin:
            first, _, n = out.pop()
            one = [first, r, n + one[2]]
        out.append(one)
    return [x for l, r, n in out for x in (max(0, l - n * 5 // 2 - margin), min(r + n * 5 // 2 + margin, (1 << 31) - 1))]  # noqa: E741


def _in_regions(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """Of shingles in regions. (deal, id, d, p): place p of a text; deal: the shingle, for which other tasks must be asked. (deal, id, d,
    places, sources, lengths): places whose shingle an earlier document of the same task has, packed with where it has it, and that
    document; one entry for each run in which both places go up by one."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap_of(regions, "d", FILTER_BITS))

    def some(batches):
        bitmap = shared.value.view(np.uint64)
        for b in batches:
            at = b.column(1).to_numpy() % (1 << FILTER_BITS)
            yield b.filter(pa.array(bitmap[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1))

    # up to a checked size the regions go to the texts; beyond it, texts (smaller than their hashes) are shuffled to meet them
    size = 32 * regions.observed["texts"] + 4 * (regions.observed["ends"] or 0)
    near = F.broadcast(regions) if size <= BROADCAST_BYTES else regions
    wanted = rows.mapInArrow(frugal(some), "id long, d long, t string").join(near, "d").select("id", "d", "t", "regions")

    def spread(batches):
        held, size, seen = [], 0, set()
        for b in batches:
            g = b.column(3)
            ends, to = g.values.to_numpy(), g.offsets.to_numpy()
            ids, ds = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, v in _shingles(b.column(2)):
                if ds[i] in seen:  # rows that repeat needn't be asked for twice
                    continue
                seen.add(ds[i])
                own = ends[to[i] : to[i + 1]]
                p = np.concatenate([np.arange(a, min(z, len(v)), dtype=np.int32) for a, z in zip(own[0::2], own[1::2], strict=True)])
                held.append((v[p].view(np.int64), ids[i], ds[i], p))
                size += len(p)
                if size >= BLOCK_ROWS:
                    yield from settled(held)
                    held, size = [], 0
        if held:
            yield from settled(held)

    def settled(held):
        n = np.array([len(x[0]) for x in held])
        s, p = (np.concatenate([x[j] for x in held]) for j in (0, 3))
        ids, d = (np.repeat(np.array([x[j] for x in held], np.int64), n) for j in (1, 2))
        order = np.lexsort((p, ids, s))
        so, io = s[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], so[1:] != so[:-1]]))
        n = np.diff(np.append(starts, len(so)))
        least, place = np.empty(len(s), np.int64), np.empty(len(s), np.int64)
        least[order], place[order] = np.repeat(io[starts], n), np.repeat(p[order][starts], n)
        ask = np.flatnonzero(least >= ids)
        # what is settled goes on as one row for each text
        sizes = np.array([len(x[0]) for x in held])
        known = [np.flatnonzero(least[a:z] < ids[a:z]) + a for a, z in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes), strict=True)]
        own = [i for i, k in enumerate(known) if len(k)]
        runs = [known[i] for i in own]
        cuts = [np.flatnonzero(np.concatenate([[True], (np.diff(p[k]) != 1) | (np.diff(place[k]) != 1) | (np.diff(least[k]) != 0)])) for k in runs]
        heads = [k[c] for k, c in zip(runs, cuts, strict=True)]
        of = lambda j: np.array([held[i][j] for i in own], np.int64)
        lists = [
            (pa.int64(), [p[k].astype(np.int64) << 32 | place[k] for k in heads]),
            (pa.int64(), [least[k] for k in heads]),
            (pa.int32(), [np.diff(np.append(c, len(k))).astype(np.int32) for k, c in zip(runs, cuts, strict=True)]),
        ]
        d_own = of(2)
        names = ["deal", "id", "d", "p", "places", "sources", "lengths"]
        yield from in_pieces(pa.RecordBatch.from_arrays([pa.array(s[ask]), pa.array(ids[ask]), pa.array(d[ask]), pa.array(p[ask]), *(pa.nulls(len(ask), pa.list_(kind)) for kind, _ in lists)], names=names))
        yield pa.RecordBatch.from_arrays([pa.array(mix(d_own.view(np.uint64)).view(np.int64)), pa.array(of(1)), pa.array(d_own), pa.nulls(len(own), pa.int32()), *(pa.array(x, pa.list_(kind)) for kind, x in lists)], names=names)

    return wanted.mapInArrow(frugal(spread), "deal long, id long, d long, p int, places array<long>, sources array<long>, lengths array<int>")


def passages(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, hashes: int = HASHES, enough: int = ENOUGH) -> DataFrame:
    """(id, d, spans): of each text with passages that an earlier document has, array of (start, end, source, at, repeated, union): words
    start to end - 1, the earlier document that most of it comes from, how many of its shingles are repeated, and how many it and its
    source have together."""
    batch_rows(docs.sparkSession)
    rows = _keyed(docs, key, text)
    width = min_words - K + 1
    run_ = run_of(width)
    regions = _regions(_signatures(rows, run_, hashes), enough, width, run_)
    regions = staged(regions, "regions", texts=F.count("*"), ends=F.sum(F.size("regions")))
    # what a task couldn't settle is looked up among all; it asks once for each shingle, so none is hot
    dealt = _in_regions(rows, regions).repartition("deal")
    asks = F.col("p").isNotNull()
    first = F.min(F.when(asks, F.struct("id", "p"))).over(Window.partitionBy("deal"))
    known = dealt.withColumn("first", first).filter("p is null or first.id < id")
    packed = F.call_function("shiftleft", F.col("p").cast("long"), F.lit(32)) + F.col("first.p")
    together = lambda one, many: F.concat(F.collect_list(F.when(asks, one)), F.flatten(F.collect_list(many)))
    seen = known.groupBy("id", "d").agg(together(packed, "places").alias("x"), together(F.col("first.id"), "sources").alias("y"), F.flatten(F.collect_list("lengths")).alias("z"))

    def run(batches):
        for b in batches:
            x, z = b.column(2), b.column(4)
            at, to, lengths = x.offsets.to_numpy(), z.offsets.to_numpy(), z.values.to_numpy()
            places, sources = x.values.to_numpy(), b.column(3).values.to_numpy()
            out = []
            for i in range(b.num_rows):
                own = slice(at[i], at[i + 1])
                # single places stand before runs
                n = np.concatenate([np.ones(at[i + 1] - at[i] - (to[i + 1] - to[i]), np.int64), lengths[to[i] : to[i + 1]]])
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                out.append(spans(np.repeat(places[own] >> 32, n) + step, np.repeat(sources[own], n), np.repeat(places[own] & 0xFFFFFFFF, n) + step, width))
            keep = pa.array(np.flatnonzero([bool(y) for y in out]))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("source", pa.int64()), ("at", pa.int32()), ("repeated", pa.int32()), ("union", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(keep), b.column(1).take(keep), pa.array([y for y in out if y], kind)], names=["id", "d", "spans"])

    return seen.mapInArrow(frugal(run), "id long, d long, spans array<struct<start:int,end:int,source:long,at:int,repeated:int,union:int>>")


def _lines(source: np.ndarray, shift: np.ndarray) -> dict[int, tuple[int, int]]:
    """source -> (how many, shift) of the most frequent of its shifts, where a run's places in the source are less its own."""
    out: dict[int, tuple[int, int]] = {}
    order = np.lexsort((shift, source))
    source, shift = source[order], shift[order]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(source) != 0) | (np.diff(shift) != 0)]))
    for k, n in zip(starts.tolist(), np.diff(np.append(starts, len(source))).tolist(), strict=True):
        one = int(source[k])
        if n > out.get(one, (0, 0))[0]:
            out[one] = (n, int(shift[k]))
    return out


def _furthest(n: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """For each run the last one up to which the runs' shingles are EACH times those in the gaps between them, or more."""
    paid = EACH * np.concatenate([[0], np.cumsum(gaps)])
    ends = np.cumsum(n) - paid
    best = np.maximum.accumulate(ends[::-1])[::-1]
    return len(n) - 1 - np.searchsorted(best[::-1], ends - n)


def spans(p: np.ndarray, source: np.ndarray, place: np.ndarray, width: int) -> list[dict]:
    """All longest spans of the repeated positions p with a similarity of 0.8; they may overlap. source, place: where a position's
    shingle stands in an earlier document. In a gap of more than GAP the source's part has as many shingles as positions there say; in
    others as many as the span, or fewer where positions say so. at: where the middle one of those that come from the source does."""
    order = np.lexsort((place, source, p))
    order = order[np.concatenate([[True], np.diff(p[order]) != 0])] if len(order) else order
    p, source, place = p[order], source[order], place[order]
    heads = np.flatnonzero(np.concatenate([[True], np.diff(p) > 1])) if len(p) else order
    tails = np.append(heads[1:], len(p)) - 1
    first, last, n = p[heads], p[tails], tails - heads + 1
    gaps = first[1:] - last[:-1] - 1
    # whatever the source's gaps are, further than this nothing is joined
    far = _furthest(n, gaps)
    if not len(p) or (last[far] - first + 1).max() < width:
        return []
    there = np.where(gaps > GAP, _NEVER, gaps)
    joined = np.unique(np.concatenate([np.arange(i, j + 1) for i, j in enumerate(far.tolist()) if j > i and last[j] - first[i] + 1 >= width] or [np.zeros(0, np.int64)]))
    lines = {k: _lines(source[heads[k] : tails[k] + 1], place[heads[k] : tails[k] + 1] - p[heads[k] : tails[k] + 1]) for k in joined.tolist()}
    for k in range(len(gaps)):
        here, after = lines.get(k, {}), lines.get(k + 1, {})
        both = [(min(here[x][0], after[x][0]), after[x][1] - here[x][1]) for x in here.keys() & after.keys()]
        if both:
            shift = max(both)[1]
            if shift >= -gaps[k] and (shift < 0 or gaps[k] > GAP):
                there[k] = gaps[k] + shift
    result, done = [], -1
    for i, j in enumerate(_furthest(n, gaps + there).tolist()):
        a, z = int(first[i]), int(last[j])
        if j <= done or z - a + 1 < width:
            continue
        done = j
        own = slice(heads[i], tails[j] + 1)
        ids, counts = np.unique(source[own], return_counts=True)
        best = ids[counts.argmax()]
        at = place[own][source[own] == best]
        repeated = int(n[i : j + 1].sum())
        result.append({"start": a, "end": z + K, "repeated": repeated, "union": repeated + int((gaps + there)[i:j].sum()), "source": int(best), "at": int(at[len(at) // 2])})
    return result


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per passage: key, start_word, end_word, n_words, source_id, similarity (Jaccard, with the gaps on either side).

    A task that settles rows among its own knows an earlier document, which may not be the earliest; where that document's own passage
    comes from an earlier one still, that is the source.
    """
    found = staged(passages(docs, key, text, min_words).select("id", "d", F.explode("spans").alias("s")).select("id", "d", "s.*"), "passages")
    # a source may be that of most passages: its rows are dealt by salt
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt2")
    other = found.select(F.col("id").alias("i2"), F.col("start").alias("a2"), F.col("end").alias("z2"), F.col("source").alias("earlier")).distinct().select("*", salts)
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id", "d"), F.lit(SALTS)).cast("int"))
    hop = salted.join(other, (F.col("source") == F.col("i2")) & (F.col("salt") == F.col("salt2")) & (F.col("at") >= F.col("a2")) & (F.col("at") < F.col("z2")), "left")
    got = hop.groupBy("id", "d", "start", "end", "repeated", "union").agg(F.min(F.coalesce("earlier", "source")).alias("source"))
    back = lambda c: F.when(F.col(c) != _NULL_ID, F.col(c))
    return got.select(back("id").alias(key), F.col("start").alias("start_word"), F.col("end").alias("end_word"), (F.col("end") - F.col("start")).alias("n_words"), back("source").alias("source_id"), F.round(F.col("repeated") / F.col("union"), 6).alias("similarity"))


@shielded()
def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs without the passages that an earlier document has, and without documents of which nothing is left by that."""
    found = passages(docs, key, text, min_words).select(F.col("d").alias("_d"), "spans")
    names = docs.columns
    rows = docs.withColumn("_k", F.xxhash64(F.coalesce(F.col(key).cast("long"), F.lit(_NULL_ID)), F.col(text)))
    joined = rows.join(found, F.col("_k") == F.col("_d"), "left").drop("_k", "_d")
    at = names.index(text)

    def run(batches):
        for b in batches:
            found_ = b.column(len(names))
            hit = np.flatnonzero(found_.is_valid().to_numpy(zero_copy_only=False))
            keep = np.ones(b.num_rows, bool)
            cols = list(b.columns[: len(names)])
            if len(hit):
                texts = cols[at].to_pylist()
                for i, x in zip(hit.tolist(), found_.take(pa.array(hit)).to_pylist(), strict=True):
                    texts[i] = cut(texts[i], [(y["start"], y["end"]) for y in x])
                    keep[i] = bool(texts[i].strip())
                cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(keep))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.mapInArrow(frugal(run), schema)


def cut(text: str, ranges: list[tuple[int, int]]) -> str:
    """text without the words start to end - 1 of each range (in words), and without the white space after them."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    _, starts, _, _ = words_of(data, np.array([0, len(data)]))
    bounds = np.append(starts, len(data))
    out, at = [], 0
    for a, z in sorted(ranges):
        l, r = int(bounds[a]), int(bounds[min(z, len(starts))])  # noqa: E741
        if l > at:
            out.append(raw[at:l])
        at = max(at, r)
    out.append(raw[at:])
    return b"".join(out).decode()
