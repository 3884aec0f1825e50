"""Operators that relate texts to each other, and the pipeline."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from conftest import TESTDATA
from pyspark.sql import functions as F
from test_text_operators import CLASHES, EDGES, docs, empty

import corpus_pipeline
from meterloom.llm import common, compact_windows, pii, prefix_tree_join, queries, weak_labels

SF = f"{TESTDATA}/sf0.001"


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute_groups(sets, num, den):
    u = Union(len(sets))
    at = {}
    for i, x in enumerate(sets):
        for j, n in Counter(j for g in x for j in at.get(g, ())).items():
            if den * n >= num * (len(x) + len(sets[j]) - n):
                u.join(i, j)
        for g in x:
            at.setdefault(g, []).append(i)
    return [u.find(i) for i in range(len(sets))]


def texts(seed, n=120, words=400, length=(1, 40)):
    """Random texts with exact and edited copies of each other."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            w = list(rng.choice(out))
            for _ in range(rng.randint(0, 3)):
                if w and rng.random() < 0.5:
                    w[rng.randrange(len(w))] = f"w{rng.randrange(words)}"
                else:
                    w.insert(rng.randint(0, len(w)), f"w{rng.randrange(words)}")
        else:
            w = [f"w{rng.randrange(words)}" for _ in range(rng.randint(*length))]
        out.append(w)
    return [" ".join(w) for w in out]


# -- 9: join -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(60))
def test_tree_by_brute_force(seed):
    rng = random.Random(seed)
    num, den = rng.choice([(90, 100), (80, 100), (50, 100), (100, 100)])
    sets = {tuple(sorted(hash(s) & 0xFFFFFF for s in shingles(t, 3))) for t in texts(seed, 60, 60)} - {()}
    sets = [np.array(x, np.int64) for x in sorted(sets)]
    u = Union(len(sets))
    for a, b in prefix_tree_join.match_sets(sets, num, den).tolist():
        u.join(a, b)
    assert [u.find(i) for i in range(len(sets))] == brute_groups([set(x.tolist()) for x in sets], num, den)


@pytest.mark.parametrize("seed, k, num, block", [(1, 3, 90, None), (2, 3, 90, 30), (3, 5, 80, 60), (4, 2, 70, 40)])
def test_join_by_brute_force(spark, monkeypatch, seed, k, num, block):
    """Also with clusters cut into small blocks and with shingles that count as frequent."""
    if block:
        monkeypatch.setattr(prefix_tree_join, "BLOCK_SHINGLES", block)
        monkeypatch.setattr(prefix_tree_join, "FREQUENT_FROM", 2)
    rows = list(enumerate(texts(seed, length=(1, 60))))
    random.Random(seed).shuffle(rows)
    got = {r.doc_id: r for r in prefix_tree_join.linked(docs(spark, rows).repartition(3), k, num, 100).collect()}
    rows.sort()
    sets = [shingles(t, k) for _, t in rows]
    groups = brute_groups(sets, num, 100)
    assert [(got[i].n_shingles, got[i].component_id) for i in range(len(rows))] == [(len(s), g) for s, g in zip(sets, groups, strict=True)]
    assert len(set(groups)) < len(rows)


def test_hot_groups(spark, monkeypatch):
    """A third of the rows are copies of one text, another third are near copies of another; all texts end in one passage."""
    monkeypatch.setattr(prefix_tree_join, "BLOCK_SHINGLES", 4000)
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(3000)}"
    common_end = " ".join(word() for _ in range(12))
    copy, near = " ".join(word() for _ in range(80)), [word() for _ in range(120)]
    rows = [copy + " " + common_end] * 150
    for _ in range(150):
        w = list(near)
        w[rng.randrange(120)] = word()
        rows.append(" ".join(w) + " " + common_end)
    rows += [" ".join(word() for _ in range(60)) + " " + common_end for _ in range(150)]
    order = list(range(450))
    rng.shuffle(order)
    data = [(i, rows[j]) for i, j in enumerate(order)]
    got = {r.doc_id: r.component_id for r in prefix_tree_join.linked(docs(spark, data)).collect()}
    assert [got[i] for i in range(450)] == brute_groups([shingles(t, 3) for _, t in data], 90, 100)
    assert len(set(got.values())) == 152


def test_join_edges(spark):
    got = prefix_tree_join.linked(docs(spark, clashes=True)).collect()
    rows = {r.doc_id: r for r in got}
    assert len(got) == len(EDGES) and [rows[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert [rows[i].component_id for i in (1, 2, 3, 4, 5, 6)] == [1, 2, 3, 4, 5, 5] and rows[None].component_id is None
    assert prefix_tree_join.linked(empty(spark)).count() == 0
    df = docs(spark, clashes=True)
    kept = prefix_tree_join.deduplicated(df)
    assert kept.columns == df.columns and Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 5, 7, None, 8, 9])
    assert prefix_tree_join.deduplicated(empty(spark)).count() == 0


@pytest.mark.parametrize("finish", [common.FINISH, 0])
def test_components(spark, finish):
    """By one task at the end, and by rounds of stars alone."""
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)] + [(2000, x) for x in range(2001, 2050)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long").repartition(5), finish=finish).collect()}
    u = Union(2100)
    for a, b in edges:
        u.join(a, b)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: u.find(x) for x in linked}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 10: passages ------------------------------------------------------------------------------------------------------


def brute_windows(x, width):
    """(first, last, least) by the Cartesian tree, node by node: the windows of `width` that each node is the lowest one of, equal
    neighbours together."""
    of_window, stack = {}, [(0, len(x))]
    while stack:
        left, right = stack.pop()
        if right - left < width:
            continue
        c = min(range(left, right), key=lambda i: x[i])
        for w in range(max(left, c - width + 1), min(c, right - width) + 1):
            of_window[w] = x[c]
        stack += [(left, c), (c + 1, right)]
    out = []
    for w in sorted(of_window):
        if out and out[-1][1] == w - 1 and out[-1][2] == of_window[w]:
            out[-1][1] = w
        else:
            out.append([w, w, of_window[w]])
    return out


@pytest.mark.parametrize("seed", range(20))
def test_windows_by_brute_force(seed):
    """Several texts in a slice, with many equal values."""
    rng = np.random.default_rng(seed)
    texts_ = [rng.integers(0, 30, rng.integers(0, 80)).astype(np.uint64) for _ in range(5)]
    width = int(rng.integers(1, 9))
    values, row = np.concatenate(texts_), np.repeat(np.arange(5), [len(x) for x in texts_])
    begin = np.cumsum([0] + [len(x) for x in texts_])
    want = [[w + begin[i], z + begin[i], v] for i, x in enumerate(texts_) for w, z, v in brute_windows(x.tolist(), width)]
    assert [list(x) for x in zip(*(y.tolist() for y in compact_windows.windows(values, row, width)), strict=True)] == want


def test_one_word_a_million_times():
    """One node for each function, and in linear time."""
    first, last, _ = compact_windows.windows(np.zeros(1_000_000, np.uint64), np.zeros(1_000_000, np.int64), 21)
    assert (first.tolist(), last.tolist()) == ([0], [999_979])


def test_covered():
    text, left, right = np.array([3, 3, 3, 3, 7]), np.array([0, 30, 5, 20, 6]), np.array([10, 40, 8, 35, 9])
    assert list(compact_windows.covered(text, left, right, 2)) == [(3, [5, 8, 30, 35])]
    assert list(compact_windows.covered(text, left, right, 1)) == [(3, [0, 10, 20, 40]), (7, [6, 9])]
    assert list(compact_windows.covered(text[:0], left[:0], right[:0], 1)) == []


def planted(seed, n=60):
    """Random texts; some share a passage of 30 to 120 words. (texts, passages as (document, start, length, first document))"""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(100_000)}"
    out, spans = [[word() for _ in range(rng.randint(0, 200))] for _ in range(n)], []
    for _ in range(15):
        length = rng.choice([30, 49, 50, 51, 60, 120])
        passage = [word() for _ in range(length)]
        owners = sorted(rng.sample(range(n), rng.choice([2, 2, 3, 20])))
        for d in owners:
            out[d] += [*passage, *(word() for _ in range(15))]
            spans.append((d, len(out[d]) - length - 15, length, owners[0]))
    return [" ".join(w) for w in out], spans


@pytest.mark.parametrize("seed", range(4))
def test_passages_by_brute_force(spark, monkeypatch, seed):
    """Also where regions are too large to broadcast."""
    monkeypatch.setattr(compact_windows, "BROADCAST_BYTES", compact_windows.BROADCAST_BYTES * (seed % 2))
    rows, spans = planted(seed)
    found = compact_windows.repeated_passages(docs(spark, list(enumerate(rows))).repartition(3)).collect()
    want = {(d, start, start + n, first) for d, start, n, first in spans if d != first and n >= 50}
    assert {(r.doc_id, r.start_word, r.end_word, r.source_id) for r in found} == want
    assert all(r.similarity == 1.0 and r.n_words >= 50 for r in found)


def test_edited_passages(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(100_000)}"
    passage = [word() for _ in range(100)]
    edited = [*passage[:50], word(), *passage[51:]]
    fill = lambda: [word() for _ in range(30)]
    rows = [(1, " ".join(fill() + passage + fill())), (2, " ".join(fill() + edited + fill())), (3, " ".join(fill() + passage[:30] + fill()))]
    found = compact_windows.repeated_passages(docs(spark, rows)).collect()
    assert [(r.doc_id, r.start_word, r.end_word, r.source_id) for r in found] == [(2, 30, 130, 1)] and 0.8 <= found[0].similarity < 1


def test_edits_at_every_place(spark):
    """Passages of 50 words and more with words changed, at every place that leaves their ends, among random words."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10_000_000)}"
    some = lambda n: [word() for _ in range(n)]
    cases = [(50, [i]) for i in range(5, 45) for _ in range(8)] + [(60, [i]) for i in range(5, 55)] + [(100, [i, i + 30]) for i in range(20, 65)]
    rows, want = [], set()
    for n, (length, edits) in enumerate(cases):
        passage, before = some(length), rng.randint(0, 60)
        edited = [word() if i in edits else x for i, x in enumerate(passage)]
        rows += [(n, " ".join(some(rng.randint(0, 60)) + passage + some(40))), (10_000 + n, " ".join(some(before) + edited + some(40)))]
        want.add((10_000 + n, before, before + length, n))
    found = {(r.doc_id, r.start_word, r.end_word, r.source_id) for r in compact_windows.repeated_passages(docs(spark, rows).repartition(5)).collect()}
    assert sorted(want - found) == [] == sorted(found - want)


@pytest.mark.parametrize("length", [98, 130])
def test_insertions_and_deletions(spark, length):
    """Of 5 to 15 words in the middle and elsewhere, as far as the similarity is 0.8; also a changed word close to either end."""
    rng = random.Random(length)
    word = lambda: f"w{rng.randrange(10_000_000)}"
    some = lambda n: [word() for _ in range(n)]
    rows, want, n = [], {}, 0
    for w in range(5, 16):
        for at in (length // 2, length // 3, 10):
            for kind in ("in", "out"):
                passage, before = some(length), some(rng.randint(0, 60))
                edited = passage[:at] + some(w) + passage[at:] if kind == "in" else passage[:at] + passage[at + w :]
                a, b = (shingles(" ".join(x), 5) for x in (passage, edited))
                rows += [(n, " ".join(some(30) + passage + some(30))), (10_000 + n, " ".join(before + edited + some(30)))]
                if len(a & b) >= 0.8 * len(a | b):
                    want[10_000 + n] = (len(before), len(before) + len(edited), round(len(a & b) / len(a | b), 6) if kind == "in" else None)
                n += 1
    for i in range(5, 65):
        passage = some(100)
        edited = [word() if j in (i, i + 30) else x for j, x in enumerate(passage)]
        rows += [(n, " ".join(passage + some(30))), (10_000 + n, " ".join(edited + some(30)))]
        want[10_000 + n] = (0, 100, round(86 / 106, 6))
        n += 1
    found = {r.doc_id: (r.start_word, r.end_word, r.similarity if i is None or want.get(i, (0, 0, None))[2] else None) for r in compact_windows.repeated_passages(docs(spark, rows).repartition(5)).collect() for i in [r.doc_id]}
    assert {i: x for i, x in want.items() if found.get(i) != x} == {} and len(want) > 100


def test_every_shingle_tells_the_source():
    """22 shingles of document 1 and 24 of document 2; of the places divisible by 8, three are of the first and two of the second."""
    p = np.arange(1, 47)
    source = np.where((p >= 4) & (p <= 25), 1, 2)
    (got,) = compact_windows.spans(p, source, p + 100, 46)
    assert (got["start"], got["end"], got["repeated"], got["source"], got["at"]) == (1, 51, 46, 2, 135)


def test_run_and_reach():
    assert [compact_windows.run_of(n) for n in (46, 10, 96)] == [21, 10, 24]
    assert compact_windows.reached([100, 110, 400, 410], 5) == [70, 140, 370, 440]
    assert compact_windows.reached([100, 110, 150, 160, 215, 220], 5) == [33, 287]
    assert compact_windows.reached([], 5) == []


def test_a_passage_in_most_documents(spark, monkeypatch):
    """Also where tasks settle their rows in small blocks."""
    monkeypatch.setattr(compact_windows, "BLOCK_ROWS", 300)
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(100_000)}"
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(20)] + (passage if i % 3 else []) + [word() for _ in range(20)])) for i in range(300)]
    found = compact_windows.repeated_passages(docs(spark, rows).repartition(6)).collect()
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in found) == [(i, 20, 80) for i in range(2, 300) if i % 3]
    left = {r.doc_id: r.text for r in compact_windows.without_repeats(docs(spark, rows)).collect()}
    for i, t in rows:
        w = t.split()
        assert left[i].split() == (w[:20] + w[80:] if i % 3 and i > 1 else w)


def test_passage_edges(spark):
    df = docs(spark, clashes=True)
    assert compact_windows.repeated_passages(df).count() == 0  # a text's repeats of its own are no matter
    kept = compact_windows.without_repeats(df)
    assert kept.columns == df.columns and Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(EDGES)
    assert compact_windows.repeated_passages(empty(spark)).count() == compact_windows.without_repeats(empty(spark)).count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    both = docs(spark, [(1, text), (2, text), (2, text), (3, text + "\n tail "), (None, text)])
    assert sorted((r.doc_id, r.text) for r in compact_windows.without_repeats(both).filter("doc_id is not null").collect()) == [(3, "tail ")]
    assert compact_windows.cut("é b  c\nd", [(1, 3)]) == "é d" and compact_windows.cut(" a b ", [(0, 2)]) == " "


# -- the pipeline ------------------------------------------------------------------------------------------------------


def brute_without_repeats(rows):
    """[(id, text)] in the order of ids, with spans of 46 and more shingles that earlier documents have taken out."""
    seen, out = set(), []
    for i, t in rows:
        w = words_of(t)
        s = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
        out.append((i, [x in seen for x in s]))
        seen |= set(s)
    return out


def test_stages_by_brute_force(spark):
    """Each stage on its predecessor's result: what it drops, keeps and changes."""
    frames, current = {}, spark.read.parquet(f"{SF}/documents.parquet")
    columns = current.columns
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = (current, stage(spark, current, SF))
        current = common.staged(frames[name][1], "test")
        frames[name] = (frames[name][0], current)
        if name != "packing":
            assert current.columns == columns

    def rows(df):
        return {r.doc_id: r.text for r in df.collect()}

    before, after = map(rows, frames["quality classifier"])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert set(after) == {r.doc_id for r in weak_labels.classified(frames["quality classifier"][0], labels).filter("kept").collect()} and 0 < len(after) < len(before)
    before, after = map(rows, frames["n-gram Jaccard join"])
    ids = sorted(before)
    groups = brute_groups([shingles(before[i], 5) for i in ids], 80, 100)
    assert after == {i: before[i] for i in {ids[g] for g in groups}}
    before, after = map(rows, frames["substring dedup"])
    for i, seen in brute_without_repeats(sorted(before.items())):
        w, left = words_of(before[i]), words_of(after.get(i, ""))
        longest = max((len(x) for x in "".join("x" if s else " " for s in seen).split()), default=0)
        if longest < 46 and i in after and len(left) == len(w):
            assert before[i] == after[i]
        if longest >= 46:
            assert len(left) < len(w)
        if not any(seen):
            assert before[i] == after[i]
    before, after = map(rows, frames["PII"])
    assert after == {r.doc_id: r.text for r in pii.pseudonymised(frames["PII"][0]).collect()} and after.keys() == before.keys()
    assert all(r.n_chars == len(r.text) for r in frames["PII"][1].collect())
    packed = frames["packing"][1].groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    library = tokenizers.Tokenizer.from_file(queries.vocabulary_path())
    assert {r.doc_id: r.n for r in packed} == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in after.items()}
    whole = corpus_pipeline.run(spark, SF)
    assert whole.exceptAll(frames["packing"][1]).isEmpty() and frames["packing"][1].exceptAll(whole).isEmpty()


def test_pipeline_takes_odd_tables(spark):
    df = docs(spark, clashes=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        assert out.count() > 0 and stage(spark, df.limit(0), SF).count() == 0
        if name != "packing":
            assert out.columns == df.columns


def test_queries_registered():
    names = list(queries.QUERIES)
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)] and len(corpus_pipeline.STAGES) == 5


def test_shield(spark):
    @common.shielded()
    def inner(df):
        assert set(df.columns) & {"lang", "n"} == set()
        return df.withColumn("n", F.lit(1))

    @common.shielded()
    def outer(df):
        return inner(df).filter("n = 1")

    df = spark.createDataFrame([(1, "t", "en", "x")], "doc_id long, text string, lang string, n string")
    assert inner(df).first().n == 1 and inner(df).first().lang == "en"
    assert outer(df.drop("n")).columns == ["doc_id", "text", "lang", "n"]


def test_staged_tables_go_where_the_session_says(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda s: f"file://{tmp_path}")
    one, two = (common.staged(spark.range(3), "x") for _ in range(2))
    assert one.count() == 3 and len(list(tmp_path.glob("x-*"))) == 2
    common.discard(one)
    assert two.count() == 3 and len(list(tmp_path.glob("x-*"))) == 1
    monkeypatch.setattr(common, "_staged", {two._staged_at})
    common.sweep(spark)
    assert not list(tmp_path.glob("x-*"))
    texts_ = pa.array(["a b", None])
    assert [x[1] for x in common.slices(texts_)] == [2]
