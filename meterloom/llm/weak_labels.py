"""Quality classifier from weak labels: a label model of overlapping heuristics, and a hashed linear scorer trained on its posteriors.

Two aspects are modelled alike: form (symbols, capitals, repeated lines, windows and words) and abuse (insults). For each, heuristic
labellers vote bad, good or not at all. One more is learned: a scorer like the last one, but trained on given labels alone, votes bad where
it is sure. Given labels, where there are any, vote themselves. Expectation-maximisation over
the counts of all vote patterns (a table of bounded size, counted over all documents) estimates the accuracy of each labeller where
it votes, and a posterior for every pattern. Not to vote is no evidence: each heuristic knows one kind of badness only. The posteriors of a bounded sample train a sparse logistic scorer over hashed
features (binned statistics and words), which then scores every document. A document is rejected if either score is above THRESHOLD.

Null and empty texts have no words: nothing votes on them, and only the scorers' features of an empty text speak. They are kept, as
there is nothing bad in them. Repeated rows get equal scores; of several labels of a document the greatest count. A score equal to
THRESHOLD is no rejection. Texts are taken whole, in blocks of bounded size. An empty table gives an empty one; without labels the
heuristics vote alone. Columns beside id and text go along, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrays_of, batch_rows, byte_tables, frugal, hash_words, mix, repeats, shielded, shingles_of, slices, words_of

#: Documents whose posteriors the scorers are fitted on, at most; hashed features; passes.
SAMPLE, BUCKETS, EPOCHS = 6000, 1 << 18, 3
THRESHOLD = 0.5
#: Insults: fixed values, in three lists that vote apart from each other.
INSULTS = [
    ["idiot", "moron", "stupid", "dumb", "imbecile", "fool", "dimwit"],
    ["loser", "clown", "pathetic", "worthless", "useless", "coward"],
    ["trash", "scum", "disgusting", "filth", "vermin", "garbage", "ugly"],
]
SYMBOLS = b"#*$%&|<>"
FORM = ["symbols", "capitals", "repeated_lines", "repeated_windows", "repeated_words", "word_length", "all_clear", "learned", "given"]
ABUSE = ["insults_a", "insults_b", "insults_c", "insult_share", "all_clear", "learned", "given"]
#: From what score on the learned labeller votes, how little it is held to zero, and labels of either kind that it needs.
SURE, LEARNED_L1, LEAST_LABELS = 0.8, 2.0, 5
STATISTICS = ["n_words", "symbols", "capitals", "repeated_lines", "repeated_windows", "distinct_words", "word_length", "insults_a", "insults_b", "insults_c"]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice of texts: statistics (a row each), hashes of letter runs, and where each text's begin."""
    n = len(offsets) - 1
    h, starts, ends, at = words_of(data, offsets)
    rows = np.repeat(np.arange(n), np.diff(at))
    words = np.diff(at)
    per = lambda hit, row: np.bincount(row[hit], minlength=n)
    share = lambda x, y: x / np.maximum(y, 1)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    _, between = byte_tables()

    def count(mask: np.ndarray) -> np.ndarray:
        ends_ = np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])
        return ends_[offsets[1:]] - ends_[offsets[:-1]]

    upper = np.zeros(256, bool)
    upper[65:91] = True
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    line, _, _, line_at = words_of(data, offsets, "lines")
    line_rows = np.repeat(np.arange(n), np.diff(line_at))
    windows = shingles_of(h, 3)
    inside = rows[: len(windows)] == rows[2:] if len(windows) else np.zeros(0, bool)
    twice, _ = repeats(windows[inside], rows[: len(windows)][inside])
    run, _, _, run_at = words_of(data, offsets, "letters")
    run_rows = np.repeat(np.arange(n), np.diff(run_at))
    insults = [per(np.isin(run, hash_words(x, "letters")), run_rows) for x in INSULTS]
    out = np.column_stack([
        words,
        share(count(symbol), words),
        share(count(upper), count(ascii_letter)),
        np.where(np.diff(line_at) > 4, share(per(repeats(line, line_rows)[1], line_rows), np.diff(line_at)), 0),
        share(per(twice, rows[: len(windows)][inside]), np.maximum(words - 2, 1)),
        share(words - per(repeats(h, rows)[1], rows), words),
        share(np.bincount(rows, weights=ends - starts, minlength=n), words),
        *insults,
    ]).astype(np.float64)
    return out, run, run_at


def votes(stats: np.ndarray, learned: dict[str, np.ndarray], quality: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes on form and on abuse, a column for each labeller: 1 bad, 0 good, 2 none. learned: the learned labellers' scores; quality,
    toxic: given labels, NaN where none."""
    s = {name: stats[:, i] for i, name in enumerate(STATISTICS)}
    some = s["n_words"] >= 1

    def vote(bad, on=some):
        return np.where(on & bad, 1, 2)

    long = s["n_words"] >= 20
    form = [
        vote(s["symbols"] > 0.3),
        vote(s["capitals"] > 0.5, some & (s["n_words"] >= 5)),
        vote(s["repeated_lines"] > 0.3, long),
        vote(s["repeated_windows"] > 0.45, long),
        vote(s["distinct_words"] < 0.15, long),
        vote((s["word_length"] > 25) | (s["word_length"] < 2), long),
    ]
    calm = (s["symbols"] < 0.15) & (s["capitals"] < 0.35) & (s["repeated_lines"] < 0.2) & (s["repeated_windows"] < 0.3)
    insults = s["insults_a"] + s["insults_b"] + s["insults_c"]
    abuse = [vote(s[x] >= 1) for x in ("insults_a", "insults_b", "insults_c")] + [vote((insults >= 2) | (insults > 0.02 * s["n_words"]))]
    form += [np.where(some & calm, 0, 2), vote(learned["form"] > SURE), np.where(np.isnan(quality), 2, 1 - np.nan_to_num(quality))]
    abuse += [np.where(some & (insults == 0), 0, 2), vote(learned["abuse"] > SURE), np.where(np.isnan(toxic), 2, np.nan_to_num(toxic))]
    return np.column_stack(form).astype(np.int8), np.column_stack(abuse).astype(np.int8)


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """(accuracy of each labeller where it votes, posterior of bad for each pattern), by expectation-maximisation.

    Labellers start at 0.9, and so many imagined votes as a hundredth of the real ones hold them there, so that one that seldom votes
    isn't believed beyond reason. Both classes count as equally likely before any vote.
    """
    sign = np.where(patterns == 1, 1.0, np.where(patterns == 0, -1.0, 0.0))
    cast = np.abs(sign) * counts[:, None]
    held = 1.0 + 0.01 * cast.sum(0)
    accuracy = np.full(patterns.shape[1], 0.9)
    post = np.full(len(patterns), 0.5)
    for _ in range(rounds):
        new = 1 / (1 + np.exp(-np.clip(sign @ np.log(accuracy / (1 - accuracy)), -30, 30)))
        right = np.where(sign > 0, new[:, None], 1 - new[:, None])
        accuracy = np.clip(((cast * right).sum(0) + 0.9 * held) / (cast.sum(0) + held), 0.5, 0.999)
        moved = np.abs(new - post).max()
        post = new
        if moved < 1e-7:
            break
    return accuracy, post


def scorer_features(stats: np.ndarray, runs: np.ndarray, run_at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text (buckets, weights): binned statistics, and the distinct letter runs with little weight."""
    bins = [
        np.digitize(stats[:, 0], [1, 5, 20, 50, 200, 1000]),
        *(np.digitize(stats[:, i], [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0]) for i in (1, 2, 3, 4, 5)),
        np.digitize(stats[:, 6], [2, 3, 5, 8, 12, 18, 25]),
        np.digitize(stats[:, 7:10].sum(1), [1, 2, 4]),
    ]
    grid = np.column_stack(bins).astype(np.uint64)
    fixed = mix(grid + np.arange(1, grid.shape[1] + 1, dtype=np.uint64)[None, :] * np.uint64(1000003))
    out = []
    for i in range(len(stats)):
        own = np.unique(runs[run_at[i] : run_at[i + 1]])
        b = np.concatenate([fixed[i], own])
        out.append(((b & np.uint64(BUCKETS - 1)).astype(np.int32), np.concatenate([np.ones(len(fixed[i]), np.float32), np.full(len(own), 0.5, np.float32)])))
    return out


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], l1: float = 8.0, seed: int = 3) -> np.ndarray:
    """Weights (the last is the bias) by follow-the-regularised-leader steps: L1 keeps words without bearing at exactly 0."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    alpha, beta, l2 = 0.2, 1.0, 1.0

    def weights(i):
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            b, x, y = rows[k]
            i, x = np.append(b.astype(np.int64), BUCKETS), np.append(x.astype(np.float64), 1.0)
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - step * w
            n[i] += g * g
    return weights(np.arange(BUCKETS + 1))


def dense(scorers: dict) -> dict[str, np.ndarray]:
    """Scorers as they travel (buckets, weights, bias) as arrays, the bias at the end."""
    out = {}
    for aspect, (used, weights, bias) in scorers.items():
        out[aspect] = np.zeros(BUCKETS + 1)
        out[aspect][used], out[aspect][-1] = weights, bias
    return out


def scores(features_: list[tuple[np.ndarray, np.ndarray]], w: np.ndarray | None) -> np.ndarray:
    """0 to 1 for each text; 0 without a scorer."""
    if w is None:
        return np.zeros(len(features_))
    z = np.array([w[b] @ x for b, x in features_]) + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _with_labels(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """doc_id, text, h, quality, toxic; the labels come by a join on the ids, of which one row each is taken."""
    rows = docs.select("doc_id", "text", "h")
    if labels is None:
        return rows.withColumns({"quality": F.lit(None).cast("double"), "toxic": F.lit(None).cast("double")})
    one = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("quality").cast("double")).alias("quality"), F.max(F.col("toxic").cast("double")).alias("toxic"))
    return rows.join(one, F.col("doc_id") == F.col("_id"), "left").drop("_id")


def _voted(docs: DataFrame, learned: dict) -> DataFrame:
    """(doc_id, form, abuse): vote patterns of all labellers but the given labels, as strings."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches):
        w = dense(shared.value)
        for b in batches:
            form, abuse = [], []
            for _, n, data, offsets in slices(b.column(1)):
                stats, runs, at = features(data, offsets)
                none = np.full(n, np.nan)
                hashed = scorer_features(stats, runs, at) if w else []
                sure = {x: scores(hashed, w[x]) if x in w else np.zeros(n) for x in ("form", "abuse")}
                for out, x in zip((form, abuse), votes(stats, sure, none, none), strict=True):
                    out += ["".join(map(str, row)) for row in x[:, :-1].tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(form, pa.string()), pa.array(abuse, pa.string())], names=["doc_id", "form", "abuse"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(frugal(run), "doc_id long, form string, abuse string")


def train(docs: DataFrame, labels: DataFrame | None = None, most: int = SAMPLE) -> dict | None:
    """Both aspects' label models over all documents, and scorers on a sample. The plain values that score() needs."""
    batch_rows(docs.sparkSession)
    sample = _sample(docs, labels, most)
    if sample is None:
        return None
    learned = {x: _sparse(fit_scorer([(*f, y) for f, y in zip(sample["features"], given, strict=True) if not np.isnan(y)], LEARNED_L1)) for x, given in sample["given"].items() if _enough(given)}
    voted = _voted(docs, learned)
    # given labels join the votes, not the texts
    if labels is None:
        voted = voted.withColumns({"q": F.lit("2"), "t": F.lit("2")})
    else:
        one = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
        joined = voted.join(one, F.col("doc_id") == F.col("_id"), "left")
        voted = joined.withColumns({"q": F.coalesce((1 - F.col("q")).cast("int").cast("string"), F.lit("2")), "t": F.coalesce(F.col("t").cast("int").cast("string"), F.lit("2"))})
    patterns = voted.groupBy(F.concat("form", "q").alias("form"), F.concat("abuse", "t").alias("abuse")).count().collect()  # bounded by the patterns that there are; some dozens in truth
    out: dict = {"models": {}, "scorers": {}, "posteriors": {}, "learned": learned}
    w = dense(learned)
    sure = {x: scores(sample["features"], w.get(x)) for x in ("form", "abuse")}
    sampled = votes(sample["stats"], sure, 1 - sample["given"]["form"], sample["given"]["abuse"])
    for aspect, at in (("form", 0), ("abuse", 1)):
        sums: dict = {}
        for r in patterns:
            if set(r[at]) != {"2"}:  # without any vote there is nothing to learn
                sums[r[at]] = sums.get(r[at], 0) + r[2]
        keys = sorted(sums) or ["2" * len((FORM, ABUSE)[at])]
        matrix = np.array([[int(c) for c in k] for k in keys])
        accuracy, post = label_model(matrix, np.array([sums.get(k, 1) for k in keys], float))
        out["posteriors"][aspect] = known = dict(zip(keys, post.tolist(), strict=True))
        out["models"][aspect] = dict(zip((FORM, ABUSE)[at], accuracy.tolist(), strict=True))
        targets = [known.get("".join(map(str, v))) for v in sampled[at].tolist()]
        out["scorers"][aspect] = _sparse(fit_scorer([(*f, y) for f, y in zip(sample["features"], targets, strict=True) if y is not None]))
    return out


def _enough(given: np.ndarray) -> bool:
    return min((given == 0).sum(), (given == 1).sum()) >= LEAST_LABELS


def _sparse(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    used = np.flatnonzero(weights[:-1])
    return used.astype(np.int32), weights[used], float(weights[-1])


def _sample(docs: DataFrame, labels: DataFrame | None, most: int) -> dict | None:
    """Statistics, hashed features and given labels (1 bad, 0 good, NaN none) of at most `most` documents, the first by a hash of the id.
    None for an empty table."""
    n = docs.select(F.count("*")).first()[0]
    if not n:
        return None
    share = int(min(1.0, 1.2 * most / n) * (1 << 20)) + 1
    h = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(23))
    some = docs.filter(F.col("text").isNotNull()).select("doc_id", "text").withColumn("h", h).filter(F.pmod("h", F.lit(1 << 20)) < share)
    rows = _with_labels(some, labels).select("h", "text", "quality", "toxic")

    def run(batches):
        for b in batches:
            found: list = [[], [], []]
            for _, _, data, offsets in slices(b.column(1)):
                stats, runs, at = features(data, offsets)
                found[0] += list(stats)
                for buckets, weights in scorer_features(stats, runs, at):
                    found[1].append(buckets)
                    found[2].append(weights)
            kinds = [pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.float32())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), *(pa.array(x, k) for x, k in zip(found, kinds, strict=True))], names=["h", "quality", "toxic", "s", "b", "w"])

    got = rows.mapInArrow(frugal(run), "h long, quality double, toxic double, s array<double>, b array<int>, w array<float>").orderBy("h", F.xxhash64("b")).limit(most).toArrow()
    given = {c: got.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("quality", "toxic")}
    stats = np.array(arrays_of(got.column("s"))).reshape(-1, len(STATISTICS))
    return {"stats": stats, "features": list(zip(arrays_of(got.column("b")), arrays_of(got.column("w")), strict=True)), "given": {"form": 1 - given["quality"], "abuse": given["toxic"]}}


@shielded()
def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """docs with bad_form, abuse (0 to 1) and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model and model["scorers"])
    names = docs.columns
    at = names.index("text")

    def run(batches):
        scorers = dense(shared.value or {})
        for b in batches:
            out = {"form": np.zeros(b.num_rows), "abuse": np.zeros(b.num_rows)}
            for first, _, data, offsets in slices(b.column(at)):
                stats, runs, run_at = features(data, offsets)
                hashed = scorer_features(stats, runs, run_at)
                for aspect, w in scorers.items():
                    out[aspect][first : first + len(hashed)] = np.where(stats[:, 0] > 0, scores(hashed, w), 0)
            kept = (out["form"] <= THRESHOLD) & (out["abuse"] <= THRESHOLD)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out["form"]), pa.array(out["abuse"]), pa.array(kept)], names=[*names, "bad_form", "abuse", "kept"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return docs.select(*names).mapInArrow(frugal(run), f"{schema}, bad_form double, abuse double, kept boolean")


def classified(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    return score(docs, train(docs, labels))


@shielded()
def accepted(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The documents that aren't rejected, with their own columns."""
    return classified(docs, labels).filter("kept").select(*docs.columns)
