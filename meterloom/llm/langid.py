"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by stochastic gradient descent.

A text's subwords are the 2- and 3-character windows of its lower-cased letters, any run of other characters counting as one word
boundary; each hashes to one of BUCKETS embeddings. The mean embedding goes through a linear softmax. As both are linear, a
bucket's contribution to each language's logit is precomputed, and a text's logits are the mean over its subwords: one gather and
one segmented sum for a whole block of texts.

The model is fitted on at most SAMPLE texts, chosen by a hash of the id; only their bucket counts reach the driver. Part of the
sample is set aside: on it a temperature and a rejection threshold are calibrated. Every text gets a prediction.

Null text or a text without a letter: `und` with score 0, rejected. Texts are taken whole, in blocks of bounded size; of languages that
are equally likely the first in the alphabet is the prediction, and a score equal to the threshold is accepted. An empty table gives an
empty one; columns beside doc_id, text and lang are not read. Repeated rows get equal results. Without any labelled row every
text is `und`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrays_of, batch_rows, kept

#: Texts that the model is fitted on, at most; embeddings and their size; passes over the sample.
SAMPLE, BUCKETS, DIMENSIONS, EPOCHS = 4000, 1 << 15, 16, 6
#: Share of the accepted texts that may be wrong, on the texts set aside.
ERRORS_ACCEPTED = 0.02
#: Characters that are hashed at once.
BLOCK_CHARS = 1 << 20
UND = "und"

def letters() -> np.ndarray:
    return kept("letters", lambda: np.frombuffer(bytes(map(str.isalpha, map(chr, range(0x110000)))), bool))


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all texts' subwords, where each text's begin and the last ends)."""
    lowered = [t.lower() for t in texts]
    code = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass") + b"\n\0\0\0", np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    is_letter = letters()[code]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # a letter, or the one boundary after a word
    code = np.where(is_letter, code, 0).astype(np.uint32)[keep]
    at = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])]
    n = len(code)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    h2 = code[:-1] * np.uint32(0x9E3779B1) ^ code[1:] * np.uint32(0x85EBCA77)
    h3 = np.zeros(n - 1, np.uint32)
    h3[1:] = (code[:-2] * np.uint32(0xC2B2AE3D) + code[1:-1] * np.uint32(0x27D4EB2F)) ^ (code[2:] * np.uint32(0x165667B1)) + np.uint32(0x9E37)
    both = np.empty(2 * (n - 1), np.uint32)
    both[0::2], both[1::2] = h2, h3
    both ^= both >> np.uint32(15)
    both *= np.uint32(0x2C1B3C6D)
    both ^= both >> np.uint32(13)
    # window i ends at character i + 1; windows of a text are those that end in it, and begin in it for the most part: a text's
    # first character is preceded by the boundary that ends the last text
    lo = 2 * np.clip(at - 1, 0, n - 1)
    lo[0], lo[-1] = 0, 2 * (n - 1)
    return (both & np.uint32(BUCKETS - 1)).astype(np.int64), lo


def blocks(texts: list[str]):
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) < BLOCK_CHARS):
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


class Model:
    """Languages and each bucket's contribution to their logits."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, threshold: float = 0.0):
        self.languages, self.table, self.bias, self.temperature, self.threshold = languages, table, bias, temperature, threshold

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(logits, number of subwords) of each text."""
        out, sizes = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for first, block in blocks(texts):
            b, at = subwords(block)
            n = np.diff(at)
            has = n > 0
            if len(b) and has.any():
                # Each text by itself: its result doesn't depend on what stands beside it.
                got = self.table[b]
                for i in np.flatnonzero(has):
                    out[first + i] = got[at[i] : at[i + 1]].sum(0, dtype=np.float64)
            out[first : first + len(block)] /= np.maximum(n, 1)[:, None]
            sizes[first : first + len(block)] = n
        return out + self.bias, sizes

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model | None:
    """samples: (language, buckets, counts) of texts, in a fixed order; buckets and counts as arrays."""
    samples = [x for x in samples if x[0] is not None and len(x[1])]
    languages = sorted({x[0] for x in samples})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    k = len(languages)
    emb = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    out, bias = np.zeros((DIMENSIONS, k), np.float32), np.zeros(k, np.float32)
    y = np.array([languages.index(x[0]) for x in samples])
    data = [(b, c.astype(np.float32) / np.float32(c.sum())) for _, b, c in samples]
    order = rng.permutation(len(samples))
    aside = order[: len(order) // 5] if len(order) >= 50 else order[:0]
    train = order[len(aside) :]
    steps, done = EPOCHS * len(train), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(train):
            rate = np.float32(1.0 * (1 - done / steps))
            done += 1
            b, w = data[i]
            x = w @ emb[b]
            z = x @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= rate * np.outer(x, p)
            bias -= rate * np.float32(0.1) * p
            emb[b] -= (rate * np.float32(8.0)) * w[:, None] * back[None, :]
    model = Model(languages, (emb @ out).astype(np.float32), bias.astype(np.float64))
    if len(aside):
        _calibrate(model, [data[i] for i in aside], y[aside])
    return model


def _calibrate(model: Model, data: list, y: np.ndarray) -> None:
    """The temperature of least log loss, then the lowest threshold at which few enough of the accepted are wrong."""
    z = np.array([(w[:, None].astype(np.float64) * model.table[b]).sum(0) for b, w in data]) + model.bias
    rows = np.arange(len(y))

    def loss(t):
        u = z / t
        u = u - u.max(1, keepdims=True)
        return float((np.log(np.exp(u).sum(1)) - u[rows, y]).mean())

    model.temperature = min(np.geomspace(0.05, 5, 41), key=loss)
    p = model.probabilities(z)
    best, right = p.max(1), p.argmax(1) == y
    order = np.argsort(-best, kind="stable")
    wrong = np.cumsum(~right[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(wrong <= ERRORS_ACCEPTED)
    model.threshold = float(best[order[good[-1]]]) if len(good) else 1.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(lang, buckets, counts) of at most `most` rows that may be learned from, the first by a hash of the id."""
    usable = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = usable.select(F.count("*")).first()[0]
    share = min(1.0, 1.2 * most / max(n, 1))
    h = F.xxhash64(F.col("doc_id").cast("string"), F.lit(11))
    some = usable.select("doc_id", "lang", "text", h.alias("h")).filter(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def count(batches):
        for b in batches:
            rows = [[], []]
            for t in b.column(1).to_pylist():
                got, n = np.unique(subwords([t])[0], return_counts=True)
                rows[0].append(got.astype(np.int32))
                rows[1].append(n.astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.list_(pa.int32())) for x in rows), b.column(2)], names=["lang", "buckets", "counts", "h"])

    kept = some.select("lang", "text", "h").mapInArrow(count, "lang string, buckets array<int>, counts array<int>, h long")
    return kept.orderBy("h", "lang", F.xxhash64("buckets", "counts")).limit(most).select("lang", "buckets", "counts")


def train(docs: DataFrame, most: int = SAMPLE) -> Model | None:
    got = sampled(docs, most).toArrow()
    return fit(list(zip(got.column("lang").to_pylist(), arrays_of(got.column("buckets")), arrays_of(got.column("counts")), strict=True)))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, rejected."""
    batch_rows(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang")
    model = model or train(docs)
    # plain values: what is broadcast is read without this package
    shared = docs.sparkSession.sparkContext.broadcast(model and (model.languages, model.table, model.bias, model.temperature, model.threshold))

    def run(batches):
        m = shared.value and Model(*shared.value)
        for b in batches:
            texts = ["" if t is None else t for t in b.column(1).to_pylist()]
            if m is None:
                lang, score = [UND] * len(texts), [0.0] * len(texts)
            else:
                z, _ = m.logits(texts)
                p = m.probabilities(z)
                has = [any(map(str.isalpha, t)) for t in texts]  # ends at the first letter
                best = p.argmax(1)
                lang = [m.languages[i] if ok else UND for i, ok in zip(best, has, strict=True)]
                score = [float(x) if ok else 0.0 for x, ok in zip(p.max(1), has, strict=True)]
            rejected = [m is None or s < m.threshold or x == UND for s, x in zip(score, lang, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
