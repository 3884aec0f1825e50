"""Quality rules in a short-circuit cascade, of DataFrame expressions only.

Each rule's cost (time over a sample with the statistics that it needs, beyond a bare scan) and selectivity (share of the sample that it
rejects) are measured;
the rules then run in the order of rejections per cost, and a document that one rejects isn't seen by those behind it. The order
changes what is computed, never the verdict: a document is kept if no rule rejects it.

Null or empty text: no words, all counts 0, base_failed, not kept. Texts are taken whole; a document is one row from end to end, so
nothing is shuffled and no group can be hot. Repeated rows get equal results. An empty table gives an empty one. A value equal to a bound
breaks no rule. Columns beside the text go along, whatever their names.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shielded

#: Rows that costs and selectivities are measured on, at most, and how often a task goes over them.
SAMPLE, COPIES = 1000, 3
_SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{_SPACE}|{_SPACE}\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE))


def repeat_words(w: Column, k: int = 3) -> Column:
    """Words in k-word windows found twice or more in the text: windows are sorted by hash, so equal ones are neighbours."""
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))

    def covered(s: Column) -> Column:
        same = lambda j, e: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
        at = F.transform(F.filter(s, lambda e, j: same(j - 1, e) | same(j + 1, e)), lambda e: e["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(*[i + j for j in range(k)])))))

    def of(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ordered, covered))

    return F.when(n < k + 1, F.lit(0)).otherwise(let(hashes, of))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeat_words(w).cast("long").alias("n_repeat_words")))
    symbols = F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long")
    dup = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    got = docs.withColumns({"_w": of_words, "n_symbols": symbols, "n_dup_lines": dup, "_lines": F.size(lines)})
    return got.withColumns({c: F.col(f"_w.{c}") for c in ("n_words", "word_chars", "n_repeat_words")}).drop("_w")


def default_rules(text: str = "text") -> dict[str, Column]:
    """Rule name -> whether it rejects; all over the columns of statistics(). Shares leave room for a junk line in a sound document."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.col("n_words")
    upper = F.length(F.regexp_replace(t, r"\P{Lu}+", ""))
    letters = F.length(F.regexp_replace(t, r"\P{L}+", ""))
    return {
        "too_short": n < 50,
        "repeated_windows": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > 3 * n,
        "repeated_lines": (F.col("_lines") > 4) & (10 * F.col("n_dup_lines") > 3 * F.col("_lines")),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n),
        "shouting": (upper > 0) & (10 * upper > 4 * letters),
        "few_letters": 10 * letters < 6 * F.col("word_chars"),
    }


def alone(text: str = "text") -> dict[str, Column]:
    """The columns of statistics(), each by itself: what a rule costs that is the only one to need them."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words(t)).cast("long"),
        "word_chars": F.length(F.regexp_replace(t, _SPACE, "")).cast("long"),
        "n_repeat_words": let(words(t), lambda w: repeat_words(w)).cast("long"),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "_lines": F.size(lines),
    }


def measure(docs: DataFrame, rules: dict[str, Column], most: int = SAMPLE, key: str = "doc_id", text: str = "text") -> dict[str, tuple[float, float]]:
    """rule -> (cost, share rejected) on at most `most` rows, the first by a hash of the key.

    A rule's cost is the time of one task over COPIES of the sample, from the texts, with the statistics that the rule needs and no others,
    less that of a rule that needs none; in steps of a factor of four, so that the machine's moods seldom change the order.
    """
    n = docs.select(F.count("*")).first()[0]
    share = int(min(1.0, 1.2 * most / max(n, 1)) * (1 << 20)) + 1
    h = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(5))
    some = docs.select(text, h.alias("_h")).filter(F.pmod("_h", F.lit(1 << 20)) < share)
    sample = some.orderBy("_h", F.xxhash64(text)).limit(most).select(text).coalesce(1).persist()
    try:
        size = max(sample.count(), 1)
        copies = sample.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES)))).withColumns(alone(text))

        def run(condition: Column) -> tuple[float, int]:
            took, rejected = [], 0
            for _ in range(2):
                began = time.perf_counter()
                rejected = copies.agg(F.count_if(F.coalesce(condition, F.lit(False)))).first()[0]
                took.append(time.perf_counter() - began)
            return min(took), rejected

        bare, _ = run(F.length(text) < 0)
        found = {name: run(condition) for name, condition in rules.items()}
        step = lambda took: 4.0 ** round(math.log(max(took - bare, 1e-3), 4))
        return {name: (step(took), rejected / (size * COPIES)) for name, (took, rejected) in found.items()}
    finally:
        sample.unpersist()


def ordered(measured: dict[str, tuple[float, float]]) -> list[str]:
    """Most rejections per cost first; of equal ones the cheaper, then by name."""
    return sorted(measured, key=lambda r: (-measured[r][1] / measured[r][0], measured[r][0], r))


@shielded()
def cascade(docs: DataFrame, rules: dict[str, Column] | None = None, text: str = "text") -> DataFrame:
    """docs with the statistics, the name of the first rule that rejects (in the measured order; null where kept) and kept."""
    rules = rules or default_rules(text)
    order = ordered(measure(docs, rules, text=text))
    first = F.lit(None).cast("string")
    for name in reversed(order):
        first = F.when(F.coalesce(rules[name], F.lit(False)), F.lit(name)).otherwise(first)
    return statistics(docs, text).withColumn("rejected_by", first).withColumn("kept", F.col("rejected_by").isNull()).drop("_lines")
