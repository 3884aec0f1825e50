"""Operators that work on each text by itself."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_entry import TABLES, plain
from tokenizers import Tokenizer

from meterloom.llm import bpe, common, langid, length_buckets, order_minhash, pii, quality_rules, queries, url_templates, weak_labels

SF = f"{TESTDATA}/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside or add, as columns of a table.
CLASHES = ("kept", "spans", "n", "class", "d", "id", "_found", "verdict", "host", "abuse", "piece")
LONG = "Der lange Text geht weiter. " * 20_000
EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "Equal text here."), (6, "Equal text here."), (6, "Equal text here."), (7, "x" * 5000), (None, "no id"), (8, LONG), (9, "½ ﬁ İ Σ ΟΔΟΣ 日本 🙂")]


def docs(spark, rows=EDGES, clashes=False):
    df = spark.createDataFrame([(i, t, "en" if i != 4 else None, "s", None) for i, t in rows], DOCS)
    return df.withColumns({c: F.lit("x") for c in CLASHES}) if clashes else df


def empty(spark):
    return spark.createDataFrame([], DOCS)


# -- 1: encoding -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.vocabulary_path())


@pytest.fixture(scope="module")
def vocabulary():
    with open(queries.vocabulary_path(), encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def encoder(vocabulary):
    words = [w.encode() for w in ("the", "them", "theme", "then", "queen", "ing", "ings", "été")]
    return bpe.Encoder(vocabulary, bpe.Lexicon.mapped(bpe.compile_lexicon(dict(zip(words, vocabulary.merge_many(words), strict=True)))))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("aeinrst 'dmlv<|>endoftx\t\x1c\x85", max_size=60)), max_size=6))
def test_encoding_equals_the_library(encoder, library, texts):
    assert encoder.encode(texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("text", ["<|endoftext|>a<|startoftext|>", "don't I'LL we've", "ab" * 3000, "aaaaaaa", "ΟΔΟΣ Σ", "a\x1cb", "é e\u0301", "  "])
def test_encoding_of_odd_texts(encoder, library, vocabulary, text):
    ids = encoder.encode([text])[0]
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact(vocabulary):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(1, 6))) + rng.choice(["ing", "ed", ""]) for _ in range(200)})
    raw = [w.encode() for w in words]
    lexicon = bpe.Lexicon(bpe.compile_lexicon(dict(zip(raw, vocabulary.merge_many(raw), strict=True))))
    assert [lexicon.ids_at(i) for i in lexicon.indices(raw)] == vocabulary.merge_many(raw)
    assert (lexicon.indices([w + b"q" for w in raw] + [b"", b"zz"]) == -1).all()
    # states of a minimal automaton: as many as there are different sets of endings
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert lexicon.states == len(endings)
    assert bpe.Lexicon(bpe.compile_lexicon({})).indices([b"a"]).tolist() == [-1]


def test_op1(spark, library):
    rows = {}
    for r in bpe.encode_decode(docs(spark, clashes=True), queries.vocabulary_path(), keep_ids=True).collect():
        rows.setdefault(r.doc_id, []).append(r)
    for i, text in EDGES:
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = rows[i][0]
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, decoded)
        assert (r.ids_sha256, r.decoded_sha256) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))
    assert len(rows[6]) == 2 and bpe.encode_decode(empty(spark), queries.vocabulary_path()).count() == 0


# -- 2: language -------------------------------------------------------------------------------------------------------


def test_op2(spark):
    got = queries.op2_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.9 * len(held) and all(0 <= r.score <= 1 for r in got)
    rows = {r.doc_id: r for r in langid.identify(docs(spark, clashes=True)).collect()}
    assert len(rows) == 10 and {rows[i].lang_pred for i in (1, 2, 3)} == {"und"} and rows[1].score == 0 and rows[1].rejected
    assert rows[7].lang_pred == "en"  # the one language there is
    assert langid.identify(empty(spark)).count() == 0
    unlabelled = langid.identify(docs(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_learning_leaves_out_the_held_out(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.lit("en").alias("lang"))
    import zlib

    assert langid.sampled(df).count() == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(200))
    assert langid.sampled(df, 20).count() <= 20


def test_prediction_doesnt_depend_on_neighbours():
    model = langid.Model(["a", "b"], np.random.default_rng(1).normal(size=(langid.BUCKETS, 2)).astype(np.float32), np.zeros(2))
    alone = model.logits(["hello there"])[0]
    assert (model.logits(["hello there", "other", "", "1"])[0][0] == alone[0]).all()


# -- 3: personal data --------------------------------------------------------------------------------------------------


def replaced(spark, text, **more):
    return pii.pseudonymised(docs(spark, [(1, text)]), **more).first()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def test_feistel_is_a_permutation(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("x"))
    two = df.select(pii._joined(pii.feistel(pii._numbers(F.col("x"), "0123456789"), 10, "k", "t"), "0123456789").alias("y"))
    assert {r.y for r in two.collect()} == {f"{i:03d}" for i in range(1000)}
    pairs = spark.range(63).select(pii.feistel_pair(F.floor(F.col("id") / 9), F.col("id") % 9, 7, 9, "k", "t").alias("p"))
    assert {(r.p.a, r.p.b) for r in pairs.collect()} == {(a, b) for a in range(7) for b in range(9)}


def test_formats_stay(spark):
    card = replaced(spark, "pay 4111 1111 1111 1111 now").text
    digits = re.fullmatch(r"pay (\d{4} \d{4} \d{4} \d{4}) now", card)[1].replace(" ", "")
    assert luhn(digits) and digits != "4111111111111111"
    amex = replaced(spark, "3782 822463 10005").text
    assert re.fullmatch(r"\d{4} \d{6} \d{5}", amex) and luhn(re.sub(r"\D", "", amex))
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", replaced(spark, "+1 (017) 555-7713").text)
    assert all(int(x) < 256 for x in replaced(spark, "10.20.30.255").text.split("."))
    assert re.fullmatch(r"(?!000|666)[0-8]\d\d-(?!00)\d\d-(?!0000)\d{4}", replaced(spark, "078-05-1120").text)
    iban = replaced(spark, "DE89 3704 0044 0532 0130 00").text
    plain_ = iban.replace(" ", "")
    assert re.fullmatch(r"DE\d\d( \d{4}){4} \d\d", iban) and int("".join(str(int(c, 36)) for c in plain_[4:] + plain_[:4])) % 97 == 1
    import datetime

    datetime.date.fromisoformat(replaced(spark, "born 2024-02-29.").text[5:-1])
    datetime.datetime.strptime(replaced(spark, "31/12/1999").text, "%d/%m/%Y")
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', replaced(spark, 'token = "' + "a1" * 20 + '"').text)
    assert re.fullmatch(r"u[0-9a-f]{16}@pseudonym\.invalid", replaced(spark, "éau.55@mail3.example.com").text)


@pytest.mark.parametrize("text", ["4111111111111112", "256.1.1.1", "666-12-1234", "000-12-1234", "2023-02-29", "DE00 3704 0044 0532 0130 00", "version 1.2.3.4.5", "no data at all", "a@b", "1234", "ab12cd", "", "f" * 40])
def test_what_isnt_valid_stays(spark, text):
    r = replaced(spark, text)
    assert (r.text, r.n_pseudonyms) == (text, 0)


ALONE = ["a@b.co", "a1" * 16, "ab" * 15 + "a1", "DE89 3704 0044 0532 0130 00", "2024-02-29", "31/12/1999", "01.02.2003", "8.8.8.8", "1.1.1.1", "1.2.3.4", "10.0.0.1", "078-05-1120", "4111111111111111", "(017) 555-7713", "+1 22 33 44"]


def test_a_value_alone_is_found(spark):
    """Also where nothing else of the text looks like personal data; the value gets the pseudonym that it has in any other text."""
    rows = [(2 * i + j, text) for i, x in enumerate(ALONE) for j, text in enumerate((f"see {x} there", f"see {x} there and 1234567 or so"))]
    out = {r.doc_id: r for r in pii.pseudonymised(docs(spark, rows)).collect()}
    for i, x in enumerate(ALONE):
        one, two = out[2 * i], out[2 * i + 1]
        assert (one.n_pseudonyms, two.n_pseudonyms) == (1, 1) and x not in one.text
        assert two.text == one.text + " and 1234567 or so"


def test_the_prefilter_covers_the_patterns(spark):
    """Random strings of the characters that candidates are made of."""
    rng = random.Random(3)
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(5, 12))) for a in ("12..", "1.+ -", "a@.b", "1-.") for _ in range(5000)]
    pattern = "|".join(p.replace(r"\1", r"\k<sep>").replace(r"([ \-])", r"(?<sep>[ \-])") for p in pii.PATTERNS.values())
    t = F.col("text")
    hit = docs(spark, list(enumerate(texts))).filter(t.rlike(pattern))
    assert hit.filter(~t.rlike(pii._ANY)).isEmpty() and not hit.isEmpty()


def plain_feistel(values, radix, key, tweak):
    """The network by its definition, without Spark."""
    half = len(values) // 2
    a, b = values[:half], values[half:]
    for i in range(pii.ROUNDS):
        mover, other = (a, b) if i % 2 == 0 else (b, a)
        d = hashlib.sha512("|".join([key, tweak, str(i), str(len(mover)), ",".join(map(str, other))]).encode()).hexdigest()
        moved = [(x + int(d[j % 32 * 4 : j % 32 * 4 + 4], 16)) % radix for j, x in enumerate(mover)]
        a, b = (moved, b) if i % 2 == 0 else (a, moved)
    return a + b


def plain_pair(a, b, size_a, size_b, key, tweak):
    for i in range(pii.ROUNDS):
        d = int(hashlib.sha256("|".join([key, tweak, str(i), str(b if i % 2 == 0 else a)]).encode()).hexdigest()[:14], 16)
        a, b = ((a + d) % size_a, b) if i % 2 == 0 else (a, (b + d) % size_b)
    return a, b


def plain_day(day, key):
    """A day's number, counted from the first of year 1, after the permutation of its cycle."""
    import datetime

    begin = [datetime.date(y, 1, 1).toordinal() - 1 for y in range(200, 9801, 400)]
    for first, end in zip(begin, begin[1:], strict=False):
        if first <= day < end:
            a, b = plain_pair((day - first) // 773, (day - first) % 773, 189, 773, key, "date")
            return first + a * 773 + b
    at = day if day < begin[0] else day - begin[-1] + begin[0]
    a, b = plain_pair(at // 1567, at % 1567, 93, 1567, key, "far date")
    new = a * 1567 + b
    return new if new < begin[0] else new - begin[0] + begin[-1]


def test_pseudonyms_by_brute_force(spark):
    """Cards, addresses, numbers, secrets and dates of any year, as another program computes them."""
    import datetime

    key, rng, want = "k1", random.Random(4), {}
    for _ in range(12):
        body = [rng.randrange(10) for _ in range(15)]
        check = next(c for c in range(10) if luhn("".join(map(str, body)) + str(c)))
        new = plain_feistel(body, 10, key, "card")
        want["".join(map(str, [*body, check]))] = "".join(map(str, new)) + str(next(c for c in range(10) if luhn("".join(map(str, new)) + str(c))))
        octets = [rng.randrange(256) for _ in range(4)]
        want[".".join(map(str, octets))] = ".".join(map(str, plain_feistel(octets, 256, key, "ip")))
        area, group, serial = rng.choice([1, 665, 667, 899]), rng.randrange(1, 100), rng.randrange(1, 10000)
        a, b = plain_pair(area - (2 if area > 666 else 1), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn")
        want[f"{area:03d}-{group:02d}-{serial:04d}"] = f"{a + (2 if a + 1 >= 666 else 1):03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"
        nibbles = [10, 1, *(rng.randrange(16) for _ in range(38))]
        want["".join(f"{x:x}" for x in nibbles)] = "".join(f"{x:x}" for x in plain_feistel(nibbles, 16, key, "secret"))
    days = [0, 72_682, 72_683, 3_652_058, *(rng.randrange(3_652_059) for _ in range(40))]
    for day in days:
        new = datetime.date.fromordinal(plain_day(day, key) + 1)
        want[datetime.date.fromordinal(day + 1).isoformat()] = new.isoformat()
        old = datetime.date.fromordinal(day + 1)
        want[f"{old.day:02d}.{old.month:02d}.{old.year:04d}"] = f"{new.day:02d}.{new.month:02d}.{new.year:04d}"
    rows = list(enumerate(want))
    got = {r.doc_id: r.text for r in pii.pseudonymised(docs(spark, rows), key=key).collect()}
    assert {x: got[i] for i, x in rows} == want
    assert len({plain_day(day, key) for day in range(72_000, 74_000)}) == 2000


def test_equal_values_stay_linked(spark):
    text = "a 10.20.30.40 b 10.20.30.40 c 10.20.30.41"
    one, two = replaced(spark, text).text.split(), replaced(spark, text).text.split()
    assert one == two and one[1] == one[3] != one[5]
    assert replaced(spark, text, key="other").text.split() != one


def test_op3_edges(spark):
    out = pii.pseudonymised(docs(spark, clashes=True))
    assert sorted(out.columns) == sorted([*DOCS.replace(" long", "").replace(" string", "").split(", "), *CLASHES, "n_pseudonyms"])
    assert sorted((r.doc_id or 0, r.text) for r in out.collect() if r.text) == sorted((i or 0, t) for i, t in EDGES if t)
    assert pii.pseudonymised(empty(spark)).count() == 0
    plan = queries.op3_pii_feistel(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_op3_leaves_nothing(spark):
    """Every valid value of the table is gone, and other texts are as they were."""
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    after = {r.doc_id: r for r in queries.op3_pii_feistel(spark, SF).collect()}
    for i, text in before.items():
        values = re.findall(r"[\w.]+@[\w.]+\w|\+1 \(\d+\) \d{3}-\d{4}|(?<![\d.])\d+(?:\.\d+){3}(?![\d.])|\b[0-9a-f]{40}\b", text) + [x for x in re.findall(r"\b\d{16}\b", text) if luhn(x)]
        assert not [v for v in values if v in after[i].text] and after[i].n_pseudonyms == len(values)
        if not values:
            assert after[i].text == text


# -- 4: urls -----------------------------------------------------------------------------------------------------------

URLS = [
    ("http://www.example.com/en/1?q#f", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://Blog.EXAMPLE.com/en/2", "blog.example.com", "/en/2", "example.com/en/", "block"),
    ("http://example.com/fr/2", "example.com", "/fr/2", "com/", "allow"),
    ("http://notexample.com/en/2", "notexample.com", "/en/2", "com/", "allow"),
    ("http://a.net/es/", "a.net", "/es/", "net/es/", "block"),
    ("http://com", "com", "", None, None),
    ("//x/y", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
    ("ftp://É.com?x=/a", "É.com", "", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
    ("http://x.org#a/b", "x.org", "", None, None),
]


def test_op4(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] + [(0, URLS[0][0])], "page_id long, url string").withColumns({c: F.lit("x") for c in CLASHES})
    rows = {r.page_id: r for r in url_templates.judged(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule) and rows[i].verdict == (verdict or "allow")
    assert url_templates.judged(pages.limit(0)).count() == 0 and url_templates.judged(pages).count() == len(URLS) + 1


def test_templates_learn_from_labels(spark):
    """A host's blocked templates pass on to like ones elsewhere; many literal segments become a wildcard."""
    rows = [(i, f"http://h{i % 3}.net/es/{i}") for i in range(60)] + [(100, "http://other.org/es/7"), (101, "http://other.org/de/7")]
    rows += [(200 + i, f"http://shop.com/item/name-{chr(97 + i % 26)}{'x' * (i // 26)}") for i in range(60)]
    out = {r.page_id: r for r in url_templates.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert out[100].verdict == "block" and out[101].verdict == "allow" and out[100].template == "/es/{n}"
    assert out[200].template == "/item/{*}" and out[200].verdict == "allow"
    again = {r.page_id: r.verdict for r in url_templates.judged(spark.createDataFrame(rows, "page_id long, url string").repartition(7)).collect()}
    assert again == {i: r.verdict for i, r in out.items()}


def deep_pages(seed=1):
    """Hosts with paths of up to five segments, of which rules block some."""
    rng = random.Random(seed)
    out = []
    for i in range(12000):
        lang = rng.choice(["es", "fr", "en", "it"])
        site = rng.choice(["a.net", "b.net", "c.org", "d.org", "e.com"])
        tail = rng.choice([f"2024/{rng.randrange(1, 13)}/title-{''.join(rng.choice('abcdefghij') for _ in range(4))}", f"list/{rng.randrange(9)}", f"about/{rng.choice(['us', 'them'])}", f"x/y/{rng.choice('pqrs')}/end", ""])
        out.append((i, f"https://{site}/{lang}/{tail}"))
    return out


def test_op4_on_deep_paths(spark):
    """Titles below dates become wildcards, unlabelled hosts learn from the like, and the SQL agrees."""
    import duckdb

    pages = spark.createDataFrame(deep_pages(), "page_id long, url string")
    got = url_templates.judged(pages).select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 6).alias("purity")).collect()
    con = duckdb.connect()
    frame = pages.toPandas()
    con.register("pages", frame)
    want = con.sql(queries.ORACLE_SQL["op4_url_templates"])
    assert want.columns == ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want.fetchall()))
    dated = [r for r in got if r.host == "c.org" and "/2024/" in r.path]
    assert dated and all(r.template.startswith(f"/{r.path[1:3]}/{{n}}/{{n}}/") and r.template.endswith("{*}") for r in dated)
    assert {r.verdict for r in dated if r.path.startswith("/es")} == {"block"} and {r.verdict for r in dated if r.path.startswith("/it")} == {"allow"}


def test_op4_is_native(spark):
    got = queries.op4_url_templates(spark, SF)
    assert got.count() == 50 and not re.search("Python|Arrow", got._jdf.queryExecution().executedPlan().toString())


# -- 5: fingerprints ---------------------------------------------------------------------------------------------------


def brute_order_minhash(text, k=order_minhash.K, m=order_minhash.SKETCHES):
    """Occurrence-numbered k-mers, the two of least hash, in text order, one at a time."""
    if not text:
        return [0] * m
    mask = (1 << 64) - 1

    def mix(h):
        h ^= h >> 33
        h = h * 0xFF51AFD7ED558CCD & mask
        h ^= h >> 33
        h = h * 0xC4CEB9FE1A85EC53 & mask
        return h ^ h >> 33

    k = min(k, len(text))
    hashes, seen, numbered = [], Counter(), []
    for i in range(len(text) - k + 1):
        h = k
        for j in range(k):
            h = (h * (0x100000001B3 + 2 * j) + ord(text[i + j])) & mask
        hashes.append(mix(h))
        seen[hashes[-1] >> 24] += 1
        numbered.append(mix(hashes[-1] + (seen[hashes[-1] >> 24] - 1) * 0xD1B54A32D192ED03 & mask))
    out = []
    for s in range(m):
        a = mix((s + 1) * 0x9E3779B97F4A7C15 & mask) | 1
        best = sorted(range(len(numbered)), key=lambda i: (numbered[i] * a & mask, i))[:2]
        lo, hi = min(best), max(best)
        x = mix(((mix(hashes[lo] + a & mask)) * 0x9FB21C651E98DF25 + hashes[hi]) & mask)
        out.append((x - (1 << 64) if x >> 63 else x) or 1)
    return out


@pytest.mark.parametrize("text", ["", "a", "abcd", "abcde", "abcdef", "abab" * 30, "The quick brown fox. " * 3, "日本🙂" * 20])
def test_order_minhash_by_brute_force(text):
    assert order_minhash.fingerprint(text).tolist() == brute_order_minhash(text)


def test_order_minhash_of_a_long_text(monkeypatch):
    """The two ways to number occurrences agree: k-mers are told apart by the same bits."""
    text = "abcab" * 3000 + "".join(chr(97 + i % 23) for i in range(9000))
    h = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64))
    assert ((h & np.uint64(0xFFFFFFFFFF000000)) >> np.uint64(24) == h >> np.uint64(24)).all()
    assert order_minhash.fingerprint(text).tolist() == brute_order_minhash(text)


def test_order_matters():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(100)]
    text, turned, edited = " ".join(words), " ".join(words[50:] + words[:50]), " ".join([*words[:97], "x", *words[98:]])
    near = lambda x: order_minhash.likeness(order_minhash.fingerprint(text), order_minhash.fingerprint(x))
    assert near(text) == 1.0 and near(edited) > 0.7 > near(turned)


def test_op5(spark):
    got = order_minhash.against_edits(docs(spark, clashes=True)).collect()
    rows = sorted(((i is not None, i or 0, t is not None, t or ""), t or "") for i, t in EDGES)
    assert len(got) == len(EDGES)
    found = Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got)
    want = Counter()
    for j, (key, text) in enumerate(rows):
        after = rows[(j + 1) % len(rows)][1]
        n = len(text) // 4
        edit = text[: len(text) - n] + after[:n]
        f, e, x = (order_minhash.fingerprint(y) for y in (text, edit, after))
        want[(key[1] if key[0] else None, len(text), hashlib.sha256(edit.encode()).hexdigest(), order_minhash.shown(f), order_minhash.shown(e), order_minhash.likeness(f, e), order_minhash.likeness(f, x))] += 1
    assert found == want
    assert order_minhash.against_edits(empty(spark)).count() == 0
    one = order_minhash.against_edits(docs(spark, [(1, "abcdefgh")])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert order_minhash.fingerprints(docs(spark)).count() == len(EDGES)


# -- 6: rules ----------------------------------------------------------------------------------------------------------


def brute_statistics(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_op6(spark):
    texts = [t for _, t in EDGES] + ["a b c a b c d", "x x x x x", "l\nl\n\n l\nl", "#|a b<>", "\u00a0 b\u2003c", "a b c\nd a b c"]
    df = docs(spark, list(enumerate(texts)), clashes=True)
    for r in quality_rules.cascade(df).collect():
        text = texts[r.doc_id] or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_statistics(text)
        assert r.kept is False if r.n_words < 50 else True
    assert quality_rules.cascade(empty(spark)).count() == 0
    assert not re.search("Python|Arrow|Exchange", queries.op6_rule_cascade(spark, SF)._jdf.queryExecution().executedPlan().toString())


def test_costs(spark):
    """A rule's cost holds what it needs of the texts; the order is the same on each run."""
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(400))) for i in range(300)]
    df, rules = docs(spark, rows).select("doc_id", "text"), {k: v for k, v in quality_rules.default_rules().items() if k in ("too_short", "repeated_windows")}
    found = [quality_rules.measure(df, rules) for _ in range(2)]
    assert found[0]["repeated_windows"][0] >= found[0]["too_short"][0] and found[0]["too_short"][1] == 0.0
    assert quality_rules.ordered(found[0]) == quality_rules.ordered(found[1])


def test_cascade_order():
    assert quality_rules.ordered({"cheap": (0.1, 0.1), "dear": (1.0, 0.2), "never": (0.1, 0.0)}) == ["cheap", "dear", "never"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE_SQL[name])
    cols = sorted(df.columns)
    at = [want.columns.index(c) for c in cols]
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


# -- 7: packing --------------------------------------------------------------------------------------------------------


def brute_padding(histogram, buckets):
    from itertools import combinations

    lengths = sorted(histogram)
    best = None
    for k in range(min(buckets, len(lengths))):
        for inner in combinations(lengths[:-1], k):
            bounds = [*inner, lengths[-1]]
            pad = sum(n * (next(b for b in bounds if b >= x) - x) for x, n in histogram.items())
            best = pad if best is None else min(best, pad)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_bucket_lengths_are_optimal(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 40): rng.randint(1, 30) for _ in range(rng.randint(1, 9))}
    k = rng.randint(1, 4)
    chosen = length_buckets.optimal_lengths(histogram, k)
    assert len(chosen) <= k and sum(n * (next(b for b in chosen if b >= x) - x) for x, n in histogram.items()) == brute_padding(histogram, k)
    assert length_buckets.optimal_lengths({}) == []


def test_op7(spark):
    rows = EDGES + [(100 + i, "w " * (i % 60 + 1)) for i in range(400)]
    out = length_buckets.packed(docs(spark, rows, clashes=True), most=64, buckets=4, budget=256).collect()
    by_doc, batches = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        if r.bucket_len is not None:
            batches.setdefault(r.batch_id, []).append(r)
            assert r.n_tokens <= r.bucket_len
    for i, t in rows:
        n = len(re.findall("[^\x20\x09-\x0d]+", t or ""))
        copies = sum(j == i for j, _ in rows)
        assert sum(r.n_tokens for r in by_doc[i]) == n * copies
        if n == 0:
            assert by_doc[i][0].bucket_len is None and by_doc[i][0].batch_id is None
    partial = Counter()
    for batch in batches.values():
        most = 256 // batch[0].bucket_len
        assert len({r.bucket_len for r in batch}) == 1 and sorted(r.slot for r in batch) == list(range(len(batch))) and len(batch) <= most
        partial[batch[0].bucket_len] += len(batch) < most
    assert all(n <= 1 for n in partial.values())
    assert length_buckets.packed(empty(spark)).count() == 0


def test_op7_counts_tokens(spark, library):
    """As the library counts them, also where a task's kept numbers go and come again."""
    rows = [*EDGES, (50, "Ein anderes Wort, unpackably long words 12345! \u00e9\u4e2d\u6587")]
    got: dict = {}
    for r in length_buckets.packed(docs(spark, rows), most=16, vocabulary=queries.vocabulary_path()).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
    want: dict = {}
    for i, t in rows:
        want[i] = want.get(i, 0) + len(library.encode(t or "", add_special_tokens=False).ids)
    assert got == want
    with open(queries.vocabulary_path(), encoding="utf-8") as f:
        counter = bpe.TokenCounter(bpe.Vocabulary(f.read()), most=5)
    texts = [t or "" for _, t in rows] * 2
    counted = [int(n) for block in counter.counts(texts, most=20) for n in block]
    assert counted == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_op7_counting_holds_few_pieces():
    """Of texts of 600,000 words, which aren't held at once."""
    with open(queries.vocabulary_path(), encoding="utf-8") as f:
        counter = bpe.TokenCounter(bpe.Vocabulary(f.read()))
    texts = [" ".join(f"word{i % 50} {j}" for j in range(150)) for i in range(2000)]
    tracemalloc.start()
    counted = [n for x in counter.counts(texts) for n in x.tolist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(counted) == 2000 and counted[:50] == counted[50:100] and peak < 20e6
    # the same where few numbers are kept, for some time
    few = bpe.TokenCounter(counter.v, most=300)
    assert [n for x in few.counts(texts[:200], most=100) for n in x.tolist()] == counted[:200] and few.older


def test_tasks_hand_their_memory_back():
    """Also where what is left of it lies behind what went."""

    def held():
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(x.split()[1]) for x in f if x.startswith("Pss_Anon")) / 1024

    last = []

    def run(batches):
        parts = [np.ones(50_000, np.uint8) for _ in range(4000)]
        last.append(parts[-1])
        yield from batches

    before = held()
    assert list(common.frugal(run)(iter([1, 2]))) == [1, 2]
    assert held() - before < 60


# -- 8: weak labels ----------------------------------------------------------------------------------------------------


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(5)
    truth = rng.random(20000) < 0.4
    accuracy = np.array([0.95, 0.85, 0.7])
    votes = np.column_stack([np.where(rng.random(20000) < 0.8, np.where(rng.random(20000) < a, truth, ~truth), 2) for a in accuracy]).astype(int)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found, post = weak_labels.label_model(patterns, counts.astype(float))
    assert np.abs(found - accuracy).max() < 0.06
    best = {tuple(p): x > 0.5 for p, x in zip(patterns.tolist(), post, strict=True)}
    assert np.mean([best[tuple(v)] == t for v, t in zip(votes.tolist(), truth, strict=True)]) > 0.9


def test_votes_by_brute_force(spark):
    """Statistics, votes and scores of a few texts, recomputed plainly."""
    import pyarrow as pa

    texts = ["You stupid IDIOT, you trash.", "A calm line of plain words, nothing more to say here.", "###$$$ %% && #*#* <<>> ||", "one two three " * 30, "SHOUTING ALL THE TIME HERE", ""]
    (_, n, data, offsets), = common.slices(pa.array(texts))
    stats, runs, at = weak_labels.features(data, offsets)
    for t, row in zip(texts, stats, strict=True):
        w = t.split()
        letters = re.findall("[A-Za-z]", t)
        windows = Counter(tuple(x.lower() for x in w[i : i + 3]) for i in range(len(w) - 2))
        want = [len(w), sum(c in "#*$%&|<>" for c in t) / max(len(w), 1), sum(c.isupper() for c in letters) / max(len(letters), 1), 0, sum(x for x in windows.values() if x > 1) / max(len(w) - 2, 1), len({x.lower() for x in w}) / max(len(w), 1), sum(map(len, w)) / max(len(w), 1)]
        want += [sum(x.lower() in names for x in re.findall("[A-Za-z]+", t)) for names in weak_labels.INSULTS]
        assert row.tolist() == pytest.approx(want)
    none, unsure = np.full(n, np.nan), {x: np.zeros(n) for x in ("form", "abuse")}
    form, abuse = weak_labels.votes(stats, unsure | {"abuse": np.array([0.9] + [0.5] * (n - 1))}, none, none)
    assert abuse[0].tolist() == [1, 2, 1, 1, 2, 1, 2] and abuse[1].tolist() == [2, 2, 2, 2, 0, 2, 2] and (abuse[-1] == 2).all()
    assert form[2].tolist()[0] == 1 and form[3].tolist()[3:5] == [1, 1] and form[4].tolist()[1] == 1 and form[1].tolist() == [2, 2, 2, 2, 2, 2, 0, 2, 2]
    hashed = weak_labels.scorer_features(stats, runs, at)
    w = np.random.default_rng(2).normal(size=weak_labels.BUCKETS + 1)
    plain_scores = [1 / (1 + np.exp(-(sum(w[b] * x for b, x in zip(bs.tolist(), xs.tolist(), strict=True)) + w[-1]))) for bs, xs in hashed]
    assert weak_labels.scores(hashed, w).tolist() == pytest.approx(plain_scores, rel=1e-4)
    assert weak_labels.scores(hashed, None).tolist() == [0] * n


def test_labels_teach_a_labeller(spark):
    """Words that no list has, learned from the labels of half of the documents, reject the others that hold them."""
    rng = random.Random(3)
    word = lambda: f"w{rng.choice('abcdefghij')}{rng.choice('klmnopqrst')}{rng.choice('uvwxyz')}"
    bad = ["grumblewort", "snarkfink", "mudgeling"]
    rows = [(i, " ".join([word() for _ in range(60)] + (rng.sample(bad, 2) * 3 if i % 4 == 0 else []))) for i in range(800)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(800) if i % 8 < 5], "doc_id long, quality int, toxic int")
    df = docs(spark, rows)
    assert weak_labels.train(df, labels)["learned"].keys() == {"abuse"}  # of form there are no labels of both kinds
    kept = {r.doc_id: r.kept for r in weak_labels.classified(df, labels).collect()}
    others = [i for i in range(800) if i % 8 >= 5] + [i for i in range(800) if i % 8 == 4]
    assert sum(kept[i] for i in others if i % 4) >= 0.99 * sum(1 for i in others if i % 4)
    assert sum(not kept[i] for i in others if i % 4 == 0) >= 0.95 * sum(1 for i in others if i % 4 == 0)


def test_op8(spark):
    d = f"{TESTDATA}/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    insults = re.compile(r"\b(" + "|".join(w for x in weak_labels.INSULTS for w in x) + r")\b")
    rows = {r.doc_id: r for r in queries.op8_weak_label_quality(spark, d).collect()}
    assert len(rows) == len(texts)
    clean = [i for i, x in labels.items() if x.quality == 1 and not insults.search(texts[i])]
    assert sum(rows[i].kept for i in clean) >= 0.98 * len(clean)
    junk = [i for i, x in labels.items() if x.quality == 0 and len(texts[i].split()) > 30]
    assert sum(not rows[i].kept for i in junk) >= 0.95 * len(junk)
    toxic = [i for i, t in texts.items() if len(insults.findall(t)) > 2]
    assert toxic and sum(not rows[i].kept for i in toxic) >= 0.98 * len(toxic)


def test_op8_edges(spark):
    df = docs(spark, clashes=True)
    out = weak_labels.classified(df)
    assert {r.doc_id: r.kept for r in out.collect() if r.doc_id in (1, 2, 3)} == {1: True, 2: True, 3: True}
    assert weak_labels.accepted(df).columns == df.columns
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert weak_labels.classified(df, labels).count() == len(EDGES)
    assert weak_labels.classified(empty(spark), labels.limit(0)).count() == 0


def test_word_hashes_dont_depend_on_neighbours():
    import pyarrow as pa

    texts = ["The cat", None, "", " the  CAT\n", "cat"]
    first = {}
    for size in (1, 4, 1 << 20):
        got = []
        for _, n, data, offsets in common.slices(pa.array(texts), size):
            h, _, _, at = common.words_of(data, offsets)
            got += [h[at[i] : at[i + 1]].tolist() for i in range(n)]
        first.setdefault("x", got)
        assert got == first["x"] and got[0] == got[3] and got[0][1] == got[4][0] and got[1] == got[2] == []
