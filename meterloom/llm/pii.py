"""Personal data replaced by format-preserving pseudonyms, of DataFrame expressions only.

Candidates are found by pattern and validated: card numbers by their check digit, account numbers (IBAN) modulo 97, addresses by
their octets, social security numbers by their ranges, dates by the calendar, telephone numbers by their form. What is valid goes
through a keyed Feistel network over its own format, so the result is valid too, distinct values stay distinct, and equal values
get equal pseudonyms in every document. Secrets of hexadecimal digits are permuted the same way. E-mail addresses, which have no
fixed format, become keyed digests. Candidates that aren't valid stay as they are.

A text without any of these comes back unchanged; null stays null, empty stays empty. Texts are taken whole, however long. A document is
one row from end to end: nothing is shuffled, rows that repeat give equal rows, and an empty table gives an empty one. Where two
patterns fit at a place, the first of PATTERNS counts. Columns beside the text go along, whatever their names. Keys are a parameter; whoever has the key can link values, so a real one belongs in a secret store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shielded
from .quality_rules import let

KEY = "demonstration key"
ROUNDS = 8
_DIGITS, _HEX, _LETTERS = "0123456789", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Kind -> pattern of its candidates, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}",
    "secret": r"(?<![0-9a-zA-Z])[0-9a-f]{32,128}(?![0-9a-zA-Z])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "date": r"(?<![\p{L}\p{N}./\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![\p{L}\p{N}/\-]|\.[0-9])",
    "ip": r"(?<![\p{L}\p{N}.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\p{L}\p{N}]|\.[0-9])",
    "ssn": r"(?<![\p{L}\p{N}\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}\-])",
    "card": r"(?<![\p{L}\p{N}])(?:[0-9]{4}([ \-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5}|[0-9]{13,19})(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)[ .\-]?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}+])\+[0-9]{1,3}[ .\-]?[0-9]{2,4}(?:[ .\-]?[0-9]{2,4}){2,4}(?![\p{L}\p{N}])",
}
#: A text without a match of this has no candidate; it spares most texts the patterns. Without two digits in a row, an address of four
#: single ones is the only candidate of digits.
_ANY = r"[0-9]{2}|@|[0-9a-f]{32}|[0-9]\.[0-9]\.[0-9]\.[0-9]"


def _numbers(s: Column, alphabet: str) -> Column:
    return F.transform(F.split(s, r"(?!^)(?!\z)"), lambda c: F.instr(F.lit(alphabet), c) - 1)


def _joined(values: Column, alphabet: str) -> Column:
    return F.array_join(F.transform(values, lambda v: F.substring(F.lit(alphabet), v + 1, F.lit(1))), "")


def feistel(values: Column, radix: Column | int, key: str, tweak: str) -> Column:
    """Keyed permutation of arrays of 2 to 128 integers below radix; the length stays. Even rounds add a digest of the right half to
    the left one, odd rounds the reverse, position by position modulo radix."""
    radix = F.lit(radix) if isinstance(radix, int) else radix

    def round_(state: Column, i: Column) -> Column:
        left, right = state["a"], state["b"]
        even = i % 2 == 0
        mover, other = F.when(even, left).otherwise(right), F.when(even, right).otherwise(left)
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), i.cast("string"), F.size(mover).cast("string"), F.array_join(F.transform(other, lambda x: x.cast("string")), ",")).cast("binary"), 512)

        def add(moved: Column) -> Column:
            return F.struct(F.when(even, moved).otherwise(left).alias("a"), F.when(even, right).otherwise(moved).alias("b"))

        return let(digest, lambda d: add(F.transform(mover, lambda x, j: ((x + F.conv(F.substring(d, j % 32 * 4 + 1, F.lit(4)), 16, 10).cast("int")) % radix).cast("int"))))

    def run(v: Column) -> Column:
        half = F.floor(F.size(v) / 2).cast("int")
        start = F.struct(F.slice(v, F.lit(1), half).alias("a"), F.slice(v, half + 1, F.size(v) - half).alias("b"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, round_, lambda s: F.concat(s["a"], s["b"]))

    return let(F.transform(values, lambda x: x.cast("int")), run)


def feistel_pair(a: Column, b: Column, size_a: int, size_b: int, key: str, tweak: str) -> Column:
    """Keyed permutation of pairs (a below size_a, b below size_b), as struct<a, b>."""

    def round_(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        digest = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), i.cast("string"), F.when(even, state["b"]).otherwise(state["a"]).cast("string")).cast("binary"), 256), 1, 14), 16, 10).cast("long")
        return let(digest, lambda d: F.struct(F.when(even, F.pmod(state["a"] + d, F.lit(size_a))).otherwise(state["a"]).cast("long").alias("a"), F.when(even, state["b"]).otherwise(F.pmod(state["b"] + d, F.lit(size_b))).cast("long").alias("b")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), round_)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn_sum(digits: Column, check: bool) -> Column:
    """Sum of the check-digit rule over digits that end in the check digit, or that still lack it."""
    from_right = F.reverse(_numbers(digits, _DIGITS))

    def of(x: Column, j: Column) -> Column:
        twice = x * 2
        return F.when(j % 2 == (1 if check else 0), F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(x)

    return F.aggregate(F.transform(from_right, of), F.lit(0), lambda s, x: s + x)


def _refill(form: Column, new: Column, kind: str = "[0-9]") -> Column:
    """form with its characters of the kind replaced by those of new, in order."""
    chars = F.split(form, r"(?!^)(?!\z)")

    def at(c: Column, j: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(form, F.lit(1), j + 1), f"[^{kind[1:-1]}]", ""))
        return F.when(c.rlike(kind), F.substring(new, before, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(chars, at), "")


def card(x: Column, key: str) -> Column:
    def of(d: Column) -> Column:
        body = _joined(feistel(_numbers(F.substring(d, F.lit(1), F.length(d) - 1), _DIGITS), 10, key, "card"), _DIGITS)
        full = let(body, lambda y: F.concat(y, ((10 - _luhn_sum(y, False) % 10) % 10).cast("string")))
        return F.when(_luhn_sum(d, True) % 10 == 0, let(full, lambda f: _refill(x, f))).otherwise(x)

    return let(_digits(x), of)


def phone(x: Column, key: str) -> Column:
    """The country code stays; the other digits are permuted."""
    code = F.regexp_extract(x, r"^(\+[0-9]{1,3}(?=[ .\-(])|\+[0-9])", 1)

    def of(c: Column) -> Column:
        rest = F.substring(x, F.length(c) + 1, F.length(x))
        return F.concat(c, let(rest, lambda r: let(_joined(feistel(_numbers(_digits(r), _DIGITS), 10, key, "phone"), _DIGITS), lambda d: _refill(r, d))))

    return let(code, of)


def ip(x: Column, key: str) -> Column:
    parts = F.transform(F.split(x, r"\."), lambda p: p.cast("int"))
    return let(parts, lambda p: F.when(F.forall(p, lambda v: v < 256), F.array_join(F.transform(feistel(p, 256, key, "ip"), lambda v: v.cast("string")), ".")).otherwise(x))


def ssn(x: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.substring(x, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)

    def back(s: Column) -> Column:
        a = s["a"] + F.when(s["a"] + 1 >= 666, F.lit(2)).otherwise(F.lit(1))
        return F.concat(F.lpad(a.cast("string"), 3, "0"), F.lit("-"), F.lpad((F.floor(s["b"] / 9999) + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((s["b"] % 9999 + 1).cast("string"), 4, "0"))

    got = feistel_pair(area - F.when(area > 666, F.lit(2)).otherwise(F.lit(1)), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn")
    return F.when(valid, let(got, back)).otherwise(x)


#: Days before year 200, of 400 years, and of 24 times 400 years: so many 400-year cycles there are from year 200 to 9799.
_HEAD, _CYCLE, _CYCLES = 72_683, 146_097, 24 * 146_097
#: A date's beginning, and how the date is read and written.
DATE_FORMS = ((r"^[0-9]{4}-", "yyyy-MM-dd"), (r"^[0-9]{2}/", "dd/MM/yyyy"), (r"^[0-9]{2}/", "MM/dd/yyyy"), (r"^[0-9]{2}\.", "dd.MM.yyyy"))


def date(x: Column, key: str) -> Column:
    """Dates of the years 1 to 9999. Each stays in its cycle of 400 years (1800 to 2199, and so on), of 189 * 773 days; those before year 200
    and after 9799 are one set of 93 * 1567 days. Day before month where that is a date, else month before day."""
    first = F.lit("0001-01-01").cast("date")

    def new_day(m: Column) -> Column:
        n, end = (m - _HEAD) % _CYCLE, F.when(m < _HEAD, m).otherwise(m - _CYCLES)
        inside = m.between(_HEAD, _HEAD + _CYCLES - 1)
        among = let(feistel_pair(F.floor(n / 773), n % 773, 189, 773, key, "date"), lambda s: m - n + s["a"] * 773 + s["b"])
        at_ends = let(feistel_pair(F.floor(end / 1567), end % 1567, 93, 1567, key, "far date"), lambda s: s["a"] * 1567 + s["b"])
        return F.when(inside, among).otherwise(let(at_ends, lambda i: F.when(i < _HEAD, i).otherwise(i + _CYCLES)))

    def of(days: Column) -> Column:
        which = F.array_position(F.transform(days, lambda v: v.isNotNull()), True)
        written = lambda d: F.coalesce(*[F.when(which == i, F.date_format(d, kind)) for i, (_, kind) in enumerate(DATE_FORMS, 1)])
        return F.when(which == 0, x).otherwise(let(F.get(days, (which - 1).cast("int")), lambda m: let(F.date_add(first, new_day(m).cast("int")), written)))

    return let(F.array(*[F.when(x.rlike(p), F.datediff(F.try_to_timestamp(x, F.lit(kind)).cast("date"), first)) for p, kind in DATE_FORMS]), of)


def _mod97(s: Column) -> Column:
    value = F.instr(F.lit(_DIGITS + _LETTERS), F.lit("")) * 0

    def step(acc: Column, c: Column) -> Column:
        v = F.instr(F.lit(_DIGITS + _LETTERS), c) - 1
        return (F.when(v > 9, acc * 100 + v).otherwise(acc * 10 + v) % 97).cast("int")

    return F.aggregate(F.split(s, r"(?!^)(?!\z)"), value.cast("int"), step)


def iban(x: Column, key: str) -> Column:
    """The country stays, and so do the account's letters; its digits are permuted (its letters, where it has hardly a digit) and the
    check digits made anew."""

    def of(s: Column) -> Column:
        country, account = F.substring(s, 1, 2), F.substring(s, F.lit(5), F.length(s))
        valid = _mod97(F.concat(account, country, F.substring(s, 3, 2))) == 1

        def made(a: Column) -> Column:
            check = F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0")
            return let(F.concat(country, check, a), lambda full: _refill(x, full, "[0-9A-Z]"))

        permuted = let(_digits(account), lambda d: F.when(F.length(d) < 2, let(F.regexp_replace(account, "[^A-Z]", ""), lambda l: _refill(account, _joined(feistel(_numbers(l, _LETTERS), 26, key, "iban"), _LETTERS), "[A-Z]"))).otherwise(_refill(account, _joined(feistel(_numbers(d, _DIGITS), 10, key, "iban"), _DIGITS))))
        return F.when(valid, let(permuted, made)).otherwise(x)

    return let(F.replace(x, F.lit(" "), F.lit("")), of)


def email(x: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(x)).cast("binary"), 256), 1, 16), F.lit("@pseudonym.invalid"))


def secret(x: Column, key: str) -> Column:
    """At least one digit and one letter: a long run of digits or of letters is no secret."""
    mixed = x.rlike("[0-9]") & x.rlike("[a-f]")
    return F.when(mixed, _joined(feistel(_numbers(x, _HEX), 16, key, "secret"), _HEX)).otherwise(x)


def pseudonym(x: Column, key: str = KEY) -> Column:
    """The pseudonym of one candidate, or the candidate itself where it isn't valid."""
    whole = lambda k: x.rlike(f"^(?:{PATTERNS[k]})$")
    makers = {"email": email, "secret": secret, "iban": iban, "date": date, "ip": ip, "ssn": ssn, "card": card, "phone": phone}
    out = F.when(F.lit(False), x)
    for kind in PATTERNS:
        out = out.when(whole(kind), makers[kind](x, key))
    return out.otherwise(x)


@shielded()
def pseudonymised(docs: DataFrame, text: str = "text", key: str = KEY, counts: bool = True) -> DataFrame:
    """docs with text made anew and, on request, n_pseudonyms: how many values were replaced."""
    pattern = "|".join(p.replace(r"\1", r"\k<sep>").replace(r"([ \-])", r"(?<sep>[ \-])") for p in PATTERNS.values())
    t = F.col(text)
    found = F.when(t.rlike(_ANY), F.regexp_extract_all(t, F.lit(f"({pattern})"), F.lit(1)))
    # one place for the values and one for the text between them; the pattern runs again only where it has matched
    rows = docs.withColumn("_found", found)
    some = F.size(F.coalesce(F.col("_found"), F.array().cast("array<string>"))) > 0
    rows = rows.withColumn("_new", F.when(some, F.transform("_found", lambda x: pseudonym(x, key))))
    between = F.split(t, pattern, -1)
    merged = let(between, lambda parts: F.concat(parts[0], F.array_join(F.transform(F.col("_new"), lambda x, i: F.concat(x, F.get(parts, i + 1))), "")))
    rows = rows.withColumn(text, F.when(some, merged).otherwise(t))
    if counts:
        changed = F.size(F.filter(F.arrays_zip("_found", "_new"), lambda z: z["_found"] != z["_new"]))
        rows = rows.withColumn("n_pseudonyms", F.when(some, changed).otherwise(0))
    return rows.drop("_found", "_new")
