r"""PII pseudonyms by format-preserving Feistel networks.

Card numbers (Luhn), IBANs (mod 97), telephone numbers, social security numbers, IPv4, IPv6 and e-mail addresses,
calendar dates and secrets (a value with a digit after a word such as token or password) are found by one pattern and
validated. Each valid one is split into two numbers, which eight keyed Feistel rounds permute within the format: a card
number stays a valid one of its issuer, a date a date in its notation, a hexadecimal token one of its length. Long
values are permuted in pieces. The same value has the same pseudonym in every document, and the key's holder can restore
it (restore=True runs the rounds backwards). Everything is one projection over the documents; nothing is shuffled.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import LOWER, table, text_or_empty

ROUNDS = 8
#: The query's key is the session's configuration of this name; where that is unset, and the session is a local one, as in
#: tests, a fixed one. On a cluster an unset key is an error: with a known one anybody can undo the pseudonyms.
KEY_CONF, KEY = "spark.terraflux.pii.key", "terraflux-demo-key"

#: What stands before a secret.
_NAMED = r"(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key|private[_-]?key)[\"']?\s?[=:]\s?[\"']?"
#: Patterns by kind, in the order in which they are tried at each place. All repetitions are bounded, so that a search is linear.
PATTERNS = {
    "secret": rf"(?<![A-Za-z]){_NAMED}(?=[A-Za-z_+/=.-]{{0,64}}\d)[A-Za-z0-9_+/=.-]{{8,256}}",
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])",
    # what is written in one piece ends with it, whatever follows; only then are groups tried
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d\d(?:[A-Z0-9]{11,30}|(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "ipv6": r"(?<![\w:.])[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){2,7}(?![\w:.])",
    "iso_date": r"(?<![\d-])\d{4}-\d\d-\d\d(?![\d-])",
    "dmy_date": r"(?<![\d./])\d\d([./])\d\d\1\d{4}(?![\d/])",
    "ssn": r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])",
    "abroad": r"(?<![\d+(])\+(?!1[ .(-])[1-9]\d{0,2}(?:[ .-]?(?:\(\d{1,4}\)|\d{1,12})){1,8}(?!\d)",
    "phone": r"(?<![\d+(])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
    "card": r"(?<!\d)(?:\d{13,19}(?!\d)|\d{4}(?:[ -]\d{4}){3}(?![ -]?\d{1,3}(?!\d))(?!\d)|\d(?:[ -]?\d){12,18}(?![ -]?\d))",
}
KINDS = tuple(PATTERNS)
#: The date pattern refers to its own group, the only one.
FOUND = "|".join(PATTERNS.values())
#: First day of the permuted dates and their number, 400 * 365: 1800-01-01 to 2199-09-24.
FIRST_DAY, YEARS, DAYS = "1800-01-01", 400, 365


def _kind(m: Column) -> Column:
    """Patterns differ in their characters, so a shape tells which of them matched."""
    digits = F.length(F.regexp_replace(m, r"\D", ""))
    return (
        F.when(m.rlike(f"^{_NAMED}"), "secret").when(F.contains(m, F.lit("@")), "email").when(m.rlike("^[A-Z]{2}[0-9]{2}"), "iban").when(F.contains(m, F.lit(":")), "ipv6")
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip").when(m.rlike(r"^\d{4}-\d\d-\d\d$"), "iso_date").when(m.rlike(r"^\d\d[./]\d\d[./]\d{4}$"), "dmy_date")
        .when(m.rlike(r"^\d{3}-\d\d-\d{4}$"), "ssn").when(m.rlike(r"^\+(?!1[ .(-])"), "abroad").when(digits >= 13, "card").otherwise("phone")
    )


def _draw(key: str, kind: str | Column, n: Column, value: Column) -> Column:
    """The keyed round function: 60 bits."""
    seen = F.concat_ws("|", F.lit(key), F.lit(kind) if isinstance(kind, str) else kind, n.cast("string"), value.cast("string"))
    return F.conv(F.substr(F.sha2(seen, 256), F.lit(1), F.lit(15)), 16, 10).cast("long")


def _feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: str | Column, restore: bool) -> Column:
    """A keyed permutation of (left, right) in 0..a-1 and 0..b-1; restore undoes it."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    a, b = a.cast("long"), b.cast("long")
    sign = -1 if restore else 1

    def turn(s: Column, n: Column) -> Column:
        even = n % 2 == 0
        return F.struct(
            F.when(even, F.pmod(s["l"] + sign * F.pmod(_draw(key, kind, n, s["r"]), a), a)).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise(F.pmod(s["r"] + sign * F.pmod(_draw(key, kind, n, s["l"]), b), b)).alias("r"),
        )

    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if restore else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, turn)


def _then(value: Column, use) -> Column:  # noqa: ANN001
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _number(digits: Column, at: int | Column, n: int | Column) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, int) else x
    return F.substr(digits, lit(at), lit(n)).cast("long")


def _padded(value: Column, n: int | Column) -> Column:
    return F.lpad(value.cast("string"), F.lit(n) if isinstance(n, int) else n, F.lit("0"))


def _put(m: Column, new: Column, slot) -> Column:  # noqa: ANN001
    """m with its characters in slots replaced by those of new, in order and in their case; what stands between them stays."""
    start = F.struct(F.lit(1).alias("i"), F.lit("").alias("o"))

    def step(s: Column, c: Column) -> Column:
        drawn = F.substr(new, s["i"], F.lit(1))
        return F.struct((s["i"] + F.when(slot(c), 1).otherwise(0)).alias("i"), F.concat(s["o"], F.when(slot(c) & c.between("A", "Z"), F.upper(drawn)).when(slot(c), drawn).otherwise(c)).alias("o"))

    return F.aggregate(F.split(m, ""), start, step)["o"]


def _is_digit(c: Column) -> Column:
    return c.between("0", "9")


def _is_letter(c: Column) -> Column:
    return c.between("a", "z") | c.between("A", "Z")


def _refill(m: Column, digits: Column) -> Column:
    return _put(m, digits, _is_digit)


#: Digits of a half by base, so that it fits 63 bits.
HALF = {10: 9, 16: 14, 26: 12, 36: 11}


def _permuted(x: Column, base: int, kind: str, key: str, restore: bool) -> Column:
    """A string of digits of a base (10, 16, 36; 26: a to z) permuted in pieces of two halves each."""
    digits = "0123456789abcdefghijklmnop"
    to = lambda s: F.coalesce(F.conv(F.translate(s, LOWER, digits) if base == 26 else s, base, 10).cast("long"), F.lit(0))
    power = lambda n: F.conv(F.rpad(F.lit("1"), n + 1, F.lit("0")), base, 10).cast("long")

    def back(v: Column, n: Column) -> Column:
        text = F.when(n > 0, F.lpad(F.lower(F.conv(v.cast("string"), 10, base)), n, F.lit("0"))).otherwise("")
        return F.translate(text, digits, LOWER) if base == 26 else text

    def piece(part: Column, i: Column) -> Column:
        n = F.length(part)
        half = F.floor(n / 2).cast("int")
        pair = _feistel(to(F.substr(part, F.lit(1), half)), to(F.substr(part, half + 1)), power(half), power(n - half), key, F.concat(F.lit(kind), i.cast("string")), restore)
        return _then(pair, lambda p: F.concat(back(p["l"], half), back(p["r"], n - half)))

    n = F.length(x)
    k = F.ceil(n / (2 * HALF[base])).cast("int")
    at = lambda i: F.floor(i * n / k).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), k - 1), lambda i: _then(F.substr(x, at(i) + 1, at(i + 1) - at(i)), lambda part: piece(part, i)))
    return F.when(n > 0, F.array_join(pieces, "")).otherwise(x)


def _by_class(x: Column, kind: str, key: str, restore: bool) -> Column:
    """The letters and the digits of x permuted among themselves; capitals stay in their places, other characters too."""
    letters = _permuted(F.lower(F.regexp_replace(x, "[^A-Za-z]", "")), 26, f"{kind} letters", key, restore)
    digits = _permuted(F.regexp_replace(x, "[^0-9]", ""), 10, f"{kind} digits", key, restore)
    return _then(_then(letters, lambda new: _put(x, new, _is_letter)), lambda half: _then(digits, lambda new: _put(half, new, _is_digit)))


def _ten_to(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def _card(m: Column, key: str, restore: bool) -> Column:
    """The issuer's first digit stays; the last is the check digit of the others."""

    def of(d: Column) -> Column:
        n = F.length(d)
        half = F.floor((n - 2) / 2).cast("int")
        rest = n - 2 - half
        pair = _feistel(_number(d, 2, half), _number(d, half + 2, rest), _ten_to(half), _ten_to(rest), key, "card", restore)
        head = _then(pair, lambda p: F.concat(F.substr(d, F.lit(1), F.lit(1)), _padded(p["l"], half), _padded(p["r"], rest)))
        whole = _then(head, lambda h: F.concat(h, F.get(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: c.cast("string")), lambda c: F.call_function("luhn_check", F.concat(h, c))), F.lit(0))))
        return F.when(F.call_function("luhn_check", d), _refill(m, whole)).otherwise(m)

    return _then(_digits(m), of)


def _phone(m: Column, key: str, restore: bool) -> Column:
    """Any area and exchange; each keeps a first digit of 2 to 9, or of 0 or 1; a leading +1 stays."""

    def of(d: Column) -> Column:
        own = F.right(d, F.lit(10))
        # area (800, or 200 below 200) and the exchange's first two digits (80, or 20); its third and the line's four (100,000)
        area, head = _number(own, 1, 3), _number(own, 4, 2)
        ranges = F.struct(
            F.when(area >= 200, 200).otherwise(0).alias("area0"), F.when(area >= 200, 800).otherwise(200).alias("areas"),
            F.when(head >= 20, 20).otherwise(0).alias("head0"), F.when(head >= 20, 80).otherwise(20).alias("heads"),
        )

        def within(g: Column) -> Column:
            left = (area - g["area0"]) * g["heads"] + head - g["head0"]
            pair = _feistel(left, _number(own, 6, 5), g["areas"] * g["heads"], F.lit(100_000), key, "phone", restore)
            return _then(pair, lambda p: F.concat(_padded(F.floor(p["l"] / g["heads"]) + g["area0"], 3), _padded(p["l"] % g["heads"] + g["head0"], 2), _padded(p["r"], 5)))

        new = _then(ranges, within)
        return _refill(m, F.concat(F.when(F.length(d) == 11, "1").otherwise(""), new))

    return _then(_digits(m), of)


def _ssn(m: Column, key: str, restore: bool) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""

    def of(d: Column) -> Column:
        area, group, serial = _number(d, 1, 3), _number(d, 4, 2), _number(d, 6, 4)
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        left = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1
        pair = _feistel(left, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn", restore)
        place = lambda p: F.floor(p["l"] / 99) + 1
        new = _then(pair, lambda p: F.concat(_padded(place(p) + F.when(place(p) >= 666, 1).otherwise(0), 3), _padded(p["l"] % 99 + 1, 2), _padded(p["r"] + 1, 4)))
        return F.when(valid, _refill(m, new)).otherwise(m)

    return _then(_digits(m), of)


def _ip(m: Column, key: str, restore: bool) -> Column:
    """Four octets of at most 255, without leading zeros."""

    def of(parts: Column) -> Column:
        valid = F.forall(parts, lambda p: (p <= 255)) & ~m.rlike(r"(^|\.)0\d")
        pair = _feistel(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], F.lit(65_536), F.lit(65_536), key, "ip", restore)
        new = _then(pair, lambda p: F.concat_ws(".", *[x.cast("long").cast("string") for x in (F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256)]))
        return F.when(valid, new).otherwise(m)

    return _then(F.transform(F.split(m, r"\."), lambda p: p.cast("long")), of)


def _date(m: Column, pattern: str, key: str, restore: bool) -> Column:
    """A calendar date of the permuted range becomes another; any other text stays."""

    def of(day: Column) -> Column:
        number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        pair = _feistel(F.floor(number / DAYS), F.pmod(number, F.lit(DAYS)), F.lit(YEARS), F.lit(DAYS), key, "date", restore)
        new = _then(pair, lambda p: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * DAYS + p["r"]).cast("int")), pattern))
        return F.when(day.isNotNull() & number.between(0, YEARS * DAYS - 1), new).otherwise(m)

    return _then(F.to_date(F.try_to_timestamp(m, F.lit(pattern))), of)


def _email(m: Column, key: str, restore: bool) -> Column:
    """The letters and the digits of the local part are permuted; its other characters and the domain stay."""
    return _then(F.substring_index(m, "@", 1), lambda local: F.concat(_by_class(local, "local", key, restore), F.substr(m, F.instr(m, "@"))))


def _secret(m: Column, key: str, restore: bool) -> Column:
    """The value: hexadecimal, or small letters and digits, of 32 or more characters as a whole; else letters and digits apart.

    A long value that is no hexadecimal one gets a hexadecimal pseudonym, which restore cannot tell, in one of 10^11 cases.
    """

    def of(value: Column) -> Column:
        whole = F.when(value.rlike("^[0-9a-f]{32,}$"), _permuted(value, 16, "hex", key, restore)).when(value.rlike("^[0-9a-z]{32,}$"), _permuted(value, 36, "base36", key, restore))
        return F.concat(F.substr(m, F.lit(1), F.length(m) - F.length(value)), whole.otherwise(_by_class(value, "secret", key, restore)))

    return _then(F.regexp_replace(m, f"^{_NAMED}", ""), of)


def _abroad(m: Column, key: str, restore: bool) -> Column:
    """Eight to fifteen digits after a plus sign; the first two stay."""
    new = lambda d: F.concat(F.substr(d, F.lit(1), F.lit(2)), _permuted(F.substr(d, F.lit(3)), 10, "abroad", key, restore))
    return _then(_digits(m), lambda d: F.when(F.length(d).between(8, 15), _then(new(d), lambda n: _refill(m, n))).otherwise(m))


def _ipv6(m: Column, key: str, restore: bool) -> Column:
    """Eight groups, or fewer with one "::" among them; every group keeps its length. Restored letters are small ones."""
    groups = F.regexp_count(m, F.lit("[^:]+"))
    gaps = F.regexp_count(m, F.lit("::"))
    valid = ((groups == 8) & (gaps == 0)) | ((groups < 8) & (gaps == 1))
    slot = lambda c: c != ":"
    return F.when(valid, _then(_permuted(F.lower(F.replace(m, F.lit(":"), F.lit(""))), 16, "ipv6", key, restore), lambda new: _put(m, new, slot))).otherwise(m)


def _iban(m: Column, key: str, restore: bool) -> Column:
    """Letters and digits of the account are permuted apart, the country stays, the check digits are those of the new account."""

    def check(country: Column, account: Column) -> Column:
        """98 less the remainder of account, country and 00, letters counting from 10, as two digits."""
        value = lambda c: F.when(_is_digit(c), c.cast("int")).otherwise(F.ascii(c) - 55)
        rest = F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), lambda r, c: (r * F.when(_is_digit(c), 10).otherwise(100) + value(c)) % 97)
        return _padded(98 - rest, 2)

    def of(x: Column) -> Column:
        country, own, account = F.substr(x, F.lit(1), F.lit(2)), F.substr(x, F.lit(3), F.lit(2)), F.substr(x, F.lit(5))
        new = _then(_by_class(account, "iban", key, restore), lambda n: F.concat(country, check(country, n), n))
        return F.when(check(country, account) == own, _then(new, lambda n: _put(m, n, lambda c: c != " "))).otherwise(m)

    return _then(F.replace(m, F.lit(" "), F.lit("")), of)


def pseudonym(m: Column, key: str, restore: bool = False) -> Column:
    """The pseudonym of one match; what does not validate stays as it is."""
    of = {
        "secret": _secret(m, key, restore), "email": _email(m, key, restore), "iban": _iban(m, key, restore), "ip": _ip(m, key, restore), "ipv6": _ipv6(m, key, restore),
        "iso_date": _date(m, "yyyy-MM-dd", key, restore), "dmy_date": _dmy(m, key, restore), "ssn": _ssn(m, key, restore), "abroad": _abroad(m, key, restore), "card": _card(m, key, restore),
    }
    return _then(_kind(m), lambda k: reduce(lambda rest, kind: F.when(k == kind, of[kind]).otherwise(rest), reversed(of), _phone(m, key, restore)))


def _dmy(m: Column, key: str, restore: bool) -> Column:
    return F.when(F.contains(m, F.lit(".")), _date(m, "dd.MM.yyyy", key, restore)).otherwise(_date(m, "dd/MM/yyyy", key, restore))


def pseudonymise(docs: DataFrame, *, key: str, restore: bool = False) -> DataFrame:
    """docs with text replaced, and changed: an array of (kind, before, after) of its replaced values in order.

    A null text stays null and changes nothing. Repeated rows and nulls elsewhere are kept, other columns stay whatever
    their names; a column of docs named changed is overwritten. An empty table gives an empty result.
    """
    none = F.array().cast("array<string>")
    # every pattern needs a digit or an at sign
    found = F.when(text_or_empty().rlike("[0-9@]"), F.regexp_extract_all(text_or_empty(), F.lit(FOUND), F.lit(0))).otherwise(none)
    rows = docs.select(F.struct("*").alias("row"), found.alias("found"))
    rows = rows.select("row", "found", F.transform("found", lambda m: pseudonym(m, key, restore)).alias("new"))
    parts = F.split(F.col("row.text"), FOUND, -1)
    joined = F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get(F.col("new"), i), F.lit("")))), "")
    pairs = F.filter(F.zip_with("found", "new", lambda a, b: F.struct(a.alias("before"), b.alias("after"))), lambda p: p["before"] != p["after"])
    changed = F.transform(pairs, lambda p: F.struct(_kind(p["before"]).alias("kind"), p["before"].alias("before"), p["after"].alias("after")))
    text = F.when(F.size("found") == 0, F.col("row.text")).otherwise(joined)
    return rows.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c != "changed"], changed.alias("changed"))


def session_key(spark: SparkSession) -> str:
    key = spark.conf.get(KEY_CONF, "")
    if key:
        return key
    if not re.match(r"local(-cluster)?(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"{KEY_CONF} must hold the key of the pseudonyms")
    return KEY


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of changed values, in all and of each kind, and length and digest of the new text."""
    docs = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key=session_key(spark))
    counts = [F.size("changed").cast("long").alias("n_changed"), *map(_count, KINDS)]
    return docs.select("doc_id", *counts, F.length(text_or_empty()).cast("long").alias("n_chars"), F.sha2(text_or_empty(), 256).alias("text_sha256"))


def _count(kind: str) -> Column:
    return F.size(F.filter("changed", lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")
