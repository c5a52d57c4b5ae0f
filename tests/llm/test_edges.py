"""Nulls in any column, empty and long texts, ties, repeated rows, empty tables and extra columns for every operator."""

import datetime
import hashlib
import html as html_of
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from terraflux.llm import chat_format, decontamination, exact_dedup, html_text, mixing, near_dedup, pii, quality, substring_dedup, url_filter

needs_tables = pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables are not here")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, count long, name string, level int"
LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(60_000))


def docs(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, "k", 7, "n", 3)[:9] if len(r) == 2 else r for r in rows], DOCS)


ROWS = [
    (1, "The cat sat on the mat and then it slept"), (2, None), (3, ""), (4, " \t\n"), (5, "the  cat sat on the mat\nand then it slept"),
    (6, "The cat sat on the mat and then it slept"), (6, "The cat sat on the mat and then it slept"), (None, "orphan text here"), (8, LONG), (9, LONG + " end"), (10, "one"), (11, "one"),
]


def result(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_exact_dedup(spark):
    out = exact_dedup.exact_dedup(docs(spark, ROWS), block_chars=64)
    assert out.count() == len(ROWS)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in ROWS:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    for r in out.collect():
        text = next(t for i, t in ROWS if i == r.doc_id)
        own = sorted(groups[norm(text)], key=lambda g: (g[0], g[1], g[2] or 0))
        assert (r.keep_id, r.group_size) == (own[0][2], len(own))
        assert r.text_sha256 == hashlib.sha256(norm(text).encode()).hexdigest()
    assert sum(r.kept for r in out.collect()) == len(groups)
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0
    want = {(r.doc_id, r.text_sha256) for r in out.collect() if r.kept}
    for limit in (10, 0):
        left = exact_dedup.drop_copies(docs(spark, ROWS), max_broadcast=limit)
        assert left.columns == docs(spark, ROWS).columns and sorted(((r.doc_id, hashlib.sha256(norm(r.text).encode()).hexdigest()) for r in left.collect()), key=repr) == sorted(want, key=repr)
    assert exact_dedup.drop_copies(docs(spark, [])).count() == 0


def test_exact_dedup_survives_equal_keys(spark, monkeypatch):
    """Two blocks with one key: another seed is tried."""
    real, seeds = exact_dedup._key, []

    def key(block, seed):
        seeds.append(seed)
        return F.struct(F.lit(1).cast("long").alias("a"), F.lit(1).cast("long").alias("b")) if seed == 1 else real(block, seed)

    monkeypatch.setattr(exact_dedup, "_key", key)
    assert result(exact_dedup.exact_dedup(docs(spark, [(1, "a"), (2, "b"), (3, "a")])), "doc_id", "keep_id") == [(1, 1), (2, 2), (3, 1)]
    assert 2 in seeds


def test_near_dedup(spark):
    out = near_dedup.near_dedup(docs(spark, ROWS), shingle=2)
    got = result(out, "doc_id", "n_shingles", "component_id", "kept")
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in out.collect()}
    assert by[1].component_id == by[5].component_id == by[6].component_id == 1
    assert (by[2].n_shingles, by[2].component_id, by[2].kept) == (0, 2, True) and by[4].component_id == 4
    assert (by[None].component_id, by[None].kept) == (None, True)
    assert by[9].component_id == 8 and by[11].component_id == 10
    assert near_dedup.near_dedup(docs(spark, [])).count() == 0
    left = near_dedup.drop_near_copies(docs(spark, ROWS), shingle=2)
    assert left.columns == docs(spark, ROWS).columns and 5 not in {r.doc_id for r in left.collect()}


def test_near_dedup_of_repeated_ids(spark):
    """A doc_id that stands on two texts: each row is judged by its own text."""
    one, two = ([f"{c}{i}" for i in range(60)] for c in "ab")
    near = lambda words: " ".join([*words[:30], "z", *words[31:]])
    rows = [(1, " ".join(one)), (5, near(one)), (5, near(two)), (7, " ".join(two)), (5, near(two)), (9, near(one) + " "), (9, " ".join(two))]
    table = docs(spark, rows)
    assert result(near_dedup.near_dedup(table, shingle=2), "doc_id", "component_id", "kept") == [(1, 1, True), (5, 1, False), (5, 5, True), (5, 5, True), (7, 5, False), (9, 1, False), (9, 5, False)]
    assert result(near_dedup.drop_near_copies(table, shingle=2), "doc_id", "text") == [(1, rows[0][1]), (5, rows[2][1]), (5, rows[2][1])]
    twice = docs(spark, [(1, " ".join(two)), (1, near(two))])
    assert near_dedup.drop_near_copies(twice, shingle=2).count() == 1
    shuffled = near_dedup.drop_near_copies(table.withColumnRenamed("key", "fp").withColumnRenamed("name", "gone"), shingle=2)
    assert shuffled.count() == 3 and "fp" in shuffled.columns


def test_near_dedup_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "MAX_BROADCAST", 0)
    assert near_dedup.drop_near_copies(docs(spark, ROWS), shingle=2).count() == 7


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, "cat SAT on"), (2, None), (3, "?!"), (None, "it slept"), (4, " ".join(f"word{i}x{i % 13}" for i in range(20)))], "item_id long, text string")
    out = decontamination.decontaminate(docs(spark, ROWS), bench)
    by = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(ROWS)
    assert (by[1].n_words, by[1].n_hit, by[1].n_items, by[1].contaminated) == (10, 5, 2, True)
    assert by[1].items_sha256 == hashlib.sha256(b",1").hexdigest()
    assert (by[2].n_words, by[2].n_hit, by[2].contaminated) == (0, 0, False)
    assert by[8].n_hit > 0 and not by[8].contaminated
    shuffled = decontamination.decontaminate(docs(spark, ROWS), bench, max_broadcast=0)
    assert result(out, "doc_id", "n_hit", "items_sha256") == result(shuffled, "doc_id", "n_hit", "items_sha256")
    assert decontamination.decontaminate(docs(spark, ROWS), bench.filter("false")).filter("n_hit > 0").count() == 0
    assert decontamination.decontaminate(docs(spark, []), bench).count() == 0


def test_substring_dedup(spark):
    shared = " ".join(f"s{i}" for i in range(30))
    rows = [(1, "a b " + shared), (2, "c " + shared + " d"), (3, shared), (None, shared), (4, None), (5, "x y"), (2, "c " + shared + " d"), (6, LONG), (7, LONG)]
    out = substring_dedup.remove_repeats(docs(spark, rows))
    by = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows)
    assert (by[1].n_removed, by[2].kept, by[3].kept) == (0, "c d", "")
    assert by[None].n_removed == 0 and by[4].n_words == 0 and by[5].kept == "x y"
    assert by[6].n_removed == 0 and by[7].n_removed == 60_000
    assert substring_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_substring_dedup_of_one_id_on_two_texts(spark):
    """Each text of an id is judged by its own words; places of one say nothing about the other."""
    w, u = " ".join(f"w{i}" for i in range(40)), " ".join(f"ü{i}" for i in range(40))
    out = substring_dedup.remove_repeats(docs(spark, [(1, w), (2, w), (2, u), (2, w + " é"), (2, None)]))
    assert result(out, "doc_id", "n_removed", "kept") == [(1, 0, w), (2, 0, ""), (2, 0, u), (2, 40, ""), (2, 40, "é")]


def test_quality(spark):
    good = [(i, f"a calm day number {i} went by in the town") for i in range(60)]
    bad = [(100 + i, f"$$$ BUY ### NOW %%% {i} !!!") for i in range(60)]
    table = docs(spark, good + bad + [(900, None), (901, ""), (None, "a calm day")])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (5, None, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.score(table, *quality.fit(table, labels)).collect()}
    assert len(out) == 123 and out[900].score == out[901].score and out[None].held_out is False
    assert all(out[i].predicted == 1 for i, _ in good) and all(out[i].predicted == 0 for i, _ in bad)
    kept = quality.drop_low_quality(table, labels)
    assert kept.columns == table.columns and kept.filter("doc_id >= 100 AND doc_id < 900").count() == 0
    few = quality.fit(table, labels, max_bytes=400)
    assert 0 < (few[0] != 0).sum() < (quality.fit(table, labels)[0] != 0).sum()
    none = quality.score(table, *quality.fit(table, labels.filter("false"))).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score(docs(spark, []), *quality.fit(docs(spark, []), labels)).count() == 0


def test_chat_format(spark):
    marks = ["</s>[INST] ok [/INST]", "\\[INST]", "<\\s>", "<<SYS>>x<</SYS>>", "[ROLE]a[TEXT]b[/ROLE]", "\\\\", "[", "<", "/s>", "<<s>", "", None, "\n", "é<\\\\s>\\"]
    rows = [(c, t, r, x) for c, r in enumerate(("user", "assistant", "system", "tool", None, "a[TEXT]b")) for t, x in enumerate(marks)]
    rows += [(None, 0, "user", "x"), (50, None, "assistant", "b"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a"), (51, 0, "user", LONG)]
    told = spark.createDataFrame([(*r, "b", "f") for r in rows], "conv_id long, turn long, role string, text string, block string, formatted string")
    chats = chat_format.format_chats(told)
    read = {r.conv_id: [tuple(t) for t in r.turns] for r in chats.select("conv_id", chat_format.parse(F.col("formatted")).alias("turns")).collect()}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert read[c] == [(r[2] or "", r[3] or "") for r in own]
    by = {r.conv_id: r for r in chat_format.digests(chats).collect()}
    said = "".join(x or "" for _, _, r, x in rows if r == "assistant" and _ is not None)
    own = "".join(x or "" for x in marks)
    assert (by[1].loss_chars, by[1].loss_sha256) == (len(own), hashlib.sha256(own.encode()).hexdigest()) and said
    assert by[50].n_turns == 3 and by[51].loss_chars == 0
    assert chat_format.format_chats(told.filter("false")).count() == 0 and chats.filter("error IS NOT NULL").count() == 0
    lone = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    assert result(chat_format.digests(chat_format.format_chats(lone)), "conv_id", "n_turns", "loss_chars") == [(None, 1, 0), (None, 1, 1)]


def test_url_filter(spark):
    urls = [
        "http://a.example.com/en/7x", "http://example.com/en/8", "HTTP://WWW.Foo.NET/de/1?x=1#y", "http://example.net/de/81", "https://x.org/es/", "https://m.bad.io/p/?utm_source=a&b=2&a=1#z",
        "https://bad.io:443/p?a=1&b=2", "https://bad.io/q", None, "no scheme", "http://", "http://notcom/en/", "x://?q=://y",
    ]
    pages = spark.createDataFrame([(i, u, "h", "b") for i, u in enumerate(urls)] + [(0, urls[0], "h", "b"), (None, urls[6], None, None)], "page_id long, url string, host string, block string")
    listed = spark.createDataFrame([("bad.io/p?a=1&b=2",), (None,), ("bad.io/p?a=1&b=2",)], "listed_url string")
    got = {(r.page_id): (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, listed).collect()}
    assert got[0] == ("a.example.com", "/en/7x", "example.com/en/7", "allow") and got[1][2:] == ("com/en/", "block")
    assert got[2] == ("www.foo.net", "/de/1", "net/de/", "allow") and got[3][2:] == ("example.net/de/8", "block") and got[4][3] == "block"
    assert got[5][3] == got[6][3] == got[None][3] == "block" and got[7][3] == "allow"
    assert got[8] == got[9] == ("", "", None, "allow") and got[11][2] is None and got[12] == ("", "", None, "allow")
    columns = ("page_id", "host", "path", "rule", "verdict")
    for limits in ({"max_blocks": 0}, {"max_listed": 0}, {"max_blocks": 0, "max_listed": 0}):  # by shuffles
        assert result(url_filter.filter_urls(pages, listed, **limits), *columns) == result(url_filter.filter_urls(pages, listed), *columns)
    assert url_filter.filter_urls(pages, listed.filter("false")).filter("rule IS NULL AND verdict = 'block'").count() == 0
    assert url_filter.filter_urls(pages.filter("false"), listed).count() == 0


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(2000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("listed_url"))
    pages = spark.range(20_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://u"), F.col("id").cast("string")).alias("url"))
    assert url_filter.filter_urls(pages, listed, ()).filter("verdict = 'block'").count() == 2000


def test_pii(spark):
    text = "mail bosbt.42@mail8.example.com, card 4041894974608795 or 4041-8949-7460-8795, tel +1 (988) 555-2485 ip 70.123.182.155 x 999.1.1.1 ssn 123-45-6789 on 2024-02-29, 31.12.1999 31.02.2001 4041894974608796"
    rows = [(1, text), (2, None), (3, ""), (4, "nothing 12"), (5, "again 4041894974608795"), (None, text), (1, text), (6, LONG), (7, "ab@b.co " * 2000)]
    table = docs(spark, rows)
    out = pii.pseudonymise(table, key="k")
    assert out.columns == [*table.columns, "changed"] and out.count() == len(rows)
    by = {r.doc_id: r for r in out.collect()}
    after = {c.before: c.after for c in by[1].changed}
    assert after["4041894974608795"] == after["4041-8949-7460-8795"].replace("-", "") == {c.before: c.after for c in by[5].changed}["4041894974608795"]
    assert "4041894974608796" in by[1].text and "999.1.1.1" in by[1].text and "31.02.2001" in by[1].text and by[None].text == by[1].text
    for pattern in (r"mail [a-z]{5}\.\d\d@mail8\.example\.com", r"tel \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", r"ssn \d{3}-\d\d-\d{4}", r"on \d{4}-\d\d-\d\d,"):
        assert re.search(pattern, by[1].text)
    assert by[2].text is None and by[3].text == "" and by[4].text == "nothing 12" and by[6].text == LONG
    back = pii.pseudonymise(out, key="k", restore=True)
    assert result(back, "doc_id", "text") == result(table, "doc_id", "text")
    assert result(pii.pseudonymise(table, key="other"), "text") != result(out, "text")


def test_pii_needs_a_key_on_a_cluster():
    class Session:
        def __init__(self, master, key):
            self.sparkContext, self.conf = self, self
            self.master, self.get = master, lambda name, default: key or default

    assert pii.session_key(Session("local[4]", "")) == pii.session_key(Session("local-cluster[3,2,3000]", "")) == pii.KEY
    assert pii.session_key(Session("spark://host:7077", "own")) == "own"
    for master in ("yarn", "spark://host:7077", "k8s://local"):
        with pytest.raises(RuntimeError, match=pii.KEY_CONF):
            pii.session_key(Session(master, ""))


def test_pii_of_any_telephone_number(spark):
    numbers = ["+1 (017) 555-7713", "+1 (132) 555-1352", "(988) 155-2485", "000-000-0000", "+1 988.055.2485", "199 199 9999"]
    table = spark.createDataFrame([(i, f"tel {x} end") for i, x in enumerate(numbers)], "doc_id long, text string")
    out = pii.pseudonymise(table, key="k")
    shape = lambda x: re.sub(r"\d", "0", x)
    for x, r in zip(numbers, out.orderBy("doc_id").collect()):
        assert [(c.kind, c.before) for c in r.changed] == [("phone", x)] and x not in r.text
        assert shape(r.text) == shape(f"tel {x} end") and r.text.startswith("tel +1") == x.startswith("+1")
    assert result(pii.pseudonymise(out, key="k", restore=True), "text") == result(table, "text")


PRIVATE = {
    "secret": ['token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "password: Hunter2-abc", "API_KEY=sk_live_9aB3xY77", "secret='0123456789abcdefghijklmnopqrstuvwxyz'"],
    "email": ["a@example.com", "Anna.Maria7@b.co", "x1@y.org", "abcdefghijklmnopqrstuvwxyzabcdefghij99@long.example.net", "1234567890123456789012@n.io"],
    "iban": ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "FR1420041010050500013M02606"],
    "ipv6": ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1ff:fe23:4567:890a"],
    "abroad": ["+49 30 5557713", "+44 (0)20 7946 0958".replace("(0)", ""), "+33 1 23 45 67 89", "+3581234567"],
}
PLAIN = ["at 12:34:56 o'clock", "DE00370400440532013000", "the token: Vereinigung", "AB12 is a code", "1:2:3:4", "+1 2"]


def test_pii_of_every_kind(spark):
    rows = [(i, f"see {x} end", kind) for i, (kind, x) in enumerate((k, x) for k in PRIVATE for x in PRIVATE[k])]
    table = spark.createDataFrame([(*r, "m", "n") for r in rows], "doc_id long, text string, kind string, __m string, new string")
    out = pii.pseudonymise(table, key="k")
    shape = lambda x: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "0", x)))
    for (_, text, kind), r in zip(rows, out.orderBy("doc_id").collect()):
        assert [c.kind for c in r.changed] == [kind] and (r["__m"], r.new) == ("m", "n"), text
        assert len(r.text) == len(text) and r.text != text
        if "04db" in text:
            assert re.fullmatch('see token = "[0-9a-f]{40}" end', r.text)
        elif kind == "iban":
            x = re.sub("[^A-Z0-9]", "", r.text.removeprefix("see ").removesuffix(" end"))
            assert int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1 and shape(r.text) == shape(text)
        elif kind in ("email", "abroad"):
            assert shape(r.text) == shape(text)
    assert result(pii.pseudonymise(out, key="k", restore=True), "text") == result(table, "text")
    clean = spark.createDataFrame([(i, x) for i, x in enumerate(PLAIN)], "doc_id long, text string")
    assert pii.pseudonymise(clean, key="k").filter("size(changed) > 0").count() == 0


def plain_feistel(left, right, a, b, key, kind):
    for n in range(pii.ROUNDS):
        draw = lambda v: int(hashlib.sha256(f"{key}|{kind}|{n}|{v}".encode()).hexdigest()[:15], 16)  # noqa: B023, E731
        left, right = ((left + draw(right)) % a, right) if n % 2 == 0 else (left, (right + draw(left)) % b)
    return left, right


def plain_permuted(x, base, kind, key):
    digits, k, out = "0123456789abcdefghijklmnopqrstuvwxyz", -(-len(x) // (2 * pii.HALF[base])), ""
    if base == 26:
        x = "".join(digits[ord(c) - 97] for c in x)
    number = lambda s: int(s, base) if s else 0
    for i in range(k):
        part = x[i * len(x) // k : (i + 1) * len(x) // k]
        half = len(part) // 2
        for v, n in zip(plain_feistel(number(part[:half]), number(part[half:]), base**half, base ** (len(part) - half), key, f"{kind}{i}"), (half, len(part) - half)):
            text = ""
            for _ in range(n):
                text, v = digits[v % base] + text, v // base
            out += text
    return "".join(chr(97 + digits.index(c)) for c in out) if base == 26 else out


def plain_by_class(x, kind, key):
    letters = iter(plain_permuted("".join(c for c in x if c.isalpha()).lower(), 26, f"{kind} letters", key))
    digits = iter(plain_permuted("".join(c for c in x if c.isdigit()), 10, f"{kind} digits", key))
    return "".join(next(digits) if c.isdigit() else c if not c.isalpha() else next(letters).upper() if c.isupper() else next(letters) for c in x)


def test_pii_against_plain_python(spark):
    """The same rounds written out in Python, for each way of splitting a value."""
    day = lambda x: (datetime.date.fromisoformat(x) - datetime.date.fromisoformat(pii.FIRST_DAY)).days

    def date(x):
        left, right = plain_feistel(*divmod(day(x), pii.DAYS), pii.YEARS, pii.DAYS, "k", "date")
        return str(datetime.date.fromisoformat(pii.FIRST_DAY) + datetime.timedelta(left * pii.DAYS + right))

    def ip(x):
        p = [int(c) for c in x.split(".")]
        left, right = plain_feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], 65536, 65536, "k", "ip")
        return ".".join(map(str, (*divmod(left, 256), *divmod(right, 256))))

    def ssn(x):
        area, group, serial = map(int, x.split("-"))
        left, right = plain_feistel((area - (2 if area > 666 else 1)) * 99 + group - 1, serial - 1, 898 * 99, 9999, "k", "ssn")
        area = left // 99 + 1
        return f"{area + (area >= 666):03}-{left % 99 + 1:02}-{right + 1:04}"

    def card(x):
        half = (len(x) - 2) // 2
        rest = len(x) - 2 - half
        left, right = plain_feistel(int(x[1 : 1 + half]), int(x[1 + half : -1]), 10**half, 10**rest, "k", "card")
        head = f"{x[0]}{left:0{half}}{right:0{rest}}"
        total = sum(sum(divmod(int(c) * (2 if i % 2 == 0 else 1), 10)) for i, c in enumerate(reversed(head)))
        return head + str(-total % 10)

    def phone(x):
        d = re.sub(r"\D", "", x)[-10:]
        area, head = int(d[:3]), int(d[3:5])
        area0, areas = (200, 800) if area >= 200 else (0, 200)
        head0, heads = (20, 80) if head >= 20 else (0, 20)
        left, right = plain_feistel((area - area0) * heads + head - head0, int(d[5:]), areas * heads, 100_000, "k", "phone")
        new = f"{left // heads + area0:03}{left % heads + head0:02}{right:05}"
        return f"+1 ({new[:3]}) {new[3:6]}-{new[6:]}"

    def email(x):
        local, host = x.split("@")
        return plain_by_class(local, "local", "k") + "@" + host

    value = lambda x: x.split('"')[1]
    want = {x: f(x) for f, own in (
        (date, ["2024-02-29", "1999-12-31"]), (ip, ["70.123.182.155", "0.0.0.1"]), (ssn, ["123-45-6789", "667-01-0001"]), (card, ["4041894974608795", "378282246310005"]),
        (phone, ["+1 (988) 555-2485", "+1 (017) 055-7713"]), (email, PRIVATE["email"]),
        (lambda x: x.replace(value(x), plain_permuted(value(x), 16, "hex", "k")), PRIVATE["secret"][:1]),
        (lambda x: "password: " + plain_by_class(x[10:], "secret", "k"), PRIVATE["secret"][1:2]),
    ) for x in own}
    table = spark.createDataFrame([(i, x) for i, x in enumerate(want)], "doc_id long, text string")
    assert [r.text for r in pii.pseudonymise(table, key="k").orderBy("doc_id").collect()] == list(want.values())


def test_feistel_is_a_permutation(spark):
    pairs = spark.range(7 * 5).select((F.col("id") % 7).alias("l"), F.floor(F.col("id") / 7).alias("r"))
    done = pairs.select(pii._feistel(F.col("l"), F.col("r"), F.lit(7), F.lit(5), "k", "t", False).alias("p")).select("p.l", "p.r")
    assert done.distinct().count() == 35 and done.filter("l BETWEEN 0 AND 6 AND r BETWEEN 0 AND 4").count() == 35


def test_mixing(spark):
    rows = [(i, "w " * (5 + i % 3), lang, source, None, None, None, None, None) for i, (lang, source) in enumerate([("en", "src0"), ("en", "src1"), ("de", "src2"), (None, None)] * 10)]
    rows += [(None, "a b", "en", "src0", None, None, None, None, None), (3, None, "en", "src1", None, None, None, None, None), (1, "w " * 6, "en", "src1", None, None, None, None, None)]
    table = docs(spark, rows)
    out = mixing.mix(table, budget=(1, 2))
    total = sum(len((r[1] or "").split()) for r in rows)
    read = out.agg(F.sum("n_tokens")).first()[0]
    assert 0.8 * total / 2 <= read <= total / 2
    assert out.groupBy("doc_id", "epoch", "n_tokens").count().filter("count > 2").count() == 0
    again = result(mixing.mix(table.repartition(7), budget=(1, 2)), "doc_id", "epoch", "n_tokens")
    assert again == result(out, "doc_id", "epoch", "n_tokens")
    lots = mixing.mix(table, budget=(10, 1), max_epochs=2)
    assert lots.agg(F.max("epoch")).first()[0] == 1 and lots.agg(F.sum("n_tokens")).first()[0] == 2 * total
    assert mixing.mix(docs(spark, [])).count() == 0
    assert result(mixing.mix(table, budget=(1, 2), max_broadcast=0), "doc_id", "epoch", "n_tokens") == result(out, "doc_id", "epoch", "n_tokens")
    named = mixing.mix(table, domains=spark.createDataFrame([("src0", "web"), ("src1", "books")], "source string, domain string"), budget=(1, 1))
    assert {(r.source, r.domain) for r in named.collect()} == {("src0", "web"), ("src1", "books"), ("src2", ""), ("", "")}
    bare = mixing.mix(table.select("doc_id", "text"), budget=(1, 1))
    assert bare.agg(F.sum("n_tokens")).first()[0] == total and {(r.domain, r.lang, r.source) for r in bare.collect()} == {("community", "", "")}


def test_html(spark):
    words = "the man of the town went to the market and he was in it for a day with his dog and the cat that they had " * 3
    page = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
      <article><header><h1>A &amp; B</h1></header><p>{words}<p><b>Short&nbsp;one.<br></p><aside>Aside</aside><form><p>Join</p></form><ul><li>First</li></ul><footer>Tags</footer><!-- x > y --></article>
      <div class="sidebar">Side</div><section id="comments"><p>{words}</p></section><footer>&copy; us</footer></body></html>"""
    want = "\n\n".join(["A & B", " ".join(words.split()), "Short one.", "First"])
    pages = spark.createDataFrame([(1, "u", page, "t"), (2, None, None, "t"), (3, "u", "", "t"), (None, "u", page, "t"), (4, "u", f"<p>{words}</p>" * 500, "t"), (5, "u", "plain &lt;text&gt; only", "t"), (6, "u", "<p>a <b", "t"), (1, "u", page, "t")], "page_id long, url string, html string, text string")
    out = html_text.extract_text(pages)
    by = {r.page_id: r for r in out.collect()}
    assert out.count() == 8 and by[1].text == by[None].text == want and by[1].n_chars == len(want)
    assert by[2].text == by[3].text == "" and by[4].text.count("\n\n") == 499 and by[5].text == "plain <text> only"
    assert html_text.extract_text(pages.filter("false")).count() == 0


GOOD = "This is the text of the page and it has all of the words that are in it. " * 6


@pytest.mark.parametrize("page, want", [
    (f"<p>{GOOD}</p><p>Karl Ratzek, Berlin, Oderstrasse 17, Telefon 030 5557713, Vorsitzender, Abteilung Nord</p>", f"{GOOD.strip()}\n\nKarl Ratzek, Berlin, Oderstrasse 17, Telefon 030 5557713, Vorsitzender, Abteilung Nord"),
    (f"<nav><ul><li><a href=/>Home</a><article><h1>T</h1><p>{GOOD}</article><footer>f</footer>", f"T\n\n{GOOD.strip()}"),
    (f"<aside><article><p>Teaser</p></article></aside><article><p>{GOOD}</article>", GOOD.strip()),
    (f'<div class="search-page"><p>{GOOD}</p></div>', GOOD.strip()),
    (f'<div class="search"><p>{GOOD}</p><p>a</p></div>', GOOD.strip()),
    (f'<div class="no-sidebar has-menu"><p>{GOOD}</p></div><div class="site-sidebar"><p>{GOOD}</p></div>', GOOD.strip()),
    (f'<form id="aspnetForm"><article><p>{GOOD}</p></article></form>', GOOD.strip()),
    (f"<form><p>{GOOD}</p></form>", GOOD.strip()),
    (f"<button>Go<p>{GOOD}</p>", f"Go\n\n{GOOD.strip()}"),
    (f"<p>{GOOD}</p><button>Go</button><select><option>1</select>", GOOD.strip()),
    (f'<div class="comment-list"><p>{GOOD}</p></div><div class="ad-300x250"><p>{GOOD}</p></div><div class="cookie-banner"><p>{GOOD}</p></div>', ""),
    ("<ul><li>" + "<li>".join([GOOD] * 3), "\n\n".join([GOOD.strip()] * 3)),
    ("<p>Zażółć gęślą jaźń i pobiegł przez łąkę, a potem wrócił nad rzekę oraz zasnął pod starym dębem.</p>" * 3, "\n\n".join(["Zażółć gęślą jaźń i pobiegł przez łąkę, a potem wrócił nad rzekę oraz zasnął pod starym dębem."] * 3)),
])
def test_html_keeps_the_article(page, want):
    assert html_text.main_text(page) == want


@needs_tables
def test_html_of_whole_tables(spark):
    """All given pages against a plain reading of their template: the blocks of the article, tags off and references decoded."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}

    def plain(page):
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1|h2|ul|ol|li|table|tr|td|blockquote|pre|div|section)\b[^>]*>", re.sub(r"<(script|style|aside|form)\b.*?</\1>|<!--.*?-->", "", article, flags=re.S))
        return "\n\n".join(x for x in (" ".join(html_of.unescape(re.sub(r"<[a-z/][^>]*>", "", re.sub(r"<br\s*/?>", " ", p))).split()) for p in parts) if x)

    rows = [r for r in pages.collect() if len(re.findall("<article>", r.html or "")) == 1 and "</article>" in r.html]
    assert len(rows) > 0.9 * len(got)
    assert [r.page_id for r in rows if got[r.page_id] != plain(r.html)] == []


@pytest.mark.parametrize("unit", ["<button>", "<select><p>", "<nav><article><p>the text", "<nav>", "<header><p>x</p>", "<", "<a ", "x", "<!--", "<div><p>x</p>", "<div>", "</div><section><p>y", "<section><h2>Comments</h2><p>z"])
def test_html_takes_time_in_proportion(unit):
    """Eight times the page takes less than 24 times as long; square time would be 64 times."""
    def took(n):
        began = time.perf_counter()
        html_text.main_text(unit * n)
        return time.perf_counter() - began

    took(100)
    assert min(took(32_000), took(32_000)) < 24 * max(min(took(4_000), took(4_000)), 0.004)


@pytest.mark.parametrize("after", [
    "<section><h2>Comments</h2><p>{g}</p><div><p>{g}</p></div></section>", "<div class='utterances'><p>{g}</p></div>", "<div class=reviews><p>{g}</p></div>", "<ul class='message-list'><li>{g}</ul>",
    "<div><h3>12 Kommentare:</h3><p>{g}</p></div>", "<div><h3>3 thoughts on “A page”</h3><ol><li>{g}</ol></div>", "<div><p>{g}</p></div>",
])
def test_html_leaves_out_what_readers_say(after):
    article = f"<article><h1>T</h1><p>{GOOD}</p><p>{GOOD}</p></article>"
    want = "\n\n".join(["T", GOOD.strip(), GOOD.strip()])
    assert html_text.main_text(f"<body>{article}{after.format(g=GOOD)}</body>") == want
    if "<div><p>" not in after[:9]:  # without an article, too, unless nothing tells it from the text
        assert html_text.main_text(f"<body><div><h1>T</h1><p>{GOOD}</p><p>{GOOD}</p></div>{after.format(g=GOOD)}</body>") == want


def test_html_comments_end_with_their_level():
    page = f"<article><h1>T</h1><p>{GOOD}</p><h2>Comments</h2><p>{GOOD} one</p><h3>Deeper</h3><p>{GOOD} two</p><h2>Sources</h2><p>{GOOD} three</p></article>"
    assert html_text.main_text(page) == "\n\n".join(["T", GOOD.strip(), "Sources", f"{GOOD}three"])
    assert html_text.main_text(f"<article><h2>Comments on the treaty of 1648</h2><p>{GOOD}</p></article>").endswith(GOOD.strip())


@pytest.mark.parametrize("before", ["<html><head><title>t</title><body>", "<head><meta charset=utf-8><article>", "<head><script>x('<div>no</div>')</script><title>t</title></head>", "<body><svg/>", '<div class="layout with-sidebar"><article>', '<body><svg viewBox="0 0 1 1" />'])
def test_html_with_open_head_or_empty_svg(before):
    text = "This is the text of the page and it has all of the words that are in it. " * 6
    assert html_text.main_text(f"{before}<p>{text}</p>") == text.strip()
