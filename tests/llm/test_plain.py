"""The classifier's features and scores written out in plain Python, and what op2 misses on a whole table."""

import math
import os
import re

import numpy as np
import pytest

from terraflux.llm import pii, quality
from terraflux.llm.common import table

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
M, P = (1 << 64) - 1, 0x9E3779B97F4A7C15


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M
    return x ^ (x >> 31)


def word_hash(word):
    return mix((sum(c * pow(P, i, 1 << 64) for i, c in enumerate(word)) + len(word)) & M)


def shape(word):
    """Runs of small letters (and all bytes beyond ASCII), capitals and digits as one character each; equal others run together too."""
    kinds = ["a" if 97 <= c <= 122 or c >= 128 else "A" if 65 <= c <= 90 else "0" if 48 <= c <= 57 else chr(c) for c in word]
    return "".join(k for k, before in zip(kinds, [None, *kinds]) if k != before).encode()


def plain_slots(text):
    words = (text or "").encode().split()
    out = []
    for pair in zip(*[iter(x) for x in (words, map(shape, words))]):
        out.append(pair)
    slots = []
    for i, pair in enumerate(out):
        for kind in (0, 1):
            one = word_hash(pair[kind])
            slots.append(mix((one + kind + 7) & M))
            if i + 1 == len(out):
                slots.append(mix((2 * kind + 2) << 32))
            else:
                after = word_hash(out[i + 1][kind])
                slots.append(mix((2 * kind + 1) << 32) if after == one else mix((one + (2 * kind + 1) * after) & M))
    return [s >> (64 - quality.BITS) for s in slots]


TEXTS = ["", " \n\t", "one", "The cat sat on the mat.", "the the the the", "A1 b2 ÀÉ été 日本 $$$ !!", "x\ny  z\x0b\x0c w\r\n", "Aa Bb Cc " * 40, "###aaa111AAA---", "wort " * 3 + "Straße 12,50 €"]


def test_features(spark):
    slots, first = quality.features([t.encode() for t in TEXTS])
    assert [slots[first[i] : first[i + 1]].tolist() for i in range(len(TEXTS))] == [plain_slots(t) for t in TEXTS]
    assert len(quality.features([])[0]) == 0


def test_scores(spark):
    """The sum of the weights of a text's slots over the root of their number, through the logistic function."""
    rng = np.random.default_rng(1)
    w, bias = rng.normal(size=1 << quality.BITS).astype(np.float32), 0.3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([None, *TEXTS])], "doc_id long, text string")
    got = {r.doc_id: (r.score, r.predicted) for r in quality.score(docs, w, bias).collect()}
    for i, text in enumerate([None, *TEXTS]):
        slots = plain_slots(text)
        score = 1 / (1 + math.exp(-(bias + sum(float(w[s]) for s in slots) / math.sqrt(max(1, len(slots))))))
        assert got[i][0] == pytest.approx(score, abs=2e-6) and got[i][1] == int(got[i][0] >= 0.5)


def luhn(digits):
    return sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def private(text):
    """Personal data found in ways of their own: words between blanks, stripped of punctuation, and runs of digits."""
    for word in re.split(r"[\s\"'<>()\[\],;]+", text):
        word = word.strip(".:!?#&*%$")
        if word.count("@") == 1 and re.fullmatch(r"[A-Za-z0-9._%+-]+", word.split("@")[0]) and "." in word.split("@")[1]:
            yield word
        if re.fullmatch(r"\d{3}-\d\d-\d{4}", word) or re.fullmatch(r"\d{16}", word) and luhn(word):
            yield word
        parts = word.split(".")
        if len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 and (p == "0" or p[0] != "0") for p in parts):
            yield word


def test_values_that_stand_side_by_side(spark):
    """Each of several values with blanks between them is replaced, and alike."""
    card, grouped, iban = "4465758382889437", "4465 7583 8288 9437", "DE89370400440532013000"
    values = [(card, "card"), (grouped, "card"), (iban, "iban"), ("+1 (663) 555-6869", "phone"), ("123-45-6789", "ssn"), ("a.b@c.example", "email"), ("10.1.2.3", "ip"), ("2024-02-29", "iso_date")]
    docs = spark.createDataFrame([(i, f"x {v} {v} {v}, y") for i, (v, _) in enumerate(values)], "doc_id long, text string")
    out = pii.pseudonymise(docs, key="k").cache()
    for r in out.collect():
        value, kind = values[r.doc_id]
        assert [(c.kind, c.before) for c in r.changed] == [(kind, value)] * 3 and len({c.after for c in r.changed}) == 1, (value, r)
    assert sorted(map(tuple, pii.pseudonymise(out.select("doc_id", "text"), key="k", restore=True).select("doc_id", "text").collect())) == sorted(map(tuple, docs.collect()))


@needs_tables
def test_nothing_is_missed_on_a_whole_table(spark):
    """Every address, card, social security and IP number of the documents is replaced, and none of them is left in its text."""
    docs = table(spark, SF, "documents").select("doc_id", "text")
    out = {r.doc_id: r for r in pii.pseudonymise(docs, key="k").collect()}
    found, missed = 0, []
    for r in docs.collect():
        before = " ".join(c.before for c in out[r.doc_id].changed)
        for value in private(r.text or ""):
            found += 1
            if value not in before or re.search(rf"(?<![\w.]){re.escape(value)}(?![\w])", out[r.doc_id].text):
                missed.append((r.doc_id, value))
    assert found > 20 and missed == []
