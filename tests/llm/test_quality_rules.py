"""op13 against a plain count of every measure, and its edge cases."""

import random
import re
from collections import Counter

import pytest

from terraflux.llm import quality_rules
from terraflux.llm.quality_rules import MEASURES, RULES, Rule, drop_by_rules, judge

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, row string, words string, n_words string, failed string"


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    found = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if found[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_bullet_lines": sum(bool(re.match(r"[ \t]*([-*+•‣◦·–]|[0-9]{1,3}[.)])[ \t]", x)) for x in lines),
        "n_ellipsis_lines": sum(bool(re.search(r"(\.\.\.|…)[ \t\r]*$", x)) for x in lines),
        "n_letter_words": sum(any(c.isascii() and c.isalpha() or c >= "\x80" for c in w) for w in words),
        "n_stop_words": sum(w.lower() in quality_rules.STOP_WORDS for w in words),
    }


def failed(counts, rules=RULES):
    out = []
    for r in rules:
        value = eval(re.sub(r"CAST\((.*) AS double\)", r"(\1)", MEASURES[r.measure]), {"greatest": max}, counts)  # noqa: S307
        if r.least is not None and value < r.least or r.most is not None and value > r.most:
            out.append(r.name)
    return out


def texts():
    rng = random.Random(3)
    out = [None, "", " \t\n\x0b\f\r", "one", "a b\n\na b\n \na b", "x " * 7, "x " * 8, "x " * 9, "x y " * 30, "é…\n- a\n* b\n12. c…\r\n3) d...  \n", "    nbsp are words \u0085", "a\x00b c"]
    for _ in range(60):
        pool = [rng.choice(["the", "of", "Der", "word", "#", "$$", "12", "naïve", "日本", "end...", "…"]) + rng.choice(["", "", "s"]) for _ in range(rng.randrange(2, 40))]
        words = [rng.choice(pool) for _ in range(rng.randrange(0, 200))]
        for _ in range(rng.randrange(0, 4)):
            at, n = rng.randrange(len(words) + 1), rng.randrange(5, 30)
            words[rng.randrange(len(words) + 1) :][:0] = words[at : at + n]
            words += words[at : at + n]
        out.append("".join(w + rng.choice([" ", "  ", "\n", "\n\n", "\t", " \n- "]) for w in words))
    return out


def test_measures_of_odd_and_random_texts(spark):
    rows = list(enumerate(texts()))
    got = judge(spark.createDataFrame([(i, t, "r", "w", "n", "f") for i, t in rows], COLUMNS)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain(dict(rows)[r.row.doc_id])
        assert {k: r[k] for k in want} == want, r.row.doc_id
        assert r.failed == failed(want), r.row.doc_id


def test_long_text_of_one_passage_again_and_again(spark):
    """A very long text, half of it repeats: covered words are found by one sort."""
    words = [f"w{i}" for i in range(60_000)] + ["p q r s t u v"] + [f"w{i}" for i in range(30_000)]
    got = judge(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert (got.n_words, got.n_repeat_words) == (90_007, 60_000)


def test_rows_stay_whole(spark):
    good = "The cat sat on the mat and it was warm in the sun for most of that long day by the river"
    rows = [(1, good, "r", None, "n", "f"), (1, good, "r", None, "n", "f"), (None, good, None, "w", None, None), (2, None, "r", "w", "n", "f"), (3, "#" * 90, "r", "w", "n", "f")]
    docs = spark.createDataFrame(rows, COLUMNS)
    left = drop_by_rules(docs)
    assert left.columns == docs.columns and sorted(map(repr, map(tuple, left.collect()))) == sorted(map(repr, rows[:3]))
    assert drop_by_rules(docs.limit(0)).count() == 0 == judge(docs.limit(0)).count()
    assert drop_by_rules(docs, ()).count() == 5
    with pytest.raises(ValueError, match="nothing"):
        judge(docs, [Rule("x", "nothing", least=1)])


def test_plan_has_no_exchange_and_no_python(spark):
    plan = judge(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
