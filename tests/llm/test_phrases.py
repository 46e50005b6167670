"""Counts and ranks of phrases against loops; closing of the border; exact arithmetic."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from rollcall.llm import phrases
from rollcall.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, phrase string"


def counted(rows):
    found = Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            found[lang, ""] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    found[lang, " ".join(words[at : at + size])] += 1
    return found


def ranked(found):
    size = lambda p: len(p.split(" ")) if p else 0
    several = {k: a for k, a in found.items() if size(k[1]) > 1 and a >= phrases.LEAST}
    best = {}
    for (lang, phrase), a in several.items():
        words = phrase.split(" ")
        inside = any(
            o == lang and f" {phrase} " in f" {p} " and p != phrase and 100 * b >= phrases.COVERED * a for (o, p), b in several.items()
        )
        if inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = found[lang, " ".join(words[:k])], found[lang, " ".join(words[k:])]
            cuts.append((phrases.SCALE * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        best.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    out = set()
    for lang, rows in best.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[: phrases.TOP], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, found[lang, ""], -score))
    return out


def texts(seed, count):
    dice = random.Random(seed)
    words = ["The", "the", "of", "Ünder", "ünder", "x\x1cy", "a", "ﬁn", "zed", "𝔸b", "q", "mno"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ; ", "!?"]
    make = lambda: "".join(dice.choice(words[: dice.randint(2, 12)]) + dice.choice(gaps) for _ in range(dice.randint(0, 60)))
    return [(i, make(), dice.choice(["en", "de", None, "und"]), "x") for i in range(count)]


ODD = [(910, "the longest-word-of-all-the-words-here of", "a\nb", ""), (900, None, "en", None), (901, "", None, None), (902, " . \t,\n", "fr", ""), (None, "the of the of", None, ""), (903, "one", "", "")]


@pytest.mark.parametrize("one_in, propose, slice_", [(16, 2, 4_000_000), (3, 4, 300), (10**9, 2, 4_000_000)])
def test_against_loops(spark, monkeypatch, one_in, propose, slice_):
    # With no document in the sample the border fails at every length, and the passes still close.
    for name, value in (("ONE_IN", one_in), ("PROPOSE", propose), ("SLICE", slice_)):
        monkeypatch.setattr(phrases, name, value)
    rows = texts(one_in, 220) + ODD + [(7, "of the x\x1cy q " * 40, "en", "")] * 3
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = phrases.frequent_phrases(docs)
    want = counted(rows)
    got = {(r.lang, r.phrase): r.n for r in found.collect()}
    assert found.count() == len(got)
    assert {k: n for k, n in got.items() if n} == {k: n for k, n in want.items() if n >= phrases.LEAST or (k[1] == "" and n)}
    monkeypatch.setattr(phrases, "TOP", 9)
    result = phrases.collocations(found)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert set(dict(result.dtypes).values()) == {"string", "bigint"}
    assert {tuple(r) for r in result.collect()} == ranked(want)


def test_shared_bits_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FIELD_BITS", 64)
    rows = texts(3, 150)
    found = phrases.frequent_phrases(spark.createDataFrame(rows, SCHEMA))
    want = {k: n for k, n in counted(rows).items() if n >= phrases.LEAST or k[1] == ""}
    assert {(r.lang, r.phrase): r.n for r in found.collect()} == want


def test_many_words_in_a_slice(monkeypatch):
    text = " ".join(f"w{i}" for i in range(70_000)) + " w1 w2 w3 w4"
    words = phrases.Words("en", text.encode())
    total = Counter()
    for batch in words.counted(np.flatnonzero(words.whole(4)), 4):
        total.update(dict(zip(batch.column("key").to_pylist(), batch.column("n").to_pylist(), strict=True)))
    assert sum(total.values()) == 70_001 and total["en\nw1 w2 w3 w4"] == 2
    monkeypatch.setattr(phrases, "SLICE", 1000)
    cut = list(phrases._cut(b"ab cd, " * 2000))
    assert max(map(len, cut)) < 2000 and b",".join(cut) == b"ab cd, " * 2000


def test_exact_beyond_64_bits(spark):
    big = 9 * 10**15
    rows = [("en", 0, "", big * 3), ("en", 1, "x", big), ("en", 1, "y", big + 1), ("en", 2, "x y", big - 7)]
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, size int, phrase string, n bigint")).collect()
    assert [r.score for r in got] == [phrases.SCALE * (big - 7) // (2 * big + 1)]


def test_empty_table(spark):
    assert phrases.collocations(phrases.frequent_phrases(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_ranks_each_language(spark):
    got = QUERIES["op11_collocations"](spark, "/root/testdata/sf0.001").toPandas()
    for _, part in got.groupby("lang"):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1)) and len(part) <= phrases.TOP
