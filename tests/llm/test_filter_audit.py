"""The audit against loops over texts, and its matrix against counted words."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from rollcall.llm import filter_audit

LONG = "Word " * 150_000
ROWS = [
    (1, "a b c " * 80, "en"),
    (2, "a b c " * 80, "de"),
    (2, "a b c " * 80, "en"),
    (3, " ".join(f"w{i}" for i in range(250)), "en"),
    (4, " ".join(f"W{i}" for i in range(250)) + " 50% off", None),
    (5, None, "fr"),
    (6, "", "fr"),
    (None, "", "fr"),
    (7, "A\x0bB\x1cC D", ""),
    (8, LONG, "en"),
    (9, " \t\n", "fr"),
    (10, "ÀÉ ж 中 #", "fr"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, None, 1), (99, 1, 1), (None, 1, 1), (6, 1, None)]


def failing(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, part in rows:
        t = t or ""
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", t) if w]
        bad = set()
        if len(words) < 200:
            bad.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            bad.add("C")
        if re.search(r"[#$%&*|]", t):
            bad.add("D")
        if i is not None and least[t] < i:
            bad.add("E")
        out.append((i, part or "", bad))
    return out


def expected(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    counts, shapley = {}, Counter()
    found = failing(rows)
    for part in {p for _, p, _ in found}:
        own = [(i, bad) for i, p, bad in found if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(i, bad) for i, bad in left if name in bad]
                earlier = [bad for i, bad in own if name in bad and bad & set(order[: step - 1])]
                left = [(i, bad) for i, bad in left if name not in bad]
                shapley[part, name] += len(gone)
                counts[part, order, step] = (
                    len(left), len(gone), len(earlier), sum(bad == {name} for _, bad in own),
                    sum(i in good and i is not None for i, _ in gone), sum(i in toxic and i is not None for i, _ in gone),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in counts.items()}


@pytest.mark.parametrize("size", [filter_audit.SHARD_BYTES, 100])
def test_audit_against_loops(spark, monkeypatch, size):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", size)
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id bigint, text string, lang string, failed string").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(filter_audit.failures(docs), labels)
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert dict(got.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | {n: "bigint" for n in names}
    assert {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in got.collect()} == expected(ROWS, LABELS)


def test_matrix_holds_all_words(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 1500)
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string").repartition(3)
    packed, slots = filter_audit.shards(docs, "doc_id", "text", "lang")
    words = filter_audit.dictionary(packed, slots).collect()
    names = {r.code: r.term for r in words}
    every = {w.decode() for _, t, _ in ROWS for w in (t or "").encode().split()}
    assert len(words) == len(names) == len(every) and set(names.values()) == every
    rows = filter_audit.rows_of(filter_audit.matrix(packed, slots)).collect()
    seen = [(r._id, Counter({names[c]: n for c, n in zip(r.columns, r.counts, strict=True)})) for r in rows]
    want = [(i, Counter(w.decode() for w in (t or "").encode().split())) for i, t, _ in ROWS]
    key = lambda x: (str(x[0]), sorted(x[1].items()))
    assert sorted(map(key, seen)) == sorted(map(key, want))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert filter_audit.audit(filter_audit.failures(docs)).count() == 0
    one = spark.createDataFrame([(1, "#", None)], docs.schema)
    got = filter_audit.audit(filter_audit.failures(one)).collect()
    assert len(got) == 600 and {r.part for r in got} == {""} and {r.good_lost for r in got} == {0}


def test_effects_add_up(spark):
    table = filter_audit.effects(spark).toPandas()
    assert len(table) == 32 * 120 * 5
    some = table[table.failed > 0]
    assert (some.groupby(["failed", "filter_order"]).goes.sum() == 1).all()
    share = some[some.filter_order == "ABCDE"].groupby("failed").orders.sum()
    assert np.all(share == 120)
