"""Posting lists of the near-duplicate search: parted, dealt and left out, with the links of brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import minhash


def corpus(seed=9):
    """A passage that many texts share, groups of near copies, and chains around the bound."""
    dice = random.Random(seed)
    word = lambda: "".join(dice.choices("abcdefgh", k=6))
    passage = [word() for _ in range(60)]
    docs = []
    for _ in range(60):
        own = [word() for _ in range(dice.randint(8, 40))]
        docs.append(own + passage if dice.random() < 0.5 else passage + own)
    for _ in range(4):
        base = [word() for _ in range(70)]
        for _ in range(14):
            copy = list(base)
            for _ in range(dice.randint(0, 4)):
                copy[dice.randrange(len(copy))] = word()
            docs.append(copy)
    dice.shuffle(docs)
    return [(i, " ".join(words)) for i, words in enumerate(docs)]


def by_brute_force(docs):
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in docs]
    root = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return dict(enumerate(root))


@pytest.mark.parametrize("block", [2, 9])
def test_parted_lists_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "LONG_LIST", block)
    docs = corpus()
    found = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert {r._id: r.component_id for r in found.collect()} == by_brute_force(docs)


def _labelled(spark, components):
    rng = np.random.default_rng(4)
    same = rng.integers(0, 2**32, minhash.COORDINATES, dtype=np.uint32)
    rows = [(key, 100, same.tobytes(), part) for key, part in enumerate(components)]
    return spark.createDataFrame(rows, "_key bigint, _size bigint, _sign binary, _component bigint")


def test_a_list_of_one_component_is_not_dealt(spark):
    labelled = _labelled(spark, [0] * 600)
    assert minhash._parted(labelled).isEmpty()
    assert minhash._blocks(minhash._parted(labelled), labelled).isEmpty()


def test_all_pairs_across_components_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 5)
    monkeypatch.setattr(minhash, "MATCHES", 2)
    monkeypatch.setattr(minhash, "PREFIX", minhash.COORDINATES - 1)
    parts = [0] * 13 + [1] * 8 + [2] * 3 + [3]
    labelled = _labelled(spark, parts)
    blocks = minhash._blocks(minhash._parted(labelled), labelled)
    rows = blocks.select("_bucket", "home", "guest", "lives", "visits", "_key").collect()
    by_block = {}
    for r in rows:
        by_block.setdefault((r._bucket, r.home, r.guest), []).append(r)
    assert max(map(len, by_block.values())) <= 4 * 5
    met = []
    for block in by_block.values():
        guests, homes = [r for r in block if r.visits], [r for r in block if r.lives]
        met += {(block[0]._bucket, frozenset((a._key, b._key))) for a in guests for b in homes if a._key != b._key}
    assert len(met) == len(set(met))
    assert {frozenset((a, b)) for a in range(25) for b in range(a) if parts[a] != parts[b]} <= {pair for _, pair in met}


def test_rows_are_linear_in_a_group_of_near_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("one two three four five six seven " * 9), F.col("id")).alias("text"))
    found = minhash.near_duplicates(docs)
    assert {r.component_id for r in found.select("component_id").distinct().collect()} == {0}
