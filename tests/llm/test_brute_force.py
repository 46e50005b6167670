"""Operators against brute force on small random fixtures."""

import random

import numpy as np

from rollcall.llm import embed_dedup, langid, line_dedup, minhash
from rollcall.llm.components import components


def _near(a: str, b: str) -> bool:
    """At most one character put in, taken out or exchanged."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def test_lines_near_earlier_ones_go(spark):
    rnd = random.Random(3)
    sizes = [5, 14, 15, 16, 17, 18, 31, 32, 33, 63, 64, 65, 127, 128, 129, 300, 515, 1030, 2050]
    base = ["".join(rnd.choice("abcde é漢") for _ in range(n)).strip() or "x" for n in sizes]

    def edit(x: str) -> str:
        i, c = rnd.randrange(len(x) + 1), rnd.choice("abxyé漢🙂 ")
        return rnd.choice([x[:i] + c + x[i:], x[:i] + x[i + 1 :], x[:i] + c + x[i + 1 :]]) or "y"

    docs = []
    for d in range(120):
        lines = []
        for _ in range(rnd.randrange(6)):
            line = rnd.choice(base)
            for _ in range(rnd.choice([0, 1, 1, 2])):
                line = edit(line)
            lines.append(line if rnd.random() < 0.9 else f"  {line}\t")
        docs.append((d, "\n".join(lines)))
    docs += [(600 + i, f"a template line number {i:05d} of many") for i in range(40)]
    got = {r.doc_id: r.new_text for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).select("_row.doc_id", "new_text").collect()}
    first: dict[str, tuple] = {}
    for d, text in docs:
        for p, line in enumerate(text.split("\n")):
            if line.strip(" \t\r"):
                first.setdefault(line.strip(" \t\r"), (d, p))
    gone = {a for a in first for b in first if first[b] < first[a] and min(len(a), len(b)) >= line_dedup.NEAR_CHARS and _near(a, b)}
    for d, text in docs:
        kept = [
            raw for p, raw in enumerate(text.split("\n"))
            if not (line := raw.strip(" \t\r")) or (line not in gone and first[line] == (d, p))
        ]
        assert got[d] == "\n".join(kept)


def test_near_copies_of_each_other(spark):
    """A large group in which many pairs are just above or just below the bound."""
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    base = [rnd.choice(words) for _ in range(60)]
    docs = []
    for d in range(220):
        text = list(base) if d % 4 else [rnd.choice(words) for _ in range(40)]
        for _ in range(rnd.randrange(4)):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        docs.append((d, " ".join(text)))
    got = {r._id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in docs]
    root = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for a in range(len(docs)):
            for b in range(a):
                if root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low, high = sorted((root[a], root[b]))
                    root = [low if r == high else r for r in root]
                    changed = True
    assert got == dict(enumerate(root))


def test_vectors_link_as_by_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 16))
    vectors = np.concatenate([base + rng.normal(0, 0.25, base.shape) for _ in range(12)])
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    got = {r.vec_id: r.n_links for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= embed_dedup.COSINE
    want = near.sum(1) - 1
    assert all(got[k] <= want[k] for k in got)
    assert sum(got.values()) >= 0.99 * want.sum()  # the tables may miss a pair near the bound


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(300) if k % 100 != 99] + [(5, 5), (None, 3), (7, 8)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect())
    assert got == {k: k // 100 * 100 for k in range(301) if k < 300}


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, rows=40)
    found = langid.identify(docs, model, declared_col=None, host_col=None).select("_row.lang", "language").collect()
    assert sum(r.lang == r.language for r in found) / len(found) > 0.97
