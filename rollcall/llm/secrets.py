"""Secret scans with a random forest against false findings (operator 9).

Patterns find candidates: keys of known shape and values assigned to telling names.
A random forest, trained here from labelled findings, then tells real secrets from
placeholders, words, checksums and the like by the candidate's length, its
character transitions, how much of it dictionary words cover, its path (the pattern
and the kind of source it stands in) and the words around it.

The labelled findings are made by a stated rule from a bounded sample of texts
(``TRAINING_TEXTS``): random keys put behind telling words are secrets; words of
the corpus, placeholders, digests named as such, numbers and paths are not. Other
labelled findings can be given.

The dictionary is counted over all texts: words of four letters and more in two texts
or more, by a grouped count. Only those of its words that stand within a candidate
matter, so the letter stretches of all candidates are joined to the counted table by
key. Up to ``DICTIONARY_WORDS`` matches go to the scanner; more are joined to their texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import checkpointed, col, packed, sampled_texts, slices, small_batches, utf8

TRAINING_TEXTS = 300
FINDINGS = 4000
#: Dictionary words within candidates that every scanner may hold (some 20 MB); counted first.
DICTIONARY_WORDS = 200_000
TREES, DEPTH, LEAST = 30, 9, 3
THRESHOLD = 0.5
CONTEXT = 40  # characters before and after a candidate
NEIGHBOURS = 64
SEED = 9

# Shapes of keys that services hand out, and names that secrets are assigned to.
PATTERNS = {
    "cloud_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "forge_token": r"\bgh[pousr]_[A-Za-z0-9]{20,}",
    "chat_token": r"\bxox[abprs]-[A-Za-z0-9-]{10,}",
    "api_key": r"\b(?:sk|pk|rk)[-_](?:live[-_]|test[-_])?[A-Za-z0-9]{16,}",
    "web_token": r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*",
    "private_key": r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]+ )*PRIVATE KEY-----)?",
    "assigned": r"(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|auth|credential|access[_-]?key|bearer)[A-Za-z_]{0,12}"
    r"[\"']?\s{0,3}(?:[:=]|=>|:=|\s)\s{0,3}[\"']?(?:(?i:basic|ntlm|hawk|dpop|hmac)\s{1,3})?(?P<value>[^\s\"',;<>()\[\]{}|]{6})",
}
#: The value goes on to here.
_STOP = re.compile(r"[\s\"',;<>()\[\]{}|]|\Z")
#: Schemes of six letters and more that may stand before the value of a header; names such as Bearer are found as names.
_SCHEME = re.compile(r"(?i:digest|negotiate|mutual|sso-key|signature)\s{1,3}(?P<value>[^\s\"',;<>()\[\]{}|]{6})")
KINDS = tuple(PATTERNS)
_CANDIDATE = re.compile("|".join(f"(?P<{k}>{v})" for k, v in PATTERNS.items()))
#: A text without any of these has no candidate; they are looked for first.
_HINT = re.compile(r"AKIA|ASIA|gh[pousr]_|xox[abprs]-|[spr]k[-_]|eyJ|-----BEGIN|(?i:pass|pwd|secret|token|api[_-]?key|auth|credential|access[_-]?key|bearer)")
_EXACT = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "sk-", "sk_", "pk-", "pk_", "rk-", "rk_", "eyJ", "-----BEGIN")
_FOLDED = ("pass", "pwd", "secret", "token", "apikey", "api_key", "api-key", "auth", "credential", "accesskey", "access_key", "access-key", "bearer")


def hinted(text: str) -> bool:
    """Whether ``_HINT`` may be found: searches for fixed strings, many times faster than the pattern."""
    folded = text.casefold()
    if not text.isascii():
        folded = folded.replace("\u0131", "i").replace("i\u0307", "i")  # equal to i where case is ignored
    some = any(word in folded for word in _FOLDED) or any(word in text for word in _EXACT)
    return some and _HINT.search(text) is not None


PLACEHOLDERS = (
    "changeme", "example", "your_token_here", "xxxxxxxxxxxx", "password", "placeholder", "************", "undefined",
    "required", "<redacted>", "0000000000", "1234567890", "abcdefghijkl", "${SECRET}", "os.environ", "getenv(TOKEN)",
)
TELLING = ("password", "token", "secret", "api_key", "passwd", "auth_token", "access_key", "bearer", "db_password")
HARMLESS = ("commit", "sha256", "checksum", "md5", "etag", "revision", "digest", "uuid")

_CLASS = np.zeros(256, np.int64)  # other
for _low, _high, _kind in ((48, 58, 1), (65, 91, 2), (97, 123, 3)):
    _CLASS[_low:_high] = _kind
_VOWELS = np.isin(np.arange(256), [ord(c) for c in "aeiouAEIOU"])


@dataclass(frozen=True)
class Finding:
    kind: str
    start: int  # of the value, in characters
    value: str
    before: str
    after: str
    source: str = ""


def candidates(text: str, source: str = "") -> Iterator[Finding]:
    """Every candidate of a text, whole text, by where its match begins.

    Candidates may overlap: the search goes on at the beginning of an assigned value, so
    that a name or a scheme word taken as the value of another name ("Authorization:
    Bearer <key>", "secret password = <key>") still gives out its own value. Of
    several assigned values within one run of characters the first is the whole run,
    and the others reach to the next name, so that their lengths add up to the run's.
    """

    def finding(kind: str, start: int, end: int) -> Finding:
        return Finding(kind, start, text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT], source)

    at, run, last, seen = 0, -1, -1, (-1, -1)
    while found := _CANDIDATE.search(text, at):
        kind = found.lastgroup if found.lastgroup != "value" else "assigned"
        inner = kind == "assigned" and found.start("value") < run
        if last >= 0 and (kind == "assigned" or found.start() >= run):
            end = min(run, found.start()) if inner else run
            if end - last >= 6:
                yield finding("assigned", last, end)
                seen = last, end
            last = -1
        if kind != "assigned":
            start, end = found.span()
            if (start, end) != seen:
                yield finding(kind, start, end)
            # A key without its end mark runs on into the words behind it.
            cut_off = kind == "private_key" and "-----END" not in text[max(start, end - 80) : end]
            at = start + len("-----BEGIN") if cut_off else end
            continue
        at = start = found.start("value")
        if inner:
            last = start
            continue
        run = _STOP.search(text, start).start()
        seen = start, run
        yield finding("assigned", start, run)
        if scheme := _SCHEME.match(text, start):
            behind = scheme.start("value")
            yield finding("assigned", behind, _STOP.search(text, behind).start())
    if last >= 0:
        yield finding("assigned", last, run)


#: Dictionary words in any corpus.
COMMON = frozenset({"password", "token", "secret", "example", "change", "your", "here", "test"})


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``_word``: words of four letters and more, in lower case, that stand in at least two of all the texts."""
    text = F.lower(col(text_col).cast("string"))
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(r"\p{L}{4,}"), F.lit(0)))
    counted = docs.select(F.explode(words).alias("_word")).groupBy("_word").agg(F.count("*").alias("_n"))
    return checkpointed(counted.where("_n > 1").select("_word"))


def stretches(value: str, lengths: list[int]) -> Iterator[str]:
    """All stretches of letters of the value that have one of some lengths (ascending), in lower case."""
    for run in re.findall(r"[^\W\d_]{4,}", value.lower()):
        for n in lengths:
            if n > len(run):
                break
            for at in range(len(run) - n + 1):
                yield run[at : at + n]


def _stretched(lengths: list[int], most: int = 20_000):
    """For mapInArrow: the stretches of all candidates, by the hash of their text."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[tuple[int, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([w for _, w in found], pa.string())], ["_code", "_word"])

        held: set[tuple[int, str]] = set()
        for batch in batches:
            _, offsets = utf8(batch.column("_text"))
            for lo, hi in slices(offsets, offsets):
                part = batch.slice(lo, hi - lo)
                for code, text in zip(part.column("_code").to_pylist(), part.column("_text").to_pylist(), strict=True):
                    if not text or not hinted(text):
                        continue
                    for one in candidates(text):
                        for word in stretches(one.value, lengths):
                            held.add((code, word))
                            if len(held) >= most:
                                yield rows(list(held))
                                held.clear()
        if held:
            yield rows(list(held))

    return split


HEAD = 16


class Dictionary(frozenset):
    """Words, and the lengths of those longer than ``HEAD`` by their first letters, the longest first."""

    def __new__(cls, words=()):
        self = super().__new__(cls, words)
        self.longer = {}
        for word in self:
            if len(word) > HEAD:
                self.longer.setdefault(word[:HEAD], set()).add(len(word))
        self.longer = {head: sorted(lengths, reverse=True) for head, lengths in self.longer.items()}
        return self


def coverage(value: str, words: frozenset[str]) -> float:
    """Share of the value's characters that dictionary words cover, the longest first from the left; whole value."""
    words = words if isinstance(words, Dictionary) else Dictionary(words)
    low, covered = value.lower(), 0
    for run in re.findall(r"[^\W\d_]{4,}", low):
        at = 0
        while at + 4 <= len(run):
            steps = (*words.longer.get(run[at : at + HEAD], ()), *range(min(HEAD, len(run) - at), 3, -1))
            step = next((n for n in steps if at + n <= len(run) and run[at : at + n] in words), 0)
            covered += step
            at += step or 1
    return covered / max(len(low), 1)


def describe(finding: Finding, words: frozenset[str]) -> np.ndarray:
    raw = np.frombuffer(finding.value.encode("utf-8", "replace"), np.uint8)
    classes = _CLASS[raw]
    steps = np.bincount(classes[:-1] * 4 + classes[1:], minlength=16) / max(len(raw) - 1, 1)
    counts = np.bincount(raw, minlength=256)
    shares = counts[counts > 0] / max(len(raw), 1)
    entropy = float(-(shares * np.log2(shares)).sum())
    near = np.zeros(NEIGHBOURS)
    for part in (finding.before, finding.after):
        for word in re.findall(r"[^\W\d_]+", part.lower())[-4 if part is finding.before else 0 :][:4]:
            near[zlib.crc32(word.encode("utf-8", "replace")) % NEIGHBOURS] = 1
    kinds = [float(finding.kind == k) for k in KINDS]
    figures = [
        len(finding.value), math.log1p(len(finding.value)), entropy, entropy / math.log2(max(len(raw), 2)),
        coverage(finding.value, words), float(_VOWELS[raw].mean()) if len(raw) else 0.0,
        len(set(finding.value)) / max(len(finding.value), 1), float(finding.before.rstrip(" \"'")[-1:] in ("=", ":")),
        float("/" in finding.source or "." in finding.source), zlib.crc32(finding.source.encode("utf-8", "replace")) % 16,
    ]
    return np.concatenate([figures, steps, kinds, near])


class Forest:
    """Bagged trees over random features, Gini splits; plain numpy, the same on every machine."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(TREES):
            rows = rng.integers(0, len(x), len(x))
            nodes: list[list[float]] = []
            self._grow(x[rows], y[rows], 0, nodes, rng)
            self.trees.append(np.array(nodes))

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, nodes: list, rng: np.random.Generator) -> int:
        me = len(nodes)
        nodes.append([-1, 0, 0, 0, y.mean()])
        if depth == DEPTH or len(y) < 2 * LEAST or y.min() == y.max():
            return me
        best = (y.mean() * (1 - y.mean()) - 1e-9, -1, 0.0)
        for feature in rng.choice(x.shape[1], int(np.sqrt(x.shape[1])) + 4, replace=False):
            order = np.argsort(x[:, feature], kind="stable")
            values, hits = x[order, feature], np.cumsum(y[order])
            left = np.arange(1, len(y))
            p, q = hits[:-1] / left, (hits[-1] - hits[:-1]) / (len(y) - left)
            impurity = (left * p * (1 - p) + (len(y) - left) * q * (1 - q)) / len(y)
            impurity[(values[1:] == values[:-1]) | (left < LEAST) | (len(y) - left < LEAST)] = np.inf
            at = int(impurity.argmin()) if len(impurity) else 0
            if len(impurity) and impurity[at] < best[0]:
                best = (impurity[at], int(feature), (values[at] + values[at + 1]) / 2)
        _, feature, cut = best
        if feature < 0:
            return me
        low = x[:, feature] <= cut
        nodes[me][:2] = [feature, cut]
        nodes[me][2] = self._grow(x[low], y[low], depth + 1, nodes, rng)
        nodes[me][3] = self._grow(x[~low], y[~low], depth + 1, nodes, rng)
        return me

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Mean share of secrets in the leaves that the rows fall into."""
        total = np.zeros(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                feature = tree[at, 0].astype(int)
                inner = feature >= 0
                low = x[np.arange(len(x)), np.maximum(feature, 0)] <= tree[at, 1]
                at = np.where(inner, np.where(low, tree[at, 2], tree[at, 3]).astype(int), at)
            total += tree[at, 4]
        return total / len(self.trees)


def labelled_findings(texts: list[str], count: int = FINDINGS, seed: int = SEED) -> list[tuple[Finding, int]]:
    """Findings of known label, put between words of the texts."""
    rng = np.random.default_rng([seed, 1])
    words = [w for t in texts for w in t.split()] or ["nothing"]
    pick = lambda values: values[int(rng.integers(len(values)))]

    def run(alphabet: str, low: int, high: int) -> str:
        return "".join(pick(alphabet) for _ in range(int(rng.integers(low, high))))

    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    hexes, mixed = digits + "abcdef", lower + upper + digits
    out = []
    while len(out) < count:
        around = " ".join(pick(words) for _ in range(4)), " ".join(pick(words) for _ in range(4))
        draw, name = rng.random(), pick(TELLING)
        assign = pick(("=", " = ", ": ", '="', ' = "', "='"))
        if draw < 0.5:
            label = 1
            shaped = rng.random() < 0.5
            value = (
                pick((lambda: "AKIA" + run(upper + digits, 16, 17), lambda: "ghp_" + run(mixed, 36, 37),
                      lambda: "sk-" + run(mixed, 20, 48), lambda: "xoxb-" + run(digits, 10, 12) + "-" + run(mixed, 20, 24),
                      lambda: "eyJ" + run(mixed, 20, 40) + "." + run(mixed, 30, 80) + "." + run(mixed, 20, 43)))()
                if shaped else pick((lambda: run(hexes, 16, 65), lambda: run(mixed, 14, 48), lambda: run(mixed + "!#$%&*+-/=?@^_", 10, 24)))()
            )
            middle = value if shaped and rng.random() < 0.6 else f"{name}{assign}{value}"
        else:
            label = 0
            value = pick((lambda: pick(words), lambda: pick(words) + pick(words), lambda: pick(PLACEHOLDERS), lambda: pick(PLACEHOLDERS) + run(digits, 1, 4),
                          lambda: run("xX*", 1, 2) * int(rng.integers(6, 20)), lambda: run(digits, 6, 12), lambda: "/".join(pick(words) for _ in range(3)),
                          lambda: run(lower, 1, 2) * 4 + pick(words), lambda: "AKIA" + "X" * 16, lambda: "sk-" + "x" * 24,
                          lambda: "AKIA" + "EXAMPLE" + "A" * 9, lambda: "_".join(pick(words) for _ in range(2))))()
            middle = f"{name}{assign}{value}"
            if rng.random() < 0.12:
                middle = f"{name} {pick(HARMLESS)}: {run(hexes, 32, 65)}" if rng.random() < 0.5 else f"{name} {pick(words)} {pick(words)}"
        found = list(candidates(f"{around[0]} {middle} {around[1]}"))
        out += [(one, label) for one in found[:1]]
        if not found and draw > 0.9:
            count -= 1  # nothing to label there
    return out


@dataclass
class Scanner:
    """``by_text`` (``_code, _words``) has the dictionary words within a text's candidates where ``words`` has not all."""

    forest: Forest
    words: frozenset[str]
    by_text: DataFrame | None = None

    def scan(self, text: str, source: str = "", words: list[str] | None = None) -> list[dict]:
        if not hinted(text):
            return []
        found = list(candidates(text, source))
        if not found:
            return []
        known = self.words if words is None else Dictionary(COMMON.union(words))
        chances = self.forest(np.array([describe(f, known) for f in found]))
        return [
            {"kind": f.kind, "start": f.start, "length": len(f.value), "chance": round(float(p), 6), "secret": bool(p >= THRESHOLD)}
            for f, p in zip(found, chances, strict=True)
        ]


def fit(rows: list[tuple[Finding, int]], words: frozenset[str]) -> Scanner:
    return Scanner(Forest(np.array([describe(f, words) for f, _ in rows]), np.array([float(y) for _, y in rows])), words)


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = TRAINING_TEXTS,
    findings: list[tuple[Finding, int]] | None = None,
    at_once: int = DICTIONARY_WORDS,
) -> Scanner:
    """A scanner with the dictionary of all texts; its labelled findings use ``sample`` texts at most (least hash of the id)."""
    spark, text = docs.sparkSession, col(text_col).cast("string")
    texts = sampled_texts(docs, id_col, text_col, sample)
    labelled = findings or labelled_findings(texts)
    table = dictionary(docs, text_col)
    lengths = sorted(n for (n,) in table.select(F.length("_word")).distinct().collect())
    mine = {w for one, _ in labelled for w in stretches(one.value, lengths)}
    mine |= {w for t in texts for w in re.findall(r"[^\W\d_]{4,}", t.lower())}
    asked = spark.createDataFrame([(w,) for w in sorted(mine)], "_word string")
    base = [w for (w,) in table.join(asked, "_word", "left_semi").collect()]
    scanner = fit(labelled, Dictionary(COMMON.union(base)))
    coded = small_batches(docs).select(F.xxhash64(text).alias("_code"), text.alias("_text"))
    parts = coded.mapInArrow(_stretched(lengths), "_code bigint, _word string").distinct()
    known = checkpointed(parts.join(table, "_word"))
    words = known.select("_word").distinct()
    if words.count() <= at_once:
        return replace(scanner, words=Dictionary(scanner.words.union(w for (w,) in words.collect())))
    return replace(scanner, by_text=known.groupBy("_code").agg(F.collect_set("_word").alias("_words")))


FOUND = "array<struct<kind:string,start:bigint,length:bigint,chance:double,secret:boolean>>"


def finder(scanner: Scanner):
    """Column function: text, source, words -> all candidates with their chance to be a secret.

    ``words`` are the dictionary words of the text's candidates; null for those that the scanner has.
    """
    scanner = replace(scanner, by_text=None)
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("chance", pa.float64()), ("secret", pa.bool_())])
    )

    @F.arrow_udf(FOUND)
    def find(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, sources, words in batches:
            _, offsets = utf8(texts)
            out: list[list] = []
            for lo, hi in slices(offsets, offsets):
                part = zip(*(a.slice(lo, hi - lo).to_pylist() for a in (texts, sources, words)), strict=True)
                out += [scanner.scan(t or "", s or "", w) for t, s, w in part]
            yield pa.array(out, kind)

    return find


def findings(docs: DataFrame, scanner: Scanner, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``_row, found`` for every row, ``_row`` holding the input columns.

    ``found`` lists all candidates of the whole text with position, length and chance,
    and whether they count as secrets. Null and empty texts have none; a null source
    is an empty path; repeated rows get equal findings; an empty table gives no rows.
    """
    field = F.col("_row").getField
    rows = packed(docs)
    text = field(text_col).cast("string")
    words = F.lit(None).cast("array<string>")
    if scanner.by_text is None:
        rows = rows.withColumn("_words", words)
    else:
        # Only texts that may have candidates meet the words; the others stay in place.
        hint = F.coalesce(text.rlike(_HINT.pattern.replace("(?i:", "(?iu:")), F.lit(False))
        some = rows.where(hint).withColumn("_code", F.xxhash64(text)).join(scanner.by_text, "_code", "left")
        some = some.select("_row", F.coalesce("_words", F.array().cast("array<string>")).alias("_words"))
        rows = some.unionByName(rows.where(~hint).withColumn("_words", words))
    return rows.select("_row", finder(scanner)(text, field(source_col).cast("string"), F.col("_words")).alias("found"))
