"""Byte-level BPE encoding and decoding with the tiktoken library (operator 12).

A rank file gives the merges; the library splits a text by the pattern and merges
the bytes of every match separately. A text of more than ``LONG`` characters is
handed to it in stretches that end where no match can reach across, so its regular
expression never runs over an unbounded text. Such places are

* between a character that is no white space and white space,
* between letters, digits and other signs, but for an apostrophe before a letter
  (``'s`` is one match),
* before the last white space of a run, if something else follows the run.

They hold for patterns whose matches are made of one kind of characters each, with
one space before them, like the public one (``PATTERN``). A run of one kind longer
than ``LONG`` stays whole, as the merges of a match cannot be cut.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from rollcall.llm.common import packed

LONG = 200_000

_GAP = regex.compile(r"(?<=\P{White_Space})(?=[ \n\t\r])")
_OTHER = r"[^\p{White_Space}\p{L}\p{N}\p{Cn}]"
_KIND = regex.compile(
    r"(?<=\P{White_Space})(?=\p{White_Space})"
    r"|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})"
    rf"|(?<=[\p{{L}}\p{{N}}])(?={_OTHER})|(?<={_OTHER}(?<!'))(?=[\p{{L}}\p{{N}}])"
    r"|(?<=\p{White_Space})(?=\p{White_Space}\P{White_Space})"
)


class Ranks:
    """A rank file and the pattern that splits texts; travels with the job."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.lines = file.read()
        self.pattern = pattern

    def library(self) -> tiktoken.Encoding:
        pairs = (line.split() for line in self.lines.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})


def stretches(text: str, limit: int = LONG) -> Iterator[str]:
    """Parts of a text whose ids are the text's ids when put behind one another."""
    begin, least = 0, max(1, limit // 2)
    while len(text) - begin > limit:
        # A gap between words is found at once; the kinds of characters are looked at only without one.
        near = _GAP.search(text, begin + least, begin + limit + 1) or _KIND.search(text, begin + least)
        if near is None or near.start() >= len(text):
            break
        yield text[begin : near.start()]
        begin = near.start()
    yield text[begin:]


def encode(text: str, library: tiktoken.Encoding, limit: int = LONG) -> np.ndarray:
    """Ids of a whole text."""
    if len(text) <= limit:
        return library.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([library.encode_to_numpy(part, disallowed_special=()) for part in stretches(text, limit)])


def encoder(ranks: Ranks):
    """Column function: text -> ids, null for null."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = ranks.library()
        for batch in batches:
            parts = [encode(text or "", library) for text in batch.to_pylist()]
            cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint32), *parts]).view(np.int32)
            mask = np.append(batch.is_null().to_numpy(zero_copy_only=False), False)
            yield pa.ListArray.from_arrays(pa.array(cuts, mask=mask), pa.array(flat))

    return run


def _rows(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    counts = lists.value_lengths().fill_null(0).to_numpy()
    return lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(counts)])


def decoder(ranks: Ranks):
    """Column function: ids -> raw bytes, which need not be valid text. An unknown id fails the job."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = ranks.library()
        for lists in batches:
            ids, cuts = _rows(lists)
            raw = [library.decode_bytes(ids[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.array(raw, pa.binary(), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return run


@F.arrow_udf(BinaryType())
def little_endian(lists: pa.Array) -> pa.Array:
    """Column function: ids -> their unsigned 32-bit little-endian bytes."""
    ids, cuts = _rows(lists)
    data = pa.py_buffer(np.ascontiguousarray(ids, "<i4"))
    where = pa.array((cuts * 4).astype(np.int32)).buffers()[1]
    plain = pa.Array.from_buffers(pa.binary(), len(lists), [None, where, data])
    return pc.if_else(lists.is_null(), pa.scalar(None, pa.binary()), plain) if lists.null_count else plain


def encoded(docs: DataFrame, ranks: Ranks, text_col: str = "text") -> DataFrame:
    """``_row, ids`` for every row, ``_row`` holding the input columns.

    A null text counts as empty: no ids. Repeated rows get equal ids, an empty table
    gives no rows, and texts of any length are encoded whole.
    """
    rows = packed(docs)
    text = F.coalesce(F.col("_row").getField(text_col).cast("string"), F.lit(""))
    return rows.select("_row", encoder(ranks)(text).alias("ids"))
