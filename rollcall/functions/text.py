"""Secret masking and run-log scraping over text columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as a credential in a query string, and the two
# kinds of line a transform run prints. The flags make white space mean any
# Unicode white space, and only a line feed end a line.
SECRET_PATTERN = r"(?iU)((?:access_token|secret|token)=)[^&\s'\"]+"
MASK = "***"
MIN_SECRET_LENGTH = 8
SUMMARY_PATTERN = r"(?mdU)^Done\. PASS=\d+ WARN=\d+ ERROR=\d+ SKIP=\d+.*TOTAL=\d+"
FAILURE_PATTERN = r"(?mdU)^Failure in test \S+.*$"


def redact(text: Column, known: Iterable[str] = ()) -> Column:
    """Mask credentials in query strings and any known secret of eight characters or more."""
    out = F.regexp_replace(text, SECRET_PATTERN, "$1***")
    for value in known:
        value = value.strip()
        if len(value) >= MIN_SECRET_LENGTH:
            out = F.replace(out, F.lit(value), F.lit(MASK))
    return out


def redact_columns(df: DataFrame, columns: Iterable[str], known: Iterable[str] = ()) -> DataFrame:
    known = list(known)
    return df.withColumns({c: redact(F.col(c), known) for c in columns})


def run_summary(text: Column) -> Column:
    """The closing summary line of a run log, empty when there is none."""
    return F.regexp_extract(text, SUMMARY_PATTERN, 0)


def run_failures(text: Column) -> Column:
    """All failure lines of a run log, one per line."""
    return F.array_join(F.regexp_extract_all(text, F.lit(FAILURE_PATTERN), F.lit(0)), "\n")
