"""Reading landed JSON once per record, as columns.

``from_json`` turns a record into a struct of strings in one pass. Two rules of
the source format need care on top of it:

* a scalar accessor yields NULL for an object or an array, while ``from_json``
  hands back the JSON text of such a value;
* JSON ``null`` is a value, not an absent key. Fields read as ``variant`` keep
  that difference, and their text form is ``'null'``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def record_struct(
    record: Column,
    scalars: Iterable[str],
    documents: Iterable[str] = (),
    arrays: Iterable[str] = (),
) -> Column:
    """Parse ``record`` to a struct: ``scalars`` as text, ``documents`` as variant.

    ``arrays`` come as the texts of their elements, cut out of the record; any other
    value under such a key is NULL. Writing a variant out as text takes far longer.
    """
    fields = [T.StructField(k, T.StringType()) for k in scalars]
    fields += [T.StructField(k, T.VariantType()) for k in documents]
    fields += [T.StructField(k, T.ArrayType(T.StringType())) for k in arrays]
    return F.from_json(record, T.StructType(fields))


def parse_once(df: DataFrame, parsed: Column, out: str) -> DataFrame:
    """Add a parsed record that later filters read but do not parse again.

    A filter on a plain column would move below it and carry a second copy of
    the parsing along; it stays above a generator.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(out))


def present_or_null(items: Column) -> Column:
    """Elements to explode so that NULL drops the parent and ``[]`` keeps it once."""
    empty = F.array(F.lit(None).cast("string"))
    return F.when(F.size(items) == 0, empty).otherwise(items)


def scalar_sql(parsed: str, key: str, record: str) -> str:
    """SQL for the text of a scalar field; NULL for missing, JSON null, object and array.

    Only text that opens and ends like a container can be one (it is cut out of the
    record as it stands there). That is rare, so only then is the record read again
    to tell a quoted string from a real container.
    """
    text = f"{parsed}.`{key}`"
    value = f"try_variant_get(try_parse_json({record}), '$.{key}', 'variant')"
    ends = lambda left, right: f"startswith({text}, '{left}') AND endswith({text}, '{right}')"
    return (
        f"CASE WHEN ({ends('{', '}')}) OR ({ends('[', ']')}) "
        f"THEN CASE WHEN schema_of_variant({value}) = 'STRING' THEN {text} END ELSE {text} END"
    )


def scalar(parsed: str, key: str, record: str) -> Column:
    """:func:`scalar_sql` as a column."""
    return F.expr(scalar_sql(parsed, key, record))


def array_sql(parsed: str, key: str, record: str) -> str:
    """SQL for the JSON text of a field that mostly holds an array, as :func:`document` has it.

    The array is cut out of the record, with its keys in the order they have there, unlike a
    written variant, which costs several times the parsing. The record is read again as a
    variant for what the cut text does not show: JSON null, a string that looks like an array,
    any other value, and numbers a variant writes in another form.
    """
    text = f"{parsed}.`{key}`"
    has = lambda part: f"contains({record}, r'{part}')"
    quoted = f'"{key}"'
    absent = f"{text} IS NULL AND NOT {has(quoted)} AND NOT {has(chr(92) + 'u')}"
    odd_number = r"[:,\[](-0|-?[0-9]+[.eE]|-?[0-9]{19})"
    plain = f"startswith({text}, '[') AND {has(quoted + ':[')} AND NOT {has(quoted + ':' + chr(34))}"
    plain = f"{plain} AND ({text} = '[]' OR NOT {text} RLIKE r'{odd_number}')"
    written = f"to_json(from_json({record}, '`{key}` VARIANT').`{key}`)"
    return f"CASE WHEN {absent} THEN NULL WHEN {plain} THEN {text} ELSE {written} END"


def document(value: Column) -> Column:
    """JSON text of a variant field: NULL when the key is missing, ``'null'`` for JSON null."""
    return F.to_json(value)


def elements(json_text: Column) -> Column:
    """Array elements as JSON text; NULL when the value is not an array."""
    return F.from_json(json_text, "array<string>")


def variant_elements(value: Column) -> Column:
    """As :func:`elements`, for a variant field."""
    return F.try_variant_get(value, "$", "array<string>")


def envelope_records(raw: Column) -> Column:
    """Records of ``{"data": [...]}`` as JSON text."""
    return F.from_json(raw, "data array<string>").getField("data")


def has_items(json_text: Column) -> Column:
    """True unless the key is missing or the array is empty (JSON null counts as present)."""
    return json_text.isNotNull() & (json_text != "[]")
