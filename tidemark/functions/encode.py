"""Values as document strings: one encoder for each type, picked from the schema before any row is read.

Each returns a string Column that is null where the value is null; nulls never become document fields.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Policy:
    """How nested values are written.

    arrays: ``json`` (one JSON array) or ``multi`` (one value for each element that isn't null).
    structs: ``json`` (one JSON object), ``placeholder`` (a fixed text) or ``flatten`` (a field for each leaf).
    """

    arrays: str = "json"
    structs: str = "json"

    def __post_init__(self) -> None:
        if self.arrays not in ("json", "multi") or self.structs not in ("json", "placeholder", "flatten"):
            raise ValueError(f"unknown policy {self}")


#: Rows of a lake table, and records of a topic.
LAKE = Policy("json", "json")
STRICT_LAKE = Policy("json", "placeholder")
TOPIC = Policy("multi", "flatten")

#: Fixed value.
PLACEHOLDER = '{"nested":"row"}'


def base64_text(c: Column) -> Column:
    """Base64 without the line breaks that Spark puts in."""
    return F.regexp_replace(F.base64(c), "[\r\n]", "")


def escape(c: Column) -> Column:
    """JSON escapes for backslash, quote, line feed, carriage return and tab; other characters stay."""
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), escape(c), F.lit('"'))


def epoch_millis(c: Column, kind: T.DataType) -> Column:
    """Milliseconds since 1970, whatever the session's time zone; fractions are cut off downwards."""
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(c)
    # Both ends are without a zone, so none is applied.
    return F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c) / F.lit(1000)).cast("long")


def scalar(c: Column, kind: T.DataType) -> Column | None:
    """A value of a type without parts as text; None for types that have no text."""
    if isinstance(kind, T.BinaryType):
        return base64_text(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return epoch_millis(c, kind).cast("string")
    if isinstance(kind, (T.BooleanType, T.NumericType, T.StringType, T.CharType, T.VarcharType)):
        return c.cast("string")
    return None


def json_element(c: Column, kind: T.DataType) -> Column:
    """A value inside a JSON array: numbers and booleans bare, all else quoted, nested values as JSON."""
    if isinstance(kind, T.ArrayType):
        return json_array(c, kind)
    if isinstance(kind, T.MapType):
        return json_map(c, kind)
    if isinstance(kind, T.StructType):
        return F.to_json(c)
    if isinstance(kind, (T.BooleanType, T.NumericType)):
        return c.cast("string")
    text = scalar(c, kind)
    return quoted(c.cast("string") if text is None else text)


def json_array(c: Column, kind: T.ArrayType) -> Column:
    """``[1,2,null]``, without blanks."""
    inside = F.transform(c, lambda x: F.coalesce(json_element(x, kind.elementType), F.lit("null")))
    return F.concat(F.lit("["), F.array_join(inside, ","), F.lit("]"))


def json_map(c: Column, kind: T.MapType) -> Column:
    """``{"k":"v"}`` with keys and values quoted and keys in order; nested values are JSON, nulls are ``null``."""

    def pair(e: Column) -> Column:
        value = e["value"]
        if isinstance(kind.valueType, (T.ArrayType, T.MapType, T.StructType)):
            text = json_element(value, kind.valueType)
        else:
            text = quoted(scalar(value, kind.valueType))
        return F.concat(quoted(scalar(e["key"], kind.keyType)), F.lit(":"), F.coalesce(text, F.lit("null")))

    return F.concat(F.lit("{"), F.array_join(F.array_sort(F.transform(F.map_entries(c), pair)), ","), F.lit("}"))


def multi_values(c: Column, kind: T.ArrayType) -> Column:
    """Texts of the elements that aren't null, as an array; null where none is left. Records become JSON."""
    texts = F.transform(F.filter(c, lambda x: x.isNotNull()), lambda x: text_of(x, kind.elementType))
    return F.when(F.size(texts) > 0, texts)


def text_of(c: Column, kind: T.DataType, policy: Policy = LAKE) -> Column | None:
    """A value as one text; None for types that have none."""
    if isinstance(kind, T.ArrayType):
        return json_array(c, kind)
    if isinstance(kind, T.MapType):
        return json_map(c, kind)
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.lit(PLACEHOLDER)) if policy.structs == "placeholder" else F.to_json(c)
    return scalar(c, kind)


def values_of(c: Column, kind: T.DataType, policy: Policy = LAKE) -> Column | None:
    """A value as a document field: an array of texts, null where there is none."""
    if isinstance(kind, T.ArrayType) and policy.arrays == "multi":
        return multi_values(c, kind)
    text = text_of(c, kind, policy)
    return None if text is None else F.when(text.isNotNull(), F.array(text))


#: Types that an id may have.
ID_TYPES = (T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.StringType, T.CharType, T.VarcharType)


def id_text(c: Column, kind: T.DataType, name: str = "id", on_null: str = "fail") -> Column:
    """An id as text. Other types are refused; a null fails the query, or stays null where ``on_null`` is ``keep``."""
    if not isinstance(kind, ID_TYPES):
        raise TypeError(f"'{name}' of type {kind.simpleString()} can't be an id")
    text = c.cast("string")
    return text if on_null == "keep" else F.coalesce(text, F.raise_error(F.lit(f"'{name}' is null in a row that needs an id")).cast("string"))


def megabytes(c: Column) -> Column:
    """Bytes as MB of 2**20, two decimals."""
    return F.round(c / F.lit(1048576.0), 2)


def non_null_branch(branches: list[str]) -> str:
    """The branch of a union that decides its type: the first that isn't null."""
    found = next((b for b in branches if b != "null"), None)
    if found is None:
        raise ValueError("a union of null alone has no type")
    return found
