"""Rows as documents: a schema and a configuration are compiled once into one projection.

A document is a map from field names to arrays of texts. Columns whose names begin with a dropped prefix are never
selected, so Spark doesn't read them; the others are renamed, encoded by type, and left out where they are null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.encode import LAKE, Policy, text_of, values_of

DOC_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def dropped(name: str, prefixes: Sequence[str] | None) -> bool:
    """Whether a source name begins with any of the prefixes; case counts."""
    return any(name.startswith(p) for p in prefixes or ())


def quote(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


@dataclass(frozen=True)
class Projection:
    """What a source's columns become. ``fields`` holds (target, value column), a target once."""

    fields: list[tuple[str, Column]] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.fields]

    def document(self) -> Column:
        """The document; empty where every field is null."""
        if not self.fields:
            return F.create_map().cast(DOC_TYPE)
        entries = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in self.fields]), F.array(*[c for _, c in self.fields]))
        return F.map_filter(entries, lambda _, v: v.isNotNull())


def compile_projection(
    schema: T.StructType | None,
    rename: Mapping[str, str] | None = None,
    drop_prefixes: Sequence[str] | None = None,
    policy: Policy = LAKE,
    meta: Sequence[str] = (),
) -> Projection:
    """The projection of a schema. Dropping looks at source names and comes before renaming; columns in ``meta`` are no fields.

    Several sources of one target: the last in schema order that isn't null counts. Columns of types without text are left out.
    """
    if schema is None:
        raise ValueError("a projection needs a schema")
    found: dict[str, list[Column]] = {}

    def add(name: str, c: Column, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType) and policy.structs == "flatten":
            for inner in kind.fields:
                add(f"{name}_{inner.name}", c.getField(inner.name), inner.dataType)
            return
        values = values_of(c, kind, policy)
        if values is not None:
            found.setdefault(name, []).append(values)

    for f in schema.fields:
        if f.name not in meta and not dropped(f.name, drop_prefixes):
            add((rename or {}).get(f.name, f.name), F.col(quote(f.name)), f.dataType)
    return Projection([(n, cs[0] if len(cs) == 1 else F.coalesce(*reversed(cs))) for n, cs in found.items()])


def documents(rows: DataFrame, keep: Sequence[str] = (), **options) -> DataFrame:
    """``rows`` as a column ``doc``, beside the columns in ``keep``; options as for compile_projection."""
    projection = compile_projection(rows.schema, **options)
    return rows.select(*[F.col(quote(k)) for k in keep], projection.document().alias("doc"))


def flattened(schema: T.StructType, prefix: str = "") -> list[tuple[str, str, T.DataType]]:
    """(flat name, path, type) of all leaves, names joined with ``_``."""
    out = []
    for f in schema.fields:
        path = f"{prefix}.{quote(f.name)}" if prefix else quote(f.name)
        if isinstance(f.dataType, T.StructType):
            out += [(f"{f.name}_{n}", p, k) for n, p, k in flattened(f.dataType, path)]
        else:
            out.append((f.name, path, f.dataType))
    return out


def flatten(rows: DataFrame) -> DataFrame:
    """Nested records as flat columns; of equal names the last that isn't null counts, as text if their types differ."""
    found: dict[str, list[tuple[Column, T.DataType]]] = {}
    for name, path, kind in flattened(rows.schema):
        found.setdefault(name, []).append((F.col(path), kind))

    def one(sources: list[tuple[Column, T.DataType]]) -> Column:
        mixed = len({k.simpleString() for _, k in sources}) > 1
        return F.coalesce(*[text_of(c, k) if mixed else c for c, k in reversed(sources)])

    return rows.select(*[one(cs).alias(n) for n, cs in found.items()])
