"""Clean-up of nested values: the schema tells which parts of a value to rewrite.

A value is any mix of objects (struct or map), lists and scalars. The rewriting is built once from
the type and runs as one expression; a part that cannot hold what is looked for is not touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertweave.functions.scalars import UNSAFE_KEY_STARTS, strip_nul


def _holds(kind: T.DataType, test: Callable[[T.DataType], bool]) -> bool:
    if test(kind):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds(kind.elementType, test)
    if isinstance(kind, T.MapType):
        return _holds(kind.keyType, test) or _holds(kind.valueType, test)
    if isinstance(kind, T.StructType):
        return any(_holds(f.dataType, test) for f in kind)
    return False


def _text(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType)


def _unsafe(name: str) -> bool:
    return name.startswith(tuple(UNSAFE_KEY_STARTS))


def _names(kind: T.DataType) -> bool:
    """Objects whose names may be unsafe: maps by text, structs with such a field."""
    if isinstance(kind, T.MapType):
        return _text(kind.keyType)
    return isinstance(kind, T.StructType) and any(_unsafe(f.name) for f in kind)


def strip_nul_deep(col: Column, kind: T.DataType) -> Column:
    """NUL characters taken out of every text of a value, at any depth.

    Null parts stay null. Names of map entries stay as they are, as they do at the top level.
    """
    if _text(kind):
        return strip_nul(col)
    if isinstance(kind, T.ArrayType) and _holds(kind, _text):
        return F.transform(col, lambda x: strip_nul_deep(x, kind.elementType))
    if isinstance(kind, T.MapType) and _holds(kind.valueType, _text):
        return F.transform_values(col, lambda key_, x: strip_nul_deep(x, kind.valueType))
    if isinstance(kind, T.StructType) and _holds(kind, _text):
        parts = [
            strip_nul_deep(col.getField(f.name), f.dataType).alias(f.name) for f in kind
        ]
        return F.when(col.isNotNull(), F.struct(*parts))
    return col


def drop_unsafe_keys_deep(col: Column, kind: T.DataType) -> Column:
    """Entries and fields with unsafe names left out of every object of a value, at any depth.

    Null parts stay null. A struct all of whose fields are unsafe becomes a struct with the one
    field ``_empty``, null, since a struct needs a field.
    """
    if not _holds(kind, _names):
        return col
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: drop_unsafe_keys_deep(x, kind.elementType))
    if isinstance(kind, T.MapType):
        kept = col
        if _text(kind.keyType):
            kept = F.map_filter(
                col, lambda key_, x: ~F.substring(key_, 1, 1).isin(*UNSAFE_KEY_STARTS)
            )
        if not _holds(kind.valueType, _names):
            return kept
        return F.transform_values(kept, lambda key_, x: drop_unsafe_keys_deep(x, kind.valueType))
    parts = [
        drop_unsafe_keys_deep(col.getField(f.name), f.dataType).alias(f.name)
        for f in kind
        if not _unsafe(f.name)
    ]
    return F.when(col.isNotNull(), F.struct(*parts or [F.lit(None).alias("_empty")]))
