"""User paths to Columns: dotted paths, JSON and map access, field maps."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: a segment is bracketed text or text without a dot
SEGMENT = re.compile(r"\[([^\[\]]+)\]|([^.]+)")
ESCAPED_DOT = "@@"


def split_path(path: str) -> list[str]:
    """``a.[b.c].d`` gives a, b.c, d; ``@@`` inside a segment is a literal dot."""
    return [(m[0] or m[1]).replace(ESCAPED_DOT, ".") for m in SEGMENT.findall(path)]


def json_path(parts: list[str]) -> str:
    return "$" + "".join(f"['{p}']" for p in parts)


def json_text(col: Column, path: str) -> Column:
    """Value at a path of a JSON text, as text."""
    return F.get_json_object(col, json_path(split_path(path)))


def json_has(col: Column, path: str) -> Column:
    """Whether the path exists, also when the value there is a JSON null."""
    *parent, leaf = split_path(path)
    holder = F.get_json_object(col, json_path(parent)) if parent else col
    keys = F.json_object_keys(holder)
    return F.coalesce(F.array_contains(keys, F.lit(leaf)), F.lit(False))


def map_text_at(col: Column, path: str) -> Column:
    """Value at a path of a string map; deeper segments read the value as JSON."""
    first, *rest = split_path(path)
    value = F.try_element_at(col, F.lit(first))
    return F.get_json_object(value, json_path(rest)) if rest else value


def first_source(col: Column) -> Column:
    """The list of sources reads as its first element."""
    return F.get(col, 0)


@dataclass(frozen=True)
class Json:
    """Target inside a JSON column; without ``path`` the wildcard part of the user path."""

    column: str
    path: str | None = None

    def value(self, rest: str) -> Column:
        return json_text(F.col(self.column), self.path or rest)

    def exists(self, rest: str) -> Column:
        return json_has(F.col(self.column), self.path or rest)


@dataclass(frozen=True)
class MapKey:
    """Target inside a map column."""

    column: str
    path: str | None = None

    def value(self, rest: str) -> Column:
        return map_text_at(F.col(self.column), self.path or rest)

    def exists(self, rest: str) -> Column:
        key = split_path(self.path or rest)[0]
        return F.coalesce(F.map_contains_key(F.col(self.column), F.lit(key)), F.lit(False))


@dataclass(frozen=True)
class Plain:
    """A typed top-level column."""

    column: str

    def value(self, rest: str) -> Column:
        return F.col(self.column)

    def exists(self, rest: str) -> Column:
        return F.lit(True)


Target = Json | MapKey | Plain


class FieldMap:
    """User field names to columns: exact names first, then wildcards in given order.

    Several targets are tried in order, the first non-null value wins.
    """

    def __init__(self, fields: dict[str, list[Target]]):
        self.fields = fields

    def find(self, path: str) -> tuple[list[Target], str] | None:
        if path in self.fields:
            return self.fields[path], path
        for pattern, targets in self.fields.items():
            if "*" in pattern and fnmatchcase(path, pattern):
                return targets, path[pattern.index("*"):]
        return None

    def knows(self, path: str) -> bool:
        return self.find(path) is not None

    def resolve(self, path: str) -> Column | None:
        found = self.find(path)
        if found is None:
            return None
        targets, rest = found
        return F.coalesce(*[t.value(rest) for t in targets])

    def has(self, path: str) -> Column:
        found = self.find(path)
        if found is None:
            return F.lit(False)
        targets, rest = found
        present = F.lit(False)
        for target in targets:
            present = present | target.exists(rest)
        return present

    def where(self, path: str, test: Callable[[Column], Column]) -> Column:
        """``test`` on the resolved field; an unknown field selects nothing."""
        col = self.resolve(path)
        return F.lit(False) if col is None else test(col)

    def remap(self, rules: dict[str, str]) -> "FieldMap":
        """Retarget columns: old column name to new one; the user names stay."""
        def moved(target: Target) -> Target:
            new = rules.get(target.column, target.column)
            if isinstance(target, Plain):
                return Plain(new)
            return type(target)(new, target.path)

        return FieldMap({k: [moved(t) for t in ts] for k, ts in self.fields.items()})
