"""Which lookup rows match which values, without comparing every value with every cell.

A cell is a regular expression to be found in a value, the value itself, or the wildcard. Texts
that every match of an expression holds are read from it, and cut into grams. Cells and values
meet by equality of one gram, the one of the cell that the fewest values hold, and only then is
the expression tried. A cell without such a text has the empty gram, which every value holds. A
cell that is no valid expression matches the value that equals it, and nothing else.

A row matches by its cells that are no wildcards, so rows are grouped by which of their cells are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertweave.operators.lineage import cut

WILDCARD = "*"
GRAM = 3
SPECIAL = frozenset(".^$*+?{}[]\\|()")


def required_texts(pattern: str) -> list[str]:
    """Texts that every match of a pattern holds; none if that cannot be told simply."""
    out, run = [], []
    depth, i = 0, 0

    def close() -> None:
        if run and not depth:
            out.append("".join(run))
        run.clear()

    while i < len(pattern):
        c = pattern[i]
        if c == "|" and not depth:
            return []
        if c == "(":
            if re.match(r"\(\?[a-zA-Z]*[-a-zA-Z]+[:)]", pattern[i:]) and not pattern.startswith("(?P", i):
                return []
            close()
            depth += 1
        elif c == ")":
            run.clear()
            depth -= 1
        elif c == "[":
            close()
            i += 2 if pattern.startswith("^", i + 1) else 1
            # a bracket that comes first is a member
            i += 1
            while i < len(pattern) and pattern[i] != "]":
                i += 2 if pattern[i] == "\\" else 1
        elif c in "*?{":
            if run:
                run.pop()
            close()
            if c == "{":
                i = max(i, pattern.find("}", i))
        elif c == "\\":
            i += 1
            if i < len(pattern) and not pattern[i].isalnum():
                run.append(pattern[i])
            else:
                close()
                # numbers and names that belong to the escape
                while i + 1 < len(pattern) and pattern[i + 1].isalnum():
                    i += 1
        elif c in SPECIAL:
            close()
        else:
            run.append(c)
        i += 1
    close()
    return [text for text in out if text]


def cell_grams(cell: str) -> set[str]:
    """Grams that a value must hold to match the cell; the empty one if there are none."""
    texts = required_texts(cell)
    long = {t[i : i + GRAM] for t in texts for i in range(len(t) - GRAM + 1)}
    return long or set(sorted(texts, key=len)[-1:]) or {""}


def value_grams(value: str) -> set[str]:
    return {value[i : i + n] for n in range(GRAM + 1) for i in range(len(value) - n + 1)}


@lru_cache(maxsize=4096)
def compiled(cell: str) -> re.Pattern | None:
    try:
        return re.compile(cell)
    except (re.error, OverflowError, RecursionError):
        return None


def _grams(texts: DataFrame, name: str, grams_of) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                grams = sorted(grams_of(text))
                columns = [pa.array([text] * len(grams), pa.string()), pa.array(grams, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [name, "gram"])

    return texts.select(name).mapInArrow(run, f"{name} string, gram string")


def _searched(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("value").to_pylist(), batch.column("cell").to_pylist(), strict=True)
            hits = [(p := compiled(cell)) is not None and p.search(value) is not None for value, cell in both]
            yield batch.filter(pa.array(hits, pa.bool_()))

    return pairs.select("value", "cell").mapInArrow(run, "value string, cell string")


def matching_pairs(values: DataFrame, cells: DataFrame) -> DataFrame:
    """``value`` and ``cell`` that match; both come distinct and not null, without wildcards."""
    wanted = cut(_grams(cells, "cell", cell_grams))
    held = _grams(values, "value", value_grams).join(wanted.select("gram").distinct(), "gram", "left_semi")
    held = cut(held)
    often = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rare = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best")
    chosen = wanted.join(often, "gram", "left").groupBy("cell").agg(rare).select("cell", "best.gram")
    found = _searched(held.join(chosen, "gram"))
    equal = values.join(cells, F.col("value") == F.col("cell")).select("value", "cell")
    return found.unionByName(equal).distinct()


def _key(text: Column) -> Column:
    """A text that is never null and stands for a text or null."""
    return F.coalesce(F.concat(F.lit("="), text), F.lit(""))


def _pairs_of(values: DataFrame, rows: DataFrame, attr: str) -> DataFrame:
    """Keys of the values and cells of one attribute that match; null matches null."""
    value = values.select(F.col(f"_m_{attr}").alias("value")).filter("value is not null").distinct()
    cell = rows.select(F.col(f"_c_{attr}").alias("cell")).filter("cell is not null").distinct()
    pairs = matching_pairs(value, cell.filter(F.col("cell") != WILDCARD))
    nulls = values.sparkSession.range(1).select(_key(F.lit(None)).alias("value"), _key(F.lit(None)).alias("cell"))
    pairs = pairs.select(_key(F.col("value")).alias("value"), _key(F.col("cell")).alias("cell"))
    return cut(pairs.unionByName(nulls).toDF(f"_v_{attr}", f"_x_{attr}"))


def first_rows(values: DataFrame, rows: DataFrame, matchers: list[list[str]]) -> DataFrame:
    """The columns of ``values`` with ``row_idx``, the least row that a matcher accepts.

    ``values`` has distinct ``_m_<attribute>``, ``rows`` has ``row_idx`` and ``_c_<attribute>``.
    A matcher accepts a row if all of its attributes match.
    """
    matchers = [[a.strip() for a in m] for m in matchers]
    attrs = list(dict.fromkeys(a for m in matchers for a in m))
    names = values.columns
    pairs = {a: _pairs_of(values, rows, a) for a in attrs}
    keyed = values.withColumns({f"_v_{a}": _key(F.col(f"_m_{a}")) for a in attrs})
    wild = {a: F.coalesce(F.col(f"_c_{a}") == WILDCARD, F.lit(False)) for a in attrs}
    hits = []
    for matcher in matchers:
        kinds = rows.select(*[wild[a].alias(a) for a in matcher]).distinct().collect()
        for kind in sorted(kinds):
            free = [a for a, is_wild in zip(matcher, kind, strict=True) if not is_wild]
            held = rows.filter(reduce(lambda x, y: x & y, [wild[a] == w for a, w in zip(matcher, kind, strict=True)]))
            if not free:
                least = held.agg(F.min("row_idx")).first()[0]
                hits.append(keyed.select(*names, F.lit(least).cast(rows.schema["row_idx"].dataType).alias("row_idx")))
                continue
            held = held.select("row_idx", *[_key(F.col(f"_c_{a}")).alias(f"_x_{a}") for a in free])
            cells = [f"_x_{a}" for a in free]
            held = held.groupBy(*cells).agg(F.min("row_idx").alias("row_idx"))
            owners = [f"_v_{a}" for a in free]
            met = keyed.select(*owners).distinct().join(pairs[free[0]], f"_v_{free[0]}").join(held, f"_x_{free[0]}")
            if len(free) > 1:
                # both sides know the other cells; the pairs tell if they match
                for a in free[1:]:
                    met = met.join(pairs[a], [f"_v_{a}", f"_x_{a}"], "left_semi")
            least = met.groupBy(*owners).agg(F.min("row_idx").alias("row_idx"))
            hits.append(keyed.join(least, owners).select(*names, "row_idx"))
    if not hits:
        return values.withColumn("row_idx", F.lit(None).cast(rows.schema["row_idx"].dataType)).limit(0)
    return reduce(DataFrame.unionByName, hits).groupBy(*names).agg(F.min("row_idx").alias("row_idx"))
