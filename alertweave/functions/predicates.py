"""Boolean Columns for filters and rules. Nulls follow SQL unless stated."""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime
from functools import reduce
from threading import RLock

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertweave.functions.scalars import SEVERITIES, severity_rank

# held while the session analyses stored predicates
_ANALYSIS = RLock()

OPS = {
    "=": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def and_(*parts: Column) -> Column:
    return reduce(operator.and_, parts)


def or_(*parts: Column) -> Column:
    return reduce(operator.or_, parts)


def not_(part: Column) -> Column:
    return ~part


def to_bool(text: Column) -> Column:
    """true/false words, a number is true from 1 on, other non-blank text is true."""
    low = F.lower(text)
    number = F.when(text.rlike(r"^[-+]?[0-9]*\.?[0-9]+$"), text.try_cast("double"))
    return (
        F.when(low == "true", True)
        .when(low == "false", False)
        .when(number.isNotNull(), number >= 1)
        .when(low != "", True)
        .otherwise(False)
    )


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def to_ts(text: Column) -> Column:
    return F.try_to_timestamp(text)


def to_uuid(text: Column) -> Column:
    """Canonical lower-case dashed form of dashed or plain hex; null otherwise."""
    hexes = F.lower(F.replace(text, F.lit("-"), F.lit("")))
    dashed = F.regexp_replace(hexes, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(hexes.rlike("^[0-9a-f]{32}$"), dashed)


def literal(value: object) -> Column:
    """Type a user literal: ISO dates and times become timestamps, numeric-looking text
    stays text, escaped quotes are unescaped."""
    if not isinstance(value, str):
        return F.lit(value)
    text = value.replace("\\'", "'").replace('\\"', '"')
    if re.match(r"^\d{4}-\d{2}-\d{2}", text):
        try:
            datetime.fromisoformat(text)
        except ValueError:
            return F.lit(text)
        return F.lit(text).cast("timestamp")
    return F.lit(text)


def typed(col: Column, value: object) -> Column:
    """Text cast to the type of the literal it is compared with."""
    if isinstance(value, bool):
        return to_bool(col)
    if isinstance(value, (int, float)):
        return to_number(col)
    if isinstance(value, (datetime, date)):
        return to_ts(col)
    return col


def cmp(col: Column, op: str, value: object, text: bool = False) -> Column:
    """One of six comparisons; None means the null tests. ``text`` marks a column read
    from JSON or a map, which is cast to the literal's type."""
    if value is None:
        if op == "=":
            return col.isNull()
        if op == "!=":
            return col.isNotNull()
        raise ValueError(f"no order against null: {op}")
    left = typed(col, value) if text else col
    return OPS[op](left, F.lit(value))


def in_list(col: Column, values: list) -> Column:
    """Membership; a null member also accepts null; mixed types compare as text."""
    given = [v for v in values if v is not None]
    null_ok = len(given) < len(values)
    tests = []
    if given:
        mixed = len({type(v) for v in values}) > 1
        left = col.cast("string") if mixed else col
        right = [_as_text(v) for v in given] if mixed else given
        tests.append(left.isin(*right))
    if null_ok:
        tests.append(col.isNull())
    return or_(*tests) if tests else F.lit(False)


def _as_text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def array_has(col: Column, value: object) -> Column:
    """Membership; None means a null or empty array, or one that holds a null."""
    if value is None:
        holds_null = F.exists(col, lambda item_: item_.isNull())
        return col.isNull() | (F.size(col) == 0) | F.coalesce(holds_null, F.lit(False))
    return F.array_contains(col, F.lit(value))


def array_has_any(col: Column, values: list) -> Column:
    given = [v for v in values if v is not None]
    tests = [F.arrays_overlap(col, F.array(*[F.lit(v) for v in given]))] if given else []
    if len(given) < len(values):
        tests.append(array_has(col, None))
    return or_(*tests) if tests else F.lit(False)


def _text_test(name: str, col: Column, text: str, ci: bool) -> Column:
    left, right = (F.lower(col), text.lower()) if ci else (col, text)
    return col.isNotNull() & getattr(left, name)(right)


def contains(col: Column, text: str, ci: bool = True) -> Column:
    return _text_test("contains", col, text, ci)


def starts_with(col: Column, text: str, ci: bool = True) -> Column:
    return _text_test("startswith", col, text, ci)


def ends_with(col: Column, text: str, ci: bool = True) -> Column:
    return _text_test("endswith", col, text, ci)


def truthy(text: Column) -> Column:
    """A bare field: not null, "0", false or blank."""
    return (
        text.isNotNull()
        & (text != "0")
        & (F.lower(text) != "false")
        & (text != "")
    )


def enum_cmp(col: Column, op: str, value: str, order: list[str]) -> Column:
    """Order comparison on an enum given from lowest to highest, as a list test.

    An unknown value compares below every member; NOT IN leaves nulls out.
    """
    if op in ("=", "!="):
        return cmp(col, op, value)
    at = order.index(value) if value in order else None
    if op in (">", ">="):
        start = 0 if at is None else at + (op == ">")
        members, negate = order[start:], False
    else:
        start = 0 if at is None else at + (op == "<=")
        members, negate = order[start:], True
    if not members:
        return F.lit(negate)
    test = col.isin(*members)
    return ~test if negate else test


def severity_cmp(col: Column, op: str, word: str) -> Column:
    """Compare a severity word column with a severity word by rank."""
    return OPS[op](severity_rank(col), F.lit(SEVERITIES.index(word) + 1))


def loose_eq(a: Column, b: Column) -> Column:
    """Equality of a number and a text, compared as text."""
    return a.cast("string") == b.cast("string")


def loose_ne(a: Column, b: Column) -> Column:
    return a.cast("string") != b.cast("string")


def condition(predicate: Column | str | None) -> Column:
    """A stored predicate as a Column; an empty one selects all."""
    if predicate is None or (isinstance(predicate, str) and not predicate.strip()):
        return F.lit(True)
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def matched(predicate: Column | str | None) -> Column:
    """A stored predicate as a yes/no: null counts as no."""
    return F.coalesce(condition(predicate).cast("boolean"), F.lit(False))


# Functions a stored predicate may call: for every input they give a value or null, and one
# value for one row. What raises errors, aggregates, explodes, reads other rows or grows without
# bound is left out, and so is what takes a pattern.
ALLOWED_FUNCTIONS = frozenset(
    "abs array array_contains arrays_overlap bit_length btrim cardinality cast ceil ceiling "
    "char_length character_length coalesce concat concat_ws contains date_trunc day dayofweek "
    "endswith exists filter floor forall get get_json_object greatest hour if ifnull instr isnan "
    "isnotnull isnull json_array_length lcase least left length len locate lower ltrim map_keys "
    "map_values minute month nullif nvl nvl2 position replace right round rtrim second size "
    "startswith substr substring transform translate trim try_cast try_element_at "
    "try_to_number try_to_timestamp ucase upper year".split()
)
# words that may stand before a bracket without calling a function
KEYWORDS = frozenset("and or not in when then else case between is interval as".split())
# words that would read other rows or tables
FORBIDDEN_WORDS = frozenset("select from over within lateral table values with".split())
PATTERN_WORDS = frozenset("like ilike rlike regexp".split())
TOKEN = re.compile(
    r"""(?P<text>[rR]?'(?:[^'\\]|\\.)*'|[rR]?"(?:[^"\\]|\\.)*")|`[^`]*`|(?P<word>[^\W\d]\w*)|\d[\w.]*|\S""",
    re.DOTALL,
)


def refusal(spark: SparkSession, predicate: str) -> str | None:
    """Why a stored predicate may not run, by its words alone; None if it may.

    A predicate that passes and can be analysed raises no error on any row, reads its row only
    and keeps the number of rows.
    """
    tokens = list(TOKEN.finditer(predicate))
    for i, token in enumerate(tokens):
        word = (token["word"] or "").lower()
        after = tokens[i + 1] if i + 1 < len(tokens) else None
        if word in FORBIDDEN_WORDS:
            return f"{word} is not part of a predicate"
        if word in PATTERN_WORDS:
            if after is None or not after["text"]:
                return f"the pattern after {word} must be a literal"
            if (error := _pattern_error(spark, word, after[0])) is not None:
                return error
        elif word and after is not None and after[0] == "(":
            if word not in ALLOWED_FUNCTIONS and word not in KEYWORDS:
                return f"{word} is not a function for predicates"
    return None


def _pattern_error(spark: SparkSession, word: str, literal_text: str) -> str | None:
    """The error of a literal pattern, which Spark folds without a job."""
    try:
        spark.sql(f"SELECT a {word} {literal_text} FROM VALUES ('a') AS t(a)").collect()
    except Exception as error:  # whatever Spark raises for a pattern
        return str(error)
    return None


def stored_test(df: DataFrame, predicate: Column | str | None) -> tuple[DataFrame, Column]:
    """``df`` with ``_test``, the yes/no of a stored predicate, which the caller drops."""
    rows, tests = attach_tests(df, [predicate] if isinstance(predicate, str) else [])
    test = tests[predicate] if isinstance(predicate, str) else matched(predicate)
    rows = rows.withColumn("_test", test)
    return rows.drop(*[c for c in rows.columns if c.startswith("_test_")]), F.col("_test")


def select(df: DataFrame, predicate: Column | str | None) -> DataFrame:
    """The rows a stored predicate selects; one that is refused or cannot be analysed selects
    none. A filter leaves nulls out by itself, so the plain condition stays visible to the
    scan."""
    if not isinstance(predicate, str) or not predicate.strip():
        return df.filter(condition(predicate))
    with _lenient_casts(df.sparkSession):
        if _error(df, [predicate]) is not None:
            return df.filter(F.lit(False))
        return df.filter(condition(predicate).cast("boolean"))


def predicate_errors(df: DataFrame, predicates: list[str | None]) -> dict[str, str]:
    """The stored predicates that are refused or cannot be analysed for ``df``, and why."""
    found = {p: _error(df, [p]) for p in dict.fromkeys(predicates)}
    return {p: error for p, error in found.items() if error is not None}


def attach_tests(
    df: DataFrame, predicates: list[str | None]
) -> tuple[DataFrame, dict[str | None, Column]]:
    """``df`` with one yes/no column per stored predicate, and these columns by predicate.

    No predicate ends the job for the others, when it is analysed or on any row. One that cannot
    be analysed (syntax, unknown column, wrong arguments), or that is refused, matches nothing.
    Comparisons of mixed types are analysed with casts that give null, so a text that is no
    number matches no number. The columns are part of the returned frame: they keep these casts.
    """
    names = {p: f"_test_{i}" for i, p in enumerate(dict.fromkeys(predicates))}
    if not names:
        return df, {}
    with _lenient_casts(df.sparkSession):
        bad = predicate_errors(df, list(names)) if _error(df, list(names)) else {}
        tests = {n: F.lit(False) if p in bad else matched(p) for p, n in names.items()}
        return df.withColumns(tests), {p: F.col(n) for p, n in names.items()}


def _error(df: DataFrame, predicates: list[str | None]) -> str | None:
    for p in predicates:
        if isinstance(p, str) and (error := refusal(df.sparkSession, p)) is not None:
            return error
    try:
        df.select(*[matched(p) for p in predicates])
    except (AnalysisException, ParseException) as error:
        return str(error)
    return None


@contextmanager
def _lenient_casts(spark: SparkSession) -> Iterator[None]:
    """Expressions analysed inside cast without errors; the setting is put back after.

    The setting is the session's, so one thread at a time has it.
    """
    name = "spark.sql.ansi.enabled"
    with _ANALYSIS:
        before = spark.conf.get(name)
        spark.conf.set(name, "false")
        try:
            yield
        finally:
            spark.conf.set(name, before)


def time_filter(
    start: Column,
    last_seen: Column,
    as_of: Column,
    days: int | None = None,
    lower: Column | None = None,
    upper: Column | None = None,
) -> Column:
    """Started within ``days`` of ``as_of``; last seen between the bounds, both included."""
    tests = [F.lit(True)]
    if days is not None:
        tests.append(start >= as_of - F.make_interval(days=F.lit(days)))
    if lower is not None:
        tests.append(last_seen >= lower)
    if upper is not None:
        tests.append(last_seen <= upper)
    return and_(*tests)
