"""Scalar functions on alert fields."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: severity names from lowest to highest rank (1 = lowest)
SEVERITIES = ("low", "info", "warning", "high", "critical")
# fixed values: alert status words
ALERT_STATUSES = (
    "firing",
    "resolved",
    "acknowledged",
    "suppressed",
    "pending",
    "maintenance",
)
# fixed values: incident status words
INCIDENT_STATUSES = ("firing", "resolved", "acknowledged", "merged", "deleted")
DESCRIPTION_FORMATS = ("markdown", "html")
DEFAULT_SEVERITY = "info"
DEFAULT_STATUS = "firing"
FINGERPRINT_MAX = 255
# fixed values: a map key may not start with one of these
UNSAFE_KEY_STARTS = ("@", "-", "$", "#", " ", ":", ".", "/", "\\", "*", "&", "^", "%", "!")
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def severity_rank(col: Column) -> Column:
    """Rank 1..5 of a severity word; null for an unknown word."""
    return F.element_at(literal_map({s: i for i, s in enumerate(SEVERITIES, 1)}), col)


def severity_label(rank: Column) -> Column:
    """Severity word of a rank; null outside 1..5."""
    return F.element_at(literal_map(dict(enumerate(SEVERITIES, 1))), rank.cast("int"))


def normalize_severity(col: Column, as_rank: Column | None = None) -> Column:
    """A known word stays, an integer rank becomes its word, anything else is ``info``."""
    known = F.when(col.isin(*SEVERITIES), col)
    from_rank = [] if as_rank is None else [severity_label(as_rank)]
    return F.coalesce(known, *from_rank, F.lit(DEFAULT_SEVERITY))


def normalize_status(col: Column) -> Column:
    return F.when(col.isin(*ALERT_STATUSES), col).otherwise(F.lit(DEFAULT_STATUS))


def iso_millis(col: Column) -> Column:
    return F.date_format(col, ISO_MILLIS)


def parse_last_received(text: Column) -> Column:
    """Timestamp from ISO text, else from UNIX seconds (a trailing ``Z`` allowed); null
    where neither reads. Milliseconds precision, as the output text has."""
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))
    seconds = F.regexp_replace(text, "Z+$", "").try_cast("double")
    unix = F.timestamp_micros(F.floor(seconds * 1000).cast("long") * 1000)
    return F.date_trunc("millisecond", F.coalesce(iso, unix))


def normalize_url(col: Column) -> Column:
    """Trim; blank becomes null; a missing scheme becomes https; reserved characters
    other than ``/:?=&`` are percent-encoded (UTF-8)."""
    url = F.trim(col)
    url = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("https://"), url))
    quoted = F.url_encode(url)
    # form encoding and percent-quoting differ in these characters
    for encoded, plain in (
        ("+", "%20"),
        ("*", "%2A"),
        ("%7E", "~"),
        ("%2F", "/"),
        ("%3A", ":"),
        ("%3F", "?"),
        ("%3D", "="),
        ("%26", "&"),
    ):
        quoted = F.replace(quoted, F.lit(encoded), F.lit(plain))
    return F.when(F.length(F.trim(col)) > 0, quoted)


def effective_dismissed(dismissed: Column, until: Column, as_of: Column) -> Column:
    """Dismissed, unless the deadline has passed; no deadline or ``forever`` keeps it.
    A deadline that does not read counts as not dismissed."""
    flag = F.lower(dismissed.cast("string")) == "true"
    open_ended = until.isNull() | (until == "") | (until == "forever")
    alive = F.coalesce(as_of < F.try_to_timestamp(until), F.lit(False))
    return F.coalesce(flag & (open_ended | alive), F.lit(False))


def effective_deleted(last_received: Column, deleted_at: Column) -> Column:
    return F.coalesce(F.array_contains(deleted_at, last_received), F.lit(False))


def default_fingerprint(given: Column, name: Column, payload: Column) -> Column:
    """The given value, hashed if it is longer than the bound, else a hash of the name, else
    of the payload."""
    source = F.when(F.length(name) > 0, name).otherwise(payload)
    kept = F.when(F.length(given) > FINGERPRINT_MAX, F.sha2(given, 256)).otherwise(given)
    return F.when(given.isNotNull(), kept).otherwise(
        F.sha2(source, 256)
    )


def fingerprint_by(fields: list[Column], name: Column) -> Column:
    """Hash of the field values in order, nulls skipped; without fields, the name."""
    if not fields:
        return name
    return F.sha2(F.concat(*[F.coalesce(f.cast("string"), F.lit("")) for f in fields]), 256)


def fingerprint_by_provider(
    provider_type: Column, fields: dict[str, list[Column]], name: Column
) -> Column:
    """``fingerprint_by`` with each provider type's own fields; the name for the others."""
    out = name
    for kind, own in fields.items():
        out = F.when(provider_type == kind, fingerprint_by(own, name)).otherwise(out)
    return out


def content_hash(fields: dict[str, Column], ignore: tuple[str, ...] = ()) -> Column:
    """Hash of the named fields in name order; a null differs from an empty text."""
    kept = [c for n, c in sorted(fields.items()) if n not in ignore]
    parts = [F.coalesce(c.cast("string"), F.lit("\u0001")) for c in kept]
    return F.sha2(F.concat_ws("|", *parts), 256)


def map_text(col: Column) -> Column:
    """A map as text that does not depend on the order of its entries."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(col))))


def strip_nul(col: Column) -> Column:
    return F.replace(col, F.lit("\x00"), F.lit(""))


def strip_nul_map(col: Column) -> Column:
    return F.transform_values(col, lambda key_, value_: strip_nul(value_))


def drop_unsafe_keys(col: Column) -> Column:
    return F.map_filter(col, lambda key_, value_: ~F.substring(key_, 1, 1).isin(*UNSAFE_KEY_STARTS))


def valid_description_format(col: Column) -> Column:
    return col.isNull() | col.isin(*DESCRIPTION_FORMATS)


# parted by characters that no name or text of an entity holds
_ENTRY, _PAIR = "\x01", "\x02"
NAME_MAX = max(map(len, html5))


def _html_names() -> str:
    """A pattern of all entity names that finds the longest one: a trie, longer branches first."""
    trie: dict = {}
    for name in html5:
        node = trie
        for c in name:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        branches = [re.escape(c) + pattern(below) for c, below in sorted(node.items()) if c]
        if not branches:
            return ""
        return f"(?:{'|'.join(branches)}){'?' if '' in node else ''}"

    return pattern(trie)


@lru_cache
def _html_tables() -> tuple[str, dict[str, str]]:
    """The pattern of names, and texts of entities as entries, by the first character of the name.

    Numbers that stand for another character, or for none, are entries too.
    """
    texts: dict[str, dict[str, str]] = defaultdict(dict)
    for name, text in html5.items():
        texts[name[0]][name] = text
    # a byte order mark would be lost when it is decoded
    texts["#"]["#65279"] = "\ufeff"
    # the numbers with an answer of their own are below this one, or end a plane
    ends = [p * 0x10000 + e for p in range(17) for e in (0xFFFE, 0xFFFF)]
    for n in (*range(0xA0), *range(0xFDD0, 0xFDF0), *ends):
        if (text := html.unescape(f"&#{n};")) != chr(n):
            texts["#"][f"#{n}"] = text
    parted = {c: _ENTRY.join(k + _PAIR + v for k, v in own.items()) for c, own in texts.items()}
    return _html_names(), parted


def _after(text: Column, start: Column) -> Column:
    return F.substring(text, F.length(start) + 1, F.lit(2**31 - 1))


def html_unescape(col: Column) -> Column:
    """Decode HTML entities as ``html.unescape`` does; texts without an ampersand are left alone."""
    names, texts = _html_tables()
    first = sorted(texts)
    # maps are searched from their start, so each first character has a map of its own
    maps = F.map_from_arrays(
        F.array(*[F.lit(c) for c in first]),
        F.array(*[F.str_to_map(F.lit(texts[c]), F.lit(_ENTRY), F.lit(_PAIR)) for c in first]),
    )

    def named(key: Column) -> Column:
        return F.try_element_at(F.try_element_at(maps, F.substring(key, 1, 1)), key)

    def decoded(part: Column) -> Column:
        """What follows an ampersand, with the entity at its start as text."""
        digits = F.regexp_extract(part, "^#0*([0-9]+)", 1)
        hexes = F.regexp_extract(part, "^#[xX]0*([0-9a-fA-F]+)", 1)
        number = F.when(F.length(digits).between(1, 9), digits.try_cast("long")).when(
            F.length(hexes).between(1, 8), F.conv(hexes, 16, 10).cast("long")
        )
        valid = (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        text = F.when(
            F.coalesce(valid, F.lit(False)),
            F.coalesce(named(F.concat(F.lit("#"), number.cast("string"))), character),
        ).otherwise("\ufffd")
        reference = F.regexp_extract(part, "^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
        # names are short, so that the text after them is not read for them
        name = F.regexp_extract(F.substring(part, 1, NAME_MAX), f"^{names}", 0)
        return F.when(
            part.startswith("#"),
            F.when(reference == "", F.concat(F.lit("&"), part)).otherwise(
                F.concat(text, _after(part, reference))
            ),
        ).otherwise(
            F.element_at(
                F.transform(
                    F.array(name),
                    lambda n: F.when(n == "", F.concat(F.lit("&"), part)).otherwise(
                        F.concat(named(n), _after(part, n))
                    ),
                ),
                1,
            )
        )

    parts = F.split(col, "&")
    others = F.transform(F.slice(parts, 2, F.size(parts)), decoded)
    whole = F.concat(F.element_at(parts, 1), F.array_join(others, ""))
    return F.when(col.contains("&"), whole).otherwise(col)
