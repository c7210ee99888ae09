"""Alert normalisation: typed fields, defaults, provider formats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertweave.functions import scalars

Format = Callable[[DataFrame], DataFrame]
BodyParser = Callable[[Column], Column]

# fixed values
QUEUE_TEXT = "alert-from-event-queue"
DEFAULT_SOURCE = "unknown"
DEFAULT_NAME = "unknown alert name"


def normalize_alerts(df: DataFrame, payload: Column | None = None) -> DataFrame:
    """A missing id becomes a hash of the payload (so a rerun gives the same id); a bad
    severity becomes info, an integer rank its word; a bad status becomes firing."""
    text = payload if payload is not None else F.to_json(F.struct(*sorted(df.columns)))
    integral = isinstance(df.schema["severity"].dataType, T.IntegralType)
    severity = F.col("severity")
    if integral:
        label = F.coalesce(
            scalars.severity_label(severity), F.lit(scalars.DEFAULT_SEVERITY)
        )
    else:
        label = scalars.normalize_severity(severity)
    given = F.nullif(F.col("id"), F.lit(""))
    return df.withColumns(
        {
            "id": F.coalesce(given, F.sha2(text, 256)),
            "severity": label,
            "status": scalars.normalize_status(F.col("status")),
        }
    )


def prepare_alerts(
    df: DataFrame, fingerprint: str | None = None, api_key: str | None = None
) -> DataFrame:
    """Default source; optional fingerprint and api key override; a missing name falls
    back to the id, then to a fixed text."""
    no_source = F.coalesce(F.size("source"), F.lit(0)) <= 0
    name = F.nullif(F.col("name"), F.lit(""))
    cols = {
        "source": F.when(no_source, F.array(F.lit(DEFAULT_SOURCE))).otherwise(F.col("source")),
        "name": F.coalesce(name, F.col("id"), F.lit(DEFAULT_NAME)),
    }
    if fingerprint is not None:
        cols["fingerprint"] = F.lit(fingerprint)
    if api_key is not None:
        cols["api_key_ref"] = F.lit(api_key)
    return df.withColumns(cols)


def queue_defaults(df: DataFrame, provider_type: str, provider_id: str) -> DataFrame:
    """Defaults for alerts that arrive through a queue."""
    texts = ("name", "environment", "service", "message", "description")
    cols = {c: F.coalesce(F.col(c), F.lit(QUEUE_TEXT)) for c in texts}
    cols["status"] = F.coalesce(F.col("status"), F.lit(scalars.DEFAULT_STATUS))
    cols["severity"] = F.coalesce(F.col("severity"), F.lit(scalars.DEFAULT_SEVERITY))
    cols["source"] = F.coalesce(F.col("source"), F.array(F.lit(provider_type)))
    cols["pushed"] = F.coalesce(F.col("pushed"), F.lit(False))
    cols["provider_id"] = F.lit(provider_id)
    return df.withColumns(cols)


def format_by_provider(
    df: DataFrame, registry: dict[str, Format], default: Format | None = None
) -> DataFrame:
    """Each provider's rows through its own format function; a list payload may become
    many rows and a null payload none. Unknown providers go through ``default``."""
    known = F.col("provider_type").isin(*registry)
    parts = [
        fmt(df.filter(F.col("provider_type") == kind)) for kind, fmt in registry.items()
    ]
    rest = df.filter(~F.coalesce(known, F.lit(False)))
    parts.append(default(rest) if default else rest)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def parse_bodies(
    df: DataFrame, parsers: dict[str, BodyParser], body: str = "body"
) -> DataFrame:
    """Raw request bodies to payload text by provider; identity where none is given."""
    raw = F.col(body)
    parsed = raw
    for kind, parser in parsers.items():
        parsed = F.when(F.col("provider_type") == kind, parser(raw)).otherwise(parsed)
    return df.withColumn(body, parsed)


def project_fields(
    df: DataFrame,
    visible: list[str],
    order: list[str] | None = None,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Visible columns, ordered ones first, shown under their new names."""
    first = [c for c in (order or []) if c in visible]
    names = first + [c for c in visible if c not in first]
    return df.select(*[F.col(c).alias((rename or {}).get(c, c)) for c in names])


def event_timestamp(df: DataFrame) -> DataFrame:
    """Row time is the forced one, else the receive time cut to milliseconds; the provider
    type falls back to the first source."""
    return df.withColumns(
        {
            "timestamp": F.coalesce(
                F.col("timestamp_forced"), F.date_trunc("millisecond", "received")
            ),
            "provider_type": F.coalesce(
                F.nullif(F.col("provider_type"), F.lit("")), F.get("source", F.lit(0))
            ),
        }
    )
