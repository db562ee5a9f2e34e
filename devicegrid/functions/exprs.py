"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from devicegrid import config as C


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (NULL counts as 0, as in ``CASE WHEN``)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def pick(values: Sequence[str], index: Column) -> Column:
    """``values[index]`` for a 0-based integer column (literal lookup table)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def cash_status(min_cash, critical_below: int = C.CASH_CRITICAL_BELOW,
                low_below: int = C.CASH_LOW_BELOW) -> Column:
    m = col_(min_cash)
    return (F.when(m < critical_below, "critical")
             .when(m < low_below, "low")
             .otherwise("healthy"))


def severity(faults, warnings, high_faults: int = C.SEVERITY_HIGH_FAULTS,
             medium_warnings: int = C.SEVERITY_MEDIUM_WARNINGS) -> Column:
    return (F.when(col_(faults) >= high_faults, "high")
             .when(col_(warnings) >= medium_warnings, "medium")
             .otherwise("low"))


def safe_ratio(num, den) -> Column:
    """``num / NULLIF(den, 0)`` as double: NULL instead of a division error."""
    return col_(num).cast("double") / F.nullif(col_(den), F.lit(0))


def day_of_week_sunday0(ts) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday (Spark's ``dayofweek`` is 1-based)."""
    return F.dayofweek(col_(ts)) - 1


def age_years(installed, as_of) -> Column:
    """Whole calendar years between ``installed`` and ``as_of``.

    A year counts once the anniversary (month and day) is reached, so an
    install on 29 February is 0 years old on 28 February next year and 1 on
    1 March.  ``months_between / 12`` would not give that.
    """
    i = col_(installed)
    d = F.lit(as_of) if isinstance(as_of, (_dt.date, str)) else col_(as_of)
    d = d.cast("date")
    return (F.year(d) - F.year(i)
            - (F.date_format(d, "MMdd") < F.date_format(i, "MMdd")).cast("int")).cast("int")


def try_timestamp(text) -> Column:
    """Parse a timestamp text; NULL for unparsable values (ANSI mode would raise)."""
    return F.try_to_timestamp(col_(text))


def try_date(text) -> Column:
    return F.try_to_timestamp(col_(text)).cast("date")


def iso_ts(ts) -> Column:
    """ISO-8601 text of a timestamp with microseconds."""
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def thousands(x) -> Column:
    """Integer text with a thousands separator, e.g. ``96,932``."""
    return F.format_number(col_(x).cast("long"), 0)


#: Hex digits of an alert id: 64 bits, so that ids of a billion alerts are
#: expected to stay apart.
ALERT_ID_DIGITS = 16


def alert_id(*parts) -> Column:
    """Repeatable alert id: the first 64 bits of the SHA-256 of the key parts.

    Reruns on the same input give the same ids, so a rerun overwrites rather
    than piling up.
    """
    key = F.concat_ws("|", *[col_(p).cast("string") for p in parts])
    return F.substring(F.sha2(key, 256), 1, ALERT_ID_DIGITS)


def template_parts(template: str) -> list[tuple[str, str]]:
    """Split ``"a {x} b"`` into [("lit", "a "), ("col", "x"), ("lit", " b")]."""
    import re
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if piece:
            parts.append(("col" if i % 2 else "lit", piece))
    return parts


def render(template: str, values: dict[str, Column]) -> Column:
    """Fill a ``{name}`` template from columns (NULL if any value is NULL)."""
    return F.concat(*[F.lit(v) if kind == "lit" else values[v].cast("string")
                      for kind, v in template_parts(template)])


def component_list(counts: dict[str, Column], fallback: str = C.NO_COMPONENT_TEXT) -> Column:
    """``"name:n, ..."`` for the components with a positive count, else ``fallback``."""
    items = F.filter(
        F.array(*[F.when(c > 0, F.concat(F.lit(f"{name}:"), c.cast("long").cast("string")))
                  for name, c in counts.items()]),
        lambda x: x.isNotNull())
    return F.when(F.size(items) > 0, F.array_join(items, ", ")).otherwise(F.lit(fallback))


def lower_is_true(c) -> Column:
    """``lower(text(c)) == 'true'`` — boolean normalisation of mixed text."""
    return F.coalesce(F.lower(col_(c).cast("string")) == F.lit("true"), F.lit(False))


def portable_hash_text(*cols, seed: int = C.SEED) -> Column:
    """SHA-256 hex of ``seed|col1|col2..`` (columns as text).

    Any engine with SHA-256 gives the same value, so samples and splits built
    on it are reproducible elsewhere.
    """
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[col_(c).cast("string") for c in cols]), 256)


def calendar_features(ts) -> list[Column]:
    """Hour, weekend, month-end and peak-hour features of a timestamp.

    Weekend uses Monday = 0 numbering (Saturday and Sunday are >= 5).
    """
    t = col_(ts)
    return [
        F.hour(t).alias("hour"),
        (F.weekday(t) >= 5).alias("is_weekend"),
        (F.dayofmonth(t) >= 26).alias("is_month_end"),
        F.hour(t).between(9, 17).alias("is_peak"),
    ]
