"""Field expressions: rows to lines and back, names, hosts, ids, times."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import column

# The shape of a batch job id and of a UTC stamp.
JOB_ID = r"\bjob_\d+_\d+\b"
UTC_INSTANT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
UTC_COMPACT = "yyyyMMdd'T'HHmmss'Z'"

_INTEGER = r"^\s*[+-]?[0-9]+\s*$"


def tsv_line(*fields: Column | str) -> Column:
    return F.concat_ws("\t", *[column(f).cast("string") for f in fields])


def tsv_fields(line: Column | str) -> Column:
    return F.split(column(line), "\t")


def to_integer(text: Column | str) -> Column:
    """BIGINT, or NULL where the text is not a plain ASCII integer within range."""
    t = column(text)
    return F.when(t.rlike(_INTEGER), F.trim(t).try_cast("bigint"))


def ceil_div(a: Column, b: Column) -> Column:
    """Smallest integer not below a / b for a >= 0, b > 0, in integer arithmetic throughout."""
    return F.call_function("div", a + b - 1, b)


def base_name(path: Column | str) -> Column:
    return F.substring_index(column(path), "/", -1)


def decoded(uri: Column | str) -> Column:
    """File name out of its URI form, in which a plus sign is just a plus sign."""
    return F.url_decode(F.replace(column(uri), F.lit("+"), F.lit("%2B")))


def host_of(address: Column | str) -> Column:
    """Address without its last `:port`."""
    return F.regexp_replace(column(address), r":[^:]*\z", "")


def all_ids(text: Column | str, pattern: str = JOB_ID) -> Column:
    return F.regexp_extract_all(column(text), F.lit(pattern), F.lit(0))


def after_marker(text: Column | str, marker: str) -> Column:
    """Rest of the first line that holds `marker`, or NULL when no line does."""
    t = column(text)
    rest = F.regexp_extract(t, re.escape(marker) + r"([^\r\n]*)", 1)
    return F.when(F.contains(t, F.lit(marker)), rest)


def utc_text(ts: Column | str, pattern: str = UTC_INSTANT) -> Column:
    """Time as text; the session time zone must be UTC, as `session.start` sets it."""
    return F.date_format(column(ts), pattern)


def run_id(ts: Column | str, framework: Column | str, nodes: Column | str) -> Column:
    size = F.concat(column(nodes).cast("string"), F.lit("n"))
    return F.concat_ws("-", utc_text(ts, UTC_COMPACT), column(framework), size)
