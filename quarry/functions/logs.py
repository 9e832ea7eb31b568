"""Access-log line parsing (Common Log Format) with column expressions.

A line looks like::

    host ident user [dd/Mon/yyyy:HH:mm:ss +zone] "request" status size

One anchored regular expression extracts every field, so a request without
the protocol part or with an embedded double quote does not shift the status
and size columns (a token-position split would).  Lines that do not match are
kept with ``malformed = true`` and NULL fields instead of being dropped.
The log time is kept as the *local* clock time of the line
(``TIMESTAMP_NTZ``) with the zone offset stored apart, so hours mean the
server's hours, not the session time zone's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_PATTERN = (
    r'^(\S+) \S+ \S+ \[(\d{2})/([A-Za-z]{3})/(\d{4}):(\d{2}):(\d{2}):(\d{2}) ([+-]\d{4})\] '
    r'"(.*)" (\d{3}) (\d+|-)[\r\n]*\z'
)

# English month abbreviations as written in access logs.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
          "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _month_number(abbrev: Column) -> Column:
    pairs = []
    for i, m in enumerate(MONTHS, start=1):
        pairs += [F.lit(m.lower()), F.lit(i)]
    return F.try_element_at(F.create_map(*pairs), F.lower(abbrev))


#: A matched line is rewritten as its groups with the request (group 9) last, joined by blanks.
#: The other groups hold no white space, so the first ten blanks end them whatever the request holds.
_ORDER = [1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 9]
#: No line that matches begins with a line feed (nor holds one but at its end).
_MARK = "\n"


def log_parts(line: str | Column) -> Column:
    """The 11 regex groups of a log line as an array, request last (NULL if it does not match).

    The regular expression runs once: ``regexp_replace`` rewrites a matching
    line into its groups (and leaves any other line as it was), then a
    ``split`` with a limit cuts them apart.
    """
    value = F.col(line) if isinstance(line, str) else line
    return _unpack(_pack(value), value)


def _pack(value: Column) -> Column:
    return F.regexp_replace(value, LOG_PATTERN, _MARK + " ".join(f"${i}" for i in _ORDER))


def _unpack(packed: Column, value: Column) -> Column:
    parts = F.split(F.substring(packed, 2, 1 << 30), " ", len(_ORDER))
    return F.when(packed.startswith(_MARK) & ~value.startswith(_MARK), parts)


def log_fields(parts: str | Column) -> list[Column]:
    """Typed columns ``host, ts, tz_offset, request, status, size, malformed``
    from the array made by :func:`log_parts`."""
    arr = F.col(parts) if isinstance(parts, str) else parts
    ok = arr.isNotNull() & (F.size(arr) == 11)

    def grp(i: int) -> Column:
        return F.when(ok, F.get(arr, _ORDER.index(i)))

    ts = F.try_make_timestamp_ntz(
        grp(4).cast("int"), _month_number(grp(3)), grp(2).cast("int"),
        grp(5).cast("int"), grp(6).cast("int"), grp(7).cast("decimal(8,6)"))
    size = grp(11)
    return [
        grp(1).alias("host"),
        ts.alias("ts"),
        grp(8).alias("tz_offset"),
        grp(9).alias("request"),
        grp(10).cast("int").alias("status"),
        F.when(size != F.lit("-"), size.try_cast("long")).alias("size"),
        F.coalesce(~ok, F.lit(True)).alias("malformed"),
    ]


def parse_log_frame(df: DataFrame, line: str = "value") -> DataFrame:
    """Parse a frame of log lines, evaluating the regex once per line.

    The packed match and the regex array are projected first (Catalyst does
    not inline an expensive expression that is used more than once), and
    the typed fields are
    produced by a generator (``inline`` of a one-element array).  Filters on
    the parsed columns (e.g. ``NOT malformed``) therefore stay above the
    parse instead of being pushed below it with the regex copied into them.
    """
    fields = log_fields("_parts")
    return (df.select(_pack(F.col(line)).alias("_packed"), F.col(line).alias("_line"))
            .select(_unpack(F.col("_packed"), F.col("_line")).alias("_parts"))
            .select(F.inline(F.array(F.struct(*fields)))))


def render_log_line(host: Column, ts: Column, offset: str, request: Column,
                    status: Column, size: Column) -> Column:
    """Inverse of :func:`parse_log_frame` (used to build log text from tables)."""
    return F.format_string(
        '%s - - [%s %s] "%s" %d %s',
        host, F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"), F.lit(offset), request,
        status, F.coalesce(size.cast("string"), F.lit("-")))
