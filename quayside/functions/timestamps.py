"""Event-time coercion as Spark SQL expressions.

The accepted text forms follow the event producer's contract: ISO 8601 as read
by Python's ``datetime.fromisoformat`` (after ``Z`` is read as ``+00:00``),
then the two ``strptime`` layouts ``%Y-%m-%d %H:%M:%S`` and
``%Y-%m-%dT%H:%M:%S`` (which also take unpadded fields such as
``2024-1-1 1:2:3``).  Anything else yields NULL here; the caller decides the
fallback (the batch time by default).

Grammar accepted as ISO (documented divergences in README):

* every ``Z`` reads as ``+00:00`` first, as the contract says
* date ``YYYY-MM-DD`` or ``YYYYMMDD``, or a week date ``YYYY-Www``, ``YYYY-Www-D``,
  ``YYYYWww``, ``YYYYWwwD`` (Monday without a day)
* optionally one separator character and a time:
  ``HH``, ``HH:MM``, ``HH:MM:SS`` or basic ``HHMM``, ``HHMMSS``; seconds may
  carry a ``.`` or ``,`` fraction of any length (first 6 digits are kept)
* optionally a zone after a time: ``±HH``, ``±HH:MM``, ``±HHMM``, ``±HH:MM:SS``
* naive values are wall-clock time in the session zone (pinned to UTC)

The expressions are produced as SQL text (one parse on the JVM side instead
of hundreds of client calls) and evaluate with one ``rlike`` plus one
``regexp_replace`` that lays all capture groups out for ``split``; the rest is
``try_make_timestamp``.  JVM-side, codegen'd, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, TimestampNTZType, TimestampType

# fixed values: the accepted ISO layout (see module docstring), as one regex.
# groups: 1 year, 2-3 month/day extended, 4-5 month/day basic,
#         6-9 time extended (h, m, s, fraction), 10-13 time basic, 14 zone
_TIME_PATTERN = (
    r"(?:(?s:.)"
    r"(?:([01]\d|2[0-3])(?::([0-5]\d)(?::([0-5]\d)(?:[.,](\d+))?)?)?"
    r"|([01]\d|2[0-3])([0-5]\d)(?:([0-5]\d)(?:[.,](\d+))?)?)"
    r"([+-](?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d)?)?)?"
    r")?$"
)
ISO_PATTERN = r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))" + _TIME_PATTERN
# the same groups with week and day in place of month and day
WEEK_PATTERN = r"^(\d{4})(?:-W(\d{2})(?:-([1-7]))?|W(\d{2})([1-7])?)" + _TIME_PATTERN
ISO_GROUPS = 14

# fixed values: the two strptime layouts, with strptime's field rules
# (%m 1-12, %d 1-31 with optional leading space, %H 0-23, %M/%S 0-59
# unpadded or padded; the layout's space matches any whitespace run and the
# literal T matches either case).
STRPTIME_PATTERN = (
    r"^(\d{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])"
    r"(?:\s+|[Tt])"
    r"(2[0-3]|[01]\d|\d):([0-5]\d|\d):([0-5]\d|\d)$"
)
STRPTIME_GROUPS = 6


def sql_literal(text: str) -> str:
    """A Spark SQL string literal for ``text`` (backslashes and quotes escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def groups_sql(s: str, pattern: str, n: int) -> str:
    """SQL: the pattern's ``n`` capture groups as an array, NULL on no match.

    On a match the whole text is replaced by its groups joined with ``,``
    (no group can contain a comma), so one regex pass yields every group.
    Compute this once as its own column: Spark does not share common
    subexpressions inside ``CASE`` branches, so 14 group lookups on an inline
    expression would run the regex 14 times.
    """
    p = sql_literal(pattern)
    laid_out = f"regexp_replace({s}, {p}, '{','.join(f'${i}' for i in range(1, n + 1))}')"
    return f"CASE WHEN {s} RLIKE {p} AND substr({s}, 1, 4) <> '0000' THEN split({laid_out}, ',') END"


def _group(parts: str):
    return lambda i: f"nullif(get({parts}, {i - 1}), '')"


def _zone_sql(z: str) -> str:
    digits = f"regexp_replace({z}, '[:+-]', '')"
    offset = (f"concat(substr({z}, 1, 1), substr({digits}, 1, 2), ':', "
              f"coalesce(nullif(substr({digits}, 3, 2), ''), '00'), "
              f"CASE WHEN length({digits}) > 4 THEN concat(':', substr({digits}, 5, 2)) ELSE '' END)")
    return f"CASE WHEN {z} IS NULL THEN 'UTC' ELSE {offset} END"


def _week_date_sql(year: str, week: str, day: str) -> str:
    """SQL: date of an ISO week and day; NULL for a week the year doesn't have."""
    fourth = f"make_date({year}, 1, 4)"     # always in week 1
    monday = f"date_add(date_sub({fourth}, weekday({fourth})), ({week} - 1) * 7)"
    return f"CASE WHEN {week} > 0 AND weekofyear({monday}) = {week} THEN date_add({monday}, {day} - 1) END"


def iso_from_groups_sql(parts: str, week: bool = False) -> str:
    """SQL: group array of ``ISO_PATTERN`` (or ``WEEK_PATTERN``) → TIMESTAMP."""
    g = _group(parts)
    sec = f"coalesce({g(8)}, {g(12)}, '00')"
    frac = f"coalesce({g(9)}, {g(13)}, '')"
    seconds = f"CAST(concat({sec}, '.', rpad(substr({frac}, 1, 6), 6, '0')) AS DECIMAL(8,6))"
    year, second, third = f"CAST({g(1)} AS INT)", f"CAST(coalesce({g(2)}, {g(4)}) AS INT)", f"coalesce({g(3)}, {g(5)})"
    if week:
        date = _week_date_sql(year, second, f"CAST(coalesce({third}, '1') AS INT)")
        ymd = f"year({date}), month({date}), day({date})"
    else:
        ymd = f"{year}, {second}, CAST({third} AS INT)"
    return (f"CASE WHEN {parts} IS NOT NULL THEN try_make_timestamp({ymd}, "
            f"CAST(coalesce({g(6)}, {g(10)}, '0') AS INT), CAST(coalesce({g(7)}, {g(11)}, '0') AS INT), "
            f"{seconds}, {_zone_sql(g(14))}) END")


def strptime_from_groups_sql(parts: str) -> str:
    """SQL: strptime group array → TIMESTAMP (session zone UTC)."""
    g = _group(parts)
    return (f"CASE WHEN {parts} IS NOT NULL THEN try_make_timestamp("
            f"CAST({g(1)} AS INT), CAST({g(2)} AS INT), CAST(trim({g(3)}) AS INT), CAST({g(4)} AS INT), "
            f"CAST({g(5)} AS INT), CAST({g(6)} AS DECIMAL(8,6)), 'UTC') END")


def epoch_digits_sql(s: str) -> str:
    """SQL: an all-digit text as epoch seconds (up to 12 digits, year 33658); longer ones, such
    as milliseconds, are no seconds and stay unread."""
    return f"CASE WHEN {s} RLIKE '^[0-9]{{1,12}}$' THEN timestamp_seconds(CAST({s} AS BIGINT)) END"


def event_time_columns(col: str, dtype, digits_as_epoch: bool = False) -> tuple[dict[str, str], str]:
    """Two-step SQL for a decoded time column: helper columns to compute
    first (the regex group arrays, each once per row) and the final
    expression over them.  Text, epoch numbers and timestamps are accepted.

    ``digits_as_epoch`` additionally reads an all-digit text of up to 12
    digits as epoch seconds (off by default: the JSON contract carries times
    as text, so ``"1704067200"`` falls back like any other unknown text)."""
    c = _name(col)
    if isinstance(dtype, StringType):
        iso = f"replace({c}, 'Z', '+00:00')"
        helpers = {"_iso_groups": groups_sql(iso, ISO_PATTERN, ISO_GROUPS),
                   "_week_groups": f"CASE WHEN instr({c}, 'W') IN (5, 6) THEN {groups_sql(iso, WEEK_PATTERN, ISO_GROUPS)} END",
                   "_strptime_groups": groups_sql(c, STRPTIME_PATTERN, STRPTIME_GROUPS)}
        parts = [iso_from_groups_sql("_iso_groups"), iso_from_groups_sql("_week_groups", week=True),
                 strptime_from_groups_sql("_strptime_groups")]
        if digits_as_epoch:
            parts.append(epoch_digits_sql(c))
        return helpers, f"coalesce({', '.join(parts)})"
    if isinstance(dtype, NumericType):
        return {}, f"timestamp_seconds({c})"
    if isinstance(dtype, TimestampNTZType):
        return {}, f"CAST({c} AS TIMESTAMP)"
    if isinstance(dtype, TimestampType):
        return {}, c
    raise TypeError(f"cannot read an event time from a {dtype.simpleString()} column")


def _name(col: str) -> str:
    return col if col.startswith("`") or "(" in col else f"`{col}`"


def python_isoformat_sql(ts: str) -> str:
    """SQL: ISO text like Python's ``datetime.isoformat()`` for naive values
    (the fraction is written only when it is not zero)."""
    whole = f"date_format({ts}, {sql_literal("yyyy-MM-dd'T'HH:mm:ss")})"
    micros = f"date_format({ts}, 'SSSSSS')"
    return f"CASE WHEN {micros} = '000000' THEN {whole} ELSE concat({whole}, '.', {micros}) END"


def python_isoformat(ts: str) -> Column:
    """Column (by name or SQL expression) → ISO text like ``isoformat()``."""
    return F.expr(python_isoformat_sql(_name(ts)))
