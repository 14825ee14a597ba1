"""Dates written in many shapes -> ``timestamp_ntz``, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perimetry.functions.barrier import stage
from perimetry.functions.text import strip

# The span of 64-bit nanosecond timestamps; text beyond it is not a date.
EARLIEST = "1677-09-21 00:12:43.145225"
LATEST = "2262-04-11 23:47:16.854775"

_MONTH = r"(?i:(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*)\.?"
_WEEKDAY = r"(?i:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?"
_TAIL = r"((?:[T\s].*)?)$"

# (whole text, its rewrite as year-month-day and the rest)
_NUMERIC_SHAPES = (
    (rf"^(\d{{4}})[/.](\d{{1,2}})[/.](\d{{1,2}}){_TAIL}", "$1-$2-$3$4"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})[T\s]?(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"),
    (rf"^(0?[1-9]|1[0-2])[/-](\d{{1,2}})[/-](\d{{4}}){_TAIL}", "$3-$1-$2$4"),
    (rf"^(\d{{1,2}})[/-](\d{{1,2}})[/-](\d{{4}}){_TAIL}", "$3-$2-$1$4"),
    (r"^(\d{4})$", "$1-1-1"),
    (r"^(\d{4})-(\d{2})$", "$1-$2-1"),
)
# (whole text, which group holds the month name, which the day)
_NAMED_SHAPES = (
    (rf"^{_WEEKDAY}(\d{{1,2}})[\s-]+{_MONTH}[\s,-]+(\d{{4}}){_TAIL}", 2, 1),
    (rf"^{_WEEKDAY}{_MONTH}\s+(\d{{1,2}}),?\s+(\d{{4}}){_TAIL}", 1, 2),
)
_YEAR_FIRST = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}{_TAIL}"

# What may follow once the date is year first.
_ZONE = r"\s*(?:Z|UTC|GMT|([+-])(\d{2}):?(\d{2})?)$"
_PLAIN = r"^\d{4}-\d{1,2}-\d{1,2}([T\s]\s*\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"
_HOUR_ONLY = r"^(\d{4}-\d{1,2}-\d{1,2})[T\s]\s*(\d{1,2})$"
_HALF_DAY = r"^(\d{4}-\d{1,2}-\d{1,2})[T\s]\s*(0?[1-9]|1[0-2])((?::\d{2}){0,2})\s*([AaPp])[Mm]$"


def _group(text: str, pattern: str, i: int) -> str:
    return f"regexp_extract({text}, r'{pattern}', {i})"


def _numeric_date(text: str) -> str:
    cases = " ".join(
        f"WHEN rlike({text}, r'{p}') THEN regexp_replace({text}, r'{p}', r'{to}')"
        for p, to in _NUMERIC_SHAPES
    )
    return f"CASE WHEN rlike({text}, r'{_YEAR_FIRST}') THEN {text} {cases} END"


def _named_date(text: str) -> str:
    cases = ""
    for pattern, month, day in _NAMED_SHAPES:
        names = "'janfebmaraprmayjunjulaugsepoctnovdec'"
        number = f"cast(floor((locate(lower({_group(text, pattern, month)}), {names}) + 2) / 3) AS string)"
        year, rest = _group(text, pattern, 3), _group(text, pattern, 4)
        iso = f"concat({year}, '-', {number}, '-', {_group(text, pattern, day)}, {rest})"
        cases += f" WHEN rlike({text}, r'{pattern}') THEN {iso}"
    return f"CASE {cases} END"


def _clock_text(local: str) -> str:
    """Date, or date and 24-hour clock time, as the cast reads it; null for anything else."""
    hour, rest = f"cast({_group(local, _HALF_DAY, 2)} AS int)", _group(local, _HALF_DAY, 3)
    hour = f"{hour} % 12 + if(lower({_group(local, _HALF_DAY, 4)}) = 'p', 12, 0)"
    half_day = f"concat({_group(local, _HALF_DAY, 1)}, ' ', {hour}, if({rest} = '', ':00', {rest}))"
    return (
        f"CASE WHEN rlike({local}, r'{_PLAIN}') THEN {local}"
        f" WHEN rlike({local}, r'{_HOUR_ONLY}') THEN concat({local}, ':00')"
        f" WHEN rlike({local}, r'{_HALF_DAY}') THEN {half_day} END"
    )


def with_parsed_date(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Add ``out``: the text column ``raw`` as UTC wall time, null where it is no calendar date.

    Every shape is guarded by a full match, so wall-clock words and bare times stay null. Casts
    are ``try_cast`` to ``timestamp_ntz``: impossible dates become null with ANSI mode on or off,
    and daylight-saving gaps of the session zone do not exist. The steps are small on purpose: the
    JVM compiles each, and the rarer shapes are looked at only where the frequent ones fail.
    """
    df = stage(df, _text=strip(f"cast(`{raw}` AS string)"))
    df = stage(df, _iso=_numeric_date("_text"))
    df = stage(df, _iso=f"CASE WHEN _iso IS NULL THEN {_named_date('_text')} ELSE _iso END")
    # a zone needs a time of day before it; "2002-02-01" must not read as "2002-02 -01"
    zoned = f"length(_iso) > 11 AND rlike(substr(_iso, 11), r'{_ZONE}')"
    df = stage(df, _zone=f"CASE WHEN {zoned} THEN {_group('_iso', _ZONE, 0)} ELSE '' END")
    minutes = [f"coalesce(try_cast({_group('_zone', _ZONE, i)} AS int), 0)" for i in (2, 3)]
    df = stage(
        df,
        _local="CASE WHEN _zone = '' THEN _iso ELSE substr(_iso, 1, length(_iso) - length(_zone)) END",
        _ahead=f"CASE WHEN length(trim(_zone)) < 3 THEN 0 WHEN instr(_zone, '-') > 0"
        f" THEN -({minutes[0]} * 60 + {minutes[1]}) ELSE {minutes[0]} * 60 + {minutes[1]} END",
    )
    df = stage(df, _local=_clock_text("_local"))
    # text with a zone but no time of day is not a date
    df = stage(
        df,
        _utc="CASE WHEN _zone = '' THEN try_cast(_local AS timestamp_ntz) WHEN length(_local) > 10"
        " THEN try_cast(_local AS timestamp_ntz) - make_dt_interval(0, 0, _ahead, 0) END",
    )
    span = f"timestamp_ntz'{EARLIEST}' AND timestamp_ntz'{LATEST}'"
    df = stage(df, **{out: f"CASE WHEN _utc BETWEEN {span} THEN _utc END"})
    return df.drop("_text", "_iso", "_zone", "_local", "_ahead", "_utc")


def in_year_range(date: str, min_year: int, max_year: int | str) -> str:
    """Inclusive bounds on the year of a date; false for a missing date."""
    return f"coalesce(year({date}) BETWEEN {min_year} AND {max_year}, false)"
