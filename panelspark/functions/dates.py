"""Date parsing expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spelled-out formats callers may use instead of strftime tokens.
FORMAT_ALIASES = {
    "YYYY-mm-dd HH:MM:SS": "%Y-%m-%d %H:%M:%S",
    "YYYY-mm-dd": "%Y-%m-%d",
}

# strftime token -> Spark pattern where digits follow directly, and elsewhere (a
# single letter also accepts one digit, as strftime parsers do); shape of its text.
_TOKENS = {
    "Y": ("yyyy", "yyyy", "[0-9]{4}"),
    "y": ("yy", "yy", "[0-9]{2}"),
    "m": ("MM", "M", "[0-9]{1,2}"),
    "d": ("dd", "d", "[0-9]{1,2}"),
    "e": ("dd", "d", "[0-9]{1,2}"),
    "H": ("HH", "H", "[0-9]{1,2}"),
    "I": ("hh", "h", "[0-9]{1,2}"),
    "M": ("mm", "m", "[0-9]{1,2}"),
    "S": ("ss", "s", "[0-9]{1,2}"),
    "j": ("DDD", "D", "[0-9]{1,3}"),
    "b": ("MMM", "MMM", "[A-Za-z]+"),
    "B": ("MMMM", "MMMM", "[A-Za-z]+"),
    "p": ("a", "a", "[APap][Mm]"),
}
# Tokens that Spark's patterns lack: their text must have this shape and is cut out. Only an
# offset changes the date, which is then the one in UTC.
_PASSED_OVER = {
    "f": "[0-9]{1,9}",
    ".f": "(?:[.][0-9]{1,9})?",
    "z": "(?:[+-][0-9]{2}(?::?[0-9]{2})?|Z)",
    ":z": "(?:[+-][0-9]{2}:[0-9]{2}|Z)",
    "a": "(?i:mon|tue|wed|thu|fri|sat|sun)",
    "A": "(?i:monday|tuesday|wednesday|thursday|friday|saturday|sunday)",
}
# Tokens that Spark's parsers lack and that make a date by arithmetic; each set is one way, %Y may be
# in a set with %U or %W. What else the format has must be text or time of day.
_COUNTED = {
    "s": "-?[0-9]{1,11}",
    "G": "[0-9]{4}",
    "V": "[0-9]{1,2}",
    "u": "[1-7]",
    "w": "[0-6]",
    "U": "[0-9]{1,2}",
    "W": "[0-9]{1,2}",
}
_WAYS = [{"s"}, {"G", "V", "u"}, *({"Y", week, day} for week in "UW" for day in "uw")]
_TIMES = set("HIMSpf%") | {".f"}
# Two-digit years from here on belong to the century before.
YEAR_PIVOT = 69
_SHORTHANDS = {"F": "%Y-%m-%d", "T": "%H:%M:%S", "R": "%H:%M", "D": "%m/%d/%y"}

# Formats a plain cast reads, given that the text has their shape.
_CAST_FORMATS = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S")

# Layouts tried when a text column comes without a format.
_PLAIN_DATES = ("%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%d/%m/%Y", "%d.%m.%Y")


def _parts(strftime: str) -> list[str]:
    """Alternating literal text and one-letter tokens."""
    text = FORMAT_ALIASES.get(strftime, strftime)
    for token, full in _SHORTHANDS.items():
        text = text.replace(f"%{token}", full)
    parts = re.split(r"%([.]f|:z|.)", text)
    unknown = [token for token in parts[1::2] if token not in (*_TOKENS, *_PASSED_OVER, "%")]
    if set(parts[1::2]) - _TIMES in _WAYS:
        unknown = []
    if unknown:
        raise ValueError(f"Unsupported date format tokens {unknown} in {strftime!r}")
    return parts


def spark_pattern(strftime: str) -> str:
    """Spark datetime pattern of a strftime format (aliases included) without tokens passed over."""
    parts = _joined(_parts(strftime))
    out = []
    for number, part in enumerate(parts):
        if number % 2 == 0:
            quoted = "'" + part.replace("'", "''") + "'"
            out.append(quoted if re.search(r"[A-Za-z'#\[\]{}]", part) else part)
        elif part == "%":
            out.append("%")
        else:
            # digits right next to another number leave the width open
            before, after = parts[number - 1], parts[number + 1]
            tight = (not before and number > 1) or (not after and number + 2 < len(parts))
            tight = tight or before[-1:].isdigit() or after[:1].isdigit()
            out.append(_TOKENS[part][0 if tight else 1])
    return "".join(out)


def _joined(parts: list[str]) -> list[str]:
    """Parts without the tokens passed over; the literal texts around them grow together."""
    out = [parts[0]]
    for token, text in zip(parts[1::2], parts[2::2]):
        if token in _PASSED_OVER:
            out[-1] += text
        else:
            out += [token, text]
    return out


def _shape(parts: list[str]) -> tuple[str, str]:
    """Regular expression of texts that may match, and the replacement that cuts out what is passed over."""
    shape, kept = ["("], 1
    for number, part in enumerate(parts):
        if number % 2 == 0:
            shape.append(re.escape(part))
        elif part in _PASSED_OVER:
            shape.append(f"){_PASSED_OVER[part]}(")
            kept += 1
        else:
            shape.append("%" if part == "%" else _TOKENS[part][2])
    return f"^{''.join(shape)})$", "".join(f"${n}" for n in range(1, kept + 1))


def _minutes_ahead(text: Column, parts: list[str]) -> Column:
    """Minutes by which the offset in a text of this shape is ahead of UTC."""
    shape = [re.escape(part) for part in parts]
    for number in range(1, len(parts), 2):
        token = parts[number]
        kind = _PASSED_OVER.get(token) or ("%" if token == "%" else _TOKENS[token][2])
        shape[number] = f"({kind})" if token in ("z", ":z") else kind
    offset = F.regexp_replace(F.regexp_extract(text, f"^{''.join(shape)}$", 1), "[:Z]", "")
    part = lambda at: F.coalesce(F.substring(offset, at, 2).try_cast("int"), F.lit(0))
    return F.when(offset.startswith("-"), -1).otherwise(1) * (60 * part(2) + part(4))


def _counted_date(text: Column, parts: list[str]) -> Column:
    """Date from seconds since 1970 (UTC), or from year, week and weekday; null where there is no such week."""
    shape, place = [re.escape(part) for part in parts], {}
    for number in range(1, len(parts), 2):
        token = parts[number]
        kind = _COUNTED.get(token) or _PASSED_OVER.get(token) or ("%" if token == "%" else _TOKENS[token][2])
        place[token] = (number + 1) // 2
        shape[number] = f"({kind})"
    whole = f"^{''.join(shape)}$"
    value = lambda token: F.regexp_extract(text, whole, place[token]).try_cast("bigint").cast("int")
    if "s" in place:
        seconds = F.regexp_extract(text, whole, place["s"]).try_cast("bigint")
        return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))
    # days from Monday
    day = value("u") - 1 if "u" in place else (value("w") + 6) % 7
    if "G" in place:
        fourth = F.make_date(value("G"), F.lit(1), F.lit(4))  # lies in week 1
        date = F.date_add(fourth, value("V") * 7 - 7 + day - F.weekday(fourth))
        return F.when((F.weekofyear(date) == value("V")) & text.rlike(whole), date)
    new_year = F.make_date(value("Y"), F.lit(1), F.lit(1))
    # week 1 begins with the first Monday (%W) or Sunday (%U)
    week, day = ("W", day) if "W" in place else ("U", (day + 1) % 7)
    ahead = F.weekday(new_year) if week == "W" else (F.weekday(new_year) + 1) % 7
    date = F.date_add(new_year, value(week) * 7 + day - ahead + F.when(ahead == 0, -7).otherwise(0))
    return F.when((F.year(date) == value("Y")) & text.rlike(whole), date)


def parse_date(text: Column, strftime: str) -> Column:
    """Date part of a text read with ``strftime``; null where it does not match.

    Texts of another shape are sorted out by a regular expression first: Spark's
    datetime parsers raise and catch an exception for each text they refuse.
    """
    parts = _parts(strftime)
    if set(parts[1::2]) & set(_COUNTED):
        return _counted_date(text, parts)
    shape, cut = _shape(parts)
    if FORMAT_ALIASES.get(strftime, strftime) in _CAST_FORMATS:
        date = text.try_cast("timestamp_ntz").cast("date")
    else:
        rest = F.regexp_replace(text, shape, cut) if len(cut) > 2 else text
        moment = F.try_to_timestamp(rest, F.lit(spark_pattern(strftime)))
        if {"z", ":z"} & set(parts[1::2]):
            moment = moment.cast("timestamp_ntz") - F.make_dt_interval(mins=_minutes_ahead(text, parts))
        date = moment.cast("date")
    if "y" in parts[1::2]:  # Spark reads 00 to 99 as 2000 to 2099
        date = F.when(F.year(date) < 2000 + YEAR_PIVOT, date).otherwise(F.add_months(date, -1200))
    return F.when(text.rlike(shape), date)


def parse_plain_date(text: Column) -> Column:
    """Date of a text in a common all-digit layout; null otherwise."""
    return F.coalesce(*[parse_date(text, layout) for layout in _PLAIN_DATES])
