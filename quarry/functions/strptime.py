"""strptime formats as one regular expression and a timestamp made of its groups.

A numeric directive takes as many digits as it can, up to its width, and gives none back: where directives touch, widths decide.
Spaces before and behind are skipped, and a run of spaces in the format stands for any run of them. Names of months and
days are taken in any case. Years of two digits are 1969 to 2068. What a format lacks is that of 1900-01-01 00:00:00; of two
directives for one part the last counts. Values out of range are null, and what is below a microsecond is cut off. Directives that aren't listed are an error
when the format is compiled.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

#: Directive -> part and most digits.
NUMERIC = {"Y": ("year", 4), "y": ("century", 2), "m": ("month", 2), "d": ("day", 2), "j": ("yearday", 3), "H": ("hour", 2), "I": ("half", 2), "M": ("minute", 2), "S": ("second", 2), "g": ("fraction", 3), "f": ("fraction", 6), "n": ("fraction", 9)}
NAMED = {"b": ("name", tuple(m[:3] for m in MONTHS)), "B": ("name", MONTHS), "p": ("noon", ("AM", "PM")), "a": (None, tuple(d[:3] for d in DAYS)), "A": (None, DAYS)}
WHOLE = {"x": "%Y-%m-%d", "X": "%H:%M:%S", "c": "%Y-%m-%d %H:%M:%S"}
_SEPARATOR = "\x01"


@dataclass(frozen=True)
class Format:
    """A Java pattern and the part that each of its groups holds."""

    pattern: str
    parts: tuple[str, ...]


@cache
def compile_format(given: str) -> Format:
    text = re.sub(r"%%|%[xXc]", lambda m: WHOLE.get(m[0][1], m[0]), given)
    out, parts = [], []
    for piece in re.findall(r"%-?.|\s+|[^%\s]+|%", text, re.S):
        letter = piece[-1]
        if piece.isspace():
            out.append(r"\s++")
        elif piece[0] != "%":
            out.append(re.sub(r"([^A-Za-z0-9])", r"\\\1", piece))
        elif piece == "%%":
            out.append("%")
        elif letter in NUMERIC and len(piece) > 1:
            part, width = NUMERIC[letter]
            parts.append(part)
            out.append(rf"([0-9]{{1,{width}}}+)")
        elif letter in NAMED and len(piece) == 2:
            part, names = NAMED[letter]
            out.append(f"({'' if part else '?:'}(?i:{'|'.join(names)}))")
            if part:
                parts.append(part)
        else:
            raise ValueError(f"date format {given!r}: directive {piece} is not supported")
    found = set(parts)
    if "yearday" in found and found & {"month", "day", "name"}:
        raise ValueError(f"date format {given!r}: a day of the year beside a month or a day")
    if len(parts) > 9:
        raise ValueError(f"date format {given!r}: more than nine directives")
    return Format(rf"^\s*+{''.join(out)}\s*+\z", tuple(parts))


def parse(text: Column, given: str) -> Column:
    """The timestamp without a zone that `text` is in the format; null for other text."""
    fmt = compile_format(given)
    # one match gives all groups, behind an empty first element; text that doesn't match stays a single one
    to = "".join(f"{_SEPARATOR}${i + 1}" for i in range(len(fmt.parts))) or _SEPARATOR
    matched = lambda t: F.split(F.regexp_replace(t, F.lit(fmt.pattern), F.lit(to)), _SEPARATOR)
    # each part refers to the groups: as the variable of a lambda they are made once a value, and not once a reference
    return _bound(text, lambda t: _bound(matched(t), lambda groups: _made(t, groups, fmt)))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _made(text: Column, groups: Column, fmt: Format) -> Column:
    of = {part: F.get(groups, F.lit(i + 1)) for i, part in enumerate(fmt.parts)}
    number = lambda part, missing: of[part].try_cast("int") if part in of else F.lit(missing)
    fits = [F.size(groups) == max(len(fmt.parts), 1) + 1, F.get(groups, F.lit(0)) == "", ~text.contains(_SEPARATOR)]

    def last(*names: str) -> str | None:
        return max((n for n in names if n in of), key=lambda n: len(fmt.parts) - 1 - fmt.parts[::-1].index(n), default=None)

    year = number("year", 1900)
    if last("year", "century") == "century":
        two = number("century", 0)
        year = two + F.when(two >= 69, 1900).otherwise(2000)
    month = number("month", 1)
    if last("month", "name") == "name":
        short = F.lower(F.substring(of["name"], 1, 3))
        month = F.array_position(F.array(*(F.lit(m[:3].lower()) for m in MONTHS)), short).cast("int")
    hour = number(last("hour", "half") or "hour", 0)
    if last("hour", "half") == "half":
        fits += [hour.between(1, 12), number("hour", 0) < 24]
    if "noon" in of:
        fits.append(hour <= 12)
        hour = hour % 12 + F.when(F.upper(of["noon"]) == "PM", 12).otherwise(0)
    second = number("second", 0)
    fits.append(second < 60)
    if "fraction" in of:
        second = F.concat(second.cast("string"), F.lit("."), F.substring(F.rpad(of["fraction"], 9, "0"), 1, 6)).try_cast("decimal(16,6)")
    if "yearday" in of:
        fits.append(number("yearday", 1).between(1, 366))
        start = F.try_make_timestamp_ntz(year, F.lit(1), F.lit(1), hour, number("minute", 0), second)
        made = start + F.make_dt_interval(number("yearday", 1) - 1)
    else:
        made = F.try_make_timestamp_ntz(year, month, number("day", 1), hour, number("minute", 0), second)
    whole = fits[0]
    for f in fits[1:]:
        whole = whole & f
    return F.when(whole, made)
