"""Text to timestamp, date and decimal. A value that cannot be read becomes NULL."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted formats, tried in this order, first match wins. The two lists
# disagree on slash dates on purpose: timestamps read month first, dates read day first.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "dd-MM-yyyy HH:mm:ss",
    "yyyy/MM/dd",
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "dd/MM/yyyy",
)
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy/MM/dd")

_TOKEN = re.compile(r"'[^']*'|([A-Za-z])\1*|.")
# The last years that are readable from their first to their last day. Spark's parse, try_
# variants included, fails the job on a date outside the range of the type, which begins and ends
# within the next years, so those must not reach it.
LAST_YEAR, FIRST_YEAR = 294246, -290307


def _at_most(n: int) -> str:
    """Regular expression of the numbers with as many digits as ``n``, up to ``n``."""
    digits, choices = str(n), [str(n)]
    for i, d in enumerate(digits):
        least = 0 if i else 1
        if int(d) > least:
            choices.append(f"{digits[:i]}[{least}-{int(d) - 1}][0-9]{{{len(digits) - i - 1}}}")
    return f"(?:{'|'.join(choices)})"


def _year(sign: str, least_digits: int, last: int) -> str:
    """A signed year up to ``last``, zeros before it included, of 19 digits at most."""
    return f"{sign}(?=[0-9]{{{least_digits},19}}(?![0-9]))0*(?:[0-9]{{1,{len(str(last)) - 1}}}|{_at_most(last)})"


_DIGITS = {
    "yyyy": f"(?:[0-9]{{4}}|{_year('[+]', 5, LAST_YEAR)}|{_year('-', 4, -FIRST_YEAR)})",
    **dict.fromkeys(("MM", "dd", "HH", "mm", "ss"), "[0-9]{2}"),
    **dict.fromkeys(("M", "d", "H", "m", "s"), "[+-]?[0-9]+"),
    **{"S" * n: f"[0-9]{{1,{n}}}" for n in range(1, 10)},
}


def text_shape(fmt: str) -> str | None:
    """Regular expression that every text readable with ``fmt`` matches.

    None where the format uses letters whose texts are not plain digits. Such formats are
    tried on every text.
    """
    if "''" in fmt or set(fmt) & set("[]{}#"):
        return None
    parts = []
    for token in (m.group() for m in _TOKEN.finditer(fmt)):
        if token[0].isalpha():
            if token not in _DIGITS:
                return None
            parts.append(_DIGITS[token])
        else:
            parts.append(re.escape(token.strip("'")))
    return f"(?i)^{''.join(parts)}$"


_DATE, _TIME = ("yyyy", "MM", "dd"), ("HH", "mm", "ss")
_FRACTION = 6  # digits that a timestamp holds
_SIGNED_YEAR = "[+]|(?:^|[^0-9])-"


class Layout(NamedTuple):
    """Texts of one length: ``shape`` has 9 for each digit, ``at`` the place of each field."""

    shape: str
    at: dict[str, tuple[int, int]]


def layouts(fmt: str) -> list[Layout]:
    """The layouts of the texts that ``fmt`` reads, years of four digits; none if it reads others.

    Those are formats of a whole date and no, some or all fields of a time, each with a fixed
    number of digits and with something other than digits between them.
    """
    if "''" in fmt or set(fmt) & set("[]{}#"):
        return []
    made, fraction = [Layout("", {})], 0
    for token in (m.group() for m in _TOKEN.finditer(fmt)):
        if not token[0].isalpha():
            literal = token.strip("'").upper()
            if any(c.isalnum() and c not in "TZ" for c in literal):
                return []
            made = [Layout(x.shape + literal, x.at) for x in made]
            continue
        if token in made[0].at or made[0].shape.endswith("9"):
            return []
        if set(token) == {"S"} and len(token) <= _FRACTION:
            fraction, widths, name = len(token), range(1, len(token) + 1), "S"
        elif token in _DATE + _TIME:
            widths, name = [len(token)], token
        else:
            return []
        made = [Layout(x.shape + "9" * n, {**x.at, name: (len(x.shape), n)}) for x in made for n in widths]
    fields = set(made[0].at)
    n_times = len(fields & set(_TIME))
    whole = fields >= set(_DATE) and fields >= set(_TIME[:n_times]) and (not fraction or n_times == len(_TIME))
    return made if whole else []


def _iso(text: Column, layout: Layout) -> Column:
    """The text's date and time as yyyy-MM-dd[ HH:mm:ss[.S]], of as few pieces as possible."""
    wanted = ["yyyy", "-", "MM", "-", "dd"]
    if "HH" in layout.at:
        for before, name in zip(" ::", _TIME):
            wanted += [before, name if name in layout.at else "00"]
        wanted += [".", "S"] if "S" in layout.at else []
    pieces: list[str | list[int]] = []  # literals and [start, end] of the text
    for part in wanted:
        start, n = layout.at.get(part, (-1, 0))
        end = pieces[-1][1] if pieces and isinstance(pieces[-1], list) else -1
        if n and start == end:
            pieces[-1][1] += n
        elif n:
            pieces.append([start, start + n])
        elif 0 <= end < len(layout.shape) and layout.shape[end] == part:
            pieces[-1][1] += 1
        elif pieces and isinstance(pieces[-1], str):
            pieces[-1] += part
        else:
            pieces.append(part)
    if pieces == [[0, len(layout.shape)]]:
        return text
    columns = [F.lit(x) if isinstance(x, str) else F.substring(text, x[0] + 1, x[1] - x[0]) for x in pieces]
    return F.concat(*columns) if len(columns) > 1 else columns[0]


def _month_first(a: Layout, b: Layout) -> bool:
    """Whether the two only differ in that month and day have changed places."""
    return a.at == {**b.at, "MM": b.at["dd"], "dd": b.at["MM"]} and a.at["MM"][1] == a.at["dd"][1]


def _of_shapes(text: Column, values: dict[str, Column]) -> Column:
    """The value of the shape that a text of their length has; NULL where it has none of them.

    One match looks for all shapes at once; then one character tells each from those after it, as
    where a shape has a separator, others have a digit or another one.
    """
    exact = [re.escape(x).replace("9", "[0-9]").replace("T", "[Tt]").replace("Z", "[Zz]") for x in values]
    *others, last = values
    value = values[last]
    for i in range(len(others) - 1, -1, -1):
        later = [*others[i + 1 :], last]
        at = next((k for k, c in enumerate(others[i]) if not c.isalnum() and all(x[k] != c for x in later)), None)
        here = text.rlike(f"^{exact[i]}\\z") if at is None else F.substring(text, at + 1, 1) == others[i][at]
        value = F.when(here, values[others[i]]).otherwise(value)
    return F.when(text.rlike(f"^(?:{'|'.join(exact)})\\z"), value)


def _classified(text: Column, formats: Sequence[str], kind: str) -> tuple[Column | None, list[str]]:
    """What the formats of fixed layouts read, and the formats that this does not cover.

    The length and one match tell the layout; then the numbers are cut out and go through one
    cast. Where two formats share a shape and only swap month and day, a first number above 12
    is no month, and only then can the second format read what the first one cannot.
    """
    by_shape: dict[str, list[Layout]] = {}
    covered = []
    for fmt in formats:
        found = layouts(fmt)
        if not found or (kind == "date" and "HH" in found[0].at):
            break  # a later format must not go before one that is tried text by text
        if any(len(by_shape.get(x.shape, [])) > 1 or not all(_month_first(y, x) for y in by_shape.get(x.shape, [])) for x in found):
            break
        for x in found:
            by_shape.setdefault(x.shape, []).append(x)
        covered.append(fmt)
    if not covered:
        return None, list(formats)
    by_length: dict[int, dict[str, Column]] = {}
    for shape, ways in by_shape.items():
        value = _iso(text, ways[0])
        if len(ways) > 1:
            start, n = ways[0].at["MM"]
            value = F.when(F.substring(text, start + 1, n) <= "12", value).otherwise(_iso(text, ways[1]))
        by_length.setdefault(len(shape), {})[shape] = value
    iso = reduce(lambda case, n: case.when(F.length(text) == n, _of_shapes(text, by_length[n])), by_length, F)
    return iso.try_cast(kind), list(formats[len(covered) :])


def _first_readable(text: Column, formats: Sequence[str], read, kind: str) -> Column:
    """First format that reads ``text``.

    Most texts are read by ``_classified``, without an attempt that fails. Signed years, and
    formats of other kinds, are tried one after another. A parse that fails costs an exception per
    row, so each one runs only on texts of the right shape; the shape test alone never
    decides, it only skips hopeless parses.
    """
    fast, rest = _classified(text, formats, kind)

    def attempts(some: Sequence[str]) -> list[Column]:
        shapes = [(fmt, text_shape(fmt)) for fmt in some]
        return [read(text, f) if shape is None else F.when(text.rlike(shape), read(text, f)) for f, shape in shapes]

    if fast is None:
        return F.coalesce(*attempts(rest))
    signed = F.when(text.rlike(_SIGNED_YEAR), F.coalesce(*attempts(formats[: len(formats) - len(rest)])))
    return F.coalesce(fast, signed, *attempts(rest))


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Timestamp in the session time zone; surrounding spaces are not removed."""
    return _first_readable(text, formats, lambda c, fmt: F.try_to_timestamp(c, F.lit(fmt)), "timestamp")


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    return _first_readable(text, formats, F.try_to_date, "date")


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    """Decimal rounded half up; NULL when malformed or out of range."""
    return text.try_cast(f"decimal({precision},{scale})")
