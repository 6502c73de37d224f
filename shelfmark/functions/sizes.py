"""Human-readable byte counts."""

from __future__ import annotations

import re
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unit names of each family, from bytes upward in steps of 1024.
SYMBOLS = {
    "customary": ("B", "K", "M", "G", "T", "P", "E", "Z", "Y"),
    "customary_ext": ("byte", "kilo", "mega", "giga", "tera", "peta", "exa", "zetta", "iotta"),
    "iec": ("Bi", "Ki", "Mi", "Gi", "Ti", "Pi", "Ei", "Zi", "Yi"),
    "iec_ext": ("byte", "kibi", "mebi", "gibi", "tebi", "pebi", "exbi", "zebi", "yobi"),
}

# A name, flags, width, precision and conversion, as in printf-style formatting.
_PLACEHOLDER = re.compile(r"(%\((?:value|symbol)\)[-+ 0]*\d*(?:\.\d+)?[dfis]|%%)")
_PARTS = re.compile(r"%\((value|symbol)\)([-+ 0]*)(\d*)(?:\.(\d+))?([dfis])")

_EXA = 6  # the last step whose unit, 2**60, a long can hold


def readable_bytes(
    n: Column,
    format: str = "%(value).1f %(symbol)s",
    symbols: str = "customary",
    strict: bool = False,
) -> Column:
    """``n`` in its largest unit not above it, e.g. ``9.6 K``.

    Fractions are cut off first, and the shown digits round half to even.
    ``format`` names ``value`` at least once and ``symbol`` as often as wanted, with
    flags, width and precision: ``f`` shows digits after the point (6 if not said),
    ``d`` cuts them off, ``s`` shows as many as there are.
    Negative counts give null, or fail the job when ``strict``.  Decimal counts
    and doubles may go beyond what a long holds.
    """
    pieces = _PLACEHOLDER.split(format)
    if any("%" in piece for piece in pieces[::2]) or not any(piece.startswith("%(value)") for piece in pieces):
        raise ValueError(f"cannot read the format {format!r}, or it does not show the value")
    names = SYMBOLS[symbols]

    def text(wide: bool) -> Column:
        whole = _truncate(n) if wide else n.cast("long")
        negative = F.raise_error(F.lit("byte count below zero")) if strict else F.lit(None)
        whole = F.when(whole >= 0, whole).when(whole < 0, negative.cast("decimal(38,0)" if wide else "long"))

        def render(value: Callable[[str, str], Column], symbol: Column) -> Column:
            # Not conditional on the count, so that common subexpressions are computed once.
            return F.concat(*[_filled(piece, value, symbol) for piece in pieces if piece])

        count = whole.try_cast("long") if wide else whole
        long_steps = range(_EXA, 0, -1)
        symbol = _by_step(count, long_steps, lambda step: names[step], names[0])
        small = _by_step(count, long_steps, lambda step: float(1 << (10 * step)), 1.0)

        def short_value(places: str, kind: str) -> Column:
            if kind == "s":
                shown = (count.cast("double") / small).cast("string")
                return F.when(count < 1024, count.cast("string")).otherwise(shown)
            if kind != "f":
                return F.floor(count.cast("double") / small).cast("string")
            digits = int(places or 6)
            return _from_long(count, digits) if digits <= 3 else _from_double(count, small, digits)

        short = render(short_value, symbol)
        if not wide:
            return short
        huge_steps = range(len(names) - 1, _EXA, -1)
        huge_symbol = _by_step(whole, huge_steps, lambda step: names[step], names[_EXA])
        unit = _by_step(whole, huge_steps, lambda step: float(1 << (10 * step)), float(1 << (10 * _EXA)))

        def huge_value(places: str, kind: str) -> Column:
            share = whole.cast("double") / unit
            if kind == "s":
                return share.cast("string")
            return F.floor(share).cast("string") if kind != "f" else _from_double(whole, unit, int(places or 6))

        return F.coalesce(short, render(huge_value, huge_symbol))

    # The type is a constant of the plan, so only one of the two is left in it.
    return F.when(F.typeof(n).rlike("^(decimal|double|float)"), text(wide=True)).otherwise(text(wide=False))


def _filled(piece: str, value: Callable[[str, str], Column], symbol: Column) -> Column:
    """The text of one piece of a format: a placeholder, ``%%``, or itself."""
    if piece == "%%":
        return F.lit("%")
    named = _PARTS.fullmatch(piece)
    if named is None:
        return F.lit(piece)
    name, flags, width, places, kind = named.groups()
    if name == "symbol" and kind != "s":
        raise ValueError(f"the symbol is a text: {piece}")
    text = symbol if name == "symbol" else value(places, kind)
    if kind == "s" and places is not None:
        text = F.substring(text, 1, int(places))
    sign = "+" if "+" in flags else " " if " " in flags else ""
    number = name == "value" and kind != "s"
    if number and sign:
        text = F.concat(F.lit(sign), text)
    if not width:
        return text
    missing = F.greatest(F.lit(int(width)) - F.length(text), F.lit(0))
    if "-" in flags:
        return F.concat(text, F.repeat(F.lit(" "), missing))
    if "0" in flags and number:
        digits = F.concat(F.repeat(F.lit("0"), missing), text)
        return F.concat(F.lit(sign), F.repeat(F.lit("0"), missing), F.substr(text, F.lit(2))) if sign else digits
    return F.concat(F.repeat(F.lit(" "), missing), text)


def _truncate(n: Column) -> Column:
    exact = n.cast("decimal(38,6)")
    return F.when(exact < 0, F.ceil(exact)).otherwise(F.floor(exact)).cast("decimal(38,0)")


def _by_step(n: Column, steps: range, value: Callable, smallest) -> Column:
    """A literal chosen by the largest unit that ``n`` reaches."""
    chosen = F
    for step in steps:
        limit = 1 << (10 * step)
        bound = F.lit(limit) if limit < 1 << 63 else F.lit(Decimal(limit)).cast("decimal(38,0)")
        chosen = chosen.when(n >= bound, F.lit(value(step)))
    return chosen.otherwise(F.lit(smallest))


def _from_double(n: Column, unit: Column, places: int) -> Column:
    # format_string rounds half up, hence the rounding beforehand, and spells out a null.
    shown = F.bround(n.cast("double") / unit, places)
    return F.when(shown.isNotNull(), F.format_string(f"%.{places}f", shown))


def _from_long(n: Column, places: int) -> Column:
    """``n`` over its unit by shifts and masks: exact, and far cheaper than a formatter.

    Nothing here is conditional on the unit, so that common subexpressions are
    computed once.  Counts from 2**53 up take the value of their nearest double,
    as a floating-point division would; its low bits are zero, and dropping
    eight of them keeps 2**60 from overflowing.
    """
    exact = F.when(n < 1 << 53, n).otherwise(n.cast("double").cast("long"))
    exact = F.call_function("shiftright", exact, F.when(n >= 1 << 60, 8).otherwise(0))
    bits = _by_step(n, range(_EXA, 0, -1), lambda step: 10 * step if step < _EXA else 52, 0)
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), bits)
    scaled = exact.bitwiseAND(unit - 1) * 10**places
    left = scaled.bitwiseAND(unit - 1) * 2
    total = F.call_function("shiftright", exact, bits) * 10**places + F.call_function("shiftright", scaled, bits)
    # Half to even: add one above the half, and on the half when the sum is odd.
    rounded = total + ((left + total % 2) > unit).cast("long")
    if not places:
        return rounded.cast("string")
    fraction = F.lpad((rounded % 10**places).cast("string"), places, "0")
    return F.concat(F.call_function("div", rounded, F.lit(10**places)).cast("string"), F.lit("."), fraction)
