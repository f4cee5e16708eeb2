"""Text helpers that follow Python's line and whitespace model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trialmill.functions.stats import let

#: From here on the parts of a product with 20 000 are not exact, and shortest forms tell ties well enough.
_WHOLE = 2.0**37

# Line terminators and the remaining Unicode whitespace
TERMINATORS = r"\n\r\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}"
LINE_BREAK = rf"\r\n|[{TERMINATORS}]"
BLANK = r" \t\x{1F}\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
SPACE = BLANK + TERMINATORS

# a whole line, with its terminator, whose first visible characters are three backticks
FENCE_LINE = rf"(?:\A|(?<=[{TERMINATORS}]))[{BLANK}]*```[^{TERMINATORS}]*(?:{LINE_BREAK}|\z)"


# the same characters as text: trimming looks at both ends only, a pattern would walk through everything
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
RARE_TERMINATORS = ("\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029")


def strip(text: Column) -> Column:
    """Without Unicode whitespace at both ends."""
    return F.trim(text, F.lit(WHITESPACE))


def contains_any(text: Column, words: tuple[str, ...] | list[str]) -> Column:
    """Plain substring search; it stops at the first word found."""
    found = text.contains(words[0])
    for w in words[1:]:
        found = found | text.contains(w)
    return found


def folded(text: Column) -> Column:
    """Lower case in the sense of case-blind patterns, where long s is an s and every i an i."""
    odd = ("\u017f", "\u0131", "\u0307")

    def fold(v: Column) -> Column:
        return F.when(contains_any(v["low"], odd), F.translate(v["low"], "".join(odd), "si")).otherwise(v["low"])

    return let({"low": F.lower(text)}, fold)


def lines(text: Column) -> Column:
    """Array of lines; a final terminator does not start another line."""
    parts = F.when(contains_any(text, RARE_TERMINATORS), F.split(text, LINE_BREAK, -1)).otherwise(F.split(text, "\n", -1))
    return F.filter(parts, lambda x, i: (x != "") | (i < F.size(parts) - 1))


def pieces(text: Column) -> Column:
    """Text between fence lines; every second piece lies inside a fence."""
    return F.when(text.contains("```"), F.split(text, FENCE_LINE, -1)).otherwise(F.array(text))


def strip_fences(text: Column) -> Column:
    """Model output without the lines that open or close a code fence."""
    trimmed = strip(text)
    kept = F.filter(F.split(trimmed, "\n", -1), lambda x: ~x.startswith("```"))
    return F.when(trimmed.startswith("```"), strip(F.array_join(kept, "\n"))).otherwise(trimmed)


def slug(label: Column) -> Column:
    """Lower case, runs of other characters become one dash, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(label), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def decimals(x: Column, digits: int) -> Column:
    """A double with ``digits`` (0 to 4) decimals, rounded by its exact binary value and half to even.

    Java rounds the shortest decimal form and half up, so that 0.125 becomes 0.13 there and 0.12 here. Twice the
    scaled number is compared with the nearest whole one; the product is taken in two parts, each of them exact.
    Null stays null; infinities and NaN are spelled inf, -inf and nan.
    """
    scale = 2.0 * 10**digits
    high = x.cast("float").cast("double")
    nearest = F.rint(x * scale)
    beyond = (high * scale - nearest) + (x - high) * scale
    down = F.floor(nearest / 2)
    tie = F.pmod(nearest, F.lit(2.0)) == 1
    up = tie & ((beyond > 0) | ((beyond == 0) & (F.pmod(down, F.lit(2)) == 1)))
    whole = down + F.when(up, 1).otherwise(0)
    text = F.format_string(f"%.{digits}f", F.abs(whole) / 10.0**digits)
    return (
        F.when(x.isNull(), None)
        .when(F.isnan(x), "nan")
        .when(F.abs(x) == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
        .when(F.abs(x) >= _WHOLE, F.format_string(f"%.{digits}f", F.bround(x, digits)))
        .otherwise(F.concat(F.when(x < 0, "-").otherwise(""), text))
    )


def percent(x: Column, digits: int) -> Column:
    """A share in percent with ``digits`` decimals."""
    return F.concat(decimals(x * 100, digits), F.lit("%"))
