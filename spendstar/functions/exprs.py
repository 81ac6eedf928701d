"""Column helpers.

Each helper returns a ``Column`` built only from Spark built-ins, so it stays
inside whole-stage codegen. The helpers pin down the places where Spark's
defaults differ from the warehouse's semantics (trim, rounding, strict casts).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode "space separator" (Zs) characters: the set ``trim`` strips. Tab, line
# breaks and zero-width characters are not in it and are kept.
ZS_CHARS = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_zs(c: Column | str) -> Column:
    """Strip leading and trailing Unicode space separators (not tabs/newlines)."""
    return F.btrim(_col(c), F.lit(ZS_CHARS))


# Word starts whose capital is one letter, not the several that full case mapping gives, or
# not the title-case form. Rules: Georgian capitals lie 0xBC0 above; a letter that full
# mapping would spell out stays as it is.
_GEORGIAN = [*range(0x10D0, 0x10FB), *range(0x10FD, 0x1100)]
_SPELLED_OUT = [chr(k) for k in range(0x80, 0xFB18) if len(chr(k).title()) > 1 and chr(k).lower() == chr(k)]
# --- fixed values: capital sharp s and the digraphs' capitals ---
_CAPITALS = {"ß": "ẞ", "ǆ": "Ǆ", "ǉ": "Ǉ", "ǌ": "Ǌ", "ǳ": "Ǳ"}
# ----------------------------------------------------------------
SPECIAL_CAPITALS = (
    {c: c for c in _SPELLED_OUT} | {chr(k): chr(k + 0xBC0) for k in _GEORGIAN} | _CAPITALS
)
_SPECIAL = "".join(SPECIAL_CAPITALS)


def canonical_name(c: Column | str) -> Column:
    """Title-case a free-text name: lower-case, trim, upper-case each word start.

    Words are split on single ASCII spaces only, so inner double spaces, tabs and
    hyphens survive (``' PAID  search-ads'`` -> ``'Paid  Search-ads'``). Letters map one to
    one, as in the source engine: no final sigma, no dot beside a lower-cased dotted I,
    and capitals of one letter. Names with such letters take the way word by word.
    """
    low = F.lower(trim_zs(F.translate(_col(c), "Σİ", "σi")))

    def capitalised(word: Column) -> Column:
        first = F.left(word, F.lit(1))
        special = F.translate(first, _SPECIAL, "".join(SPECIAL_CAPITALS.values()))
        return F.concat(F.when(_holds_special(first), special).otherwise(F.initcap(first)), F.substr(word, F.lit(2)))

    by_word = F.array_join(F.transform(F.split(low, " "), capitalised), " ")
    return F.when(_holds_special(low), by_word).otherwise(F.initcap(low))


def _holds_special(text: Column) -> Column:
    # plain ASCII, by far the most, is told by its length in bytes
    return (F.octet_length(text) > F.length(text)) & (F.translate(text, _SPECIAL, "") != text)


def round_half_away(y: Column) -> Column:
    """Round a double to an integral double, half away from zero, on its exact value.

    ``rint`` rounds half to even; only an exact ``.5`` differs, and there
    ``y +/- 0.5`` is exact. Plain double arithmetic, no decimal conversion per row.
    NaN and infinity pass through unchanged.
    """
    r = F.rint(y)
    return F.when(F.abs(y - r) == F.lit(0.5), y + F.signum(y) * F.lit(0.5)).otherwise(r)


def r2(x: Column) -> Column:
    """Round a double to cents, half away from zero, on the exact product ``x*100``.

    ``round(x, 2)`` rounds the decimal text of ``x`` instead and disagrees on
    half-cent products; rounding the double ``x*100`` to an integer does not.
    """
    return round_half_away(x * F.lit(100.0)) / F.lit(100.0)


# Numbers as the source engine reads them: digits, a point, an exponent. No type suffix,
# no hexadecimal form.
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_WORD = r"^[+-]?([nN][aA][nN]|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
# Dates: year, month and day with one separator, then nothing or a time of day.
_DATE = (
    r"^([0-9]{4,6}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4,6}/[0-9]{1,2}/[0-9]{1,2})"
    r"([ T](([01]?[0-9]|2[0-3]):[0-5]?[0-9](:[0-5]?[0-9]([.][0-9]+)?)?|24:0?0(:0?0([.]0+)?)?)"
    r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?$"
)


def _checked(text: Column, grammar: Column, what: str, value: Column) -> Column:
    failed = F.raise_error(F.concat(F.lit(f"invalid {what} text: "), text))
    return F.when(text.isNull() | grammar, value).otherwise(failed)


def _ends(c: Column, first: str, last: str) -> Column:
    """Whether the first character lies between the two of ``first``, the last between those of ``last``."""
    return F.ascii(c).between(*map(ord, first)) & F.substring(c, -1, 1).between(*last)


def _bare(c: Column) -> Column:
    """Text without the separators that ``trim`` strips and the white space that casts skip."""
    return F.btrim(c, F.lit(ZS_CHARS + "\t\n\x0b\x0c\r"))


def to_double_strict(c: Column | str) -> Column:
    """Text -> double; text that is not a plain number aborts the job.

    Text without letters that begins and ends as a number does is cast at once: the ANSI cast
    then takes plain numbers and nothing else. The grammar is asked about the rest.
    """
    c = _col(c)
    plain = _ends(c, "+9", ".9") & (F.lower(c) == F.upper(c))
    t = _bare(c)
    checked = _checked(t, t.rlike(_NUMBER) | t.rlike(_WORD), "number", t.cast("double"))
    return F.when(plain, c.cast("double")).otherwise(checked)


def to_int_strict(c: Column | str) -> Column:
    """Text -> int accepting ``'12.5'`` (13), ``'-2.5'`` (-3) and ``'1e5'``.

    Parsed as double, rounded half away from zero, then an ANSI cast that raises
    on overflow, NaN and infinity.
    """
    return round_half_away(to_double_strict(c)).cast("int")


def to_date_strict(c: Column | str) -> Column:
    """Text -> date accepting ``2026-1-5``, ``2026/01/05`` and a trailing time of day; else abort.

    Ten characters with hyphens in their places are cast at once: the ANSI cast takes
    four, two and two digits there and nothing else.
    """
    c = _col(c)
    plain = (
        (F.length(c) == 10)
        & (F.substring(c, 5, 1) == "-")
        & (F.substring(c, 8, 1) == "-")
        & _ends(c, "09", "09")
    )
    t = _bare(c)
    day = F.regexp_extract(t, r"^[0-9]+[-/][0-9]+[-/][0-9]+", 0)
    checked = _checked(t, t.rlike(_DATE), "date", F.translate(day, "/", "-").cast("date"))
    return F.when(plain, c.cast("date")).otherwise(checked)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` in double, NULL when the denominator is 0 or NULL."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def ctr_pct(clicks: Column, impressions: Column) -> Column:
    """Click-through rate in percent from summed clicks and impressions."""
    return r2(safe_ratio(F.lit(100.0) * clicks.cast("double"), impressions))


def cost_per_conversion(spend: Column, conversions: Column) -> Column:
    """Spend per conversion from summed spend and conversions."""
    return r2(safe_ratio(spend, conversions))


def money_to_double(c: Column) -> Column:
    """A decimal money amount as a JSON-friendly double."""
    return c.cast("double")


def date_key(d: Column | str) -> Column:
    """Integer ``yyyymmdd`` of a date."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
