"""String recipes. Every function returns a Column built from JVM built-ins, so
the work stays inside whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's ``str.strip()`` removes for these
# records (blank, tab, carriage return, line feed).
STRIP_CHARS = " \t\r\n"

# Fixed value: characters removed from food-order lines before loading.
FOOD_ORDER_JUNK = "[?%&]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(c, sep: str = ",") -> Column:
    """``line.split(',')`` -> array<string> (literal separator, no regex)."""
    return F.split(_c(c), _regex_quote(sep))


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in s)


def strip(c, chars: str = STRIP_CHARS) -> Column:
    """Python ``str.strip()``: removes the whole blank set at both ends.
    (Spark's one-argument ``trim`` removes only spaces.)"""
    return F.btrim(_c(c), F.lit(chars))


def lower(c) -> Column:
    return F.lower(_c(c))


def remove_chars(c, pattern: str = FOOD_ORDER_JUNK) -> Column:
    """Delete every match of a character class, e.g. ``[?%&]``."""
    return F.regexp_replace(_c(c), pattern, "")


def starts_with(c, prefix: str) -> Column:
    return _c(c).startswith(prefix)


def contains_any(c, words) -> Column:
    cond = None
    for w in words:
        t = F.contains(_c(c), F.lit(w))
        cond = t if cond is None else (cond | t)
    return cond


def text_between(c, keyword: str, end: str = ";") -> Column:
    """Text after the first ``keyword`` up to the next ``end``, trimmed of blanks;
    NULL when there is no ``end`` after it (the reference yields nothing then).

    ``line[line.find(kw)+len(kw) : line.find(end, start)].strip()``
    """
    col = _c(c)
    start = F.instr(col, keyword) + F.lit(len(keyword))  # 1-based start of the name
    rest = F.substr(col, start)
    stop = F.instr(rest, end)  # 1-based within rest; 0 = not found
    name = F.when(stop > 1, F.substr(rest, F.lit(1), stop - 1))
    return F.when(F.instr(col, keyword) > 0, strip(name, " \t\r\n"))


def prefixes(c, sep: str = ".") -> Column:
    """All leading prefixes of a separated name, shortest first:
    ``a.b.c`` -> ``[a, a.b, a.b.c]``. Pure higher-order built-ins."""
    col = _c(c)
    parts = F.split(col, _regex_quote(sep))
    every = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, 1, i), sep),
    )
    # a name that begins with the separator has no proper prefix
    return F.when(col.startswith(sep), F.array(col)).otherwise(every)


def lines(c) -> Column:
    """Split a text into its lines (``record.split('\\n')``)."""
    return F.split(_c(c), "\n")


def concat_sep(sep: str, *cols) -> Column:
    return F.concat_ws(sep, *[_c(x) for x in cols])


def utf8_decode(c) -> Column:
    return F.decode(_c(c), "UTF-8")


def utf8_encode(c) -> Column:
    return F.encode(_c(c), "UTF-8")
