"""Package scoring: popularity (how often a name is imported), needs-help (how
many marker lines its sources hold) and the composite ``ln(help) * ln(pop)``.

Names are credited to every prefix (``a``, ``a.b``, ``a.b.c``). All steps are
explode + partial aggregation; the only broadcast is the top-``n`` popularity
list, whose size is bounded by ``n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.functions import numeric, strings
from flumen.operators import aggregates as agg

# The reference's keywords, markers and list size.
IMPORT_KEYWORD = "import"
PACKAGE_KEYWORD = "package"
HELP_MARKERS = ("FIXME", "TODO")
TOP_N = 1000


def package_uses(df: DataFrame, text_col: str, keyword: str = IMPORT_KEYWORD, sep: str = ".",
                 end: str = ";") -> DataFrame:
    """One row ``(package)`` per prefix of the name on every line that starts
    with ``keyword`` (``import a.b.c;`` -> a, a.b, a.b.c)."""
    lines = df.select(F.explode(strings.lines(text_col)).alias("line"))
    names = lines.filter(F.col("line").startswith(keyword)).select(
        strings.text_between("line", keyword, end).alias("name")).filter(F.col("name").isNotNull())
    return names.select(F.explode(strings.prefixes("name", sep)).alias("package"))


def name_uses(df: DataFrame, name: Column, sep: str = ".") -> DataFrame:
    """Same as :func:`package_uses` when the name is a column (one use per row)."""
    return df.select(F.explode(strings.prefixes(name, sep)).alias("package"))


def popularity(uses: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """Top ``top_n`` packages by use count (ties by name)."""
    counts = agg.count_per_key(uses, "package", "popularity")
    return agg.top_n(counts, top_n, "popularity", "package")


def marker_count(text_col: str, markers=HELP_MARKERS) -> Column:
    """Number of lines of a text that contain any marker word."""
    return F.size(F.filter(strings.lines(text_col), lambda l: strings.contains_any(l, markers)))


def last_keyword_name(text_col: str, keyword: str = PACKAGE_KEYWORD, end: str = ";") -> Column:
    """Name on the *last* line starting with ``keyword`` (NULL when none)."""
    hits = F.filter(strings.lines(text_col), lambda l: l.startswith(keyword))
    return strings.text_between(F.try_element_at(hits, F.lit(-1)), keyword, end)


def needs_help(df: DataFrame, text_col: str, name: Column | None = None,
               markers=HELP_MARKERS, sep: str = ".") -> DataFrame:
    """Per package prefix: total marker lines of the records naming it; zero
    totals dropped. ``name`` defaults to the last ``package ...;`` line."""
    name = name if name is not None else last_keyword_name(text_col)
    per_record = df.select(name.alias("name"), marker_count(text_col, markers).alias("n"))
    per_record = per_record.filter(F.col("name").isNotNull())
    credited = per_record.select(F.explode(strings.prefixes("name", sep)).alias("package"), "n")
    totals = agg.sum_per_key(credited, "package", "n", "help")
    return totals.filter(F.col("help") > 0)


def composite_score(popular: DataFrame, help_: DataFrame) -> DataFrame:
    """``ln(help) * ln(popularity)`` for popular packages that need help, kept
    when > 0. ``popular`` is a top-n list (bounded), so it is the broadcast side."""
    joined = help_.join(F.broadcast(popular), "package")
    joined = joined.filter(F.col("help").isNotNull() & (F.col("help") != 0))
    scored = joined.select("package", numeric.log_product("help", "popularity").alias("score"))
    return scored.filter(F.col("score") > 0)
