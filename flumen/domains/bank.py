"""Bank defaulters: card points, medical-loan late payments, personal-loan
missed months, and the co-group of card and loan defaulters.

Per-customer work is partial aggregation only: the personal-loan rule needs
the *set* of paid months, which is kept as a 12-bit mask (``bit_or``), never as
a list, so a customer with any number of payments costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.functions import collections as coll
from flumen.functions import dates, strings
from flumen.operators import joins

# Rule constants of the bank requirements (as the code applies them).
PAID_SHARE = 0.7
MIN_LATE_MEDICAL = 3
MAX_MISSED_MONTHS = 4
MAX_CONSECUTIVE_MISSED = 2
MEDICAL, PERSONAL = "Medical Loan", "Personal Loan"


def statement_points() -> Column:
    """Points of a statement. +1 paid < 70% of spent; +1 spent == limit and anything
    unpaid; +1 more when spent == limit and paid < 70% of spent."""
    spent, limit, paid = F.col("spent"), F.col("max_limit"), F.col("payment_cleared")
    share = spent * F.lit(PAID_SHARE)
    at_limit = spent == limit
    return (F.when(paid < share, 1).otherwise(0)
            + F.when(at_limit & (paid < spent), 1).otherwise(0)
            + F.when(at_limit & (paid < share), 1).otherwise(0))


def card_points(cards: DataFrame, key="customer_id", points: Column | None = None) -> DataFrame:
    """Points of the statements, summed per customer, kept when > 0. ``points``: those of a
    row, if it is not a statement but a sum of some."""
    out = cards.groupBy(key).agg(F.sum(statement_points() if points is None else points).cast("bigint").alias("points"))
    return out.filter(F.col("points") > 0)


def loan_summary(loans: DataFrame, key="customer_id") -> DataFrame:
    """One pass over the loans: per customer, late medical payments and, for
    personal loans, the payment count and the 12-bit set of paid months."""
    cat = strings.strip("category")
    medical, personal = cat == MEDICAL, cat == PERSONAL
    late = (dates.parse_dmy("payment_date") > dates.parse_dmy("due_date")
            if "due_date" in loans.columns else F.lit(False))
    month_bit = F.pow(F.lit(2), dates.month_of(dates.parse_dmy("payment_date"))).cast("int")
    return loans.groupBy(key).agg(
        F.count(F.when(medical & late, 1)).alias("medical_late"),
        F.count(F.when(personal, 1)).alias("personal_n"),
        F.bit_or(F.when(personal, month_bit)).alias("personal_mask"),
    )


def _medical_rule():
    """Medical loans paid after the due date; >= 3 kept."""
    return F.when(F.col("medical_late") >= MIN_LATE_MEDICAL,
                  F.struct(F.col("medical_late").cast("bigint").alias("missed"), F.lit("late").alias("reason")))


def _with_gap(summary: DataFrame) -> DataFrame:
    """``gap``: the longest run of unpaid months (before the first, between, after the last)."""
    months = F.filter(F.sequence(F.lit(1), F.lit(12)),
                      lambda m: F.col("personal_mask").bitwiseAND(F.pow(F.lit(2), m).cast("int")) != 0)
    return summary.withColumn("gap", coll.longest_gap(months))


def _personal_rule(max_missed: int, max_gap: int):
    """Personal loans: missed = 12 - payments (each payment row counts); if
    missed > max_missed report it, else the longest gap if > max_gap, else nothing."""
    missed, gap = F.lit(12) - F.col("personal_n"), F.col("gap")
    rule = (F.when(missed > max_missed, F.struct(missed.cast("bigint").alias("missed"), F.lit("missed").alias("reason")))
            .when(gap > max_gap, F.struct(gap.cast("bigint").alias("missed"), F.lit("gap").alias("reason"))))
    return F.when(F.col("personal_n") > 0, rule)


def _reported(summary: DataFrame, key, *rules) -> DataFrame:
    """One row per customer and rule that reports something, all from one summary row."""
    found = F.filter(F.array(*rules), lambda r: r.isNotNull() & (r["missed"] > 0))
    return summary.select(key, F.explode(found).alias("r")).select(key, "r.missed", "r.reason")


def medical_defaulters(loans: DataFrame, key="customer_id") -> DataFrame:
    return _reported(loan_summary(loans, key), key, _medical_rule())


def personal_defaulters(loans: DataFrame, key="customer_id", max_missed: int = MAX_MISSED_MONTHS,
                        max_gap: int = MAX_CONSECUTIVE_MISSED) -> DataFrame:
    return _reported(_with_gap(loan_summary(loans, key)), key, _personal_rule(max_missed, max_gap))


def loan_defaulters(loans: DataFrame, key="customer_id") -> DataFrame:
    """Personal and medical defaulters; the loans are read and aggregated once."""
    return _reported(_with_gap(loan_summary(loans, key)), key,
                     _personal_rule(MAX_MISSED_MONTHS, MAX_CONSECUTIVE_MISSED), _medical_rule())


def both_defaulters(card: DataFrame, loan: DataFrame, key="customer_id") -> DataFrame:
    """Co-group of card and loan defaulters per customer. Each side has at most
    one row per (customer, rule), so the per-key lists are bounded by the
    number of rules."""
    g = joins.cogroup({"card": card.select(key, "points"),
                       "loan": loan.select(key, "reason", "missed")}, key)
    return g.select(
        key,
        F.array_join(F.transform("card", lambda x: x["points"].cast("string")), ";").alias("card"),
        F.array_join(F.transform("loan", lambda x: F.format_string("%s:%d", x["reason"], x["missed"])), ";")
        .alias("loan"),
        F.size("card").cast("bigint").alias("n_card"),
        F.size("loan").cast("bigint").alias("n_loan"),
    )
