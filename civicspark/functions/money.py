"""Amounts, filing codes, and the one predicate of what counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, lookup

# Fixed values.
FILING_CODES = {"1A": "Individual Contribution", "2A": "Transfer In", "3A": "Loan Received", "4A": "Other Receipt", "5A": "In-kind Contribution"}
DUES_TYPE, OTHER_TYPE = "IE Committee Dues Transfer", "Other Receipt"
RECORD = {"yes": "yes", "no": "no", "abstain": "present", "not voting": "present", "absent": "absent", "excused": "absent"}
POSITION = {"yes": "Affirmative", "no": "Oppositional", "abstain": "Neutral", "not voting": "Neutral", "absent": "-", "excused": "-"}
BILL_PREFIXES = {"SO": "ordinance", "O": "ordinance", "SOR": "order", "OR": "order", "SR": "resolution", "R": "resolution", "F": "communication"}
MONEY = "decimal(18,2)"


def cents(text: Column) -> Column:
    """Decimal text to money, half up; blank is 0, what isn't a number null."""
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.lit(0).cast(MONEY)).otherwise(F.round(F.trim(text).try_cast("decimal(20,6)"), 2).cast(MONEY))


def total(c: Column) -> Column:
    """An exact sum, as money; 0 of no rows."""
    return F.coalesce(F.sum(c), F.lit(0)).cast(MONEY)


def filing_type(code: Column) -> Column:
    return lookup(FILING_CODES, code)


def is_loan(kind: Column) -> Column:
    return F.coalesce(kind == "Loan Received", F.lit(False))


def is_in_kind(kind: Column) -> Column:
    return F.coalesce(kind == "In-kind Contribution", F.lit(False))


def is_dues(name: Column) -> Column:
    return F.coalesce(name.rlike(r"(?i)\b(dues|membership|member\s+contributions?)\b"), F.lit(False))


def donor_type(kind: Column, self_funded: Column, individual: Column) -> Column:
    """How a donor is shown: from the filing code's name, the self flag and the shape of the name."""
    return F.when(self_funded, "Self").when(individual, "Individual").when(kind == "Transfer In", "PAC").otherwise("Other")


def is_excluded_other(kind: Column, own_committee: Column) -> Column:
    return (kind == OTHER_TYPE) & ~F.coalesce(own_committee, F.lit(False))


def counted(kind: Column, cycle: Column, aggregate: Column, own_committee: Column, donor_type: Column, uncounted: tuple[str, ...] = ("pre-2011", "undated")) -> Column:
    """What every published total is made of: not an aggregate row, in a cycle, no dues between committees,
    no other receipt unless from an own committee, and from a donor that is known and not an aggregate."""
    return (
        ~F.coalesce(aggregate, F.lit(False))
        & ~F.coalesce(cycle, F.lit("undated")).isin(*uncounted)
        & (kind != DUES_TYPE)
        & ~is_excluded_other(kind, own_committee)
        & donor_type.isNotNull()
        & (donor_type != "Aggregate")
    )


def bill_type(identifier: Column, classification: Column) -> Column:
    prefix = F.upper(F.regexp_extract(F.coalesce(identifier, F.lit("")), "^([A-Za-z]+)", 1))
    return F.coalesce(blank_to_null(classification), lookup(BILL_PREFIXES, prefix, F.lit("other")))


def vote_record(option: Column) -> Column:
    return lookup(RECORD, option)


def vote_position(option: Column) -> Column:
    return lookup(POSITION, option)


def parse_date(text: Column) -> Column:
    """M/D/YYYY to a date, else null."""
    return F.try_to_timestamp(F.trim(text), F.lit("M/d/yyyy")).cast("date")


def short_date(value: Column) -> Column:
    return F.date_format(value, "M/d/yyyy")
