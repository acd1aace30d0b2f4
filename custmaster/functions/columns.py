"""Column rules shared by the datasets (all built-in expressions, codegen'd)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

STR = "string"


def text(c: Column | str) -> Column:
    """The value as text."""
    return (F.col(c) if isinstance(c, str) else c).cast(STR)


def null_text() -> Column:
    """A NULL of type text: placeholder that aligns union arms."""
    return F.lit(None).cast(STR)


def blank() -> Column:
    """Empty text: placeholder of a profile column that has no source yet."""
    return F.lit("")


def non_blank(c: Column | str) -> Column:
    """Neither NULL nor empty."""
    c = F.col(c) if isinstance(c, str) else c
    return (c != F.lit("")) & c.isNotNull()


def usable_income(pay_source: Column, income: Column) -> Column:
    """An income declaration is kept when it names a source or an amount.

    So a blank source passes together with an amount and stays in the source set.
    """
    return non_blank(pay_source) | income.isNotNull()


def in_force(end_datetime: Column, as_of: dt.date) -> Column:
    """Ends on the business date or later, or never."""
    return (F.to_date(end_datetime) >= F.lit(as_of)) | end_datetime.isNull()


def birth_digit(birthday: Column) -> Column:
    """Partition digit: the birthday text's 4th character if it is a digit.

    Masked and NULL birthdays give '0'.  Always text (see SURVEY S5).
    """
    d = F.substring(birthday, 4, 1)
    return F.when(d.rlike("[0-9]"), d).otherwise(F.lit("0"))


def flag_or_zero(flag: Column) -> Column:
    """The flag as text, '0' where it is NULL (list-membership flags are NULL or '1')."""
    return F.coalesce(text(flag), F.lit("0"))


def stamp(day: dt.date) -> Column:
    """A date as ``TIMESTAMP_NTZ`` (audit columns)."""
    return F.lit(day).cast("timestamp_ntz")
