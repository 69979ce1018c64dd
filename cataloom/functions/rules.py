"""Campaign indicator rules as Column expressions (all JVM-side).

Each rule takes Columns (or column names) and returns a Column, so the
rules compose into one projection and stay inside whole-stage codegen.
"now" is always an explicit ``as_of`` date, so results repeat.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.column import Column

# Codes and thresholds of the campaign rules.
YES, NO = "Y", "N"
DAY_SUPPLY_BANDS = [(1, 33, 30), (34, 83, 60)]  # (low, high, normalised)
DAY_SUPPLY_LONG_MIN, DAY_SUPPLY_LONG = 84, 90
MINOR_AGE = 18
MAIL, RETAIL = "M", "R"
MAINT_CHOICE_VOLUNTARY = "MV"
MCV_RETAIL_DAYS = (21, 33)
MCV_LONG_DAYS = 84
READY_FILL_PROGRAMS = [5383, 5384]
READY_FILL_SOURCES = ["PTL", "CPT", "PSV", "CPV"]
NOT_CONTROLLED_DEA = ["0", " "]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def yes_no(condition: Column) -> Column:
    """'Y' when the condition holds, 'N' otherwise (NULL counts as not)."""
    return F.when(condition, F.lit(YES)).otherwise(F.lit(NO))


def normalized_day_supply(qty) -> Column:
    """1-33 -> 30, 34-83 -> 60, >= 84 -> 90, anything else NULL."""
    q = _c(qty)
    out = None
    for low, high, norm in DAY_SUPPLY_BANDS:
        out = (F.when if out is None else out.when)(q.between(low, high), F.lit(norm))
    return out.when(q >= DAY_SUPPLY_LONG_MIN, F.lit(DAY_SUPPLY_LONG))


def member_age(birth, as_of, method: str = "months") -> Column:
    """Whole years at ``as_of``.

    ``months``: ``floor(months_between(as_of, birth) / 12)``;
    ``days365``: ``floor(datediff(as_of, birth) / 365)``.
    """
    b = F.to_date(_c(birth))
    now = as_date(as_of)
    if method == "months":
        return F.floor(F.months_between(now, b) / 12)
    if method == "days365":
        return F.floor(F.datediff(now, b) / 365)
    raise ValueError(f"unknown age method {method!r}")


def minor_flag(age) -> Column:
    """'Y' under 18; a NULL age is 'N' (C9)."""
    return yes_no(_c(age) < MINOR_AGE)


def eligible_flag(as_of, start, end) -> Column:
    """'Y' when ``as_of`` lies within [start, end]."""
    return yes_no(as_date(as_of).between(F.to_date(_c(start)), F.to_date(_c(end))))


def retail_to_mail_flag(plan_mail_ind, delivery) -> Column:
    """Plan allows mail and the latest claim was at retail (C11)."""
    return yes_no((_c(plan_mail_ind) == YES) & (_c(delivery) == RETAIL))


def maintenance_choice_flag(choice_type, day_supply, delivery, own_retail, own_mail) -> Column:
    """Voluntary maintenance choice and a 21-33 day retail fill, or an
    84+ day fill at neither own retail nor own mail (C12)."""
    mv = _c(choice_type) == MAINT_CHOICE_VOLUNTARY
    q = _c(day_supply)
    retail_30 = q.between(*MCV_RETAIL_DAYS) & (_c(delivery) == RETAIL)
    outside_90 = (q >= MCV_LONG_DAYS) & (_c(own_retail) == NO) & (_c(own_mail) == NO)
    return yes_no((mv & retail_30) | (mv & outside_90))


def ready_fill_flag(program_id, opt_in_source, opt_out_date) -> Column:
    """Enrolled in a ready-fill program and not opted out.

    The opt-out test compares text, so a DATE column or '' both work under
    ANSI mode.
    """
    opt_out = _c(opt_out_date)
    open_ended = opt_out.isNull() | (opt_out.cast("string") == "")
    return yes_no(
        _c(program_id).isin(READY_FILL_PROGRAMS)
        & _c(opt_in_source).isin(READY_FILL_SOURCES)
        & open_ended
    )


def controlled_substance_flag(dea_class) -> Column:
    """'N' for DEA class '0' or ' '; everything else, NULL included, 'Y' (C14)."""
    return F.when(_c(dea_class).isin(NOT_CONTROLLED_DEA), F.lit(NO)).otherwise(F.lit(YES))


def first_fill_at_mail_flag(plan_mail_ind, delivery, member_mail_count) -> Column:
    """Plan allows mail, latest claim by mail, and the member has exactly
    one mail row (C6)."""
    return yes_no(
        (_c(plan_mail_ind) == YES) & (_c(delivery) == MAIL) & (_c(member_mail_count) == 1)
    )


def recent_fill(fill_date, as_of, days: int = 180) -> Column:
    """Filled fewer than ``days`` days before ``as_of`` (future dates pass).

    A comparison of the column itself, for dates and timestamps, so it is
    pushed to the scan.
    """
    return _c(fill_date) >= F.date_add(as_date(as_of), 1 - days)


def nonzero_id(link_id, text: bool = False) -> Column:
    """Non-NULL and not zero; of a ``text`` column, non-numeric text counts as
    NULL (a number needs no cast and is pushed to the scan)."""
    if not text:
        return _c(link_id).isNotNull() & (_c(link_id) != 0)
    return F.coalesce(_c(link_id).try_cast("bigint"), F.lit(0)) != 0
