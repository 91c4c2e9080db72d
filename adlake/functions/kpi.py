"""Campaign performance measures.

Every measure is computed on decimals, is null where its denominator is zero or
missing, and is rounded once, half away from zero: rates to four digits, money and percentages to two.
"""

from __future__ import annotations

from pyspark.sql import Column

from adlake.functions.scalars import MONEY, as_column, days_between, exact_ratio

Col = Column | str


def click_through_rate(clicks: Col, impressions: Col) -> Column:
    return exact_ratio(clicks, impressions, 4)


def conversion_rate(conversions: Col, clicks: Col) -> Column:
    return exact_ratio(conversions, clicks, 4)


def roi_percentage(revenue: Col, budget: Col) -> Column:
    gain = as_column(revenue).cast(MONEY) - as_column(budget).cast(MONEY)
    return exact_ratio(gain, budget, 2, 100)


def cost_per(budget: Col, events: Col) -> Column:
    """Cost per click or per acquisition, by what is counted in ``events``."""
    return exact_ratio(budget, events, 2)


def cost_per_thousand(budget: Col, impressions: Col) -> Column:
    return exact_ratio(budget, impressions, 2, 1000)


def revenue_per(revenue: Col, events: Col) -> Column:
    """Revenue per click, conversion or day, by what is counted in ``events``."""
    return exact_ratio(revenue, events, 2)


def return_on_ad_spend(revenue: Col, budget: Col) -> Column:
    return exact_ratio(revenue, budget, 2)


def active_days(end_date: Col, start_date: Col) -> Column:
    """Days from start to end, the start day not counted."""
    return days_between(end_date, start_date)
