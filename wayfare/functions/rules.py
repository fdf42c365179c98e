"""Rating, sentiment, price and quota rules."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (upper edge, tier) in rising order; None stands for "no upper edge".
HOTEL_TIERS = ((100, "BUDGET"), (200, "MIDRANGE"), (300, "UPSCALE"), (None, "LUXURY"))
RESTAURANT_TIERS = ((10, "QUICK_SERVICE"), (45, "UPSCALE_CASUAL"), (None, "FINE_DINING"))
HOTEL_SHARE = "0.7"
REAL_SHARE = 0.99

RATING_TIERS = ((4.5, "EXCELLENT"), (3.5, "GOOD"), (2.5, "AVERAGE"), (None, "POOR"))


def sentiment(rating: Column) -> Column:
    """A missing rating counts as neutral."""
    return F.when(rating >= 4, "POSITIVE").when(rating <= 2, "NEGATIVE").otherwise("NEUTRAL")


def tier_below(value: Column, edges) -> Column:
    """First tier whose upper edge lies above ``value``; null stays null."""
    chain = None
    for edge, name in edges:
        test = value.isNotNull() if edge is None else value < edge
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain


def inclusive_tier(value: Column) -> Column:
    """The other published edge set: 250 and 300 belong to the lower tier."""
    return (
        F.when(value < 100, "BUDGET").when(value <= 250, "MIDRANGE")
        .when(value <= 300, "UPSCALE").when(value > 300, "LUXURY")
    )


def rating_tier(rating: Column) -> Column:
    chain = None
    for edge, name in RATING_TIERS:
        test = F.lit(True) if edge is None else rating >= edge
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain


def split_budget(budget: Column, share: str = HOTEL_SHARE) -> tuple[Column, Column]:
    """Hotel and restaurant part of a budget, in cents exactly."""
    money = budget.cast("decimal(18,2)")
    hotel = F.round(money * F.lit(Decimal(share)), 2)
    return hotel.cast("double"), (money - hotel).cast("double")


def synthetic_quota(n: Column, real_share: float = REAL_SHARE) -> Column:
    """Generated rows wanted next to ``n`` real rows, one at least."""
    return F.greatest(F.lit(1).cast("long"), F.floor(n / F.lit(real_share)) - n)
