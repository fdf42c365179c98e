"""Review records and links out of stored pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import text as X

# Style classes of a review page.
CARD_START = r'<div\b[^>]*\bclass="(?:[^"]*\s)?_c(?:\s[^"]*)?"[^>]*>'
BODY_START = r'<div\b[^>]*\bclass="(?:[^"]*\s)?JguWG(?:\s[^"]*)?"[^>]*>'
REVIEW_CARD = {
    "review_link": r'class="biGQs _P fiohW qWPrE ncFvv fOtGX"[^>]*><a href="([^"]*)"',
    "review_title": r'(?s)class="biGQs _P fiohW qWPrE ncFvv fOtGX"[^>]*><a [^>]*>(.*?)</a>',
    "review_date": r'(?s)class="RpeCd"[^>]*>(.*?)</div>',
    "username": r'(?s)class="biGQs _P fiohW fOtGX"[^>]*><a [^>]*>(.*?)</a>',
    "username_link": r'class="biGQs _P fiohW fOtGX"[^>]*><a [^>]*href="([^"]*)"',
}


def page_records(pages: DataFrame, keys: list[str], html: str, block: str, fields: dict[str, str], limit: int | None = None) -> DataFrame:
    """One row per match of ``block`` (group 1) in a page, each field by its own pattern, N/A when missing.

    ``limit`` keeps the first records of a page.
    """
    blocks = F.regexp_extract_all(F.col(html), F.lit(block), F.lit(1))
    if limit is not None:
        blocks = F.slice(blocks, 1, limit)
    opened = pages.select(*keys, F.posexplode(blocks).alias("position", "_block"))
    return opened.select(
        *keys, "position",
        *[F.coalesce(F.nullif(X.strip_tags(F.regexp_extract("_block", pattern, 1)), F.lit("")), F.lit(X.MISSING)).alias(name)
          for name, pattern in fields.items()],
    )


def inside_div(rest):
    """What stands before the ``</div>`` that closes an already open one; everything if none does.

    The markup is cut before each opening and closing div; the depth is carried
    along the pieces until it is back at zero.
    """
    pieces = F.split(rest, r"(?i)(?=</?div\b)")
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))
    steps = F.aggregate(pieces, start, lambda state, piece: F.when(state["depth"] <= 0, state).otherwise(F.struct(
        (state["depth"] + F.when(F.lower(piece).startswith("</div"), -1).when(F.lower(piece).startswith("<div"), 1).otherwise(0)).alias("depth"),
        (state["n"] + 1).alias("n"))))
    whole = F.when(steps["depth"] <= 0, F.slice(pieces, 1, steps["n"] - 1)).otherwise(pieces)
    return F.array_join(whole, "")


def review_cards(pages: DataFrame, keys: list[str], html: str, limit: int | None = None) -> DataFrame:
    """Review records of a page: link, id, title, date, user and body of each card."""
    cards = F.split(F.col(html), CARD_START)
    cards = F.slice(cards, 2, F.greatest(F.size(cards) - 1, F.lit(1)))
    if limit is not None:
        cards = F.slice(cards, 1, limit)
    opened = pages.select(*keys, F.posexplode(cards).alias("position", "_card"))
    body = inside_div(F.coalesce(F.get(F.split("_card", BODY_START, 2), F.lit(1)), F.lit("")))
    found = opened.select(*keys, "position", *[
        X.strip_tags(F.regexp_extract("_card", pattern, 1)).alias(name) for name, pattern in REVIEW_CARD.items()
    ], X.strip_tags(body).alias("review_body"))
    found = found.withColumn("review_date", X.head_of(F.col("review_date")))
    named = [F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(X.MISSING)).alias(c) for c in (*REVIEW_CARD, "review_body")]
    return found.select(*keys, "position", *named).withColumn("review_id", X.review_id(F.col("review_link")))


def breadcrumb(html, pattern: str):
    return X.first_match(html, pattern)


def url_parts(df: DataFrame, url: str) -> DataFrame:
    return df.select(
        "*", X.location_id(F.col(url)).alias("location_id"), X.city_id(F.col(url)).alias("city_id"),
        X.location_name(F.col(url)).alias("location_name"), X.review_id(F.col(url)).alias("review_id"),
    )
