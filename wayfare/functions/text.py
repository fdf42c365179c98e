"""Extraction from links, page text and model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Link patterns and placeholder texts.
LOCATION_ID = r"-d(\d+)-"
CITY_ID = r"-g(\d+)-"
REVIEW_ID = r"-r(\d+)-"
LOCATION_NAME = r"-Reviews-(.*?)-"
MISSING = "N/A"
BULLET = "•"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def strip(text: Column) -> Column:
    """Without white space at both ends, line breaks included."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def first_match(text: Column, pattern: str, default: str = MISSING) -> Column:
    """First group of the pattern; ``default`` when nothing (or nothing but '') is found."""
    return F.coalesce(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")), F.lit(default))


def location_id(url: Column, default: str = MISSING) -> Column:
    return first_match(url, LOCATION_ID, default)


def city_id(url: Column) -> Column:
    return first_match(url, CITY_ID)


def review_id(url: Column) -> Column:
    return first_match(url, REVIEW_ID)


def location_name(url: Column, default: str = MISSING) -> Column:
    raw = F.regexp_extract(url, LOCATION_NAME, 1)
    return F.coalesce(F.nullif(strip(F.replace(raw, F.lit("_"), F.lit(" "))), F.lit("")), F.lit(default))


def head_of(text: Column, separator: str = BULLET) -> Column:
    return strip(F.split_part(text, F.lit(separator), F.lit(1)))


def unescape(html: Column) -> Column:
    """Named and quote entities as their characters, the ampersand last."""
    for entity, character in ENTITIES:
        html = F.replace(html, F.lit(entity), F.lit(character))
    return html


def strip_tags(html: Column) -> Column:
    """Visible text of a piece of markup."""
    return strip(unescape(F.regexp_replace(html, "<[^>]*>", "")))


def repair_json(reply: Column) -> Column:
    """Turn a reply with single quotes and Python literals into JSON text.

    Apostrophes inside words stay; every other single quote becomes a double quote.
    """
    text = F.replace(reply, F.lit('"'), F.lit("'"))
    text = F.regexp_replace(text, r"(?<![\p{L}\p{N}_])'|'(?![a-zA-Z]+(?:[^\p{L}\p{N}_]|$))", '"')
    for python, json in (("True", "true"), ("False", "false"), ("None", "null")):
        text = F.replace(text, F.lit(python), F.lit(json))
    return text


def json_or_text(reply: Column) -> Column:
    """The repaired reply if it parses, otherwise the trimmed repaired text."""
    repaired = repair_json(reply)
    return F.when(is_json(repaired), repaired).otherwise(strip(repaired))


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def json_path(text: Column, path: str, default: str = "") -> Column:
    """Text at a JSON path, ``default`` where any level is missing or the text is no JSON."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(text), path, "string"), F.lit(default))
