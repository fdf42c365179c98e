"""Replies, filters and free-text requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfare.functions import rules
from wayfare.functions import text as X
from wayfare.operators import requests as Q
from wayfare.registry import query


def replies(t):
    """Model replies around the conversation turns: quoted loosely, quoted well, and plain text."""
    clean = F.regexp_replace("text", r"[\s\"\\]+", " ")
    reply = (
        F.when(F.col("role") == "user", F.concat(F.lit("{'travel': True, 'note': None, 'response': '"), clean, F.lit("'}")))
        .when(F.col("role") == "assistant", F.concat(F.lit("  {\"travel\": False, \"response\": \"I'm "), clean, F.lit("\"} ")))
        .otherwise(F.concat(F.lit(" plain "), clean))
    )
    return t.table("conversations").select("conv_id", "turn", "role", reply.alias("reply"))


_REPLY = r"""
    WITH cleaned AS (SELECT conv_id, turn, role, regexp_replace(text, '[\s"\\]+', ' ', 'g') AS clean FROM conversations),
         reply AS (SELECT conv_id, turn, role,
                CASE role WHEN 'user' THEN concat('{''travel'': True, ''note'': None, ''response'': ''', clean, '''}')
                          WHEN 'assistant' THEN concat('  {"travel": False, "response": "I''m ', clean, '"} ')
                          ELSE concat(' plain ', clean) END AS reply FROM cleaned),
         guarded AS (SELECT conv_id, turn, role, regexp_replace(replace(reply, '"', ''''),
                '([\p{L}\p{N}_])''([a-zA-Z]+)([^\p{L}\p{N}_]|$)', '\1' || chr(65535) || '\2\3', 'g') AS g FROM reply),
         fixed AS (SELECT conv_id, turn, role, replace(replace(replace(replace(replace(g, '''', '"'), chr(65535), ''''),
                'True', 'true'), 'False', 'false'), 'None', 'null') AS f FROM guarded)"""


@query("json_repair", _REPLY + r"""
    SELECT conv_id, turn, json_valid(f) AS parsed,
           CASE WHEN json_valid(f) THEN f ELSE regexp_replace(f, '^\s+|\s+$', '', 'g') END AS repaired FROM fixed""")
def json_repair(t):
    repaired = X.json_or_text(F.col("reply"))
    return replies(t).select("conv_id", "turn", X.is_json(X.repair_json(F.col("reply"))).alias("parsed"), repaired.alias("repaired"))


@query("json_flag", _REPLY + """
    SELECT conv_id, turn, coalesce(CASE WHEN json_valid(f) THEN json_extract_string(f, '$.travel') END, '') = 'true' AS travel,
           coalesce(CASE WHEN json_valid(f) THEN json_extract_string(f, '$.response') END, '') AS response FROM fixed""")
def json_flag(t):
    fixed = replies(t).withColumn("fixed", X.repair_json(F.col("reply")))
    return fixed.select("conv_id", "turn", (X.json_path(F.col("fixed"), "$.travel") == "true").alias("travel"),
                        X.json_path(F.col("fixed"), "$.response").alias("response"))


@query("json_defaults", """
    SELECT place_id, CASE WHEN type IN ('HOTEL', 'RESTAURANT') THEN city ELSE '' END AS city,
           CASE WHEN type = 'HOTEL' THEN primary_category ELSE '' END AS primary_category,
           CASE WHEN type = 'RESTAURANT' THEN brand ELSE '' END AS cuisine, '' AS dietary FROM place""", ("place",))
def json_defaults(t):
    """Filter documents with keys missing at different levels; some are no JSON at all."""
    def key(name, value):
        return F.concat(F.lit(f'"{name}": {{"$eq": "'), value, F.lit('"}'))

    city = key("CITY", F.col("city"))
    document = (
        F.when(F.col("type") == "HOTEL", F.concat(F.lit('{"attractions": {'), city, F.lit(", "), key("PRIMARY_CATEGORY", F.col("primary_category")), F.lit("}}")))
        .when(F.col("type") == "RESTAURANT", F.concat(F.lit('{"attractions": {'), city, F.lit('}, "restaurants": {'), key("CUISINES", F.col("brand")), F.lit("}}")))
        .when(F.col("type") == "ATTRACTION", F.lit('{"hotels": {}}')).otherwise("no filter")
    )
    doc = F.col("doc")
    return t.place.select("place_id", document.alias("doc")).select(
        "place_id", X.json_path(doc, "$.attractions.CITY['$eq']").alias("city"),
        X.json_path(doc, "$.attractions.PRIMARY_CATEGORY['$eq']").alias("primary_category"),
        X.json_path(doc, "$.restaurants.CUISINES['$eq']").alias("cuisine"),
        X.json_path(doc, "$.restaurants.DIETARY_RESTRICTIONS['$eq']").alias("dietary"))


@query("budget_tier", """
    SELECT place_id, CASE WHEN price - 800 < 100 THEN 'BUDGET' WHEN price - 800 < 200 THEN 'MIDRANGE' WHEN price - 800 < 300 THEN 'UPSCALE'
                          ELSE 'LUXURY' END AS hotel_tier,
           CASE WHEN price - 895 < 10 THEN 'QUICK_SERVICE' WHEN price - 895 < 45 THEN 'UPSCALE_CASUAL' ELSE 'FINE_DINING' END AS restaurant_tier,
           CASE WHEN price - 800 < 100 THEN 'BUDGET' WHEN price - 800 <= 250 THEN 'MIDRANGE' WHEN price - 800 <= 300 THEN 'UPSCALE'
                ELSE 'LUXURY' END AS other_hotel_tier
    FROM place""", ("place",))
def budget_tier(t):
    night, meal = F.col("price") - 800, F.col("price") - 895
    return t.place.select(
        "place_id", rules.tier_below(night, rules.HOTEL_TIERS).alias("hotel_tier"),
        rules.tier_below(meal, rules.RESTAURANT_TIERS).alias("restaurant_tier"),
        rules.inclusive_tier(night).alias("other_hotel_tier"))


@query("budget_split", """
    SELECT request_id, CAST(hotel AS DOUBLE) AS hotel, CAST(total - hotel AS DOUBLE) AS restaurant
    FROM (SELECT o_orderkey AS request_id, CAST(o_totalprice AS DECIMAL(18, 2)) AS total,
                 round(CAST(o_totalprice AS DECIMAL(18, 2)) * 0.7, 2) AS hotel FROM orders)""")
def budget_split(t):
    hotel, restaurant = rules.split_budget(F.col("o_totalprice"))
    return t.table("orders").select(F.col("o_orderkey").alias("request_id"), hotel.alias("hotel"), restaurant.alias("restaurant"))


_ENTITIES = r"""
    WITH said AS (SELECT o_orderkey AS request_id,
                CASE WHEN o_orderkey % 7 <> 0 THEN CAST(floor(o_totalprice / 1000) AS BIGINT) END AS budget,
                CASE WHEN o_orderpriority <> '5-LOW' THEN 2 + o_orderkey % 9 END AS n_days,
                CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS start_date,
                CASE WHEN o_custkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + CAST(2 + o_orderkey % 9 AS INTEGER) END AS end_date,
                CASE WHEN c_mktsegment <> 'MACHINERY' THEN n_name END AS location
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


@query("entity_extract", _ENTITIES + " SELECT * FROM said")
def entity_extract(t):
    """The SQL states what each request was composed of; the query has to find it in the text."""
    return Q.entities(t.request, t.cities)


@query("missing_entities", _ENTITIES + """
    , counted AS (SELECT *, CASE WHEN n_days IS NULL THEN 0 ELSE 1 END + CASE WHEN start_date IS NULL THEN 0 ELSE 1 END
                            + CASE WHEN end_date IS NULL THEN 0 ELSE 1 END AS known FROM said)
    SELECT request_id, concat_ws(',', CASE WHEN budget IS NULL THEN 'BUDGET' END, CASE WHEN location IS NULL THEN 'LOCATION' END,
               CASE WHEN known < 2 AND n_days IS NULL THEN 'DURATION' END,
               CASE WHEN known < 2 AND start_date IS NULL THEN 'START_DATE' END,
               CASE WHEN known < 2 AND end_date IS NULL THEN 'END_DATE' END) AS missing,
           budget IS NULL OR location IS NULL OR known < 2 AS is_missing FROM counted""")
def missing_entities(t):
    found = Q.entities(t.request, t.cities).withColumn("missing", Q.missing_entities())
    return found.select("request_id", F.array_join("missing", ",").alias("missing"), (F.size("missing") > 0).alias("is_missing"))


@query("casual_flag", """
    SELECT concat('request-', request_id) AS message_id, true AS travel FROM request
    UNION ALL SELECT concat('turn-', conv_id, '-', turn),
        regexp_matches(text, '(?i)(^|[^\\p{L}\\p{N}])(trip|travel|travelling|traveling|vacation|holiday|visit|hotel|flight|itinerary|destination|restaurant|attraction|tour)([^\\p{L}\\p{N}]|$)')
    FROM conversations WHERE role = 'user'""", ("request",))
def casual_flag(t):
    requests = t.request.select(F.concat(F.lit("request-"), F.col("request_id").cast("string")).alias("message_id"), "text")
    turns = t.table("conversations").filter(F.col("role") == "user").select(
        F.concat_ws("-", F.lit("turn"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"), "text")
    return requests.unionByName(turns).select("message_id", Q.is_travel(F.col("text")).alias("travel"))


@query("term_refine", """
    SELECT o_orderkey AS request_id, kind, value FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN (VALUES ('AUTOMOBILE', 'CATEGORY', 'Nature & Parks'), ('AUTOMOBILE', 'CATEGORY', 'Outdoor Activities'),
                 ('BUILDING', 'DIET', 'Vegan options'), ('FURNITURE', 'TRAVEL', 'Solo'), ('HOUSEHOLD', 'CUISINE', 'Italian'),
                 ('HOUSEHOLD', 'CATEGORY', 'Nature & Parks')) AS meant(segment, kind, value) ON c_mktsegment = segment""")
def term_refine(t):
    return Q.refine_terms(t.request)
