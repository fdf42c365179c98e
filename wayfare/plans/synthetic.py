"""Synthetic review plan and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfare.operators import quality
from wayfare.operators import reviews as R
from wayfare.operators import synthetic as S
from wayfare.registry import query

_QUOTA = """
    quota AS (SELECT place_id, count(*) AS n_real, greatest(1, CAST(floor(count(*) / 0.99::DOUBLE) AS BIGINT) - count(*)) AS n_synthetic
              FROM review WHERE place_id IN (SELECT place_id FROM place WHERE type = 'ATTRACTION') GROUP BY place_id)"""


def quota(t):
    return S.quotas(t.review, t.place.filter(F.col("type") == "ATTRACTION").select("place_id"))


@query("synthetic_quota", f"""
    WITH {_QUOTA} SELECT place_id, n_real, n_synthetic, round(100 * n_real / (n_real + n_synthetic), 1) AS real_percent,
                         round(100 * n_synthetic / (n_real + n_synthetic), 1) AS synthetic_percent FROM quota""", ("place", "review"))
def synthetic_quota(t):
    return quota(t)


@query("synthetic_plan", f"""
    WITH {_QUOTA} SELECT place_id, unnest(range(1, n_synthetic + 1)) AS seq FROM quota""", ("place", "review"))
def synthetic_plan(t):
    return S.open_rows(quota(t))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join([str(i), *["'" + str(x).replace("'", "''") + "'" for x in row]]) + ")" for i, row in enumerate(rows))


def _drawn(salt: str, n: int) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', place_id, seq, '{salt}')), 1, 8)) AS BIGINT) % {n}"


_PARAMS = f"""
    {_QUOTA},
    opened AS (SELECT place_id, unnest(range(1, n_synthetic + 1)) AS seq FROM quota),
    picked AS (SELECT *, {_drawn('style', len(S.STYLES))} AS style_no, {_drawn('visitor', len(S.VISITORS))} AS visitor_no,
                      2 + {_drawn('count', 3)} AS n_aspects FROM opened),
    styles AS (SELECT * FROM (VALUES {_values(S.STYLES)}) AS v(style_no, style, length, focus, words)),
    visitors AS (SELECT * FROM (VALUES {_values(S.VISITORS)}) AS v(visitor_no, visitor, expects)),
    aspects AS (SELECT * FROM (VALUES {_values([(a,) for a in S.ASPECTS])}) AS v(aspect_no, aspect)),
    drawn AS (SELECT place_id, seq, string_agg(aspect, '; ' ORDER BY k) AS aspects FROM
                 (SELECT place_id, seq, n_aspects, aspect, md5(concat_ws('|', place_id, seq, 'aspect', aspect)) AS k FROM picked, aspects
                  QUALIFY row_number() OVER (PARTITION BY place_id, seq ORDER BY k) <= n_aspects) GROUP BY place_id, seq),
    params AS (SELECT p.place_id, p.seq, style, length, focus, words, visitor, expects, d.aspects FROM picked p JOIN styles USING (style_no)
               JOIN visitors USING (visitor_no) JOIN drawn d ON p.place_id = d.place_id AND p.seq = d.seq)"""


@query("prompt_params", f"WITH {_PARAMS} SELECT place_id, seq, style, length, visitor, aspects FROM params", ("place", "review"))
def prompt_params(t):
    drawn = S.with_parameters(S.open_rows(quota(t)))
    return drawn.select("place_id", "seq", "style", "length", "visitor", F.array_join("aspects", "; ").alias("aspects"))


@query("prompt_table", f"""
    WITH {_PARAMS},
    newest AS (SELECT * FROM review ORDER BY published DESC, order_no, line_no, place_id, user_id, spend LIMIT 1000),
    sample AS (SELECT place_id, avg(rating) AS a FROM newest GROUP BY place_id)
    SELECT m.place_id, seq, concat_ws(chr(10),
        concat('Write a ', length, ' review of ', words, ' for a place.'), concat('Name: ', name), concat('Location: ', city, ', ', state),
        concat('Categories: ', primary_category, ', ', brand), concat('Style: ', style, ' with a view to ', focus),
        concat('Written by a ', visitor, ' who expects ', expects), concat('Cover: ', replace(aspects, '; ', ', ')),
        CASE WHEN a IS NULL THEN 'Rate the visit as it is described.'
             ELSE concat('Visitors give this place about ', printf('%.1f', a), ' stars.') END,
        'Answer with one JSON object with the fields rating, title, review_text, trip_type, travel_date.') AS prompt
    FROM params m JOIN place p ON m.place_id = p.place_id LEFT JOIN sample s ON m.place_id = s.place_id""", ("place", "review"))
def prompt_table(t):
    newest = R.newest(t.review, "published", ["order_no", "line_no", "place_id", "user_id", "spend"])
    sample = newest.groupBy("place_id").agg(F.avg("rating").alias("avg_rating"))
    places = t.place.select("place_id", "name", F.concat_ws(", ", "city", "state").alias("location"),
                            F.concat_ws(", ", "primary_category", "brand").alias("categories"))
    rows = S.with_parameters(S.open_rows(quota(t))).join(places, "place_id").join(sample, "place_id", "left")
    return S.prompts(rows).select("place_id", "seq", "prompt")


@query("synthetic_rows", f"""
    WITH {_QUOTA}, opened AS (SELECT place_id, unnest(range(1, n_synthetic + 1)) AS seq FROM quota)
    SELECT sha256(concat_ws('|', o.place_id, seq)) AS id, o.place_id AS locationid, DATE '2024-01-31' AS publisheddate,
           concat('user_', substr(sha256(concat_ws('|', o.place_id, seq)), 1, 10)) AS username, concat(city, ', ', state) AS userlocation
    FROM opened o JOIN place p ON o.place_id = p.place_id""", ("place", "review"))
def synthetic_rows(t):
    """Planned rows in table layout for one run date, with the texts left to the generator."""
    rows = S.open_rows(quota(t)).join(t.place.select("place_id", F.concat_ws(", ", "city", "state").alias("userlocation")), "place_id")
    empty = {"rating": "int", "title": "string", "text": "string", "trip_type": "string", "traveldate": "date"}
    for name, kind in empty.items():
        rows = rows.withColumn(name, F.lit(None).cast(kind))
    return S.synthetic_rows(rows, F.lit("2024-01-31").cast("date")).drop(*empty)


@query("required_fields", """
    SELECT review_id, CASE WHEN line_no = 1 THEN 'rating,title,review_text,trip_type,travel_date' WHEN line_no = 2 THEN 'trip_type'
                           WHEN line_no = 3 THEN 'rating,travel_date' ELSE '' END AS missing FROM review""", ("review",))
def required_fields(t):
    """Replies as JSON text, some without a field and some no JSON at all; an explicit null counts as present."""
    line = F.col("line_no")
    body = F.concat(
        F.when(line != 3, F.concat(F.lit('"rating": '), F.col("rating").cast("string"), F.lit(", "))).otherwise(""),
        F.lit('"title": null, "review_text": "fine"'),
        F.when(line != 2, F.concat(F.lit(', "trip_type": "'), F.col("trip_type"), F.lit('"'))).otherwise(""),
        F.when(line != 3, ', "travel_date": "2024-01-01"').otherwise(""))
    reply = F.when(line == 1, F.lit("sorry")).otherwise(F.concat(F.lit("{"), body, F.lit("}")))
    return t.review.select("review_id", F.array_join(S.missing_reply_fields(reply), ",").alias("missing"))


@query("dup_keys", "SELECT review_id, count(*) AS n FROM review GROUP BY review_id HAVING count(*) > 1", ("review",))
def dup_keys(t):
    return quality.duplicate_keys(t.review, ["review_id"])


_PROFILED = ("place_id", "name", "type", "city", "brand_or_null", "size", "noted")


@query("profile_table", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value "
    f"FROM (SELECT *, CASE WHEN type <> 'HOTEL' THEN brand END AS brand_or_null, CAST(place_id AS BIGINT) * 7 AS size, "
    f"DATE '2024-01-01' + CAST(place_id AS INTEGER) % 400 AS noted FROM place)" for c in _PROFILED), ("place",))
def profile_table(t):
    """Text, number and date columns; smallest and largest by the column's own order."""
    rows = t.place.withColumns({
        "brand_or_null": F.when(F.col("type") != "HOTEL", F.col("brand")), "size": F.col("place_id").cast("long") * 7,
        "noted": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("place_id").cast("int") % 400))})
    return quality.profile(rows.select(*_PROFILED))
