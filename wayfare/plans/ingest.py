"""Scans, projections, casts and page extraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from wayfare import schemas
from wayfare.functions import casts
from wayfare.functions import text as X
from wayfare.functions import vector as V
from wayfare.operators import extract, ingest
from wayfare.registry import query
from wayfare.session import scratch_path
from wayfare.sources import readers, writers
from wayfare.travel import TABLES

# -- scans --------------------------------------------------------------------


@query("scan_table", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def scan_table(t):
    counts = [t.table(name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name in TABLES]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query("scan_projected", "SELECT p_partkey, p_name, p_type, p_brand, p_retailprice FROM part")
def scan_projected(t):
    return readers.read_table(t.spark, f"{t.sf_dir}/part.parquet", ["p_partkey", "p_name", "p_type", "p_brand", "p_retailprice"])


def raw_reviews(t):
    """Nested review documents made of reviews, places and users; parts are missing on purpose.

    Reviews meet their place while they are narrow; the documents are made after.
    """
    nothing = F.lit(None).cast("string")
    line = F.col("line_no")
    subratings = F.slice(F.transform(
        F.sequence(F.lit(1), line),
        lambda i: F.struct(F.concat(F.lit("aspect"), i.cast("string")).alias("name"),
                           ((F.col("rating") + i) % 5 + 1).cast("string").alias("value")),
    ), 1, 8)
    place = t.place.select("place_id", "name", "price", "city", "country", "state")
    info = F.struct(
        "name", F.col("price").cast("string").alias("rating"), F.lit("1.5").alias("latitude"), F.lit("bad").alias("longitude"),
        F.struct("city", "country", nothing.alias("postalcode"), "state", nothing.alias("street1"), nothing.alias("street2")).alias("addressObj"),
    )
    # By their columns as read, reviews look small enough to be sent to every task; they are met by their place in many tasks instead.
    return t.review_spread.hint("merge").join(place, "place_id").select(
        F.col("place_id").alias("locationId"), F.col("review_id").alias("id"),
        F.date_format("published", "yyyy-MM-dd").alias("publishedDate"),
        F.when(line != 2, F.date_format("published", "yyyy-MM")).alias("travelDate"),
        F.col("rating").cast("string").alias("rating"), F.lit("good, \"quiet\"\nplace").alias("text"),
        F.col("spend").cast("string").alias("title"), F.col("trip_type").alias("tripType"),
        nothing.alias("url"), F.lit("en").alias("lang"),
        F.when(line != 4, F.struct(
            nothing.alias("link"), F.lit("u").alias("name"), F.col("user_id").alias("userId"),
            F.concat(F.lit("user"), F.col("user_id")).alias("username"))).alias("user"),
        F.when(line != 1, subratings).alias("subratings"),
        F.when(line != 3, info).alias("placeInfo"),
    )


_FLAT = """
    SELECT r.review_id AS id, r.place_id AS location_id, CASE WHEN line_no <> 3 THEN p.city END AS city,
           CASE WHEN line_no <> 3 THEN p.name END AS name, CASE WHEN line_no <> 3 THEN p.price END AS place_rating,
           r.published AS published_date, CASE WHEN line_no <> 2 THEN date_trunc('month', r.published)::DATE END AS travel_date,
           CAST(r.rating AS DOUBLE) AS rating, {trip} AS trip_type, 'Tripadvisor' AS platform,
           CASE WHEN line_no >= 2 THEN 'aspect1' END AS subrating_name_1,
           CASE WHEN line_no >= {last} THEN 'aspect{last}' END AS subrating_name_last,
           CASE WHEN line_no >= {last} THEN CAST((r.rating + {last}) % 5 + 1 AS DOUBLE) END AS subrating_value_last,
           CASE WHEN line_no <> 4 THEN 'user' || r.user_id END AS username, r.spend
    FROM review r JOIN place p ON r.place_id = p.place_id"""


def _flat_columns(typed, last):
    return typed.select(
        F.col("ID").alias("id"), F.col("LOCATIONID").alias("location_id"), F.col("CITY").alias("city"),
        F.col("NAME").alias("name"), F.col("PLACE_RATING").alias("place_rating"),
        F.col("PUBLISHEDDATE").alias("published_date"), F.col("TRAVELDATE").alias("travel_date"),
        F.col("RATING").alias("rating"), F.col("TRIP_TYPE").alias("trip_type"), F.col("PUBLISHEDPLATFORM").alias("platform"),
        F.col("SUBRATING_NAME_1").alias("subrating_name_1"), F.col(f"SUBRATING_NAME_{last}").alias("subrating_name_last"),
        F.col(f"SUBRATING_VALUE_{last}").alias("subrating_value_last"), F.col("USERNAME").alias("username"),
        F.col("TITLE").cast("double").alias("spend"),
    )


@query("scan_review_json", _FLAT.format(trip="r.trip_type", last=4), ("place", "review"))
def scan_review_json(t):
    """Nested documents written as JSON lines, read with the explicit schema, flattened and typed."""
    path = scratch_path(t.spark, "review-json")
    writers.write_json(raw_reviews(t), path, packed=True)
    flat = ingest.restaurant_reviews(readers.read_reviews(t.spark, path))
    return _flat_columns(casts.typed(flat, schemas.review_spec(schemas.RESTAURANT_SUBRATINGS)), 4)


@query("flatten_nested", _FLAT.format(trip="CAST(NULL AS VARCHAR)", last=6), ("place", "review"))
def flatten_nested(t):
    flat = ingest.hotel_reviews(raw_reviews(t))
    return _flat_columns(casts.typed(flat, schemas.review_spec(schemas.HOTEL_SUBRATINGS)), 6)


@query("array_to_columns", """
    SELECT review_id, CASE WHEN line_no >= 2 THEN 'aspect1' END AS name_1,
           CASE WHEN line_no >= 2 THEN CAST((rating + 1) % 5 + 1 AS VARCHAR) END AS value_1,
           CASE WHEN line_no >= 4 THEN 'aspect4' END AS name_4,
           CASE WHEN line_no >= 4 THEN CAST((rating + 4) % 5 + 1 AS VARCHAR) END AS value_4,
           CAST(CASE WHEN line_no >= 2 THEN greatest(line_no - 4, 0) ELSE 0 END AS INTEGER) AS dropped
    FROM review""", ("review",))
def array_to_columns(t):
    """Sub-ratings of each document as four fixed pairs, with the number that did not fit."""
    flat = raw_reviews(t).select(F.col("id").alias("review_id"), *ingest.pair_columns("subratings", 4),
                                 ingest.dropped_pairs("subratings", 4).alias("dropped"))
    return flat.select("review_id", F.col("SUBRATING_NAME_1").alias("name_1"), F.col("SUBRATING_VALUE_1").alias("value_1"),
                       F.col("SUBRATING_NAME_4").alias("name_4"), F.col("SUBRATING_VALUE_4").alias("value_4"), "dropped")


@query("scan_json_envelope", """
    SELECT concat(review_id, '.', i) AS review_id, place_id AS location_id, rating, published AS travel_date,
           'user' || user_id AS user_name, CASE WHEN line_no > 2 THEN trip_type END AS user_location
    FROM review, (VALUES (1), (2), (3)) AS v(i) WHERE i <= 1 + line_no % 3""", ("review",))
def scan_json_envelope(t):
    """Envelope documents ``{"data": [...]}`` with one to three rows, opened into rows."""
    def row(i):
        return F.struct(
            F.concat(F.col("review_id"), F.lit("."), i.cast("string")).alias("id"), F.col("place_id").alias("location_id"),
            F.col("rating").cast("string").alias("rating"), F.date_format("published", "yyyy-MM-dd").alias("travel_date"),
            F.struct(F.concat(F.lit("user"), F.col("user_id")).alias("username"),
                     F.when(F.col("line_no") > 2, F.struct(F.col("trip_type").alias("name"))).alias("user_location")).alias("user"),
        )

    path = scratch_path(t.spark, "envelopes")
    data = F.transform(F.sequence(F.lit(1), 1 + F.col("line_no") % 3), row)
    writers.write_json(t.review_spread.select(data.alias("data")), path)
    rows = readers.read_envelope(t.spark, path, schemas.LOCATION_REVIEW_RAW)
    return ingest.location_reviews(rows).select(
        "review_id", "location_id", "rating", "travel_date", "user_name", "user_location")


@query("scan_jsonl_typed", """
    SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_float, json_extract_string(props, '$.k') AS k_text,
           CAST(NULL AS VARCHAR) AS absent FROM events""")
def scan_jsonl_typed(t):
    parsed = t.table("events").select("event_id", "event_type", F.from_json("props", schemas.texts(["k", "absent"])).alias("v"))
    return parsed.select("event_id", "event_type", casts.to_int(F.col("v.k")).alias("k"),
                         casts.to_double(F.col("v.k")).alias("k_float"), F.col("v.k").alias("k_text"), F.col("v.absent").alias("absent"))


def messy_rows(t):
    """Reviews as text with markers, quotes, line breaks and bad numbers in known places."""
    line = F.col("line_no")
    return t.review_spread.select(
        "review_id",
        F.when(line == 1, F.lit("NULL")).when(line == 2, F.lit("null")).when(line == 3, F.lit("")).otherwise(F.col("place_id")).alias("place_id"),
        F.when(line == 4, F.lit("four")).otherwise(F.col("rating").cast("string")).alias("rating"),
        F.when(line == 5, F.lit("2024-13-40")).otherwise(F.date_format("published", "yyyy-MM-dd")).alias("published"),
        F.concat(F.lit('said "a, b"\nand '), F.col("trip_type")).alias("text"),
        F.col("spend").cast("string").alias("spend"),
    )


MESSY_SPEC = {"review_id": "string", "place_id": "string", "rating": "int", "published": "date", "text": "string", "spend": "double"}
_MESSY = """
    SELECT review_id, CASE WHEN line_no <= 3 THEN NULL ELSE place_id END AS place_id,
           CASE WHEN line_no <> 4 THEN rating END AS rating, CASE WHEN line_no <> 5 THEN published END AS published,
           concat('said "a, b"', chr(10), 'and ', trip_type) AS text, spend FROM review"""


@query("scan_csv_format", _MESSY, ("review",))
def scan_csv_format(t):
    path = scratch_path(t.spark, "csv-format")
    writers.write_delimited(messy_rows(t), path)
    return casts.typed(readers.read_delimited(t.spark, path, list(MESSY_SPEC)), MESSY_SPEC)


@query("scan_csv_positional", _MESSY, ("review",))
def scan_csv_positional(t):
    path = scratch_path(t.spark, "csv-positional")
    writers.write_delimited(messy_rows(t), path, header=False)
    return readers.read_positional(t.spark, path, MESSY_SPEC)


@query("null_markers", """
    SELECT review_id, CASE WHEN line_no <= 3 THEN NULL ELSE place_id END AS place_id FROM review""", ("review",))
def null_markers(t):
    return messy_rows(t).select("review_id", casts.null_if_marker(F.col("place_id")).alias("place_id"))


@query("scan_flights", """
    SELECT CAST(o_orderkey AS INTEGER) AS flight_price_id, CAST(o_custkey AS INTEGER) AS flight_id,
           CAST(o_orderdate AS DATE) AS departure_date, CAST(o_orderdate AS DATE) - 30 AS booking_date, o_totalprice AS price,
           o_orderpriority AS other_attributes, c_nationkey AS source_city_id,
           CAST((c_nationkey + 7) % 25 AS INTEGER) AS destination_city_id, c_name AS flight_number
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def scan_flights(t):
    """Flights and their prices staged as JSON lines, read typed and joined on the flight id."""
    customer, orders = t.table("customer"), t.table("orders")
    flights = customer.select(
        F.col("c_custkey").alias("flight_id"), F.col("c_nationkey").alias("source_city_id"),
        ((F.col("c_nationkey") + 7) % 25).alias("destination_city_id"), F.col("c_mktsegment").alias("airline"),
        F.col("c_name").alias("flight_number"), F.lit(90).alias("flight_duration"))
    day = F.col("o_orderdate").cast("date")
    prices = orders.select(
        F.col("o_orderkey").alias("flight_price_id"), F.col("o_custkey").alias("flight_id"), day.alias("departure_date"),
        F.date_sub(day, 30).alias("booking_date"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("other_attributes"))
    flight_path, price_path = scratch_path(t.spark, "flights"), scratch_path(t.spark, "flight-prices")
    writers.write_json(flights, flight_path)
    writers.write_json(prices, price_path)
    flight = readers.read_json_typed(t.spark, flight_path, schemas.FLIGHT).drop("other_attributes", "airline", "flight_duration")
    return readers.read_json_typed(t.spark, price_path, schemas.FLIGHT_PRICE).join(flight, "flight_id")


@query("ingest_options", """
    SELECT doc_id, source, n_chars FROM documents WHERE lang IN ('en', 'fr')
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 20""")
def ingest_options(t):
    documents = t.table("documents").select("doc_id", "source", "lang", "n_chars")
    order = [F.col("n_chars").desc(), F.col("doc_id")]
    return ingest.ingest_options(documents, "lang", "source", order, ["en", "fr"], 20).select("doc_id", "source", "n_chars")


# -- pages ----------------------------------------------------------------------

def _visible(text: str) -> str:
    """SQL for the visible text of a piece of markup."""
    text = f"regexp_replace({text}, '<[^>]*>', '', 'g')"
    for entity, character in X.ENTITIES:
        text = f"replace({text}, '{entity}', '{character.replace(chr(39), chr(39) * 2)}')"
    return f"coalesce(nullif(regexp_replace({text}, '^\\s+|\\s+$', '', 'g'), ''), 'N/A')"


@query("extract_page_records", f"""
    WITH b AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS block,
                      unnest(range(len(regexp_extract_all(html, '<li>(.*?)</li>', 1)))) AS position FROM pages)
    SELECT page_id, CAST(position AS INTEGER) AS position,
           {_visible("""regexp_extract(block, 'href="([^"]*)"', 1)""")} AS link,
           {_visible("""regexp_extract(block, '<a [^>]*>(.*?)</a>', 1)""")} AS title,
           coalesce(nullif(regexp_extract(block, 'rating="([0-9]+)"', 1), ''), 'N/A') AS rating FROM b""")
def extract_page_records(t):
    fields = {"link": r'href="([^"]*)"', "title": r"<a [^>]*>(.*?)</a>", "rating": r'rating="([0-9]+)"'}
    return extract.page_records(t.table("pages"), ["page_id"], "html", "<li>(.*?)</li>", fields)


@query("extract_review_cards", f"""
    SELECT doc_id AS page_id, i AS position,
           CASE WHEN source <> 'src3' THEN concat('/Show-g1-d', doc_id % 100, '-r', doc_id, i, '-Reviews-x.html') ELSE 'N/A' END AS review_link,
           CASE WHEN source <> 'src3' THEN concat('Title ', i) ELSE 'N/A' END AS review_title,
           CASE WHEN source <> 'src4' THEN 'May 2024' ELSE 'N/A' END AS review_date,
           concat('name', doc_id) AS username, concat('/Profile/', doc_id) AS username_link,
           {_visible("concat(text, ' (', i, ')')")} AS review_body,
           CASE WHEN source <> 'src3' THEN concat(doc_id, i) ELSE 'N/A' END AS review_id
    FROM documents, (VALUES (0), (1)) AS v(i)""")
def extract_review_cards(t):
    """Review pages with two cards around each document; some cards lack the link or the date."""
    def card(i):
        link = F.when(F.col("source") != "src3", F.concat(
            F.lit('<div class="biGQs _P fiohW qWPrE ncFvv fOtGX"><a href="/Show-g1-d'), (F.col("doc_id") % 100).cast("string"),
            F.lit("-r"), F.col("doc_id").cast("string"), F.lit(f'{i}-Reviews-x.html"><span>Title {i}</span></a></div>'))).otherwise("")
        when = F.when(F.col("source") != "src4", '<div class="RpeCd"> May 2024 • Couples</div>').otherwise("")
        user = F.concat(F.lit('<span class="biGQs _P fiohW fOtGX"><a class="u" href="/Profile/'), F.col("doc_id").cast("string"),
                        F.lit('">name'), F.col("doc_id").cast("string"), F.lit("</a></span>"))
        body = F.concat(F.lit('<div class="JguWG"><div><span>'), F.col("text"), F.lit(f'</span></div><div class="n"> ({i})</div></div><div>Helpful?</div>'))
        start = '<div class="_c" data-x="1">' if i == 0 else '<div id="r" class="_c last">'
        return F.concat(F.lit(start), link, when, user, body, F.lit("</div>"))

    pages = t.table("documents").select(F.col("doc_id").alias("page_id"),
                                        F.concat(F.lit('<main><div class="LbPSX">'), card(0), card(1), F.lit("</div></main>")).alias("html"))
    return extract.review_cards(pages, ["page_id"], "html")


@query("page_breadcrumb", """
    SELECT page_id, coalesce(nullif(regexp_extract(html, '<nav><ul><li><a href="/([^"]*)"', 1), ''), 'N/A') AS city,
           coalesce(nullif(regexp_extract(html, 'class="breadcrumb">([^<]*)<', 1), ''), 'N/A') AS breadcrumb FROM pages""")
def page_breadcrumb(t):
    html = F.col("html")
    return t.table("pages").select("page_id", extract.breadcrumb(html, '<nav><ul><li><a href="/([^"]*)"').alias("city"),
                                   extract.breadcrumb(html, 'class="breadcrumb">([^<]*)<').alias("breadcrumb"))


@query("url_parts", """
    SELECT place_id AS id, CAST(place_no AS VARCHAR) AS location_id, CAST(place_no % 25 AS VARCHAR) AS city_id, name AS location_name,
           CASE WHEN type = 'ATTRACTION' THEN CAST(place_no AS VARCHAR) ELSE 'N/A' END AS review_id FROM place
    UNION ALL SELECT 'page' || page_id, 'N/A', 'N/A', 'N/A', 'N/A' FROM pages""", ("place",))
def url_parts(t):
    """Links composed from places, and the given page links, which carry none of the ids."""
    number = F.col("place_no").cast("string")
    url = F.concat(
        F.lit("https://www.example.com/Review-g"), (F.col("place_no") % 25).cast("string"), F.lit("-d"), number,
        F.when(F.col("type") == "ATTRACTION", F.concat(F.lit("-r"), number)).otherwise(""),
        F.lit("-Reviews-"), F.replace(F.col("name"), F.lit(" "), F.lit("_")), F.lit("-"), F.col("city"), F.lit(".html"))
    links = t.place.select(F.col("place_id").alias("id"), url.alias("url")).unionByName(
        t.table("pages").select(F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("id"), "url"))
    return extract.url_parts(links, "url").drop("url")


@query("split_head", """
    SELECT doc_id, regexp_replace(split_part(replace(text, '.', '•'), '•', 1), '^\\s+|\\s+$', '', 'g') AS head,
           split_part(text, ' ', 1) AS first_word FROM documents""")
def split_head(t):
    return t.table("documents").select(
        "doc_id", X.head_of(F.replace(F.col("text"), F.lit("."), F.lit(X.BULLET))).alias("head"),
        F.split_part(F.col("text"), F.lit(" "), F.lit(1)).alias("first_word"))


# -- projections ------------------------------------------------------------------

@query("route_by_type", """
    SELECT 'hotels' AS family, place_id AS id, name, price AS rating, CAST(size_no AS INTEGER) AS number, concat(primary_category, ',', brand) AS list
    FROM place WHERE type = 'HOTEL'
    UNION ALL SELECT 'attractions', place_id, name, price, NULL, concat(primary_category, ',', brand) FROM place WHERE type = 'ATTRACTION'
    UNION ALL SELECT 'restaurants', place_id, name, price, NULL, concat(primary_category, ',', brand) FROM place WHERE type = 'RESTAURANT'""",
       ("place",))
def route_by_type(t):
    routed = ingest.route_places(raw_places(t))
    shape = {
        "hotels": (F.col("number_of_rooms"), F.col("amenities")),
        "attractions": (F.lit(None).cast("int"), F.col("subcategories")),
        "restaurants": (F.lit(None).cast("int"), F.col("cuisines")),
    }
    parts = [routed[table].select(F.lit(table).alias("family"), "id", "name", "rating", number.alias("number"), values.alias("list"))
             for table, (number, values) in shape.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def raw_places(t):
    """Raw place documents made of the place view."""
    values = {
        "id": F.col("place_id"), "name": F.col("name"), "rating": F.col("price").cast("string"),
        "numberOfRooms": F.col("size_no").cast("string"), "type": F.col("type"),
        **{c: F.array("primary_category", "brand") for c in ("amenities", "subcategories", "cuisines")},
    }
    return t.place.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.PLACE_RAW.fields])


@query("array_join_default", """
    SELECT place_id, CASE WHEN type = 'HOTEL' THEN concat(primary_category, ',', brand) ELSE '' END AS joined,
           CASE WHEN type = 'HOTEL' THEN primary_category ELSE '' END AS holding_null FROM place""", ("place",))
def array_join_default(t):
    values = F.when(F.col("type") == "HOTEL", F.array("primary_category", "brand"))
    holding_null = F.when(F.col("type") == "HOTEL", F.array(F.col("primary_category"), F.lit(None).cast("string")))
    return t.place.select("place_id", ingest.joined_list(values).alias("joined"), ingest.joined_list(holding_null).alias("holding_null"))


@query("optional_nested", """
    SELECT place_id AS location_id, name, concat(city, ', ', state) AS address, country,
           CASE WHEN type <> 'HOTEL' THEN state END AS state, CASE WHEN type = 'RESTAURANT' THEN city END AS city,
           CASE WHEN type = 'RESTAURANT' THEN '' WHEN type = 'HOTEL' THEN 'state,city' ELSE 'city' END AS missing
    FROM place""", ("place",))
def optional_nested(t):
    raw = t.place.select(
        F.col("place_id").alias("location_id"), "name",
        F.struct(F.concat_ws(", ", "city", "state").alias("address_string"), "country",
                 F.when(F.col("type") != "HOTEL", F.col("state")).alias("state"),
                 F.when(F.col("type") == "RESTAURANT", F.col("city")).alias("city")).alias("address_obj"))
    found = ingest.search_results(raw)
    return found.withColumn("missing", F.array_join(ingest.missing_fields(["location_id", "name", "state", "city"]), ","))


@query("json_flatten", """
    SELECT event_id, event_type, CAST(i AS BIGINT) AS part, CAST(json_extract_string(props, '$.k') AS BIGINT) * i AS k
    FROM events, (VALUES (1), (2), (3)) AS v(i) WHERE i <= 1 + event_id % 3""")
def json_flatten(t):
    """A JSON list held as text opened into one row per element."""
    k = F.get_json_object("props", "$.k").cast("long")
    items = F.transform(F.sequence(F.lit(1).cast("long"), 1 + F.col("event_id") % 3),
                        lambda i: F.struct(i.alias("part"), (k * i).alias("k")))
    packed = t.table("events").select("event_id", "event_type", F.to_json(items).alias("items"))
    return ingest.explode_json(packed, "items", "struct<part: bigint, k: bigint>")


@query("compose_text", """
    SELECT place_id, concat_ws(' ', name, CASE WHEN type = 'RESTAURANT' THEN brand END, primary_category) AS text FROM place""", ("place",))
def compose_text(t):
    cuisines = F.when(F.col("type") == "RESTAURANT", F.col("brand"))
    return t.place.select("place_id", ingest.embed_text(F.col("name"), cuisines, F.col("primary_category")).alias("text"))


@query("metadata_struct", """
    SELECT concat_ws('_', r.place_id, r.review_id) AS id, 'restaurants' AS namespace, p.name AS restaurant_name, p.city, p.state,
           r.rating, p.price, r.published AS review_date, r.trip_type
    FROM review r JOIN place p ON r.place_id = p.place_id WHERE p.type = 'RESTAURANT'""", ("place", "review"))
def metadata_struct(t):
    places = t.place.filter(F.col("type") == "RESTAURANT").select("place_id", "name", "city", "state", "price")
    joined = t.review.select("review_id", "place_id", "rating", "published", "trip_type").join(places, "place_id")
    metadata = F.struct(F.col("name").alias("restaurant_name"), "city", "state", "rating", "price",
                        F.col("published").alias("review_date"), "trip_type")
    rows = joined.select(F.concat_ws("_", "place_id", "review_id").alias("id"), F.lit("restaurants").alias("namespace"), metadata.alias("metadata"))
    return rows.select("id", "namespace", "metadata.*")


@query("composite_id", """
    SELECT DISTINCT concat_ws('_', place_id, review_id) AS vector_id, concat_ws('_', 'given', rating) AS cluster_id FROM review""", ("review",))
def composite_id(t):
    return t.review.select(F.concat_ws("_", "place_id", "review_id").alias("vector_id"),
                           F.concat_ws("_", F.lit("given"), F.col("rating").cast("string")).alias("cluster_id")).distinct()


@query("rename_case", """SELECT p_partkey AS "P_PARTKEY", p_name AS "P_NAME", p_type AS "P_TYPE" FROM part""")
def rename_case(t):
    return casts.rename_case(t.table("part").select("p_partkey", "p_name", "p_type"), upper=True)


@query("audit_columns", """
    SELECT place_id AS id, name, true AS has_created, true AS same_time FROM place WHERE type = 'HOTEL'""", ("place",))
def audit_columns(t):
    """Rows get their creation and change time when written; both are the moment of the write."""
    path = scratch_path(t.spark, "audited")
    writers.replace_table(writers.with_audit(ingest.place_family(raw_places(t), "HOTEL")), path)
    return t.spark.read.parquet(path).select(
        "id", "name", F.col("created_at").isNotNull().alias("has_created"), (F.col("created_at") == F.col("updated_at")).alias("same_time"))


# -- casts and nulls ------------------------------------------------------------------

@query("typed_casts", """
    SELECT review_id, CASE WHEN line_no <> 4 THEN rating END AS as_int, CASE WHEN line_no <> 4 THEN CAST(rating AS DOUBLE) + 0.5 END AS as_double,
           CASE WHEN line_no <> 5 THEN published END AS as_date, CAST(floor(spend) AS BIGINT) AS as_long FROM review""", ("review",))
def typed_casts(t):
    messy = messy_rows(t)
    return messy.select(
        "review_id", casts.to_int(F.concat(F.col("rating"), F.lit(".5"))).alias("as_int"),
        casts.to_double(F.concat(F.col("rating"), F.lit(".5"))).alias("as_double"),
        casts.day(F.col("published")).alias("as_date"), casts.to_long(F.col("spend")).alias("as_long"))


@query("parse_dates", """
    SELECT review_id, CASE WHEN line_no <> 5 THEN published END AS day,
           CASE WHEN line_no NOT IN (2, 6) THEN date_trunc('month', published)::DATE END AS month FROM review""", ("review",))
def parse_dates(t):
    day = F.when(F.col("line_no") == 5, F.lit("05/2024")).otherwise(F.date_format("published", "yyyy-MM-dd"))
    month = F.when(F.col("line_no") == 2, F.date_format("published", "yyyy-MM-dd")).when(
        F.col("line_no") != 6, F.date_format("published", "yyyy-MM"))
    return t.review.select("review_id", casts.day(day).alias("day"), casts.month_start(month).alias("month"))


@query("numeric_defaults", """
    SELECT review_id, CASE WHEN line_no IN (1, 4) THEN 0.0 ELSE CAST(rating AS DOUBLE) END AS rating_or_zero,
           CASE WHEN line_no IN (1, 4) THEN 0 ELSE rating END AS count_or_zero,
           CASE WHEN line_no <> 1 THEN CASE WHEN line_no = 4 THEN 'four' ELSE concat(rating, '.9') END END AS text FROM review""", ("review",))
def numeric_defaults(t):
    value = F.when(F.col("line_no") == 4, F.lit("four")).when(F.col("line_no") != 1, F.col("rating").cast("string"))
    tenth = F.when(F.col("line_no") == 4, F.lit("four")).otherwise(F.concat(value, F.lit(".9")))
    return t.review.select("review_id", casts.double_or_zero(value).alias("rating_or_zero"),
                           casts.int_or_zero(tenth).alias("count_or_zero"), tenth.cast("string").alias("text"))


@query("fill_nulls", """
    SELECT place_id, CASE WHEN type = 'HOTEL' THEN 'UNKNOWN' ELSE city END AS city, state, country,
           CASE WHEN type = 'ATTRACTION' THEN 0.0 ELSE price END AS rating,
           CASE WHEN type = 'RESTAURANT' THEN '' ELSE brand END AS brand FROM place""", ("place",))
def fill_nulls(t):
    holes = t.place.select(
        "place_id", F.when(F.col("type") != "HOTEL", F.col("city")).alias("city"), "state", "country",
        F.when(F.col("type") != "ATTRACTION", F.col("price")).alias("rating"), F.lit(0.0).alias("weighted_rating"),
        F.when(F.col("type") != "RESTAURANT", F.col("brand")).alias("brand"))
    return ingest.fill_nulls(ingest.fill_features(holes)).drop("weighted_rating")


def vector_texts(t):
    """Vectors as JSON text: cut short, spread over lines, missing or unreadable for some labels."""
    text = F.to_json("embedding")
    short = F.to_json(F.slice("embedding", 1, 10))
    return t.table("embeddings").select(
        "vec_id", "label",
        F.when(F.col("label") == 3, short).when(F.col("label") == 5, F.replace(text, F.lit(","), F.lit(" ,\n ")))
        .when(F.col("label") == 7, F.lit(None).cast("string")).when(F.col("label") == 9, F.lit("not a vector"))
        .otherwise(text).alias("vector_text"))


def checked_vectors(t, dim=64):
    parsed = vector_texts(t).withColumn("vector", V.parse_vector(F.col("vector_text")))
    return parsed.withColumn("status", V.vector_status(F.col("vector_text"), F.col("vector"), dim))


@query("vector_parse", """
    SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, round(list_sum(CAST(embedding AS DOUBLE[])), 3) AS total
    FROM embeddings WHERE label NOT IN (3, 7, 9)""")
def vector_parse(t):
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return checked_vectors(t).filter(F.col("status") == "OK").select("vec_id", F.size("vector").alias("dim"), F.round(total, 3).alias("total"))


@query("vector_errors", """
    SELECT CASE label WHEN 3 THEN 'WRONG_DIMENSION' WHEN 7 THEN 'MISSING' WHEN 9 THEN 'NOT_NUMERIC' ELSE 'OK' END AS status,
           count(*) AS n, min(vec_id) AS first_vec_id FROM embeddings GROUP BY 1""")
def vector_errors(t):
    return checked_vectors(t).groupBy("status").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_vec_id"))
