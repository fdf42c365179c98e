"""From nested documents to flat typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare import schemas
from wayfare.functions import casts
from wayfare.operators.reviews import cap_per_group
from wayfare.sources.readers import BROKEN

# Fixed values of the ingest service and the review platform.
PLATFORM = "Tripadvisor"
LANGUAGES = ("en",)
ROWS_PER_LOCATION = 200


def pair_columns(pairs: str, n: int) -> list[Column]:
    """The first ``n`` name/value entries as fixed columns; missing ones are null, later ones are dropped."""
    columns = []
    for i in range(n):
        entry = F.get(F.col(pairs), F.lit(i))
        columns.append(entry["name"].alias(f"SUBRATING_NAME_{i + 1}"))
        columns.append(entry["value"].alias(f"SUBRATING_VALUE_{i + 1}"))
    return columns


def dropped_pairs(pairs: str, n: int) -> Column:
    return F.greatest(F.coalesce(F.size(pairs), F.lit(0)) - n, F.lit(0))


def flatten_reviews(raw: DataFrame, subratings: int, keep_trip_type: bool, platform: str = PLATFORM) -> DataFrame:
    """Flat text columns in table order; any missing level of the document gives null."""
    address = "placeInfo.addressObj."
    source = {
        "ID": "id", "LOCATIONID": "locationId", "CITY": address + "city", "COUNTRY": address + "country",
        "POSTALCODE": address + "postalcode", "STATE": address + "state", "STREET1": address + "street1",
        "STREET2": address + "street2", "LATITUDE": "placeInfo.latitude", "LONGITUDE": "placeInfo.longitude",
        "NAME": "placeInfo.name", "PLACE_RATING": "placeInfo.rating", "PUBLISHEDDATE": "publishedDate",
        "RATING": "rating", "TEXT": "text", "TITLE": "title", "URL": "url", "USER_LINK": "user.link",
        "USER_NAME": "user.name", "USERID": "user.userId", "USERNAME": "user.username",
    }
    flat = {name: F.col(path) for name, path in source.items()}
    flat["PUBLISHEDPLATFORM"] = F.lit(platform)
    flat["TRIP_TYPE"] = F.col("tripType") if keep_trip_type else F.lit(None).cast("string")
    flat["TRAVELDATE"] = F.date_format(casts.month_start(F.col("travelDate")), "yyyy-MM-dd")
    pairs = dict(zip([c for c in schemas.review_spec(subratings) if c.startswith("SUBRATING")],
                     pair_columns("subratings", subratings)))
    return raw.select(*[{**flat, **pairs}[name].alias(name) for name in schemas.review_spec(subratings)],
                      *[c for c in raw.columns if c == BROKEN])


def hotel_reviews(raw: DataFrame) -> DataFrame:
    return flatten_reviews(raw, schemas.HOTEL_SUBRATINGS, keep_trip_type=False)


def restaurant_reviews(raw: DataFrame) -> DataFrame:
    return flatten_reviews(raw, schemas.RESTAURANT_SUBRATINGS, keep_trip_type=True)


def small_reviews(raw: DataFrame) -> DataFrame:
    """The 19-column layout: coordinates and rating default to 0.0, texts stay null when missing."""
    address = "placeInfo.addressObj."
    return raw.select(
        "id", "locationId",
        *[F.col(address + c).alias(c) for c in ("city", "country", "postalcode", "state")],
        casts.double_or_zero(F.col("placeInfo.latitude")).alias("latitude"),
        casts.double_or_zero(F.col("placeInfo.longitude")).alias("longitude"),
        F.col("placeInfo.name").alias("name"),
        casts.day(F.col("publishedDate")).alias("publishedDate"),
        casts.double_or_zero(F.col("rating")).alias("rating"),
        "text", "title", casts.month_start(F.col("travelDate")).alias("travelDate"),
        F.col("tripType").alias("trip_type"), "url",
        F.col("user.link").alias("user_link"), F.col("user.name").alias("user_name"), F.col("user.userId").alias("userId"),
    )


def joined_list(values: Column) -> Column:
    """Comma-joined text; a missing or null list gives ''."""
    return F.coalesce(F.array_join(values, ","), F.lit(""))


def place_family(raw: DataFrame, kind: str) -> DataFrame:
    """Rows of one type tag with the shared and the family's own columns."""
    columns = []
    for field, (name, of) in {**schemas.PLACE_BASE, **schemas.PLACE_FAMILIES[kind][1]}.items():
        value = joined_list(F.col(field)) if of == "list" else casts.CASTS[of](F.col(field))
        columns.append(value.alias(name))
    return raw.filter(F.col("type") == kind).select(*columns)


def route_places(raw: DataFrame) -> dict[str, DataFrame]:
    """Table name -> rows; types outside the three families are dropped."""
    return {table: place_family(raw, kind) for kind, (table, _) in schemas.PLACE_FAMILIES.items()}


def tagged_places(raw: DataFrame) -> DataFrame:
    """All three families in one pass, tagged with their table; columns of other families are null.

    Where the reader kept broken lines, ``_rejected`` names what is wrong with a
    row (columns whose text does not fit their type, or the whole record) and
    ``_raw`` holds its text; broken lines have no family.
    """
    tests = {table: F.col("type") == kind for kind, (table, _) in schemas.PLACE_FAMILIES.items()}
    table = F.coalesce(*[F.when(test, F.lit(name)) for name, test in tests.items()])
    columns = [casts.CASTS[of](F.col(field)).alias(name) for field, (name, of) in schemas.PLACE_BASE.items()]
    for kind, (owner, fields) in schemas.PLACE_FAMILIES.items():
        for field, (name, of) in fields.items():
            value = joined_list(F.col(field)) if of == "list" else casts.CASTS[of](F.col(field))
            columns.append(F.when(tests[owner], value).alias(name))
    wanted = F.col("type").isin(*schemas.PLACE_FAMILIES)
    if BROKEN not in raw.columns:
        return raw.filter(wanted).select(*columns, table.alias("category"))
    faults = [
        F.when(F.col(BROKEN).isNull() & F.col(field).isNotNull() & casts.CASTS[of](F.col(field)).isNull(), F.lit(name))
        for family in (schemas.PLACE_BASE, *(fields for _, fields in schemas.PLACE_FAMILIES.values()))
        for field, (name, of) in family.items() if of not in ("string", "list")]
    rejected = F.array_compact(F.array(*faults, F.when(F.col(BROKEN).isNotNull(), F.lit("record"))))
    text = F.coalesce(BROKEN, F.to_json(F.struct(*[c for c in raw.columns if c != BROKEN])))
    return raw.filter(F.coalesce(wanted, F.lit(False)) | F.col(BROKEN).isNotNull()).select(
        *columns, table.alias("category"), rejected.alias("_rejected"), F.when(F.size(rejected) > 0, text).alias("_raw"))


def ingest_options(df: DataFrame, language: str, location: str, order: Sequence[Column],
                   languages: Sequence[str] = LANGUAGES, limit: int = ROWS_PER_LOCATION) -> DataFrame:
    """Wanted languages, at most ``limit`` rows per location."""
    return cap_per_group(df.filter(F.col(language).isin(*languages)), [location], order, limit)


def location_details(raw: DataFrame) -> DataFrame:
    return raw.select(
        "location_id", "name", "description", casts.to_double(F.col("latitude")).alias("latitude"),
        casts.to_double(F.col("longitude")).alias("longitude"), "timezone",
        F.col("address_obj.country").alias("country"), F.col("address_obj.state").alias("state"),
    )


def location_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("review_id"), "location_id", casts.to_int(F.col("rating")).alias("rating"), "title", "text",
        casts.day(F.col("travel_date")).alias("travel_date"), F.col("user.username").alias("user_name"),
        F.col("user.user_location.name").alias("user_location"),
    )


def search_results(raw: DataFrame) -> DataFrame:
    return raw.select(
        "location_id", "name", F.col("address_obj.address_string").alias("address"),
        F.col("address_obj.country").alias("country"), F.col("address_obj.state").alias("state"),
        F.col("address_obj.city").alias("city"),
    )


def missing_fields(required: Sequence[str]) -> Column:
    """Names of the required fields that are null, in the order asked."""
    return F.array_compact(F.array(*[F.when(F.col(path).isNull(), F.lit(path)) for path in required]))


def fill_nulls(df: DataFrame, text: str = "") -> DataFrame:
    """Every null text becomes ``text``."""
    return df.na.fill(text)


def fill_features(df: DataFrame) -> DataFrame:
    """Unknown place parts and zero ratings, as the feature step wants them."""
    return df.na.fill({"city": "UNKNOWN", "state": "UNKNOWN", "country": "UNKNOWN", "rating": 0, "weighted_rating": 0})


def explode_json(df: DataFrame, column: str, row: str) -> DataFrame:
    """One row per element of a JSON list held as text, its fields as columns beside the others."""
    parsed = F.from_json(F.col(column), f"array<{row}>")
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(parsed).alias("_v")).select(*others, "_v.*")


def embed_text(name: Column, cuisines: Column, review: Column) -> Column:
    """Text to embed; missing parts are left out."""
    return F.concat_ws(" ", name, cuisines, review)
