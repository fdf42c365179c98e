"""Explicit schemas of the raw inputs and contracts of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "long": T.LongType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "array": T.ArrayType(T.StringType()),
}


def schema(spec: str) -> T.StructType:
    """``"id string, rating double"`` as a StructType; all fields may be null."""
    fields = [part.split() for part in spec.replace("\n", " ").split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in fields])


def texts(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# -- raw documents ------------------------------------------------------------

REVIEW_RAW = T.StructType([
    *schema("id string, locationId string, publishedDate string, travelDate string, rating string, "
            "text string, title string, tripType string, url string, lang string").fields,
    T.StructField("placeInfo", T.StructType([
        *schema("name string, rating string, latitude string, longitude string").fields,
        T.StructField("addressObj", schema(
            "city string, country string, postalcode string, state string, street1 string, street2 string")),
    ])),
    T.StructField("user", schema("link string, name string, userId string, username string")),
    T.StructField("subratings", T.ArrayType(schema("name string, value string"))),
])

PLACE_RAW = schema(
    "id string, name string, rating string, numberOfReviews string, locationString string, latitude string, "
    "longitude string, priceLevel string, rankingPosition string, phone string, address string, website string, "
    "email string, type string, hotelClass string, numberOfRooms string, amenities array, subcategories array, "
    "description string, cuisines array, dietaryRestrictions array, mealTypes array"
)

LOCATION_RAW = T.StructType([
    *schema("location_id string, name string, description string, latitude string, longitude string, "
            "timezone string").fields,
    T.StructField("address_obj", schema("country string, state string")),
])

LOCATION_REVIEW_RAW = T.StructType([
    *schema("id string, location_id string, rating string, title string, text string, travel_date string").fields,
    T.StructField("user", T.StructType([
        T.StructField("username", T.StringType()),
        T.StructField("user_location", schema("name string")),
    ])),
])

LOCATION_SEARCH_RAW = T.StructType([
    *schema("location_id string, name string").fields,
    T.StructField("address_obj", schema("address_string string, country string, state string, city string")),
])

# -- flat review layouts --------------------------------------------------------

_REVIEW_HEAD = {
    "ID": "string", "LOCATIONID": "string", "CITY": "string", "COUNTRY": "string", "POSTALCODE": "string",
    "STATE": "string", "STREET1": "string", "STREET2": "string", "LATITUDE": "double", "LONGITUDE": "double",
    "NAME": "string", "PLACE_RATING": "double", "PUBLISHEDDATE": "date", "PUBLISHEDPLATFORM": "string",
    "RATING": "double",
}
_REVIEW_TAIL = {
    "TEXT": "string", "TITLE": "string", "TRAVELDATE": "date", "TRIP_TYPE": "string", "URL": "string",
    "USER_LINK": "string", "USER_NAME": "string", "USERID": "string", "USERNAME": "string",
}


def review_spec(subratings: int) -> dict[str, str]:
    """Column -> type of a flat review table with that many sub-rating pairs."""
    pairs = {}
    for i in range(1, subratings + 1):
        pairs[f"SUBRATING_NAME_{i}"] = "string"
        pairs[f"SUBRATING_VALUE_{i}"] = "double"
    return {**_REVIEW_HEAD, **pairs, **_REVIEW_TAIL}


HOTEL_SUBRATINGS = 6
RESTAURANT_SUBRATINGS = 4

REVIEWS_SMALL = {
    "id": "string", "locationId": "string", "city": "string", "country": "string", "postalcode": "string",
    "state": "string", "latitude": "double", "longitude": "double", "name": "string", "publishedDate": "date",
    "rating": "double", "text": "string", "title": "string", "travelDate": "date", "trip_type": "string",
    "url": "string", "user_link": "string", "user_name": "string", "userId": "string",
}

# -- place layouts ----------------------------------------------------------------

# raw field -> (stored column, type)
PLACE_BASE = {
    "id": ("id", "string"), "name": ("name", "string"), "rating": ("rating", "double"),
    "numberOfReviews": ("num_reviews", "int"), "locationString": ("location_string", "string"),
    "latitude": ("latitude", "double"), "longitude": ("longitude", "double"),
    "priceLevel": ("price_level", "string"), "rankingPosition": ("ranking_position", "int"),
    "phone": ("phone", "string"), "address": ("address", "string"), "website": ("website", "string"),
    "email": ("email", "string"),
}
PLACE_FAMILIES = {
    "HOTEL": ("hotels", {"hotelClass": ("hotel_class", "double"), "numberOfRooms": ("number_of_rooms", "int"),
                         "amenities": ("amenities", "list")}),
    "ATTRACTION": ("attractions", {"subcategories": ("subcategories", "list"), "description": ("description", "string")}),
    "RESTAURANT": ("restaurants", {"cuisines": ("cuisines", "list"),
                                   "dietaryRestrictions": ("dietary_restrictions", "list"),
                                   "mealTypes": ("meals", "list")}),
}


def place_spec(kind: str) -> dict[str, str]:
    own = PLACE_FAMILIES[kind][1]
    columns = {**PLACE_BASE, **own}
    return {name: ("string" if t == "list" else t) for name, t in columns.values()}


FLIGHT = {
    "flight_id": "int", "source_city_id": "int", "destination_city_id": "int", "airline": "string",
    "flight_number": "string", "flight_duration": "int", "other_attributes": "string",
}
FLIGHT_PRICE = {
    "flight_price_id": "int", "flight_id": "int", "departure_date": "date", "booking_date": "date",
    "price": "double", "other_attributes": "string",
}
LOCATION_DETAILS = {
    "location_id": "string", "name": "string", "description": "string", "latitude": "double",
    "longitude": "double", "timezone": "string", "country": "string", "state": "string",
}
LOCATION_REVIEWS = {
    "review_id": "string", "location_id": "string", "rating": "int", "title": "string", "text": "string",
    "travel_date": "date", "user_name": "string", "user_location": "string",
}
SEARCH_RESULTS = {
    "location_id": "string", "name": "string", "address": "string", "country": "string", "state": "string",
    "city": "string",
}
ATTRACTIONS_DIM = {
    "attraction_id": "string", "city_id": "string", "name": "string", "location": "string",
    "opening_hours": "string", "category": "string", "entry_fee": "double", "other_attributes": "string",
}
ATTRACTION_REVIEWS_DIM = {
    "city_id": "string", "city_name": "string", "attraction_id": "string", "attraction_name": "string",
    "review_id": "string", "review_link": "string", "review_title": "string", "ratings_score": "double",
    "review_date": "date", "review_body": "string", "username": "string", "username_link": "string",
}
SYNTHETIC_REVIEWS = {
    "ID": "string", "LOCATIONID": "string", "RATING": "int", "TITLE": "string", "TEXT": "string",
    "TRIP_TYPE": "string", "TRAVELDATE": "date", "PUBLISHEDDATE": "date", "USERNAME": "string",
    "USERLOCATION": "string",
}

# table -> (columns, key, has audit columns)
CONTRACTS: dict[str, tuple[dict[str, str], tuple[str, ...], bool]] = {
    "hotel_reviews": (review_spec(HOTEL_SUBRATINGS), (), False),
    "restaurant_reviews": (review_spec(RESTAURANT_SUBRATINGS), ("ID",), False),
    "reviews_small": (REVIEWS_SMALL, ("id",), False),
    "hotels": (place_spec("HOTEL"), ("id",), True),
    "attractions": (place_spec("ATTRACTION"), ("id",), True),
    "restaurants": (place_spec("RESTAURANT"), ("id",), True),
    "flight": (FLIGHT, ("flight_id",), False),
    "flight_price": (FLIGHT_PRICE, ("flight_price_id",), False),
    "flight_stage_table": (FLIGHT, (), False),
    "flight_price_stage_table": (FLIGHT_PRICE, (), False),
    "location_details": (LOCATION_DETAILS, ("location_id",), False),
    "location_reviews": (LOCATION_REVIEWS, ("review_id",), False),
    "search_results": (SEARCH_RESULTS, ("location_id",), False),
    "attractions_dim": (ATTRACTIONS_DIM, ("attraction_id",), False),
    "attraction_reviews_dim": (ATTRACTION_REVIEWS_DIM, ("review_id",), False),
    "synthetic_reviews": (SYNTHETIC_REVIEWS, (), False),
}
AUDIT_COLUMNS = ("created_at", "updated_at")


def contract_schema(table: str) -> T.StructType:
    columns, _, audited = CONTRACTS[table]
    fields = [T.StructField(name, _KINDS[kind]) for name, kind in columns.items()]
    if audited:
        fields += [T.StructField(name, _KINDS["timestamp"]) for name in AUDIT_COLUMNS]
    return T.StructType(fields)
