"""Travel requests in free text: routing, entities, missing parts and refined terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that mark a travel request.
TRAVEL_WORDS = (
    "trip", "travel", "travelling", "traveling", "vacation", "holiday", "visit", "hotel", "flight", "itinerary",
    "destination", "restaurant", "attraction", "tour",
)

# Free term -> (kind, catalogue value). A term may have several values.
TERMS = (
    ("beach", "CATEGORY", "Nature & Parks"),
    ("beach", "CATEGORY", "Outdoor Activities"),
    ("mountain", "CATEGORY", "Nature & Parks"),
    ("temple", "CATEGORY", "Sights & Landmarks"),
    ("cultural", "CATEGORY", "Sights & Landmarks"),
    ("vegan", "DIET", "Vegan options"),
    ("vegetarian", "DIET", "Vegetarian friendly"),
    ("gluten", "DIET", "Gluten free options"),
    ("halal", "DIET", "Halal"),
    ("italian", "CUISINE", "Italian"),
    ("indian", "CUISINE", "Indian"),
    ("alone", "TRAVEL", "Solo"),
    ("solo", "TRAVEL", "Solo"),
    ("family", "TRAVEL", "Family"),
    ("friends", "TRAVEL", "Friends"),
    ("couple", "TRAVEL", "Couples"),
)
# A misspelt word may be this many edits away from a term, and must be this long.
TERM_EDITS = 1
TERM_LENGTH = 6

BUDGET = r"\$\s*([0-9]+)"
BUDGET_AFTER = r"([0-9]+)\s*\$"
DAYS = r"([0-9]+)\s+days?"
WEEKS = r"([0-9]+)\s+weeks?"
START = r"(?:from|start on|starting)\s+([0-9]{4}-[0-9]{2}-[0-9]{2})"
END = r"(?:until|end on|ending)\s+([0-9]{4}-[0-9]{2}-[0-9]{2})"
WORD = r"[\p{L}\p{N}_]+"


def is_travel(text: Column) -> Column:
    """Does the message use a travel word (whole word, any case)?"""
    words = "|".join(TRAVEL_WORDS)
    return text.rlike(rf"(?i)(^|[^\p{{L}}\p{{N}}])({words})([^\p{{L}}\p{{N}}]|$)")


def number(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("long")


def day(text: Column, pattern: str) -> Column:
    """The date found; the search finds nothing but four, two and two digits, and most texts lack one of the dates."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("date")


def entities(requests: DataFrame, cities: DataFrame, key: str = "request_id") -> DataFrame:
    """Budget, length, dates and city named in each request; what is not said stays null.

    The requests are built and dealt out by key once; both sides of the join
    read that one shuffle. No key on the right is missing on the left, so the
    full join gives the rows of a left one; a left join would filter the null
    keys out of one side below the shuffle, and then each side has its own.
    The search is heavy per byte, so the session's number of tasks is kept.
    """
    tasks = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    requests = requests.select(key, "text").repartition(tasks, key)
    text = F.col("text")
    budget = F.coalesce(number(text, BUDGET), number(text, BUDGET_AFTER))
    days = F.coalesce(number(text, DAYS), number(text, WEEKS) * 7)
    said = requests.select(
        key, budget.alias("budget"), days.alias("n_days"), day(text, START).alias("start_date"), day(text, END).alias("end_date"))
    return said.join(named_cities(requests, cities, key), key, "full")


def named_cities(requests: DataFrame, cities: DataFrame, key: str) -> DataFrame:
    """First city name a request mentions, the longer one winning at one place; null keys have none.

    The words are looked up by equality among the first words of the names, and
    only where one is found are the words after it compared, so the work follows
    the text and not texts x cities.
    """
    names = cities.select("city").distinct().select("city", F.lower("city").alias("name_key")).select(
        "city", "name_key", F.split_part("name_key", F.lit(" "), F.lit(1)).alias("word"), F.size(F.split("name_key", " ")).alias("n_words"))
    longest = names.agg(F.max("n_words")).scalar()
    words = F.regexp_extract_all(F.lower(F.when(F.col(key).isNotNull(), F.col("text"))), F.lit(WORD), F.lit(0))
    opened = requests.select(key, words.alias("w"), longest.alias("longest")).select(
        key, "w", "longest", F.posexplode_outer("w").alias("at", "word"))
    ahead = F.array_join(F.slice("w", F.col("at") + 1, F.col("longest")), " ")
    found = opened.select(key, "at", "word", ahead.alias("ahead")).join(names, "word")
    whole = F.startswith(F.concat("ahead", F.lit(" ")), F.concat("name_key", F.lit(" ")))
    place = F.when(whole, F.struct("at", (-F.col("n_words")).alias("shorter"), "city"))
    return found.select(key, place.alias("place")).groupBy(key).agg(F.min("place")["city"].alias("location"))


def missing_entities() -> Column:
    """Names of required parts the request lacks; two of length, start and end are enough."""
    known = sum((F.col(c).isNotNull().cast("int") for c in ("n_days", "start_date", "end_date")), F.lit(0))
    short = known < 2
    return F.array_compact(F.array(
        F.when(F.col("budget").isNull(), "BUDGET"),
        F.when(F.col("location").isNull(), "LOCATION"),
        F.when(short & F.col("n_days").isNull(), "DURATION"),
        F.when(short & F.col("start_date").isNull(), "START_DATE"),
        F.when(short & F.col("end_date").isNull(), "END_DATE"),
    ))


def nearest_term(word: Column) -> Column:
    """The closest dictionary term within the allowed edits, else null. The dictionary is a short literal."""
    known = F.array(*[F.lit(t) for t in sorted({term for term, _, _ in TERMS})])
    near = F.array_min(F.transform(known, lambda t: F.struct(F.levenshtein(word, t).alias("edits"), t.alias("term"))))
    exact = F.array_contains(known, word)
    return F.when(exact, word).when((F.length(word) >= TERM_LENGTH) & (near["edits"] <= TERM_EDITS), near["term"])


def refine_terms(requests: DataFrame, key: str = "request_id") -> DataFrame:
    """Catalogue values meant by the words of each request; misspelt words count as their nearest term.

    The edit distance is taken once per distinct word, not once per mention.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    terms = sorted({term for term, _, _ in TERMS})
    mentions = requests.select(key, F.explode(words).alias("word")).filter(
        F.col("word").isin(*terms) | (F.length("word") >= TERM_LENGTH))
    meaning = mentions.select("word").distinct().select("word", nearest_term(F.col("word")).alias("term"))
    values = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(k).alias("kind"), F.lit(v).alias("value")) for t, k, v in TERMS])
    meant = meaning.filter(F.col("term").isNotNull()).select(
        "word", F.explode(F.filter(values, lambda v: v["term"] == F.col("term"))).alias("v")).select("word", "v.kind", "v.value")
    return mentions.join(meant, "word").select(key, "kind", "value").distinct()
