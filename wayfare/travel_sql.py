"""The travel views of ``travel.py`` written once more as plain SQL for the comparison engine."""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "place": ((), """
        SELECT p_partkey AS place_no, CAST(p_partkey AS VARCHAR) AS place_id, p_name AS name,
               CASE p_size % 4 WHEN 0 THEN 'HOTEL' WHEN 1 THEN 'ATTRACTION'
                               WHEN 2 THEN 'RESTAURANT' ELSE 'VACATION_RENTAL' END AS type,
               p_type AS primary_category, p_brand AS brand, p_size AS size_no,
               p_retailprice AS price, n_name AS city, r_name AS state,
               CASE WHEN r_regionkey < 3 THEN 'EAST' ELSE 'WEST' END AS country
        FROM part JOIN nation ON p_partkey % 25 = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey"""),
    "review": ((), """
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS review_id, l_orderkey AS order_no,
               l_linenumber AS line_no, CAST(l_partkey AS VARCHAR) AS place_id,
               CAST(l_suppkey AS VARCHAR) AS user_id,
               CAST(1 + floor((l_quantity - 1) / 10) AS INTEGER) AS rating,
               CAST(l_shipdate AS DATE) AS published, l_returnflag AS trip_type,
               l_linestatus AS status, l_extendedprice AS spend
        FROM lineitem"""),
    "place_stats": (("review",), """
        SELECT place_id, n, mean_rating, weighted_rating,
               CASE WHEN weighted_rating >= 4.5 THEN 'EXCELLENT' WHEN weighted_rating >= 3.5 THEN 'GOOD'
                    WHEN weighted_rating >= 2.5 THEN 'AVERAGE' ELSE 'POOR' END AS rating_tier,
               1 + CASE WHEN n > q[1] THEN 1 ELSE 0 END + CASE WHEN n > q[2] THEN 1 ELSE 0 END
                 + CASE WHEN n > q[3] THEN 1 ELSE 0 END AS popularity_tier
        FROM (SELECT g.place_id, g.n, g.mean_rating,
                     round((g.n * g.mean_rating + m.m * c.c) / (g.n + m.m), 6) AS weighted_rating, m.q
              FROM (SELECT place_id, count(*) AS n, avg(rating) AS mean_rating FROM review GROUP BY place_id) g,
                   (SELECT avg(n) AS m, quantile_cont(n, [0.25, 0.5, 0.75]) AS q
                    FROM (SELECT count(*) AS n FROM review GROUP BY place_id)) m,
                   (SELECT avg(rating) AS c FROM review) c)"""),
    "review_vector": ((), """
        SELECT vec_id, CAST(vec_id AS VARCHAR) AS review_id, CAST(vec_id // 4 AS VARCHAR) AS place_id,
               CAST(embedding AS DOUBLE[]) AS vector, label, lang, source,
               CAST(1 + n_chars % 5 AS INTEGER) AS rating, text
        FROM embeddings JOIN documents ON vec_id = doc_id"""),
    "clustered": (("place", "place_stats", "review_vector"), """
        SELECT v.vec_id, v.review_id, v.place_id, 'given' AS method, v.label, v.vector, v.rating, v.lang, v.source,
               p.name AS place_name, p.primary_category, p.city, p.state, p.country,
               s.weighted_rating, s.rating_tier, s.popularity_tier,
               CASE WHEN v.rating >= 4 THEN 'POSITIVE' WHEN v.rating <= 2 THEN 'NEGATIVE'
                    ELSE 'NEUTRAL' END AS sentiment
        FROM review_vector v JOIN place p ON v.place_id = p.place_id
                             JOIN place_stats s ON v.place_id = s.place_id"""),
    "centroid": (("clustered",), """
        SELECT method, label, list(m ORDER BY i) AS centroid
        FROM (SELECT method, label, i, avg(x) AS m
              FROM (SELECT method, label, unnest(vector) AS x, unnest(range(len(vector))) AS i FROM clustered)
              GROUP BY method, label, i)
        GROUP BY method, label"""),
    "request": ((), """
        SELECT o_orderkey AS request_id,
               concat('I plan a trip',
                      CASE WHEN c_mktsegment <> 'MACHINERY' THEN concat(' to ', n_name) ELSE '' END,
                      CASE WHEN o_orderpriority <> '5-LOW' THEN concat(' for ', 2 + o_orderkey % 9, ' days') ELSE '' END,
                      CASE WHEN o_orderstatus <> 'P' THEN concat(' from ', strftime(o_orderdate, '%Y-%m-%d')) ELSE '' END,
                      CASE WHEN o_custkey % 3 = 0
                           THEN concat(' until ', strftime(o_orderdate + to_days(CAST(2 + o_orderkey % 9 AS INTEGER)), '%Y-%m-%d'))
                           ELSE '' END,
                      CASE WHEN o_orderkey % 7 <> 0 THEN concat(' with $', CAST(floor(o_totalprice / 1000) AS BIGINT)) ELSE '' END,
                      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN ', we like the Beach'
                                        WHEN 'BUILDING' THEN ', vegan food please'
                                        WHEN 'FURNITURE' THEN ', travelling alone'
                                        WHEN 'HOUSEHOLD' THEN ', love italien and mountain' ELSE '' END) AS text
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""),
    "node": (("place", "place_stats"), """
        SELECT CASE type WHEN 'HOTEL' THEN 'Hotel' WHEN 'ATTRACTION' THEN 'Attraction' ELSE 'Restaurant' END AS label,
               p.place_id AS id, p.name, coalesce(s.mean_rating, 0.0) AS rating, p.city, p.state,
               p.primary_category, p.price
        FROM place p LEFT JOIN place_stats s ON p.place_id = s.place_id
        WHERE type IN ('HOTEL', 'ATTRACTION', 'RESTAURANT')
        UNION ALL
        SELECT DISTINCT 'City', concat_ws('|', city, state), city, CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), state,
               CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE)
        FROM place WHERE type IN ('HOTEL', 'ATTRACTION', 'RESTAURANT')
        UNION ALL
        SELECT DISTINCT 'Category', primary_category, primary_category, CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR),
               CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE)
        FROM place WHERE type = 'ATTRACTION'"""),
    "edge": (("place",), """
        SELECT DISTINCT CASE type WHEN 'HOTEL' THEN 'Hotel' WHEN 'ATTRACTION' THEN 'Attraction' ELSE 'Restaurant' END AS src_label,
               place_id AS src, 'LOCATED_IN' AS rel, 'City' AS dst_label, concat_ws('|', city, state) AS dst
        FROM place WHERE type IN ('HOTEL', 'ATTRACTION', 'RESTAURANT')
        UNION ALL
        SELECT DISTINCT 'Attraction', place_id, 'HAS_CATEGORY', 'Category', primary_category
        FROM place WHERE type = 'ATTRACTION'"""),
}


def with_views(sql: str, *names: str) -> str:
    """Put the needed views, in dependency order, in front of ``sql``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    body = sql.strip()
    if not ordered:
        return body
    head = ",\n".join(f"{name} AS ({VIEWS[name][1].strip()})" for name in ordered)
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
