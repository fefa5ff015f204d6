"""The fixture views as portable SQL text (valid in DuckDB and Spark SQL).

Used by the oracle: every oracle query is one ``WITH`` statement whose first
CTEs are these views over the driver tables, so the check needs nothing but
the driver's registered tables.
"""

from __future__ import annotations

RAW_ITEMS = """
SELECT 100000 + p_partkey AS id,
       p_name AS original_title,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE concat('T ', p_name) END AS title,
       CASE WHEN p_partkey % 41 = 0 THEN NULL
            WHEN p_partkey % 33 = 0 THEN 'not-json'
            WHEN p_partkey % 10 = 0 THEN concat('[{''id'': 1, ''name'': ''', p_type, '''}, {''id'': 2, ''name'': None}]')
            ELSE concat('[{"id": 1, "name": "', p_type, '"}, {"id": 2, "name": "Sci ', split_part(p_name, ' ', 1), '"}]') END AS genres,
       concat('[{"name": "', split_part(p_name, ' ', 2), '"}]') AS keywords,
       CASE WHEN p_partkey % 29 = 0 THEN '[]'
            ELSE concat('[{"iso_3166_1": "N', CAST(p_partkey % 25 AS VARCHAR), '"}]') END AS production_countries,
       CASE WHEN p_partkey % 37 = 0 THEN '????'
            ELSE concat(CAST(1950 + p_partkey % 70 AS VARCHAR), '-06-15') END AS release_date,
       CASE WHEN p_partkey % 31 = 0 THEN NULL
            WHEN p_partkey % 23 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(80 + p_size AS DOUBLE) END AS runtime,
       CASE WHEN p_partkey % 53 = 0 THEN NULL
            WHEN p_partkey % 7 = 0 THEN 'fr'
            WHEN p_partkey % 11 = 0 THEN 'de'
            ELSE 'en' END AS original_language,
       p_retailprice AS popularity,
       CAST(p_partkey % 101 AS DOUBLE) / 10 AS vote_average,
       p_partkey % 1000 AS vote_count
FROM part
"""

RAW_CREDITS = """
SELECT 100000 + p_partkey AS movie_id,
       concat('[{"name": "A', CAST(p_partkey % 17 AS VARCHAR), ' X"}, {"name": "A', CAST(p_partkey % 13 AS VARCHAR),
              ' Y"}, {"name": "A3"}, {"name": "A4"}, {"name": "A5"}, {"name": "A6"}, {"name": "A7"}]') AS cast_list,
       concat('[{"job": "Director", "name": "', p_brand, '"}, {"job": "Producer", "name": "Zed"}]') AS crew
FROM part
WHERE p_partkey % 20 <> 7
"""

RAW_RATINGS = """
SELECT o_custkey AS userId, l_partkey AS movieId,
       CAST(ceil(l_quantity / 5) AS DOUBLE) / 2 AS rating,
       o_orderdate AS rated_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

RAW_LINKS = """
SELECT p_partkey AS movieId,
       CASE WHEN p_partkey % 50 = 0 THEN NULL
            WHEN p_partkey % 97 = 1 THEN CAST(100000 + p_partkey - 1 AS DOUBLE)
            ELSE CAST(100000 + p_partkey AS DOUBLE) END AS tmdbId
FROM part
"""

VIEWS = {
    "raw_items": RAW_ITEMS,
    "raw_credits": RAW_CREDITS,
    "raw_ratings": RAW_RATINGS,
    "raw_links": RAW_LINKS,
}


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    """One SQL statement: the fixture views, then ``ctes`` in order, then ``body``."""
    parts = [f"{name} AS ({sql.strip()})" for name, sql in list(VIEWS.items()) + list(ctes)]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
