"""The roles of ``bindings`` as SQL, for the oracle."""

QTY = """qty AS (
  SELECT l_orderkey, CAST(sum(l_quantity) AS INTEGER) AS minutes FROM lineitem GROUP BY l_orderkey
)"""

TITLES = QTY + r""", titles AS (
  SELECT o_orderkey AS row_id, 'tt' || o_orderkey AS tconst, o_orderpriority AS "primaryTitle",
    CASE WHEN o_orderkey % 10 = 0 THEN '' WHEN o_orderkey % 10 = 3 THEN '\N'
         WHEN o_orderkey % 10 = 5 THEN 'NULL' WHEN o_orderkey % 10 = 7 THEN NULL
         WHEN o_orderkey % 4 = 1 THEN o_orderpriority || ' é' ELSE o_orderpriority END AS "originalTitle",
    CASE WHEN o_orderkey % 7 = 0 THEN CASE o_orderkey % 3 WHEN 0 THEN '\N' WHEN 1 THEN 'nan' ELSE 'NULL' END
         WHEN o_orderkey % 17 = 5 THEN '2500'
         ELSE CAST(year(o_orderdate) AS VARCHAR) END AS "startYear",
    CASE WHEN o_orderkey % 7 = 0 AND o_orderkey % 11 <> 3 THEN CAST(year(o_orderdate) AS VARCHAR)
         ELSE '\N' END AS "endYear",
    CASE WHEN o_orderkey % 11 = 0 THEN '\N' WHEN minutes IS NULL THEN 'NULL'
         ELSE CAST(minutes AS VARCHAR) END AS "runtimeMinutes",
    CASE WHEN o_orderkey % 13 = 0 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END AS "numVotes",
    CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS label,
    CASE WHEN o_orderkey % 10 = 0 THEN 'validation' WHEN o_orderkey % 10 = 1 THEN 'test'
         ELSE 'train' END AS split
  FROM orders LEFT JOIN qty ON l_orderkey = o_orderkey
)"""

# titles with every missing value as NULL, years repaired
CLEAN = TITLES + r""", typed AS (
  SELECT row_id, tconst, label, split,
    TRY_CAST(nullif(nullif(nullif("startYear", '\N'), 'nan'), 'NULL') AS INTEGER) AS raw_start,
    TRY_CAST(nullif("endYear", '\N') AS INTEGER) AS raw_end,
    TRY_CAST(nullif(nullif("runtimeMinutes", '\N'), 'NULL') AS INTEGER) AS minutes,
    CASE WHEN isnan("numVotes") THEN NULL ELSE "numVotes" END AS votes,
    "primaryTitle" AS primary_title,
    CASE WHEN "originalTitle" IN ('', '\N', 'NULL') THEN NULL ELSE "originalTitle" END AS original_title
  FROM titles
), clean AS (
  SELECT *, coalesce(raw_start, raw_end) AS start_year FROM typed
)"""

DIRECTING = """directing AS (
  SELECT 'tt' || l_orderkey AS movie,
    CASE WHEN (l_orderkey + l_linenumber) % 6 <> 0 THEN 's' || l_suppkey END AS director FROM lineitem
)"""

WRITING = """writing AS (
  SELECT 'tt' || l_orderkey AS movie,
    CASE WHEN (l_orderkey + 2 * l_linenumber) % 5 <> 0 THEN 'p' || l_partkey END AS writer FROM lineitem
)"""

GENRE_OF_TYPE = """CASE p_type WHEN 'ECONOMY' THEN 'Action' WHEN 'LARGE' THEN 'Comedy' WHEN 'MEDIUM' THEN 'Drama'
    WHEN 'PROMO' THEN 'Science Fiction' WHEN 'SMALL' THEN 'TV Movie' WHEN 'STANDARD' THEN 'War' END"""

TITLE_GENRES = f"""title_genres AS (
  SELECT 'tt' || l_orderkey AS tconst, l_orderkey, {GENRE_OF_TYPE} AS genre
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

COUNTRIES = """countries AS (
  SELECT 'N' || n_nationkey AS code, CASE WHEN n_nationkey = 4 THEN '' ELSE r_name END AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 8 <> 7
)"""

# what each title's document says, valid documents only
DOCUMENTS = QTY + ", " + TITLE_GENRES + ", " + COUNTRIES + """, mentions AS (
  SELECT l_orderkey,
    count(*) FILTER (genre = 'Action') AS action, count(*) FILTER (genre = 'Comedy') AS comedy,
    count(*) FILTER (genre = 'Drama') AS drama,
    count(*) FILTER (genre = 'Science Fiction') AS science_fiction,
    count(*) FILTER (genre = 'TV Movie') AS tv_movie, count(*) FILTER (genre = 'War') AS war
  FROM title_genres GROUP BY l_orderkey
), docs AS (
  SELECT o_orderkey, 'tt' || o_orderkey AS requested,
    CASE WHEN o_orderkey % 23 <> 0 THEN 'tt' || o_orderkey END AS tconst,
    lower(c_mktsegment) AS original_language, o_totalprice / 1000 AS popularity,
    CAST(floor(o_totalprice) AS BIGINT) AS revenue, minutes AS runtime,
    CAST(o_orderkey % 100 AS DOUBLE) / 10 AS vote_average, CAST(o_orderkey % 1000 AS INTEGER) AS vote_count,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'n' || c_nationkey END AS country,
    coalesce(nullif(region, ''), 'World') AS country_region,
    coalesce(action, 0) AS action, coalesce(comedy, 0) AS comedy, coalesce(drama, 0) AS drama,
    coalesce(science_fiction, 0) AS science_fiction, coalesce(tv_movie, 0) AS tv_movie, coalesce(war, 0) AS war
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN qty ON qty.l_orderkey = o_orderkey
  LEFT JOIN mentions ON mentions.l_orderkey = o_orderkey
  LEFT JOIN countries ON code = 'N' || c_nationkey AND o_orderkey % 19 <> 0
  WHERE o_orderkey % 29 <> 0
), features AS (
  SELECT tconst, original_language, popularity, revenue, runtime, vote_average, vote_count,
    country_region AS continent, o_orderkey,
    CAST(action > 0 AS INTEGER) AS action, CAST(comedy > 0 AS INTEGER) AS comedy,
    CAST(drama > 0 AS INTEGER) AS drama, CAST(science_fiction > 0 AS INTEGER) AS science_fiction,
    CAST(tv_movie > 0 AS INTEGER) AS tv_movie, CAST(war > 0 AS INTEGER) AS war
  FROM docs WHERE tconst IS NOT NULL
)"""

SERIES = """series AS (
  SELECT user_id AS batch_id, CAST(ts AS DATE) AS date,
    CASE WHEN event_type = 'click' THEN 'click' ELSE event_type || ' ' || user_id END AS series,
    CASE WHEN event_type = 'click' AND user_id % 37 = 5 THEN 0.0 ELSE value END AS value
  FROM events
)"""
