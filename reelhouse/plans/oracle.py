"""Oracle SQL (DuckDB dialect) for every registered query.

Written as plain SQL over the driver's views, independent of the Spark code
path: rules, thresholds and declared tests are stated here again, so the two
engines check each other.
"""

from __future__ import annotations

RAW = """
li AS (
  SELECT l_orderkey, list(DISTINCT l_partkey % 19) AS genre_ids, count(*) AS n, sum(l_quantity) AS q
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o_orderstatus = 'P' AS adult, CAST(NULL AS VARCHAR) AS backdrop_path, li.genre_ids,
         o_orderkey AS id,
         CASE o_custkey % 5 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' WHEN 3 THEN 'xx' END AS original_language,
         o_orderpriority AS original_title, ' ' || o_orderstatus || ' ' AS overview,
         o_totalprice / 2500.0 AS popularity, CAST(NULL AS VARCHAR) AS poster_path,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS release_date,
         '  ' || o_orderpriority || ' ' AS title, o_orderpriority = '5-LOW' AS video,
         li.q / li.n / 5.0 AS vote_average, li.n AS vote_count, o_orderstatus
  FROM orders LEFT JOIN li ON li.l_orderkey = orders.o_orderkey),
raw_items AS (
  SELECT * EXCLUDE (o_orderstatus), '2024-01-01' AS ingestion_date FROM base
  UNION ALL BY NAME
  SELECT * EXCLUDE (o_orderstatus) REPLACE (popularity + 1.0 AS popularity), '2024-01-02' AS ingestion_date
  FROM base WHERE o_orderstatus = 'O')"""

CLEAN = """
clean_items AS (
  SELECT movie_id, genre_ids,
         coalesce(original_language, 'xx') AS original_language,
         coalesce(trim(original_title), '') AS original_title,
         coalesce(trim(overview), '') AS overview,
         coalesce(popularity, 0.0) AS popularity,
         release_date,
         coalesce(trim(title), '') AS title,
         coalesce(vote_average, 0.0) AS vote_average,
         coalesce(vote_count, 0) AS vote_count,
         ingestion_date,
         CAST(year(release_date) AS INTEGER) AS release_year
  FROM (
    SELECT id AS movie_id, genre_ids, original_language, original_title, overview, popularity,
           CAST(try_strptime(release_date, '%Y-%m-%d') AS DATE) AS release_date,
           title, vote_average, vote_count, ingestion_date,
           row_number() OVER (PARTITION BY id ORDER BY ingestion_date DESC) AS rn
    FROM raw_items WHERE id IS NOT NULL) t
  WHERE rn = 1)"""

LOOKUPS = """
raw_languages AS (
  SELECT lang AS iso_639_1,
         CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German'
                   WHEN 'es' THEN 'Spanish' END AS english_name,
         CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'Français' WHEN 'de' THEN 'Deutsch'
                   WHEN 'es' THEN 'Español' END AS name,
         '2024-01-01' AS ingestion_date
  FROM documents),
raw_genres AS (
  SELECT p_partkey % 19 AS id, 'cat' || CAST(p_partkey % 19 AS VARCHAR) AS name, '2024-01-01' AS ingestion_date
  FROM part),
raw_countries AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso_3166_1, n_name AS english_name,
         r_name AS native_name, '2024-01-01' AS ingestion_date
  FROM nation JOIN region ON n_regionkey = r_regionkey),
dim_genre AS (SELECT DISTINCT id AS genre_id, name AS genre_name FROM raw_genres WHERE id IS NOT NULL),
dim_country AS (
  SELECT DISTINCT iso_3166_1 AS country_code, english_name AS country_name, native_name AS country_native_name
  FROM raw_countries WHERE iso_3166_1 IS NOT NULL),
dim_language AS (
  SELECT DISTINCT iso_639_1 AS language_code, english_name AS language_name, name AS language_native_name
  FROM raw_languages WHERE iso_639_1 IS NOT NULL)"""

ENRICH = """
items_enriched AS (
  SELECT m.movie_id, m.title, m.original_title, m.overview, m.original_language AS language_code,
         l.language_name, m.release_date, m.release_year,
         CAST(floor(m.release_year / 10) * 10 AS INTEGER) AS release_decade,
         m.release_date IS NOT NULL AS has_release_date, m.popularity,
         CASE WHEN m.popularity >= 100 THEN 'high' WHEN m.popularity >= 20 THEN 'medium' ELSE 'low' END
           AS popularity_tier,
         m.vote_average, m.vote_count,
         CASE WHEN m.vote_average >= 7.5 THEN 'excellent' WHEN m.vote_average >= 6.0 THEN 'good'
              WHEN m.vote_average >= 4.0 THEN 'average' ELSE 'poor' END AS vote_tier,
         m.ingestion_date
  FROM clean_items m LEFT JOIN dim_language l ON m.original_language = l.language_code),
item_pairs AS (
  SELECT DISTINCT movie_id, genre_id
  FROM (SELECT movie_id, unnest(genre_ids) AS genre_id FROM clean_items) u
  WHERE genre_id IS NOT NULL),
item_genres AS (
  SELECT p.movie_id, p.genre_id, g.genre_name
  FROM item_pairs p LEFT JOIN dim_genre g ON p.genre_id = g.genre_id)"""

ENRICHED_COLS = (
    "movie_id, title, original_title, overview, language_code, language_name, release_date, "
    "release_year, release_decade, has_release_date, popularity, popularity_tier, vote_average, "
    "vote_count, vote_tier"
)

MARTS = f"""
stg_items AS (
  SELECT {ENRICHED_COLS}, CAST(ingestion_date AS DATE) AS ingestion_date FROM items_enriched),
item_metrics AS (
  SELECT {ENRICHED_COLS},
         CASE WHEN vote_count > 0 THEN round(popularity * ln(vote_count + 1) * (vote_average / 10.0), 2)
              ELSE 0.0 END AS composite_score,
         coalesce(release_year >= year(DATE '2001-01-01') - 5, false) AS is_recent,
         ingestion_date
  FROM stg_items),
fact_items AS (
  SELECT movie_id, CAST(strftime(release_date, '%Y%m%d') AS INTEGER) AS release_date_id, language_code,
         title, original_title, release_date, release_year, release_decade, has_release_date, is_recent,
         popularity_tier, vote_tier, popularity, vote_average, vote_count, composite_score, ingestion_date
  FROM item_metrics),
stg_item_genres AS (
  SELECT DISTINCT movie_id, genre_id FROM item_genres WHERE movie_id IS NOT NULL AND genre_id IS NOT NULL),
bridge_item_genre AS (SELECT movie_id, genre_id FROM stg_item_genres),
stg_genres AS (SELECT genre_id, genre_name FROM dim_genre),
stg_countries AS (SELECT country_code, country_name, country_native_name FROM dim_country),
stg_languages AS (SELECT language_code, language_name, language_native_name FROM dim_language)"""


def calendar_sql(spine: str) -> str:
    """Calendar columns over a CTE ``spine(date_day)``."""
    return f"""
  SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_id, date_day,
         CAST(year(date_day) AS INTEGER) AS year, CAST(quarter(date_day) AS INTEGER) AS quarter,
         CAST(month(date_day) AS INTEGER) AS month, strftime(date_day, '%b') AS month_name,
         CAST(day(date_day) AS INTEGER) AS day_of_month, CAST(dayofweek(date_day) AS INTEGER) AS day_of_week,
         strftime(date_day, '%a') AS day_name, CAST(weekofyear(date_day) AS INTEGER) AS week_of_year,
         dayofweek(date_day) IN (0, 6) AS is_weekend,
         CAST(floor(year(date_day) / 10) * 10 AS INTEGER) AS decade
  FROM {spine}"""


DEFAULT_CALENDAR = f"""
date_spine AS (
  SELECT CAST(unnest(generate_series(TIMESTAMP '1900-01-01', TIMESTAMP '2030-12-30', INTERVAL 1 DAY)) AS DATE)
    AS date_day),
dim_date AS ({calendar_sql('date_spine')})"""

PIPELINE = ",".join([RAW, CLEAN, LOOKUPS, ENRICH, MARTS, DEFAULT_CALENDAR])

COUNTER = """
samples AS (
  SELECT event_id, ts, event_type, user_id, CAST(event_id % 1000 + 1 AS DOUBLE) AS value FROM events),
lagged AS (
  SELECT event_type, ts, value,
         lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev
  FROM samples),
deltas AS (
  SELECT event_type, ts,
         CASE WHEN prev IS NULL THEN NULL WHEN value < prev THEN value ELSE value - prev END AS delta
  FROM lagged)"""

DAILY_INCREASE = """
daily AS (
  SELECT event_type, date_trunc('day', ts) AS window_start, sum(delta) AS increase
  FROM deltas GROUP BY 1, 2)"""


def metric_names_sql() -> str:
    return """
ev_names AS (
  SELECT event_id, ts, value, unnest([
    CASE event_type
      WHEN 'view' THEN 'airflow.dag.catalogue.task_' || CAST(user_id % 10 AS VARCHAR) || '.duration'
      WHEN 'click' THEN 'airflow.ti.start.catalogue.task_' || CAST(user_id % 10 AS VARCHAR)
      WHEN 'purchase' THEN 'airflow.ti.finish.catalogue.task_' || CAST(user_id % 10 AS VARCHAR) || '.success'
      WHEN 'error' THEN 'airflow.ti.finish.catalogue.task_' || CAST(user_id % 10 AS VARCHAR) || '.failed'
      WHEN 'signup' THEN 'airflow.scheduler_heartbeat'
      ELSE 'airflow.' || event_type END,
    'airflow.' || event_type,
    'airflow.' || event_type || '.total',
    CASE event_id % 19
      WHEN 0 THEN 'airflow.dagrun.duration.success.my-dag' WHEN 1 THEN 'airflow.dagrun.duration.failed.my-dag'
      WHEN 2 THEN 'airflow.dag.my-dag.load.duration' WHEN 3 THEN 'airflow.ti.finish.my-dag.load.skipped'
      WHEN 4 THEN 'airflow.ti.start.my-dag.load' WHEN 5 THEN 'airflow.dagrun.dependency-check.my-dag'
      WHEN 6 THEN 'airflow.dagrun_succeeded' WHEN 7 THEN 'airflow.dagrun_failed'
      WHEN 8 THEN 'airflow.ti_successes' WHEN 9 THEN 'airflow.ti_failures'
      WHEN 10 THEN 'airflow.scheduler_heartbeat' WHEN 11 THEN 'airflow.scheduler.tasks.running'
      WHEN 12 THEN 'airflow.scheduler.tasks.executable' WHEN 13 THEN 'airflow.executor.open_slots'
      WHEN 14 THEN 'airflow.executor.running_tasks' WHEN 15 THEN 'airflow.executor.queued_tasks'
      WHEN 16 THEN 'airflow.zombies' WHEN 17 THEN 'airflow.pool.open-slots.default pool'
      ELSE 'statsd.my-dag:x' END]) AS name
  FROM events)"""


# First match wins; a name that none matches keeps its letters, digits and underscores.
MAPPED = r"""
segs AS (SELECT *, string_split(name, '.') AS s FROM ev_names),
ruled AS (
  SELECT *, CASE
    WHEN len(s) = 5 AND name LIKE 'airflow.dagrun.duration.success.%' THEN 'dag_success'
    WHEN len(s) = 5 AND name LIKE 'airflow.dagrun.duration.failed.%' THEN 'dag_failed'
    WHEN len(s) = 5 AND name LIKE 'airflow.dag.%.duration' THEN 'task_duration'
    WHEN len(s) = 6 AND name LIKE 'airflow.ti.finish.%' THEN 'finish'
    WHEN len(s) = 5 AND name LIKE 'airflow.ti.start.%' THEN 'start'
    WHEN len(s) = 4 AND name LIKE 'airflow.dagrun.dependency-check.%' THEN 'dependency'
    WHEN name IN ('airflow.dagrun_succeeded', 'airflow.dagrun_failed', 'airflow.ti_successes', 'airflow.ti_failures')
      THEN 'total'
    WHEN name IN ('airflow.scheduler_heartbeat', 'airflow.scheduler.tasks.running',
                  'airflow.scheduler.tasks.executable', 'airflow.executor.open_slots',
                  'airflow.executor.running_tasks', 'airflow.executor.queued_tasks') THEN 'gauge'
    WHEN len(s) = 2 AND s[1] = 'airflow' THEN 'rest' END AS rule
  FROM segs),
mapped AS (
  SELECT event_id, ts, value, name,
    CASE rule WHEN 'dag_success' THEN 'airflow_dagrun_duration_success_seconds'
      WHEN 'dag_failed' THEN 'airflow_dagrun_duration_failed_seconds'
      WHEN 'task_duration' THEN 'airflow_task_duration_seconds' WHEN 'finish' THEN 'airflow_ti_finish_total'
      WHEN 'start' THEN 'airflow_ti_start_total' WHEN 'dependency' THEN 'airflow_dagrun_dependency_check_seconds'
      WHEN 'total' THEN replace(name, '.', '_') || '_total' WHEN 'rest' THEN 'airflow_unmapped'
      ELSE regexp_replace(name, '[^A-Za-z0-9_]', '_', 'g') END AS metric,
    CASE WHEN rule IN ('dag_success', 'dag_failed') THEN s[5] WHEN rule = 'task_duration' THEN s[3]
      WHEN rule IN ('finish', 'start', 'dependency') THEN s[4] END AS dag_id,
    CASE WHEN rule = 'task_duration' THEN s[4] WHEN rule IN ('finish', 'start') THEN s[5] END AS task_id,
    CASE WHEN rule = 'finish' THEN s[6] END AS state,
    CASE WHEN rule = 'rest' THEN s[2] END AS raw_metric
  FROM ruled)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# --- data-quality suite ------------------------------------------------------------

# The declared tests: kind, model, its columns, then values, or parent and key.
# Models with another name in the SQL above are given as model=table.
SUITE = """
unique src_items_enriched=items_enriched movie_id
not_null src_items_enriched=items_enriched movie_id
unique src_dim_genre=dim_genre genre_id
not_null src_dim_genre=dim_genre genre_id
not_null src_dim_genre=dim_genre genre_name
unique src_dim_country=dim_country country_code
not_null src_dim_country=dim_country country_code
unique src_dim_language=dim_language language_code
not_null src_dim_language=dim_language language_code
not_null src_item_genres=item_genres movie_id
not_null src_item_genres=item_genres genre_id
unique stg_items movie_id
not_null stg_items movie_id
accepted_values stg_items popularity_tier high,medium,low
accepted_values stg_items vote_tier excellent,good,average,poor
unique stg_genres genre_id
not_null stg_genres genre_id
not_null stg_genres genre_name
unique stg_countries country_code
not_null stg_countries country_code
unique stg_languages language_code
not_null stg_languages language_code
unique_combination stg_item_genres movie_id,genre_id
not_null stg_item_genres movie_id
not_null stg_item_genres genre_id
unique item_metrics movie_id
not_null item_metrics movie_id
not_null item_metrics composite_score
unique dim_genre genre_id
not_null dim_genre genre_id
not_null dim_genre genre_name
unique dim_country country_code
not_null dim_country country_code
unique dim_language language_code
not_null dim_language language_code
unique dim_date date_id
not_null dim_date date_id
unique dim_date date_day
not_null dim_date date_day
not_null dim_date year
unique fact_items movie_id
not_null fact_items movie_id
relationships fact_items release_date_id dim_date date_id
relationships fact_items language_code dim_language language_code
not_null fact_items popularity
not_null fact_items vote_average
unique_combination bridge_item_genre movie_id,genre_id
not_null bridge_item_genre movie_id
relationships bridge_item_genre movie_id fact_items movie_id
not_null bridge_item_genre genre_id
relationships bridge_item_genre genre_id dim_genre genre_id
"""

DIRTY = """
unique raw_items id
unique raw_languages iso_639_1
not_null raw_items original_language
not_null raw_items id
accepted_values raw_items original_language en,fr,de
accepted_values raw_items overview ^O^
unique_combination raw_items id,vote_count
relationships raw_items original_language raw_languages iso_639_1
relationships raw_items vote_count raw_countries code
"""


def _check_sql(line: str) -> str:
    kind, model, columns, *rest = line.split(" ")
    model, _, t = model.partition("=")
    t = t or model
    col = columns.split(",")[0]
    name = f"{kind}_{model}_{columns.replace(',', '_')}"
    if kind == "not_null":
        failures = f"(SELECT count(*) FROM {t} WHERE {col} IS NULL)"
    elif kind == "accepted_values":
        vals = ", ".join(f"'{v.replace('^', ' ')}'" for v in rest[0].split(","))
        failures = f"(SELECT count(DISTINCT {col}) FROM {t} WHERE {col} NOT IN ({vals}))"
    elif kind == "relationships":
        parent, key = rest
        name += f"__{parent}"
        failures = (
            f"(SELECT count(*) FROM {t} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} pp WHERE pp.{key} = c.{col}))"
        )
    else:
        known = f"WHERE {col} IS NOT NULL " if kind == "unique" else ""
        failures = f"(SELECT count(*) FROM (SELECT 1 FROM {t} {known}GROUP BY {columns} HAVING count(*) > 1) x)"
    return (
        f"SELECT '{name}' AS test_name, '{kind}' AS kind, '{model}' AS model, "
        f"'{columns}' AS column_name, CAST({failures} AS BIGINT) AS failures"
    )


def suite_sql(ctes: str, lines: str) -> str:
    body = "\n  UNION ALL ".join(map(_check_sql, lines.strip().split("\n")))
    return with_(ctes, f"\nsuite AS ({body})") + (
        "\nSELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM suite"
    )


# The chain of the first listing date alone.
DATED_RUN = ",".join([
    RAW.replace("raw_items AS", "all_items AS") + ",\nraw_items AS (SELECT * FROM all_items WHERE ingestion_date = '2024-01-01')",
    CLEAN, LOOKUPS, ENRICH,
])

GENRE_LIST = "array_to_string(list_sort(genre_ids), ',')"

ORACLE: dict[str, str] = {
    "scan_partition": with_(RAW)
    + f"""
SELECT id, title, original_language, {GENRE_LIST} AS genre_list, popularity, release_date, vote_average,
       vote_count, adult, video, ingestion_date
FROM raw_items WHERE ingestion_date = '2024-01-02'""",
    "lake_roundtrip": with_(RAW)
    + f"""
SELECT id, title, original_language, {GENRE_LIST} AS genre_list, popularity, release_date, vote_average,
       vote_count, adult, video, ingestion_date
FROM raw_items WHERE ingestion_date = '2024-01-02'""",
    "lake_rerun_empty": with_(RAW)
    + """
SELECT '2024-01-01' AS ingestion_date, count(*) AS n_rows FROM raw_items WHERE ingestion_date = '2024-01-01'
UNION ALL SELECT '2024-01-02', 0""",
    "pages_landed": with_(RAW)
    + f"""
SELECT id, title, {GENRE_LIST} AS genre_list, popularity, release_date, vote_count
FROM raw_items WHERE ingestion_date = '2024-01-01'""",
    "pages_complete": """
WITH numbers AS (
  SELECT unnest(range(1, (SELECT max(o_orderkey) // 250 + 2 FROM orders))) AS page),
saved AS (
  SELECT page, CASE WHEN page % 4 = 0 THEN 2 ELSE 1 END AS n FROM numbers WHERE page % 5 <> 3)
SELECT 'gap' AS kind, page AS page_from, page AS page_to, CAST(1 AS BIGINT) AS n FROM numbers WHERE page % 5 = 3
UNION ALL SELECT 'repeated', page, page, n FROM saved WHERE n > 1""",
    "lake_rerun_failed": with_(RAW)
    + """
SELECT ingestion_date, count(*) AS n_rows, CAST(sum(vote_count) AS BIGINT) AS n_votes FROM raw_items GROUP BY ingestion_date""",
    "load_versions": with_(RAW)
    + """,
days AS (
  SELECT ingestion_date AS day, count(*) AS n_rows, CAST(sum(vote_count) AS BIGINT) AS n_votes
  FROM raw_items GROUP BY ingestion_date),
steps(step, day, n_versions) AS (
  VALUES ('1 loaded', '2024-01-01', 1), ('2 died before publishing', '2024-01-01', 2),
         ('3 failed', '2024-01-01', 2), ('4 loaded again', '2024-01-02', 2))
SELECT step, n_rows, n_votes, n_versions FROM steps JOIN days USING (day)""",
    "latest_merge": with_(RAW)
    + """,
listed AS (
  SELECT id, ingestion_date, popularity, title FROM raw_items
  UNION ALL SELECT id, '2024-01-03', popularity * 2, title FROM raw_items WHERE ingestion_date = '2024-01-01' AND id % 3 = 0)
SELECT id, ingestion_date, popularity, title FROM listed WHERE id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingestion_date DESC) = 1""",
    "drift_gate": with_(RAW)
    + """
SELECT trim(overview) AS status, count(*) AS n_rows, CAST(sum(vote_count) AS BIGINT) AS n_votes, CAST(2 AS BIGINT) AS n_drifted
FROM raw_items WHERE trim(overview) = 'F' GROUP BY 1""",
    "dated_run": with_(DATED_RUN)
    + """,
c AS (
  SELECT (SELECT count(*) FROM raw_items) AS raw, (SELECT count(*) FROM clean_items) AS items,
         (SELECT count(*) FROM item_genres) AS pairs, (SELECT count(*) FROM dim_genre) AS genres,
         (SELECT count(*) FROM dim_country) AS countries, (SELECT count(*) FROM dim_language) AS languages)
SELECT layer, dataset, n_rows, 'success' AS status FROM c, LATERAL (VALUES
  ('ingest', 'movies', raw), ('ingest', 'genres', genres), ('ingest', 'countries', countries), ('ingest', 'languages', languages),
  ('staging', 'movies', items), ('staging', 'movies_raw', raw), ('staging', 'movies_rejected', raw - items),
  ('staging', 'genres', genres), ('staging', 'countries', countries), ('staging', 'languages', languages),
  ('curated', 'movies_enriched', items), ('curated', 'movie_genres', pairs), ('curated', 'dim_genre', genres),
  ('curated', 'dim_country', countries), ('curated', 'dim_language', languages),
  ('warehouse', 'movies_enriched', items), ('warehouse', 'movie_genres', pairs), ('warehouse', 'dim_genre', genres),
  ('warehouse', 'dim_country', countries), ('warehouse', 'dim_language', languages),
  ('source_tests', 'tests', 11), ('model_tests', 'tests', 40), ('counts', 'tables', 6),
  ('marts', 'fact_items', items), ('marts', 'bridge_item_genre', pairs), ('marts', 'dim_genre', genres),
  ('marts', 'dim_country', countries), ('marts', 'dim_language', languages), ('marts', 'dim_date', 47846)
) t(layer, dataset, n_rows)""",
    "top_genres_rollup": with_(PIPELINE)
    + """
SELECT g.genre_name, count(DISTINCT b.movie_id) AS nb_items, round(avg(f.vote_average), 2) AS mean_vote
FROM fact_items f JOIN bridge_item_genre b ON f.movie_id = b.movie_id
JOIN dim_genre g ON b.genre_id = g.genre_id
GROUP BY g.genre_name ORDER BY nb_items DESC, g.genre_name LIMIT 5""",
    "views_top_genres": with_(PIPELINE)
    + """
SELECT g.genre_name, count(DISTINCT b.movie_id) AS nb_items, round(avg(f.vote_average), 2) AS mean_vote
FROM fact_items f JOIN bridge_item_genre b ON f.movie_id = b.movie_id
JOIN dim_genre g ON b.genre_id = g.genre_id
GROUP BY g.genre_name ORDER BY nb_items DESC, g.genre_name LIMIT 5""",
    "metric_retention": """
WITH mx AS (SELECT max(ts) AS m FROM events)
SELECT CAST(ts AS DATE) AS day, count(*) AS n_kept, count(*) FILTER (ts >= m - INTERVAL 36 HOUR) AS n_recent
FROM events, mx WHERE CAST(ts AS DATE) >= CAST(m - INTERVAL 7 DAY AS DATE) GROUP BY 1""",
    "load_counts": with_(PIPELINE)
    + """
SELECT dataset, n_rows, n_rows AS n_table, 'success' AS status FROM (
  SELECT 'dim_genre' AS dataset, count(*) AS n_rows FROM dim_genre
  UNION ALL SELECT 'dim_country', count(*) FROM dim_country
  UNION ALL SELECT 'dim_language', count(*) FROM dim_language
  UNION ALL SELECT 'movies_enriched', count(*) FROM items_enriched
  UNION ALL SELECT 'movie_genres', count(*) FROM item_genres) t""",
    "listing_after": with_(RAW)
    + """
SELECT id, title, popularity, release_date FROM raw_items
WHERE ingestion_date = '2024-01-01' AND NOT coalesce(adult, false) AND NOT coalesce(video, false)
ORDER BY popularity DESC, id LIMIT 20 OFFSET 40""",
    "metric_increase_total": with_(COUNTER)
    + """
SELECT coalesce(sum(delta), 0.0) AS increase FROM deltas
WHERE ts > (SELECT max(ts) FROM samples) - INTERVAL 24 HOUR""",
    "stamp_date": "SELECT *, '2024-01-01' AS ingestion_date FROM nation",
    "clean_items": with_(RAW, CLEAN)
    + f"""
SELECT * EXCLUDE (genre_ids), {GENRE_LIST} AS genre_list FROM clean_items""",
    "clean_lookup": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn
  FROM customer WHERE c_nationkey IS NOT NULL) t WHERE rn = 1""",
    "dedup_latest": with_(RAW)
    + """
SELECT id, ingestion_date, popularity, title FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingestion_date DESC) AS rn
  FROM raw_items WHERE id IS NOT NULL) t WHERE rn = 1""",
    "reject_counts": with_(RAW, CLEAN)
    + """
SELECT (SELECT count(*) FROM raw_items) AS n_raw, (SELECT count(*) FROM clean_items) AS n_clean,
       (SELECT count(*) FROM raw_items) - (SELECT count(*) FROM clean_items) AS rejected""",
    "items_enriched": with_(RAW, CLEAN, LOOKUPS, ENRICH) + "\nSELECT * FROM items_enriched",
    "bridge_item_genre": with_(RAW, CLEAN, LOOKUPS, ENRICH) + "\nSELECT * FROM item_genres",
    "distinct_pairs": """
SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL""",
    "dim_genre": with_(LOOKUPS) + "\nSELECT * FROM dim_genre",
    "dim_country": with_(LOOKUPS) + "\nSELECT * FROM dim_country",
    "dim_language": with_(LOOKUPS) + "\nSELECT * FROM dim_language",
    "stg_items": with_(PIPELINE) + "\nSELECT * FROM stg_items",
    "item_metrics": with_(PIPELINE) + "\nSELECT * FROM item_metrics",
    "fact_items": with_(PIPELINE) + "\nSELECT * FROM fact_items",
    "dim_date": """
WITH bounds AS (
  SELECT make_date(CAST(year(min(o_orderdate)) AS INTEGER), 1, 1) AS lo,
         make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 31) AS hi FROM orders),
spine AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
    AS date_day FROM bounds)"""
    + calendar_sql("spine"),
    "fact_by_calendar": with_(PIPELINE)
    + """
SELECT c.year, c.quarter, count(*) AS n_items, CAST(sum(f.vote_count) AS BIGINT) AS total_votes,
       max(f.popularity) AS max_popularity
FROM fact_items f LEFT JOIN dim_date c ON f.release_date_id = c.date_id
GROUP BY c.year, c.quarter""",
    "load_by_name": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority
FROM orders""",
    "row_counts": with_(PIPELINE)
    + """
SELECT 'raw_items' AS table_name, count(*) AS n_rows FROM raw_items
UNION ALL SELECT 'stg_items', count(*) FROM clean_items
UNION ALL SELECT 'movies_enriched', count(*) FROM items_enriched
UNION ALL SELECT 'movie_genres', count(*) FROM item_genres
UNION ALL SELECT 'fact_items', count(*) FROM fact_items
UNION ALL SELECT 'bridge_item_genre', count(*) FROM bridge_item_genre
UNION ALL SELECT 'dim_genre', count(*) FROM dim_genre
UNION ALL SELECT 'dim_country', count(*) FROM dim_country
UNION ALL SELECT 'dim_language', count(*) FROM dim_language
UNION ALL SELECT 'dim_date', count(*) FROM dim_date""",
    "discover_page": with_(RAW)
    + """
SELECT id, title, popularity, release_date FROM raw_items
WHERE ingestion_date = '2024-01-01' AND NOT coalesce(adult, false) AND NOT coalesce(video, false)
ORDER BY popularity DESC, id LIMIT 20 OFFSET 40""",
    "top_k_popular": with_(RAW)
    + """
SELECT id, title, popularity, release_date FROM raw_items
WHERE ingestion_date = '2024-01-01' AND NOT coalesce(adult, false) AND NOT coalesce(video, false)
ORDER BY popularity DESC, id LIMIT 60""",
    "top_genres": with_(PIPELINE)
    + """
SELECT g.genre_name, count(DISTINCT b.movie_id) AS nb_items, round(avg(f.vote_average), 2) AS mean_vote
FROM fact_items f JOIN bridge_item_genre b ON f.movie_id = b.movie_id
JOIN dim_genre g ON b.genre_id = g.genre_id
GROUP BY g.genre_name ORDER BY nb_items DESC, g.genre_name LIMIT 5""",
    "dq_unique": """
SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL
GROUP BY l_orderkey HAVING count(*) > 1""",
    "dq_unique_combination": """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_not_null": with_(RAW)
    + "\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM raw_items"
        for c in (
            "adult backdrop_path genre_ids id original_language original_title overview popularity "
            "poster_path release_date title video vote_average vote_count ingestion_date"
        ).split()
    ),
    "dq_accepted_values": with_(RAW)
    + """
SELECT original_language AS value_field, count(*) AS n_records FROM raw_items
WHERE original_language NOT IN ('en', 'fr', 'de') GROUP BY original_language""",
    "dq_relationships": with_(PIPELINE)
    + """
SELECT f.movie_id, f.language_code FROM fact_items f
WHERE f.language_code IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_language d WHERE d.language_code = f.language_code)""",
    "dq_suite": suite_sql(PIPELINE, SUITE),
    "dq_suite_dirty": suite_sql(
        ",".join([RAW, LOOKUPS.replace("lpad(CAST(n_nationkey AS VARCHAR), 2, '0')", "n_nationkey AS code, lpad(CAST(n_nationkey AS VARCHAR), 2, '0')")]),
        DIRTY,
    ),
    "metric_mapping": with_(metric_names_sql(), MAPPED)
    + """
SELECT metric, dag_id, task_id, state, raw_metric, count(*) AS n_samples FROM mapped
GROUP BY metric, dag_id, task_id, state, raw_metric""",
    "metric_rate": with_(COUNTER)
    + """
SELECT event_type, date_trunc('minute', ts) AS window_start, sum(delta) * 60.0 / 60.0 AS rate_per_min
FROM deltas GROUP BY 1, 2""",
    "metric_increase": with_(COUNTER, DAILY_INCREASE) + "\nSELECT * FROM daily",
    "metric_last": """
SELECT event_type, user_id, max(CASE WHEN rn = 1 THEN value END) AS last_value, max(value) AS max_value
FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE value IS NOT NULL) t
GROUP BY event_type, user_id""",
    "metric_p99": """
SELECT user_id, round(quantile_cont(value, 0.99), 6) AS p99 FROM events
WHERE event_type = 'view' GROUP BY user_id""",
    "metric_status": with_(COUNTER, DAILY_INCREASE)
    + """
SELECT event_type, window_start, increase, increase / 1440.0 AS rate_per_min,
       CASE WHEN increase / 1440.0 >= 5 THEN 'green' WHEN increase / 1440.0 >= 1 THEN 'yellow' ELSE 'red' END
         AS rate_status,
       CASE WHEN increase >= 1 THEN 'red' ELSE 'green' END AS failure_status
FROM daily""",
    "metric_sample": """
WITH mx AS (SELECT max(ts) AS m FROM events),
recent AS (
  SELECT e.* FROM events e, mx WHERE e.ts <= mx.m AND e.ts >= mx.m - INTERVAL 7 DAY AND e.value IS NOT NULL),
stepped AS (
  SELECT event_type, value, ts, event_id,
         date_trunc('minute', ts) + CAST(floor(second(ts) / 15) * 15 AS INTEGER) * INTERVAL 1 SECOND AS step_start
  FROM recent)
SELECT event_type, step_start, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, step_start ORDER BY ts DESC, event_id DESC) AS rn
  FROM stepped) t WHERE rn = 1""",
    "metric_by_state": with_(metric_names_sql(), MAPPED)
    + """
SELECT dag_id, task_id, state, count(*) AS n_samples FROM mapped
WHERE metric = 'airflow_ti_finish_total' GROUP BY dag_id, task_id, state""",
}

