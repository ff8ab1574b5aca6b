import datetime as dt

from reelhouse.sources.schemas import RAW_ITEMS

D1, D2 = "2024-01-01", "2024-01-02"

# Unit rows: (id, title, original_language, genre_ids, popularity, release_date,
# vote_average, vote_count, ingestion_date)
ITEM_ROWS = [
    (1, "  A ", "en", [1, 2, 2], 100.0, "1999-12-31", 7.5, 10, D1),
    (2, "B", "fr", [], 99.99, "2000-01-01", 7.49, 0, D1),
    (3, "C", None, None, 20.0, "", 6.0, 1, D1),
    (4, None, "de", [None, 5], 19.99, "2024-02-29", 3.99, None, D1),
    (5, "E", "zz", [99], None, "2024-13-01", None, 3, D1),
    (6, "F", "en", [1], float("nan"), "1899-12-31", 4.0, 5, D1),
    (None, "X", "en", [1], 1.0, "2001-01-01", 5.0, 5, D1),
    (1, "A2", "en", [1], 1.0, "1999-12-31", 5.0, 5, D2),
]


def raw_items(spark, rows=ITEM_ROWS):
    full = []
    for r in rows:
        id_, title, lang, genres, pop, rel, va, vc, d = r
        full.append((False, None, genres, id_, lang, title, " ov ", pop, None, rel, title, False, va, vc, d))
    return spark.createDataFrame(full, RAW_ITEMS)


def genres(spark):
    return spark.createDataFrame(
        [(1, "Action", D1), (2, "Drama", D1), (5, "Comedy", D1), (1, "Action", D1), (None, "Nobody", D1)],
        "id long, name string, ingestion_date string",
    )


def languages(spark):
    return spark.createDataFrame(
        [("en", "English", "English", D1), ("fr", "French", "Français", D1), ("de", "German", "Deutsch", D1)],
        "iso_639_1 string, english_name string, name string, ingestion_date string",
    )


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def day(s):
    return dt.date.fromisoformat(s)
