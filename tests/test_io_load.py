import json
import os

import pytest
from pyspark.sql import functions as F

from reelhouse.sources import io, load, schemas
from reelhouse.sources.load import align_to_schema, load_all, load_table
from tests.helpers import D1, D2, raw_items


def _files(path):
    return sorted(f for f in os.listdir(path) if f.endswith(".parquet"))


def test_partition_overwrite_keeps_other_dates(spark, tmp_path):
    root = str(tmp_path)
    raw = raw_items(spark)
    n1 = io.write_partition(raw.filter(F.col("ingestion_date") == D1), root, "raw", "movies", D1)
    n2 = io.write_partition(raw.filter(F.col("ingestion_date") == D2), root, "raw", "movies", D2)
    assert (n1, n2) == (7, 1)
    # re-run D1 with fewer rows: D2 untouched, no stale D1 rows
    n1b = io.write_partition(raw.filter((F.col("ingestion_date") == D1) & (F.col("id") <= 2)), root, "raw", "movies", D1)
    assert n1b == 2
    d1 = io.read_partition(spark, root, "raw", "movies", D1, schemas.RAW_ITEMS)
    d2 = io.read_partition(spark, root, "raw", "movies", D2, schemas.RAW_ITEMS)
    assert d1.count() == 2 and d2.count() == 1
    assert d1.schema == schemas.RAW_ITEMS


def test_read_partition_prunes_partitions(spark, tmp_path, capsys):
    root = str(tmp_path)
    raw = raw_items(spark)
    for day in (D1, D2):
        io.write_partition(raw.filter(F.col("ingestion_date") == day), root, "raw", "movies", day)
    io.read_partition(spark, root, "raw", "movies", D2, schemas.RAW_ITEMS).filter(F.col("id").isNotNull()).explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan and D2 in plan
    assert "PushedFilters: [IsNotNull(id)]" in plan
    io.read_partition(spark, root, "raw", "movies", D2, schemas.RAW_ITEMS).select("id", "title").explain()
    assert "ReadSchema: struct<id:bigint,title:string>" in capsys.readouterr().out
    # an existing dataset without the requested date reads as 0 rows
    assert io.read_partition(spark, root, "raw", "movies", "1999-01-01", schemas.RAW_ITEMS).count() == 0


def test_max_records_per_file(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(0, 4500, 1, 1).select(F.col("id"), F.lit(D1).alias("ingestion_date"))
    io.write_partition(df, root, "raw", "many", D1, max_records_per_file=2000)
    assert len(_files(os.path.join(root, "raw", "many", f"ingestion_date={D1}"))) == 3


def test_missing_dataset_reads_empty_with_schema(spark, tmp_path):
    df = io.read_partition(spark, str(tmp_path), "raw", "nothing", D1, schemas.RAW_GENRES)
    assert df.count() == 0 and df.schema == schemas.RAW_GENRES


def test_qualified_name():
    assert io.qualified_name("marts", "fct") == "marts.fct"
    assert io.qualified_name(" staging ", "v") == "staging.v"
    assert io.qualified_name(None, "v", default="analytics") == "analytics.v"


def _item(i, pop):
    return {"id": i, "title": f"t{i}", "popularity": pop, "genre_ids": [1], "adult": False, "video": False}


def test_read_pages_caps_at_page_one_total(spark, tmp_path):
    d = tmp_path / "pages"
    d.mkdir()
    for page in (1, 2, 3):
        doc = {"page": page, "total_pages": 50 if page == 1 else 2, "results": [_item(page * 10 + j, 1.0) for j in range(2)]}
        (d / f"p{page}.json").write_text(json.dumps(doc))
    rows = io.read_pages(spark, str(d), max_pages=2, schema=schemas.PAGE_DOCUMENT).collect()
    assert sorted(r.id for r in rows) == [10, 11, 20, 21]


def _pages(tmp_path, docs):
    d = tmp_path / "pages"
    d.mkdir()
    for i, doc in enumerate(docs):
        (d / f"p{i}.json").write_text(doc if isinstance(doc, str) else json.dumps(doc))
    return str(d)


def test_all_announced_pages_are_read(spark, tmp_path):
    # every announced page, in many files of a few documents each
    pages = [{"page": p, "total_pages": 600, "results": [_item(p, 1.0)]} for p in range(1, 602)]
    docs = [json.dumps(pages[i : i + 40]) for i in range(0, 601, 40)]
    rows = io.read_pages(spark, _pages(tmp_path, docs), schemas.PAGE_DOCUMENT).collect()
    assert sorted(r.id for r in rows) == list(range(1, 601))


def test_missing_pages_are_named(spark, tmp_path):
    docs = [{"page": p, "total_pages": 9, "results": [_item(p, 1.0)]} for p in (1, 3, 4, 8)]
    path = _pages(tmp_path, docs)
    with pytest.raises(Exception, match="5 pages are missing, the first are 2 to 2"):
        io.read_pages(spark, path, schemas.PAGE_DOCUMENT).collect()
    # a smaller cap needs only its own pages
    with pytest.raises(Exception, match="1 pages are missing"):
        io.read_pages(spark, path, schemas.PAGE_DOCUMENT, max_pages=4).collect()
    assert [r.id for r in io.read_pages(spark, path, schemas.PAGE_DOCUMENT, max_pages=1).collect()] == [1]
    report = io.page_report(spark, path, schemas.PAGE_DOCUMENT)
    assert sorted(tuple(r) for r in report.collect()) == [("gap", 2, 2, 1), ("gap", 5, 7, 3), ("gap", 9, 9, 1)]


def test_gaps_across_ranges_of_page_numbers(spark):
    pages = spark.createDataFrame([(p,) for p in (2, 3, 9, 10, 11, 40, 41, 41)], "page long")
    cap = spark.createDataFrame([(50,)], "cap long")
    want = [(1, 1), (4, 8), (12, 39), (42, 50)]
    for bucket in (1, 4, 10, 1_000):
        assert sorted(tuple(r) for r in io.page_gaps(pages, cap, bucket).collect()) == want
    whole = spark.range(1, 51).select(F.col("id").alias("page"))
    assert io.page_gaps(whole, cap, 7).count() == 0
    assert [tuple(r) for r in io.page_gaps(whole.limit(0), cap, 7).collect()] == [(1, 50)]


def test_a_page_saved_again_counts_once_as_saved_last(spark, tmp_path):
    docs = [
        {"page": 1, "total_pages": 3, "results": [_item(10, 1.0)]},
        {"page": 3, "total_pages": 3, "results": [_item(30, 1.0)]},
        {"page": 2, "total_pages": 3, "results": [_item(20, 1.0)]},
        {"page": 3, "total_pages": 3, "results": [_item(31, 1.0), _item(32, 1.0)]},
    ]
    path = _pages(tmp_path, docs)
    for i in range(4):
        os.utime(os.path.join(path, f"p{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    rows = io.read_pages(spark, path, schemas.PAGE_DOCUMENT).collect()
    assert sorted(r.id for r in rows) == [10, 20, 31, 32]
    # twice in one file, and the same twice
    (tmp_path / "pages" / "p4.json").write_text(json.dumps([docs[2], docs[2]]))
    rows = io.read_pages(spark, path, schemas.PAGE_DOCUMENT).collect()
    assert sorted(r.id for r in rows) == [10, 20, 31, 32]
    repeated = io.page_report(spark, path, schemas.PAGE_DOCUMENT).collect()
    assert sorted(tuple(r) for r in repeated) == [("repeated", 2, 2, 3), ("repeated", 3, 3, 2)]


@pytest.mark.parametrize("docs", [
    [{"page": 2, "total_pages": 3, "results": [_item(2, 1.0)]}],
    [{"page": 1, "total_pages": 3, "results": [_item(1, 1.0)]}, '{"page": 2, "results": [{"id": 2'],
    [{"page": 1, "total_pages": 3, "results": [_item(1, 1.0)]}, {"total_pages": 3, "results": [_item(9, 1.0)]}],
])
def test_lost_pages_fail_the_read(spark, tmp_path, docs):
    with pytest.raises(Exception, match="page 1 with|FAILFAST|MALFORMED|no page number"):
        io.read_pages(spark, _pages(tmp_path, docs), schemas.PAGE_DOCUMENT).collect()


def test_plain_paths_and_uris_read_the_same(spark, tmp_path):
    root = str(tmp_path)
    io.write_partition(raw_items(spark), root, "raw", "movies", D1)
    n = [io.read_partition(spark, r, "raw", "movies", D1, schemas.RAW_ITEMS).count() for r in (root, f"file:{root}", f"file://{root}")]
    assert n == [8, 8, 8]
    assert io.read_partition(spark, f"file://{root}/none", "raw", "movies", D1, schemas.RAW_ITEMS).count() == 0


def test_empty_rerun_empties_the_partition(spark, tmp_path):
    root = str(tmp_path)
    io.write_partition(raw_items(spark), root, "raw", "movies", D1)
    io.write_partition(raw_items(spark), root, "raw", "movies", D2)
    assert io.write_partition(io.empty_frame(spark, schemas.RAW_ITEMS), root, "raw", "movies", D1) == 0
    read = lambda day: io.read_partition(spark, root, "raw", "movies", day, schemas.RAW_ITEMS).count()
    assert (read(D1), read(D2)) == (0, 8)


def test_lookups_from_json(spark, tmp_path):
    (tmp_path / "genres.json").write_text(json.dumps({"genres": [{"id": 1, "name": "Action"}, {"id": 2, "name": "Drama"}]}))
    (tmp_path / "countries.json").write_text(json.dumps([{"iso_3166_1": "FR", "english_name": "France", "native_name": "France"}]))
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    g = io.read_wrapped_lookup(spark, str(tmp_path / "genres.json"), "genres",
                               StructType([StructField("id", LongType()), StructField("name", StringType())]))
    assert sorted((r.id, r.name) for r in g.collect()) == [(1, "Action"), (2, "Drama")]
    c = io.read_array_lookup(spark, str(tmp_path / "countries.json"),
                             StructType([StructField(n, StringType()) for n in ("iso_3166_1", "english_name", "native_name")]))
    assert c.collect()[0].iso_3166_1 == "FR"


def test_align_to_schema_by_case_insensitive_name(spark):
    src = spark.createDataFrame([("Drama", "7", "extra")], "GENRE_NAME string, Genre_Id string, junk string")
    out = align_to_schema(src, schemas.DIM_GENRE)
    assert out.columns == ["genre_id", "genre_name"]
    assert out.collect()[0].asDict() == {"genre_id": 7, "genre_name": "Drama"}
    missing = align_to_schema(src.drop("GENRE_NAME"), schemas.DIM_GENRE).collect()[0]
    assert missing.genre_name is None


def test_load_aborts_on_bad_value(spark):
    src = spark.createDataFrame([("x", "Drama")], "genre_id string, genre_name string")
    with pytest.raises(Exception, match="genre_id has a value that is no bigint"):
        load_table(spark, src, "bad_dim_genre", schemas.DIM_GENRE)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_failed_load_leaves_the_old_table(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = spark.createDataFrame([("1", "A")], "genre_id string, genre_name string")
        assert load_table(spark, good, "kept_dim_genre", schemas.DIM_GENRE) == 1
        versions = load.table_versions(spark, "kept_dim_genre")
        with pytest.raises(Exception, match="no bigint"):
            load_table(spark, good.selectExpr("'1x' AS genre_id", "genre_name"), "kept_dim_genre", schemas.DIM_GENRE)
        assert [tuple(r) for r in spark.table("kept_dim_genre").collect()] == [(1, "A")]
        assert load.table_versions(spark, "kept_dim_genre") == versions
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_load_all_replaces_tables_idempotently(spark):
    frames = {"dim_genre": spark.createDataFrame([(1, "A"), (2, "B")], "genre_id long, genre_name string")}
    targets = {"dim_genre": schemas.DIM_GENRE, "dim_country": schemas.DIM_COUNTRY}
    spark.sql("CREATE DATABASE IF NOT EXISTS loadtest")
    for _ in range(2):
        summary = {r.dataset: (r.n_rows, r.status) for r in load_all(spark, frames, targets, "loadtest").collect()}
    assert summary == {"dim_genre": (2, "success"), "dim_country": (0, "skipped")}
    assert spark.table("loadtest.dim_genre").count() == 2


def test_schema_drift_is_case_insensitive(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "ID long, Name string, extra double")
    assert schemas.schema_drift(df.schema, schemas.RAW_GENRES) == {"missing": ["ingestion_date"], "unexpected": ["extra"]}


def test_failed_rerun_keeps_the_partition(spark, tmp_path):
    root = str(tmp_path)
    io.write_partition(raw_items(spark), root, "raw", "movies", D1)
    broken = raw_items(spark).repartition(4).withColumn("id", F.when(F.col("id") == 5, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        io.write_partition(broken, root, "raw", "movies", D1)
    read = lambda: io.read_partition(spark, root, "raw", "movies", D1, schemas.RAW_ITEMS)
    assert read().count() == 8
    # a re-run may read the rows it replaces
    assert io.write_partition(read().filter("id > 2"), root, "raw", "movies", D1) == 4
    assert read().count() == 4


def _genres(spark, *names):
    return spark.createDataFrame(list(enumerate(names)), "genre_id long, genre_name string")


def _names(spark, table):
    return sorted(r.genre_name for r in spark.table(table).collect())


def test_readers_see_whole_versions(spark):
    table = "versioned_genre"
    load_table(spark, _genres(spark, "a", "b"), table, schemas.DIM_GENRE)
    version, n = load.write_version(spark, _genres(spark, "c"), table, schemas.DIM_GENRE)
    assert n == 1 and _names(spark, table) == ["a", "b"]  # in mid-load, or after a crash there
    load_table(spark, _genres(spark, "d", "e", "f"), table, schemas.DIM_GENRE)
    assert _names(spark, table) == ["d", "e", "f"]
    # the dead version is behind the current one, so the next loads drop it
    load_table(spark, _genres(spark, "g"), table, schemas.DIM_GENRE)
    load_table(spark, _genres(spark, "h"), table, schemas.DIM_GENRE)
    assert len(load.table_versions(spark, table)) == 1 + load.KEEP_VERSIONS
    assert version not in load.table_versions(spark, table)
    load.drop_table(spark, table)
    assert not spark.catalog.tableExists(table) and load.table_versions(spark, table) == []


def test_a_plain_table_becomes_a_versioned_one(spark):
    _genres(spark, "old").write.saveAsTable("plain_genre")
    assert load_table(spark, _genres(spark, "new"), "plain_genre", schemas.DIM_GENRE) == 1
    assert _names(spark, "plain_genre") == ["new"]
    assert spark.table("plain_genre").schema == schemas.DIM_GENRE


def test_saved_pages_are_parsed_once(spark, tmp_path):
    docs = [{"page": p, "total_pages": 3, "results": [_item(p, 1.0)]} for p in (1, 2, 3, 2)]
    path = _pages(tmp_path, docs)
    rows = io.read_pages(spark, path, schemas.PAGE_DOCUMENT)
    assert "Scan json" not in rows._jdf.queryExecution().toString()  # the looks at page numbers read what is stored
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3]
    assert "Scan json" not in io.page_report(spark, path, schemas.PAGE_DOCUMENT)._jdf.queryExecution().toString()
