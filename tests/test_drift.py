import pytest
from pyspark.sql import functions as F

from reelhouse.plans import pipeline
from reelhouse.plans.catalogue import Catalogue
from reelhouse.sources import drift, io, schemas
from tests.conftest import SF_SMALL
from tests.helpers import D1, raw_items


def _lake(spark, root):
    cat = Catalogue.from_tables(spark, SF_SMALL)
    pipeline.land_raw(spark, root, cat.raw, D1)
    return f"{io.dataset_path(root, 'raw', 'movies')}/ingestion_date={D1}"


def _add(df, leaf):
    df.drop("ingestion_date").coalesce(1).write.mode("append").parquet(leaf)


def test_files_as_expected_pass(spark, tmp_path):
    root = str(tmp_path)
    leaf = _lake(spark, root)
    # narrower numbers are widened by the reader; case and order do not matter
    _add(raw_items(spark).withColumn("vote_count", F.col("vote_count").cast("int")).withColumnRenamed("title", "TITLE"), leaf)
    for name, schema in pipeline.RAW_SCHEMAS.items():
        assert drift.drift_gate(spark, root, "raw", name, D1, schema) == 0
    assert drift.drift_gate(spark, root, "raw", "nothing", D1, schemas.RAW_ITEMS) == 0


def test_one_drifted_file_is_named_or_set_aside(spark, tmp_path):
    root = str(tmp_path)
    leaf = _lake(spark, root)
    clean = pipeline.run_staging(spark, root, D1)
    bad = raw_items(spark).drop("title").withColumn("tagline", F.lit("x")).withColumn("popularity", F.col("popularity").cast("string"))
    _add(bad, leaf)
    found = drift.file_drift(spark, root, "raw", "movies", D1, schemas.RAW_ITEMS).collect()
    assert [(r.missing, r.unexpected, r.retyped) for r in found] == [(["title"], ["tagline"], ["popularity"])]
    with pytest.raises(drift.SchemaDriftError, match=r"1 part file.*missing title, unexpected tagline, retyped popularity"):
        pipeline.run_staging(spark, root, D1)
    assert pipeline.run_staging(spark, root, D1, set_drift_aside=True) == clean | {"movies_drifted": 1}
    assert pipeline.run_staging(spark, root, D1) == clean  # it is out of the way now
    aside = tmp_path / "raw" / "_drifted" / "movies" / f"ingestion_date={D1}"
    assert len(list(aside.glob("*.parquet"))) == 1


def test_large_files_are_told_by_their_schema(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    leaf = _lake(spark, root)
    _add(raw_items(spark).drop("video"), leaf)
    monkeypatch.setattr(drift, "LARGEST_IN_TASK", 0)
    found = drift.file_drift(spark, root, "raw", "movies", D1, schemas.RAW_ITEMS).collect()
    assert [(r.missing, r.unexpected, r.retyped) for r in found] == [(["video"], [], [])]


def test_counts_that_differ_fail_the_run(spark, tmp_path):
    from reelhouse.operators import quality

    root = str(tmp_path)
    _lake(spark, root)
    spark.sql("CREATE DATABASE IF NOT EXISTS drift_raw")
    spark.sql("CREATE DATABASE IF NOT EXISTS drift_marts")
    pipeline.run_staging(spark, root, D1)
    curated = pipeline.run_curated(spark, root, D1)
    pipeline.run_load(spark, root, D1, "drift_raw")
    pipeline.run_models(spark, "drift_raw", "drift_marts")
    assert pipeline.run_counts(spark, curated, "drift_marts") == {"tables": 6}
    with pytest.raises(quality.DataQualityError, match=r"fact_items has \d+ rows for 7"):
        pipeline.run_counts(spark, curated | {"movies_enriched": 7}, "drift_marts")


def test_drifted_file_is_written_by_a_task_that_copies_stored_rows(spark, tmp_path, monkeypatch):
    from reelhouse.plans import queries

    frame = type(spark.range(1))
    plans, tasks = [], frame.coalesce
    monkeypatch.setattr(frame, "coalesce", lambda df, n: plans.append(df._jdf.queryExecution().toString()) or tasks(df, n))
    out = queries.q_drift_gate(spark, SF_SMALL).collect()
    assert [(r.status, r.n_drifted) for r in out] == [("F", 2)]
    assert len(plans) == 2 and not any("Join" in p or "Aggregate" in p for p in plans)


def test_large_files_are_not_read_into_a_task():
    assert drift.LARGEST_IN_TASK <= 32 << 20
