"""Run pipeline stages for one date: ``python -m reelhouse <stage> --root R --date D``.

Stages: ingest (saved JSON pages and lookups -> raw), staging, curated,
load, models, test, all. The session comes from
spark-submit (master, resources, ``spark.checkpoint.dir``); each stage prints
its (layer, dataset, n_rows) counts.
"""

from __future__ import annotations

import argparse
import datetime as dt

from reelhouse.operators import quality
from reelhouse.plans import pipeline
from reelhouse.session import get_spark


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="reelhouse")
    p.add_argument("stage", choices=["ingest", "staging", "curated", "load", "models", "test", "all"])
    p.add_argument("--root", required=True, help="lake root (raw/, staging/, curated/ below it)")
    p.add_argument("--date", default=dt.date.today().isoformat(), help="ingestion date YYYY-MM-DD")
    p.add_argument("--src", help="folder of saved pages/ and lookup JSON (ingest)")
    p.add_argument("--max-pages", type=int, help="stop after so many pages (default: all that page 1 announces)")
    p.add_argument("--records-per-file", type=int, help="rows per raw part file (default: unbounded)")
    p.add_argument("--as-of", help="reference date of the recent flag (default: today)")
    p.add_argument("--set-drift-aside", action="store_true", help="move drifted raw files aside instead of stopping")
    p.add_argument("--namespace", default="raw")
    p.add_argument("--marts", default="marts")
    a = p.parse_args(argv)

    spark = get_spark(f"reelhouse-{a.stage}")
    if a.stage == "ingest":
        if not a.src:
            p.error("ingest needs --src")
        print(pipeline.ingest_json(spark, a.src, a.root, a.date, a.max_pages, a.records_per_file))
    elif a.stage == "staging":
        print(pipeline.run_staging(spark, a.root, a.date, a.set_drift_aside))
    elif a.stage == "curated":
        print(pipeline.run_curated(spark, a.root, a.date, a.as_of))
    elif a.stage == "load":
        print(pipeline.run_load(spark, a.root, a.date, a.namespace))
    elif a.stage == "models":
        print(pipeline.run_models(spark, a.namespace, a.marts, a.as_of))
    elif a.stage == "test":
        rows = pipeline.run_tests(spark, a.namespace, a.marts, a.as_of).orderBy("test_name").collect()
        for r in rows:  # one row per declared test
            print(r.test_name, r.failures, r.status)
        quality.raise_on_failures(rows)
    else:
        done = pipeline.run_pipeline(
            spark, a.root, a.date, a.as_of, a.namespace, a.marts, set_drift_aside=a.set_drift_aside
        )
        done.show(truncate=False)


if __name__ == "__main__":
    main()
