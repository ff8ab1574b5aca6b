"""Declarative data tests as DataFrame operators.

Each test returns the offending rows, like a test query that must come back
empty. ``run_suite`` evaluates a list of checks into one
(test_name, kind, model, column_name, failures, status) frame. Per frame it
makes one grouped pass for the uniqueness of a key and all not-null checks,
one for all accepted-values checks and one for all relationship checks;
further keys get a grouped count each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataQualityError(RuntimeError):
    """Raised by ``assert_suite`` when at least one test has failures."""


# --- single tests ----------------------------------------------------------


def unique(df: DataFrame, col: str) -> DataFrame:
    """Q1: duplicated non-NULL values with their row count."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q2: rows where ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q2 over many columns in one scan: (column_name, n_null) per column."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").cast("long").alias("n_null"))
            for i, c in enumerate(cols)
        ]
    )
    return one.select(F.inline(rows))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Q3: values outside ``values`` with their row count; NULL passes."""
    return (
        df.filter(~F.col(col).isin(list(values)))
        .groupBy(F.col(col).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL ``fk`` has no ``key`` in the parent.

    The NULL filter is needed: a left anti join alone returns NULL keys.
    """
    keys = parent.select(F.col(key).alias("_parent_key")).filter(F.col("_parent_key").isNotNull())
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_parent_key"), "left_anti")


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q5: duplicated combinations; NULLs group together."""
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


# --- suite -------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    kind: str  # unique | not_null | accepted_values | relationships | unique_combination
    model: str
    columns: tuple[str, ...]
    values: tuple = field(default=())
    parent: str | None = None
    parent_key: str | None = None

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)

    @property
    def name(self) -> str:
        base = f"{self.kind}_{self.model}_{'_'.join(self.columns)}"
        return f"{base}__{self.parent}" if self.parent else base


def _counted(one: DataFrame, found: list[tuple[Check, Column]]) -> DataFrame:
    """A one-row frame of sums as (test_name, failures) rows; no rows at all count as 0."""
    rows = [
        F.struct(F.lit(c.name).alias("test_name"), F.coalesce(n, F.lit(0)).cast("long").alias("failures"))
        for c, n in found
    ]
    return one.select(F.inline(F.array(*rows)))


def _key_pass(df: DataFrame, key: tuple[str, ...], uniques: list[Check], nulls: list[Check]) -> DataFrame:
    """One grouped pass: repeated keys, and NULLs of every checked column."""
    cols = sorted({c.columns[0] for c in nulls})
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in cols if c not in key],
    )
    # A single key is NULL-free for uniqueness; a combination groups its NULLs.
    known = F.col(key[0]).isNotNull() if len(key) == 1 else F.lit(True)
    one = per_key.agg(
        F.count_if(known & (F.col("_n") > 1)).alias("_repeated"),
        *[
            F.sum(F.when(F.col(c).isNull(), F.col("_n")) if c in key else F.col(f"_null_{c}")).alias(f"_null_{c}")
            for c in cols
        ],
    )
    found = [(c, F.col("_repeated")) for c in uniques] + [(c, F.col(f"_null_{c.columns[0]}")) for c in nulls]
    return _counted(one, found)


def _null_pass(df: DataFrame, nulls: list[Check]) -> DataFrame:
    cols = sorted({c.columns[0] for c in nulls})
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in cols])
    return _counted(one, [(c, F.col(f"_null_{c.columns[0]}")) for c in nulls])


def _value_pass(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Distinct unaccepted values of all checked columns: one scan that keeps violations only."""
    bad = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.when(~F.col(c.columns[0]).isin(list(c.values)), F.col(c.columns[0]).cast("string")).alias("v"),
            )
            for i, c in enumerate(checks)
        ]
    )
    seen = df.select(F.inline(F.filter(bad, lambda x: x["v"].isNotNull()))).distinct()
    one = seen.agg(*[F.count_if(F.col("i") == i).alias(f"_v{i}") for i in range(len(checks))])
    return _counted(one, [(c, F.col(f"_v{i}")) for i, c in enumerate(checks)])


def _parent_pass(df: DataFrame, checks: list[Check], models: dict[str, DataFrame]) -> DataFrame:
    """All foreign keys of a frame in one scan: left joins to the distinct parent keys."""
    df = df.select(*dict.fromkeys(c.columns[0] for c in checks))
    for i, c in enumerate(checks):
        keys = models[c.parent].select(F.col(c.parent_key).alias(f"_p{i}")).where(f"_p{i} is not null").distinct()
        df = df.join(keys, F.col(c.columns[0]) == F.col(f"_p{i}"), "left")
    one = df.agg(
        *[
            F.count_if(F.col(c.columns[0]).isNotNull() & F.col(f"_p{i}").isNull()).alias(f"_f{i}")
            for i, c in enumerate(checks)
        ]
    )
    return _counted(one, [(c, F.col(f"_f{i}")) for i, c in enumerate(checks)])


def run_suite(
    models: dict[str, DataFrame], checks: Sequence[Check], same_rows: dict[str, str] | None = None
) -> DataFrame:
    """Q6: one row per check with its failure count and pass/fail status.

    ``same_rows`` names, for a model that is row for row a projection of
    another, the model to read instead (it must have the checked columns), so
    that layers of one row set are tested in the same passes.
    """
    kinds = {"unique", "unique_combination", "not_null", "accepted_values", "relationships"}
    frames: dict[int, tuple[DataFrame, list[Check]]] = {}
    for c in checks:
        if c.kind not in kinds:
            raise ValueError(f"unknown check kind {c.kind!r}")
        df = models[(same_rows or {}).get(c.model, c.model)]
        frames.setdefault(id(df), (df, []))[1].append(c)
    parts: list[DataFrame] = []
    for df, own in frames.values():
        nulls = [c for c in own if c.kind == "not_null"]
        keys: dict[tuple[str, ...], list[Check]] = {}
        for c in own:
            if c.kind in ("unique", "unique_combination"):
                keys.setdefault(c.columns, []).append(c)
        for i, (key, uniques) in enumerate(keys.items()):
            parts.append(_key_pass(df, key, uniques, [] if i else nulls))
        if nulls and not keys:
            parts.append(_null_pass(df, nulls))
        if values := [c for c in own if c.kind == "accepted_values"]:
            parts.append(_value_pass(df, values))
        if parents := [c for c in own if c.kind == "relationships"]:
            parts.append(_parent_pass(df, parents, models))
    failures = reduce(DataFrame.union, parts)
    # Test metadata is attached once, from a frame of one row per declared
    # test (bounded by the suite, so broadcast), not as literals per part.
    spark = failures.sparkSession
    meta = spark.createDataFrame(
        [(c.name, c.kind, c.model, c.column_name) for c in checks],
        "test_name string, kind string, model string, column_name string",
    )
    return (
        F.broadcast(meta)
        .join(failures, "test_name")
        .withColumn("status", F.when(F.col("failures") > 0, "fail").otherwise("pass"))
    )


def assert_suite(result: DataFrame) -> None:
    """Q7: stop the run when any test failed.

    Only the failing rows of the suite result come to the driver: one row
    per failing test, bounded by the number of declared tests.
    """
    raise_on_failures(result.filter(F.col("failures") > 0).select("test_name", "failures").collect())


def raise_on_failures(rows: Sequence) -> None:
    """Q7 over collected suite rows (one per declared test)."""
    failing = [r for r in rows if r.failures > 0]
    if failing:
        detail = ", ".join(f"{r.test_name}={r.failures}" for r in failing)
        raise DataQualityError(f"{len(failing)} data test(s) failed: {detail}")


def expect_counts(actual: DataFrame, expected: DataFrame, name_col: str = "table_name") -> DataFrame:
    """Q8: names whose row count differs from the expectation (or is missing)."""
    a = actual.select(name_col, F.col("n_rows").alias("actual"))
    e = expected.select(name_col, F.col("n_rows").alias("expected"))
    return a.join(e, name_col, "full_outer").filter(
        ~F.col("actual").eqNullSafe(F.col("expected"))
    )


# --- the catalogue's declared tests ----------------------------------------
# The 51 declared tests of the catalogue, by layer, restated as
# (kind, model, columns[, accepted values | parent, parent key]).


def _u(model: str, col: str) -> list[Check]:
    return [Check("unique", model, (col,)), Check("not_null", model, (col,))]


def _nn(model: str, col: str) -> Check:
    return Check("not_null", model, (col,))


def _rel(model: str, col: str, parent: str, key: str) -> Check:
    return Check("relationships", model, (col,), parent=parent, parent_key=key)


POPULARITY_TIERS = ("high", "medium", "low")
VOTE_TIERS = ("excellent", "good", "average", "poor")

CATALOGUE_SUITE: list[Check] = [
    # sources (curated outputs as loaded): 11
    *_u("src_items_enriched", "movie_id"),
    *_u("src_dim_genre", "genre_id"),
    _nn("src_dim_genre", "genre_name"),
    *_u("src_dim_country", "country_code"),
    *_u("src_dim_language", "language_code"),
    _nn("src_item_genres", "movie_id"),
    _nn("src_item_genres", "genre_id"),
    # staging: 14
    *_u("stg_items", "movie_id"),
    Check("accepted_values", "stg_items", ("popularity_tier",), values=POPULARITY_TIERS),
    Check("accepted_values", "stg_items", ("vote_tier",), values=VOTE_TIERS),
    *_u("stg_genres", "genre_id"),
    _nn("stg_genres", "genre_name"),
    *_u("stg_countries", "country_code"),
    *_u("stg_languages", "language_code"),
    Check("unique_combination", "stg_item_genres", ("movie_id", "genre_id")),
    _nn("stg_item_genres", "movie_id"),
    _nn("stg_item_genres", "genre_id"),
    # intermediate: 3
    *_u("item_metrics", "movie_id"),
    _nn("item_metrics", "composite_score"),
    # marts: 23
    *_u("dim_genre", "genre_id"),
    _nn("dim_genre", "genre_name"),
    *_u("dim_country", "country_code"),
    *_u("dim_language", "language_code"),
    *_u("dim_date", "date_id"),
    *_u("dim_date", "date_day"),
    _nn("dim_date", "year"),
    *_u("fact_items", "movie_id"),
    _rel("fact_items", "release_date_id", "dim_date", "date_id"),
    _rel("fact_items", "language_code", "dim_language", "language_code"),
    _nn("fact_items", "popularity"),
    _nn("fact_items", "vote_average"),
    Check("unique_combination", "bridge_item_genre", ("movie_id", "genre_id")),
    _nn("bridge_item_genre", "movie_id"),
    _rel("bridge_item_genre", "movie_id", "fact_items", "movie_id"),
    _nn("bridge_item_genre", "genre_id"),
    _rel("bridge_item_genre", "genre_id", "dim_genre", "genre_id"),
]

# Layers of the in-memory chain that are row for row projections of another.
CHAIN_SAME_ROWS = {
    "src_items_enriched": "items_all",
    "stg_items": "items_all",
    "item_metrics": "items_all",
    "fact_items": "items_all",
    "stg_item_genres": "bridge_item_genre",
}
