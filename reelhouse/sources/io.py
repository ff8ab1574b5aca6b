"""Reading and writing the date-partitioned lake.

Datasets live under ``<root>/<layer>/<dataset>/ingestion_date=YYYY-MM-DD/``.
Reads go through the dataset root plus a filter on the partition column, so
Catalyst prunes partitions (``PartitionFilters``) instead of the caller
building leaf paths. A write replaces exactly the partition of its date, also
when it has no rows; other dates stay untouched. The rows are staged beside
the dataset and take the partition's place when the whole write has succeeded,
so a write that fails leaves the former rows.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelhouse.session import scratch_path

PARTITION_COL = "ingestion_date"


def dataset_path(root: str, layer: str, dataset: str) -> str:
    return os.path.join(root, layer, dataset)


def qualified_name(layer: str | None, name: str, default: str = "default") -> str:
    """A custom namespace is used as is (trimmed), else the default."""
    ns = layer.strip() if layer is not None else default
    return f"{ns}.{name}"


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_partition(
    spark: SparkSession,
    root: str,
    layer: str,
    dataset: str,
    ingestion_date: str,
    schema: StructType | None = None,
) -> DataFrame:
    """All part files of one date partition.

    With ``schema`` the fixed schema is enforced (partition column included as
    a string); columns absent from the files read as NULL. Only ``*.parquet``
    files are picked up. A dataset that its file system does not have gives an
    empty frame of the schema; Spark itself looks, so the rule is the same for
    plain paths and every URI scheme.
    """
    path = dataset_path(root, layer, dataset)
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or schema is None:
            raise
        return empty_frame(spark, schema)
    return df.filter(F.col(PARTITION_COL) == F.lit(ingestion_date))


def write_partition(
    df: DataFrame,
    root: str,
    layer: str,
    dataset: str,
    ingestion_date: str,
    max_records_per_file: int | None = None,
) -> int:
    """Replace the partition of one date with ``df``; return rows.

    A dynamic overwrite of one static partition: tasks write below a staging
    folder, and only the commit of the finished job puts the partition in the
    place of the old one. A failed or killed write leaves the old rows. A write
    without rows commits nothing that way, so the partition is emptied after
    it, when its emptiness is known. The date is the partition's, whatever
    ``df`` has in that column.

    The row count is observed during the write itself (one job, not a
    ``count()`` plus a write). No ``coalesce(1)``: the last stage keeps its
    parallelism and ``maxRecordsPerFile`` bounds file sizes.
    """
    obs = Observation(f"rows_{layer}_{dataset}")
    rows = df.drop(PARTITION_COL)
    observed = rows.observe(obs, F.count(F.lit(1)).alias("n")).withColumn(PARTITION_COL, F.lit(ingestion_date))
    writer = observed.write.mode("overwrite").partitionBy(PARTITION_COL)
    writer = writer.option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    path = dataset_path(root, layer, dataset)
    writer.parquet(path)
    n = int(obs.get["n"])
    if not n:
        leaf = os.path.join(path, f"{PARTITION_COL}={ingestion_date}")
        empty_frame(df.sparkSession, rows.schema).write.mode("overwrite").parquet(leaf)
    return n


def stamp_date(df: DataFrame, ingestion_date: str, col: str = PARTITION_COL) -> DataFrame:
    """Every row carries the processing date."""
    return df.withColumn(col, F.lit(ingestion_date))


# Page numbers that one task of the gap search orders.
PAGE_BUCKET = 100_000


def _page_documents(spark: SparkSession, path: str, schema: StructType, columns: tuple[str, ...] = ("*",)) -> DataFrame:
    """Saved pages, with the time and name of their file.

    Every file is opened and parsed once: what was read is stored under the
    shared scratch folder, and the looks at page numbers take their column.
    """
    docs = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    docs = docs.select(*columns, "_metadata.file_modification_time", "_metadata.file_path")
    stored = scratch_path(spark, "page-documents")
    docs.write.parquet(stored)
    return spark.read.schema(docs.schema).parquet(stored)


def _page_cap(docs: DataFrame, max_pages: int | None) -> DataFrame:
    """One row ``cap``: the last page that is read, NULL without page 1."""
    total = docs.filter(F.col("page") == 1).agg(F.max("total_pages").cast("long").alias("cap"))
    return total if max_pages is None else total.select(F.when(F.col("cap") > max_pages, int(max_pages)).otherwise(F.col("cap")).alias("cap"))


def page_gaps(pages: DataFrame, cap: DataFrame, bucket: int = PAGE_BUCKET) -> DataFrame:
    """(page_from, page_to): runs of page numbers 1..cap that ``pages`` (column page) lacks.

    Gaps and islands: each page is compared with the next one that is there,
    page 0 and the page after the cap standing for the ends. The next page is
    looked up inside ranges of ``bucket`` numbers, and for a range's last page
    in the next range that has any, so no task orders more than a range.
    """
    ends = cap.select(F.explode(F.array(F.lit(0).cast("long"), F.col("cap") + 1)).alias("page"))
    last = cap.scalar()
    seen = pages.select(F.col("page").cast("long").alias("page")).filter(F.col("page").between(1, last))
    seen = seen.unionByName(ends).distinct().withColumn("_b", F.floor(F.col("page") / bucket))
    inside = Window.partitionBy("_b").orderBy("page")
    seen = seen.withColumn("_next", F.lead("page").over(inside))
    first = seen.groupBy("_b").agg(F.min("page").alias("_first"))
    # One row per range of numbers.
    ahead = first.select("_b", F.lead("_first").over(Window.orderBy("_b")).alias("_ahead"))
    following = F.coalesce("_next", "_ahead")
    gaps = seen.join(ahead, "_b").filter(following > F.col("page") + 1)
    return gaps.select((F.col("page") + 1).alias("page_from"), (following - 1).alias("page_to"))


def page_report(spark: SparkSession, path: str, schema: StructType, max_pages: int | None = None) -> DataFrame:
    """S3: what is amiss with a set of saved pages: (kind, page_from, page_to, n), one row per
    ``gap`` (n pages lacking) and per ``repeated`` page (n documents)."""
    docs = _page_documents(spark, path, schema, ("page", "total_pages"))
    docs = docs.select(F.col("page").cast("long").alias("page"), "total_pages")
    cap = _page_cap(docs, max_pages)
    counted = docs.groupBy("page").agg(F.count(F.lit(1)).alias("n"))
    repeated = counted.filter((F.col("n") > 1) & (F.col("page") <= cap.scalar()))
    gaps = page_gaps(counted, cap).withColumn("n", F.col("page_to") - F.col("page_from") + 1)
    return gaps.select(F.lit("gap").alias("kind"), "page_from", "page_to", "n").unionByName(
        repeated.select(F.lit("repeated").alias("kind"), F.col("page").alias("page_from"), F.col("page").alias("page_to"), "n")
    )


def read_pages(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_pages: int | None = None,
) -> DataFrame:
    """S3 re-aimed: saved listing pages -> item rows, the set being complete.

    Pages beyond the ``total_pages`` of page 1 (and beyond ``max_pages``, when
    the caller gives one) are ignored, like the paginated download that stops
    there. All others have to be there: a missing page fails the read, and the
    error names the first gap. A page that was saved again counts once, as
    saved last. A malformed document, a document without a page number and a
    set without page 1 fail the read too.

    The documents are parsed and stored first. Over them it is one distributed
    plan: the cap and the gaps come in through scalar subqueries over page
    numbers; only documents of repeated pages are shuffled.
    """
    docs = _page_documents(spark, path, schema)
    fail = lambda why: F.raise_error(F.concat(F.lit(f"{path}: "), why)).cast("long")
    number = F.coalesce(F.col("page").cast("long"), fail(F.lit("a document has no page number")))
    docs = docs.withColumn("page", number)
    counted = docs.groupBy("page").agg(F.count(F.lit(1)).alias("n"))
    cap = _page_cap(docs, max_pages)
    first = F.min(F.struct("page_from", "page_to"))
    lacking = page_gaps(counted, cap).agg(
        F.concat(
            F.sum(F.col("page_to") - F.col("page_from") + 1).cast("string"), F.lit(" pages are missing, the first are "),
            first["page_from"].cast("string"), F.lit(" to "), first["page_to"].cast("string"),
        )
    ).scalar()
    last = F.coalesce(cap.scalar(), fail(F.lit("page 1 with its total_pages is missing")))
    last = F.when(lacking.isNull(), last).otherwise(fail(lacking))
    again = counted.filter("n > 1").select("page")
    kept = docs.filter(F.col("page") <= last)
    once = kept.join(again, "page", "left_anti").select("results")
    saved = F.struct("file_modification_time", "file_path", F.xxhash64(F.to_json(F.struct("results"))).alias("h"))
    newest = kept.join(again, "page", "left_semi").groupBy("page").agg(F.max_by(F.struct("results"), saved).alias("d"))
    return once.unionByName(newest.select("d.results")).selectExpr("inline(results)")


def read_wrapped_lookup(spark: SparkSession, path: str, field: str, schema: StructType) -> DataFrame:
    """A lookup wrapped in an object, e.g. ``{"genres": [{..}, ..]}``."""
    from pyspark.sql.types import ArrayType, StructField

    wrapper = StructType([StructField(field, ArrayType(schema), True)])
    return spark.read.schema(wrapper).option("multiLine", True).json(path).selectExpr(f"inline({field})")


def read_array_lookup(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A lookup stored as a top-level JSON array (one row per element)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
