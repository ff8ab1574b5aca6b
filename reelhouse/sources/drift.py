"""Schema drift of raw part files (S7, S8), told per file.

A fixed schema is enforced when a partition is read, which hides files that
have other columns (they read as NULL or are ignored) and fails somewhere in
the job on files with other types. The gate looks at every file first: the
footers are taken in tasks (of large files by Spark's reader), and what differs from the expected schema is
named by file, before anything is read from it.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType

from reelhouse.sources.io import PARTITION_COL, dataset_path

# Files above this are not taken into a task whole; of those Spark reads the footer alone, some at a time.
LARGEST_IN_TASK = 8 << 20
FOOTERS_AT_ONCE = 8
# Types that the Parquet reader widens without loss.
_WIDENS = {(IntegerType(), LongType()), (ShortType(), LongType()), (FloatType(), DoubleType())}


class SchemaDriftError(RuntimeError):
    """Part files whose schema is not the expected one."""


def _differences(names: dict[str, DataType | None], expected: StructType) -> tuple[list[str], list[str], list[str]]:
    """(missing, unexpected, retyped) columns; names are compared without case. A type of None is unknown to Spark."""
    have = {n.lower(): t for n, t in names.items()}
    want = {f.name.lower(): f.dataType for f in expected.fields if f.name != PARTITION_COL}
    have.pop(PARTITION_COL, None)
    retyped = [n for n in want if n in have and have[n] != want[n] and (have[n], want[n]) not in _WIDENS]
    return sorted(set(want) - set(have)), sorted(set(have) - set(want)), sorted(retyped)


def _plain(t: DataType) -> DataType:
    """A type with everything nullable, as files differ in that without drifting."""
    from pyspark.sql.types import ArrayType, StructField

    if isinstance(t, ArrayType):
        return ArrayType(_plain(t.elementType), True)
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _plain(f.dataType), True) for f in t.fields])
    return t


def _arrow_types(schema: pa.Schema) -> dict[str, DataType | None]:
    from pyspark.sql.pandas.types import from_arrow_type

    out: dict[str, DataType | None] = {}
    for f in schema:
        try:
            out[f.name] = _plain(from_arrow_type(f.type))
        except Exception:  # a type that Spark has no name for
            out[f.name] = None
    return out


def file_drift(spark: SparkSession, root: str, layer: str, dataset: str, ingestion_date: str, expected: StructType) -> DataFrame:
    """(file, missing, unexpected, retyped) of the partition's part files that differ from ``expected``."""
    leaf = os.path.join(dataset_path(root, layer, dataset), f"{PARTITION_COL}={ingestion_date}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(leaf)
    out = "file string, missing array<string>, unexpected array<string>, retyped array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                schema = pq.read_schema(pa.BufferReader(content.as_buffer()))
                diff = _differences(_arrow_types(schema), expected)
                if any(diff):
                    found.append((path, *diff))
            cols = list(zip(*found)) or [(), (), (), ()]
            types = [pa.string()] + [pa.list_(pa.string())] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["file", "missing", "unexpected", "retyped"])

    small = files.filter(F.col("length") <= LARGEST_IN_TASK).select("path", "content").mapInArrow(run, out)

    def footer(path: str) -> tuple:
        names = {f.name: _plain(f.dataType) for f in spark.read.parquet(path).schema.fields}
        return path, *_differences(names, expected)

    paths = [r.path for r in files.filter(F.col("length") > LARGEST_IN_TASK).select("path").collect()]  # names of files
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        large = [found for found in pool.map(footer, paths) if any(found[1:])]
    return small.unionByName(spark.createDataFrame(large, out)) if large else small


def drift_gate(
    spark: SparkSession,
    root: str,
    layer: str,
    dataset: str,
    ingestion_date: str,
    expected: StructType,
    set_aside: bool = False,
) -> int:
    """Stop on drifted files, or set them aside and return how many.

    Set aside means moved, one rename each, to ``<root>/<layer>/_drifted/<dataset>/..``,
    where no read of the dataset looks; they can be moved back as they are.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    leaf = os.path.join(dataset_path(root, layer, dataset), f"{PARTITION_COL}={ingestion_date}")
    if not hadoop(leaf).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop(leaf)):
        return 0
    drifted = file_drift(spark, root, layer, dataset, ingestion_date, expected).collect()  # one row per bad file
    if not drifted:
        return 0
    if not set_aside:
        told = "; ".join(
            f"{r.file}: " + ", ".join(f"{kind} {' '.join(r[kind])}" for kind in ("missing", "unexpected", "retyped") if r[kind])
            for r in drifted[:20]
        )
        raise SchemaDriftError(f"{len(drifted)} part file(s) of {layer}/{dataset} {ingestion_date} have drifted: {told}")
    aside = hadoop(os.path.join(root, layer, "_drifted", dataset, f"{PARTITION_COL}={ingestion_date}"))
    fs = aside.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(aside)
    for r in drifted:
        source = hadoop(r.file)
        if not fs.rename(source, hadoop(aside, source.getName())):
            raise SchemaDriftError(f"{r.file} could not be set aside")
    return len(drifted)
