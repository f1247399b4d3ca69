"""Scans: CSV, Parquet splits, JSONL, optional files, and the presence audit."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.fixed_values import EXPECTED_FILES, MISSING_TEXTS
from tallyguard.sources.schemas import CHAT


def without_missing_texts(df: DataFrame) -> DataFrame:
    """Text columns with null for each of MISSING_TEXTS."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`")) for c in texts})


def csv_scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row; MISSING_TEXTS and unreadable numbers are null.

    Without a schema one pass finds the type of every column: whole numbers, numbers or text.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        return without_missing_texts(reader.option("enforceSchema", True).schema(schema).csv(path))
    raw = without_missing_texts(reader.csv(path))
    found = raw.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & F.expr(f"try_cast(`{c}` AS {t})").isNull()).alias(f"{t}{i}")
                      for i, c in enumerate(raw.columns) for t in ("bigint", "double")]).first() if raw.columns else {}

    def kind(i: int) -> str:
        return next((t for t in ("bigint", "double") if not found[f"{t}{i}"]), "string")

    return raw.select(*[F.col(f"`{c}`").cast(kind(i)).alias(c) for i, c in enumerate(raw.columns)])


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Column names of the header row; a repeated name gets ``.1``, ``.2``, ..."""
    lines = spark.read.text(path).head(1)
    seen: dict[str, int] = {}
    names = []
    for name in next(csv.reader([lines[0]["value"]])) if lines else []:
        name = name.strip().strip("'\"")
        n = seen.get(name, 0)
        seen[name] = n + 1
        names.append(f"{name}.{n}" if n else name)
    return names


def csv_scan_by_header(spark: SparkSession, path: str, known: T.StructType) -> DataFrame:
    """CSV with a header row whose columns may be fewer, more or in another order than known;
    unknown columns are read as text."""
    types = {f.name: f.dataType for f in known}
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType()))
                           for n in header_names(spark, path)])
    return csv_scan(spark, path, schema)


def csv_scan_named(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV without a header row; names and types come from the schema."""
    return spark.read.option("header", False).schema(schema).csv(path)


def dataset_path(out_dir: str, alias: str) -> str:
    """Folder of one processed data set."""
    return f"{out_dir.rstrip('/')}/dataset={alias}"


def parquet_scan(spark: SparkSession, out_dir: str, alias: str, split: str | None = None) -> DataFrame:
    """One processed data set; the split filter prunes to that split's files."""
    df = spark.read.parquet(dataset_path(out_dir, alias))
    return df if split is None else df.where(F.col("split") == split)


def jsonl_scan(spark: SparkSession, path: str, schema: T.StructType = CHAT) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).json(path)


def jsonl_pair(spark: SparkSession, train: str, validation: str,
               schema: T.StructType = CHAT) -> DataFrame:
    """Training and validation files as one table with a ``split`` column."""
    return (jsonl_scan(spark, train, schema).withColumn("split", F.lit("train"))
            .unionByName(jsonl_scan(spark, validation, schema).withColumn("split", F.lit("validation"))))


def numbered_lines(lines: DataFrame, group: str, file: str, start: str, line: str, out: str) -> DataFrame:
    """Number the lines of every group from 1, in the order of file name and place in the file.

    ``start`` is where in its file the piece begins that was read in one go, ``line`` grows within a
    piece. Lines are counted a piece at a time; only the pieces are ordered as a whole.
    """
    piece = [group, file, start]
    before = Window.partitionBy(group).orderBy(file, start).rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy(*piece).agg(F.count("*").alias("n"))
    # one row for a piece of a file, which has as many bytes as a task reads
    ahead = F.broadcast(sizes.select(F.col(group).alias("_group"), F.col(file).alias("_file"), F.col(start).alias("_start"),
                                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    numbered = lines.withColumn(out, F.row_number().over(Window.partitionBy(*piece).orderBy(line)))
    here = F.col(group).eqNullSafe(F.col("_group")) & (F.col(file) == F.col("_file")) & (F.col(start) == F.col("_start"))
    return (numbered.join(ahead, here).withColumn(out, (F.col(out) + F.col("_before")).cast("int"))
            .drop("_group", "_file", "_start", "_before"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on its file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def optional_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 name: str | None = None, by_header: bool = False) -> DataFrame | None:
    """The CSV file, or None with a message if it is absent."""
    if not path_exists(spark, path):
        print(f"[{name or path}] skipped, file not found: {path}")
        return None
    if by_header and schema is not None:
        return csv_scan_by_header(spark, path, schema)
    return csv_scan(spark, path, schema)


def manifest_audit(spark: SparkSession, data_dir: str,
                   expected: dict[str, list[str]] = EXPECTED_FILES) -> DataFrame:
    """Per alias the files present, as "name (x.x MB)", and the missing ones."""
    manifest = spark.createDataFrame(
        [(a, i, f) for a, files in expected.items() for i, f in enumerate(files)],
        "alias string, pos int, file string")
    names = ",".join(sorted({f for files in expected.values() for f in files}))
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", f"{{{names}}}").load(data_dir)
               .select(F.element_at(F.split("path", "/"), -1).alias("file"), "length"))
    shown = F.concat("file", F.lit(" ("),
                     F.format_string("%.1f", F.col("length") / F.lit(1024.0 * 1024.0)), F.lit(" MB)"))
    # the manifest names a handful of files per alias
    joined = manifest.join(listing, "file", "left")

    def ordered(when, value):
        return F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("pos", value.alias("v"))))),
                           lambda s: s["v"])
    return joined.groupBy("alias").agg(
        ordered(F.col("length").isNotNull(), shown).alias("found"),
        ordered(F.col("length").isNull(), F.col("file")).alias("missing"))
