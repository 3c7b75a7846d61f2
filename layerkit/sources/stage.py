"""Staged files: positional CSV, JSON documents as variant, listings, scoped loads, external views.

A *stage* is a folder of files plus the reader options used for it. Loading keeps the
stage-relative file name and a load time next to every row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Text forms of time values in staged files: full microsecond precision (fixed values)
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_TIME_OPTS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_NTZ_FORMAT}


@dataclass(frozen=True)
class FileFormat:
    """Reusable reader options (a named file format)."""
    kind: str = "csv"                       # csv | json
    options: dict = field(default_factory=dict)

    @staticmethod
    def csv(skip_header: bool = True, delimiter: str = ",", on_error: str = "abort") -> "FileFormat":
        mode = {"abort": "FAILFAST", "skip": "DROPMALFORMED", "continue": "PERMISSIVE"}[on_error]
        # enforceSchema binds columns by position and ignores the header text
        return FileFormat("csv", {"header": str(skip_header).lower(), "sep": delimiter,
                                  "mode": mode, "enforceSchema": "true", **_TIME_OPTS})

    @staticmethod
    def json(multi_line: bool = False, on_error: str = "abort") -> "FileFormat":
        mode = {"abort": "FAILFAST", "skip": "DROPMALFORMED", "continue": "PERMISSIVE"}[on_error]
        return FileFormat("json", {"multiLine": str(multi_line).lower(), "mode": mode, **_TIME_OPTS})


# Column layout of one order line file (fixed values: names and order of the staged columns)
ORDER_LINE_SCHEMA = T.StructType([
    T.StructField("customer", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("delivery_date", T.DateType()),
    T.StructField("baked_good_type", T.StringType()),
    T.StructField("quantity", T.DecimalType(38, 0)),
])


def relative_file(stage_path: str) -> Column:
    """``_metadata.file_path`` with the stage root removed (the file name relative to the stage).

    The metadata path is percent-encoded (a blank is ``%20``, a plus stays a plus), the root is not."""
    root = _strip_scheme(stage_path.rstrip("/")) + "/"
    # file paths come back fully qualified (file:/..., hdfs://host/...); keep what follows the root
    path = "url_decode(replace(_metadata.file_path, '+', '%2B'))"
    at = f"instr({path}, {_sql_str(root)})"
    return F.expr(f"if({at} > 0, substring({path}, {at} + {len(root)}), "
                  f"raise_error(concat('file outside the stage: ', {path})))")


def _strip_scheme(p: str) -> str:
    if p.startswith("file://"):
        return p[len("file://"):]
    if p.startswith("file:"):
        return p[len("file:"):]
    if "://" in p:
        rest = p.split("://", 1)[1]
        return "/" + rest.split("/", 1)[1] if "/" in rest else "/"
    return p


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _load_ts(load_ts) -> Column:
    return F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")


def read_stage(spark: SparkSession, stage_path: str, schema: T.StructType | None,
               fmt: FileFormat = FileFormat.csv(), *, sub_path: str | None = None,
               with_file: bool = True, load_ts=None, variant_col: str | None = None,
               path_glob: str | None = None) -> DataFrame:
    """Positional / typed scan of the staged files (``select $1..$n, metadata$filename, ...``).

    ``sub_path`` loads one folder of the stage only (``from @stage/202308``).
    ``variant_col`` reads each JSON document into one variant column instead of a schema.
    """
    path = stage_path.rstrip("/") + ("/" + sub_path.strip("/") if sub_path else "")
    r = spark.read.options(**fmt.options)
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    if fmt.kind == "json" and variant_col:
        df = r.option("singleVariantColumn", variant_col).json(path)
    else:
        r = r.schema(schema)
        df = r.csv(path) if fmt.kind == "csv" else r.json(path)
    cols = [F.col(c) for c in df.columns]
    if with_file:
        cols += [relative_file(stage_path).alias("source_file_name"), _load_ts(load_ts).alias("load_ts")]
    return df.select(*cols)


def stage_listing(spark: SparkSession, stage_path: str) -> DataFrame:
    """``list @stage`` / directory table: one row per file; contents are not read (column pruned)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(stage_path)
            .select(F.col("path").alias("name"), F.col("length").alias("size"),
                    F.col("modificationTime").alias("last_modified")))


class StageDirectory:
    """Directory table of a stage: the files as of the last refresh, kept as versions of a small table.

    Reads go by the stored list, not by a new listing, so a file that came or went is seen from the next refresh on. A
    refresh compares the listing with the stored list (name, size, time) and says what was added, changed and removed."""

    COLUMNS = ("name", "size", "last_modified")

    def __init__(self, spark: SparkSession, stage_path: str, state_path: str):
        from .snapshot import SnapshotTable
        self.spark, self.stage_path = spark, stage_path.rstrip("/")
        self.state = SnapshotTable(spark, state_path)

    def files(self) -> DataFrame:
        """name (relative to the stage), path, size, last_modified."""
        return self.state.refresh().read() if self.state.refresh().exists() else self._listing().limit(0)

    def _listing(self) -> DataFrame:
        root = _strip_scheme(self.stage_path) + "/"
        listed = stage_listing(self.spark, self.stage_path).where(~F.col("name").rlike("/[_.][^/]*$"))
        return listed.select(F.substring(F.col("name"), F.instr(F.col("name"), F.lit(root)) + F.lit(len(root)), F.length("name")).alias("name"),
                             F.col("name").alias("path"), "size", "last_modified")

    def refresh(self) -> dict:
        """Number of files added, changed and removed since the last refresh; a new version only if there are any."""
        now, old = self._listing().persist(), self.files()
        try:
            both = now.select("name", F.struct("size", "last_modified").alias("new")).join(
                old.select("name", F.struct("size", "last_modified").alias("old")), "name", "full_outer")
            kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("new") != F.col("old"), "changed")
            news = {r["kind"]: r["n"] for r in both.select(kind.alias("kind")).where("kind is not null").groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
            if news:
                self.state.publish(now.coalesce(4))
            return {k: int(news.get(k, 0)) for k in ("added", "changed", "removed")}
        finally:
            now.unpersist()

    def read(self, schema: T.StructType, fmt: FileFormat = FileFormat.csv(), computed: dict[str, Column] | None = None) -> DataFrame:
        """External table over the files of the last refresh, with computed columns and the file name."""
        paths = [r["path"] for r in self.files().select("path").collect()]           # one per file
        if not paths:
            df = self.spark.createDataFrame([], schema).withColumn("source_file_name", F.lit(None).cast("string"))
        else:
            reader = self.spark.read.options(**fmt.options).schema(schema)
            df = (reader.csv(paths) if fmt.kind == "csv" else reader.json(paths)).withColumn("source_file_name", relative_file(self.stage_path))
        return df.select(*[c.alias(n) for n, c in computed.items()], "source_file_name") if computed else df


def create_external_view(spark: SparkSession, name: str, stage_path: str, schema: T.StructType,
                         fmt: FileFormat = FileFormat.csv(), computed: dict[str, Column] | None = None) -> DataFrame:
    """External table: schema-on-read over files, with computed columns, registered as a view.

    Re-reading the view lists the files again (``refresh`` is implicit for path-based reads).
    """
    df = read_stage(spark, stage_path, schema, fmt, with_file=True)
    if computed:
        df = df.select(*[c.alias(n) for n, c in computed.items()], "source_file_name")
    df.createOrReplaceTempView(name)
    return spark.table(name)


def refresh_external_view(spark: SparkSession, name: str) -> None:
    """``alter external table ... refresh``: list the stage again so new files are seen."""
    spark.catalog.refreshTable(name)


def land(df: DataFrame, stage_path: str, fmt: FileFormat = FileFormat.csv(), *, sub_path: str | None = None,
         partition_by: list[str] | None = None) -> None:
    """Place rows as files into a stage (the upload side; used to build fixtures from tables)."""
    path = stage_path.rstrip("/") + ("/" + sub_path.strip("/") if sub_path else "")
    w = df.write.mode("append").options(**_TIME_OPTS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt.kind == "csv":
        w.option("header", fmt.options.get("header", "true")).option("sep", fmt.options.get("sep", ",")).csv(path)
    else:
        w.json(path)
