"""Readers for sensor files, status logs, stores and baselines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadtime.functions.headers import clean_header
from leadtime.functions.scalars import nan_to_null

HEADER_MARK = "Date and time"
HEADER_LINE = 10
#: Bytes of a file's head that are read at a time, and at most.
HEAD_BYTES, MOST_HEAD_BYTES = 16 << 10, 4 << 20

STATUS_SCHEMA = T.StructType([
    T.StructField("Timestamp start", T.StringType()),
    T.StructField("Timestamp end", T.StringType()),
    T.StructField("Duration", T.StringType()),
    T.StructField("Status", T.StringType()),
    T.StructField("Code", T.IntegerType()),
    T.StructField("Message", T.StringType()),
    T.StructField("Comment", T.StringType()),
    T.StructField("Service contract category", T.StringType()),
    T.StructField("IEC category", T.StringType()),
])


def yearly_globs(root: str, years: Sequence[int | str], folder: str, name: str) -> list[str]:
    """Glob paths of one source, e.g. ``folder="SCADA_{year}_*"``, ``name="Turbine_Data_2_*.csv"``."""
    return [f"{root.rstrip('/')}/{folder.format(year=y)}/{name.format(year=y)}" for y in years]


PROBE = "file string, n_bytes long, read_bytes long, line string, marked boolean, reason string"


def _line_at(store, path: str, n_bytes: int) -> tuple[str | None, int, str | None]:
    """The 10th line of a file, the bytes read to find it, and why there is none."""
    head = b""
    with store.open_input_file(path) as file:
        while head.count(b"\n") < HEADER_LINE and len(head) < min(n_bytes, MOST_HEAD_BYTES):
            more = file.read(max(HEAD_BYTES, len(head)))  # doubles what is there
            if not more:
                break
            head += more
    lines = head.split(b"\n")
    if len(lines) < HEADER_LINE or not head:
        return None, len(head), f"fewer than {HEADER_LINE} lines"
    return lines[HEADER_LINE - 1].decode("utf-8", "replace").rstrip("\r"), len(head), None


def _probe(batches):
    import pyarrow as pa
    from pyarrow import fs

    for batch in batches:
        rows = []
        for path, n_bytes in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
            scheme, _, rest = path.partition(":")
            uri = f"{scheme}://{quote(rest.lstrip('/') if scheme != 'file' else '/' + rest.lstrip('/'))}"
            try:
                store, place = fs.FileSystem.from_uri(uri)
                line, read, reason = _line_at(store, place, n_bytes)
            except OSError as error:
                line, read, reason = None, 0, f"not readable: {error}"
            if reason is None and HEADER_MARK not in line:
                line, reason = None, f"no column line on line {HEADER_LINE}"
            rows.append((path, n_bytes, read, line, None if line is None else line.startswith("#"), reason))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string())
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["file", "n_bytes", "read_bytes", "line", "marked", "reason"])


def probe_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every file with its cleaned header, or the reason why it has none.

    (file, n_bytes, read_bytes, header, marked, accepted, reason). Tasks open a slice of the paths each and
    read the first kilobytes, more only while the 10th line is not complete. ``marked`` tells whether the
    column line starts with ``#``; it need not. Files without a byte are in no listing of Spark's.
    """
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    listed = spark.read.format("binaryFile").load(list(paths)).select("path", "length")  # the content is not read
    found = listed.repartition(parts, "path").mapInArrow(_probe, PROBE)
    return found.select("file", "n_bytes", "read_bytes", clean_header(F.col("line")).alias("header"), "marked",
                        F.col("reason").isNull().alias("accepted"), "reason")


def read_scada(spark: SparkSession, paths: Sequence[str], *, wanted: Sequence[str] | None = None,
               entity_from: str | None = None, probe: DataFrame | None = None) -> DataFrame:
    """Sensor CSV files with a ``#`` preamble, unioned by column name.

    Files are grouped by header (firmware generations, a handful), so the plan has one scan per
    header and no inference pass. ``entity_from`` is a pattern whose first group is the entity id
    in the file path. Files without a header are left out; ``probe_files`` tells which and why, and
    its result may be passed as ``probe``.
    """
    probe = probe_files(spark, paths) if probe is None else probe
    by_header: dict[tuple[str, bool], list[str]] = {}
    for row in probe.where("accepted").select("file", "header", "marked").collect():  # one short row per file, as in a file listing
        by_header.setdefault((row.header, row.marked), []).append(row.file)
    if not by_header:
        raise FileNotFoundError(f"no file with a header on line {HEADER_LINE}: {list(paths)}")
    frames = [_read_generation(spark, header.split(","), marked, files, wanted, entity_from)
              for (header, marked), files in sorted(by_header.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _read_generation(spark, names, marked, files, wanted, entity_from) -> DataFrame:
    schema = T.StructType([
        T.StructField(n, T.TimestampType() if n == "timestamp" else T.DoubleType()) for n in names])
    # a column line without # is the first line that is no comment
    df = (spark.read.schema(schema).option("comment", "#").option("nanValue", "NaN").option("header", not marked)
          .csv(files))
    keep = [n for n in names if wanted is None or n in wanted]
    columns = [nan_to_null(n).alias(n) if n != "timestamp" else F.col(n) for n in keep]
    if entity_from:
        columns.insert(0, F.regexp_extract(F.col("_metadata.file_path"), entity_from, 1)
                       .try_cast("int").alias("entity_id"))
    return df.select(*columns)


def read_status(spark: SparkSession, paths: Sequence[str] | str,
                schema: T.StructType = STATUS_SCHEMA) -> DataFrame:
    """Status log CSV: header line, ``#`` comment lines, times kept as text."""
    return spark.read.option("header", True).option("comment", "#").schema(schema).csv(
        paths if isinstance(paths, str) else list(paths))


def read_status_events(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Status log with parsed times; an open end (``-``) is NULL."""
    df = read_status(spark, paths)
    return df.withColumns({
        "Timestamp start": F.try_to_timestamp("Timestamp start"),
        "Timestamp end": F.try_to_timestamp("Timestamp end"),
    }).withColumnsRenamed({"Timestamp start": "timestamp_start", "Timestamp end": "timestamp_end"})


def read_telemetry(spark: SparkSession, path: str, time: str = "ts") -> DataFrame:
    """Parquet scan with the time column as TIMESTAMP and NaN as NULL; order is left to the operators that need it."""
    df = spark.read.parquet(path)
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c == time else nan_to_null(c).alias(c) if kind in ("double", "float") else F.col(c)
                       for c, kind in df.dtypes])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str,
                  fmt: str = "parquet", **options) -> DataFrame:
    """A store that may not exist yet: a missing path is an empty frame, any other error is raised."""
    try:
        return spark.read.format(fmt).schema(schema).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """Baseline documents (one JSON object per entity) as rows (entity, sensor, mean, p90)."""
    docs = spark.read.schema(
        "entity_id int, baseline_months int, computed_on string, n_rows bigint, "
        "mean map<string,double>, p90 map<string,double>").json(path)
    return docs.select("entity_id", F.explode("mean").alias("sensor", "mean"), "p90").select(
        "entity_id", "sensor", "mean", F.try_element_at("p90", F.col("sensor")).alias("p90"))
