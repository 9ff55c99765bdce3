"""CSV sources.

* ``read_extract``: a bank extract -- ``;``-separated, header row, an
  unnamed index column first, a legacy code page (cp866), upper-case
  headers, blanks in text columns kept as ''.  Read as text, then typed
  by the declared schema (inference would turn account numbers into
  decimals and ``dd.MM.yyyy`` dates into strings).
* ``read_declared``: columns by header name, strict types; ``read_tab``: the
  same for tab-separated files; ``read_inferred``: types guessed from the data.
* ``read_sorted_out``: one pass over an extract or declared CSV that gives the
  good rows and, beside them, the refused lines with what is wrong with them.
* ``scan_delta_folders``: every numbered delta folder, one scan per distinct
  header; the batch number comes from each row's file path (``_metadata``).
  Bare CR, CRLF and LF line ends all read with the default line reader --
  never set ``lineSep``.

Damaged input is refused: a bad value or a differing header raises.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# Fixed values of the extract format.
EXTRACT_SEP = ";"
EXTRACT_ENCODING = "cp866"
DELTA_DIR_PATTERN = r"/(?:delta_id=)?([0-9]+)/[^/]+$"


def enable_legacy_charsets(spark: SparkSession) -> None:
    """cp866 and other non-standard charsets are refused unless this is on."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def apply_schema(df: DataFrame, schema: T.StructType, date_format: str | None = None,
                 keep_blank_text: bool = True) -> DataFrame:
    """Type text columns by name; blank -> NULL for non-text, '' kept for text."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            cols.append((F.coalesce(c, F.lit("")) if keep_blank_text else c).alias(f.name))
            continue
        c = F.when(F.trim(c) == "", None).otherwise(F.trim(c))
        if isinstance(f.dataType, T.DateType) and date_format:
            cols.append(F.to_date(c, date_format).alias(f.name))
        else:
            cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_extract(spark: SparkSession, path: str, schema: T.StructType, date_format: str | None = None,
                 encoding: str = EXTRACT_ENCODING, sep: str = EXTRACT_SEP, index_col: bool = True) -> DataFrame:
    if encoding.lower().replace("-", "") not in ("utf8", "usascii", "iso88591", "utf16", "utf32"):
        enable_legacy_charsets(spark)
    raw = spark.read.options(header=True, sep=sep, encoding=encoding, inferSchema=False, enforceSchema=False,
                             mode="FAILFAST").csv(path)
    raw = raw.toDF(*[c.lower() for c in raw.columns])
    if index_col:
        raw = raw.select(*raw.columns[1:])
    return apply_schema(raw, schema, date_format)


def read_declared(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                  date_format: str | None = None) -> DataFrame:
    """Columns by header name, in any order and case; typed by ``schema``.

    A missing column, part files whose headers differ and a value that does not
    have its column's type are errors, never NULLs in the result.
    """
    raw = spark.read.options(header=True, sep=sep, inferSchema=False, enforceSchema=False, mode="FAILFAST").csv(path)
    raw = raw.toDF(*[c.strip().lower() for c in raw.columns])
    missing = [f.name for f in schema.fields if f.name.lower() not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no column {missing} in header {raw.columns}")
    lower = T.StructType([T.StructField(f.name.lower(), f.dataType) for f in schema.fields])
    return apply_schema(raw, lower, date_format, keep_blank_text=False).toDF(*schema.fieldNames())


def read_inferred(spark: SparkSession, path: str, sep: str = ";", header: bool = True) -> DataFrame:
    """Types guessed from the data (a second pass over the file)."""
    return spark.read.options(header=header, sep=sep, inferSchema=True).csv(path)


def read_tab(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Tab-separated: by header name and strictly with a schema, else with guessed types."""
    if schema is not None:
        return read_declared(spark, path, schema, sep="\t")
    return read_inferred(spark, path, sep="\t")


class SortedOut(NamedTuple):
    good: DataFrame      # typed by the schema
    refused: DataFrame   # reason (the column that failed, or 'line'), file, line (the cells, joined)
    n_good: int
    n_refused: int
    path: str            # the staged rows; to be deleted by jobs that are done with them


class TooManyRefused(ValueError):
    pass


def read_sorted_out(spark: SparkSession, path: str | list[str], schema: T.StructType, date_format: str | None = None,
                    sep: str = ";", encoding: str = "utf-8", index_col: bool = False, at_most: int | None = None,
                    keep_blank_text: bool = False) -> SortedOut:
    """Good rows and refused lines of a CSV, in one pass over it.

    Cells are read as text, by header name in any order and case.  A line with
    too few or too many cells, or with a non-blank cell that is no value of its
    column's type, is refused; so is, for dates with ``date_format``, a date
    written otherwise.  Both sides are staged by one write, on which they are
    counted; more than ``at_most`` refused lines raise ``TooManyRefused`` and
    nothing is kept.  A header that lacks a column of ``schema`` is an error, and
    so are part files whose headers differ.
    """
    if encoding.lower().replace("-", "") not in ("utf8", "usascii", "iso88591", "utf16", "utf32"):
        enable_legacy_charsets(spark)
    options = {"header": True, "sep": sep, "encoding": encoding, "enforceSchema": False}
    header = spark.read.options(**options).csv(path).columns  # one line is read
    names = [c.strip().lower() for c in header]
    missing = [f.name for f in schema.fields if f.name.lower() not in names]
    if missing:
        raise ValueError(f"{path}: no column {missing} in header {header}")
    cells = [f"`{c}`" for c in header]
    # the header's own names: a part file with another header fails the read
    layout = T.StructType([T.StructField(c, T.StringType()) for c in [*header, "_damaged"]])
    raw = (spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord="_damaged").schema(layout).csv(path))
    at = {n: cells[i] for i, n in enumerate(names) if not (index_col and i == 0)}
    typed, wrong = [], [F.when(F.col("_damaged").isNotNull(), F.lit("line"))]
    for f in schema.fields:
        text = F.col(at[f.name.lower()])
        if isinstance(f.dataType, T.StringType):
            typed.append((F.coalesce(text, F.lit("")) if keep_blank_text else text).alias(f.name))
            continue
        filled = F.when(F.trim(text) != "", F.trim(text))
        if isinstance(f.dataType, T.DateType) and date_format:
            value = F.try_to_timestamp(filled, F.lit(date_format)).cast("date")
        else:
            value = filled.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        wrong.append(F.when(filled.isNotNull() & value.isNull(), F.lit(f.name)))
    line = F.coalesce(F.col("_damaged"), F.concat_ws(sep, *[F.coalesce(F.col(c), F.lit("")) for c in cells]))
    reason = F.coalesce(*wrong)
    rows = raw.select(*typed, reason.alias("_reason"),
                      F.when(reason.isNotNull(), F.regexp_extract(F.col("_metadata.file_path"), r"[^/]+$", 0)).alias("_file"),
                      F.when(reason.isNotNull(), line).alias("_line"))
    staged = scratch_path(spark, "sorted-out")
    obs = Observation("sorted-out")
    rows.observe(obs, F.count(F.lit(1)).alias("rows"), F.count("_reason").alias("refused")).write.parquet(staged)
    n, refused = int(obs.get["rows"]), int(obs.get["refused"])
    if at_most is not None and refused > at_most:
        p, fs = _hadoop(spark, staged)
        fs.delete(p, True)
        raise TooManyRefused(f"{path}: {refused} of {n} lines refused, more than {at_most}")
    kept = spark.read.schema(rows.schema).parquet(staged)
    return SortedOut(kept.filter("_reason IS NULL").select(*schema.fieldNames()),
                     kept.filter("_reason IS NOT NULL").select(F.col("_reason").alias("reason"), F.col("_file").alias("file"),
                                                               F.col("_line").alias("line")),
                     n - refused, refused, staged)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delta_folders(spark: SparkSession, root: str, after: int | None = None) -> list[tuple[int, str]]:
    """(batch number, path) of the numbered folders under ``root`` (``N`` or
    ``delta_id=N``), ascending, newer than ``after``.  A listing of folder
    names -- metadata, one entry per batch -- not a read of the data."""
    p, fs = _hadoop(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        if not st.isDirectory():
            continue
        name = st.getPath().getName()
        num = name.split("=", 1)[1] if name.startswith("delta_id=") else name
        if num.isdigit() and (after is None or int(num) > after):
            out.append((int(num), st.getPath().toString()))
    return sorted(out)


def csv_header(spark: SparkSession, folder: str, sep: str = ";") -> tuple[str, ...] | None:
    """Lower-case column names of the first CSV file of a folder that has any: one line is read."""
    p, fs = _hadoop(spark, folder)
    jvm = spark.sparkContext._jvm
    for st in sorted(fs.listStatus(p), key=lambda x: x.getPath().getName()):
        if not st.getPath().getName().endswith(".csv") or st.getLen() == 0:
            continue
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(st.getPath()), "UTF-8"))
        try:
            line = lines.readLine()
        finally:
            lines.close()
        if line and line.strip():
            return tuple(c.strip().strip('"').lower() for c in line.lstrip("\ufeff").split(sep))
    return None


def delta_schema(spark: SparkSession, root: str, declared: T.StructType, sep: str = ";") -> T.StructType:
    """All columns of the first delta, in its order: declared types where known, text otherwise."""
    types = {f.name.lower(): f.dataType for f in declared.fields}
    for _, folder in delta_folders(spark, root):
        names = csv_header(spark, folder, sep)
        if names:
            return T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    return declared


def scan_delta_folders(spark: SparkSession, root: str, schema: T.StructType, sep: str = ";",
                       date_format: str | None = None, id_col: str = "delta_id",
                       after: int | None = None) -> DataFrame:
    """All ``root/<number>/*.csv`` (or ``root/delta_id=<number>/...``) newer than ``after``.

    Columns go by header name: folders with the same header are one scan, and a
    file whose header differs from its folder's is an error.  Columns of
    ``schema`` that a delta does not have are NULL there; a column it has beyond
    ``schema`` and a value of the wrong type are errors.
    """
    names = schema.fieldNames()
    by_header: dict[tuple, list[str]] = {}
    for _, folder in delta_folders(spark, root, after):
        header = csv_header(spark, folder, sep)
        if header:
            by_header.setdefault(header, []).append(folder)
    out = None
    for header, folders in by_header.items():
        more = [c for c in header if c not in [n.lower() for n in names]]
        if more:
            raise ValueError(f"{folders[0]}: column(s) {more} are not in {names}")
        raw = (spark.read.options(header=True, sep=sep, inferSchema=False, enforceSchema=False, mode="FAILFAST",
                                  pathGlobFilter="*.csv").csv(folders))
        number = F.regexp_extract(F.col("_metadata.file_path"), DELTA_DIR_PATTERN, 1).cast("int").alias(id_col)
        raw = raw.select(number, *[F.col(f"`{c}`").alias(header[i]) for i, c in enumerate(raw.columns)])
        typed = [f for f in schema.fields if f.name.lower() in header]
        lower = T.StructType([T.StructField(id_col, T.IntegerType())]
                             + [T.StructField(f.name.lower(), f.dataType) for f in typed])
        df = apply_schema(raw.withColumn(id_col, F.col(id_col).cast("string")), lower, date_format,
                          keep_blank_text=False).toDF(id_col, *[f.name for f in typed])
        for f in schema.fields:
            if f.name.lower() not in header:
                df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        df = df.select(id_col, *names)
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField(id_col, T.IntegerType())] + list(schema.fields)))
    return out
