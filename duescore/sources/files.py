"""Portfolio files: choice of the newest file, scans with a schema, control records.

Every file is read with a declared schema (all strings for the text files) so
no inference job runs and types never depend on the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


# -- S1, S2: which file, which date ------------------------------------------

def stamp_of(name: Column | str, stamp_regex: str) -> Column:
    """The numeric stamp captured by group 1 of ``stamp_regex``; null when absent."""
    n = F.col(name) if isinstance(name, str) else name
    return F.nullif(F.regexp_extract(n, stamp_regex, 1), F.lit("")).try_cast("bigint")


def latest_snapshot(df: DataFrame, name: str, stamp_regex: str, pattern: str | None = None) -> DataFrame:
    """Rows of the newest file: the largest stamp among names holding ``pattern``.

    The maximum is a scalar subquery (one partial aggregate over the name
    column, one value broadcast back), so nothing is collected and a left-over
    folder without a stamp can never win (Q25).
    """
    rows = df.filter(F.col(name).contains(pattern)) if pattern else df
    newest = rows.select(F.max(stamp_of(name, stamp_regex))).scalar()
    return rows.filter(stamp_of(name, stamp_regex) == newest)


def newest_file(spark: SparkSession, folder: str, pattern: str, stamp_regex: str) -> str | None:
    """Path of the newest file in ``folder`` by the stamp in its name (S1), from the listing only.

    Reads file names through the Hadoop file system of the session (no data is
    read); names without ``pattern`` or without a stamp never win (Q25).
    """
    import re

    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    best, best_stamp = None, None
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        m = re.search(stamp_regex, name)
        if pattern in name and m and (best_stamp is None or int(m.group(1)) > best_stamp):
            best, best_stamp = st.getPath().toString(), int(m.group(1))
    return best


def file_date(name: Column | str, regex: str, fmt: str) -> Column:
    """Date carried in a file name, group 1 of ``regex`` parsed with ``fmt``."""
    n = F.col(name) if isinstance(name, str) else name
    return F.try_to_date(F.regexp_extract(n, regex, 1), fmt)


def day_of_name(name: str, regex: str, fmt: str) -> str:
    """The ISO day carried in one file's name, group 1 of ``regex`` parsed with the
    ``strptime`` format ``fmt`` (S2)."""
    import datetime
    import re

    m = re.search(regex, name)
    if not m:
        raise ValueError(f"no date in the file name {name}")
    return datetime.datetime.strptime(m.group(1), fmt).date().isoformat()


def with_file_name(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Add the source file name from the hidden ``_metadata`` column of a file scan."""
    return df.select("*", F.col("_metadata.file_name").alias(name))


# -- S3, S4: scans ------------------------------------------------------------

def scan_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited text with a header, every column as string (S3).

    Columns go by the names in the file's header: ``columns`` must be there, in
    any order, and come first; further columns are kept after them.  Only the
    header line is read here.  Spark checks the header of every file under
    ``path`` against these names, so a file with another order fails loudly.
    """
    names = spark.read.option("header", True).option("sep", sep).csv(path).columns
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"columns missing in the header of {path}: {missing}")
    df = spark.read.schema(string_schema(names)).option("header", True).option("sep", sep) \
        .option("enforceSchema", False).csv(path)
    return df.select(*[F.col(f"`{c}`") for c in (*columns, *[n for n in names if n not in columns])])


def scan_fixed_schema(spark: SparkSession, path: str, fields: Sequence[str], sep: str = ";") -> DataFrame:
    """Headerless delimited text with a fixed field list."""
    return spark.read.schema(string_schema(fields)).option("header", False).option("sep", sep).csv(path)


def parse_lines(lines: DataFrame, fields: Sequence[str], sep: str = ";", column: str = "value") -> DataFrame:
    """Parse a text column with the fixed field list; the same reader as S4 on rows already loaded."""
    schema = ", ".join(f"`{f}` STRING" for f in fields)
    parsed = lines.select(F.from_csv(F.col(column), schema, {"sep": sep}).alias("__r"))
    return parsed.select(*[F.col(f"__r.`{f}`").alias(f) for f in fields])


def json_scan(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Nested JSON with a declared schema."""
    return spark.read.schema(schema).json(path)


def parse_json_column(df: DataFrame, column: str, schema: str, alias: str = "json") -> DataFrame:
    """JSON text column to a struct with a declared schema (S9 on loaded rows)."""
    return df.withColumn(alias, F.from_json(F.col(column), schema))


# -- lines that do not fit (S3, S4) --------------------------------------------

LINE = "_line"


class TooManyBadLines(RuntimeError):
    """More lines of a file do not fit its fields than a run may leave out."""


def scan_checked(spark: SparkSession, path: str, fields: Sequence[str], sep: str = ";", header: bool = False) -> DataFrame:
    """Delimited text with every column as string and ``_line``: null where a line fits the
    fields, else the line itself (too short, too long or badly quoted).

    With a header its names must be ``fields`` in any order, further ones allowed.  All
    columns are parsed whatever is selected, as a short line only shows then.
    """
    names = list(fields)
    if header:
        names = spark.read.option("header", True).option("sep", sep).csv(path).columns
        missing = [c for c in fields if c not in names]
        if missing:
            raise ValueError(f"columns missing in the header of {path}: {missing}")
    schema = string_schema([*names, LINE])
    return spark.read.schema(schema).option("header", header).option("sep", sep).option("enforceSchema", not header) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).option("columnPruning", False) \
        .csv(path).select(*[F.col(f"`{c}`") for c in (*fields, *[n for n in names if n not in fields])], LINE)


FITS = "_fits"


def split_lines(scanned: DataFrame, path: str, most_share: float = 0.01, type_column: str | None = None,
                control_types: Sequence[str] = ("0", "9")) -> DataFrame:
    """The lines that fit, from a stage table at ``path``; its part ``_fits=false`` keeps the
    others with their line and file, and a share of them above ``most_share`` fails the run.

    Control records are shorter than detail records: with ``type_column`` lines of
    ``control_types`` pass as they are.  One pass over the file parses, counts and writes.
    """
    fits = F.col(LINE).isNull()
    if type_column is not None:
        fits = fits | F.coalesce(F.trim(F.col(type_column)).isin(list(control_types)), F.lit(False))
    marked = scanned.select("*", F.col("_metadata.file_name").alias("_file"), fits.alias(FITS))
    counts = Observation()
    seen = marked.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if(~F.col(FITS)).alias("bad"))
    seen.write.mode("overwrite").partitionBy(FITS).parquet(path)
    lines, left_out = counts.get["lines"], counts.get["bad"]
    if left_out > most_share * lines:
        raise TooManyBadLines(f"{left_out} of {lines} lines do not fit; they are in {path}/{FITS}=false")
    return _stage(scanned, path).filter(FITS).drop(LINE, "_file", FITS)


def left_out(scanned: DataFrame, path: str) -> DataFrame:
    """The lines that ``split_lines`` set aside, with what could be parsed of them."""
    return _stage(scanned, path).filter(~F.col(FITS)).drop(FITS)


def _stage(scanned: DataFrame, path: str) -> DataFrame:
    schema = T.StructType([*scanned.schema.fields, T.StructField("_file", T.StringType()), T.StructField(FITS, T.BooleanType())])
    return scanned.sparkSession.read.schema(schema).parquet(path)


# -- S5: header and trailer records -------------------------------------------

def header_date(df: DataFrame, type_column: str = "Tipo_Registro", date_column: str = "Tipo_Pessoa",
                header_type: str = "0", date_format: str = "yyyy-MM-dd") -> DataFrame:
    """The trimmed date field of the header records, as one row."""
    return df.filter(F.trim(F.col(type_column)) == F.lit(header_type)) \
        .select(F.max(F.try_to_date(F.trim(F.col(date_column)), date_format)).alias("file_date"))


def strip_control_records(df: DataFrame, type_column: str = "Tipo_Registro", person_column: str = "Tipo_Pessoa",
                          person_type: str = "J", header_type: str = "0", trailer_type: str = "9",
                          date_name: str = "Data_Arquivo", date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Detail records of one person type, with the file date from the header record.

    The header's date is read by a scalar subquery over the header records
    (a ``max`` over the trimmed field), not from whichever line comes first,
    and record types are compared after trimming, so type ``10`` is kept.
    """
    rtype = F.trim(F.col(type_column))
    day = header_date(df, type_column, person_column, header_type, date_format).scalar()
    detail = df.filter(rtype.isNotNull() & ~rtype.isin(header_type, trailer_type)
                       & (F.col(person_column) == F.lit(person_type)))
    return detail.drop(type_column).withColumn(date_name, day)
