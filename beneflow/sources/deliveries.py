"""Delimited deliveries: separator sniff, repeated headers, all-text scan, broken lines kept aside.

Every file speaks for itself: its first line gives its separator and its columns. Files with the same
line share one scan; scans are united by column name. A line with more or fewer fields than its header has
no place in the columns: it fails the read, or is kept whole with the reason.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beneflow.functions import fixed
from beneflow.sources.tables import MONTH

# What a broken line leaves: the line itself, why it is broken, and its file; NULL for all others.
REJECTED_LINE, REJECTED_WHY, REJECTED_FILE = "_linha_rejeitada", "_motivo_rejeicao", "_arquivo"
REJECTED = (REJECTED_LINE, REJECTED_WHY, REJECTED_FILE)
TOO_FEW, TOO_MANY, OTHERWISE = "campos_a_menos", "campos_a_mais", "ilegivel"

# Every file is one split and every split one task, which may stop reading after the first rows.
_TASK_A_FILE = {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40)}
_FIRST_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "8"}


def header_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_path, line): the first line of every file below the paths.

    A task reads the beginning of one file and stops, so whole files are not read for their headers. The
    settings for that belong to a session of its own. Rows are widened, so that those on their way to the
    function, some megabytes, are few lines.
    """
    reading = spark.newSession()
    for key, value in (_TASK_A_FILE | _FIRST_ROWS).items():
        reading.conf.set(key, value)
    alone = all(reading.conf.get(key) == value for key, value in _TASK_A_FILE.items())
    lines = reading.read.csv(
        list(paths), schema="line string", sep="\x01", quote="", encoding=fixed.DELIVERY_ENCODING
    ).select("line", "_metadata.file_path", F.col("_metadata.file_block_start").alias("start"))
    if alone:
        lines = lines.withColumn("wide", F.repeat(F.lit(" "), 1 << 16))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for line, path, start in zip(*(batch.column(c).to_pylist() for c in ("line", "file_path", "start")), strict=True):
                if start == 0 and path not in seen:
                    seen.add(path)
                    yield pa.RecordBatch.from_pydict({"file_path": pa.array([path]), "line": pa.array([line])})
            if alone:
                return

    return lines.mapInArrow(first, "file_path string, line string")


def file_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files below the paths by their first line. Where all files have the same, only that line is fetched
    and the paths stand for the files, so the driver holds a row a header, not a row a file."""
    found = header_lines(spark, paths)
    groups = found.groupBy("line").agg(F.min("file_path").alias("one")).collect()
    if len(groups) == 1:
        return {groups[0].line: list(paths)}
    by_line: dict[str, list[str]] = {}
    for row in found.collect() if groups else ():
        by_line.setdefault(row.line, []).append(unquote(row.file_path))
    return {line: sorted(files) for line, files in by_line.items()}


def sniff_separator(header: str) -> str:
    """First known separator found more than twice in the header, outside quoted names."""
    plain = re.sub(r'"[^"]*"', "", header)
    for separator in fixed.SEPARATORS:
        if plain.count(separator) > 2:
            return separator
    return fixed.DEFAULT_SEPARATOR


def distinct_names(names: Sequence[str], known: Sequence[str] = ()) -> list[str]:
    """Give every repeated header its column position as a suffix, as Spark's CSV reader does.

    Where ``known`` has as many names of a repeated header with positions, those are given in their
    order: another column order does not change what the columns are called.
    """
    lowered = [name.lower() for name in names]
    out = []
    for position, name in enumerate(names):
        if lowered.count(name.lower()) > 1:
            told = [k for k in known if re.fullmatch(re.escape(name) + r"\d+", k, re.IGNORECASE)]
            if len(told) == lowered.count(name.lower()):
                out.append(told[lowered[:position].count(name.lower())])
            else:
                out.append(f"{name}{position}")
        else:
            out.append(name)
    return out


def columns_of(header: str, known: Sequence[str] = ()) -> tuple[str, tuple[str, ...]]:
    """Separator and column names of a header line; a quoted name may hold separators."""
    separator = sniff_separator(header)
    return separator, tuple(distinct_names(next(csv.reader([header], delimiter=separator)), known))


def why_rejected(line: Column, separator: str, fields: int) -> Column:
    """Too few or too many fields, quoted ones counted as one; else the line cannot be read for another reason."""
    plain = F.regexp_replace(line, '"[^"]*"', "")
    found = F.char_length(plain) - F.char_length(F.replace(plain, F.lit(separator), F.lit(""))) + 1
    return F.when(found < fields, TOO_FEW).when(found > fields, TOO_MANY).otherwise(F.lit(OTHERWISE))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _scan(
    spark: SparkSession, paths: Sequence[str], separator: str, names: Sequence[str], base: str | None, rejected: bool
) -> DataFrame:
    # All fields of a line have to be counted, whichever columns are asked for.
    reader = spark.read.options(header=True, sep=separator, encoding=fixed.DELIVERY_ENCODING, columnPruning=False)
    own = [*names, REJECTED_LINE] if rejected else [*names]
    if rejected:
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED_LINE)
    else:
        reader = reader.option("mode", "FAILFAST")
    if base is not None:
        reader = reader.option("basePath", base)
        own.append(MONTH)
    df = reader.schema(", ".join(f"{_quoted(name)} string" for name in own)).csv(list(paths))
    if not rejected:
        return df
    line = F.col(REJECTED_LINE)
    return df.select(
        *[F.when(line.isNull(), F.col(_quoted(name))).alias(name) for name in names],
        line, F.when(line.isNotNull(), why_rejected(line, separator, len(names))).alias(REJECTED_WHY),
        F.when(line.isNotNull(), F.col("_metadata.file_name")).alias(REJECTED_FILE),
        *([] if base is None else [MONTH]),
    )


def _read(
    spark: SparkSession, paths: Sequence[str], known: Sequence[str], base: str | None, rejected: bool
) -> DataFrame:
    by_columns: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for header, files in sorted(file_headers(spark, paths).items()):
        by_columns.setdefault(columns_of(header, known), []).extend(files)
    if not by_columns:
        raise ValueError(f"no header line in {', '.join(paths)}")
    for (_, names), files in by_columns.items():
        if known and (missing := [name for name in known if name not in names]):
            raise ValueError(f"{files[0]} and {len(files) - 1} more: no column {', '.join(missing)}")
    scans = [_scan(spark, files, *columns, base, rejected) for columns, files in by_columns.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def read_delivery(spark: SparkSession, path: str, known: Sequence[str] = (), rejected: bool = False) -> DataFrame:
    """A delivery as text columns. Lines are single records, so large files split freely.

    A column some files lack reads as NULL; a file without one of the ``known`` columns is refused. A line
    with too many or too few fields fails the job; with ``rejected`` it is a row that has only the columns
    ``REJECTED``.
    """
    return _read(spark, [path], known, None, rejected)


def read_monthly_deliveries(
    spark: SparkSession, base: str, months: Sequence[str], known: Sequence[str] = (), rejected: bool = False
) -> DataFrame:
    """Deliveries kept as ``base/_ano_mes=YYYYMM/`` as text columns plus the month."""
    return _read(spark, [f"{base}/{MONTH}={month}" for month in months], known, base, rejected)


def read_delivery_files(
    spark: SparkSession, base: str, files: Sequence[str], known: Sequence[str] = (), rejected: bool = False
) -> DataFrame:
    """Some files of ``base/_ano_mes=YYYYMM/`` as text columns plus the month; no other file is read."""
    return _read(spark, files, known, base, rejected)


def write_delivery(
    df: DataFrame, path: str, header: Sequence[str], separator: str = ";", mode: str = "error"
) -> None:
    """Write text columns as a delivery; ``header`` may repeat names, which the CSV writer refuses.

    Each task writes one file and puts the header before its first row. Fields are written as
    they are, so they must not hold the separator or a line break.
    """
    line = F.concat_ws(separator, *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns])
    first_of_file = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = F.when(
        first_of_file, F.array(F.lit(separator.join(header)), line)
    ).otherwise(F.array(line))
    (
        df.select(F.explode(lines).alias("line"))
        .write.mode(mode)
        # A task's second file would have no header.
        .option("maxRecordsPerFile", 0)
        .option("encoding", fixed.DELIVERY_ENCODING)
        .option("sep", "\x01")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
