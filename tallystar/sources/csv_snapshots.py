"""CSV snapshots: header, CRLF, minimal quoting, doubled quotes, NULL as empty.

A line feed inside a value is written as CRLF too and read back as a line feed.  As values may hold line breaks, a
file is read by one task; files hold ``FILE_ROWS`` rows at most, so that large snapshots are read by many.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallystar.sources import files
from tallystar.sources.tables import EVENT_DATE, AppendTable

FILE_ROWS = 1_000_000

# The snapshot dialect.
DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}


def csv_export(
    tables: dict[str, DataFrame], directory: str, one_file: Collection[str] = ()
) -> list[str]:
    """Write ``<directory>/<table>.csv`` per table; empty tables are skipped.

    Each snapshot is a directory of part files, every one with the header: as many
    as the table has partitions, or one for the tables named in ``one_file``.
    """
    written = []
    for name, rows in tables.items():
        if rows.isEmpty():
            continue
        if name in one_file:
            rows = rows.repartition(1)
        path = f"{directory.rstrip('/')}/{name.split('.')[-1]}.csv"
        rows.write.mode("overwrite").options(lineSep="\r\n", maxRecordsPerFile=FILE_ROWS, **DIALECT).csv(path)
        written.append(path)
    return written


def csv_export_days(table: AppendTable, directory: str) -> int:
    """Bring the snapshot ``<directory>/<table>.csv`` of a table with days up to date: only days that runs have
    changed since the last call are written; returns how many.

    The number of the last run stands beside the rows, so that no run is left out, whichever of them export.
    """
    spark, path = table.spark, f"{directory.rstrip('/')}/{table.name}.csv"
    marks = sorted(n for n in files.children(spark, path) if n.startswith("_exported~"))
    days, last = table.changed_days(int(marks[-1].partition("~")[2]) if marks else 0)
    if not days:
        return 0
    rows = table.read(prunable=True, days=days).select(*table.schema.names, EVENT_DATE)
    # Each day's directory is replaced as a whole.
    options = {"partitionOverwriteMode": "dynamic", "lineSep": "\r\n", "maxRecordsPerFile": FILE_ROWS, **DIALECT}
    rows.write.mode("overwrite").options(**options).partitionBy(EVENT_DATE).csv(path)
    mark = f"_exported~{last:012d}"
    if mark not in marks:
        files.create(spark, f"{path}/{mark}")
    for old in marks:
        if old != mark:
            files.remove(spark, f"{path}/{old}")
    return len(days)


def csv_scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a snapshot back, by days or not; the given schema replaces inference."""
    # multiLine keeps quoted line breaks and accepts both line ends.
    return spark.read.schema(schema).options(multiLine=True, recursiveFileLookup=True, **DIALECT).csv(path)
