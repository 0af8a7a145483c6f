"""Messy CSV exports read line by line, so that one big file is many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.functions.columns import TIME_FORMATS, first_time
from tilth.operators.readings import column_label, station_of_file
from tilth.operators.scenes import parse_scene_key
from tilth.session import materialize
from tilth.sources.file_ranges import qualified, reachable, scan

# What marks the unit row, and columns of no use in scene files.
UNIT_ROW_MARK = "timestamp"
SCENE_META_COLUMNS = ("system:index", ".geo")
#: Why a line of a logger file gave no cells.
NO_HEADER, NO_TIME, BAD_TIME = "file has no unit row", "no time", "time in no known format"


def cells(line: Column) -> Column:
    """Cells of one CSV line; quoted cells may hold commas and doubled quotes."""
    raw = F.regexp_extract_all(
        F.concat(F.lit(","), F.rtrim(line)), F.lit(r',("[^"]*(?:""[^"]*)*"|[^,]*)'), F.lit(1)
    )
    return F.transform(
        raw,
        lambda c: F.when(
            c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        ).otherwise(c),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of all ``*.csv`` below ``path`` where only Spark can open the store: file, place in the file, text.

    ``at`` orders the lines of one file: the split's offset, then the running
    id inside the task. How files are packed into tasks may differ from scan
    to scan, so the lines are written once with their places and read back
    from there. Runs that job.
    """
    lines = (
        spark.read.option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct(
                F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("n")
            ).alias("at"),
            F.replace(F.col("value"), F.lit("\ufeff"), F.lit("")).alias("line"),
        )
    )
    return materialize(lines.filter(F.trim("line") != ""), "lines")


def marked_lines(spark: SparkSession, path: str, mark: str | None, **options) -> tuple[DataFrame, DataFrame]:
    """(lines, heads): all lines, and per file its first line with the mark (without one: its second line) and the line before.

    Files are read in place, in ranges of bytes; the head of a file is read no
    further than the mark. The heads' one row per file is written (runs a
    job), so the planner knows its size. A store that only Spark can open is
    read through :func:`read_lines` instead.
    """
    uri = qualified(spark, path)
    if reachable(uri):
        ending = {"mark": mark} if mark else {}
        return scan(spark, uri, "lines", **options), materialize(scan(spark, uri, "heads", **ending), "heads")
    lines = read_lines(spark, path)
    if mark:
        found = lines.filter(F.lower("line").contains(mark)).groupBy("file").agg(F.min("at").alias("at"), F.min_by("line", "at").alias("line"))
    else:
        places = lines.groupBy("file").agg(F.min("at").alias("first"))
        later = lines.join(places, "file").filter("at > first")
        found = later.groupBy("file").agg(F.min("at").alias("at"), F.min_by("line", "at").alias("line"))
    found = materialize(found, "heads")
    above = lines.join(found.select("file", F.col("at").alias("head_at")), "file").filter("at < head_at")
    above = above.groupBy("file").agg(F.max_by("line", "at").alias("before"))
    return lines, materialize(found.join(above, "file", "left"), "heads")


class StationFiles:
    """Logger bulk exports below a folder; runs the job that finds their headers.

    The depth of the header is unknown: the first line with a cell containing
    ``timestamp`` is the unit row, the line above holds the names, data
    follows; columns left of that cell are ignored. Times are tried in the
    given formats, in order (None: as ISO 8601 and what else a cast takes).
    """

    def __init__(self, spark: SparkSession, path: str, formats: Sequence[str | None] = TIME_FORMATS, **options):
        self.formats = formats
        self.lines, heads = marked_lines(spark, path, UNIT_ROW_MARK, **options)
        units = cells(F.col("line"))
        layouts = (
            heads.withColumn("units", units)
            .withColumn("names", cells(F.coalesce("before", "line")))
            .withColumn(
                "ts_col",
                F.array_position(F.transform("units", lambda u: F.lower(u).contains(UNIT_ROW_MARK)), True).cast("int")
                - 1,
            )
            .withColumn("station", station_of_file(F.col("file")))
            .withColumn(
                "labels",
                F.transform(
                    "units", lambda u, i: column_label(F.get(F.col("names"), i), u)
                ),
            )
            .select("file", "station", F.col("at").alias("unit_at"), "ts_col", "labels")
        )
        self.layouts = materialize(layouts, "layouts")

    def columns(self) -> DataFrame:
        """(file, station, col_pos, column) of the data columns, from the headers alone."""
        own = self.layouts.select("file", "station", "ts_col", F.posexplode("labels").alias("col_pos", "column"))
        return own.filter("col_pos > ts_col").drop("ts_col")

    def _data(self) -> DataFrame:
        """Lines below the unit row with their cells and time; the headers are broadcast while they are small."""
        data = self.lines.join(self.layouts, on="file").filter(F.col("at") > F.col("unit_at")).withColumn("cells", cells(F.col("line")))
        data = data.withColumn("time", F.get(F.col("cells"), F.col("ts_col")))
        return data.withColumn("ts", first_time("time", self.formats))

    def cells(self) -> DataFrame:
        """(file, station, ts, col_pos, column, raw): a row for each data cell of the lines whose time parses."""
        value = F.get(F.col("cells"), F.col("col_pos"))
        data = self._data().filter("ts is not null")
        return (
            data.select("file", "station", "ts", "ts_col", "cells", F.posexplode("labels").alias("col_pos", "column"))
            .filter(F.col("col_pos") > F.col("ts_col"))
            .select("file", "station", "ts", "col_pos", "column", F.when(value != "", value).alias("raw"))
        )

    def rejects(self) -> DataFrame:
        """(file, at, line, reason) of all lines that gave no cells: no unit row in the file, no time, or one in no known format.

        Header lines are no rejects.
        """
        reason = F.when(F.trim("time") == "", NO_TIME).when(F.col("time").isNull(), NO_TIME).otherwise(BAD_TIME)
        late = self._data().filter("ts is null").select("file", "at", "line", reason.alias("reason"))
        lost = self.lines.join(self.layouts.select("file"), "file", "left_anti").select("file", "at", "line", F.lit(NO_HEADER).alias("reason"))
        return late.unionByName(lost)


def read_station_csv(spark: SparkSession, path: str, formats: Sequence[str | None] = TIME_FORMATS) -> DataFrame:
    """The cells of all logger files below ``path``, see :class:`StationFiles`; runs jobs over the files' heads.

    A file without a unit row contributes no rows, and neither do lines whose
    time is in none of the formats; ``StationFiles.rejects`` has them.
    """
    return StationFiles(spark, path, formats).cells()


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(file, reason, n): lines lost, by file and reason."""
    return rejects.groupBy("file", "reason").agg(F.count("*").alias("n"))


def read_scene_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide scene files as ``(station, key, date, year, doy, band, op, value)`` rows.

    Each file has its own columns, one per acquisition, band and pass. Only
    its first data row counts, so no more than two lines of a file are read;
    index and geometry columns are dropped. Runs that job.
    """
    _, heads = marked_lines(spark, path, None)
    wide = heads.select(
        station_of_file(F.col("file")).alias("station"),
        F.explode(F.arrays_zip(cells(F.col("before")).alias("key"), cells(F.col("line")).alias("raw"))).alias("c"),
    )
    long = wide.select(
        "station", F.col("c.key").alias("key"), F.col("c.raw").try_cast("double").alias("value")
    ).filter(~F.col("key").isin(*SCENE_META_COLUMNS))
    return parse_scene_key(long)
