"""Raw files, JSON tables and writers."""

import json

import pytest
from pyspark.sql import functions as F

from tilth.operators import readings as ops
from tilth.operators import scenes
from tilth.plans.pipeline import run_to_phenology, wide_readings
from tilth.schemas import READINGS, SCENES
from tilth.sources import sinks, tables
from tilth.sources import csv_lines, file_ranges
from tilth.sources.csv_lines import StationFiles, cells, read_scene_csv, read_station_csv, reject_counts

LOGGER = """﻿Bulk export,for station
made,2020-01-01 00:00:00

Time,Air Temp.Air temperature,Soil.Soil water content 0 to 5 cm,Probe.Soil temperature 5 cm depth,Probe.Soil temperature 0 to 5 cm,Rain.Precipitation totals,Power.Battery
Timestamp (UTC),Value (Â°C),"Value (m3/m3, raw)",Value (°C),Value (Ã‚Â°C),Value (mm),
2020-06-01 00:00:00,10.0,0.20,5.0,7.0,0.0,12
2020-06-01 06:00:00,bad,0.22,,9.0,1.5,12
not a time,1,1,1,1,1,1

2020-06-01 12:00:00,20.0,,6.0,8.0,,12
2020-06-03 12:00:00,30.0,0.30,10.0,,,12
"""


@pytest.fixture
def loggers(tmp_path):
    folder = tmp_path / "loggers"
    folder.mkdir()
    (folder / "LOGGER_MB1_2015_to_2024.csv").write_text(LOGGER)
    (folder / "LOGGER_SK2.csv").write_text("Timestamp (UTC),Air temperature\n2020-06-01 00:00:00,4\n")
    (folder / "LOGGER_MB9.csv").write_text("no header here\n2020-06-01 00:00:00,4\n")
    (folder / "LOGGER_MB8.csv").write_text("")
    (folder / "notes_MB7.txt").write_text(LOGGER)
    return str(folder)


def test_station_files(spark, loggers):
    rows = read_station_csv(spark, loggers).collect()
    assert {r.station for r in rows} == {"MB1", "SK2"}
    one = [r for r in rows if r.station == "MB1"]
    assert len(one) == 4 * 6  # the unparsable time is gone, no cell is
    labels = {r.col_pos: r.column for r in one}
    assert labels == {
        1: "Air temperature (°C)",
        2: "Soil water content 0 to 5 cm (m3/m3, raw)",
        3: "Soil temperature 5 cm depth (°C)",
        4: "Soil temperature 0 to 5 cm (°C)",
        5: "Precipitation totals (mm)",
        6: "Battery",
    }
    gaps = [r for r in one if r.raw is None]
    assert len(gaps) == 5


def test_wide_readings_average_sensors_and_keep_all_instants(spark, loggers):
    out = {(r.station, str(r.date)): r for r in wide_readings(read_station_csv(spark, loggers)).collect()}
    assert len(out) == 5
    first, second = out["MB1", "2020-06-01 00:00:00"], out["MB1", "2020-06-01 06:00:00"]
    assert (first.airt, first.ssm, first.sst, first.prcp) == (10.0, 0.2, 6.0, 0.0)
    assert (second.airt, second.ssm, second.sst, second.prcp) == (None, 0.22, 9.0, 1.5)


def test_csv_cells(spark):
    lines = ['a,"b,c",d', ',"say ""x""",', "", "one"]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = [r.c for r in frame.select("i", cells(F.col("line")).alias("c")).orderBy("i").collect()]
    assert got == [["a", "b,c", "d"], ["", 'say "x"', ""], [""], ["one"]]


SCENE = (
    'system:index,from20200601T001505_VV_asc,from20200601T001505_VH_asc,from20200601T001505_angle_asc,'
    'from20200601T001505_landcover_asc,from20200601T001505_doy_asc,from20200603T121500_VV_desc,from20200603T121500_VH_desc,'
    'from20200603T121500_angle_desc,from20200603T121500_landcover_desc,.geo\n'
    '0,-10,-16,38,110,153,-11,-17,39,110,"{""type"":""Point"",""coordinates"":[1,2]}"\n'
    '1,-99,-99,1,1,1,-99,-99,1,1,"{}"\n'
)


def test_scene_files_use_the_first_row_only(spark, tmp_path):
    folder = tmp_path / "scenes"
    folder.mkdir()
    (folder / "S1_Backscatter_LOGGER_MB1_2015.csv").write_text(SCENE)
    (folder / "S1_Backscatter_LOGGER_SK2_2015.csv").write_text("system:index,from20210101T000000_VV_asc,.geo\n0,-7.5,x\n")
    long = read_scene_csv(spark, str(folder))
    assert long.count() == 9 + 1
    kept = scenes.pivot_bands_mean(scenes.drop_meta_bands(long), ["VV", "VH", "angle", "landcover"])
    rows = {(r.station, r.op): r for r in scenes.cast_crop(kept).collect()}
    assert (rows["MB1", 0].vv, rows["MB1", 0].lc, rows["MB1", 0].doy) == (-10.0, "110", 153)
    assert (rows["MB1", 1].vh, str(rows["MB1", 1].date)) == (-17.0, "2020-06-03 12:15:00")
    assert rows["SK2", 0].vv == -7.5


def test_scene_dates_are_checked(spark):
    with pytest.raises(ValueError):
        scenes.date_range_filter(spark.range(1), "2020-01-02", "2020-01-01")


def test_raw_files_to_phenology(spark, loggers, tmp_path):
    folder = tmp_path / "scenes"
    folder.mkdir()
    (folder / "S1_Backscatter_LOGGER_MB1_2015.csv").write_text(SCENE)
    texture = spark.createDataFrame([("MB1", 5, 1.3, 0.4, 0.3, 0.3, "Loam")], "station string, depth_cm int, bulk double, sand double, silt double, clay double, classification string")
    crops = {
        "base": spark.createDataFrame([("110", 5.0)], "lc string, base double"),
        "stages": spark.createDataFrame([("110", 1.0, 10.0), ("110", 100.0, 89.0)], "lc string, gdd double, stage double"),
    }
    out = {r.op: r for r in run_to_phenology(spark, loggers, str(folder), texture, crops).collect()}
    assert len(out) == 2
    # 00:15 meets the reading of 00:00, whose day runs from 10 to 20 degrees
    assert (out[0].ssm, out[0].airt, out[0].mean_airt, out[0].mean_sst) == (0.2, 10.0, 15.0, 7.5)
    assert (out[0].cum_gdd_air, out[0].cum_gdd_soil, out[0].cum_gdd) == (10.0, 2.5, 6.25)
    assert out[1].mean_airt == 30.0 and out[1].cum_gdd_air == 35.0
    assert out[1].cum_ssm == pytest.approx(0.5) and out[1].sand == 0.4


def test_json_tables(spark, tmp_path):
    def put(name, value):
        (tmp_path / name).write_text(json.dumps(value, indent=1))
        return str(tmp_path / name)

    layer = {"depth_cm": 5, "density_gcm3": 1.3, "sand_pct": 50.0, "silt_pct": 20.0, "clay_pct": 30.0, "classification": "Loam"}
    path = put("t.json", {"MB1": [layer, {**layer, "depth_cm": 20}], "SK1": [layer]})
    rows = {r.station: r for r in tables.read_texture_json(spark, path).collect()}
    assert set(rows) == {"MB1", "SK1"} and rows["MB1"].sand == 0.5 and rows["MB1"].bulk == 1.3
    crop = tables.read_crop_tables(
        spark,
        put("b.json", {"110": 5, "157": 6.7}),
        put("s.json", {"110": [[10, 1], [20, 2.5]]}),
        put("h.json", {"110": {"bbch_k_b": [[10, 2, 6], [20, 3, 7]]}}),
        put("i.json", {"110": {"cbound": [1, 0.5, 0], "sbound": [0.1, 9, 0.1], "lbound": [0, 1, 2], "wbound": [0, 1, 2]}}),
    )
    assert {(r.lc, r.base) for r in crop["base"].collect()} == {("110", 5.0), ("157", 6.7)}
    assert [(r.seq, r.gdd, r.stage) for r in crop["stages"].orderBy("seq").collect()] == [(0, 10.0, 1.0), (1, 20.0, 2.5)]
    assert [(r.stage, r.k, r.b) for r in crop["heights"].orderBy("seq").collect()] == [(10.0, 2.0, 6.0), (20.0, 3.0, 7.0)]
    bounds = {r.param: (r.lo, r.seed, r.hi) for r in crop["bounds"].collect()}
    assert bounds["c"] == (0.0, 0.5, 1.0) and bounds["s"] == (0.1, 0.1, pytest.approx(0.1 + 1e-6))
    short = put("x.json", {"110": {"cbound": [1, 2]}})
    with pytest.raises(Exception, match="need \\[lo, seed, hi\\]"):
        tables.bounds_rows(tables._json_files(spark, short)).collect()


def test_new_stations_only(spark, tmp_path):
    path = f"{tmp_path}/stations"
    first = spark.createDataFrame([("a", 1), ("a", 2)], "station string, v int")
    second = spark.createDataFrame([("a", 9), ("b", 3)], "station string, v int")
    sinks.write_new_stations(first, path)
    sinks.write_new_stations(second, path)
    assert {(r.station, r.v) for r in spark.read.parquet(path).collect()} == {("a", 1), ("a", 2), ("b", 3)}


def test_half_written_station_is_written_anew(spark, tmp_path):
    path = f"{tmp_path}/stations"
    sinks.write_new_stations(spark.createDataFrame([("a", 1)], "station string, v int"), path)
    # what a lost job leaves: some rows of a station, no word that it is complete
    spark.createDataFrame([("b", 3)], "station string, v int").write.partitionBy("station").mode("append").parquet(path)
    every = spark.createDataFrame([("a", 9), ("b", 3), ("b", 4)], "station string, v int").repartition(8)
    sinks.write_new_stations(every, path)
    assert sorted((r.station, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3), ("b", 4)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_stage_tables_round_trip(spark, tmp_path, fmt):
    row = spark.createDataFrame([("MB1", 1, "110", -9.5)], "Station string, op int, lc string, VV double")
    sinks.write_stage(row, f"{tmp_path}/{fmt}", SCENES, fmt)
    back = sinks.read_stage(spark, f"{tmp_path}/{fmt}", SCENES, fmt).first()
    assert (back.station, back.lc, back.vv, back.vh) == ("MB1", "110", -9.5, None)
    with pytest.raises(FileNotFoundError):
        sinks.read_stage(spark, f"{tmp_path}/absent", SCENES, fmt)


def test_pivot_refuses_doubled_cells(spark):
    long = spark.createDataFrame([("a", "SSM", 1.0), ("a", "SSM", 2.0), ("b", "Unknown", 3.0)], "k string, category string, value double")
    assert [(r.k, r.n) for r in ops.duplicate_cells(long, ["k", "category"]).collect()] == [("a", 2)]
    with pytest.raises(Exception, match="several SSM values"):
        ops.pivot_long_to_wide(long, ["k"]).collect()
    kept = ops.pivot_long_to_wide(long.filter("value <> 2.0"), ["k"]).collect()
    assert {(r.k, r.ssm) for r in kept} == {("a", 1.0), ("b", None)}


def test_union_of_nothing_has_the_columns(spark):
    out = ops.union_stations(spark, [], READINGS)
    assert out.columns == READINGS.names and out.isEmpty()


MIXED = "Time,Air temperature\nTimestamp (UTC),\n6/1/2020 7:05,1\n2020-06-01 08:00:00,2\n6/1/2020 9:00:30 PM,3\n03-Jun-2020 10:00,4\n,5\nnever,6\n"


def test_time_formats_are_tried_in_order_and_lost_lines_told(spark, loggers, tmp_path):
    folder = tmp_path / "loggers"
    (folder / "field7_north.csv").write_text(MIXED)
    (folder / "plain.csv").write_text(MIXED.replace("\n", "\r\n"))
    files = StationFiles(spark, str(folder))
    rows = files.cells().collect()
    times = [(r.station, str(r.ts), r.raw) for r in rows if r.station in ("north", "plain")]
    own = [("2020-06-01 07:05:00", "1"), ("2020-06-01 08:00:00", "2"), ("2020-06-01 21:00:30", "3"), ("2020-06-03 10:00:00", "4")]
    assert sorted(times) == sorted((s, t, v) for s in ("north", "plain") for t, v in own)
    lost = {(r.file.split("/")[-1], r.reason): r.n for r in reject_counts(files.rejects()).collect()}
    assert lost == {
        ("field7_north.csv", csv_lines.NO_TIME): 1,
        ("field7_north.csv", csv_lines.BAD_TIME): 1,
        ("plain.csv", csv_lines.NO_TIME): 1,
        ("plain.csv", csv_lines.BAD_TIME): 1,
        ("LOGGER_MB1_2015_to_2024.csv", csv_lines.BAD_TIME): 1,
        ("LOGGER_MB9.csv", csv_lines.NO_HEADER): 2,
    }
    assert {(r.station, r.column) for r in files.columns().collect()} >= {("north", "Air temperature"), ("MB1", "Battery")}
    only_iso = StationFiles(spark, str(folder), formats=[None])
    assert only_iso.cells().where("station = 'north'").count() == 1
    frame = spark.createDataFrame([("6/1/2020 7:05",), ("x",), (None,)], "raw string")
    assert ops.parse_timestamp_dropna(frame, "raw").count() == 1 and ops.unparsed_times(frame, "raw").count() == 2


@pytest.mark.parametrize("split", [7, 64, 1 << 20])
def test_files_in_ranges_have_every_line_once(spark, loggers, split):
    read = lambda f: sorted((r.station, str(r.ts), r.col_pos, r.raw or "") for r in f.collect())
    files = StationFiles(spark, loggers, split=split)
    assert read(files.cells()) == read(read_station_csv(spark, loggers))
    lines = files.lines.where("file like '%MB1_2015%'").orderBy("at").collect()
    want = [x.lstrip("\ufeff") for x in LOGGER.split("\n") if x.strip()]
    assert [r.line for r in lines] == want
    data = LOGGER.encode()
    assert all(data[r.at :].decode().lstrip("\ufeff").startswith(r.line) for r in lines)


def test_chunks_of_a_long_file_join(tmp_path, monkeypatch):
    """Lines longer than what is read at once, no line end at the file's end, and ranges that hold no line's beginning."""
    from pyarrow import fs

    monkeypatch.setattr(file_ranges, "CHUNK", 5)
    lines = ["é" * 9, "", "short", "x" * 40, "漢字", "last"]
    path = tmp_path / "a.csv"
    for end in ("", "\n"):
        path.write_bytes(("\n".join(lines) + end).encode())
        size = path.stat().st_size
        for split in (3, 11, 1000):
            got = []
            for task in file_ranges.plan([(str(path), size)], split):
                for _, a, b in task.pieces:
                    got += [(int(p), t) for places, texts in file_ranges.lines_of(fs.LocalFileSystem(), str(path), a, b) for p, t in zip(places, texts)]
            places, at = [], 0
            for line in lines:
                places.append((at, line))
                at += len(line.encode()) + 1
            assert got == places, (end, split)


def test_stores_that_only_spark_opens_give_the_same(spark, loggers, monkeypatch):
    read = lambda: sorted((r.station, str(r.ts), r.col_pos, r.raw or "") for r in read_station_csv(spark, loggers).collect())
    want = read()
    monkeypatch.setattr(csv_lines, "reachable", lambda uri: False)
    assert read() == want
    assert not file_ranges.reachable("viewfs://cluster/x")


def test_small_files_share_tasks():
    files = [(f"f{i}", 10) for i in range(5)] + [("big", 35), ("empty", 0)]
    tasks = file_ranges.plan(files, 20)
    assert [p for t in tasks for p in t.pieces if p[0] == "big"] == [("big", 0, 20), ("big", 20, 35)]
    assert max(sum(b - a for _, a, b in t.pieces) for t in tasks) <= 20
    assert len(tasks) == 5
