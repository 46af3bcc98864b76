from __future__ import annotations

import math
import statistics
from pathlib import Path

import pytest

from fixtures import CHAIN_RANKS, CONNECTIONS, STATIONS
from skymeter.plans.report import readings_report, write_report
from skymeter.session import work_root
from skymeter.sources import connections_table, read_readings

MEASURES = ["PM2.5", "PM10", "SO2", "NO2", "CO", "O3"]


def reading(station_number, hour):
    """Measures of one hour; one hour is far off, some are missing."""
    base = 20 + 3 * station_number + 10 * math.sin(hour / 4)
    pm25 = "NA" if hour % 11 == 5 else f"{900.0 if (station_number, hour) == (3, 40) else base:.2f}"
    others = [f"{base * k:.2f}" for k in (1.5, 0.2, 0.8, 10)]
    if (station_number, hour) == (3, 40):
        others = [f"{float(v) * 20:.2f}" for v in others]
    return [pm25, *others, "" if hour % 7 == 0 else f"{base / 2:.2f}"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    for number, station in enumerate(STATIONS):
        lines = [",".join(["No", "year", "month", "day", "hour", *MEASURES, "station"])]
        for hour in range(96):
            day, month = 1 + hour // 24, (1, 4, 7, 10)[hour % 4]
            values = [hour + 1, 2013 + hour % 3, month, day, hour % 24, *reading(number, hour), station]
            lines.append(",".join(map(str, values)))
        lines.append(lines[-1])
        (folder / f"{station}.csv").write_text("\n".join(lines) + "\n")
    return folder


def stored_tables(spark):
    folder = Path(work_root(spark).removeprefix("file://")) / "skymeter"
    return {p.name for p in folder.iterdir()} if folder.is_dir() else set()


def test_a_report_that_cannot_be_written_leaves_no_tables(spark, folder, tmp_path):
    raw = read_readings(spark, [str(folder / f"{s}.csv") for s in STATIONS[:2]])
    before = stored_tables(spark)
    report = readings_report(raw, connections_table(spark, CONNECTIONS[:1]))
    (tmp_path / "file").write_text("")
    with pytest.raises(Exception):
        write_report(report, str(tmp_path / "file"))
    assert stored_tables(spark) <= before


def test_malformed_lines_are_set_aside_and_counted(spark, folder, tmp_path):
    source = tmp_path / "bad.csv"
    lines = (folder / f"{STATIONS[0]}.csv").read_text().splitlines()
    source.write_text("\n".join([*lines, "1,2013,3", lines[1] + ",more"]) + "\n")
    raw = read_readings(spark, [str(folder / f"{STATIONS[1]}.csv"), str(source)], malformed="malformed")
    write_report(readings_report(raw, connections_table(spark, CONNECTIONS[:1]), malformed="malformed"), str(tmp_path / "out"))
    bad = spark.read.parquet(str(tmp_path / "out" / "malformed_lines")).collect()
    assert sorted(r.line for r in bad) == sorted(["1,2013,3", lines[1] + ",more"])
    assert {r.file.rsplit("/", 1)[1] for r in bad} == {"bad.csv"}
    quality = spark.read.parquet(str(tmp_path / "out" / "quality_report")).first()
    assert (quality.raw_rows, quality.distinct_rows, quality.malformed_rows) == (2 * 97, 2 * 96, 2)


def test_report_from_csv_files(spark, folder, tmp_path):
    raw = read_readings(spark, [str(folder / f"{s}.csv") for s in STATIONS])
    before = stored_tables(spark)
    tables = readings_report(raw, connections_table(spark, CONNECTIONS))
    assert stored_tables(spark) - before
    write_report(tables, str(tmp_path))
    assert stored_tables(spark) <= before
    got = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}

    kept = [h for h in range(96) if h % 11 != 5]
    quality = got["quality_report"].first()
    assert (quality.raw_rows, quality.distinct_rows) == (12 * 97, 12 * 96)
    assert quality.clean_rows == 12 * len(kept)

    means = {r.station: r.pm25_mean for r in got["mean_by_station"].collect()}
    expected = statistics.mean(float(reading(0, h)[0]) for h in kept)
    assert means[STATIONS[0]] == pytest.approx(expected)
    assert got["mean_by_hour"].count() == 24
    assert {r.month for r in got["mean_by_month"].collect()} == {1, 4, 7, 10}
    assert {r.year for r in got["mean_by_year"].collect()} == {2013, 2014, 2015}
    assert {r.season for r in got["critical_seasons"].collect()} == {"winter", "spring", "summer", "autumn"}
    assert got["stations_most_exposed"].orderBy("pm25_max", ascending=False).first().station == STATIONS[3]

    top = got["top_anomalies"].orderBy("pollution_index", ascending=False).first()
    assert (top.station, top.pm25) == (STATIONS[3], 900.0)
    assert got["anomaly_count"].first().n_anomalies == got["top_anomalies"].count() == 1
    assert got["top_index"].count() == 20

    ranks = {r.station: r["rank"] for r in got["pagerank"].collect()}
    assert [ranks[s] for s in STATIONS] == pytest.approx(CHAIN_RANKS, abs=1e-6)
    received = {r.station: r.received for r in got["propagate"].collect()}
    assert STATIONS[0] not in received
    assert received[STATIONS[1]] == pytest.approx(0.1 * means[STATIONS[0]])

    assert got["model_comparison"].count() == 3
    assert got["prediction_examples"].count() == 20
