"""End-to-end jobs on text files written from the sf0.001 fixtures."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tracelake.__main__ import main as cli
from tracelake.operators import daily_itineraries, itineraries, lookup_batch
from tracelake.plans import fixtures as fx
from tracelake.plans import jobs
from tracelake.sources import parse_cells, parse_logs, read_table

CELL_HEADER = "id,t,LAC,CELL,f4,f5,f6,f7,f8,f9,f10,f11,CITY,extra"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("jobs")
    cell_lines = [r.value for r in fx.cell_lines(spark, SF_SMALL).collect()]
    log_lines = [r.value for r in fx.log_lines(spark, SF_SMALL).collect()]
    (d / "cells").mkdir()
    half = len(cell_lines) // 2
    # Two directory files, each with its own header line.
    (d / "cells" / "a.csv").write_text("\n".join([CELL_HEADER] + cell_lines[:half]) + "\n")
    (d / "cells" / "b.csv").write_text("\n".join([CELL_HEADER] + cell_lines[half:]) + "\n")
    (d / "logs").mkdir()
    (d / "logs" / "part1.txt").write_text("\n".join(log_lines[:500]) + "\n")
    (d / "logs" / "part2.txt").write_text("\n".join(log_lines[500:]) + "\n")
    clean = [x for x in log_lines if len(x.rstrip(",").split(",")) >= 5]
    (d / "clean_logs.txt").write_text("\n".join(clean) + "\n")
    good_cells = [x for x in cell_lines if len(x.rstrip(",").split(",")) >= 13]
    (d / "good_cells.csv").write_text("\n".join([CELL_HEADER] + good_cells) + "\n")
    return d, cell_lines, log_lines


def test_itineraries_job_default_and_mapreduce(spark, files):
    d, cell_lines, log_lines = files
    cells = parse_cells(spark.createDataFrame([(v,) for v in cell_lines], "value string"))
    logs = parse_logs(spark.createDataFrame([(v,) for v in log_lines], "value string"))
    got = jobs.build_itineraries(spark, str(d / "cells"), str(d / "logs"), str(d / "out_default"))
    assert rows(got) == rows(itineraries(logs, cells))
    got = jobs.build_itineraries(spark, str(d / "cells"), str(d / "logs"), str(d / "out_mr"),
                                 variant="mapreduce")
    expected = itineraries(logs, cells, unmatched="null_text", cells_mode="one", strip="none")
    assert rows(got) == rows(expected)


def test_rdd_variant_fails_on_short_lines_and_runs_on_clean_ones(spark, files):
    d, _, _ = files
    with pytest.raises(Exception):
        jobs.build_itineraries(spark, str(d / "cells"), str(d / "logs"), variant="rdd").collect()
    got = jobs.build_itineraries(spark, str(d / "good_cells.csv"), str(d / "clean_logs.txt"),
                                 variant="rdd")
    cells = parse_cells(spark.read.text(str(d / "good_cells.csv")).where(f"value <> '{CELL_HEADER}'"))
    logs = parse_logs(spark.read.text(str(d / "clean_logs.txt")), min_fields=4)
    expected = itineraries(logs, cells, key="concat", strip="ends", dedupe="raw")
    assert rows(got) == rows(expected)


def test_daily_job_and_lookups(spark, files, tmp_path):
    d, cell_lines, log_lines = files
    daily_path = str(tmp_path / "daily")
    daily = jobs.build_daily_itineraries(spark, str(d / "cells"), str(d / "logs"), daily_path)
    cells = parse_cells(spark.createDataFrame([(v,) for v in cell_lines], "value string"))
    logs = parse_logs(spark.createDataFrame([(v,) for v in log_lines], "value string"))
    expected = daily_itineraries(logs, cells, strip="none")
    assert rows(daily, "phone", "day", "itinerary") == rows(expected)

    req = fx.requests(spark, SF_SMALL)
    req_csv = tmp_path / "requests.csv"
    with open(req_csv, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["request_id", "phone", "start", "end"])
        for r in req.collect():
            w.writerow([r.request_id, r.phone, r.start, r.end])
    got = jobs.answer_lookups(spark, daily_path, str(req_csv), str(tmp_path / "answers"))
    assert rows(got) == rows(lookup_batch(expected, req.withColumn("request_id", F.col("request_id").cast("string"))))

    one = req.where("request_id % 7 = 0").orderBy("request_id").first()
    single = jobs.lookup(spark, daily_path, one.phone, one.start, one.end).first()
    batch = {r.request_id: r for r in got.collect()}[str(one.request_id)]
    assert (single.visited, single.found) == (batch.visited, batch.found)


def test_cli(spark, files, tmp_path, capsys):
    d, _, _ = files
    out = str(tmp_path / "cli_daily")
    assert cli(["daily", "--cells", str(d / "cells"), "--logs", str(d / "logs"), "--out", out]) == 0
    capsys.readouterr()
    first = read_table(spark, out).orderBy("phone", "day").first()
    assert cli(["lookup", "--daily", out, "--phone", f" {first.phone} ",
                "--start", first.day, "--end", first.day]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["found"] and res["visited"] == first.itinerary
    assert cli(["lookup", "--daily", out, "--phone", "123", "--start", "x", "--end", "y"]) == 2
    odd = ["lookup", "--daily", out, "--phone", first.phone, "--start", "2024-99-99", "--end", "2024-99-99"]
    assert cli(odd) == 0
    assert cli([*odd, "--strict"]) == 2
    with pytest.raises(SystemExit):
        cli(["lookup", "--daily", out, "--requests", "requests.csv"])
    with pytest.raises(SystemExit):
        cli(["lookup", "--daily", out])


def test_region_job(spark, tmp_path):
    places = fx.places_text(spark, SF_SMALL).collect()
    p = tmp_path / "places.csv"
    with open(p, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["ID", "LNG", "LAT", "REGION", "COUNTRY"])
        for r in places:
            w.writerow([r.c_custkey, r.lng, r.lat, r.region, r.country])
    labels = fx.region_labels(spark, SF_SMALL)
    res = jobs.train_regions(spark, str(p), country="home", key="ID", labels=labels,
                             out_dir=str(tmp_path / "regions"), params={"numTrees": 10})
    acc = spark.read.parquet(str(tmp_path / "regions" / "accuracy")).first()
    assert acc.n == res.predictions.count() > 0
    assert spark.read.parquet(str(tmp_path / "regions" / "confusion")).count() > 0


def test_cell_dimension_job(spark, files, tmp_path):
    d, cell_lines, _ = files
    out = str(tmp_path / "dim")
    assert cli(["cells", "--cells", str(d / "cells"), "--out", out]) == 0
    from tracelake.operators import cell_dimension
    cells = parse_cells(spark.createDataFrame([(v,) for v in cell_lines], "value string"))
    assert rows(read_table(spark, out)) == rows(cell_dimension(cells))
    assert rows(jobs.build_cell_dimension(spark, str(d / "cells"))) == rows(cell_dimension(cells))


def test_two_step_flow_with_stored_dimension(spark, files, tmp_path):
    d, _, _ = files
    dim = str(tmp_path / "dim")
    jobs.build_cell_dimension(spark, str(d / "cells"), dim)
    two_step = jobs.build_itineraries(spark, None, str(d / "logs"), cells_table=dim,
                                      variant="mapreduce")
    one_plan = jobs.build_itineraries(spark, str(d / "cells"), str(d / "logs"), variant="mapreduce")
    assert rows(two_step) == rows(one_plan)
    out = str(tmp_path / "daily2")
    assert cli(["daily", "--cells-table", dim, "--logs", str(d / "logs"), "--out", out]) == 0
    assert rows(read_table(spark, out), "phone", "day", "itinerary") == rows(
        jobs.build_daily_itineraries(spark, str(d / "cells"), str(d / "logs")), "phone", "day", "itinerary")


def test_quote_aware_directory(spark, tmp_path):
    cells = tmp_path / "cells.csv"
    cells.write_text("id,t,LAC,CELL,a,b,c,d,e,f,g,h,CITY\n"
                     '1,t,1,1,a,"b,c",d,e,f,g,h,i,Alpha\n')
    logs = tmp_path / "logs.txt"
    logs.write_text("0,1,1,13800000001,2024-01-05 10:00:00\n")
    positional = jobs.build_itineraries(spark, str(cells), str(logs)).collect()
    quoted = jobs.build_itineraries(spark, str(cells), str(logs), quote_aware=True).collect()
    assert [r.itinerary for r in positional] == ["i"]
    assert [r.itinerary for r in quoted] == ["Alpha"]
    cells.write_text(cells.read_text() + "2,t,1\n")
    with pytest.raises(Exception):
        jobs.build_itineraries(spark, str(cells), str(logs), quote_aware=True, mode="fail").collect()


def test_lookup_of_a_city_with_a_comma(spark, tmp_path):
    cells, logs, daily = tmp_path / "cells.csv", tmp_path / "logs.txt", str(tmp_path / "daily")
    cells.write_text('id,t,LAC,CELL,a,b,c,d,e,f,g,h,CITY\n1,t,1,1,a,b,c,d,e,f,g,h,"Paris, FR"\n')
    logs.write_text("0,1,1,13800000001,2024-01-05 10:00:00\n")
    jobs.build_daily_itineraries(spark, str(cells), str(logs), daily, quote_aware=True)
    one = jobs.lookup(spark, daily, "13800000001", "2024-01-01", "2024-01-31").first()
    assert (one.visited, one.n_visited) == ("Paris, FR", 1)


def test_region_presets(spark, tmp_path):
    p = tmp_path / "places.csv"
    rows_ = [f"{110 + i % 9},{30 + i % 7},{'北京市' if i % 2 else '上海市'},中国" for i in range(60)]
    p.write_text("\n".join(["LNG,LAT,REGION,COUNTRY", *rows_, "1,1,Atlantis,中国"]) + "\n")
    assert jobs.train_regions(spark, str(p), params={"numTrees": 2}).prepared.count() == 61
    with pytest.raises(Exception):
        jobs.train_regions(spark, str(p), params={"numTrees": 2}, variant="original")
    p.write_text("\n".join(["LNG,LAT,REGION,COUNTRY", *rows_]) + "\n")
    res = jobs.train_regions(spark, str(p), params={"numTrees": 2}, variant="original")
    assert res.accuracy.first().n == res.predictions.count()


def test_region_job_with_the_province_dictionary(spark, tmp_path):
    import random

    rnd = random.Random(5)
    centres = {"北京市": (116.4, 39.9), "上海市": (121.5, 31.2), "广东省": (113.3, 23.1)}
    p = tmp_path / "places.csv"
    with open(p, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["LNG", "LAT", "REGION", "COUNTRY", "NAME"])
        for i in range(300):
            region = list(centres)[i % 3]
            lng, lat = centres[region]
            w.writerow([lng + rnd.uniform(-1, 1), lat + rnd.uniform(-1, 1), region,
                        "中国" if i % 10 else "其他", f"place {i}, somewhere"])
        w.writerow(["bad", "1.0", "北京市", "中国", "malformed"])
        w.writerow(["116.0", "40.0", "", "中国", "no region"])
    res = jobs.train_regions(spark, str(p), params={"numTrees": 10})
    assert res.model.numClasses == 31
    acc = res.accuracy.first()
    assert acc.n > 0 and acc.accuracy >= 0.9
    assert set(r.label for r in res.confusion.collect()) <= {0.0, 2.0, 16.0}
