"""Headers found by a probe, thresholds without a baseline, short series mirrored."""

import random

import pytest
from pyspark.sql import functions as F

from leadtime.operators import faults as flt
from leadtime.operators.baseline import baseline
from leadtime.operators.rolling import rolling_features, smooth_centered
from leadtime.sources import files
from tests.helpers import at, quantile, same, telemetry

PREAMBLE = "".join(f"# line {i}\n" for i in range(1, 10))


def test_probe_reads_the_head_and_tells_why(spark, tmp_path):
    texts = {
        "marked.csv": PREAMBLE + "# Date and time,Power (kW)\n2018-01-01 00:00:00,1.5\n",
        "plain.csv": PREAMBLE + "Date and time,Power (kW),Extra\n2019-01-01 00:00:00,2.5,7\n2019-01-01 00:10:00,,8\n",
        "large.csv": PREAMBLE + "# Date and time,Power (kW)\n" + "".join(f"2020-01-01 00:00:00,{i}\n" for i in range(200_000)),
        "wide.csv": PREAMBLE + "# Date and time," + "x" * 40_000 + "\n2021-01-01 00:00:00,4\n",
        "with space.csv": PREAMBLE + "# Date and time,Power (kW)\r\n2022-01-01 00:00:00,5\r\n",
        "other.csv": PREAMBLE + "a,b\n1,2\n", "short.csv": "# Date and time,Power (kW)\n1,2\n", "empty.csv": "",
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    found = {r.file.rsplit("/", 1)[1]: r for r in files.probe_files(spark, [str(tmp_path)]).collect()}
    assert set(found) == set(texts) - {"empty.csv"}  # Spark lists no file without a byte
    assert {n for n, r in found.items() if r.accepted} == {"marked.csv", "plain.csv", "large.csv", "wide.csv", "with space.csv"}
    assert found["plain.csv"].header == "timestamp,power_kw,extra" and not found["plain.csv"].marked and found["marked.csv"].marked
    assert found["with space.csv"].header == "timestamp,power_kw"
    assert (found["other.csv"].reason, found["short.csv"].reason) == ("no column line on line 10", "fewer than 10 lines")
    large = found["large.csv"]
    assert large.n_bytes == len(texts["large.csv"]) > 100 * files.HEAD_BYTES and large.read_bytes == files.HEAD_BYTES
    assert 40_000 < found["wide.csv"].read_bytes <= 128 << 10 and len(found["wide.csv"].header) > 40_000
    rows = files.read_scada(spark, [str(tmp_path / n) for n in ("marked.csv", "plain.csv", "with space.csv", "empty.csv")]).orderBy("timestamp").collect()
    assert [(r.timestamp.year, r.power_kw, r.extra) for r in rows] == [(2018, 1.5, None), (2019, 2.5, 7.0), (2019, None, 8.0), (2022, 5.0, None)]


def test_threshold_of_the_whole_series_where_there_is_no_baseline(spark):
    rng = random.Random(2)
    rows = [(e, h, rng.choice([None, rng.random()]), rng.random()) for e in (1, 2) for h in range(40)]
    tel = telemetry(spark, rows, "a double, b double")
    base = baseline(tel.where("entity_id = 1"), ["a", "b"], days=1).where("sensor = 'a'")
    p90 = base.first().p90
    got = {(r.entity_id, r.ts): r for r in rolling_features(tel, ["a", "b"], base, windows={"w": 5}, chunk_rows=7, fallback=True).collect()}
    for e in (1, 2):
        for sensor in ("a", "b"):
            filled, last = [], 0.0
            for row in (r for r in rows if r[0] == e):
                last = row[2 if sensor == "a" else 3] if row[2 if sensor == "a" else 3] is not None else last
                filled.append(last)
            limit = p90 if (e, sensor) == (1, "a") else quantile(filled, 0.9)
            for i in range(40):
                frame = filled[max(0, i - 4):i + 1]
                want = sum(x > limit for x in frame) / len(frame)
                assert same(got[e, at(i)][f"{sensor}__exceed_w"], want), (e, sensor, i)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 30])
@pytest.mark.parametrize("n", [1, 4, 9, 24])
def test_series_shorter_than_half_the_frame_are_mirrored_again(spark, size, n):
    values = [float((i * 7) % 11) for i in range(size)]
    out = smooth_centered(telemetry(spark, [(1, i, v) for i, v in enumerate(values)]), "v", n, chunk_rows=5).orderBy("ts").collect()
    left, right = n // 2, n - n // 2 - 1

    def mirrored(i):
        i %= 2 * size
        return values[i] if i < size else values[2 * size - 1 - i]

    assert len(out) == size
    for i, row in enumerate(out):
        assert same(row.smoothed, sum(mirrored(i + k) for k in range(-left, right + 1)) / n), (i, row)


def test_long_catalogs_are_joined(spark, monkeypatch):
    events = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (None, "n")], "code int, t string")
    catalog = spark.createDataFrame([(1, "a"), (2, "b")], "code int, family string")
    short = sorted(map(str, flt.map_family(events, catalog, other="none").collect())), sorted(map(str, flt.drop_codes(events, catalog).collect()))
    monkeypatch.setattr(flt, "LITERAL_CODES", 1)
    long = flt.map_family(events, catalog, other="none"), flt.drop_codes(events, catalog)
    assert "Join" in long[0]._jdf.queryExecution().executedPlan().toString()
    assert (sorted(str(r) for r in long[0].select("code", "t", "family").collect()), sorted(str(r) for r in long[1].select("code", "t").collect())) == short
    flagged = flt.flag_targets(events.withColumn("event_ts", F.lit(at(0))), catalog)
    assert {r.code: r.is_failure_target for r in flagged.collect()} == {1: True, 2: True, 3: False, None: False}
