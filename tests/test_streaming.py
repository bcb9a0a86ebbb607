from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lendspark.operators import drift as D
from lendspark.streaming import jobs

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, feature string, x double"


def _write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)


def _week(week, shift=0.0, n=300):
    return [(START + timedelta(days=7 * week, minutes=30 * i), f"f{i % 3}", (i * 37 % 100) / 100 + shift) for i in range(n)]


@pytest.fixture
def folder(spark, tmp_path):
    """Four weeks landing in order, then a row that is far too late."""
    for w, shift in enumerate([0.0, 0.0, 0.6, 0.0]):
        _write(spark, _week(w, shift), str(tmp_path / "in" / f"w{w}"))
    _write(spark, [(START, "f0", 0.5)], str(tmp_path / "in" / "w8"))
    _write(spark, [(START + timedelta(days=60), "f0", 0.5)], str(tmp_path / "in" / "w9"))
    return tmp_path


def _arrivals(spark, folder):
    reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    return reader.parquet(str(folder / "in"))


def test_windowed_drift(spark, folder):
    first = spark.createDataFrame(_week(0), SCHEMA)
    wide = first.groupBy("ts").pivot("feature").agg(F.first("x")).drop("ts")
    edges = D.fit_reference_edges(wide, ["f0", "f1", "f2"], 4)
    ref = D.bin_counts_long(first, edges)
    alerts = []
    q = jobs.stream_drift(_arrivals(spark, folder), edges, ref, str(folder / "counts"), str(folder / "cp"),
                          lambda df, _: alerts.extend(df.collect()), alert_at=3)
    q.awaitTermination(180)
    assert q.exception() is None
    psi = jobs.windowed_psi(spark, str(folder / "counts"), edges, ref).collect()
    by = {}
    for r in psi:
        by.setdefault(r.window_start, []).append(r)
    assert sorted(by) == [START + timedelta(days=7 * w) for w in range(4)]
    assert all(r.psi < 1e-9 for r in by[START])
    assert all(r.drift_verdict == "major_drift" for r in by[START + timedelta(days=14)])
    assert [a.window_start for a in alerts] == [START + timedelta(days=14)] and alerts[0].n_major == 3


def test_windowed_rates_drop_late_rows(spark, folder):
    rows = _arrivals(spark, folder).withColumn("TARGET", (F.col("x") > 0.5).cast("int"))
    rates = jobs.windowed_rates(rows, "feature", min_n=50)
    jobs.stream_windowed_rates(rates, str(folder / "rates"), str(folder / "cp2")).awaitTermination(180)
    got = {(r.window_start, r.segment): r for r in spark.read.parquet(str(folder / "rates")).collect()}
    batch = jobs.windowed_rates(spark.createDataFrame(sum((_week(w, s) for w, s in enumerate([0.0, 0.0, 0.6, 0.0])), []), SCHEMA)
                                .withColumn("TARGET", (F.col("x") > 0.5).cast("int")), "feature", min_n=50)
    assert got == {(r.window_start, r.segment): r for r in batch.collect()}


def test_sliding_windows(spark):
    df = spark.createDataFrame(_week(0), SCHEMA).withColumn("TARGET", F.lit(1))
    slid = jobs.windowed_rates(df, "feature", window="7 days", slide="1 day", min_n=1)
    assert slid.select("window_start").distinct().count() > 7


def test_windowed_counts_keep_new_features_and_outside_values(spark, tmp_path):
    rows = [(START, "a", 1.0), (START, "a", 50.0), (START, "new", 1.0), (START, "a", None)]
    _write(spark, rows, str(tmp_path / "in"))
    events = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    q = jobs.windowed_bin_counts(events, {"a": [0.0, 5.0]}).writeStream.outputMode("complete").format("memory").queryName("kept_counts").trigger(
        availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    assert {(r.feature, r.bin, r.n) for r in spark.table("kept_counts").collect()} == {("a", 0, 1), ("a", None, 1), ("new", None, 1)}


def test_successive_windows_over_a_restart(spark, tmp_path):
    """Windows against the ones before them, closed by timers; stopped and started again the rows are those of the batch form."""
    weeks = [0.0, 0.0, 0.6, 0.6, 0.1]
    rows = [_week(w, s) for w, s in enumerate(weeks)]
    rows[3] = [r for r in rows[3] if r[1] != "f1"]  # f1 pauses for a week
    rows[1] += [(START + timedelta(days=8), "new", 1.0), (START + timedelta(days=8), "f0", 99.0), (START + timedelta(days=9), "f0", None)]
    first = spark.createDataFrame(rows[0], SCHEMA)
    edges = D.fit_reference_edges(first.groupBy("ts").pivot("feature").agg(F.first("x")).drop("ts"), ["f0", "f1", "f2"], 4)
    edges = {f: [e[0] - 1, *e[1:-1], e[-1] + 1] for f, e in edges.items()}
    into, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        q = jobs.append_to(jobs.successive_drift(_arrivals(spark, tmp_path), edges), out, cp)
        q.awaitTermination(180)
        assert q.exception() is None

    for w in range(3):
        _write(spark, rows[w], f"{into}/w{w}")
    run()
    some = spark.read.parquet(out).count()
    for w in (3, 4):
        _write(spark, rows[w], f"{into}/w{w}")
    _write(spark, [(START, "f0", 0.5), (START + timedelta(days=60), "f2", 0.5)], f"{into}/w8")  # one far too late, one that moves the clock
    _write(spark, [(START + timedelta(days=61), "f2", 0.5)], f"{into}/w9")
    run()
    got = {(r.window_start, r.feature): r for r in spark.read.parquet(out).collect()}
    assert 0 < some < len(got)
    long = spark.createDataFrame(sum(rows, []), SCHEMA).withColumn("w", F.window("ts", "7 days", startTime="4 days").start)
    batch = {(r.w, r.feature): r for r in D.psi_between_windows(D.bin_counts_long(long, edges, ["w"]), "w", edges).collect()}
    assert set(got) == set(batch) and len(got) == 14
    for k, r in batch.items():
        assert (got[k].previous, got[k].n, got[k].drift_verdict) == (r.previous, r.n, r.drift_verdict) and got[k].psi == pytest.approx(r.psi, abs=1e-12)
    assert got[START + timedelta(days=28), "f1"].previous == START + timedelta(days=14)
    assert got[START + timedelta(days=14), "f0"].drift_verdict == "major_drift" and got[START, "f0"].psi is None


def test_outcomes_come_late_or_never(spark, tmp_path):
    day = lambda d: START + timedelta(days=d)
    decisions = [(k, day(k // 4), ["Approve", "Reject", "Manual Review"][k % 3]) for k in range(200)]
    outcomes = [(k, day(k // 4 + (k * 7) % 40), int(k % 5 == 0)) for k in range(200) if k % 4]  # some after the horizon of 30 days, some never
    d_schema, o_schema = "id long, ts timestamp, recommendation string", "id long, at timestamp, TARGET int"
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def land(part, clock):
        spark.createDataFrame([r for r in decisions if r[0] // 100 == part] + [(10_000 + part, clock, "Clock")], d_schema).coalesce(1).write.parquet(str(tmp_path / f"d/{part}"))
        spark.createDataFrame([r for r in outcomes if r[0] // 100 == part] + [(20_000 + part, clock, 0)], o_schema).coalesce(1).write.parquet(str(tmp_path / f"o/{part}"))

    def run():
        d, o = (spark.readStream.schema(s).option("recursiveFileLookup", True).parquet(str(tmp_path / n)) for s, n in ((d_schema, "d"), (o_schema, "o")))
        q = jobs.append_to(jobs.outcome_rates(jobs.decision_outcomes(d, o, "id", horizon="30 days")), out, cp)
        q.awaitTermination(180)
        assert q.exception() is None

    land(0, day(0))
    run()
    land(1, day(200))
    run()
    land(2, day(230))
    run()
    got = {(r.window_start, r.recommendation): r for r in spark.read.parquet(out).where("recommendation <> 'Clock'").collect()}
    joined = jobs.decision_outcomes(spark.createDataFrame(decisions, d_schema), spark.createDataFrame(outcomes, o_schema), "id", horizon="30 days")
    assert got == {(r.window_start, r.recommendation): r for r in jobs.outcome_rates(joined).collect()}
    assert sum(r.n_decided for r in got.values()) == 200 and 0 < sum(r.n_known for r in got.values()) < 150
