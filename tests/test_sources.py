import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lendspark.operators import metrics as M
from lendspark.sources import audits as A
from lendspark.sources import files as S

CSV = 'id,name,x\n1,plain,1.5\n2,"two\nlines",2.5\n3,"say ""hi""",NaN\n4,,4.0\n'


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_round_trip_and_contract(spark, csv, tmp_path):
    df = S.read_applications(spark, csv, "id long, name string, x double", rows=4, cols=3, multi_line=True)
    rows = {r.id: (r.name, r.x) for r in df.collect()}
    assert rows == {1: ("plain", 1.5), 2: ("two\nlines", 2.5), 3: ('say "hi"', None), 4: (None, 4.0)}
    with pytest.raises(ValueError):
        S.read_applications(spark, csv, rows=5, multi_line=True)
    with pytest.raises(FileNotFoundError):
        S.read_applications(spark, str(tmp_path / "none.csv"))
    out = str(tmp_path / "out")
    S.write_csv(df.where("id <> 2"), out)
    assert S.read_applications(spark, out, "id long, name string, x double").count() == 3


def test_malformed_record_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,x\n1,2.0\n2,abc\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        S.read_applications(spark, str(path), "id long, x double").collect()


def test_parquet_projection_and_partitions(spark, tmp_path):
    df = spark.range(30).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") % 2).cast("int").alias("TARGET"),
                                F.when(F.col("id") < 20, "train").otherwise("val").alias("SPLIT"))
    path = str(tmp_path / "t")
    S.write_table(df, path, "SPLIT")
    slim = S.read_table(spark, path, ["TARGET", "SPLIT"])
    assert slim.columns == ["TARGET", "SPLIT"] and slim.where("SPLIT = 'train'").count() == 20
    plan = slim.where("SPLIT = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(SPLIT" in plan and "SK_ID_CURR" not in plan.split("ReadSchema")[1]


def test_selected_features_round_trip(spark, tmp_path):
    rows = [(2, "b", 2, 3, 1, 2.0, 0.5), (1, "a", 1, 1, 2, 1.3, 0.9)]
    path = str(tmp_path / "sel")
    S.write_selected(spark.createDataFrame(rows, S.SELECTED_SCHEMA), path)
    assert S.selected_names(spark, path) == ["a", "b"]


def test_preferred_path(spark, csv, tmp_path):
    assert S.first_existing(spark, [str(tmp_path / "no"), csv]) == csv
    with pytest.raises(FileNotFoundError):
        S.first_existing(spark, [str(tmp_path / "no")])


def test_markdown_ranking(spark, tmp_path):
    text = ["# Report", "| Rank | Feature | A | B | C | mean | score |", "|---|---|---|---|---|---|---|"]
    text += [f"| {i} | `F_{i} / x` | {i} | {i + 1} | {i} | {i + 0.333} | 0.9{i} |" for i in range(1, 6)]
    text += ["| 9 | short | 1 |", "plain 1 | 2"]
    path = tmp_path / "r.md"
    path.write_text("\n".join(text))
    rows = S.read_importance_markdown(spark, str(path)).collect()
    assert [r.rank for r in rows] == [1, 2, 3, 4, 5] and rows[0].feature == "F_1 / x" and rows[2].rf_rank == 4
    assert rows[0].mean_rank == 1.333
    path.write_text("nothing here")
    with pytest.raises(ValueError):
        S.read_importance_markdown(spark, str(path))


def test_run_log(spark, tmp_path):
    scored = spark.createDataFrame([("m", s, y, p) for s in ("val", "test") for y, p in ((1, 0.8), (0, 0.3), (0, 0.6))],
                                   "model string, SPLIT string, TARGET int, score double")
    report = M.model_report(scored)
    path = str(tmp_path / "log")
    S.append_run_log(report, "r1", path, {"learner": "x"})
    S.append_run_log(report, "r2", path)
    log = spark.read.parquet(path)
    assert log.where("run_id = 'r1'").count() == 13 and log.where("run_id = 'r2'").count() == 12
    assert log.where("run_id = 'r1' AND key = 'val_accuracy'").first().value == pytest.approx(2 / 3)


def test_line_audits(spark, csv):
    r = A.line_audit(spark, csv).first()
    assert (r.physical_lines, r.parsed_rows) == (6, 4)
    df = S.read_applications(spark, csv, "id long, name string, x double", multi_line=True)
    n = A.embedded_newlines(df, "name").first()
    assert (n.n_rows, n.n_embedded, n.n_newlines) == (4, 1, 1)
    assert [x.id for x in A.records_with_newline(df, "name").collect()] == [2]
    q = A.quote_parity(spark.read.text(csv), "value").first()
    assert (q.n_quotes, q.parity, q.n_odd_rows) == (8, 0, 2)


def test_ragged_records(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("a,b,c\n1,2,3\n1,2\n1,2,3,4\n4,5,6\n")
    assert sorted(r.record for r in A.ragged_records(spark, str(path), ["a", "b", "c"]).collect()) == ["1,2", "1,2,3,4"]
    assert A.ragged_records(spark, str(path), ["a", "b", "c"], 1).count() == 1


def test_fingerprint(spark, csv):
    digest = hashlib.md5(CSV.encode()).hexdigest()
    A.check_fingerprint(spark, csv, len(CSV), digest)
    with pytest.raises(ValueError):
        A.check_fingerprint(spark, csv, len(CSV), "0" * 32)


def test_gaps_and_missing_ids(spark):
    ids = [1, 2, 5, 6, 2_000_000, 2_000_001, 5_000_000, 2]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long")
    got = sorted((r.id, r.next_id, r.n_missing) for r in A.id_gaps(df, "id").collect())
    assert got == [(2, 5, 2), (6, 2_000_000, 1_999_993), (2_000_001, 5_000_000, 2_999_998)]
    assert sorted(r.id for r in A.missing_ids(df.where("id < 10"), "id").collect()) == [3, 4]
    assert A.missing_ids(df.where("id < 10"), "id", 0, 7).count() == 4


def test_scattered_ids_link_across_buckets(spark):
    from pyspark.sql import functions as F

    from lendspark.operators.segments import member_filter
    from lendspark.sources.audits import id_gaps

    ids = sorted({(k * 7919) ** 3 % (1 << 44) for k in range(1, 300)})
    df = spark.createDataFrame([(i,) for i in ids[::-1]], "id long")
    got = sorted((r.id, r.next_id, r.n_missing) for r in id_gaps(df, "id", bucket_rows=20).collect())
    assert got == [(a, b, b - a - 1) for a, b in zip(ids, ids[1:]) if b - a > 1]
    wanted = df.where(F.col("id") % 2 == 0)
    assert member_filter(df, "id", wanted).count() == wanted.count() == member_filter(df, "id", [r.id for r in wanted.collect()]).count()


def test_missing_ranges_of_any_width(spark):
    df = spark.createDataFrame([(3,), (3 + (1 << 62),), (None,)], "id long")
    assert [tuple(r) for r in A.missing_ranges(df, "id").collect()] == [(4, 2 + (1 << 62), (1 << 62) - 1)]
    with pytest.raises(ValueError):
        A.missing_ids(df, "id")
    few = spark.createDataFrame([(5,), (9,), (9,)], "id long")
    assert sorted(tuple(r) for r in A.missing_ranges(few, "id", 1, 12).collect()) == [(1, 4, 4), (6, 8, 3), (10, 12, 3)]
    assert sorted(r.id for r in A.missing_ids(few, "id", 1, 12).collect()) == [1, 2, 3, 4, 6, 7, 8, 10, 11, 12]
    assert [tuple(r) for r in A.missing_ranges(few.where("false"), "id", 1, 2).collect()] == [(1, 2, 2)]
    assert A.missing_ranges(few.where("false"), "id").count() == 0


def test_line_audit_of_a_file_in_many_blocks(spark, tmp_path):
    """Quoted line breaks, doubled quotes and blank lines, in files that many tasks read a part of."""
    rng = random.Random(1)
    rows = []
    for k in range(3000):
        text = "".join(rng.choice(['a', 'b', '""', "\n", ",", "\n\n", "é"]) for _ in range(rng.randint(0, 12)))
        rows.append(f'{k},"{text}"' if rng.random() < 0.7 else f"{k},plain" + rng.choice(["", "\n"]))
    (tmp_path / "d").mkdir()
    for name, part in (("a", rows[:2500]), ("b", rows[2500:]), ("c", [])):
        (tmp_path / "d" / f"{name}.csv").write_text("\n".join(["id,text", *part]) + "\n")
    lines = sum(p.read_text().count("\n") for p in (tmp_path / "d").iterdir())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        path = str(tmp_path / "d")
        assert A.line_blocks(spark, path).count() > 10
        assert tuple(A.line_audit(spark, path).first()) == (lines, 3000)
        parsed = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        assert parsed.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
