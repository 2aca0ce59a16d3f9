import gzip
import json
import random
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from equigauge.functions import codebook
from equigauge.operators import clean, runs
from equigauge.session import new_path
from equigauge.sources import matrix, tables
from equigauge.sources.commits import CommitLog

TS = datetime(2024, 5, 1, 12, 0, 0)


def test_landed_matrices(spark, tmp_path):
    header = ["AGEP", "WAGP", "OCCP", "state"]
    (tmp_path / "va.json").write_text(json.dumps([header, ["45", "b", "0010", "51"], ["17", "-1", "10", "51"]], indent=1))
    turned = header[::-1]
    (tmp_path / "md.json").write_text(json.dumps([turned, ["24", None, "0", "30"]]))
    rows = matrix.read_json_matrix(spark, str(tmp_path), ["AGEP", "WAGP", "OCCP", "SEX", "state"])
    got = {r.person_id: r for r in rows.collect()}
    assert set(got) == {"va.json#1", "va.json#2", "md.json#1"}
    assert (got["va.json#1"].OCCP, got["va.json#1"].SEX) == ("0010", None)
    assert (got["md.json#1"].AGEP, got["md.json#1"].OCCP) == ("30", None)
    one = matrix.scope(rows, "51")
    assert one.count() == 2 and matrix.scope(rows, "*").count() == 3
    named = clean.coerce_numeric(clean.rename_present(rows, codebook.FIELD_NAMES), codebook.NUMERIC_FIELDS)
    wages = sorted(str(r.wage_income) for r in named.collect())
    assert wages == ["-1.0", "0.0", "None"]


AWKWARD = ['a"b', "back\\", "\\\\", '\\"', "[x]", "],[", "line\nbreak", "é[ü]", "", "\u2028", '"', "plain", "[[", "tab\t"]


def awkward_matrix(rng, rows, cell=lambda rng: rng.choice(AWKWARD)):
    header = ["a", 'h"[', "b"]
    return [header] + [[None if rng.random() < 0.1 else cell(rng) for _ in range(rng.choice([2, 3, 3, 4]))] for _ in range(rows)]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_ranges_of_any_size_see_the_same_rows(size, tmp_path):
    rng = random.Random(size)
    for indent in (None, 1):
        want = awkward_matrix(rng, 12)
        text = json.dumps(want, indent=indent, ensure_ascii=indent is None).encode()
        path = tmp_path / f"m{indent}.json"
        path.write_bytes(text)
        uri = f"file:{path}"
        starts = range(0, len(text), size)
        notes = [json.dumps([matrix.effect(matrix.read_bytes(uri, s, size), b) for b in matrix.STATES]) for s in starts]
        begun = matrix.chain(pd.DataFrame({"path": uri, "start": list(starts), "note": notes}))
        found = [r for b in begun.itertuples() for r in matrix.range_rows(uri, b.start, size, b.state, b.depth, b.row)]
        assert [n for n, _, _ in found] == list(range(1, 13))
        assert [cells for _, cells, _ in found] == want[1:]
        assert all(header == want[0] for _, _, header in found)


def test_a_large_file_is_many_tasks_and_equals_one_parse(spark, tmp_path):
    rng = random.Random(3)
    cells = [*AWKWARD, 12, 0.50, -1e5, True, "long " * 50]
    (tmp_path / "big.json").write_text(json.dumps(awkward_matrix(rng, 400, lambda r: r.choice(cells))))
    (tmp_path / "small.json").write_text(json.dumps([["b", "a"], ["1", "2"]]))
    (tmp_path / "none.json").write_text("")
    (tmp_path / "bare.json").write_text("[]")
    (tmp_path / "zipped.json.gz").write_bytes(gzip.compress(json.dumps([["a"], ["z"], ["[y"]]).encode()))
    columns = ["b", "a", 'h"[', "lacking"]
    got = matrix.read_json_matrix(spark, str(tmp_path), columns, range_bytes=2000)
    whole = spark.read.text(str(tmp_path), wholetext=True)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    want = matrix.parse_matrix(whole.withColumn("f", name), "value", columns, ["f"])
    want = want.select(F.concat_ws("#", "f", F.col("row_no").cast("string")).alias("person_id"), *columns)
    assert got.rdd.getNumPartitions() > 10

    def plain(df):
        return sorted(map(tuple, df.collect()), key=lambda r: r[0])

    assert plain(got) == plain(want) and got.count() == 403


def test_a_broken_row_is_named(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[["a"],["x" "y"]]')
    with pytest.raises(Exception, match="bad.json: the row at byte 7 is no JSON"):
        matrix.read_json_matrix(spark, str(tmp_path), ["a"]).collect()
    (tmp_path / "bad.json").write_text('[["a"],["x"')
    with pytest.raises(Exception, match="the row at byte 7 is not closed"):
        matrix.read_json_matrix(spark, str(tmp_path), ["a"]).collect()


def test_snapshots(spark):
    path = new_path(spark, "snap-test")
    tables.write_snapshot(spark.range(5), path, date(2024, 1, 1))
    tables.write_snapshot(spark.range(7), path, date(2024, 1, 2))
    tables.write_snapshot(spark.range(3), path, date(2024, 1, 2))
    assert tables.read_latest(spark, path).count() == 3
    assert spark.read.parquet(path).count() == 8
    with pytest.raises(FileNotFoundError):
        tables.read_latest(spark, _empty(spark))


def _empty(spark):
    path = new_path(spark, "snap-empty")
    spark.createDataFrame([], "id long, snapshot_date date").write.parquet(path)
    return path


def test_split_tables_keep_sensitive_columns_apart(spark):
    df = spark.createDataFrame(
        [(1, 30.0, 2.0, "1", 1, True), (2, 40.0, 3.0, "2", 0, False)],
        "person_id long, age double, person_weight double, race string, high_income int, is_test boolean",
    )
    path, secret = new_path(spark, "sp"), new_path(spark, "se")
    tables.write_splits(df, path, secret)
    features, labels = tables.read_splits(spark, path, test=True)
    assert features.columns == ["person_id", "age"]
    assert labels.collect()[0].high_income == 1
    kept, _ = tables.read_splits(spark, path, test=False, keep_weight=True)
    assert "person_weight" in kept.columns and kept.count() == 1
    assert "race" in spark.read.parquet(secret).columns


def test_run_log(spark):
    path = new_path(spark, "log-test")
    metrics = spark.createDataFrame([("auc", 0.9), ("f1", 0.7)], "key string, value double")
    versions = [
        runs.log_run(spark, path, f"r{i}", m, TS, {"stage": "x"}, {"depth": 3}, metrics)
        for i, m in enumerate(["a", "a", "b"])
    ]
    assert versions == [1, 2, 1]
    runs.set_alias(spark, path, "a", "staging", 1, TS)
    runs.set_alias(spark, path, "a", "staging", 2, TS.replace(hour=13))
    assert runs.current_aliases(runs.read_log(spark, path, "aliases")).first().version == 2
    assert runs.read_log(spark, path, "metrics").count() == 6
    assert runs.read_log(spark, path, "params").first().value == "3"


def test_latest_snapshot_opens_only_its_files(spark):
    path = new_path(spark, "snap-log")
    for day, n in ((3, 4), (1, 5), (2, 6)):
        tables.write_snapshot(spark.range(n).withColumn("g", F.col("id") % 2), path, date(2024, 1, day), ["g"])
    latest = tables.read_latest(spark, path)
    assert latest.count() == 4
    assert all("snapshot_date=2024-01-03" in f for f in latest.inputFiles())
    assert set(latest.columns) == {"id", "g", "snapshot_date"}
    tables.write_snapshot(spark.range(0).withColumn("g", F.col("id") % 2), path, date(2024, 1, 4), ["g"])
    assert tables.read_latest(spark, path).count() == 0


def test_failed_snapshot_is_not_visible(spark, monkeypatch):
    path = new_path(spark, "snap-fail")
    tables.write_snapshot(spark.range(3), path, date(2024, 1, 1))

    def lost(self, entry):
        raise OSError("writer lost before its commit")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lost)
        with pytest.raises(OSError):
            tables.write_snapshot(spark.range(9), path, date(2024, 1, 2))
    assert tables.read_latest(spark, path).count() == 3
    broken = spark.range(2).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.write_snapshot(broken, path, date(2024, 1, 3))
    assert tables.read_latest(spark, path).count() == 3


def test_a_table_without_a_log_is_found_by_its_folders(spark):
    path = new_path(spark, "snap-plain")
    days = spark.sql("select date'2024-01-01' + cast(id % 3 as int) as snapshot_date, id from range(10)")
    days.write.partitionBy("snapshot_date").parquet(path)
    latest = tables.read_latest(spark, path)
    assert sorted(r.id for r in latest.collect()) == [2, 5, 8]
    assert latest.first().snapshot_date == date(2024, 1, 3)


def test_a_number_is_given_once(spark):
    log = CommitLog(spark, new_path(spark, "log-race"))
    assert log.newest() is None
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: log.put(1, {"by": i}), range(8)))
        assert sum(won) == 1 and log.read(1) == {"by": won.index(True)}
        numbers = list(pool.map(lambda i: log.commit(lambda _: {"by": i})[0], range(12)))
    assert sorted(numbers) == list(range(2, 14)) and log.last() == 13


def test_concurrent_runs_get_versions_of_their_own(spark, monkeypatch):
    path = new_path(spark, "log-many")
    metrics = spark.createDataFrame([("auc", 0.5)], "key string, value double")
    assert runs.read_log(spark, path, "versions").count() == 0

    def one(i):
        return runs.log_run(spark, path, f"r{i}", "a/b c", TS, {"i": str(i)}, {}, metrics)

    with ThreadPoolExecutor(4) as pool:
        assert sorted(pool.map(one, range(4))) == [1, 2, 3, 4]
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "put", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            one(9)
    tags = {(r.run_id, r.value, r.model) for r in runs.read_log(spark, path, "tags").collect()}
    assert tags == {(f"r{i}", str(i), "a/b c") for i in range(4)}
    versions = runs.read_log(spark, path, "versions").collect()
    assert sorted(v.version for v in versions) == [1, 2, 3, 4] and versions[0].ts == TS
    assert runs.read_log(spark, path, "params").count() == 0
    assert one(5) == 5


def test_metrics_append(spark):
    path = new_path(spark, "metric-test")
    df = spark.createDataFrame([("DriftShare", 0.0, "None")], "name string, value double, unit string")
    for _ in range(2):
        tables.write_metrics(tables.metric_rows(df, "ns", TS), path)
    assert spark.read.parquet(path).count() == 2


def test_csv_lines(spark):
    df = spark.createDataFrame([(1, 45, None, "0010")], "person_id long, a int, b double, c string")
    assert tables.to_csv_lines(df, ["c", "a", "b"]).first().line == "0010,45,nan"


def test_report_is_stored_per_run(spark):
    path = new_path(spark, "report-test")
    df = spark.range(2)
    first = tables.write_report(df, path, "drift", TS)
    tables.write_report(df, path, "drift", TS.replace(hour=13))
    assert spark.read.parquet(first).count() == 2
