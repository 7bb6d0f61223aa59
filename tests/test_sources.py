import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from runscope import session
from runscope.session import fresh_path
from runscope.operators import filters as flt, summaries as summ
from runscope.sources import nested, runs as src, schema, storage, tracking

NESTED = {
    "4796": {"23": {"X": [[0.1, 0.2], [0.3, 0.4]], "y": [[0.9], [0.8]]}},
    "5527": {"31": {"X": [[0.5]], "y": [0.7]}, "32": {"X": [[0.5], [0.6], [0.7]], "y": [[0.25], None]}},
}
FLAT = {
    (4796, 23, 0.9, 0.1, 0.2), (4796, 23, 0.8, 0.3, 0.4), (5527, 31, 0.7, 0.5, None), (5527, 32, 0.25, 0.5, None),
    (5527, 32, None, 0.6, None),
}


def without_names(found):
    return {tuple(r)[1:] for r in found.collect()}


def test_nested_lines(spark, tmp_path):
    lines = [json.dumps({space: datasets}) for space, datasets in NESTED.items()]
    (tmp_path / "runs.json").write_text("\n".join(lines) + "\n\n")
    found = nested.flatten_nested_runs(spark, str(tmp_path))
    assert without_names(found) == FLAT and found.columns[-2:] == ["hp_0", "hp_1"]


def test_nested_file_over_several_lines(spark, tmp_path):
    (tmp_path / "runs.json").write_text(json.dumps(NESTED, indent=2))
    found = nested.flatten_nested_runs(spark, str(tmp_path), 2, whole_files=True)
    assert without_names(found) == FLAT
    assert [f.dataType for f in found.schema] == [f.dataType for f in schema.real_runs(2)]
    with pytest.raises(Exception, match="MALFORMED"):  # read line by line it is no JSON
        nested.flatten_nested_runs(spark, str(tmp_path), 2).collect()


def test_no_value_is_lost(spark, tmp_path):
    (tmp_path / "runs.json").write_text('{"1": {"2": {"X": [[1, 2, 3, 4], [5]], "y": [[0.5], 0.25]}}}')
    found = nested.flatten_nested_runs(spark, str(tmp_path))
    assert without_names(found) == {(1, 2, 0.5, 1.0, 2.0, 3.0, 4.0), (1, 2, 0.25, 5.0, None, None, None)}
    with pytest.raises(Exception, match="more than 2 values"):
        nested.flatten_nested_runs(spark, str(tmp_path), 2).collect()


def test_a_bad_document_stops_the_job_or_is_counted(spark, tmp_path):
    good = json.dumps({"1": {"2": {"X": [[1]], "y": [0.5]}}})
    (tmp_path / "runs.json").write_text(good + "\n" + good[:-9])
    path, documents = str(tmp_path), nested.read_documents(spark, str(tmp_path))
    with pytest.raises(Exception, match="MALFORMED"):
        nested.flatten_nested_runs(spark, path, 1).collect()
    assert nested.flatten_nested_runs(spark, path, skip_bad=True).count() == 1
    assert nested.rejected_documents(documents).count() == 1
    (tmp_path / "runs.json").write_text('{"1": ["2"]}\n{"1": ["3')
    with pytest.raises(Exception, match="MALFORMED"):
        nested.explode_split_manifest(spark, path, whole_files=False).collect()


def test_names_are_unique_over_documents_and_copies(spark, tmp_path):
    one = json.dumps({"1": {"2": {"X": [[1], [2]], "y": [0.5, 0.6]}}})
    two = json.dumps({"1": {"2": {"X": [[3]], "y": [0.7]}}})
    (tmp_path / "runs.json").write_text("\n".join([one, two, one]))
    names = [r["run_id"] for r in nested.flatten_nested_runs(spark, str(tmp_path)).collect()]
    assert len(names) == len(set(names)) == 5
    again = nested.flatten_nested_runs(spark, str(tmp_path)).repartition(7)
    assert {r["run_id"] for r in again.collect()} == set(names)


def test_the_first_element_of_y_counts(spark, tmp_path):
    (tmp_path / "runs.json").write_text('{"1": {"2": {"X": [[1], [2], [3], [4]], "y": [[null, 0.7], [], 0.5, null]}}}')
    found = nested.flatten_nested_runs(spark, str(tmp_path)).orderBy("hp_0").collect()
    assert [r["val_accuracy"] for r in found] == [None, None, 0.5, None]


@pytest.mark.parametrize("number", [1e-05, -0.25, 1.0, 0, 12345.678901234567, 1e20])
def test_nested_numbers_survive(spark, tmp_path, number):
    (tmp_path / "runs.json").write_text(json.dumps({"1": {"2": {"X": [[number]], "y": [[number]]}}}))
    row = nested.flatten_nested_runs(spark, str(tmp_path), 1).first()
    assert row["val_accuracy"] == number and row["hp_0"] == number


def test_manifest(spark, tmp_path):
    (tmp_path / "split.json").write_text('{"4796": ["3549", "23"],\n "5906": ["9971"]}')
    found = nested.explode_split_manifest(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in found} == {(4796, 3549), (4796, 23), (5906, 9971)}


def test_manifest_split_keeps_every_run(spark, runs):
    manifest = spark.createDataFrame([(1, 5), (1, 5), (2, 7)], "search_space_id int, dataset_id int")
    test, train = (flt.in_manifest(runs, manifest, t).count() for t in (True, False))
    parts = dict(flt.mark_held_out(runs, manifest).groupBy("part").count().collect())
    assert test + train == runs.count() and parts == {"test": test, "train": train}


def test_csv_with_and_without_schema(spark, runs, tmp_path):
    path = str(tmp_path / "csv")
    src.write_runs_csv(runs, path)
    assert src.scan_runs_csv(spark, path, runs.schema).exceptAll(runs).count() == 0
    assert src.scan_runs_csv(spark, path).exceptAll(runs).count() == 0


def test_written_table_prunes_spaces(spark, runs, tmp_path, capsys):
    path = str(tmp_path / "by-space")
    src.write_runs(runs, path)
    src.write_runs(runs, path)
    back = src.scan_runs(spark, path)
    assert back.count() == runs.count()
    flt.filter_space(back, 1).select("val_accuracy").explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(search_space_id" in plan and "ReadSchema: struct<val_accuracy:double>" in plan


def test_one_big_space_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = spark.range(0, 400_000, 1, 8).select(
        F.lit(1).alias("search_space_id"), F.sha2(F.col("id").cast("string"), 256).alias("run_id")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        src.write_runs(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{path}/search_space_id=1") if f.endswith(".parquet")]
    assert len(files) > 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path, runs, capsys):
    path = str(tmp_path / "flat")
    runs.write.parquet(path)
    summ.top_config_profile(src.scan_runs(spark, path)).explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(val_accuracy,0.95)" in plan and "learning_rate" not in plan


def test_register_view_and_external_table(spark, runs, tmp_path):
    src.register_runs(runs, "runs_view")
    src.register_runs(runs, "runs_table", str(tmp_path / "table"))
    for name in ("runs_view", "runs_table"):
        assert spark.table(name).count() == runs.count()
    assert spark.catalog.getTable("runs_table").tableType == "EXTERNAL"
    spark.sql("DROP TABLE runs_table")


def test_generated_runs_stay_in_their_ranges(spark):
    found = src.generate_runs(spark, 5000)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in schema.SYNTHETIC_RUNS]
    row = found.agg(
        F.count("run_id").alias("n"), F.count_distinct("run_id").alias("ids"),
        F.count_distinct("search_space_id").alias("spaces"), F.count_distinct("dataset_id").alias("datasets"),
        F.min("learning_rate").alias("lr_min"), F.max("learning_rate").alias("lr_max"),
        F.min("num_layers").alias("l_min"), F.max("num_layers").alias("l_max"),
        F.min("epochs").alias("e_min"), F.max("epochs").alias("e_max"),
        F.min("val_accuracy").alias("a_min"), F.max("val_accuracy").alias("a_max"),
    ).first()
    assert (row["n"], row["ids"], row["spaces"], row["datasets"]) == (5000, 5000, 10, 50)
    assert 1e-5 <= row["lr_min"] < 2e-5 and 5e-2 < row["lr_max"] <= 1e-1
    assert (row["l_min"], row["l_max"], row["e_min"], row["e_max"]) == (1, 5, 10, 199)
    assert 0.5 <= row["a_min"] and row["a_max"] < 0.99
    assert found.exceptAll(src.generate_runs(spark, 5000).repartition(3)).count() == 0


def test_log_and_search(spark, tmp_path):
    path = str(tmp_path / "log")
    results = spark.createDataFrame([(1, 0.9), (2, 0.8)], "id int, best double")
    tracking.log_run(
        tracking.long_records(results, F.col("id"), F.lit("demo"), {"top_k": F.lit(3)}, {"best": F.col("best")},
                              {"plot": F.lit("p.png")}), path)
    tracking.log_run(
        tracking.long_records(results.where("id = 1"), F.col("id"), F.lit("demo"), metrics={"best": F.lit(0.95)}), path)
    log = tracking.read_log(spark, path)
    assert log.count() == 7
    found = tracking.search_runs(log)
    wide = tracking.metric_columns(found.select("run_id", "metrics"), ["best", "r2"])
    assert wide.columns == ["run_id", "metrics.best", "metrics.r2"]
    assert {tuple(r) for r in wide.collect()} == {("1", 0.95, None), ("2", 0.8, None)}
    kept = flt.drop_empty_columns(wide, ["metrics.best", "metrics.r2"])
    assert kept.columns == ["run_id", "metrics.best"]
    row = found.where("run_id = '1'").first()
    assert row["params"] == {"top_k": "3"} and row["artifacts"] == {"plot": "p.png"} and row["run_name"] == "demo"


def test_search_finds_every_key_and_the_state(spark, tmp_path):
    path = str(tmp_path / "log")
    events = spark.createDataFrame(
        [(1, "retry", 5.0, "2024-01-01 00:00:02"), (1, "retry", 4.0, "2024-01-01 00:00:01"), (1, "odd key.x", 1.0, "2024-01-01 00:00:03"), (2, "view", 2.0, "2024-01-02 00:00:00")],
        "id int, key string, value double, ts string",
    ).withColumn("ts", F.to_timestamp("ts"))
    tracking.log_run(tracking.metric_records(events, F.col("id"), F.lit("run"), F.col("key"), F.col("value"), F.col("ts")), path)
    done = spark.createDataFrame([(1,)], "id int")
    tracking.log_run(tracking.long_records(done, F.col("id"), F.lit("run"), status=F.lit("FINISHED")), path)
    found = tracking.search_runs(tracking.read_log(spark, path))
    got = {r["run_id"]: (r["metrics"], r["status"], str(r["start_time"])) for r in found.collect()}
    assert got == {
        "1": ({"retry": 5.0, "odd key.x": 1.0}, "FINISHED", "2024-01-01 00:00:01"), "2": ({"view": 2.0}, None, "2024-01-02 00:00:00"),
    }
    assert tracking.metric_columns(found.select("run_id", "metrics")).columns == ["run_id", "metrics.odd key.x", "metrics.retry", "metrics.view"]


def test_all_null_rows(spark):
    df = spark.createDataFrame([(1, None, None), (2, 0.1, None), (3, None, 0.2)], "id int, `m.a` double, `m.b` double")
    assert [r["id"] for r in flt.drop_all_null_rows(df, ["m.a", "m.b"]).orderBy("id").collect()] == [2, 3]


def test_inventory(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("12345")
    (tmp_path / "raw" / "b.csv").write_text("123")
    (tmp_path / "plain").write_text("1")
    files = storage.storage_inventory(spark, str(tmp_path))
    assert {(r["file"], r["file_type"], r["bytes"]) for r in files.collect()} == {("a.csv", "csv", 5), ("b.csv", "csv", 3), ("plain", None, 1)}
    sizes = {(r["directory"].rsplit("/", 1)[1], r["files"], r["bytes"]) for r in storage.bytes_by_directory(files).collect()}
    assert ("raw", 2, 8) in sizes


def test_profile_of_a_table(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in storage.profile_table(df).collect()] == [(0, "a", "int", 2, 2), (1, "b", "string", 2, 1)]


def test_constant_columns(spark):
    df = spark.createDataFrame([(0.1, 0.5, None), (0.2, 0.5, None)], "hp_0 double, hp_1 double, hp_2 double")
    assert flt.varying_columns(df, df.columns) == ["hp_0"]
    assert flt.drop_constant_hp(df, df.columns).columns == ["hp_0"]
    assert flt.varying_columns(df.limit(1), df.columns) == []


def test_approximate_distinct_counts(runs):
    exact, near = summ.distinct_counts(runs).first(), summ.distinct_counts(runs, approximate=True).first()
    assert abs(exact["datasets"] - near["datasets"]) <= 10


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Session:
    def __init__(self, master, **conf):
        self.conf = _Conf(conf)
        self.sparkContext = type("C", (), {"master": master})()


def test_shared_folder_is_the_one_the_cluster_names():
    assert session.shared_folder(_Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        session.shared_folder(_Session("yarn"))
    local = _Session("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_written_table_keeps_types(spark):
    df = spark.sql("SELECT 1 AS a, array(1.5D) AS v, struct('x' AS s) AS t, CAST(1.25 AS DECIMAL(18,6)) AS d, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts")
    back = session.written_table(df, "types")
    assert back.dtypes == df.dtypes and back.collect() == df.collect()
    assert isinstance(back.schema["ts"].dataType, T.TimestampNTZType)


def log_records(spark, runs):
    rows = [(str(r), f"run {r}", "metric", f"k{k}", None, float(r * k), dt.datetime(2024, 1, 1, k)) for r in runs for k in range(5)]
    rows += [(str(r), None, "param", "a:b", "1:-", None, None) for r in runs]
    return spark.createDataFrame(rows, schema.RUN_LOG)


def logged(spark, path):
    return sorted(map(str, tracking.read_log(spark, path).collect()))


def test_a_repeated_append_changes_nothing(spark):
    path, first, second = fresh_path(spark, "log"), log_records(spark, range(40)), log_records(spark, range(30, 60))
    tracking.log_run(first, path)
    once = logged(spark, path)
    assert len(once) == 240
    tracking.log_run(first.unionByName(first), path)
    assert logged(spark, path) == once
    tracking.log_run(second, path)
    assert logged(spark, path) == sorted(map(str, log_records(spark, range(60)).collect()))


def test_a_half_failed_append_is_completed(spark):
    path, records = fresh_path(spark, "log"), log_records(spark, range(50))
    # What an append leaves that was stopped between the files of its partitions.
    some = tracking.with_record_id(records).where("part % 3 = 0")
    some.write.partitionBy("part").parquet(path)
    tracking.log_run(records, path)
    assert logged(spark, path) == sorted(map(str, records.collect()))


def test_compaction_keeps_every_record_once(spark):
    path, target = fresh_path(spark, "log"), fresh_path(spark, "log")
    for k in range(5):
        tracking.log_run(log_records(spark, range(10 * k, 10 * k + 12)), path)
    # A copy that came by another way.
    tracking.with_record_id(log_records(spark, range(4))).write.mode("append").partitionBy("part").parquet(path)
    tracking.compact_log(spark, path, target)
    assert logged(spark, target) == sorted(map(str, log_records(spark, range(52)).collect()))
    files = lambda p: len(glob.glob(f"{p}/part=*/*.parquet"))
    assert files(target) < files(path)
    tracking.log_run(log_records(spark, range(52)), target)
    assert len(logged(spark, target)) == 52 * 6


def test_too_many_metrics_need_names(spark, monkeypatch):
    monkeypatch.setattr(tracking, "MOST_COLUMNS", 4)
    path = fresh_path(spark, "log")
    tracking.log_run(log_records(spark, range(3)), path)
    found = tracking.search_runs(tracking.read_log(spark, path))
    with pytest.raises(ValueError):
        tracking.metric_columns(found)
    assert "metrics.k1" in tracking.metric_columns(found, ["k1"]).columns


def test_runs_are_shuffled_once_to_be_nested(spark, runs):
    dealt = runs.withColumn("document", F.substring(F.md5("run_id"), 1, 2))
    documents = nested.nest_runs(dealt, "document", ["hp_0", "hp_1"], ["run_id"])
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    back = nested.flatten_documents(documents.select("value"))
    assert back.count() == runs.count() and back.agg(F.count_distinct("run_id")).first()[0] == back.count()


def test_documents_are_parsed_once_for_their_width(spark, tmp_path, monkeypatch):
    written, keep = [], nested.written_table
    monkeypatch.setattr(nested, "written_table", lambda df, label: written.append(label) or keep(df, label))
    path = str(tmp_path / "runs.jsonl")
    with open(path, "w") as file:
        file.write(json.dumps({"4": {"7": {"X": [[0.5, 1.0], [0.25]], "y": [[0.9], [0.8]]}}}) + "\n")
    found = nested.flatten_nested_runs(spark, path)
    assert "flat-runs" in written and found.columns[-2:] == ["hp_0", "hp_1"]
    assert sorted((r["hp_0"], r["hp_1"]) for r in found.collect()) == [(0.25, None), (0.5, 1.0)]
