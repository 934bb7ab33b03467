import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.operators import cleaning, facts, quality, runlog
from starloom.plans import athlete_results as results
from starloom.plans import silver
from starloom.plans.specs import CleaningConfig
from starloom.plans.star import QualityGateError, build_star, create_star, load_star, read_star
from starloom.sources import ingest, layers, staging, warehouse
from starloom.sources.warehouse import manifest

DAY1, DAY2, DAY3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
HEADER = '"ID","Name","Sex","Age","Height","Weight","Team","NOC","Games","Year","Season","City","Sport","Event","Medal"'


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


REGIONS_CSV = '''NOC,region,notes
AAA,Aland,first
BBB,"Bonaire, Saba",second
CCC,NA,third
DDD,Dora,
EEE,Eland,"said ""no"""
'''


def test_csv_markers_quotes_and_types(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(REGIONS_CSV)
    read = ingest.read_csv(spark, str(path), results.REGIONS_CONTRACT.schema())
    assert rows(read) == [
        ("AAA", "Aland", "first"),
        ("BBB", "Bonaire, Saba", "second"),
        ("CCC", None, "third"),
        ("DDD", "Dora", None),
        ("EEE", "Eland", 'said "no"'),
    ]
    path.write_text("i,d,b,s,none,id\n1,1.5,True,x,,1D\nNA,2,false,n/a,NULL,2D\n3,-1e3,,y,nan,3D\n")
    inferred = ingest.read_csv(spark, str(path))
    assert dict(inferred.dtypes) == {
        "i": "bigint", "d": "double", "b": "boolean", "s": "string", "none": "string", "id": "string"
    }
    assert rows(inferred, "i", "d", "b", "s")[0] == (1, 1.5, True, "x")


def test_file_order_is_recorded(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text("n\n" + "\n".join(str(i) for i in range(5000)) + "\n")
    with_order = ingest.read_csv(spark, str(path), record_order=True)
    assert [r.n for r in with_order.orderBy(*ingest.FILE_ORDER).collect()] == list(range(5000))


@pytest.mark.parametrize("fmt", layers.FORMATS)
def test_ingest_frames_and_rows(spark, tmp_path, fmt):
    given = [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    root = str(tmp_path)
    from_rows = ingest.ingest(spark, given, root, "t", DAY1, fmt)
    assert rows(from_rows) == [(1, "x", DAY1, "raw_ingestion"), (2, None, DAY1, "raw_ingestion")]
    ingest.ingest(spark, spark.createDataFrame(given).limit(1), root, "t", DAY2, fmt)
    both = layers.read_layer(spark, root, "t", from_rows.schema, fmt)
    assert both.count() == 3
    newest = layers.read_newest(spark, root, "t", from_rows.schema, fmt)
    assert rows(newest, "a", "_batch_id") == [(1, "20240102_000000_000000")]
    ingest.ingest(spark, spark.createDataFrame(given), root, "t", DAY2, fmt)
    assert layers.read_layer(spark, root, "t", from_rows.schema, fmt).count() == 4


def test_bad_sources_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        ingest.ingest(spark, [], str(tmp_path), "t", DAY1)
    with pytest.raises(ValueError, match="cannot ingest"):
        ingest.ingest(spark, 5, str(tmp_path), "t", DAY1)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest.ingest(spark, str(tmp_path / "absent.csv"), str(tmp_path), "t", DAY1)
    with pytest.raises(ValueError, match="unknown format"):
        ingest.ingest(spark, [{"a": 1}], str(tmp_path), "t", DAY1, "xlsx")


def test_staging_uses_the_folder_of_the_session(spark):
    folder = staging.shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert folder == named or named is None
    staged = staging.stage(spark.range(3))
    assert staged.inputFiles()[0].replace("file://", "").startswith(folder.replace("file:", ""))


def test_silver_process_counts_what_it_removed(spark, tmp_path):
    data = [(i, float(i % 10), "x") for i in range(100)] * 2 + [(1000, None, "x"), (1001, 1e6, "x")]
    raw = ingest.stamp(spark.createDataFrame(data, "`My Id` bigint, ` Value` double, s string"), DAY1)
    config = CleaningConfig(
        type_mapping={"s": "int", "my_id": "float"},
        remove_outliers=True,
        outlier_columns=("value",),
        transformations=(lambda df: df.filter("my_id < 50"), lambda df: df.withColumn("twice", F.col("my_id") * 2)),
    )
    done = silver.process(raw, str(tmp_path), "t", config, DAY2)
    assert rows(done.issues) == [
        ("duplicates", 100, "rows removed"), ("missing_values", 1, "drop"), ("outliers", 1, "rows removed")
    ]
    assert (done.rows_in, done.rows_out) == (202, 50)
    assert done.table.columns == [
        "my_id", "value", "s", "_ingestion_timestamp", "_source_system", "twice", "_processing_timestamp", "_layer"
    ]
    assert dict(done.table.dtypes)["my_id"] == "double" and dict(done.table.dtypes)["s"] == "string"


@pytest.mark.parametrize("strategy", ["drop", "fillna_mean", "fillna_forward", "fillna_value"])
def test_silver_strategies(spark, tmp_path, strategy):
    raw = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, None), (3, 3.0)], "n int, v double")
    config = CleaningConfig(missing_strategy=strategy, order_by=("n",), fill_value=-1.0)
    done = silver.process(raw, str(tmp_path), "t", config, DAY1)
    filled = {"drop": [], "fillna_mean": [2.0], "fillna_forward": [1.0], "fillna_value": [-1.0]}[strategy]
    assert [r.v for r in done.table.filter("n = 2").collect()] == filled
    assert rows(done.issues) == [("duplicates", 1, "rows removed"), ("missing_values", 1, strategy)]


def athletes_csv(path, seed, ids, n=120, team="T"):
    draw = random.Random(seed)
    lines = [HEADER]
    for _ in range(n):
        year = draw.choice([1992, 1996, 2000])
        event = draw.randint(1, 4)
        quoted = [draw.choice(ids), 'A ""B""', "M"]
        numbers = [draw.choice([20, 30]), draw.choice(["NA", 170, 180, 185]), draw.choice([70, 80])]
        names = [team, draw.choice(["AAA", "BBB", "EEE", "ZZZ"]), f"{year} Summer"]
        rest = ["Summer", "City", f"Sport{event % 2}", f"Event {event}"]
        medal = draw.choice(["NA", "Gold", "Silver"])
        fields = [f'"{v}"' for v in quoted] + numbers + [f'"{v}"' for v in names] + [year]
        lines.append(",".join(map(str, [*fields, *[f'"{v}"' for v in rest], medal])))
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def loads(spark, tmp_path_factory):
    """Three batches: first; a later one with new athletes and a changed region; that one again."""
    folder = tmp_path_factory.mktemp("warehouse")
    root = str(folder / "w")
    regions = folder / "regions.csv"
    regions.write_text(REGIONS_CSV)
    first = athletes_csv(folder / "a1.csv", 1, range(1, 20))
    second = athletes_csv(folder / "a2.csv", 2, range(10, 40), team="U")
    changed = folder / "regions2.csv"
    changed.write_text(REGIONS_CSV.replace("Aland", "Oland"))
    done = [results.run(spark, first, str(regions), root, DAY1)]
    done.append(results.run(spark, second, str(changed), root, DAY2, checks=results.warehouse_checks(), min_pass_rate=0.8))
    done.append(results.run(spark, second, str(changed), root, DAY3))
    return root, done


def test_counts_of_the_loads(spark, loads):
    root, (first, second, third) = loads
    assert first.stats["mode"] == "full" and first.stats["new_rows"] == first.fact.count()
    stats = second.stats
    assert stats["mode"] == "incremental"
    assert 0 < stats["appended_rows"] == stats["new_rows"] - stats["duplicate_keys_skipped"]
    assert third.stats["appended_rows"] == 0 and third.stats["duplicate_keys_skipped"] == stats["new_rows"]
    assert manifest(spark, f"{root}/gold").count() == 3


def test_keys_stay_unique_and_dense(spark, loads):
    tables = read_star(spark, results.STAR, f"{loads[0]}/gold")
    keys = {d.name: d.key for d in results.STAR.dimensions} | {results.FACT: "result_key"}
    for name, key in keys.items():
        found = sorted(r[0] for r in tables[name].select(key).collect())
        assert found == list(range(1, len(found) + 1)), name


def test_history_and_overwrite(spark, loads):
    tables = read_star(spark, results.STAR, f"{loads[0]}/gold")
    versions = rows(tables["dim_country"].filter("noc = 'AAA'"), "region", "is_current")
    assert versions == [("Aland", False), ("Oland", True)]
    assert tables["dim_athlete"].filter("id = 30 AND team = 'T'").isEmpty()
    assert rows(tables["dim_athlete"].select("team").distinct()) == [("T",), ("U",)]


def test_suite_over_the_tables(spark, loads):
    tables = read_star(spark, results.STAR, f"{loads[0]}/gold")
    raw = quality.run_suite(tables, results.warehouse_checks(history_aware=False))
    assert raw.count() == 27
    # The history of one code fails the check over all versions; few athletes fail the row count.
    assert sorted(r.position for r in raw.filter("not passed").collect()) == [1, 9]
    aware = quality.run_suite(tables, results.warehouse_checks())
    assert sorted(r.position for r in aware.filter("not passed").collect()) == [1]


def test_log_of_the_runs(spark, loads):
    report = runlog.run_report(runlog.read_runs(spark, f"{loads[0]}/logs/runs"))
    assert report.count() == 9
    assert {r.layer for r in report.collect()} == {"bronze", "silver", "gold"}
    latest = runlog.latest_checkpoint(runlog.read_checkpoints(spark, f"{loads[0]}/logs/checkpoints")).first()
    assert latest.new_rows_processed == 0 and latest.fact_table_size == loads[1][2].fact.count()


def small_star(spark, fact_rows):
    athletes = spark.createDataFrame(
        [(i, f"n{i}", "M", 20.0, 170.0, 70.0, "T", noc, "G", 2000, "S", "C", "Sp", event, medal, i, 0, 0)
         for i, noc, event, medal in fact_rows],
        "id bigint, name string, sex string, age double, height double, weight double, team string, noc string, "
        "games string, year bigint, season string, city string, sport string, event string, medal string, "
        "_source_file int, _source_offset int, _source_row int",
    )
    regions = spark.createDataFrame([("A", "a", None, 0, 0, 0), ("B", "b", None, 0, 0, 0)],
                                    "noc string, region string, notes string, _source_file int, _source_offset int, _source_row int")
    return {results.ATHLETES: athletes, results.REGIONS: regions}


def test_unmatched_rows_drop_before_numbering_and_null_events_match(spark):
    sources = small_star(spark, [(1, "A", "e", "Gold"), (2, "?", "e", None), (3, "B", None, None)])
    dims, fact = build_star(sources, results.STAR, DAY1)
    assert sorted(r.result_key for r in fact.collect()) == [1, 2]
    assert rows(fact, "medal", "medal_flag") == [("Gold", 1), (None, 0)]
    assert dims["dim_event"].count() == 2


def test_replayed_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    sources = small_star(spark, [(1, "A", "e", None), (2, "A", "e", None)])
    load_star(sources, results.STAR, root, DAY1)
    more = small_star(spark, [(2, "A", "e", None), (3, "A", "f", None)])
    for _ in range(2):
        loaded = load_star(more, results.STAR, root, DAY2)
        assert loaded.stats["appended_rows"] == 1
    assert read_star(spark, results.STAR, root)[results.FACT].count() == 3
    assert manifest(spark, root).count() == 2
    with pytest.raises(ValueError, match="later than"):
        load_star(more, results.STAR, root, DAY1)


def test_overlap_with_copies_inside_the_batch(spark, tmp_path):
    first = [(i, "A", "e", None) for i in range(5)]
    batch = [(0, "A", "e", None), (1, "A", "e", None), (2, "A", "e", None), (7, "A", "e", None), (8, "A", "e", None), (8, "B", "e", None)]
    for dedup, appended in ((False, 3), (True, 2)):
        root = str(tmp_path / str(dedup))
        load_star(small_star(spark, first), results.STAR, root, DAY1)
        loaded = load_star(small_star(spark, batch), results.STAR, root, DAY2, dedup_batch=dedup)
        assert loaded.stats["appended_rows"] == appended
        assert loaded.fact.select("result_key").distinct().count() == 5 + appended


def test_unseen_facts_match_missing_parts_of_the_grain(spark):
    old = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    new = spark.createDataFrame([(1, None), (2, None), (None, "b"), (None, "b"), (2, "b")], "a int, b string")
    assert rows(facts.unseen_facts(old, new, ("a", "b"))) == sorted([(2, None), (None, "b"), (None, "b")], key=repr)
    assert rows(facts.unseen_facts(old, new, ("a", "b"), dedup_batch=True)) == sorted([(2, None), (None, "b")], key=repr)
    assert facts.unseen_facts(new, new, ("a", "b")).isEmpty()


def test_part_of_a_loaded_batch_with_new_rows(spark, tmp_path):
    first = small_star(spark, [(i, "A", f"e{i % 3}", None) for i in range(30)])
    load_star(first, results.STAR, str(tmp_path), DAY1)
    new = small_star(spark, [(i, "B", "e9", None) for i in range(100, 104)])
    some = first[results.ATHLETES].sample(0.5, seed=7)
    batch = some.unionByName(new[results.ATHLETES].orderBy("id").limit(3)).distinct()
    stats = load_star({**first, results.ATHLETES: batch}, results.STAR, str(tmp_path), DAY2).stats
    assert (stats["appended_rows"], stats["duplicate_keys_skipped"]) == (3, some.count())


def test_run_takes_frames_and_rows(spark, tmp_path):
    athletes = [
        {"ID": 1, "Name": name, "Sex": "F", "Age": 20.0, "Height": 170.0, "Weight": 60.0, "Team": "T", "NOC": "A",
         "Games": "G", "Year": 2000, "Season": "S", "City": "C", "Sport": "Sp", "Event": name, "Medal": "Gold"}
        for name in ("first", "last")
    ]
    regions = spark.createDataFrame([("A", "a", "n")], "NOC string, region string, notes string")
    loaded = results.run(spark, athletes, regions, str(tmp_path), DAY1)
    with pytest.raises(QualityGateError, match="contracts"):
        results.run(spark, athletes, regions, str(tmp_path / "strict"), DAY1, enforce_contracts=True)
    assert rows(loaded.dims["dim_athlete"], "name") == [("last",)]
    assert loaded.stats["new_rows"] == 2
    log = runlog.read_runs(spark, f"{tmp_path}/logs/runs").filter("layer = 'bronze'").first()
    assert log.source == "list, DataFrame"


def test_failed_gate_leaves_the_warehouse_as_it_was(spark, tmp_path):
    root = str(tmp_path)
    load_star(small_star(spark, [(1, "A", "e", None)]), results.STAR, root, DAY1)
    with pytest.raises(QualityGateError):
        load_star(small_star(spark, [(2, "A", "e", None)]), results.STAR, root, DAY2,
                  checks=[quality.RowCount(results.FACT, 1000)])
    assert read_star(spark, results.STAR, root)[results.FACT].count() == 1
    assert load_star(small_star(spark, [(3, "A", "e", None)]), results.STAR, root, DAY3).stats["appended_rows"] == 1
    assert sorted(r.result_key for r in read_star(spark, results.STAR, root)[results.FACT].collect()) == [1, 2]


def test_failed_replay_leaves_the_promoted_batch(spark, tmp_path):
    root = str(tmp_path)
    load_star(small_star(spark, [(i, "A", "e", None) for i in range(5)]), results.STAR, root, DAY1)
    with pytest.raises(QualityGateError):
        load_star(small_star(spark, [(9, "A", "e", None)]), results.STAR, root, DAY1, checks=[quality.RowCount(results.FACT, 1000)])
    tables = read_star(spark, results.STAR, root)
    assert tables[results.FACT].count() == 5 and tables["dim_athlete"].count() == 5


def test_driver_lost_before_promotion(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    load_star(small_star(spark, [(1, "A", "e", None)]), results.STAR, root, DAY1)

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr("starloom.plans.star.promote", lost)
        with pytest.raises(KeyboardInterrupt):
            load_star(small_star(spark, [(2, "A", "e", None)]), results.STAR, root, DAY2)
    assert read_star(spark, results.STAR, root)[results.FACT].count() == 1
    assert load_star(small_star(spark, [(2, "A", "e", None)]), results.STAR, root, DAY2).stats["appended_rows"] == 1
    assert read_star(spark, results.STAR, root)[results.FACT].count() == 2
    # The folders of the lost attempt are no longer needed and go on request.
    tables = {d.name: False for d in results.STAR.dimensions} | {results.FACT: True}
    gone = warehouse.remove_superseded(spark, root, tables)
    assert len([g for g in gone if results.FACT in g]) == 1
    left = read_star(spark, results.STAR, root)
    assert left[results.FACT].count() == 2 and left["dim_athlete"].count() == 2


def test_two_loads_within_a_second(spark, tmp_path):
    root = str(tmp_path)
    load_star(small_star(spark, [(1, "A", "e", None)]), results.STAR, root, DAY1)
    soon = DAY1.replace(microsecond=800_000)
    assert load_star(small_star(spark, [(2, "A", "e", None)]), results.STAR, root, soon).stats["mode"] == "incremental"
    assert read_star(spark, results.STAR, root)[results.FACT].count() == 2


def test_two_loads_from_one_base(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    load_star(small_star(spark, [(1, "A", "e", None)]), results.STAR, root, DAY1)
    real = warehouse.promote

    def beaten(*given):
        monkeypatch.undo()
        load_star(small_star(spark, [(2, "A", "e", None)]), results.STAR, root, DAY2)
        real(*given)

    monkeypatch.setattr("starloom.plans.star.promote", beaten)
    with pytest.raises(warehouse.MovedBaseError):
        load_star(small_star(spark, [(3, "A", "e", None)]), results.STAR, root, DAY3)
    tables = read_star(spark, results.STAR, root)
    assert rows(tables[results.FACT], "result_key") == [(1,), (2,)]


@pytest.mark.parametrize("fmt", layers.FORMATS)
def test_warehouse_formats(spark, tmp_path, fmt):
    root = str(tmp_path)
    load_star(small_star(spark, [(1, "A", "e\n\"x\"", None), (2, "B", "", "Gold")]), results.STAR, root, DAY1, fmt=fmt)
    load_star(small_star(spark, [(2, "B", "", "Gold"), (3, "B", None, " ")]), results.STAR, root, DAY2, fmt="parquet")
    tables = read_star(spark, results.STAR, root)
    assert rows(tables[results.FACT], "result_key", "medal") == [(1, None), (2, "Gold"), (3, " ")]
    assert rows(tables["dim_event"], "event") == sorted([("e\n\"x\"",), ("",), (None,)], key=repr)


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('NOC,region,notes\nAAA,"two\nlines",x\nBBB,plain,y\n')
    with pytest.raises(ValueError, match="multiLine"):
        ingest.read_csv(spark, str(path))
    raw = ingest.ingest(spark, str(path), str(tmp_path), "t", DAY1, options={"multiLine": True})
    assert rows(raw, "NOC", "region") == [("AAA", "two\nlines"), ("BBB", "plain")]


@pytest.mark.parametrize("fmt", layers.FORMATS)
def test_layers_give_back_what_they_got(spark, tmp_path, fmt):
    given = [("a\nb", 1), ("", 2), (None, 3), ("\\N", 4), ("\\\\", 5), (' "q", ', 6), ("NULL", 7), ("\r\n", 8), ('"', 9)]
    df = spark.createDataFrame(given, "s string, n int").withColumn("t", F.lit("2024-01-01 00:00:00.123456").cast("timestamp_ntz"))
    layers.write_layer(df, str(tmp_path), "t", DAY1, fmt)
    assert rows(layers.read_layer(spark, str(tmp_path), "t", df.schema, fmt, DAY1)) == rows(df)


def test_misfits(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    fitted, failed = cleaning.coerce_types(df, {"v": "int"}, "sibling")
    assert rows(fitted) == sorted([(1, None), (None, "x"), (None, None)], key=repr) and failed == []
    with pytest.raises(ValueError, match="do not fit"):
        cleaning.coerce_types(df, {"v": "int"}, "fail")
    with pytest.raises(ValueError, match="on_misfit"):
        cleaning.coerce_types(df, {"v": "int"}, "drop")


def test_run_states(spark, tmp_path):
    path = str(tmp_path / "runs")
    with runlog.logged_run(spark, path, "bronze", "t") as run:
        assert [r.status for r in runlog.read_runs(spark, path).collect()] == ["running"]
        run.error("one file was skipped")
    with pytest.raises(ZeroDivisionError), runlog.logged_run(spark, path, "silver", "t"):
        1 / 0  # noqa: B018
    found = {r.layer: r for r in runlog.read_runs(spark, path).collect()}
    assert (found["bronze"].status, found["bronze"].errors) == ("partial", ["one file was skipped"])
    assert found["silver"].status == "failed" and found["silver"].end_time is not None


def test_checkpoints_of_one_time(spark, tmp_path):
    path = str(tmp_path / "c")
    runlog.store_checkpoint(spark, path, 100, 100, DAY1, 1, "b1")
    runlog.store_checkpoint(spark, path, 40, 5, DAY1, 2, "b2")
    assert runlog.latest_checkpoint(runlog.read_checkpoints(spark, path)).first().fact_table_size == 40
    runlog.store_checkpoint(spark, path, 41, 6, DAY1, 3, "b2")
    assert runlog.read_checkpoints(spark, path).count() == 2


def test_create_star_summary(spark, tmp_path):
    sources = small_star(spark, [(1, "A", "e", None), (2, "B", "f", None)])
    _, fact, summary = create_star(sources, results.STAR, str(tmp_path), DAY1)
    assert {r.table: r.row_count for r in summary.collect()} == {
        "dim_athlete": 2, "dim_country": 2, "dim_event": 2, "dim_games": 1, results.FACT: 2
    }
    # A second full build takes the place of the first; later loads add to the second.
    create_star(small_star(spark, [(9, "A", "g", None)]), results.STAR, str(tmp_path), DAY2)
    tables = read_star(spark, results.STAR, str(tmp_path))
    assert rows(tables[results.FACT], "result_key") == [(1,)] and rows(tables["dim_athlete"], "id") == [(9,)]
    load_star(sources, results.STAR, str(tmp_path), DAY3, check_new_facts_only=True,
              checks=[quality.RowCount(results.FACT, 1)])
    assert rows(read_star(spark, results.STAR, str(tmp_path))[results.FACT], "result_key") == [(1,), (2,), (3,)]


def test_rollup(spark):
    sources = small_star(spark, [(1, "A", "e", "Gold"), (2, "B", "e", None), (3, "B", "e", "Gold")])
    dims, fact = build_star(sources, results.STAR, DAY1)
    fact = fact.withColumn("age", F.when(F.col("medal").isNotNull(), F.col("age")))
    by = {"dim_country": ["region"], "dim_games": ["year"]}
    expected = [("a", 2000, 1, 20.0, 170.0, 1), ("b", 2000, 2, 20.0, 170.0, 1)]
    for large in ((), ("dim_country",), tuple(by)):
        rolled = facts.star_rollup(fact, dims, results.STAR, by, ["age", "height"], ["medal_flag"], fold_first=large)
        assert rows(rolled, "region", "year", "fact_rows", "avg_age", "avg_height", "sum_medal_flag") == expected
