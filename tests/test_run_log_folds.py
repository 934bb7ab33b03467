"""The run log before, between and after folds."""

from datetime import datetime, timedelta

from starloom.operators import runlog

START = datetime(2024, 1, 1)


def reports(spark, path):
    return sorted((tuple(r) for r in runlog.read_runs(spark, path).collect()), key=repr)


def log(spark, path, numbers, tail):
    ticks = iter(range(1_000_000))
    before, runlog.LONGEST_TAIL = runlog.LONGEST_TAIL, tail
    try:
        for i in numbers:
            clock = lambda i=i: START + timedelta(hours=i, seconds=next(ticks))
            try:
                with runlog.logged_run(spark, path, "silver", f"t{i}", None, clock) as run:
                    run.row_count_in = i
                    run.transformation("step", {"n": i})
                    if i % 5 == 0:
                        raise RuntimeError("no")
            except RuntimeError:
                pass
    finally:
        runlog.LONGEST_TAIL = before


def test_folds_keep_every_run(spark, tmp_path):
    path = str(tmp_path / "log")
    assert runlog.compact_runs(spark, path) is False
    assert reports(spark, path) == []
    log(spark, path, range(6), 1000)
    still = runlog.Run("gold", "open", None, datetime.now)
    runlog.append_run(spark, path, still, START, None, "running")
    seen = reports(spark, path)
    assert len(seen) == 7
    for _ in range(3):
        assert runlog.compact_runs(spark, path) is (_ == 0)
        assert reports(spark, path) == seen
    # A run that was open when the log was folded ends later.
    runlog.append_run(spark, path, still, START, START + timedelta(days=1), "success")
    found = {r["table_name"]: r["status"] for r in runlog.read_runs(spark, path).collect()}
    assert found == {"open": "success", **{f"t{i}": "failed" if i % 5 == 0 else "success" for i in range(6)}}
    seen = reports(spark, path)
    assert runlog.compact_runs(spark, path)
    assert reports(spark, path) == seen


def test_a_long_log_has_few_files(spark, tmp_path):
    path = tmp_path / "log"
    log(spark, str(path), range(30), 8)
    assert len(reports(spark, str(path))) == 30
    assert len(list(path.glob("*.parquet"))) <= 20
    assert len(list(path.glob("_folded/*"))) <= 2
    assert len(list(path.glob("_folds/*.json"))) <= 2


def test_a_fold_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    log(spark, path, range(3), 1000)
    seen = reports(spark, path)
    monkeypatch.setattr(runlog, "create_new", lambda *_: False)
    assert runlog.compact_runs(spark, path) is False
    assert reports(spark, path) == seen
    monkeypatch.undo()
    runlog.last_states(runlog.read_runs(spark, path).limit(1)).write.parquet(f"{path}/{runlog.FOLDED}/000000001-lost")
    assert reports(spark, path) == seen
    assert runlog.compact_runs(spark, path)
    assert reports(spark, path) == seen
