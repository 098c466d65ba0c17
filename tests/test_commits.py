import glob
import os
import shutil

import pytest

from corpusloom import programs
from corpusloom.sources import commits


def _write(folder, name, text, at=1_900_000_000):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    os.utime(path, (at, at))


@pytest.fixture()
def place(tmpdir_path):
    src, out, log = (os.path.join(tmpdir_path, x) for x in ("my txt", "out", "log"))
    os.makedirs(src)
    return src, out, log


def _build(spark, place):
    src, out, log = place
    rows = programs.build_pretraining_corpus(spark, src, out, block_size=64, test_size=0.0, log_path=log).collect()
    return {r.metric: r.value for r in rows}


def _texts(spark, place, **how):
    return {r.file: bytes(i - 3 for i in r.input_ids[1:]).decode() for r in programs.read_corpus(spark, *place[1:], **how).collect()}


def test_changed_emptied_and_deleted_files(spark, place):
    src, out, log = place
    for name in ("a.txt", "b c.txt", "d.txt", "e.txt"):
        _write(src, name, f"one {name[0]}\n")
    assert _build(spark, place)["train_samples"] == 4
    assert _build(spark, place) == {}  # nothing changed: no commit
    _write(src, "a.txt", "two a\n", 2_000_000_000)  # changed
    _write(src, "b c.txt", "", 2_000_000_000)       # emptied
    os.remove(os.path.join(src, "d.txt"))           # deleted
    assert _build(spark, place)["train_samples"] == 2
    assert _texts(spark, place) == {"a.txt": "two a", "e.txt": "one e"}
    # names are those of the files' metadata, where a space is %20
    assert _texts(spark, place, as_of=0) == {"a.txt": "one a", "b%20c.txt": "one b", "d.txt": "one d", "e.txt": "one e"}
    assert commits.unused_builds(spark, out, log).count() == 0  # e.txt still lives in the first build
    for name in ("a.txt", "b c.txt", "e.txt"):
        os.remove(os.path.join(src, name))
    assert _build(spark, place) == {"train_samples": None, "eval_samples": None}  # only tombstones: no rows left
    assert _texts(spark, place) == {} and commits.live_files(spark, log).count() == 0
    assert commits.unused_builds(spark, out, log).count() == 2
    _write(src, "d.txt", "again\n")  # a removed file may come back
    _build(spark, place)
    assert _texts(spark, place) == {"d.txt": "again"}


def _frame(spark, names, value):
    return spark.createDataFrame([(n, value) for n in names], "file string, v string")


def _values(spark, place):
    return {r.file: r.v for r in commits.read_live(spark, place[1], place[2], "file string, v string").collect()}


def _stop_while_staging(spark, plan, rows, out, log):
    commits.stage(rows, "file", out, "b-stopped")
    # the job died after a part of its files had arrived
    os.remove(sorted(glob.glob(f"{out}/build=b-stopped/*.parquet"))[0])


def _stop_before_commit(spark, plan, rows, out, log):
    commits.stage(rows, "file", out, "b-stopped")


def _stop_inside_commit(kept):
    def stop(spark, plan, rows, out, log):
        commits.stage(rows, "file", out, "b-stopped")
        commits.commit(plan.repartition(3, "file"), log, "b-stopped")
        parts = sorted(glob.glob(f"{log}/commit=1/build=b-stopped/*.parquet"),
                       key=lambda p: -spark.read.parquet(p).filter("action = 'head'").count())
        for p in parts[:1] if kept == "rows" else parts[1:]:  # without its head row; the head row alone
            os.remove(p)
    return stop


@pytest.mark.parametrize("stop", [_stop_while_staging, _stop_before_commit, _stop_inside_commit("rows"), _stop_inside_commit("head")])
def test_a_stop_between_or_inside_the_writes(spark, place, stop):
    src, out, log = place
    names = [f"{i}.txt" for i in range(6)]
    for n in names:
        _write(src, n, "x\n")

    def plan():
        return commits.plan_build(spark, src, log, "v1")

    def files(p):
        return [r.file for r in p.filter("action = 'add'").collect()]

    first = plan()
    keys = files(first)
    commits.commit(first, log, commits.stage(_frame(spark, keys, "old"), "file", out))
    for n in names[:4]:
        _write(src, n, "changed\n", 2_000_000_000)
    os.remove(os.path.join(src, names[5]))
    again = plan()
    changed = files(again)
    assert len(changed) == 4 and again.count() == 5
    stop(spark, again, _frame(spark, changed, "torn"), out, log)
    assert _values(spark, place) == dict.fromkeys(keys, "old")  # nothing of it is seen
    after = plan()
    assert sorted(files(after)) == sorted(changed) and after.count() == 5  # all of it is to do again
    n = commits.commit(after, log, commits.stage(_frame(spark, changed, "new"), "file", out))
    assert n == (2 if glob.glob(f"{log}/commit=1/build=b-stopped") else 1)
    gone = [k for k in keys if k.endswith("/5.txt")]
    assert _values(spark, place) == {k: "new" if k in changed else "old" for k in keys if k not in gone}
    assert plan().isEmpty()
    assert [r.build for r in commits.unused_builds(spark, out, log).collect()] == ["b-stopped"]


def test_a_number_taken_twice(spark, place):
    src, out, log = place
    _write(src, "a.txt", "x\n")
    plan = commits.plan_build(spark, src, log, "v1")
    key = plan.first().file
    for build in ("b-2", "b-1"):
        commits.stage(_frame(spark, [key], build), "file", out, build)
    commits.commit(plan, log, "b-1")
    # the other writer had read the log before: it writes the same number
    shutil.copytree(f"{log}/commit=0/build=b-1", f"{log}/commit=0/build=b-2")
    assert _values(spark, place) == {key: "b-1"}
    assert commits.complete_commits(spark.read.schema(commits.LOG_SCHEMA).parquet(log)).count() == 1


def test_the_later_writer_of_a_number_is_told(spark, place, monkeypatch):
    src, out, log = place
    _write(src, "a.txt", "x\n")
    plan = commits.plan_build(spark, src, log, "v1")
    commits.commit(plan, log, "b-1")
    real, calls = commits._read, []

    def stale(spark, path, schema):  # the first look at the log is one from before b-1
        calls.append(path)
        return spark.createDataFrame([], schema) if len(calls) == 1 else real(spark, path, schema)

    monkeypatch.setattr(commits, "_read", stale)
    with pytest.raises(commits.CommitConflict):
        commits.commit(plan, log, "b-2")


def test_other_configuration_builds_again_and_a_missing_folder_removes_nothing(spark, place):
    src, out, log = place
    _write(src, "a.txt", "x\n")
    commits.commit(commits.plan_build(spark, src, log, "v1"), log, "b-1")
    assert commits.plan_build(spark, src, log, "v1").isEmpty()
    assert [r.action for r in commits.plan_build(spark, src, log, "v2").collect()] == ["add"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        commits.plan_build(spark, src + "-gone", log, "v1")


def test_an_unreadable_log_is_no_empty_one(spark, place):
    src, out, log = place
    os.makedirs(f"{log}/commit=0/build=b-1")
    _write(f"{log}/commit=0/build=b-1", "part-0.parquet", "no parquet")
    with pytest.raises(Exception):
        commits.live_files(spark, log).count()
