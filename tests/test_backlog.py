"""Manifests by hand."""

import pytest

from fleetlake.plans.backlog import classify_backlog, expand_backlog, manifest, plan_batches

D = "0BFD7754"


def listing(spark, paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def files(device=D, sessions=2, count=3, extension="MF4"):
    return [f"{device}/{s:08d}/{n:08d}-6296186{n}.{extension}" for s in range(1, sessions + 1) for n in range(1, count + 1)]


def test_kinds(spark):
    entries = [D, f"{D}/", f"{D}/00000001", f"{D}/00000001/", f"{D}/00000001/1.MF4", f"{D}/1.MF4", "0bfd7754", f"{D}/0001", f"{D}/00000001/x.txt", "", "x/y/z.mfe"]
    rows = classify_backlog(manifest(spark, entries)).orderBy("pos").collect()
    assert [r.kind for r in rows] == ["device", "device", "session", "session", "file", "reject", "reject", "reject", "reject", "reject", "file"]
    assert [r.path for r in rows][:4] == [f"{D}/", f"{D}/", f"{D}/00000001/", f"{D}/00000001/"]


def expanded(spark, entries, paths):
    rows = expand_backlog(manifest(spark, entries), listing(spark, paths)).collect()
    return sorted(rows, key=lambda r: (r.session_pos, r.session, r.file_pos, r.path))


def test_overlapping_entries_give_each_file_once(spark):
    known = files()
    entries = [known[1], f"{D}/00000001/", D, known[1], "AAAAAAAA/00000009/lost.MF4"]
    rows = expanded(spark, entries, [*known, f"{D}/00000001/notes.txt", f"{D}/other/x.MF4", "FFFFFFFF/00000001/1.MF4"])
    assert [r.path for r in rows] == [*known, "AAAAAAAA/00000009/lost.MF4"]


@pytest.mark.parametrize("order", [0, 1])
def test_a_file_before_or_after_its_session_changes_nothing(spark, order):
    known = files(sessions=1)
    entries = [known[0], f"{D}/00000001/"][:: -1 if order else 1]
    assert [r.path for r in expanded(spark, entries, known)] == known


def test_named_files_keep_manifest_order(spark):
    known = files(sessions=1)
    assert [r.path for r in expanded(spark, known[::-1], known)] == known[::-1]


def batches(spark, entries, paths, **limits):
    files = expand_backlog(manifest(spark, entries), listing(spark, paths), len(entries))
    rows = plan_batches(files, len(entries), **limits).collect()
    plan = {}
    for r in sorted(rows, key=lambda r: (r.batch, r.place)):
        plan.setdefault(r.batch, []).append(r.path)
    return plan


def test_few_entries_are_regrouped_by_device(spark):
    paths = files(count=150) + files("AAAAAAAA", sessions=1)
    plan = batches(spark, [D, "AAAAAAAA"], paths, smallest=10, largest=256)
    assert {k: len(v) for k, v in plan.items()} == {f"{D}/0": 256, f"{D}/1": 44, "AAAAAAAA/0": 3}
    assert plan[f"{D}/0"] + plan[f"{D}/1"] == sorted(files(count=150))


def test_257_files_need_two_batches(spark):
    plan = batches(spark, [D], files(sessions=1, count=257), smallest=10, largest=256, always_split=True)
    assert sorted(len(v) for v in plan.values()) == [1, 256]


def test_many_entries_or_one_session_stay_batches_by_session(spark):
    plan = batches(spark, [D], files(sessions=1, count=300), smallest=10, largest=256)
    assert {k: len(v) for k, v in plan.items()} == {f"{D}/00000001": 300}
    plan = batches(spark, [D, D], files(), smallest=2, largest=256)
    assert sorted(plan) == [f"{D}/00000001", f"{D}/00000002"]
