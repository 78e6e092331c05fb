import re
from collections import defaultdict

from fleetlake.llm import line_dedup

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """Per row: doc_id, number of lines, dropped lines, text."""
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACES).translate(LOWER)
            if len(key) >= 40 and doc_id is not None:
                holders[key].add(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        keys = [line.strip(SPACES).translate(LOWER) for line in lines]
        gone = [doc_id is not None and len(holders[k]) >= 5 and max(holders[k]) != doc_id for k in keys]
        kept = "\n".join(line for line, g in zip(lines, gone) if not g)
        out.append((doc_id, len(lines), sum(gone), kept))
    return sorted(out, key=repr)


def test_awkward_rows(docs, rows):
    found = line_dedup.dedup_lines(docs).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found), key=repr) == brute(rows)
    assert any(r.n_dropped for r in found)


def test_bitmaps_are_runs_of_kept_lines(docs):
    for r in line_dedup.dedup_lines(docs).collect():
        assert sum(run.length for run in r.keep_runs) == r.n_lines - r.n_dropped
        assert all(a.start + a.length < b.start for a, b in zip(r.keep_runs, r.keep_runs[1:]))


def test_a_document_that_loses_all_lines_is_empty(spark):
    line = "x" * 40
    docs = spark.createDataFrame([(i, f"{line}\n {line.upper()}") for i in range(5)], "doc_id long, text string")
    found = {r.doc_id: (r.n_dropped, r.text) for r in line_dedup.dedup_lines(docs).collect()}
    assert found == {**{i: (2, "") for i in range(4)}, 4: (0, f"{line}\n {line.upper()}")}


def test_four_holders_or_39_points_lose_nothing(spark):
    rows = [(i, "é" * 39) for i in range(9)] + [(10 + i, "y" * 40) for i in range(4)] + [(10, "y" * 40)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup.dedup_lines(docs).collect()} == {0}


def test_no_rows(no_docs):
    assert line_dedup.dedup_lines(no_docs).collect() == []
    assert line_dedup.stage(no_docs).columns == no_docs.columns


def test_stage_keeps_columns_and_rows(docs, rows):
    after = line_dedup.stage(docs)
    assert after.dtypes == docs.dtypes
    found = after.collect()
    assert sorted((repr((r.doc_id, r.text or "")) for r in found)) == sorted(repr((a, t)) for a, _, _, t in brute(rows))
    assert all(r.n_chars == len(r.text or "") for r in found)
    assert sum(r.text is None for r in found) == sum(r[1] is None for r in rows)


def test_plan_is_native(docs):
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
