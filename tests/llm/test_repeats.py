import random

import pytest

from fleetlake.llm import repeats

from .helpers import documents, prose


def brute(rows, length=50):
    """Kept bytes and spans per row, by listing all strings of the length."""
    first = {}
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1 if doc_id is not None else 0):
            s = data[i : i + length]
            first[s] = min(first.get(s, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1 if doc_id is not None else 0):
            if first[data[i : i + length]] < doc_id:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        starts = [i for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1])]
        stops = [i + 1 for i in range(len(data)) if gone[i] and (i + 1 == len(data) or not gone[i + 1])]
        out.append((doc_id, len(data), list(zip(starts, stops)), kept))
    return sorted(out, key=repr)


def found(docs, **options):
    rows = repeats.remove_repeats(docs, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows), key=repr)


def test_awkward_rows(docs, rows):
    assert found(docs) == brute(rows)


def test_pasted_passages_of_all_lengths(spark, monkeypatch):
    """Passages from 45 to 80 bytes, many chunks, small pieces."""
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 3000)
    rnd = random.Random(7)
    passages = [prose(rnd, 30)[: rnd.randint(45, 80)] for _ in range(40)]
    rows = []
    for i in range(120):
        parts = [prose(rnd, rnd.randint(0, 12))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            cut = rnd.randint(0, 12)
            parts += [p[cut:] if rnd.random() < 0.3 else p, prose(rnd, rnd.randint(0, 6))]
        rows.append((200 - i, "".join(parts), "en", "s", 0))
    assert any(spans for _, _, spans, _ in brute(rows))
    assert found(documents(spark, rows)) == brute(rows)
    # More buckets than tasks.
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 200)
    assert found(documents(spark, rows)) == brute(rows)


def test_periodic_text_and_other_lengths(spark):
    rnd = random.Random(5)
    rows = [(1, "ab" * 200, "", "", 0), (2, "ba" * 100 + "x" + "ab" * 30, "", "", 0), (3, "a" * 90, "", "", 0), (4, "b" + "a" * 49 + "b" + "a" * 50, "", "", 0)]
    rows += [(10 + i, prose(rnd, 25) + "the same few words in each of them, " + prose(rnd, 4), "", "", 0) for i in range(6)]
    docs = documents(spark, rows)
    for length in (32, 50, 101):
        assert found(docs, length=length) == brute(rows, length)


def test_no_rows(no_docs):
    assert found(no_docs) == []


def test_lengths_out_of_range(no_docs):
    with pytest.raises(ValueError):
        repeats.remove_repeats(no_docs, length=31)


def test_texts_are_shuffled_once(spark):
    df = repeats.remove_repeats(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 2
