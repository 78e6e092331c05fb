import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlake.llm import sharding


def jump(key: str, shards: int) -> int:
    at, land = -1, 0
    while land < shards:
        at = land
        digits = hashlib.md5(f"{key}:{at}".encode()).hexdigest()[:13]
        land = int((at + 1) / ((int(digits, 16) + 1.0) / (1 << 52)))
    return at


def test_awkward_rows(docs, rows):
    found = sharding.shard_documents(docs, 24).collect()
    expected = []
    for doc_id, text, *_ in rows:
        key, data = "" if doc_id is None else str(doc_id), (text or "").encode()
        expected.append((doc_id, len(data) + 8, zlib.crc32(data), "key", jump(key, 24), jump(key, 25)))
    assert sorted(map(repr, expected)) == sorted(repr((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard)) for r in found)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("shards", [1, 2, 7, 300])
def test_growth_moves_rows_into_the_new_shard_only(spark, shards):
    rows = spark.range(20_000).withColumn("text", F.lit("x"))
    found = sharding.shard_documents(rows.withColumnRenamed("id", "doc_id"), shards).collect()
    assert all(r.grown_shard in (r.shard, shards) for r in found)
    moved = sum(r.grown_shard != r.shard for r in found)
    assert moved == pytest.approx(20_000 / (shards + 1), rel=0.35)
    counts = Counter(r.shard for r in found)
    assert set(counts) == set(range(shards))
    if shards < 10:
        assert max(counts.values()) < 1.1 * 20_000 / shards


def test_no_rows(no_docs):
    assert sharding.shard_documents(no_docs).collect() == []


def test_plan_is_native(docs):
    assert not re.search("Python|Pandas|Arrow", sharding.shard_documents(docs)._jdf.queryExecution().toString())


def test_no_shards():
    with pytest.raises(ValueError):
        sharding.jump_shard(F.lit("x"), 0)
