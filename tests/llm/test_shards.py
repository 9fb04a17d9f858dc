import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from helpers import awkward, frame, prose
from tessera.llm import shards


def check(rows, texts):
    size = {d: len((t or "").encode()) + 1 for d, t in texts}
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for r in rows:
        by_shard[r.shard].append(r)
        by_text[r.digest].add(r.shard)
        assert r.size == size[r.doc_id]
    assert all(len(s) == 1 for s in by_text.values())
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {s: sum(r.size for r in own) for s, own in by_shard.items()}


def brute(sizes, k):
    """The smallest capacity for contiguous runs, by plain binary search."""
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        runs, at = 1, 0
        for s in sizes:
            if at + s > mid:
                runs, at = runs + 1, 0
            at += s
        low, high = (low, mid) if runs <= k else (mid + 1, high)
    return low


def test_capacity_is_the_smallest(spark, monkeypatch):
    monkeypatch.setattr(shards, "CHUNK_GROUPS", 4)
    texts = [(i, prose(i, 1 + i * 37 % 50)) for i in range(300)]
    rows = shards.shard(frame(spark, texts), 7).collect()
    sums = check(rows, texts)
    groups = defaultdict(int)
    for r in rows:
        groups[r.digest] += r.size
    assert max(sums.values()) == brute([groups[d] for d in sorted(groups)], 7)


def test_a_third_in_one_group(spark):
    texts = [(i, prose(0, 30) if i % 3 == 0 else prose(i, 30)) for i in range(300)]
    sums = check(shards.shard(frame(spark, texts), 8).collect(), texts)
    assert len(sums) == 8
    others = sorted(sums.values())[:-1]
    assert max(others) - min(others) < 1500


def test_awkward_rows(spark):
    rows = shards.shard(frame(spark, extra="slot"), 4).collect()
    assert len(rows) == len(awkward())
    check(rows, awkward())
    assert all(r.text_crc32 == 0 and r.size == 1 for r in rows if r.doc_id in (3, 4))
    assert {r.text_crc32 for r in rows if r.doc_id == 1} == {zlib.crc32(prose(2, 120).encode())}


def test_empty_table(spark):
    assert shards.shard(frame(spark, []), 16).count() == 0


def test_query(spark, sf_dir):
    import __spark_entry__ as E

    got = E.queries()["op2_shards"](spark, sf_dir)
    sums = [r.b for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sums) == 16 and max(sums) < 1.5 * sum(sums) / 16
    assert got.filter("law <> 'bytes' or grown_shard is not null").count() == 0
