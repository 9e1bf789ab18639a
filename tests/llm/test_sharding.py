import hashlib
import random
import zlib

import pytest

from orderflow.llm import sharding
from orderflow.llm.queries import op2_sharding


def smallest_capacity(sizes, shards):
    """The smallest capacity that a greedy pass over the sizes fits into the shards."""

    def fits(capacity):
        used, room = 0, 0
        for size in sizes:
            if size > capacity:
                return False
            if size > room:
                used, room = used + 1, capacity
            room -= size
        return used <= shards

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def grouped(texts):
    sizes = {}
    for text in texts:
        key = hashlib.md5((text or "").encode()).hexdigest()
        sizes[key] = sizes.get(key, 0) + len((text or "").encode()) + 16
    return sizes


@pytest.mark.parametrize("seed, count, most", [(1, 3000, 200), (2, 300, 20_000), (3, 45, 9), (4, 12, 5)])
def test_same_as_a_pass_over_all_groups(spark, monkeypatch, seed, count, most):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 1)
    draw = random.Random(seed)
    texts = [str(n) * draw.randint(1, most) for n in range(count)]
    groups = spark.createDataFrame(list(grouped(texts).items()), "key string, size long")
    plan = sharding.plan(groups, 40)
    sizes = grouped(texts)
    rest = [sizes[k] for k in sorted(set(sizes) - set(plan.alone))]
    if rest:
        assert plan.capacity == smallest_capacity(rest, 40 - len(plan.alone))
    found = groups.select("size", plan.shard(groups["key"]).alias("shard"))
    shards = {r.shard: r[1] for r in found.groupBy("shard").sum("size").collect()}
    assert set(shards) <= set(range(40))
    assert max([v for k, v in shards.items() if k >= len(plan.alone)] or [0]) <= plan.capacity


def check(rows, texts):
    assert len(rows) == len(texts)
    slots, of_text = {}, {}
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r["size"] == len(text.encode()) + 16
        assert r.text_crc32 == zlib.crc32(text.encode())
        assert 0 <= r.shard < 40
        slots.setdefault(r.shard, []).append(r.slot)
        assert of_text.setdefault(text, r.shard) == r.shard
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_query(spark, tables_dir):
    texts = {
        r.doc_id: r.text for r in spark.read.parquet(f"{tables_dir}/documents.parquet").collect()
    }
    rows = op2_sharding(spark, tables_dir).collect()
    check(rows, texts)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_hot_group_and_odd_texts(spark):
    texts = dict(enumerate(["same"] * 500 + [f"text {n}" for n in range(900)] + [None, "", "ä" * 9]))
    documents = spark.createDataFrame(
        [(k, v, 1, "x") for k, v in texts.items()], "doc_id long, text string, shard int, slot string"
    )
    rows = sharding.sharded(documents).collect()
    check(rows, texts)
    shards = {r.shard for r in rows if texts[r.doc_id] == "same"}
    assert not shards & {r.shard for r in rows if texts[r.doc_id] != "same"}


def test_repeated_rows_and_empty_table(spark):
    documents = spark.createDataFrame([(1, "a")] * 5 + [(None, "b")], "doc_id long, text string")
    rows = sharding.sharded(documents).collect()
    assert sorted(r.slot for r in rows if r.doc_id == 1) == [0, 1, 2, 3, 4]
    assert sharding.sharded(documents.where("false")).collect() == []


def test_equal_rows_go_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 7)
    rows = [(None, "same")] * 300 + [(5, None)] * 200 + [(n, f"text {n}") for n in range(100)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.sharded(documents, shards=3).collect()
    assert sorted((r.doc_id or -1, r.size) for r in found) == sorted(
        (d or -1, 16 + len(t or "")) for d, t in rows
    )
    for shard in {r.shard for r in found}:
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
