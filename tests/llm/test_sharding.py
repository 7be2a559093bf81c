"""Shards against a plain jump hash, counted and read back."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterweave.llm import sharding

SCHEMA = "doc_id long, text string"


def plain_mix(i):
    k = i % 2**64
    for factor in sharding.MIX:
        k = (k ^ k >> 33) * factor % 2**64
    return k ^ k >> 33


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * sharding.JUMP + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_equals_the_plain_form_and_moves_no_more_than_needed():
    ids = np.array([0, 1, -1, 7, 2**62, -(2**63), *range(1000, 9000)], np.int64)
    keys = sharding.mixed(ids)
    assert keys.tolist() == [plain_mix(int(i)) for i in ids]
    last = None
    for n in (1, 2, 3, 24, 25, 1000):
        got = sharding.jump(keys, n)
        assert got.tolist() == [plain_jump(int(k), n) for k in keys]
        if n == 25:
            moved = got != last
            assert set(got[moved].tolist()) == {24}
            assert abs(moved.sum() / len(ids) - 1 / 25) < 0.01
        last = got
    assert sharding.jump(keys[:0], 5).tolist() == []
    with pytest.raises(ValueError):
        sharding.jump(keys, 0)


def expected(rows):
    shards = defaultdict(list)
    for doc_id, text in rows:
        data = (text or "").encode()
        key = sharding.NO_ID if doc_id is None else plain_mix(doc_id)
        row = (doc_id is not None, doc_id or 0, len(data) + 8, zlib.crc32(data))
        shards[plain_jump(key, 24)].append((row, doc_id, plain_jump(key, 25)))
    return sorted(
        (str(doc_id), row[2], row[3], "key", shard, slot, grown)
        for shard, found in shards.items()
        for slot, (row, doc_id, grown) in enumerate(sorted(found, key=lambda x: x[0]))
    )


def test_rows_of_all_kinds_get_gapless_slots(spark, stage):
    rows = [(i, f"text {i % 7} é\x00" * (i % 5)) for i in range(-40, 400)]
    rows += [(None, None), (None, ""), (None, "x"), (9, None), (9, "same"), (9, "same"), (2**60 + 1, "y" * 300_000)]
    rows += [(5, "hot")] * 500
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    docs = docs.withColumns({"shard": F.lit(1), "slot": F.lit("x"), "row": F.lit(None), "size": F.lit(2)})
    got = sharding.assigned(docs, stage)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == expected(rows)


def test_one_id_is_cut_over_many_tasks(spark, stage):
    docs = spark.range(20_000).select(F.lit(3).cast("long").alias("doc_id"), F.lit("copy").alias("text"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        made = sharding.assigned(docs, stage)
    finally:
        spark.conf.unset(setting)
    got = made.groupBy("shard").agg(
        F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("top")
    ).collect()
    assert [(r.n, r.slots, r.top) for r in got] == [(20_000, 20_000, 19_999)]
    placed = spark.read.parquet(f"{stage.folder}/placed")
    parts = placed.groupBy(F.input_file_name()).count().collect()
    assert len(parts) == 4 and max(r[1] for r in parts) < 8_000


def test_no_rows(spark, stage):
    assert sharding.assigned(spark.createDataFrame([], SCHEMA), stage).collect() == []


def test_written_shards_hold_every_row_and_column(spark, tmp_path):
    rows = [(i % 90 if i % 11 else None, f"t{i % 30}", i) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    name = sharding.write_shards(docs, f"{tmp_path}/shards", 6)
    assert name == "shard_"
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(map(str, (tuple(r) for r in back.select(*docs.columns).collect()))) == sorted(map(str, rows))
    for r in back.collect():
        key = sharding.NO_ID if r.doc_id is None else plain_mix(r.doc_id)
        assert r.shard_ == plain_jump(key, 6)
    assert len(Counter(r.shard_ for r in back.collect())) == 6
