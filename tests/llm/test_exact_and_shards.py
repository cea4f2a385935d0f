"""Exact groups and shards against plain Python, and the cases of cases.py."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from entity360.llm import bloom, sharding
from entity360.llm.exact_dedup import drop_copies, exact_groups
from entity360.llm.queries import QUERIES
from entity360.llm.sharding import shard_by_bytes
from tests.llm.cases import FOLDER, documents, empty, messy, messy_rows


def _digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def test_query_finds_the_groups_of_equal_texts(spark):
    groups = defaultdict(list)
    for i, text in documents(spark):
        groups[_digest(text)].append(i)
    expected = {
        (i, min(ids), len(ids), i == min(ids), digest) for digest, ids in groups.items() for i in ids
    }
    got = QUERIES["op10_exact_dedup"](spark, FOLDER).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
    assert {tuple(r) for r in got.collect()} == expected


def test_one_row_of_each_group_is_kept_whatever_the_rows(spark):
    rows = exact_groups(messy(spark)).collect()
    assert len(rows) == len(messy_rows())
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert kept == Counter({_digest(t) for _, t in messy_rows()})
    sizes = Counter(_digest(t) for _, t in messy_rows())
    assert all(r.group_size == sizes[r.text_sha256] for r in rows)
    assert {r.keep_id for r in rows if r.text_sha256 == _digest("")} == {1}


def test_dropping_copies_keeps_the_columns_and_one_row_a_group(spark):
    docs = messy(spark)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    assert Counter(_digest(r.text) for r in left.collect()) == Counter({_digest(t) for _, t in messy_rows()})
    assert drop_copies(empty(spark)).count() == 0 == exact_groups(empty(spark)).count()


def test_a_group_of_a_third_of_all_rows_is_one_group(spark):
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "copied text").otherwise(F.concat(F.lit("t"), "id")).alias("text"),
    )
    got = exact_groups(docs).groupBy("group_size").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k"))
    assert {tuple(r) for r in got.collect()} == {(1000, 1000, 1), (1, 2000, 2000)}


def test_a_bloom_filter_never_misses_a_key(spark):
    keys = spark.range(0, 2_000, 2).select(F.col("id").alias("key"))
    absent, maybe = bloom.split_by(spark.range(4_000).select(F.col("id").alias("key")), "key", keys)
    assert absent.where("key % 2 = 0 AND key < 2000").count() == 0
    assert absent.count() + maybe.count() == 4_000
    assert absent.count() > 2_500


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_have_near_equal_bytes_and_gapless_slots(spark, shards):
    docs = spark.range(4_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("copied " * 30))
        .otherwise(F.repeat(F.concat(F.col("id").cast("string"), F.lit("é ")), (F.col("id") % 50).cast("int")))
        .alias("text"),
    )
    rows = shard_by_bytes(docs, shards).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.id for r in rows} == set(texts) and len(rows) == 4_000
    assert all(r.size == len(texts[r.id].encode()) + 16 for r in rows)
    assert all(r.text_crc32 == zlib.crc32(texts[r.id].encode()) for r in rows)
    total, sums, slots = sum(r.size for r in rows), Counter(), defaultdict(list)
    for r in rows:
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sums) == set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in rows)
    assert all(abs(b - total / shards) <= largest + 0.01 * total / shards for b in sums.values())


def test_ranges_cut_rows_that_repeat_text_and_id(spark):
    docs = spark.range(3_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("again and again").alias("text"))
    rows = shard_by_bytes(docs, 5).collect()
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(5)) and max(counts.values()) - min(counts.values()) <= 1
    keys = docs.select(
        F.lit(7).cast("long").alias("h"), F.lit(0).cast("long").alias("k"), F.lit(31).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    splitters = sharding.splitters_for(keys, 31 * 3_000, 5)
    ranged = keys.groupBy(sharding._range_of(splitters)).count().collect()
    assert len(splitters) > 50 and max(r["count"] for r in ranged) <= 2 * 3_000 / (5 * sharding.RANGES_PER_SHARD) + 1


def test_shards_of_odd_rows_and_none(spark):
    rows = shard_by_bytes(messy(spark), 4).collect()
    assert sorted((r.id is not None, r.id) for r in rows if r.id) == sorted(
        (True, i) for i, _ in messy_rows() if i
    )
    assert len(rows) == len(messy_rows()) and all(0 <= r.shard < 4 for r in rows)
    assert shard_by_bytes(empty(spark), 4).count() == 0


def test_query_shards_every_document(spark):
    got = QUERIES["op3_sharding"](spark, FOLDER)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted(r.doc_id for r in got.collect()) == [i for i, _ in documents(spark)]
