"""Line dedup and sharding."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from llm_tables import LOWER, SPACES, TEXTS, awkward, documents, empty
from strata.llm import line_dedup, sharding


def plain_line_dedup(texts, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(LOWER)
    for place, (_, text) in enumerate(texts):
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(place)
    out = []
    for place, (doc_id, text) in enumerate(texts):
        lines = (text or "").split("\n")
        kept = [
            x for x in lines if len(holders[key(x)]) < min_docs or max(holders[key(x)]) == place
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("min_docs", [1, 2, 3])
def test_line_dedup_equals_plain_version(spark, min_docs):
    got = line_dedup.line_dedup(documents(spark), 20, min_docs).collect()
    assert sorted(map(tuple, got)) == sorted(plain_line_dedup(TEXTS, 20, min_docs))


def test_line_dedup_on_awkward_rows(spark):
    frame = awkward(spark)
    texts = sorted(
        [(r["doc_id"], r["text"]) for r in frame.collect()],
        key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""),
    )
    got = line_dedup.line_dedup(frame).collect()
    assert Counter(map(tuple, got)) == Counter(plain_line_dedup(texts))
    assert line_dedup.line_dedup(empty(spark)).collect() == []


def plain_shard(doc_id, n):
    def score(shard):
        draw = xxhash.xxh64_intdigest(
            shard.to_bytes(4, "little"), xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little"), 42)
        )
        return -1 / math.log(((draw >> 11) + 0.5) / 2**53)

    return max(range(n), key=score)


def test_shards_equal_plain_rendezvous(spark):
    got = sharding.assign_shards(documents(spark), [1.0] * 24, [1.0] * 25).collect()
    assert len(got) == len(TEXTS)
    by_id = dict(TEXTS)
    for row in got:
        data = (by_id[row["doc_id"]] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert row["shard"] == plain_shard(row["doc_id"], 24)
        assert row["grown_shard"] == plain_shard(row["doc_id"], 25)


def test_a_new_shard_only_takes(spark):
    ids = spark.range(5000).selectExpr("id AS doc_id", "'x' AS text")
    got = sharding.assign_shards(ids, [1.0] * 10, [1.0] * 11).collect()
    moved = [row for row in got if row["shard"] != row["grown_shard"]]
    assert {row["grown_shard"] for row in moved} == {10} and 350 < len(moved) < 560
    slots = defaultdict(list)
    for row in got:
        slots[row["shard"]].append(row["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(map(len, slots.values())) < 1.25 * min(map(len, slots.values()))


def test_weights(spark):
    ids = spark.range(6000).selectExpr("id AS doc_id", "'x' AS text")
    got = Counter(
        row["shard"] for row in sharding.assign_shards(ids, [1.0, 2.0, 0.0, 3.0]).collect()
    )
    assert got[2] == 0
    assert all(abs(got[s] - 1000 * w) < 200 for s, w in ((0, 1), (1, 2), (3, 3)))
    with pytest.raises(ValueError):
        sharding.assign_shards(ids, [0.0])


def test_shards_of_awkward_rows(spark, tmp_path):
    frame = awkward(spark)
    got = sharding.assign_shards(frame, [1.0] * 3).collect()
    assert len(got) == frame.count()
    slots = defaultdict(list)
    for row in got:
        slots[row["shard"]].append(row["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert sharding.assign_shards(empty(spark), [1.0] * 3).collect() == []
    sharding.write_shards(documents(spark), str(tmp_path / "out"), [1.0] * 3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(TEXTS)
