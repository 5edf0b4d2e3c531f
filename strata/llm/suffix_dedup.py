"""Suffix-array dedup: bytes covered by a long string that also starts earlier are removed.

A position repeats if its longest previous factor, the longest string that also starts earlier,
has ``LENGTH`` bytes or more. In suffix order an earlier match is the previous or next smaller
position among neighbours that share those bytes. Suffixes that agree in ``LENGTH`` bytes are
ordered by position here, so the previous smaller position of each is its neighbour, and the
first of them has none: it stays.

Sorting every suffix of a corpus is not needed for that. Each window of ``LENGTH`` bytes is
represented by the smallest hash of the short grams in it, which equal windows share:

1. Runs of windows with the same smallest gram are counted by gram; grams of one run go.
2. Runs of equal bytes are repeats as a whole, but for the first: found by hash, combined
   before the shuffle, so copies and common passages never meet in one task.
3. What differs within a gram's runs, the ends of passages, is suffix-sorted by gram. Grams
   with very many runs are dealt by window hash instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keyed, ship_package
from strata.session import materialize

LENGTH = 100
GRAM = 32
#: Grams in a window.
_WIDTH = LENGTH - GRAM + 1
#: Windows in one run at most; longer runs (periodic text) are cut.
PIECE = 192
#: Windows that one sort takes, and windows of a gram beyond which it is dealt by window.
SORTED_TOGETHER = 300_000
CROWD = 400_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _gram_hashes(data: bytes) -> np.ndarray:
    """Hashes of all grams, by doubling."""
    h = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * _M1
    size = 1
    while size < GRAM:
        right = h[size:]
        h = h[:-size] * _M2
        h += right ^ (right >> np.uint64(29))
        h ^= h >> np.uint64(31)
        size *= 2
    return h * _M1


def _least(h: np.ndarray) -> np.ndarray:
    """The smallest hash in each window."""
    n, size = len(h) - _WIDTH + 1, 1
    while size * 2 <= _WIDTH:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:n], h[_WIDTH - size : _WIDTH - size + n])


def runs_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram, start, windows, again): runs of windows with the same smallest gram.

    ``again`` tells that the gram is more than once in the run's bytes, so that windows of the
    run may equal each other.
    """
    if len(data) < LENGTH:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2, np.zeros(0, bool))
    h = _gram_hashes(data)
    least = _least(h)
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    sizes = np.diff(np.append(starts, len(least)))
    if sizes.max() > PIECE:
        pieces = -(-sizes // PIECE)
        first = np.repeat(starts, pieces)
        number = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        left = np.repeat(sizes, pieces) - number * PIECE
        starts, sizes = first + number * PIECE, np.minimum(left, PIECE)
    gram = least[starts]
    again = sizes > _WIDTH
    most = 2 * _WIDTH - 1
    for at in range(0, len(starts), 8192):
        own = slice(at, at + 8192)
        where = starts[own, None] + np.arange(most)[None, :]
        inside = np.arange(most)[None, :] < sizes[own, None] + _WIDTH - 1
        equal = h[np.minimum(where, len(h) - 1)] == gram[own, None]
        again[own] |= (equal & inside).sum(1) > 1
    return gram, starts, sizes, again


def _packed(start, windows, again):
    return start << 10 | windows << 1 | again


def _runs(docs: DataFrame) -> DataFrame:
    """(gram, bytes_hash, _key, at) of every run; ``at`` packs start, windows and again."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, digests, keys, ats = [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = (text.as_py() or "").encode()
                gram, start, windows, again = runs_of(data)
                ends = (start + windows + LENGTH - 1).tolist()
                digests += [
                    xxhash.xxh64_intdigest(data[a:b]) for a, b in zip(
                        start.tolist(), ends, strict=True
                    )
                ]
                grams.append(gram)
                keys.append(np.full(len(gram), key, np.int64))
                ats.append(_packed(start, windows, again.astype(np.int64)))
                if len(digests) > 100_000:
                    yield _run_rows(grams, digests, keys, ats)
                    grams, digests, keys, ats = [], [], [], []
            if digests:
                yield _run_rows(grams, digests, keys, ats)

    return docs.select("_key", "text").mapInArrow(
        scan, "gram long, digest long, _key long, at long"
    )


def _run_rows(grams, digests, keys, ats) -> pa.RecordBatch:
    columns = [
        np.concatenate(grams).view(np.int64),
        np.array(digests, np.uint64).view(np.int64),
        np.concatenate(keys),
        np.concatenate(ats),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in columns], names=["gram", "digest", "_key", "at"]
    )


def _start(at="at"):
    return F.shiftright(F.col(at), 10)


def _windows(at="at"):
    return F.shiftright(F.col(at), 1).bitwiseAND(F.lit(511))


def _again(at="at"):
    return F.col(at).bitwiseAND(F.lit(1))


def repeated_windows(
    key: np.ndarray, start: np.ndarray, windows: np.ndarray, texts: list[bytes]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, end) of the bytes whose windows have an earlier match among these runs.

    The windows are put in suffix order, ties by position; one that shares ``LENGTH`` bytes
    with its neighbour before has that neighbour as previous smaller position.
    """
    order = np.lexsort((start, key))
    key, start, windows = key[order], start[order], windows[order]
    texts = [texts[i] for i in order]
    offsets = np.cumsum([0, *map(len, texts[:-1])])
    run = np.repeat(np.arange(len(key)), windows)
    inner = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
    data = np.frombuffer(b"".join(texts), np.uint8)
    suffixes = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[offsets[run] + inner]
    suffixes = np.ascontiguousarray(suffixes).view(f"S{LENGTH}").ravel()
    ranked = np.argsort(suffixes, kind="stable")
    in_order = suffixes[ranked]
    earlier = np.zeros(len(run), bool)
    earlier[ranked[1:]] = in_order[1:] == in_order[:-1]
    hit = np.flatnonzero(earlier)
    keys, starts = key[run[hit]], start[run[hit]] + inner[hit]
    if not len(hit):
        return keys, starts, starts
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(hit) - 1)
    return keys[first], starts[first], starts[last] + LENGTH


def _cut(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, _key, at, bytes) of the wanted runs (gram, _key, at)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, runs in zip(
                batch.column(2).to_pylist(), batch.column(1), batch.column(3), strict=True
            ):
                data, rows = (text.as_py() or "").encode(), runs.as_py()
                for at in range(0, len(rows), 20_000):
                    few = rows[at : at + 20_000]
                    spans = [
                        (
                            x["at"] >> 10, (x["at"] >> 10) + (x["at"] >> 1 & 511) + LENGTH - 1
                        ) for x in few
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([x["gram"] for x in few], pa.int64()), pa.array(
                                [key] * len(few), pa.int64()
                            ),
                            pa.array([x["at"] for x in few], pa.int64()), pa.array(
                                [data[a:b] for a, b in spans], pa.binary()
                            ),
                        ],
                        names=["gram", "_key", "at", "bytes"],
                    )

    lists = wanted.groupBy("_key").agg(F.collect_list(F.struct("gram", "at")).alias("runs"))
    # The columns of the last join, so that both joins read one shuffle of the texts.
    joined = docs.join(lists, "_key").select(*docs.columns, "runs")
    return joined.mapInArrow(cut, "gram long, _key long, at long, bytes binary")


_SPAN = "_key long, start long, end long"


def _sorted_by_gram(runs: DataFrame) -> DataFrame:
    """Repeats (_key, start, end) within each gram's runs; many grams go into one sort."""

    def spans(gram, key, at, texts):
        found = repeated_windows(
            np.concatenate(key), np.concatenate(at) >> 10, np.concatenate(at) >> 1 & 511, texts
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in found], names=["_key", "start", "end"]
        )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [[], [], [], []]
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, key, at = (batch.column(i).to_numpy() for i in range(3))
            texts, done = batch.column(3).to_pylist(), 0
            cuts = np.flatnonzero(gram[1:] != gram[:-1]) + 1
            begins = [0, *cuts.tolist()] if gram[0] != last else cuts.tolist()
            many = np.cumsum(at >> 1 & 511)
            for begin in begins:
                held_now = size + (
                    int(many[begin - 1]) - (
                        int(many[done - 1]) if done else 0
                    ) if begin > done else 0
                )
                if held_now >= SORTED_TOGETHER:
                    for own, column in zip(held, (gram, key, at), strict=False):
                        own.append(column[done:begin])
                    held[3] += texts[done:begin]
                    if held[3]:
                        yield spans(*held)
                    held, size, done = [[], [], [], []], 0, begin
            for own, column in zip(held, (gram, key, at), strict=False):
                own.append(column[done:])
            held[3] += texts[done:]
            size += int(many[-1]) - (int(many[done - 1]) if done else 0)
            last = gram[-1]
        if held[3]:
            yield spans(*held)

    return runs.repartition("gram").sortWithinPartitions("gram").mapInArrow(sort, _SPAN)


def _dealt_by_window(runs: DataFrame) -> DataFrame:
    """The same for grams of very many runs: windows are dealt by their own hash."""
    offset = F.explode(F.sequence(F.lit(0), _windows().cast("int") - 1)).alias("offset")
    windows = runs.select("_key", _start().alias("run"), "bytes", offset).select(
        F.unhex(F.md5(F.substring("bytes", F.col("offset") + 1, F.lit(LENGTH)))).alias("window"),
        F.struct("_key", (F.col("run") + F.col("offset")).alias("start")).alias("place"),
    )
    windows = materialize(windows, "windows")
    first = materialize(
        windows.groupBy("window")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .drop("n"),
        "first-windows",
    )
    later = windows.join(first, "window").where(F.col("place") != F.col("first"))
    return later.select("place._key", "place.start", (F.col("place.start") + LENGTH).alias("end"))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans; spans are merged where they touch."""
    for batch in batches:
        ids, sizes, all_spans, kept = [], [], [], []
        for doc_id, text, spans in zip(
            batch.column(0).to_pylist(), batch.column(1), batch.column(3), strict=True
        ):
            data = (text.as_py() or "").encode()
            merged: list[list[int]] = []
            for start, end in sorted((x["start"], x["end"]) for x in spans.as_py() or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            bounds = [0, *(x for span in merged for x in span), len(data)]
            ids.append(doc_id)
            sizes.append(len(data))
            all_spans.append([{"start": a, "end": b} for a, b in merged])
            kept.append(b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(all_spans, span),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )


def suffix_dedup(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): every document without its repeated bytes.

    A byte goes if a string of 100 bytes that covers it also starts earlier: in a document of
    smaller id, or earlier in the same one; overlaps count, and strings are judged on the
    texts as given. ``spans`` are the maximal removed runs, ``kept`` the bytes that stay
    (they may end within a character). Matches never cross documents. Null is read as empty;
    texts of under 100 bytes stay. Rows that share an id, or have none, are documents of their
    own, ordered by (id, text), null first. Other columns are not read; empty in, empty out.
    """
    ship_package(docs.sparkSession)
    own = keyed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text", "_key").where(
        F.col("_key").isNotNull()
    )
    counted = _runs(own).groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.max(_again()).alias("again")
    )
    shared = materialize(
        counted.where((F.col("n") > 1) | (F.col("again") == 1)).select("gram"), "shared-grams"
    )
    runs = materialize(_runs(own).join(shared, "gram", "left_semi"), "runs")

    place = F.struct("_key", "at")
    firsts = materialize(
        runs.groupBy("gram", "digest").agg(
            F.min(place).alias("first"), F.count(F.lit(1)).alias("n")
        ), "first-runs"
    )
    later = runs.join(firsts.where(F.col("n") > 1).select("gram", "digest", "first"), ["gram", "digest"]).where(
        place != F.col("first")
    )
    as_wholes = later.select(
        "_key", _start().alias("start"), (_start() + _windows() + LENGTH - 1).alias("end")
    )

    mixed = materialize(
        firsts.groupBy("gram")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.max(_again("first.at")).alias("again"),
            F.sum(_windows("first.at")).alias("windows"),
        )
        .where((F.col("runs") > 1) | (F.col("again") == 1))
        .select("gram", (F.col("windows") > crowd).alias("crowded")),
        "mixed-grams",
    )
    wanted = firsts.select("gram", "first._key", "first.at").join(mixed, "gram")
    plain = _sorted_by_gram(_cut(own, wanted.where(~F.col("crowded")).select("gram", "_key", "at")))
    spans = as_wholes.union(plain)
    if not mixed.where("crowded").isEmpty():
        spans = spans.union(
            _dealt_by_window(_cut(own, wanted.where("crowded").select("gram", "_key", "at")))
        )
    lists = spans.groupBy("_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = own.join(lists, "_key", "left").select(*own.columns, "spans")
    return joined.mapInArrow(
        _apply,
        "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary",
    )
