"""Benchmark decontamination by a broadcast hash set of word windows.

Benchmark items become windows of normalised words. Each document's words are hashed, a
rolling hash over every window position is looked up in the set, and each hit is verified
word by word before it counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keyed, keyed_whole, ship_package
from strata.session import materialize

WORDS = 10
#: Windows that one broadcast set may hold; a larger benchmark is scanned in so many parts.
WINDOWS_AT_ONCE = 500_000
_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)

#: Word characters are 0-9, A-Z (lower-cased), a-z and all bytes of characters above ASCII.
_TABLE = bytes(
    byte + 32
    if 65 <= byte <= 90
    else byte
    if 48 <= byte <= 57 or 97 <= byte <= 122 or byte > 127
    else 32
    for byte in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


class WindowSet:
    """Windows of one benchmark part, looked up by a rolling hash, then word by word."""

    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        self.items = {}
        for joined, items in windows:
            self.items[tuple(joined.split(b" "))] = items
        self.lengths = sorted({len(window) for window in self.items})
        self.near = {}
        for length in self.lengths:
            hashes = np.concatenate(
                [self.rolled(_hashes(w), length) for w in self.items if len(w) == length]
            )
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[hashes >> np.uint64(64 - _BITS)] = True
            self.near[length] = bitmap

    @staticmethod
    def rolled(hashes: np.ndarray, length: int) -> np.ndarray:
        n = len(hashes) - length + 1
        total = np.zeros(max(n, 0), np.uint64)
        for at in range(length if n > 0 else 0):
            total = total * _BASE + hashes[at : at + n]
        return total * _BASE

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """(start, end) of the occurring windows in words, and the items that have them."""
        spans, items, hashes = [], set(), _hashes(words)
        for length in self.lengths:
            near = self.near[length][self.rolled(hashes, length) >> np.uint64(64 - _BITS)]
            for at in np.flatnonzero(near).tolist():
                found = self.items.get(tuple(words[at : at + length]))
                if found is not None:
                    spans.append((at, at + length))
                    items.update(found)
        return np.array(spans, np.int64).reshape(-1, 2), items


def _hashes(words) -> np.ndarray:
    """One worker's hashes of words; the set is built in the same worker."""
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def benchmark_windows(benchmark: DataFrame, size: int = WORDS) -> DataFrame:
    """(window, items): every distinct window, its words joined by blanks, with its item ids.

    A window is ``size`` consecutive words of an item, or all words of a shorter one. Items
    without words have no window; those without id count for hits but are not listed.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, windows = [], []
            for item, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                words = words_of(text)
                for at in range(max(len(words) - size, 0) + 1) if words else ():
                    items.append(item)
                    windows.append(b" ".join(words[at : at + size]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(windows, pa.binary())], names=["item", "window"]
            )

    slim = benchmark.select(F.col("item_id").cast("string"), "text")
    return slim.mapInArrow(cut, "item string, window binary").groupBy("window").agg(
        F.collect_set("item").alias("items")
    )


def _window_parts(benchmark: DataFrame, size: int, at_once: int) -> Iterator[_Shared]:
    """The distinct windows in broadcasts of at most ``at_once`` windows each.

    One part is alive at a time: the one before is freed when the next is asked for, so the
    findings of a part must be at rest by then. A single part stays for as long as it is used.
    """
    spark = benchmark.sparkSession
    windows = materialize(benchmark_windows(benchmark, size), "benchmark-windows")
    n = windows.count()
    # Twice as many parts as needed on average, so that hashing leaves none above the bound.
    parts = 1 if n <= at_once else 2 * n // at_once + 1
    for part in range(parts):
        own = windows if parts == 1 else windows.where(
            F.pmod(F.xxhash64("window"), F.lit(parts)) == part
        )
        pairs = [(bytes(window), list(items)) for window, items in own.collect()]
        shared = _Shared(spark.sparkContext.broadcast(pairs), parts == 1)
        yield shared
        if parts > 1:
            shared.broadcast.destroy()


class _Shared:
    """A broadcast part; a worker builds its set once and keeps the last one built."""

    built: tuple[str, WindowSet] | None = None

    def __init__(self, broadcast, alone: bool):
        self.broadcast, self.name, self.alone = broadcast, uuid.uuid4().hex, alone

    def windows(self) -> WindowSet:
        if _Shared.built is None or _Shared.built[0] != self.name:
            _Shared.built = (self.name, WindowSet(self.broadcast.value))
        return _Shared.built[1]


def _merged(spans: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(start, end) for start, end in out]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WORDS, at_once: int = WINDOWS_AT_ONCE
) -> DataFrame:
    """(doc_id, n_words, spans, items) of every document against all of ``benchmark``.

    ``spans`` are the merged runs (start, end) of hit words, ``items`` the sorted ids of items
    with a window in the text. The benchmark is normalised and counted by Spark and broadcast
    in parts of a bounded number of windows. Test sets fit one part; a larger one takes one
    pass over the documents for each part, and the parts' findings are merged by document.
    Null and empty texts have no word and no hit; repeated rows and ids give a row each; an
    empty benchmark hits nothing. Columns other than ids and texts are not read.
    """
    ship_package(docs.sparkSession)
    parts = _window_parts(benchmark, size, at_once)
    first = next(parts)
    if first.alone:
        slim = docs.select(F.col("doc_id").cast("long"), "text")
        return slim.mapInArrow(_scanner(first), f"doc_id long, {_FOUND}")
    own = keyed(docs, "doc_id", "text")
    found = _found_in_parts(own.select("_key", "text"), first, parts, hits_only=False)
    merged = found.groupBy("_key").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return own.select("_key", F.col("doc_id").cast("long")).join(
        merged.mapInArrow(_merge, f"_key long, {_FOUND}"), "_key"
    ).drop("_key")


def _found_in_parts(
    texts: DataFrame, first: _Shared, others: Iterator[_Shared], hits_only: bool
) -> DataFrame:
    """(_key, n_words, spans, items): the findings of each part, at rest before the next.

    Rows without a hit come from the first part, or from none with ``hits_only``.
    """
    passes = []
    for part in chain([first], others):
        found = texts.mapInArrow(_scanner(part), f"_key long, {_FOUND}")
        if passes or hits_only:
            found = found.where(F.size("spans") > 0)
        passes.append(materialize(found, "contaminated-part"))
    return reduce(DataFrame.union, passes)


_FOUND = "n_words long, spans array<struct<start: int, end: int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _found(ids, counts, spans, items, id_name: str) -> pa.RecordBatch:
    merged = [[{"start": start, "end": end} for start, end in _merged(x)] for x in spans]
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(counts, pa.int64()),
            pa.array(merged, _SPANS),
            pa.array(items, pa.list_(pa.string())),
        ],
        names=[id_name, "n_words", "spans", "items"],
    )


def _scanner(shared: _Shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.windows()
        for batch in batches:
            counts, spans, items = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                span, item = windows.hits(words)
                counts.append(len(words))
                spans.append(span)
                items.append(sorted(item))
            yield _found(batch.column(0), counts, spans, items, batch.schema.names[0])

    return scan


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, counts, spans, items = (batch.column(i) for i in range(4))
        pairs = [
            np.array([(x["start"], x["end"]) for x in one], np.int64).reshape(-1, 2) for one in spans.to_pylist()
        ]
        yield _found(key, counts.to_pylist(), pairs, items.to_pylist(), "_key")


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, size: int = WORDS, at_once: int = WINDOWS_AT_ONCE
) -> DataFrame:
    """The rows of ``docs`` whose text has no window of the benchmark; all columns as they are.

    Each row is judged by its own text, whatever the benchmark's size and whatever id it
    shares. Where the windows fit one broadcast, texts are judged where they are read and none
    moves; with more, each part marks rows by a key of their own. Null and empty texts stay,
    repeated rows stay or go together, an empty benchmark or table drops nothing; columns of
    any name are carried along.
    """
    ship_package(docs.sparkSession)
    parts = _window_parts(benchmark, size, at_once)
    first = next(parts)
    if first.alone:

        @F.pandas_udf("boolean")
        def hit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            windows = first.windows()
            for texts in batches:
                yield pd.Series(
                    [len(windows.hits(words_of(text))[0]) > 0 for text in texts], dtype=bool
                )

        return docs.where(~hit(docs["text"]))
    own = keyed_whole(docs, "doc_id", "text")
    found = _found_in_parts(own.select("_key", "text"), first, parts, hits_only=True)
    return own.join(found.select("_key").distinct(), "_key", "left_anti").select("_row.*")
