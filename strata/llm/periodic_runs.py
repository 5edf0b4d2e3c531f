"""Periodic runs of words, found in tiles of the scale of their period.

A run of period q and at least 4q words holds at least 3q places i with word i = word i + q.
Periods are taken an octave [Q, 2Q) at a time. For each octave a document is exploded into
tiles that overlap by 2Q such places; only tiles in which a stretch of Q words comes again
within the octave's reach (a test that misses no run) are kept, so the tiles of ordinary text
are few. Tiles are dealt over the cluster and solved independently: Z-functions to the right
and to the left of boundaries 2Q words apart tell for every period at once how far it holds.
The fragments are shuffled by (document, period) and stitched where they touch.

Why no run is lost: of the places of a run, a tile sees either fewer than 2Q, and then a
neighbour sees all of those, or at least 2Q; around some boundary of the tile at least 2Q of
them are then seen, which is what a fragment must have to be reported.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keyed, ship_package

# What counts as a run.
LEAST_WORDS = 6
LEAST_EXPONENT = 4

#: Places that a tile is responsible for; four times the octave where that is more.
STRIDE = 2_048
#: Octaves below this one are screened period by period, the others by hashes of blocks.
HASHED_FROM = 16
#: Words that are screened together.
CHUNK_WORDS = 262_144

_MULTIPLY = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_FOLD = np.uint64(29)


def stride(octave: int) -> int:
    return max(STRIDE, 4 * octave)


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the stretches of True of at least ``least`` places."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    starts, ends = edges[0::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def candidates(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(octave, places): where the octave's tiles may hold a run; none is missed.

    ``codes`` may be several documents with a code of its own between them. Below
    ``HASHED_FROM`` the places are those of the long stretches themselves. Above, they are
    the starts of aligned blocks of Q words whose hash comes again Q to 2Q - 1 words later:
    any 2Q places of a run hold such a block.
    """
    n, octave = len(codes), 1
    while octave < HASHED_FROM and LEAST_EXPONENT * octave <= n:
        found = []
        for period in range(octave, 2 * octave):
            if LEAST_EXPONENT * period > n:
                break
            least = max(LEAST_WORDS, LEAST_EXPONENT * period) - period
            starts, ends = _stretches(codes[period:] == codes[:-period], least)
            found.extend(np.arange(s, e) for s, e in zip(starts, ends, strict=True))
        if found:
            yield octave, np.unique(np.concatenate(found))
        octave *= 2
    hashes, width = codes.astype(np.uint64) * _MULTIPLY[0], 1
    while LEAST_EXPONENT * octave <= n:
        while width < octave:
            left, right = hashes[:-width], hashes[width:]
            mixed = (left ^ (left >> _FOLD)) * _MULTIPLY[1] + right
            hashes, width = (mixed ^ (mixed >> _FOLD)) * _MULTIPLY[0], 2 * width
        blocks = -(-len(hashes) // octave)
        padded = np.zeros(blocks * octave, np.uint64)
        padded[: len(hashes)] = hashes
        rows = padded.reshape(blocks, octave)
        again = np.flatnonzero((rows[1:] == rows[:-1, :1]).any(axis=1))
        if len(again):
            yield octave, again * octave
        octave *= 2


def z_function(s: list[int]) -> list[int]:
    """For each place how many items from there on agree with the beginning."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def _is_simple(window: list[int], octave: int) -> bool:
    """Whether a whole window has a very short period, of which all others are multiples."""
    return any(
        window[p : p + 8] == window[:8] and window[p:] == window[:-p]
        for p in range(1, min(octave, HASHED_FROM))
    )


def _at_boundary(words: list[int], at: int, octave: int) -> list[tuple[int, int, int]]:
    """(period, start, stop): the octave's stretches of places around a boundary of a tile.

    A period that is a multiple of a smaller one on the same words is left out: no run has it
    as smallest period.
    """
    reach = 2 * octave
    ahead = words[at : at + 2 * reach]
    if ahead[0] not in ahead[octave:reach]:
        return []
    if _is_simple(words[max(0, at - reach) : at + 2 * reach], octave):
        return []
    before = words[max(0, at - reach) : at][::-1]
    near = words[at : at + reach]
    forward = z_function(ahead)
    # Place -1 is a code that no word has: it ends every match at the boundary's own words.
    backward = z_function([*before, -1, *near[::-1], *before])
    shift = len(before) + 1 + len(near)
    found: list[tuple[int, int, int]] = []
    smaller: list[tuple[int, int, int]] = []
    for period in range(1, min(reach, len(ahead))):
        if period > len(near):
            break
        left, right = backward[shift - period] if before else 0, forward[period]
        if left + right < reach:
            continue
        stop = right + period
        if any(period % p == 0 and le >= left and st >= stop for p, le, st in smaller):
            continue
        smaller.append((period, left, stop))
        if period >= octave:
            found.append((period, at - left, at + right))
    return found


def fragments(words: list[int], octave: int) -> list[tuple[int, int, int]]:
    """(period, start, stop): a tile's stretches of places, those that touch merged."""
    merged: dict[int, list[tuple[int, int]]] = {}
    for at in range(0, len(words) - octave, 2 * octave):
        for period, start, stop in _at_boundary(words, at, octave):
            own = merged.setdefault(period, [])
            if own and start <= own[-1][1]:
                own[-1] = (own[-1][0], max(stop, own[-1][1]))
            else:
                own.append((start, stop))
    return [(period, s, e) for period, own in sorted(merged.items()) for s, e in own]


def split_words(text: str | None) -> list[bytes]:
    """The words as UTF-8; bytes split at ASCII white space only."""
    return text.encode().split() if text else []


# --- over tables -----------------------------------------------------------------------

_TILES = "_key long, octave long, at long, words array<int>"


def tiles(own: DataFrame) -> DataFrame:
    """(_key, octave, at, words) of the tiles that may hold a run; ``own`` has _key and text.

    Words are numbered within their chunk, so the codes of one document agree in all tiles.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                yield from _tile_batches(*chunk)

    ship_package(own.sparkSession)
    return own.select("_key", "text").mapInArrow(explode, _TILES)


def _chunks(rows: Iterator) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
    """(keys, first places, codes) of whole documents, put together up to ``CHUNK_WORDS``."""
    keys, firsts, codes, known = [], [0], [], {}
    for key, text in rows:
        words = split_words(text.as_py())
        if len(words) < LEAST_WORDS:
            continue
        keys.append(key)
        codes.extend([known.setdefault(word, len(known)) for word in words])
        codes.append(-len(keys))
        firsts.append(len(codes))
        if len(codes) >= CHUNK_WORDS:
            yield keys, firsts, np.array(codes, np.int32)
            keys, firsts, codes, known = [], [0], [], {}
    if keys:
        yield keys, firsts, np.array(codes, np.int32)


def _tile_batches(
    keys: list[int], firsts: list[int], codes: np.ndarray
) -> Iterator[pa.RecordBatch]:
    first = np.array(firsts)
    for octave, places in candidates(codes):
        step = stride(octave)
        doc = np.searchsorted(first, places, "right") - 1
        inside = places - first[doc]
        tile = inside // step
        shared = (inside % step < 2 * octave) & (tile > 0)
        wanted = np.unique(
            np.concatenate([np.stack([doc, tile], 1), np.stack([doc[shared], tile[shared] - 1], 1)]),
            axis=0,
        )
        for d, t in wanted.tolist():
            start, end = firsts[d] + t * step, firsts[d + 1] - 1
            words = codes[start : min(end, start + step + 4 * octave)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[d]], pa.int64()),
                    pa.array([octave], pa.int64()),
                    pa.array([t * step], pa.int64()),
                    pa.array([words], pa.list_(pa.int32())),
                ],
                names=["_key", "octave", "at", "words"],
            )


def solve(tiled: DataFrame) -> DataFrame:
    """(_key, period, start, stop): stretches of equal places of every tile, by itself."""

    def solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int, int]] = []
            for row in batch.to_pylist():
                key, at = row["_key"], row["at"]
                own = fragments(row["words"], row["octave"])
                rows.extend((key, period, at + s, at + e) for period, s, e in own)
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in columns],
                names=["_key", "period", "start", "stop"],
            )

    return tiled.mapInArrow(solve_tiles, "_key long, period long, start long, stop long")


def stitch(pieces: DataFrame) -> DataFrame:
    """(_key, start, length, period) of the runs: touching stretches of a period are one.

    A (document, period) holds at most one fragment for each tile of the document.
    """
    return pieces.sparkSession.sql(
        """
        WITH ordered AS (
            SELECT *, max(stop) OVER (
                PARTITION BY _key, period ORDER BY start, stop
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
            ) AS reached FROM {pieces}
        ), parted AS (
            SELECT *, count_if(reached IS NULL OR start > reached) OVER (
                PARTITION BY _key, period ORDER BY start, stop
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
            ) AS island FROM ordered
        )
        SELECT _key, min(start) AS start, max(stop) - min(start) + period AS length, period
        FROM parted GROUP BY _key, period, island
        HAVING length >= greatest({least}, {times} * period)
        """,
        pieces=pieces,
        least=LEAST_WORDS,
        times=LEAST_EXPONENT,
    )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, kept, kept_sha256) of every whole text.

    ``runs`` are structs of start, length and period, by start, then period: the maximal
    stretches of at least six words and four times their smallest period in which words one
    period apart are equal. ``kept`` are the words joined by one blank, without those that a
    run holds after its first period. Words are split at ASCII white space. Null, empty and
    blank texts have no words and keep the empty text. Rows that share an id, or have none,
    are documents of their own; other columns are not read; an empty table gives an empty
    table. Of equal runs in copies each copy has its own.
    """
    own = keyed(docs, "doc_id", "text")
    # By number: a tile's work is large for its bytes, by which partitions would be merged.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles(own).repartition(parts, "_key", "octave", "at")
    found = stitch(solve(dealt))
    runs = found.groupBy("_key").agg(
        F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("found")
    )
    joined = own.join(runs, "_key", "left").select(
        "doc_id",
        "text",
        F.transform("found", lambda r: r["start"]).alias("starts"),
        F.transform("found", lambda r: r["length"]).alias("lengths"),
        F.transform("found", lambda r: r["period"]).alias("periods"),
    )

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, texts, hashes = [], [], [], []
            for row in zip(*(batch.column(i) for i in range(1, 5)), strict=True):
                text, starts, lengths, periods = (value.as_py() for value in row)
                words = split_words(text)
                counts.append(len(words))
                own = list(zip(starts or (), lengths or (), periods or (), strict=True))
                if own:
                    words = _without_repeats(words, own)
                kept = b" ".join(words)
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own])
                texts.append(kept.decode())
                hashes.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(runs, _RUNS),
                    pa.array(texts, pa.string()),
                    pa.array(hashes, pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "kept", "kept_sha256"],
            )

    return joined.mapInArrow(
        collapse,
        f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, kept string, kept_sha256 string",
    )


_RUNS = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)


def _without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]
