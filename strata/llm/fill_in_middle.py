"""Fill-in-middle over seekable compressed frames.

A text is stored as independent zstandard frames of bounded size, with the cumulative count of
its units (lines), code points and bytes at every frame's end. Choosing the cuts needs only
the counts; a cut that falls inside a frame decompresses that frame alone. The transformed
document is a sequence of frames as well: marks and the pieces of cut frames become frames of
their own, every other frame is moved as it is, still compressed. Digests, and the way back to
the text, stream ordered frames and never hold more than one.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship_package

#: Bytes of text in a frame; the last code point may take it three bytes beyond.
FRAME_BYTES = 65_536
LEVEL = 3

# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"

_FRAMES = pa.list_(pa.binary())
_COUNTS = pa.list_(pa.int64())


@cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL)


@cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _pack(data: bytes) -> bytes:
    return _compressor().compress(data)


def _unpack(frame: bytes) -> bytes:
    return _decompressor().decompress(frame)


def _chars(data: bytes) -> int:
    return len(data.decode())


class Frames:
    """A byte text as frames, with cumulative units, code points and bytes at frame ends.

    Units are counted where they end: at a line feed, or at the end of the text.
    """

    def __init__(self, frames: list[bytes], units: list[int], chars: list[int], ends: list[int]):
        self.frames, self.units, self.chars, self.ends = frames, units, chars, ends

    @classmethod
    def of(cls, data: bytes, size: int = FRAME_BYTES) -> Frames:
        frames, units, chars, ends = [], [], [], []
        start = n_units = n_chars = 0
        while start < len(data):
            stop = min(len(data), start + size)
            while stop < len(data) and data[stop] & 0xC0 == 0x80:
                stop += 1
            piece = data[start:stop]
            n_units += piece.count(b"\n") + (stop == len(data) and not piece.endswith(b"\n"))
            n_chars += _chars(piece)
            frames.append(_pack(piece))
            units.append(n_units)
            chars.append(n_chars)
            ends.append(stop)
            start = stop
        return cls(frames, units, chars, ends)

    @property
    def n_units(self) -> int:
        return self.units[-1] if self.units else 0

    @property
    def n_bytes(self) -> int:
        return self.ends[-1] if self.ends else 0

    def cut(self, unit: int) -> tuple[int, int]:
        """(bytes, code points) before the end of the ``unit``-th unit; opens one frame."""
        if unit <= 0 or not self.frames:
            return 0, 0
        k = bisect_left(self.units, unit)
        before = (self.units[k - 1], self.chars[k - 1], self.ends[k - 1]) if k else (0, 0, 0)
        data, at = _unpack(self.frames[k]), -1
        for _ in range(unit - before[0]):
            at = data.find(b"\n", at + 1)
            if at < 0:
                at = len(data) - 1  # the text's last unit, without a line feed
        return before[2] + at + 1, before[1] + _chars(data[: at + 1])

    def between(self, start: int, stop: int) -> Iterator[bytes]:
        """Frames that hold the bytes from ``start`` to ``stop``: whole ones as they are."""
        k = bisect_right(self.ends, start)
        while start < stop:
            first, end = (self.ends[k - 1] if k else 0), self.ends[k]
            if start == first and stop >= end:
                yield self.frames[k]
            else:
                yield _pack(_unpack(self.frames[k])[start - first : min(stop, end) - first])
            start, k = end, k + 1

    def holds_mark(self) -> bool:
        """Whether any mark occurs, also across frames."""
        tail, longest = b"", max(map(len, MARKS)) - 1
        for frame in self.frames:
            data = tail + _unpack(frame)
            if any(mark.encode() in data for mark in MARKS):
                return True
            tail = data[-longest:]
        return False


def arrange(text: Frames, first: int, second: int, form: str) -> list[bytes]:
    """The output's frames, for byte offsets of the two cuts."""
    if form == PLAIN:
        return text.frames
    parts = {PREFIX: (0, first), MIDDLE: (first, second), SUFFIX: (second, text.n_bytes)}
    order = (PREFIX, SUFFIX, MIDDLE) if form == PSM else (SUFFIX, PREFIX, MIDDLE)
    out: list[bytes] = []
    for mark in order:
        out.append(_pack(mark.encode()))
        out.extend(text.between(*parts[mark]))
    return out


def digest(frames: list[bytes]) -> str:
    """SHA-256 of the bytes, streamed frame by frame."""
    sha = hashlib.sha256()
    for frame in frames:
        sha.update(_unpack(frame))
    return sha.hexdigest()


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The original text's bytes, rebuilt from an output and its form alone.

    One pass over the output finds where the marks stand, the next ones stream prefix, middle
    and suffix from the frames that hold them. A part holds no mark, so the first occurrence
    of each is the mark itself.
    """
    if form == PLAIN:
        yield from map(_unpack, frames)
        return
    longest = max(map(len, MARKS)) - 1
    ends, found, tail, total = [], {}, b"", 0
    for frame in frames:
        piece = _unpack(frame)
        data, first = tail + piece, total - len(tail)
        for mark in MARKS:
            at = data.find(mark.encode())
            if at >= 0:
                found.setdefault(mark, first + at)
        tail, total = data[-longest:], total + len(piece)
        ends.append(total)
    order = sorted(found, key=found.get)
    stops = [found[mark] for mark in order[1:]] + [total]
    parts = {m: (found[m] + len(m), stop) for m, stop in zip(order, stops, strict=True)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        start, stop = parts[mark]
        k = bisect_right(ends, start)
        while start < stop:
            first = ends[k - 1] if k else 0
            yield _unpack(frames[k])[start - first : stop - first]
            start, k = ends[k], k + 1


def restored_digest(frames: list[bytes], form: str) -> str:
    sha = hashlib.sha256()
    for piece in restored(frames, form):
        sha.update(piece)
    return sha.hexdigest()


# --- over tables -----------------------------------------------------------------------

_TEXT_FRAMES = "frames array<binary>, units array<long>, chars array<long>, ends array<long>"


def compress_texts(docs: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(doc_id, frames, units, chars, ends): every whole text as seekable frames.

    ``units``, ``chars`` and ``ends`` are the cumulative lines, code points and UTF-8 bytes at
    each frame's end. Null is read as empty, an empty text has no frame. Every row gives one
    row, also where ids are null or repeated; other columns are not read; an empty table
    gives an empty table.
    """

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (Frames.of((t.as_py() or "").encode(), frame_bytes) for t in batch.column(1))
            made = list(zip(*((t.frames, t.units, t.chars, t.ends) for t in texts), strict=True))
            columns = made or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], _FRAMES)]
                + [pa.array(column, _COUNTS) for column in columns[1:]],
                names=["doc_id", "frames", "units", "chars", "ends"],
            )

    ship_package(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(compress, f"doc_id long, {_TEXT_FRAMES}")


def _draw(seed: int, which: int) -> Column:
    """The ``which``-th 32-bit number of the document's hash; a null id hashes as no digits."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    hexed = F.substring(F.sha2(key, 256), 8 * which + 1, 8)
    return F.conv(hexed, 16, 10).cast("long")


def fill_in_middle(
    framed: DataFrame, seed: int, percent: int = 100, spm_percent: int = 50
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``compress_texts``.

    A text of n lines is cut after two line counts drawn from (seed, doc_id), and written
    prefix-suffix-middle or suffix-prefix-middle with a mark before each part; ``percent`` of
    the documents are transformed, ``spm_percent`` of these in the second form. Empty texts
    and texts that hold a mark stay plain, with null ``prefix_chars`` and ``middle_chars``.
    ``output`` are the frames of the written document: their concatenation is one zstandard
    stream. Rows that share an id are cut at the same draws; a null id draws as any other.
    """

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text = Frames(row["frames"], row["units"], row["chars"], row["ends"])
                n, form = text.n_units, PLAIN
                prefix = middle = None
                low = high = (0, 0)
                if n and row["h3"] % 100 < percent and not text.holds_mark():
                    cuts = sorted((row["h1"] % (n + 1), row["h2"] % (n + 1)))
                    low, high = map(text.cut, cuts)
                    form = SPM if row["h4"] % 100 < spm_percent else PSM
                    prefix, middle = low[1], high[1] - low[1]
                out = arrange(text, low[0], high[0], form)
                rows.append((row["doc_id"], n, form, prefix, middle, out))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), _FRAMES]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    ship_package(framed.sparkSession)
    drawn = framed.withColumns({f"h{i + 1}": _draw(seed, i) for i in range(4)})
    return drawn.mapInArrow(
        transform,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>",
    )


def digests(outputs: DataFrame) -> DataFrame:
    """Adds ``output_sha256``, and ``restored_sha256`` of the text rebuilt from the output.

    Takes the rows of ``fill_in_middle`` and gives them back without the frames.
    """

    def hash_frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column("form").to_pylist()
            frames = [frame.as_py() for frame in batch.column("output")]
            out = [digest(f) for f in frames]
            back = [restored_digest(f, form) for f, form in zip(frames, forms, strict=True)]
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(out, pa.string()), pa.array(back, pa.string())],
                names=[*names, "output_sha256", "restored_sha256"],
            )

    ship_package(outputs.sparkSession)
    names = [name for name in outputs.columns if name != "output"]
    fields = ", ".join(f"{name} {kind}" for name, kind in outputs.dtypes if name != "output")
    return outputs.mapInArrow(hash_frames, f"{fields}, output_sha256 string, restored_sha256 string")


def decompress_outputs(outputs: DataFrame) -> DataFrame:
    """``output`` as text, for those who want the transformed documents as strings."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b"".join(map(_unpack, frames.as_py())) for frames in batch.column("output")]
            at = batch.schema.get_field_index("output")
            yield batch.set_column(at, "output", pa.array([t.decode() for t in texts], pa.string()))

    ship_package(outputs.sparkSession)
    fields = ", ".join(
        f"{name} {'string' if name == 'output' else kind}" for name, kind in outputs.dtypes
    )
    return outputs.mapInArrow(read, fields)
