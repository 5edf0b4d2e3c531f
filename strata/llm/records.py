"""Token ids as length-delimited binary records, with an offset index beside them.

A data file is a row of frames (integers little-endian):

    u64 length | u32 masked checksum of the length | payload | u32 masked checksum of the payload

The payload is ``i64 document | u8 bytes per id | ids``. A checksum is CRC-32, rotated right by
15 bits plus a constant, so that data which holds its own checksums is still checked well.

Every task writes files of a name of its own and returns their index rows; Spark commits the
index (Parquet). A file that no index row names, left by a task that was retried, does not
exist for readers. Readers go by the index: in order, or in any shuffled order by offset.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.common import keyed, ship_package
from strata.session import shared_folder

#: Words that one worker remembers before it starts anew, and the longest of them.
REMEMBERED = 350_000
LONGEST = 64
#: Documents, and bytes of text, that are encoded together; a longer document is alone.
TOGETHER = 2_000
BYTES_TOGETHER = 4_000_000
_PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
_MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_PAYLOAD = struct.Struct("<qB")

INDEX = (
    "part int, file string, seq long, key long, doc_id long, offset long, length long, n_tokens long, before long"
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return _HEAD.pack(len(payload), masked(length)) + payload + masked(payload).to_bytes(4, "little")


def unframe(data: bytes) -> bytes:
    """The payload of one frame; raises where lengths or checksums do not fit."""
    length, check = _HEAD.unpack_from(data)
    if check != masked(data[:8]) or len(data) != _HEAD.size + length + 4:
        raise ValueError("a record's length is damaged")
    payload = data[_HEAD.size : -4]
    if masked(payload) != int.from_bytes(data[-4:], "little"):
        raise ValueError("a record's content is damaged")
    return payload


def payload_of(key: int, width: int, ids: bytes) -> bytes:
    return _PAYLOAD.pack(key, width) + ids


def parse_payload(payload: bytes) -> tuple[int, np.ndarray]:
    key, width = _PAYLOAD.unpack_from(payload)
    return key, np.frombuffer(payload, f"<u{width}", offset=_PAYLOAD.size)


class WordEncoder:
    """Ids of texts under a word-level BPE whose pre-tokenizer drops white space.

    Nothing in such a vocabulary reaches across a blank or a line end, so a text's ids are its
    words' ids in a row. Arrow splits the texts and finds their distinct words; these go
    through the library once and are then remembered. Where the tokenizer lower-cases and parts
    letters from punctuation, a word of plain letters and trailing punctuation is the ids of
    its lower-cased letters and those of the punctuation, so that "End" and "end." need
    nothing new after "end".
    """

    def __init__(self, tokenizer_file: str):
        # A task has one core: the library's own threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool) if suffix else None
        if suffix:
            for token, number in self.tokenizer.get_vocab().items():
                self.ends[number] = token.endswith(suffix)
        if self._ids(["a b\nc"]) != [b"".join(self._ids(["a", "b", "c"]))]:
            raise ValueError("this tokenizer does not drop white space between words")
        tried = self._ids(["Ab", "ab", "Été.,", "été", ".,"])
        self.parts = tried[0] == tried[1] and tried[2] == tried[3] + tried[4]
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        kind = np.dtype(f"<u{self.width}")
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, kind).tobytes() for x in found]

    def _single(self, pieces: list[str]) -> list[bytes]:
        """The same for pieces that the pre-tokenizer leaves whole, in one text: twice as fast.

        Tokens that end a piece are told by the vocabulary's word-end suffix.
        """
        if not pieces or self.ends is None:
            return self._ids(pieces)
        text = "\n".join(pieces)
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        ids = np.array(found.ids, f"<u{self.width}")
        bounds = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(bounds) != len(pieces) or bounds[-1] != len(ids):
            return self._ids(pieces)
        data, width = ids.tobytes(), self.width
        return [data[a * width : b * width] for a, b in pairwise([0, *bounds])]

    def _learn(self, pieces: list[str], odd: set[str]) -> list[bytes]:
        """The ids of distinct pieces; ``odd`` are those that may not stay whole."""
        new = [piece for piece in pieces if piece not in self.known]
        whole = [piece for piece in new if piece not in odd]
        rest = [piece for piece in new if piece in odd]
        self.known.update(zip(whole, self._single(whole), strict=True))
        self.known.update(zip(rest, self._ids(rest), strict=True))
        found = [self.known[piece] for piece in pieces]
        for piece in new:
            if len(piece) > LONGEST:
                del self.known[piece]
        return found

    def _cut(self, words: pa.Array) -> tuple[pa.Array, pa.Array, set[str]]:
        """Each word's two pieces (the second may be empty), and the words not taken apart.

        Letters are those of Latin-1, which have one form under NFC and lower-case one by one;
        an apostrophe may belong to the letters after it, so it is not taken.
        """
        if not self.parts:
            return words, pa.array([""] * len(words), words.type), set(words.to_pylist())
        found = pc.extract_regex(words, _PLAIN)
        odd = set(words.filter(pc.is_null(found)).to_pylist())
        letters = pc.utf8_lower(pc.struct_field(found, "letters"))
        return pc.coalesce(letters, words), pc.fill_null(pc.struct_field(found, "marks"), ""), odd

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, in ``width`` bytes each."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        lines = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")
        split = pc.split_pattern(lines, " ")
        words = split.flatten().dictionary_encode()
        first, second, odd = self._cut(words.dictionary)
        both = pa.concat_arrays([first, second]).dictionary_encode()
        ids = self._learn(both.dictionary.to_pylist(), odd | {""})
        flat = np.frombuffer(b"".join(ids), f"<u{self.width}")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width
        starts = np.cumsum(sizes) - sizes
        # The pieces of all texts in a row, two for each word, and where each one's ids are.
        pieces = both.indices.to_numpy().reshape(2, -1)[:, words.indices.to_numpy()].T.ravel()
        lengths = sizes[pieces]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat(starts[pieces] - (ends - lengths), lengths)
        where += np.arange(total)
        data, width = flat[where].tobytes(), self.width
        per_text = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        bounds = np.concatenate([[0], ends])[2 * per_text].tolist()
        return [data[a * width : b * width] for a, b in pairwise(bounds)]


@cache
def _encoder(tokenizer_file: str) -> WordEncoder:
    return WordEncoder(tokenizer_file)


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    system, folder = fs.FileSystem.from_uri(path)
    return system, folder


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded rows and bytes of text (its last column)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy()
    first, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > first and (held + size > BYTES_TOGETHER or at - first >= TOGETHER):
            yield batch.slice(first, at - first)
            first, held = at, 0
        held += size
    if batch.num_rows:
        yield batch.slice(first)


def write_records(docs: DataFrame, path: str, tokenizer_file: str, end_id: int) -> DataFrame:
    """Encode all texts and write them in ascending order of id; returns the index.

    ``path`` is a folder that all executors reach (any file system that Arrow opens by URI).
    Documents are range-partitioned by id, one data file for each partition. Null is read as
    empty and becomes the end id alone. Rows that share an id, or have none, are documents of
    their own (null first). An empty table gives an empty index and no data file.
    """
    data = f"{path}/data"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file)
        end = end_id.to_bytes(encoder.width, "little")
        part = TaskContext.get().partitionId()
        system, folder = _folder(data)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        sink, offset, before, seq = None, 0, 0, 0
        for batch in batches:
            for slice_of in _portions(batch):
                few = list(zip(*slice_of.to_pydict().values(), strict=True))
                index: list[tuple] = []
                if sink is None:
                    system.create_dir(folder, recursive=True)
                    sink = system.open_output_stream(f"{folder}/{name}")
                for (key, doc, _), ids in zip(
                    few, encoder.encode([text or "" for _, _, text in few]), strict=True
                ):
                    record = frame(payload_of(key, encoder.width, ids + end))
                    sink.write(record)
                    n = len(ids) // encoder.width + 1
                    index.append((part, name, seq, key, doc, offset, len(record), n, before))
                    seq, offset, before = seq + 1, offset + len(record), before + n
                yield _rows(index)
        if sink is not None:
            sink.close()

    ship_package(docs.sparkSession)
    own = keyed(docs, "doc_id", "text").select("_key", F.col("doc_id").cast("long"), "text")
    ordered = own.repartitionByRange("_key").sortWithinPartitions("_key")
    ordered.mapInArrow(write, INDEX).write.parquet(f"{path}/index")
    return docs.sparkSession.read.schema(INDEX).parquet(f"{path}/index")


def _rows(index: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), *[pa.int64()] * 7]
    names = [x.split()[0] for x in INDEX.split(", ")]
    columns = [pa.array(x, kind) for x, kind in zip(zip(*index, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def read_records(index: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, ids) of the records that ``index`` names, read from the data files.

    ``index`` may be the whole index or any selection of it. ``start`` counts the ids of all
    documents before. One task reads one file from front to back; checksums are verified.
    """
    return _read(index, path, "ids array<long>", lambda ids: ids.astype(np.int64))


def record_digests(index: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the data files: CRC-32 over ids as u32."""
    return _read(index, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))


def _read(index: DataFrame, path: str, column: str, of) -> DataFrame:
    spark: SparkSession = index.sparkSession
    ship_package(spark)
    data, name = f"{path}/data", column.split()[0]
    kind = pa.list_(pa.int64()) if "array" in column else pa.int64()
    every = spark.read.schema(INDEX).parquet(f"{path}/index")
    # One row for each data file, so the running total is a few rows on the driver.
    totals = every.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    starts, total = {}, 0
    for row in totals:
        starts[row["part"]] = total
        total += row["n"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _folder(data)
        source, opened = None, ""
        for batch in batches:
            docs, begun, counts, values = [], [], [], []
            for row in batch.to_pylist():
                if row["file"] != opened:
                    source, opened = system.open_input_file(f"{folder}/{row['file']}"), row["file"]
                source.seek(row["offset"])
                key, ids = parse_payload(unframe(source.read(row["length"])))
                if key != row["key"] or len(ids) != row["n_tokens"]:
                    raise ValueError(f"the index does not fit {row['file']}")
                docs.append(row["doc_id"])
                begun.append(starts[row["part"]] + row["before"])
                counts.append(len(ids))
                values.append(of(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array(begun, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(values, kind),
                ],
                names=["doc_id", "start", "n_tokens", name],
            )

    files = max([*starts, 0]) + 1
    dealt = index.repartitionById(files, F.col("part")).sortWithinPartitions("part", "offset")
    return dealt.mapInArrow(read, f"doc_id long, start long, n_tokens long, {column}")


def new_folder(spark: SparkSession) -> str:
    """A folder for record files. They are a result, so it lies outside of scratch folders."""
    return f"{shared_folder(spark)}/strata/records-{uuid.uuid4().hex}"
