"""Token counts of every prefix, by dynamic programming over the text.

A vocabulary whose pieces hold the space mark only at their start (or as a run of marks)
never merges across the end of a word. The count of a prefix is then

    count(prefix) = count(up to the last whole word) + count(the word begun)

so one running sum over words holds the exact count at every word end. Within a word the counts
of all its prefixes come from dynamic programming over pieces: the last piece of a prefix is the
longest vocabulary piece that may stand behind the last piece of what is before it, where two
pieces may stand together if the model gives them back when it encodes the two alone. Pairs are
remembered, so truncation and budget questions need no second encoding of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship_package

#: Words that one worker remembers before it starts anew.
REMEMBERED = 400_000
#: Code points of the longest word worth remembering.
LONGEST = 64
MARK = "▁"
#: A character that no piece holds: what follows it is encoded as if nothing were before.
ALONE = "\ue000"
_WORDS = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")


class PrefixCounter:
    """Exact token counts of prefixes for a SentencePiece model."""

    def __init__(self, model_file: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("pieces cross word ends: prefixes cannot be counted word by word")
        self.known = _Known(self.model)
        self.pieces = {
            self.model.id_to_piece(i)
            for i in range(self.model.get_piece_size())
            if not any(
                kind(i)
                for kind in (
                    self.model.is_control, self.model.is_unknown, self.model.is_byte, self.model.is_unused,
                )
            )
        }
        if any(ALONE in piece for piece in self.pieces):
            raise ValueError("no character is free to part pieces")
        self.longest = max(map(len, self.pieces))
        self.opening = len(self.model.encode(ALONE, num_threads=1))
        self.pairs: dict[tuple[str, str], bool] = {}

    def _alone(self, text: str) -> list[int]:
        """Tokens of a text as if it stood behind something, without the mark of a beginning."""
        return self.model.encode(ALONE + text, num_threads=1)[self.opening :]

    def _together(self, left: str, right: str) -> bool:
        """Whether one piece may follow the other: both stay what they are."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            found = self._alone(left + right) == self._alone(left) + self._alone(right)
            self.pairs[left, right] = found
        return found

    def inside(self, unit: str) -> np.ndarray:
        """Tokens of every prefix of a unit, one code point and more, behind the model's mark.

        A code point that no piece holds is as many tokens as the model gives for it alone.
        """
        text = MARK + unit.replace(" ", MARK)
        last, counts = [""], [0]
        for end in range(1, len(text) + 1):
            for size in range(min(self.longest, end), 0, -1):
                piece = text[end - size : end]
                if piece not in self.pieces and size > 1:
                    continue
                before = end - size
                if before == 0 or self._together(last[before], piece):
                    more = 1 if piece in self.pieces else len(self._alone(piece))
                    last.append(piece)
                    counts.append(counts[before] + more)
                    break
            else:
                raise ValueError("no piece fits: the vocabulary is not one of merged pairs")
        return np.array(counts[2:], np.int64)

    def _unit(self, unit: str, first: bool) -> int:
        """Tokens of spaces and a word; the model puts a mark before the text's first unit."""
        if first:
            return self.known[unit]
        if unit in (" ", MARK):
            return self.mark
        return self.known[unit[1:]]

    @property
    def mark(self) -> int:
        """Tokens of a single mark: what "a " has beyond "a"."""
        return self.known["a "] - self.known["a"]

    def table(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ends, counts): the code points up to each word's end, and the tokens up to there."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if text[0] != " " and text[-1] != " " and "  " not in text and MARK not in text:
            words = text.split(" ")
            n = len(words)
            counts = np.fromiter(map(self.known.__getitem__, words), np.int64, n)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        else:
            units = _WORDS.findall(text)
            counts = np.array([self._unit(u, i == 0) for i, u in enumerate(units)], np.int64)
            ends = np.cumsum([len(unit) for unit in units])
        return ends, np.cumsum(counts)

    def at(self, text: str, ends: np.ndarray, counts: np.ndarray, length: int) -> int:
        """Tokens of ``text[:length]``, from the table."""
        if length <= 0 or not len(ends):
            return 0
        whole_words = int(np.searchsorted(ends, length, "right"))
        start = int(ends[whole_words - 1]) if whole_words else 0
        done = int(counts[whole_words - 1]) if whole_words else 0
        rest = text[start:length]
        if whole_words and rest:
            if len(rest) == 1:
                return done + self.mark
            rest = rest[1:]
        return done + (int(self.inside(rest)[-1]) if rest else 0)

    def fitting(self, text: str, ends: np.ndarray, counts: np.ndarray, budget: int) -> int:
        """The code points of the longest prefix with at most ``budget`` tokens.

        Counts grow with every word, so the longest prefix ends in the first word that does
        not fit as a whole. Within it they need not grow with every code point.
        """
        whole_words = int(np.searchsorted(counts, budget, "right"))
        start = int(ends[whole_words - 1]) if whole_words else 0
        if whole_words == len(ends):
            return start
        left = budget - (int(counts[whole_words - 1]) if whole_words else 0)
        unit, fits = text[start : int(ends[whole_words])], start
        if whole_words:
            unit, start = unit[1:], start + 1
            fits = start if self.mark <= left else fits
        within = np.flatnonzero(self.inside(unit) <= left) if unit else ()
        return start + int(within[-1]) + 1 if len(within) else fits


class _Known(dict):
    """Counts of units as the model encodes them alone, filled on demand."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, unit: str) -> int:
        n = len(self.model.encode(unit, num_threads=1))
        if len(unit) <= LONGEST:
            self[unit] = n
        return n


@cache
def _counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


def prefix_counts(
    docs: DataFrame, model_file: str, budget: int, keep_tables: bool = True
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, fits_chars, prefix_ends, prefix_counts) of every whole text.

    ``prefix_ends`` and ``prefix_counts`` are the text's table at every word end (left out with
    ``keep_tables=False``); ``fits_chars`` is the longest prefix of any kind within ``budget``
    tokens (``PrefixCounter.at`` tells the count of any other prefix).
    Counts are those of the model without begin, end or added special tokens. Null is read as
    empty and has no token; every row gives one row, whatever its id. Other columns are not
    read; an empty table gives an empty table. A text without blanks is one word, however long:
    its prefixes take time in proportion to its length. ``model_file`` must exist under that path on every executor.
    """
    tables = ", prefix_ends array<int>, prefix_counts array<int>" if keep_tables else ""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for batch in batches:
            sizes, totals, fits, all_ends, all_counts = [], [], [], [], []
            for scalar in batch.column(1):
                text = scalar.as_py() or ""
                ends, counts = counter.table(text)
                sizes.append(len(text.encode()))
                totals.append(int(counts[-1]) if len(counts) else 0)
                fits.append(counter.fitting(text, ends, counts, budget))
                if keep_tables:
                    all_ends.append(ends.astype(np.int32))
                    all_counts.append(counts.astype(np.int32))
            columns = [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array(fits, pa.int64()),
            ]
            names = ["doc_id", "n_bytes", "n_tokens", "fits_chars"]
            if keep_tables:
                columns += [pa.array(x, pa.list_(pa.int32())) for x in (all_ends, all_counts)]
                names += ["prefix_ends", "prefix_counts"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ship_package(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(
        count, f"doc_id long, n_bytes long, n_tokens long, fits_chars long{tables}"
    )
