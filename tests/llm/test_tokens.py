"""Token counts of prefixes, and token records: against the tokenizer libraries."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_tables import TEXTS, awkward, documents, empty
from strata.llm import records, token_counts
from strata.session import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = st.lists(
    st.sampled_from(
        ["a", "Foo", "É", "́", "é", " ", "  ", "\n", "▁", "'s", "'", "don't", "<s>", "<|endoftext|>", "12", "ß", "ẞ",
         "Σ", "ΑΣ", "İ", "日本", "!!", "###", "|", "\t", "\x1c", "\x00", "\x85", " ", "😀", "µ", "×", "ÿ", "<0x0A>"]
    ),
    max_size=14,
).map("".join)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def word_bpe():
    return Tokenizer.from_file(WORD_BPE)


@settings(max_examples=300, deadline=None)
@given(text=ODD)
def test_every_prefix_has_the_library_s_count(text):
    counter = token_counts._counter(PIECES)
    ends, counts = counter.table(text)
    for length in range(len(text) + 1):
        assert counter.at(text, ends, counts, length) == len(counter.model.encode(text[:length]))


def test_prefixes_within_words_follow_the_library():
    rng, counter = random.Random(5), token_counts._counter(PIECES)
    parts = ["ing", "tion", "the", "er", "th", "s", " ", "  ", "▁", "日本", "中", "é", "😀", "\n", "0", "<s>", "x" * 20]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        ends, counts = counter.table(text)
        library = [len(counter.model.encode(text[:n])) for n in range(len(text) + 1)]
        assert [counter.at(text, ends, counts, n) for n in range(len(text) + 1)] == library
        for budget in {0, 1, 2, library[-1] // 2, library[-1] - 1, library[-1], library[-1] + 5}:
            longest = max(n for n in range(len(text) + 1) if library[n] <= budget) if budget >= 0 else 0
            assert counter.fitting(text, ends, counts, budget) == longest, (text, budget)


def test_a_text_without_blanks_is_cut_within_its_word(spark, pieces):
    rng = random.Random(6)
    text = "".join(rng.choice("日本語中国人大小上下一二三的是在不了有和") for _ in range(20_000))
    row = token_counts.prefix_counts(documents(spark, [(1, text)]), PIECES, 4_096).first()
    fits = row["fits_chars"]
    assert len(pieces.encode(text[:fits])) <= 4_096 < len(pieces.encode(text[: fits + 1]))
    assert fits > 4_000


def test_counts_of_whole_texts(spark, pieces):
    got = {
        r["doc_id"]: r for r in token_counts.prefix_counts(documents(spark), PIECES, 50).collect()
    }
    for doc_id, text in TEXTS:
        row, text = got[doc_id], text or ""
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), len(pieces.encode(text)))
        assert row["n_tokens"] == (row["prefix_counts"][-1] if text else 0)
        assert len(pieces.encode(text[: row["fits_chars"]])) <= 50
        longer = next((end for end in row["prefix_ends"] if end > row["fits_chars"]), None)
        assert longer is None or len(pieces.encode(text[:longer])) > 50


def test_counts_of_awkward_rows(spark):
    frame = awkward(spark)
    got = token_counts.prefix_counts(frame, PIECES, 50, keep_tables=False)
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(
        r["doc_id"] for r in frame.collect()
    )
    assert token_counts.prefix_counts(empty(spark), PIECES, 50).collect() == []


@settings(max_examples=300, deadline=None)
@given(text=ODD)
def test_word_encoder_equals_the_library(text):
    encoder = records._encoder(WORD_BPE)
    got = np.frombuffer(encoder.encode([text])[0], "<u2").tolist()
    assert got == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@given(payload=st.binary(max_size=200), at=st.integers(0, 215), bit=st.integers(0, 7))
def test_frames_round_trip_and_find_damage(payload, at, bit):
    data = records.frame(payload)
    assert records.unframe(data) == payload
    broken = bytearray(data)
    broken[at % len(data)] ^= 1 << bit
    with pytest.raises(ValueError):
        records.unframe(bytes(broken))


def test_records_round_trip(spark, word_bpe):
    path = scratch_path(spark, "records-test")
    index = records.write_records(documents(spark), path, WORD_BPE, 2)
    wanted, start = {}, 0
    for doc_id, text in sorted(TEXTS):
        ids = [*word_bpe.encode(text or "", add_special_tokens=False).ids, 2]
        wanted[doc_id] = (start, ids)
        start += len(ids)
    got = {r["doc_id"]: (r["start"], r["ids"]) for r in records.read_records(index, path).collect()}
    assert got == wanted
    some = records.read_records(index.where(F.col("doc_id") % 2 == 1), path).collect()
    assert {r["doc_id"]: (r["start"], r["ids"]) for r in some} == {
        i: x for i, x in wanted.items() if i % 2
    }
    for row in records.record_digests(index, path).collect():
        start, ids = wanted[row["doc_id"]]
        assert tuple(row)[1:] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_records_of_awkward_rows(spark):
    frame = awkward(spark)
    path = scratch_path(spark, "records-test")
    index = records.write_records(frame, path, WORD_BPE, 2)
    got = records.read_records(index, path).orderBy("start").collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in frame.collect())
    at = 0
    for row in got:
        assert row["start"] == at and len(row["ids"]) == row["n_tokens"]
        at += row["n_tokens"]
    path = scratch_path(spark, "records-test")
    index = records.write_records(empty(spark), path, WORD_BPE, 2)
    assert records.read_records(index, path).collect() == []
