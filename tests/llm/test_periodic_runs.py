"""Periodic runs against a plain search of every period, on own texts and the given table."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_tables import SF, awkward, documents, empty

from strata.llm import periodic_runs as pr
from strata.llm.queries import op11_periodic_runs


def plain_runs(words):
    """(start, length, period): every period over all words, then its smallest period."""
    known = {}
    codes = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    found = []
    for period in range(1, len(codes) // 4 + 1):
        equal = np.concatenate(([0], codes[period:] == codes[:-period], [0])).astype(np.int8)
        edges = np.flatnonzero(np.diff(equal))
        for start, end in zip(edges[0::2], edges[1::2], strict=True):
            length = int(end - start) + period
            if length < max(6, 4 * period):
                continue
            own = codes[start : start + length]
            if not any(period % d == 0 and (own[d:] == own[:-d]).all() for d in range(1, period)):
                found.append((int(start), length, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_kept(words, runs):
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()


def planted(doc_id, text):
    """The words of the query's documents."""
    words, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def runs_of(frame):
    return {
        row.doc_id: ([tuple(r[k] for k in ("start", "length", "period")) for r in row.runs], row.kept)
        for row in frame.collect()
    }


def random_words(rng):
    kinds, words = rng.choice([1, 2, 3, 60]), []
    size = rng.randrange(0, 260)
    while len(words) < size:
        part = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(1, 30))]
        words += part * rng.choice([1, 1, 2, 3, 4, 5, 9]) + part[: rng.randrange(len(part))]
    return words


@pytest.mark.parametrize("stride, hashed_from", [(2_048, 16), (16, 16), (16, 2), (64, 4)])
def test_random_words_match_plain_search(spark, monkeypatch, stride, hashed_from):
    rng = random.Random(stride + hashed_from)
    texts = [(i, " ".join(random_words(rng))) for i in range(150)]
    monkeypatch.setattr(pr, "STRIDE", stride)
    monkeypatch.setattr(pr, "HASHED_FROM", hashed_from)
    for _, text in texts:
        words = text.encode().split()
        known, found = {}, {}
        codes = np.array([known.setdefault(w, len(known)) for w in words] + [-1], np.int32)
        for batch in pr._tile_batches([0], [0, len(codes)], codes):
            tile = batch.to_pylist()[0]
            for period, s, e in pr.fragments(tile["words"], tile["octave"]):
                found.setdefault(period, []).append((tile["at"] + s, tile["at"] + e))
        stitched = []
        for period, pieces in found.items():
            merged = []
            for s, e in sorted(pieces):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(e, merged[-1][1])
                else:
                    merged.append([s, e])
            stitched += [(s, e - s + period, period) for s, e in merged]
        long = [r for r in stitched if r[1] >= max(6, 4 * r[2])]
        assert sorted(long, key=lambda r: (r[0], r[2])) == plain_runs(words)


def test_tiles_of_long_documents_are_stitched(spark):
    rng = random.Random(3)
    noise = [f"n{rng.randrange(400)}" for _ in range(6_000)]
    texts = {
        1: noise[:3_000] + noise[:1_500] * 5 + noise[3_000:],
        2: ["a"] * 9_000 + noise + ["b", "a", "c"] * 3_000,
        3: noise[:37] * 500,
        4: noise,
        5: (["x"] * 20 + ["y"]) * 400,
    }
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = runs_of(pr.periodic_runs(frame))
    for i, words in texts.items():
        words = [w.encode() for w in words]
        runs = plain_runs(words)
        assert got[i] == (runs, plain_kept(words, runs)), i
    assert got[4][0] == [] and len(got[1][0]) == 1


def test_awkward_rows(spark):
    frame = awkward(spark)
    got = pr.periodic_runs(frame).collect()
    assert len(got) == frame.count()
    wanted = sorted((str(r.doc_id), r.text or "") for r in frame.collect())
    plain = []
    for doc_id, text in wanted:
        words = text.encode().split()
        plain.append((doc_id, len(words), plain_kept(words, plain_runs(words))))
    assert sorted((str(r.doc_id), r.n_words, r.kept) for r in got) == sorted(plain)
    assert pr.periodic_runs(empty(spark)).count() == 0


def test_only_ascii_white_space_parts_words(spark):
    text = "a\xa0b a\xa0b\x1ca a\x85a　 \x0b\x0c\r\n a\xa0b"
    row = pr.periodic_runs(documents(spark, [(1, text)])).first()
    assert row.n_words == 4 and row.kept == "a\xa0b a\xa0b\x1ca a\x85a　 a\xa0b"


def test_query_matches_plain_search_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {row.doc_id: row for row in op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    with_runs = 0
    for doc_id, text in docs:
        words = planted(doc_id, text)
        runs = plain_runs(words)
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        row = got[doc_id]
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        kept = plain_kept(words, runs).encode()
        assert row.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        with_runs += bool(runs)
    assert with_runs
