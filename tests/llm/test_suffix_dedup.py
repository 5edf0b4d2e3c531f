"""Suffix-array dedup against a scan of all windows."""

import random
from collections import Counter

import numpy as np
import pytest

from llm_tables import TEXTS, awkward, documents, empty
from strata.llm import suffix_dedup as s


def plain(texts):
    seen, out = set(), []
    for doc_id, text in texts:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - s.LENGTH + 1):
            window = data[at : at + s.LENGTH]
            if window in seen:
                gone[at : at + s.LENGTH] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append(
            (
                doc_id,
                len(data),
                tuple(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)),
                kept,
            )
        )
    return out


def digest(frame):
    return [
        (
            r["doc_id"],
            r["n_bytes"],
            tuple((x["start"], x["end"]) for x in r["spans"]),
            bytes(r["kept"]),
        ) for r in frame.collect()
    ]


@pytest.fixture(scope="module")
def texts():
    """Passages at every offset and length around the limit, periodic texts, odd bytes."""
    random.seed(11)
    parts = [
        "ab",
        "the quick brown fox jumps over the lazy dog and more ",
        "é",
        "x" * 40,
        "\0",
        "zq" * 30,
        "0123456789" * 5,
    ]
    parts += ["".join(random.choices("abcdefg ", k=n)) for n in (98, 99, 100, 101, 150, 400)]
    own = [
        (100 + i, "".join(random.choice(parts) for _ in range(random.randint(0, 30)))) for i in range(60)
    ]
    return TEXTS + own + [
        (200, "a" * 3000), (201, "a" * 99), (202, "a" * 100), (203, "xyz" * 700), (204, "\0" * 500)
    ]


@pytest.mark.parametrize("crowd", [s.CROWD, 50])
def test_equals_plain_scan(spark, texts, crowd, monkeypatch):
    if crowd == 50:
        monkeypatch.setattr(s, "SORTED_TOGETHER", 100)
    assert sorted(digest(s.suffix_dedup(documents(spark, texts), crowd))) == sorted(plain(texts))


def test_awkward_rows(spark):
    frame = awkward(spark)
    texts = sorted(
        [(r["doc_id"], r["text"]) for r in frame.collect()],
        key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""),
    )
    assert Counter(digest(s.suffix_dedup(frame))) == Counter(plain(texts))
    assert s.suffix_dedup(empty(spark)).collect() == []


@pytest.mark.parametrize("size", [0, 99, 100, 101, 5000])
def test_runs_cover_each_window_once(size):
    random.seed(size)
    data = "".join(random.choices("ab c", k=size)).encode()
    _, start, windows, _ = s.runs_of(data)
    covered = [
        w for a, n in zip(start.tolist(), windows.tolist(), strict=True) for w in range(a, a + n)
    ]
    assert covered == list(range(max(size - s.LENGTH + 1, 0)))
    assert all(n <= s.PIECE for n in windows)
