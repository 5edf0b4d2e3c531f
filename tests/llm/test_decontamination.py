"""Benchmark decontamination against a plain scan."""

import os
import re
import subprocess
import sys
from collections import Counter

import pytest

from llm_tables import LOWER, PASSAGE, TEXTS, awkward, documents, empty
from strata.llm import decontamination as d

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

ITEMS = [
    (1, PASSAGE),
    (
        2,
        "PASSAGE3 word passage4 word passage5 word passage6 word passage7 word passage8 word, and more words after",
    ),
    (3, "ONE, two!"),
    (4, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"),
    (5, None),
    (6, " ,;"),
    (None, "first own text"),
    (3, "one"),
    (10, "nowhere to be found at all in any of the texts above here"),
]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, n_words int")


def own_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(texts, items):
    windows = []
    for item, text in items:
        own = own_words(text)
        windows += [(item, own[i : i + 10]) for i in range(max(len(own) - 9, 1))] if own else []
    out = []
    for doc_id, text in texts:
        own, hit, found = own_words(text), set(), set()
        starts = {}
        for i, word in enumerate(own):
            starts.setdefault(word, []).append(i)
        for item, window in windows:
            for i in starts.get(window[0], ()):
                if own[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found |= {str(item)} if item is not None else set()
        out.append((doc_id, len(own), len(hit), tuple(sorted(found))))
    return out


def digest(found):
    return [
        (
            r["doc_id"],
            r["n_words"],
            sum(x["end"] - x["start"] for x in r["spans"]),
            tuple(r["items"]),
        ) for r in found.collect()
    ]


@pytest.mark.parametrize("at_once", [500_000, 7])
def test_equals_plain_scan(spark, at_once):
    got = digest(d.find_contamination(documents(spark), benchmark(spark), at_once=at_once))
    assert sorted(got) == sorted(plain(TEXTS, ITEMS))


@pytest.mark.parametrize("at_once", [500_000, 7])
def test_awkward_rows(spark, at_once):
    frame = awkward(spark)
    texts = [(r["doc_id"], r["text"]) for r in frame.collect()]
    assert Counter(digest(d.find_contamination(frame, benchmark(spark), at_once=at_once))) == Counter(plain(texts, ITEMS))
    kept = d.without_contaminated(frame, benchmark(spark), at_once=at_once)
    assert kept.columns == frame.columns
    clean = Counter(i for i, _, n, _ in plain(texts, ITEMS) if not n)
    assert Counter(r["doc_id"] for r in kept.collect()) == clean


def test_empty_tables(spark):
    assert d.find_contamination(empty(spark), benchmark(spark)).collect() == []
    none = benchmark(spark, [])
    assert all(not r["spans"] for r in d.find_contamination(documents(spark), none).collect())
    assert d.without_contaminated(documents(spark), none).count() == len(TEXTS)


def test_spans_are_word_runs(spark):
    row = next(
        r for r in d.find_contamination(documents(spark), benchmark(spark, ITEMS[:1])).collect() if r["doc_id"] == 8
    )
    assert [(x["start"], x["end"]) for x in row["spans"]] == [(2, 82)]


@pytest.mark.parametrize("at_once", [500_000, 7])
def test_rows_without_id_are_judged_by_themselves(spark, at_once):
    texts = [(None, PASSAGE), (None, "clean and without id"), (None, None), (1, PASSAGE), (2, "clean")]
    kept = d.without_contaminated(documents(spark, texts), benchmark(spark), at_once=at_once)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        [(None, "clean and without id"), (None, None), (2, "clean")]
    )


@pytest.mark.parametrize("at_once", [500_000, 7])
def test_rows_that_share_an_id_are_judged_by_themselves(spark, at_once):
    texts = [(1, PASSAGE), (1, "clean under the same id"), (1, "clean under the same id"), (2, "clean")]
    kept = d.without_contaminated(documents(spark, texts), benchmark(spark), at_once=at_once)
    assert sorted(r["text"] for r in kept.collect()) == sorted(t for _, t in texts[1:])


def test_alone_in_a_session_whose_workers_do_not_find_the_package(tmp_path):
    code = f"""
import sys
sys.path[:0] = {[REPO, os.path.dirname(os.path.abspath(__file__))]!r}
import test_decontamination as t
from strata.session import build_session
spark = build_session("alone", "local[1]", **{{"spark.ui.enabled": "false"}})
from llm_tables import documents
print("kept", t.d.without_contaminated(documents(spark), t.benchmark(spark)).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "kept " in done.stdout
