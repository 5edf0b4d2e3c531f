"""Fill-in-middle over frames against cutting the whole string."""

import hashlib
import random
import re

import pytest
from llm_tables import SF, awkward, documents, empty

from strata.llm import fill_in_middle as fim
from strata.llm.queries import op12_fill_in_middle


def plain(doc_id, text, seed=7, percent=100, spm_percent=50):
    """(n, form, prefix_chars, middle_chars, output) of a whole string."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(lines)
    if not text or any(m in text for m in fim.MARKS) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(part) for part in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_text(rng):
    alphabet = "ab é日😀\n\n <PSM>"
    return "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 90)))


@pytest.mark.parametrize("size", [1, 2, 5, 16, 65_536])
def test_frames_of_any_size_equal_whole_strings(size):
    rng = random.Random(size)
    for _ in range(400):
        text = random_text(rng)
        frames = fim.Frames.of(text.encode(), size)
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        assert b"".join(map(fim._unpack, frames.frames)).decode() == text
        assert (frames.n_units, frames.n_bytes) == (len(lines), len(text.encode()))
        assert frames.holds_mark() == any(m in text for m in fim.MARKS)
        for unit in range(len(lines) + 1):
            before = "".join(lines[:unit])
            assert frames.cut(unit) == (len(before.encode()), len(before))
        if frames.holds_mark():
            continue
        a, b = sorted(rng.randrange(len(lines) + 1) for _ in range(2))
        for form in (fim.PSM, fim.SPM, fim.PLAIN):
            out = fim.arrange(frames, frames.cut(a)[0], frames.cut(b)[0], form)
            assert b"".join(fim.restored(out, form)).decode() == text
            assert fim.digest(out) == hashlib.sha256(b"".join(map(fim._unpack, out))).hexdigest()


def test_whole_frames_are_moved_as_they_are():
    text = b"".join(b"line %d\n" % i for i in range(4_000))
    frames = fim.Frames.of(text, 1_000)
    out = fim.arrange(frames, frames.cut(1_000)[0], frames.cut(3_000)[0], fim.SPM)
    assert len(set(frames.frames) - set(out)) <= 2


@pytest.mark.parametrize("percent, spm_percent", [(100, 50), (40, 0), (0, 50), (70, 100)])
def test_awkward_rows(spark, percent, spm_percent):
    frame = awkward(spark)
    made = fim.fill_in_middle(fim.compress_texts(frame, 700), 7, percent, spm_percent)
    got = [tuple(r) for r in fim.decompress_outputs(made).collect()]
    wanted = [(r.doc_id, *plain(r.doc_id, r.text, 7, percent, spm_percent)) for r in frame.collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    hashed = fim.digests(made).collect()
    texts = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in frame.collect())
    assert sorted(r.restored_sha256 for r in hashed) == texts


def test_empty_table_and_marks(spark):
    assert fim.digests(fim.fill_in_middle(fim.compress_texts(empty(spark)), 7)).count() == 0
    marked = documents(spark, [(i, f"x\n{mark}\ny\n") for i, mark in enumerate(fim.MARKS)])
    forms = {r.form for r in fim.fill_in_middle(fim.compress_texts(marked, 3), 7).collect()}
    assert forms == {"plain"}


def test_query_matches_whole_strings_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {row.doc_id: tuple(row) for row in op12_fill_in_middle(spark, SF).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        *measures, output = plain(doc_id, text)
        hashes = [hashlib.sha256(t.encode()).hexdigest() for t in (output, text or "")]
        assert got[doc_id] == (doc_id, *measures, *hashes)
