"""Small tables with every awkward case, and plain versions of what the operators compute."""

import os
import re

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = " \t\n\x0b\x0c\r"
PASSAGE = " ".join(f"passage{i} word" for i in range(40))
LINE = "A line that very many documents hold, word by word"

#: (doc_id, text): nulls, empty, blank, very long, ties, copies, near copies, odd characters.
TEXTS = [
    (0, f"{LINE}\nfirst own text\n{LINE.lower()}  "),
    (1, f"  {LINE}\t\nsecond own text"),
    (2, f"{LINE}\r\nthird own text"),
    (3, None),
    (4, ""),
    (5, "   \n\n \t"),
    (6, PASSAGE),
    (7, PASSAGE),
    (8, f"before it {PASSAGE} and behind"),
    (9, "Été ẞtraße 日本語のテキスト 😀 ΑΣ é ▁ <s> <|endoftext|> don't x\x00y\x1cz w"),
    (10, "ab" * 3000),
    (11, "one"),
    (12, "one two"),
    (13, "one two three"),
    (14, " ".join(f"w{i % 997}" for i in range(30_000))),
    (15, " ".join(f"w{i % 997}" for i in range(30_000)) + " end"),
    (17, "\n".join(["short", LINE, "", LINE.upper()])),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(texts=TEXTS):
    return [(i, t, None if i == 4 else "en", None if i == 5 else "a", None) for i, t in texts]


def documents(spark, texts=TEXTS):
    return spark.createDataFrame(rows(texts), SCHEMA)


def awkward(spark):
    """Repeated rows, null ids, one id for two texts, and columns that operators name inside."""
    more = [
        *TEXTS,
        TEXTS[6],
        (None, "no id here"),
        (None, None),
        (11, "another text under id eleven"),
        (12, "one two"),
    ]
    frame = documents(spark, more)
    for name in (
        "_key",
        "h",
        "pos",
        "fp",
        "node",
        "component",
        "gram",
        "n_lines",
        "tokens",
        "topic",
        "score",
        "size",
        "_id",
        "quality",
        "probability",
    ):
        frame = frame.selectExpr("*", f"1 AS `{name}`")
    return frame


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    """White-space words, A-Z lower-cased."""
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, size):
    own = words(text)
    if not own:
        return []
    return [" ".join(own[i : i + size]) for i in range(max(1, len(own) - size + 1))]


def smallest_reachable(ids, links):
    """Union-find: the smallest id that each can reach."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}
