"""Small tables with the awkward cases, and brute-force versions."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards box with quiet judges near some old stone "
         "bridge where children often come to play and sing their songs of summer until the evening bell rings out")


def edge_docs(spark, extra="fp bigint, size bigint, key bigint, n_words bigint, score double, cuts string"):
    """Null in every column, empty, blank, very long and repeated texts,
    repeated rows and ids, and columns named like the operators' own."""
    long_text = " ".join(f"w{i % 997}x{i % 131}" for i in range(30_000)) + "\n" + "a" * 20_000
    rows = [
        (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, PROSE + " extra", "en", None),
        (4, None, None, None), (5, "", "en", "b"), (6, " \t\n ", "de", "b"), (7, "one", None, "b"),
        (None, PROSE, "en", "a"), (None, None, None, None), (8, long_text, "fr", "c"),
        (9, "the a\x0bb c   d\x1ce", "de", "c"), (9, "other text, same id", "de", "c"),
        (-10, "DIE " * 60, "de", "c"), (11, "é日本語 <|endoftext|> 👩‍👩‍👧 ÀÉ", "fr", "a"),
    ]
    clash = tuple(None if "string" in c else 1 for c in extra.split(", "))
    return spark.createDataFrame([r + clash for r in rows],
                                 "doc_id bigint, text string, lang string, source string, "
                                 + extra.replace("double", "bigint"))


def empty_docs(spark):
    return edge_docs(spark).limit(0)


def words(text):
    return WORD.findall(text or "")


def components(n, pairs):
    """Class number of each of n nodes, by union-find."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]
