"""Small tables and brute-force versions for the operators of recspark.llm."""

import collections
import re

EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node long, salt int, digest string"


def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with the operators' own names."""
    long_text = " ".join(f"word{k % 977} tail{k % 31}." for k in range(30_000))
    passage = "the same passage of some words that comes back in other documents again"
    rows = [(1, "alpha beta gamma delta epsilon zeta", "en", "a"), (2, "alpha beta gamma delta epsilon zeta", "en", "a"),
            (2, "alpha beta gamma delta epsilon zeta", "en", "a"), (3, "", "en", "b"), (4, None, None, None), (5, "", None, "b"),
            (None, "alpha beta gamma delta epsilon zeta", "de", None), (6, long_text, "en", "a"), (7, long_text + " end", "en", "c"),
            (8, f"first line\n{passage}\nlast", "fr", "c"), (9, f"{passage}\n", "fr", "c"), (10, "   \n\t \n", "en", "c"),
            (11, "ÀÉ ñandú straße 中文 😀 \x01 x", "es", "a"), (12, "A b", "en", "a"), (13, "a  B", "en", "a"), (None, None, None, None)]
    return spark.createDataFrame([(i, t, l, s, None, "k", 1, 0, "d") for i, t, l, s in rows], EDGE_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


WORD = re.compile("[^\x20\x09-\x0D]+")
ASCII_LOWER = {k: k + 32 for k in range(65, 91)}


def shingle_set(text):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_components(rows):
    """{id: (set size, smallest id reachable)} by comparing all texts that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = collections.defaultdict(list)
    for i in sorted(sets):
        shared = collections.Counter(j for g in sets[i] for j in inverted[g])
        for g in sets[i]:
            inverted[g].append(i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def values(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
