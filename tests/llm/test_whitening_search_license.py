"""Whitening, reversed ranked search and license templates against brute force."""

import collections
import math
import random
import re

import numpy as np
import pytest
from conftest import SMOKE
from helpers import edge_docs, empty_docs

from recspark.llm import QUERIES, lexical_search, license_scan, whitening

# ---- whitening ----

VECTORS = "vec_id long, embedding array<float>, component int, x string"


def brute_whitening(rows, k=16):
    """{vec_id: (n, deviation, whitened up to the components' signs)}, explained shares; numpy's own eigen solver."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    out = [(i, n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), np.array([(n * c - s) / n for c, s in zip(x, sums)]) @ q / np.sqrt(e)) for i, x in kept]
    return out, e / np.trace(y.T @ y / n)


def table(rows, k):
    """vec_id -> matrix rows of a whitened result, sorted by component."""
    got = collections.defaultdict(list)
    for r in rows:
        got[r.vec_id].append(r)
    return {i: sorted(rs, key=lambda r: r.component) for i, rs in got.items()}


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 20)) * np.geomspace(4, 0.2, 20)
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(np.vstack([base, base[:15], np.repeat(base[:1], 40, axis=0)]))]
    bad = [(900, None), (901, []), (902, [None] + [0.0] * 19), (903, [float("nan")] * 20), (904, [float("inf")] * 20), (905, [1.0] * 3)]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows + bad], VECTORS)
    want, share = brute_whitening(rows)
    got = table(whitening.whiten(df).collect(), 16)
    assert set(got) == {i for i, _ in rows}
    w = np.array([[r.whitened for r in got[i]] for i, *_ in want])
    b = np.array([x[3] for x in want])
    assert np.abs(w * np.sign((w * b).sum(axis=0)) - b).max() < 1e-9
    assert [(got[i][0].n, got[i][0].deviation) for i, *_ in want] == [(n, d) for _, n, d, _ in want] == [(60, d) for _, _, d, _ in want]
    assert np.allclose([r.explained for r in got[0]], share, rtol=1e-10) and all(r.identity_error < 1e-9 for r in got[0])
    assert [r.component for r in got[0]] == list(range(1, 17))


def test_whitening_query_on_a_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMOKE}/embeddings.parquet").collect()]
    want, share = brute_whitening(rows)
    got = table(QUERIES["op11_qdwh_whitening"](spark, SMOKE).collect(), 16)
    w, b = np.array([[r.whitened for r in got[i]] for i, *_ in want]), np.array([x[3] for x in want])
    assert len(got) == len(rows) and np.abs(w * np.sign((w * b).sum(axis=0)) - b).max() < 1e-7
    assert [(got[i][0].n, got[i][0].deviation) for i, *_ in want] == [(n, d) for _, n, d, _ in want]
    assert np.allclose([r.explained for r in got[rows[0][0]]], share, rtol=1e-9) and got[rows[0][0]][0].identity_error < 1e-9


def test_whitening_defined_cases(spark):
    make = lambda rows: spark.createDataFrame([(i, v, 0, None) for i, v in rows], VECTORS)
    empty = whitening.whiten(make([]))
    assert empty.collect() == [] and empty.columns == [f.split()[0] for f in whitening.RESULT.split(", ")]
    assert whitening.whiten(make([(1, None), (2, [])])).collect() == []
    assert whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # one distinct vector: no variance
    got = whitening.whiten(make([(1, [0.0, 5.0, 1.0]), (None, [1.0, 5.0, 1.0]), (1, [0.0, 5.0, 1.0]), (3, [9e18, 0.0, 0.0]), (4, [1.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, round(r.whitened, 12)) for r in got if r.vec_id) == [(1, 1, 2, 4096, got[0].whitened)] * 2
    assert [abs(r.whitened) for r in got] == [1.0] * 3 and [r.explained for r in got] == [1.0] * 3  # rank one of three dimensions
    far = whitening.whiten(make([(1, [4e15, 0.0]), (2, [-4e15, 1.0]), (3, [0.0, 7.0])])).collect()
    assert {r.deviation for r in far if r.vec_id < 3} == {None} and all(math.isfinite(r.whitened) for r in far)


@pytest.mark.parametrize("name, e", [("tied", [5.0] * 6 + [1.0] * 10), ("graded", np.geomspace(1, 1e-10, 24)), ("one", [2.0]), ("flat", [1.0] * 9),
                                     ("rank", [3.0, 2.0, 2.0, 1.0] + [0.0] * 12), ("close", 1 + 1e-9 * np.arange(12.0))])
def test_spectrum_by_divide_and_conquer(name, e):
    q = np.linalg.qr(np.random.default_rng(len(e)).standard_normal((len(e), len(e))))[0]
    a = q @ np.diag(e) @ q.T
    a = (a + a.T) / 2
    got, axes = whitening.spectrum(a, 16)
    want = np.linalg.eigvalsh(a)[::-1][:len(got)]
    assert len(got) == min(16, sum(np.array(e) > 0)) and np.abs(got - want).max() < 1e-13 * want[0]
    assert np.abs(a @ axes - axes * got).max() < 1e-13 * want[0] and np.abs(axes.T @ axes - np.eye(len(got))).max() < 1e-13


def test_polar_factor_is_orthogonal_and_keeps_signs():
    a = np.diag([3.0, -2.0, 1e-9, -1e-12])
    assert np.abs(whitening.polar_factor(a) - np.diag([1.0, -1, 1, -1])).max() < 1e-12


# ---- reversed search ----

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def brute_search(docs, items, k=10):
    terms = [(i, TERM.findall(t.translate(LOWER))) for i, t in docs if t is not None]
    terms = [(i, t) for i, t in terms if t]
    n_docs, total = len(terms), sum(len(t) for _, t in terms)
    df = collections.Counter(x for _, t in terms for x in set(t))
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        asked, scores = TERM.findall(text.translate(LOWER)), []
        for i, t in terms:
            tf, m = collections.Counter(t), 100 - 75 + (75 * len(t) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1000000000 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in asked if tf[x])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


ITEMS = [(1, "alpha GAMMA gamma, delta"), (2, "word1 word2 tail3 end"), (3, None), (4, "!!"), (5, "ñandú 中文 zeta"), (None, "passage of some words"),
         (1, "alpha GAMMA gamma, delta"), (6, "absent words only here qqq"), (7, "straße 😀x"), (8, "the same line")]


@pytest.mark.parametrize("block", [1 << 20, 4])
def test_search_equals_brute_force_on_edge_cases(spark, block):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(i, t, 0, 1) for i, t in ITEMS], "item_id long, text string, rank int, score int")
    got = found(lexical_search.search(docs, items, block_terms=block))
    assert got == brute_search([(r.doc_id, r.text) for r in docs.collect()], ITEMS) and got
    assert found(lexical_search.search(empty_docs(spark), items)) == [] == found(lexical_search.search(docs, items.where("false")))


@pytest.mark.parametrize("seed", [1, 2])
def test_search_equals_brute_force_on_random_texts(spark, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(k, " ".join(rng.choices(words, k=rng.choice([1, 5, 30, 200])))) for k in range(300)] + [(1000 + k, "w1 w2 w3") for k in range(150)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 4, 25])))) for k in range(23)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert found(lexical_search.search(df, spark.createDataFrame(items, "item_id long, text string"), block_terms=40)) == brute_search(docs, items)


def test_search_steps_over_a_very_long_document(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "CELLS", 7)  # many steps, also within a document
    docs = [(k, " ".join(f"t{(k * j) % 13}" for j in range(40))) for k in range(30)]
    items = [(k, f"t{k} t{k + 1} t{k}") for k in range(12)]
    got = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found(got) == brute_search(docs, items)


# ---- license templates ----

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_labels(text):
    s = "".join(f" {w} " for w in WORD.findall((text or "").translate(LOWER)))
    return {label for label, markup in license_scan.TEMPLATES if re.search(license_scan._pattern(markup), s)}


def brute_base(text):
    w = WORD.findall((text or "").translate(LOWER))
    at = [(k, label) for phrase, label in license_scan.PHRASES for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
    return len(w), at


def plain(markup, fill="Some Body"):
    """A text that a template accepts: without its optional regions, replaceable ones filled."""
    out = re.sub(r"<<var;words=(\d+)-\d+>>", lambda m: " ".join((fill.split() * 9)[:max(1, int(m[1]))]), markup)
    while "<<beginOptional>>" in out:
        out = re.sub(r"<<beginOptional>>(?:(?!<<beginOptional>>).)*?<<endOptional>>", " ", out, flags=re.S)
    return out


def test_licenses_equal_brute_force(spark):
    full = [re.sub("<<(begin|end)Optional>>", " ", re.sub(r"<<var;words=\d+-(\d+)>>", lambda m: "x " * int(m[1]), t)) for _, t in license_scan.TEMPLATES]
    bare = [plain(t) for _, t in license_scan.TEMPLATES]
    broken = [re.sub(r"\bthe\b", "a", t, count=1) for t in bare] + [t.replace(" x x", " x x x", 1) for t in full]
    rng = random.Random(5)
    words = "cc by mit license apache gnu general public the licensed under version 3 0 4 nc or later".split()
    noise = [" ".join(rng.choices(words, k=60)) for _ in range(60)]
    texts = full + bare + broken + noise + ["cc by cc by", "MIT LICENSE", "mit-license!", "accc by", "", None, "...", "CC BY", "cc by " * 20_000 + full[0]]
    texts += [f"{a}\n{b}" for a, b in zip(full, bare[1:])]
    rows = [(k if k % 9 else None, t, t, 1) for k, t in enumerate(texts)]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, spans string, score int")).collect()
    assert len(got) == len(rows) and [r.doc_id for r in got] == [r[0] for r in rows]
    for r, text in zip(got, texts):
        n, at = brute_base(text)
        labels = brute_labels(text)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and r.labels == ",".join(sorted(labels | {x for _, x in at}))
        assert r.score == (1.0 if labels else 0.5 if at else 0.0) and {s.split(":")[0] for s in r.spans.split(",") if s} == labels
    for (label, _), a, b, c in zip(license_scan.TEMPLATES, got, got[len(full):], got[2 * len(full):]):
        assert label in a.labels.split(",") and label in b.labels.split(",")
    assert sum(r.score < 1 for r in got[2 * len(full):3 * len(full)]) > len(full) // 2  # a changed mandatory word is not accepted


def test_license_spans_are_the_accepted_words():
    auto = license_scan.TokenAutomaton("alpha <<beginOptional>>beta <<beginOptional>>gamma<<endOptional>><<endOptional>> <<var;words=0-2>> omega")
    find = lambda t: auto.find(license_scan.words_of(t))
    assert find("x alpha omega alpha beta gamma one two omega y") == [(1, 3), (3, 9)]
    assert find("alpha beta gamma one two three omega") == [] and find("alpha gamma omega") == [(0, 3)]
    assert find("alpha alpha omega") == [(0, 3)] and find("omega alpha") == [] and find("") == []


@pytest.mark.parametrize("markup", ["", "<<var;words=1-3>>", "<<beginOptional>>a<<endOptional>>", "a<<beginOptional>>b", "a<<endOptional>>", "a <<var;words=3-1>>"])
def test_bad_templates_are_refused(markup):
    with pytest.raises(ValueError):
        license_scan.TokenAutomaton(markup)


def test_license_edge_tables(spark):
    got = license_scan.scan_licenses(edge_docs(spark)).collect()
    assert len(got) == edge_docs(spark).count() and all(r.score == 0 for r in got)
    assert license_scan.scan_licenses(empty_docs(spark)).collect() == []
