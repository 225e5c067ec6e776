import collections
import hashlib
import random

import duckdb
import numpy as np
import pytest
from conftest import SMOKE
from helpers import edge_docs, empty_docs, near_components, values

from recspark.llm import components, exact_dedup, line_dedup, near_dedup, shingles

LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()


def test_exact_edge_cases(spark):
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup.exact_dedup(edge_docs(spark)).collect()}
    alpha = [r for r in got.values() if r.keep_id == 2 and r.group_size == 4]
    assert {(r.doc_id, r.keep_id, r.kept) for r in alpha} == {(1, 2, False), (2, 2, True), (None, 2, False)}
    blank = [r for r in got.values() if r.keep_id == 5]  # empty and null texts are equal
    assert {(r.doc_id, r.kept, r.group_size) for r in blank} == {(3, False, 4), (4, False, 4), (5, True, 4), (None, False, 4)}
    assert exact_dedup.exact_dedup(edge_docs(spark)).count() == 16
    assert exact_dedup.exact_dedup(empty_docs(spark)).count() == 0


def test_exact_kept_rows_and_smallest(spark):
    docs = edge_docs(spark)
    kept = exact_dedup.keep_first_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5, 6, 7, 8, 9, 10, 11, 12, 13]  # the repeated row once
    small = exact_dedup.exact_dedup(docs, keep="smallest").where("group_size = 4").select("keep_id").distinct()
    assert {r.keep_id for r in small.collect()} == {1, 3}
    assert exact_dedup.keep_first_copies(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("fan_in", [2, 8])
def test_tree_merge_over_many_runs(spark, fan_in):
    docs = spark.createDataFrame([(i, f"text {i % 37 if i % 3 else 0}") for i in range(900)], "doc_id long, text string").repartition(23)
    want = {}
    for i in range(900):
        want.setdefault(f"text {i % 37 if i % 3 else 0}", []).append(i)
    got = values(exact_dedup.exact_dedup(docs, fan_in=fan_in), "doc_id", "keep_id", "group_size")
    assert got == sorted(((i, max(g), len(g)) for g in want.values() for i in g), key=repr)


def test_merge_refuses_different_texts_with_one_digest(spark):
    runs = spark.createDataFrame([(1, "aa" * 32, 5, 11, 0), (2, "aa" * 32, 6, 11, 1)],
                                 "doc_id long, text_sha256 string, n_bytes long, check long, run int")
    with pytest.raises(Exception, match="share the digest"):
        exact_dedup.digest_groups(runs, 2).collect()


def test_near_edge_cases(spark):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(edge_docs(spark)).collect()}
    assert {(1, 2, 1, True), (2, 2, 1, False), (None, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (None, 0, None, False),
            (12, 1, 12, True), (13, 1, 12, False), (10, 0, 10, True)} <= got
    assert [x[2] for x in got if x[0] in (6, 7)] == [6, 6]
    assert near_dedup.near_duplicates(edge_docs(spark)).count() == 16
    assert near_dedup.near_duplicates(empty_docs(spark)).count() == 0
    kept = near_dedup.keep_representatives(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    # 8 and 9 share 9 of 12 shingles: exactly at the threshold
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6, 8, 10, 11, 12]


def check_near(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, **options).collect()}
    want = near_components(rows)
    assert got == want
    return want


def test_near_against_brute_force_with_chains_and_a_hot_group(spark):
    rng = random.Random(5)
    base = [rng.choice(LONG) + str(rng.randint(0, 60)) for _ in range(120)]
    rows = []
    for i in range(160):  # near copies of one text
        w = list(base)
        w[rng.randrange(120)] = f"edit{i}"
        rows.append((1000 + i, " ".join(w)))
    chain = [f"c{k}" for k in range(60)]
    for i in range(25):  # each like the next one, the ends unlike
        rows.append((2000 + i, " ".join(chain[i:] + [f"d{k}" for k in range(i)])))
    rows += [(3000 + i, " ".join(rng.choice(LONG) for _ in range(rng.randint(0, 12)))) for i in range(120)]
    rows.append((1, rows[0][1]))
    want = check_near(spark, rows, tile=16)
    assert {want[1000 + i][1] for i in range(160)} == {1} and len({c for _, c in want.values()}) > 20


def test_near_on_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMOKE}/documents.parquet'").fetchall()
    check_near(spark, rows)


def test_tiles_find_links_that_no_hub_has(spark):
    """A bucket whose hub is like nobody: its other members still meet."""
    nodes, sig = [], np.arange(128, dtype=np.uint32)
    for k in range(12):
        s = sig.copy() + (1000 if k == 0 else 0)
        s[k:k + 2] += 7 * k
        nodes.append((k, 100, bytes(16), s.tobytes()))
    frame = spark.createDataFrame(nodes, "node long, n_shingles long, digest binary, sig binary")
    members = spark.createDataFrame([(1, k) for k in range(12)], "key long, node long")
    comps = spark.createDataFrame([], "node long, component long")
    floors = near_dedup.least_matches(128, 16, 75, 1e-9)
    tiles = near_dedup.remaining_tiles(members, frame, comps, floors, 75, tile=4)
    both = [(r.key, r.kind, r.i, r.j, r.node) for r in tiles.collect()]
    assert {x[-1] for x in both} == set(range(1, 12))
    together = {(a[-1], b[-1]) for a in both for b in both if a[:4] == b[:4] and a[-1] < b[-1]}
    assert together >= {(a, b) for a in range(1, 12) for b in range(a + 1, 12)}


def test_posterior_bounds():
    floors = near_dedup.least_matches(128, 16, 75, 1e-3)
    for n, m in floors.items():  # by numerical integration of the Beta posterior
        s = np.linspace(0, 1, 20_001)
        density = lambda k: s ** k * (1 - s) ** (n - k)
        tail = lambda k: density(k)[s >= 0.75].sum() / density(k).sum()
        assert tail(m) >= 0.9e-3 and (m == 0 or tail(m - 1) < 1.1e-3)


def test_similarity_is_estimated_by_signatures():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, b = np.unique(pool[:3000]), np.unique(pool[1000:])
    x, y = shingles.Signer(512).signatures([a, b])
    assert abs((x == y).mean() - 0.5) < 0.08


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    got = dict(values(components.components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert got == {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 160)}


def brute_runs(rows, by="clause", least=30):
    """{(doc_id, text): [(start, stop, words as text)]} of the units in repeated runs, in two rounds, rows counted one by one."""
    live = [[(a, b, b" ".join(w).decode(), len(w), k) for k, (a, b, w) in enumerate(line_dedup.units_of(t, by))] if t else [] for _, t in rows]
    for _ in range(2):
        n = collections.Counter(u[2] for units in live for u in units)
        kept = []
        for units in live:
            runs, last = [], None
            for u in units:
                if n[u[2]] > 1:
                    runs = runs if last is not None and u[4] == last + 1 else [*runs, []]
                    runs[-1].append(u)
                    last = u[4]
            kept.append([u for run in runs if sum(x[3] for x in run) >= least for u in run])
        live = kept
    return live


def check_runs(spark, rows, by="clause", least=30):
    live = brute_runs(rows, by, least)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, int(hashlib.md5((rows[k][1] or "").encode()).hexdigest()[:15], 16)))
    first, copies = {}, collections.Counter(u[2] for units in live for u in units)
    for k in order:
        for u in live[k]:
            first.setdefault(u[2], (rows[k], u[4]))
    want = set()
    for k in order:
        later, stretches = {}, []
        for u in live[k]:
            later[u[4]] = first[u[2]] != (rows[k], u[4])
            joins = stretches and stretches[-1][-1][4] == u[4] - 1 and later[u[4] - 1] == later[u[4]]
            stretches = stretches[:-1] + [[*stretches[-1], u]] if joins else [*stretches, [u]]
        for units in stretches:
            cut = later[units[0][4]] and sum(u[3] for u in units) >= least
            want |= {(rows[k][0], u[4], u[0], u[1], u[3], hashlib.md5(u[2].encode()).hexdigest(), first[u[2]][0][0], first[u[2]][1], copies[u[2]], cut)
                     for u in units}
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, unit int, digest string")
    got = line_dedup.repeated_units(docs, by, least)
    assert got.columns == "doc_id unit start stop words digest keep_doc_id keep_unit copies cut".split()
    got = [tuple(r) for r in got.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(set(got)) == len(got)
    return want, docs


@pytest.mark.parametrize("by", ["clause", "line", "paragraph"])
def test_runs_equal_brute_force(spark, by):
    rng = random.Random(11)
    line = lambda: " ".join(rng.choice(LONG) for _ in range(rng.randint(1, 5))) + rng.choice([".", "!", ",", "", ";"])
    verses = [line() for _ in range(40)]
    rows = []
    for k in range(60):
        a = rng.randrange(30)
        part = verses[a:a + rng.randint(1, 9)]
        own = [line() for _ in range(rng.randint(0, 6))]
        body = own[:len(own) // 2] + part + own[len(own) // 2:]
        rows.append((k if k % 13 else None, rng.choice(["\n", " ", "\n\n", "\n \t\n"]).join(body)))
    rows += [(70, None), (71, ""), (72, " \n\t"), rows[5], rows[5], (5, "another text of the id"), (90, "ÀÉ b c. " * 30), (91, "a" * 50_000)]
    want, _ = check_runs(spark, rows, by, 12)
    assert want and any(x[-1] for x in want) and not all(x[-1] for x in want)


def test_runs_of_short_lines_passages_inside_lines_and_chance_repeats(spark):
    verse = "\n".join(f"verse {k}\nof it" for k in range(12))  # lines of two words each
    passage = ", ".join(f"clause{k} with some words" for k in range(13)) + "."
    rows = [(1, f"A beginning here.\n{verse}\nEnd one."), (2, f"{verse}\nother end"), (3, f"This line goes on and then {passage} Nothing more."),
            (4, f"Unlike, but {passage} So it ends\nand goes on"), (5, "All rights reserved."), (6, "All rights reserved.\nA text of its own"),
            (7, "All rights reserved.\nAnother text"), (8, verse.replace("\n", "\n\n"))]
    want, docs = check_runs(spark, rows)
    assert {x[0] for x in want} == {1, 2, 3, 4, 8} and {x[0] for x in want if x[-1]} == {2, 4, 8}
    kept = {r.doc_id: r for r in line_dedup.remove_repeats(docs).collect()}
    assert kept[1].text == rows[0][1] and kept[3].text == rows[2][1] and kept[2].text == "other end" and kept[8].text == ""
    assert kept[4].text.startswith("Unlike, but clause0 with some words,") and kept[4].text.endswith(" So it ends\nand goes on") and "clause5" not in kept[4].text
    assert [kept[k].text for k in (5, 6, 7)] == [rows[4][1], rows[5][1], rows[6][1]]
    assert line_dedup.remove_repeats(docs).columns == docs.columns and kept[1].unit == 1


def test_chance_runs_fall_out_in_the_second_round(spark):
    """A run put together from units that recur elsewhere alone is none."""
    units = [f"short unit number {k}." for k in range(9)]
    rows = [(1, " ".join(units))] + [(10 + k, f"{u} own text {k} here") for k, u in enumerate(units)]
    assert check_runs(spark, rows, least=20)[0] == set()


def test_removal_keeps_to_the_text_whose_offsets_it_has(spark):
    """Two texts without an id, and two of one id: the one that repeats nothing stays as it is."""
    passage = " ".join(f"w{k}" for k in range(40)) + "."
    rows = [(1, f"{passage} And more."), (None, f"Before. {passage}"), (None, "A sentence of its own here that repeats nothing."), (4, f"{passage}"),
            (4, "Another sentence of its own."), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.text) for r in line_dedup.remove_repeats(docs).collect())
    assert got == collections.Counter([rows[0], (None, "Before."), rows[2], (4, ""), rows[4], (None, None)])


def test_runs_on_edge_tables(spark):
    docs = edge_docs(spark)
    got = line_dedup.repeated_units(docs, "line", 10).where("doc_id >= 8 AND doc_id < 10").collect()
    assert {(r.doc_id, r.unit, r.keep_doc_id, r.keep_unit, r.copies, r.cut) for r in got} == {(8, 1, 8, 1, 2, False), (9, 0, 8, 1, 2, True)}
    text = docs.where("doc_id = 9").first().text
    assert text[got[0].start:got[0].stop].startswith("the same passage") or got[0].doc_id == 8
    by_id = {r.doc_id: r.text for r in line_dedup.remove_repeats(docs, "line", 10).where("doc_id >= 8").collect()}
    assert by_id[9] == "" and by_id[8].count("passage") == 1 and by_id[10] == "   \n\t \n"
    assert line_dedup.repeated_units(empty_docs(spark)).count() == 0 and line_dedup.remove_repeats(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.repeated_units(docs, "word")
