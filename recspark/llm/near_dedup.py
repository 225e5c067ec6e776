"""MinHash near-duplicate detection with sequential Bayesian verification.

1. Every text becomes its set of five-word shingles, a digest of the set and a MinHash signature.
   Texts with one set are one class, a node of all that follows; nodes are numbered by (smallest id, digest), null ids last.
2. The signature's bands deal the classes to buckets.  The smallest member of a bucket is its hub, and the other members
   are candidates of the hub: linear in the bucket, whatever its size.
3. A candidate is compared batch by batch.  After n hashes with m agreeing, the similarity has the posterior
   Beta(m + 1, n - m + 1), so P(similarity >= threshold) = P(Binomial(n + 1, threshold) <= m); a pair is dropped as
   soon as this falls below ``miss``.  Survivors are verified on their full sets.
4. The verified links give components.  Buckets whose non-hub members are still of several components are searched on: all pairs of members of different
   components, in tiles of about ``tile`` x ``tile`` members that are compared inside a task; only survivors leave it.  Pairs inside one component
   cannot change the result and are skipped, so a large group of near copies costs its size, not its square.
5. Components of all verified links.

What can be missed: a pair at similarity s shares no band with probability (1 - s^rows)^bands (5e-6 at 0.75 with the
defaults), and verification drops a true pair with at most ``miss`` per batch.  Everything that is reported
is exact up to 64-bit hashes of shingles.

Skew: exact copies collapse in step 1 by partial aggregation; hubs are dealt to ``spread`` tasks per hub; joins to classes
and hubs are salted.

Defined cases: null and empty texts have the empty set and are linked with nothing.  Rows that share an id but differ in their sets are nodes of
their own, each kept or not by its own links; a group is represented by its smallest id, then smallest digest.  Rows with a null id
take part like all others and come last: in a group without an id the component is null and one row is kept.  Repeated rows with an id come
back as often as they occur.  A null id without any word is not kept by :func:`near_duplicates`, and by :func:`keep_representatives`
only with ``keep_blank``.  An empty table gives an empty result; extra columns are ignored by :func:`near_duplicates` and kept by
:func:`keep_representatives`.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.llm.common import col, fresh, salted_left_join, join_by_size, lean
from recspark.llm.components import components
from recspark.llm.pieces import text_batches
from recspark.llm.shingles import Shingler, Signer, band_keys, set_digest
from recspark.session import materialize

ship_by_value(__name__)

PERCENT = 75  # linked at 100 * intersection >= PERCENT * union
BANDS, ROWS, BATCH = 32, 4, 16
SIGNED = "doc_id long, n_shingles long, digest binary, sig binary, bands array<long>"


def _sign(bands: int, rows: int):
    def sign(batches):
        shingler, signer = Shingler(), Signer(bands * rows)
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].astype("Int64")
            for lo, hi in text_batches(texts, 1_000_000):
                sets = shingler.sets(texts[lo:hi])
                sig = signer.signatures(sets)
                yield pd.DataFrame({"doc_id": ids[lo:hi].array, "n_shingles": [len(s) for s in sets], "digest": [set_digest(s) for s in sets],
                                    "sig": [s.tobytes() for s in sig], "bands": list(band_keys(sig, bands))})

    return sign


def least_matches(size: int, batch: int, percent: int, miss: float) -> dict[int, int]:
    """After n hashes, the fewest agreeing ones at which a pair is still likely enough (>= miss) to reach the threshold."""
    t, out = percent / 100, {}
    for n in range(batch, size + 1, batch):
        below, m = 0.0, 0
        while (below := below + comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)) < miss:
            m += 1
        out[n] = m
    return out


def sequential_survivors(x: np.ndarray, y: np.ndarray, floors: dict[int, int], batch: int) -> np.ndarray:
    """Row numbers of the pairs (x[k], y[k]) of signatures that are still likely after all batches."""
    alive, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
    for n, floor in floors.items():
        part = slice(n - batch, n)
        matches = matches + (x[alive, part] == y[alive, part]).sum(axis=1)
        ok = matches >= floor
        alive, matches = alive[ok], matches[ok]
    return alive


def _size_fits(m, n, percent: int):
    return 100 * np.minimum(m, n) >= percent * np.maximum(m, n)


def _hub_kernel(judge):
    """Rows sorted by (a, part, b), the hub's own row (b null) first: ``judge`` gets members and the hub row of each, as frames."""
    def run(batches):
        hub = None
        for batch in batches:
            if hub is not None:
                batch = pd.concat([hub, batch], ignore_index=True)
            is_hub = batch["b"].isna().to_numpy()
            at = np.maximum.accumulate(np.where(is_hub, np.arange(len(batch)), 0))
            member = np.flatnonzero(~is_hub)
            hub = batch.iloc[[int(at[-1])]] if len(batch) else hub
            if len(member):
                rows = batch.iloc[member]
                keep = judge(rows, batch.iloc[at[member]])
                yield pd.DataFrame({"a": rows["a"].to_numpy()[keep], "b": rows["b"].to_numpy(np.int64)[keep]})

    return run


def _judge_signatures(floors, percent: int):
    def judge(rows, hubs):
        fits = np.flatnonzero(_size_fits(rows["n"].to_numpy(), hubs["n"].to_numpy(), percent))
        if not len(fits):
            return fits
        x, y = (np.frombuffer(b"".join(f["data"].iloc[fits]), np.uint32).reshape(len(fits), -1) for f in (rows, hubs))
        return fits[sequential_survivors(x, y, floors, BATCH)]

    return judge


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _judge_sets(percent: int):
    def judge(rows, hubs):
        as_set = lambda x: np.frombuffer(x, np.uint64)
        return np.array([k for k, (x, y) in enumerate(zip(rows["data"], hubs["data"])) if _linked(as_set(x), as_set(y), percent)], np.int64)

    return judge


def _with_hubs(pairs: DataFrame, payload: DataFrame, judge, spread: int) -> DataFrame:
    """Pairs (a, b) that ``judge`` keeps; ``payload`` (node, n, data) is joined to both ends.

    The members of a hub are dealt to ``spread`` parts, each with one copy of the hub's payload, and pass through as a stream.
    """
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(spread)).cast("int"))
    members = dealt.join(payload, dealt["b"] == payload["node"]).select("a", "part", "b", "n", "data")
    hubs = dealt.select("a", "part").distinct()
    hubs = hubs.join(payload, hubs["a"] == payload["node"]).select("a", "part", F.lit(None).cast("long").alias("b"), "n", "data")
    rows = members.union(hubs).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return rows.mapInPandas(lean(_hub_kernel(judge)), "a long, b long")


def _set_rows(batches):
    shingler = Shingler()
    for batch in batches:
        texts = batch["text"].tolist()
        for lo, hi in text_batches(texts, 1_000_000):
            sets = shingler.sets(texts[lo:hi])
            yield pd.DataFrame({"n": [len(s) for s in sets], "data": [s.tobytes() for s in sets], "digest": [set_digest(s) for s in sets]})


def node_sets(ends: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, n, data): the full shingle sets of the given nodes, made from their texts again."""
    wanted = materialize(ends.join(nodes.select("node", "doc_id", "digest"), "node"), "wanted")
    chosen = join_by_size(texts, wanted.where("doc_id IS NOT NULL").select("doc_id").distinct(), "doc_id", "left_semi").select("text")
    if not wanted.where("doc_id IS NULL").isEmpty():
        chosen = chosen.union(texts.where("doc_id IS NULL").select("text"))
    sets = (chosen.mapInPandas(lean(_set_rows), "n long, data binary, digest binary").dropDuplicates(["digest"])
            .join(wanted.select("node", "digest"), "digest").select("node", "n", "data"))
    return materialize(sets, "sets")


def hub_links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, floors, percent: int, spread: int) -> DataFrame:
    """The pairs (hub a, member b) that the signatures leave and the full sets confirm."""
    likely = materialize(_with_hubs(pairs, nodes.select("node", F.col("n_shingles").alias("n"), F.col("sig").alias("data")),
                                    _judge_signatures(floors, percent), spread), "likely")
    ends = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    return materialize(_with_hubs(likely, node_sets(ends, nodes, texts), _judge_sets(percent), spread), "links")


TILE = ["key", "kind", "i", "j"]
LIVE = "key long, kind int, i int, j int, node long, comp long, lead boolean, n_shingles long, sig binary"


def _likely_pairs(tile: pd.DataFrame, floors, percent: int):
    """For each row outside the leading component, the rows it may be linked with (of another component, each pair once), best first."""
    sig = np.frombuffer(b"".join(tile["sig"]), np.uint32).reshape(len(tile), -1)
    comp, n, lead = (tile[c].to_numpy() for c in ("comp", "n_shingles", "lead"))
    # members of one part meet each other in the part's first tile with the leading component
    among = tile["kind"].iloc[0] == 1 or tile["i"].iloc[0] == 0
    for k in np.flatnonzero(~lead).tolist():
        other = np.flatnonzero((comp != comp[k]) & _size_fits(n, n[k], percent) & (lead | (among & (np.arange(len(tile)) > k))))
        other = other[sequential_survivors(np.broadcast_to(sig[k], (len(other), sig.shape[1])), sig[other], floors, BATCH)]
        if len(other):
            yield k, other[np.argsort(-(sig[other] == sig[k]).sum(axis=1), kind="stable")]


def _live_rows(floors, percent: int):
    def live(tile: pd.DataFrame):
        rows = [np.append(other, k) for k, other in _likely_pairs(tile, floors, percent)]
        return tile.iloc[np.unique(np.concatenate(rows))] if rows else tile.iloc[:0]

    return live


def _tile_links(floors, percent: int):
    """Verified links of a tile that join components; a pair whose components already met is not compared."""
    def links(tile: pd.DataFrame):
        sets = [np.frombuffer(x, np.uint64) for x in tile["data"]]
        node, comp = tile["node"].tolist(), tile["comp"].tolist()
        parent = {c: c for c in comp}

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        out = []
        for k, other in _likely_pairs(tile, floors, percent):
            for o in other.tolist():
                x, y = root(comp[k]), root(comp[o])
                if x != y and _linked(sets[k], sets[o], percent):
                    parent[max(x, y)] = min(x, y)
                    out.append((min(node[k], node[o]), max(node[k], node[o])))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return links


def _per_tile(work):
    """Rows sorted by tile: ``work`` gets the frame of one tile at a time."""
    def run(batches):
        held = []
        for batch in batches:
            new = (batch[TILE] != batch[TILE].shift()).any(axis=1).to_numpy()
            cuts = np.flatnonzero(new).tolist()
            if held and cuts and (batch[TILE].iloc[0] == held[0][TILE].iloc[0]).all():
                cuts = cuts[1:]
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
                if lo in cuts and held:
                    yield work(pd.concat(held, ignore_index=True))
                    held = []
                if hi > lo:
                    held.append(batch.iloc[lo:hi])
        if held:
            yield work(pd.concat(held, ignore_index=True))

    return run


def remaining_tiles(members: DataFrame, nodes: DataFrame, comps: DataFrame, floors, percent: int, tile: int) -> DataFrame:
    """Rows (LIVE) of tiles of one bucket that still have likely pairs of different components; ``members`` is (key, node)."""
    comp = F.coalesce("component", "node")
    rows = members.join(comps, "node", "left").select("key", "node", comp.alias("comp"))
    sizes = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    live = (sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("comps"))
            .where("comps > 1")
            .select("key", F.col("top.comp").alias("top"), F.ceil(F.col("top.n") / tile).cast("int").alias("lead_tiles"),
                    F.ceil((F.col("all") - F.col("top.n")) / tile).cast("int").alias("rest_tiles")))
    dealt = (salted_left_join(rows, live, ["key"], F.col("node")).where("top IS NOT NULL")
             .withColumn("lead", F.col("comp") == F.col("top"))
             .withColumn("c", F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("lead"), F.col("lead_tiles")).otherwise(F.col("rest_tiles"))).cast("int")))
    to = lambda n, f: F.transform(F.sequence(F.lit(0), F.col(n) - 1), f)
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    tiles = F.when(F.col("lead"), to("rest_tiles", lambda j: cell(0, F.col("c"), j))).otherwise(F.concat(
        to("lead_tiles", lambda i: cell(0, i, F.col("c"))),
        F.filter(to("rest_tiles", lambda j: cell(1, F.least(F.col("c"), j), F.greatest(F.col("c"), j))), lambda t: t["i"] != t["j"])))
    placed = dealt.select("key", "node", "comp", "lead", F.explode(tiles).alias("t")).select("key", "t.*", "node", "comp", "lead")
    rows = placed.join(nodes.select("node", "n_shingles", "sig"), "node").select(*[x.split()[0] for x in LIVE.split(", ")])
    return rows.repartition(*TILE).sortWithinPartitions(*TILE).mapInPandas(lean(_per_tile(_live_rows(floors, percent))), LIVE)


def remaining_links(tiles: DataFrame, nodes: DataFrame, texts: DataFrame, floors, percent: int) -> DataFrame:
    """Verified links between components inside the tiles; at most one row per row of a tile."""
    rows = tiles.join(node_sets(tiles.select("node").distinct(), nodes, texts).select("node", "data"), "node")
    return rows.repartition(*TILE).sortWithinPartitions(*TILE).mapInPandas(lean(_per_tile(_tile_links(floors, percent))), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
                    miss: float = 1e-6, spread: int = 64, tile: int = 512) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    return _verdicts(docs, id_col, text_col, percent, bands, rows, miss, spread, tile).select("doc_id", "n_shingles", "component_id", "kept")


def _verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
              miss: float = 1e-6, spread: int = 64, tile: int = 512) -> DataFrame:
    """One row per input row: doc_id, n_shingles, digest, component_id, kept."""
    texts = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    signed = materialize(texts.mapInPandas(lean(_sign(bands, rows)), SIGNED).withColumn("row", F.monotonically_increasing_id()), "signed")
    floors = least_matches(bands * rows, BATCH, percent, miss)
    # one class per set, numbered in the order of (smallest id, digest); ``row`` is the one that is kept of rows without an id
    classes = (signed.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.min("row").alias("row"))
               .orderBy(F.col("first").asc_nulls_last(), "digest"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    payload = ["doc_id", "n_shingles", "digest", "sig", "bands"]
    named = signed.select(*payload).join(classes.where("first IS NOT NULL").select(F.col("first").alias("doc_id"), "digest", "node"), ["doc_id", "digest"])
    unnamed = (signed.where("doc_id IS NULL").join(classes.where("first IS NULL").select("digest", "row", "node"), ["digest", "row"])
               .select(*payload, "node"))
    nodes = materialize(named.dropDuplicates(["doc_id", "digest"]).select(*payload, "node").union(unnamed), "nodes")

    placed = nodes.select("node", F.explode("bands").alias("key"))
    hubs = placed.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialize(salted_left_join(placed, hubs, ["key"], F.col("node"), 4).where("hub IS NOT NULL AND hub <> node")
                          .select("key", "node", "hub", "size"), "members")
    links = hub_links(members.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), nodes, texts, floors, percent, spread)
    comps = components(links)
    tiles = materialize(remaining_tiles(members.where("size > 2").select("key", "node"), nodes, comps, floors, percent, tile), "tiles")
    if not tiles.isEmpty():
        comps = components(links.union(remaining_links(tiles, nodes, texts, floors, percent)))

    # classes with a component of their own or with copies; all others are their own component
    roots = (comps.select("component").distinct().join(classes.withColumnRenamed("node", "component"), "component")
             .select("component", F.col("first").alias("root_id"), F.col("digest").alias("root_digest")))
    rooted = salted_left_join(comps, roots, ["component"], F.col("node")).select("node", "root_id", "root_digest")
    lookup = (classes.join(rooted, "node", "left").where("copies > 1 OR root_digest IS NOT NULL")
              .select("digest", F.when(F.col("root_digest").isNull(), F.col("first")).otherwise(F.col("root_id")).alias("root_id"),
                      F.coalesce("root_digest", "digest").alias("root_digest"), F.col("row").alias("kept_row")))
    out = salted_left_join(signed.select("doc_id", "n_shingles", "digest", "row"), lookup, ["digest"], F.col("row"))
    grouped = F.col("root_digest").isNotNull()
    lone = F.col("doc_id").isNotNull() | (F.col("n_shingles") > 0)
    best = (F.col("digest") == F.col("root_digest")) & F.col("doc_id").eqNullSafe(F.col("root_id")) & (F.col("doc_id").isNotNull() | (F.col("row") == F.col("kept_row")))
    return out.select("doc_id", "n_shingles", "digest", F.when(grouped, F.col("root_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.when(grouped, best).otherwise(lone).alias("kept"))


def _digests(texts: pd.Series) -> pd.Series:
    shingler, out = Shingler(), []
    texts = texts.fillna("").tolist()
    for lo, hi in text_batches(texts, 1_000_000):
        out += [set_digest(s) for s in shingler.sets(texts[lo:hi])]
    return pd.Series(out, dtype=object)


_digests.__annotations__ = {"texts": pd.Series, "return": pd.Series}  # types, not their names


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_blank: bool = False, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each group (the smallest id).

    Only rows without an id and rows of an id that is kept for one text and not for another are signed again, to be told by their digest.
    ``keep_blank`` keeps rows that have neither an id nor a word, too.
    """
    key, mark, rank = (fresh(name, docs.columns) for name in ("near_id", "near_digest", "near_rank"))
    judged = materialize(_verdicts(docs, id_col, text_col, **options)
                         .select(F.col("doc_id").alias(key), F.col("digest").alias(mark), F.col("kept").alias(rank)), "judged")
    has_id = F.col(key).isNotNull()
    gone = materialize(judged.where(has_id & ~F.col(rank)).select(key, mark).distinct(), "gone")
    gone_ids = gone.select(key).distinct()
    both = materialize(join_by_size(judged.where(has_id & F.col(rank)).select(key), gone_ids, key, "left_semi").distinct(), "both")
    tagged = docs.withColumn(key, col(id_col).cast("long"))
    stay = join_by_size(tagged.where(has_id), gone_ids, key, "left_anti").drop(key)
    signed = lambda rows: rows.withColumn(mark, F.pandas_udf(_digests, "binary")(col(text_col)))
    if not both.isEmpty():
        again = signed(join_by_size(tagged.where(has_id), both, key, "left_semi"))
        stay = stay.union(again.join(gone, [key, mark], "left_anti").drop(key, mark))
    if not judged.where(~has_id).isEmpty():
        unnamed = signed(tagged.where(~has_id))
        best = unnamed.join(judged.where(~has_id & F.col(rank)).select(mark), mark, "left_semi")
        best = best.withColumn(rank, F.row_number().over(Window.partitionBy(mark).orderBy(col(text_col)))).where(F.col(rank) == 1)
        stay = stay.union(best.select(*[col(c) for c in docs.columns]))
        if keep_blank:
            stay = stay.union(unnamed.where(F.col(mark) == F.lit(set_digest(np.zeros(0, np.uint64)))).select(*[col(c) for c in docs.columns]))
    return stay


SQL = r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                              WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (SELECT x, y FROM shared JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * c >= 75 * (na.n + nb.n - c)),
    edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach(doc_id, other) AS (SELECT x, x FROM edges UNION SELECT reach.doc_id, y FROM reach JOIN edges ON reach.other = x),
    comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
           w.doc_id = coalesce(component_id, w.doc_id) AS kept
    FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.doc_id = w.doc_id"""
