"""Substring deduplication by hashing the units of all texts.

Every text is cut into units: clauses of its lines (``by="clause"``: up to a line end or a run of ``. ! ? ; : ,``), whole lines or
paragraphs between empty lines.  A unit is normalised (ASCII letters in lower case, runs of white space as one space, ends trimmed) and
digested, and the digests are counted over all documents.  Single short units recur by chance in clean text and prove nothing, so what is
looked for are *runs*: consecutive units of a document that all occur more than once, of ``min_words`` words in all.  No unit is too short
to take part in a run, so verses, addresses and lists are found, and so is a passage that begins or ends inside a line.  A second round
counts again over the units of the runs found, so a run that chance put together from units of unrelated texts falls out.

Of the occurrences of a unit in runs, the earliest in the order (document id, key of the text, unit number) stays and the others are removed,
where such units again follow each other with ``min_words`` words in all: a refrain inside the text that stays is not cut out of it.  Every unit of a
run is reported with its offsets in the original text (code points, end exclusive), the place of its earliest occurrence and whether it is cut.

Digests are counted with partial aggregation before anything moves; the joins that bring counts back are plain equi-joins with a written table of one
row per digest, which Spark splits where a digest (a license line in a third of all documents) is hot.  Only digests and offsets
move; texts do not until the removal itself.  A window holds the repeated units of one document.

Defined cases: null and empty texts have no units; blank lines are no units and do not end a run; null ids sort after all others; rows with
one id and one text are copies of each other of which none is removed (they keep or lose the same spans), rows with one id and different texts are
documents of their own; an empty table gives an empty result; extra columns are ignored by :func:`repeated_units` and kept by :func:`remove_repeats`.
"""

from __future__ import annotations

import hashlib
import re
import struct

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.llm.common import col, fresh
from recspark.session import materialize

ship_by_value(__name__)

UNITS = "doc_id long, text_key long, unit int, start int, stop int, words int, h1 long, h2 long"  # h1, h2: the MD5
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
UNIT = {"clause": r"[^\n.!?;:,]*[.!?;:,]+|[^\n.!?;:,]+", "line": r"[^\n]+", "paragraph": r"[^\n]+(?:\n(?![ \t\x0b\x0c\r]*(?:\n|$))[^\n]+)*"}
MIN_WORDS = 30
DOC = ["doc_id", "text_key"]
ROWS = 50_000  # units of a batch that leaves a task
HALVES = ">qq"


def text_key(text: Column) -> Column:
    """60 bits of the text's MD5, as a long: tells texts of one id apart."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def units_of(text: str, by: str):
    """(start, stop, normalised unit as bytes) of the units of a text that are not blank."""
    low = text.encode("utf-8").translate(LOWER).decode("utf-8")
    for m in re.finditer(UNIT[by], low):
        words = m.group().encode("utf-8").split()  # bytes split at ASCII white space only
        if words:
            yield m.start(), m.end(), words


def _units(by: str):
    types = [*[pa.int64()] * 2, *[pa.int32()] * 4, *[pa.int64()] * 2]
    names = [f.split()[0] for f in UNITS.split(", ")]

    def batch_of(cols):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def cut(batches):
        for batch in batches:
            cols = [[] for _ in types]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                key = int(hashlib.md5(text.encode("utf-8")).hexdigest()[:15], 16)
                for k, (a, b, words) in enumerate(units_of(text, by)):
                    for c, v in zip(cols, (doc_id, key, k, a, b, len(words), *struct.unpack(HALVES, hashlib.md5(b" ".join(words)).digest()))):
                        c.append(v)
                    if len(cols[0]) >= ROWS:
                        yield batch_of(cols)
                        cols = [[] for _ in types]
            yield batch_of(cols)

    return cut


def _stretches(units: DataFrame, of: Column | None = None) -> DataFrame:
    """Adds ``total``, the words of the stretch of consecutive units of a document (that agree in ``of``) to which a row belongs."""
    by = [*DOC] if of is None else [*DOC, of]
    run = F.col("unit") - F.row_number().over(Window.partitionBy(*by).orderBy("unit"))
    return units.withColumn("run", run).withColumn("total", F.sum("words").over(Window.partitionBy(*by, "run")))


def _runs(units: DataFrame, digest: list[str], min_words: int) -> DataFrame:
    """The units in runs of ``min_words`` or more words; every unit of a run occurs more than once in ``units``."""
    # written, so that the join below has an exchange on both sides and Spark can split a hot digest
    often = materialize(units.groupBy(*digest).agg(F.sum("rows").alias("n")).where("n > 1").select(*digest), "often")
    # one row per unit of a document; ``rows`` tells how often the document's row repeats
    live = (units.join(often, digest, "left_semi").repartition(*DOC).groupBy(*DOC, "unit")
            .agg(*[F.first(c).alias(c) for c in ("start", "stop", "words", "h1", "h2")], F.sum("rows").alias("rows")))
    return _stretches(live).where(F.col("total") >= min_words).drop("run", "total")


def _found(docs: DataFrame, by: str, min_words: int, id_col: str, text_col: str) -> DataFrame:
    if by not in UNIT:
        raise ValueError(f"by must be one of {tuple(UNIT)}")
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text")).where("text IS NOT NULL")
    units = materialize(rows.mapInArrow(_units(by), UNITS), "units").withColumn("rows", F.lit(1))
    both = ["h1", "h2"]
    # half a digest does for the first round: units that share it by chance fall out in the second
    for digest in (both[:1], both):
        units = materialize(_runs(units, digest, min_words), "unit-runs")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "unit")
    first = materialize(units.groupBy(*both).agg(F.min(rank).alias("first"), F.sum("rows").alias("copies")), "first-units")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")) & (F.col("unit") == F.col("first.unit"))
    ranked = units.join(first, both).withColumn("later", ~same)
    digest = F.lower(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in both]))
    return _stretches(ranked, F.col("later")).select(
        *DOC, "unit", "start", "stop", "words", digest.alias("digest"), F.col("first.doc_id").alias("keep_doc_id"),
        F.col("first.unit").alias("keep_unit"), "copies", (F.col("later") & (F.col("total") >= min_words)).alias("cut"))


def repeated_units(docs: DataFrame, by: str = "clause", min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per unit of a repeated run: doc_id, unit, start, stop, words, digest, keep_doc_id, keep_unit, copies, cut.

    ``cut`` marks the units that are removed; ``keep_doc_id`` and ``keep_unit`` name the earliest occurrence, ``copies`` counts all in runs.
    """
    return _found(docs, by, min_words, id_col, text_col).drop("text_key")


def _cut(text: str, spans) -> str:
    """``text`` without the spans (start, stop, start, stop, ...); a span of whole lines takes its line end along."""
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(text[at:a])
        at = b + 1 if (a == 0 or text[a - 1] == "\n") and text[b:b + 1] == "\n" else b
    return "".join([*out, text[at:]])


def _cutter():
    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or s is None else _cut(t, [int(x) for x in s]) for t, s in zip(texts, spans)], dtype=object)

    return cut


def remove_repeats(docs: DataFrame, by: str = "clause", min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the removed units; all other columns as they were.

    Neighbouring removed units go as one span, with the white space between them.  A span finds its text by id and text, so rows
    that share an id, or have none, lose only what is theirs.
    """
    spans, key, text = (fresh(n, docs.columns) for n in ("spans", "span_id", "span_text"))
    gone = _found(docs, by, min_words, id_col, text_col).where("cut")
    island = gone.withColumn("part", F.col("unit") - F.row_number().over(Window.partitionBy(*DOC).orderBy("unit")))
    cuts = (island.groupBy(*DOC, "part").agg(F.min("start").alias("a"), F.max("stop").alias("b")).groupBy(*DOC)
            .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("a", "b"))), lambda s: F.array(s["a"], s["b"]))).alias(spans))
            .withColumnRenamed("doc_id", key).withColumnRenamed("text_key", text))
    joined = docs.join(cuts, (text_key(col(text_col)) == F.col(text)) & col(id_col).cast("long").eqNullSafe(F.col(key)), "left")
    return joined.withColumn(text_col, F.when(col(spans).isNull(), col(text_col)).otherwise(_cutter()(col(text_col), col(spans)))).drop(spans, key, text)


def _sql_round(name: str, of: str, min_words: int) -> str:
    return f"""{name} AS (SELECT row, doc_id, text_key, unit, start, stop, words, norm FROM (
        SELECT *, sum(words) OVER (PARTITION BY row, run) AS total FROM (
            SELECT *, unit - row_number() OVER (PARTITION BY row ORDER BY unit) AS run FROM (
                SELECT *, count(*) OVER (PARTITION BY norm) AS n FROM {of}) WHERE n > 1)) WHERE total >= {min_words})"""


SQL = r"""
    WITH parts AS (SELECT row_number() OVER () AS row, doc_id, ('0x' || md5(text)[1:15])::BIGINT AS text_key,
                          regexp_extract_all(text, '[^\n.!?;:,]*[.!?;:,]+|[^\n.!?;:,]+|\n') AS p FROM documents WHERE text IS NOT NULL),
    pieces AS (SELECT row, doc_id, text_key, unnest(range(len(p))) AS pos, unnest(p) AS piece FROM parts),
    placed AS (SELECT *, sum(length(piece)) OVER (PARTITION BY row ORDER BY pos) - length(piece) AS start,
                      trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[ \t\n\x0b\x0c\r]+', ' ', 'g'), ' ') AS norm FROM pieces),
    units AS (SELECT row, doc_id, text_key, CAST(row_number() OVER (PARTITION BY row ORDER BY pos) - 1 AS INTEGER) AS unit,
                     CAST(start AS INTEGER) AS start, CAST(start + length(piece) AS INTEGER) AS stop,
                     CAST(len(string_split(norm, ' ')) AS INTEGER) AS words, norm FROM placed WHERE norm <> ''),
    """ + _sql_round("once", "units", MIN_WORDS) + ", " + _sql_round("twice", "once", MIN_WORDS) + """,
    ranked AS (SELECT *, count(*) OVER (PARTITION BY norm) AS copies, rank() OVER w AS place, first_value(doc_id) OVER w AS keep_doc_id,
                      first_value(unit) OVER w AS keep_unit
               FROM twice WINDOW w AS (PARTITION BY norm ORDER BY doc_id NULLS LAST, text_key, unit)),
    parted AS (SELECT *, unit - row_number() OVER (PARTITION BY row, place > 1 ORDER BY unit) AS part FROM ranked),
    summed AS (SELECT *, sum(words) OVER (PARTITION BY row, place > 1, part) AS total FROM parted)
    SELECT DISTINCT doc_id, unit, start, stop, words, md5(norm) AS digest, keep_doc_id, keep_unit, copies,
           place > 1 AND total >= """ + f"{MIN_WORDS} AS cut FROM summed"
