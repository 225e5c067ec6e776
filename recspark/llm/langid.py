"""Language identification by nearest centroids of TF-IDF character n-grams.

A text becomes its words in lower case (runs of letters, one space around each); its one- to three-letter n-grams are
hashed to ``DIMS`` features, weighted by (1 + log tf) * idf and normalised.  Every label has ``clusters`` centroids (spherical k-means), and a
text gets the label of the centroid with the largest cosine.  A text is rejected when its distance to that centroid exceeds the label's
radius for texts of its length, times ``slack``.  The length is the octave of the number of different n-grams (a word said a hundred times is as short as
the word).  The radius of an octave is fitted on the sample's texts and on pieces from the middle of each, of 4 to 2,896 letters: a cosine of at
least ``SHARE`` of the one that all but 1 - ``QUANTILE`` of them reach (that quantile alone would reject 1 % of the language itself).
An octave with fewer than ``LEAST`` of them takes the radius of the next shorter one, and a longer text never has a larger radius.

Fitting: document frequencies are counted over all training texts; the centroids are fitted, one task per label, on a
bounded sample of at most ``sample_per_label`` texts per label, those with the smallest text hashes.  Only the model reaches the
driver: DIMS frequencies and labels x clusters x DIMS weights.

Defined cases: null texts and texts without a letter get ``und``, score 0 and are rejected; of equal cosines the label that
sorts first wins; training rows without text, letters or label teach nothing; without any training row every
text is ``und``; repeated rows are predicted alike (and count once in the sample); an empty table gives an empty result; extra columns are
ignored by :func:`predict_language` and kept by :func:`keep_known_languages`.  Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.llm.common import col, fresh, lean

ship_by_value(__name__)

DIMS = 1 << 14
NONE = "und"
SAMPLE_PARTS = 64
OCTAVES = 15  # of 1 to DIMS different n-grams
QUANTILE, SHARE, LEAST = 0.95, 0.5, 50
PIECES = [round(4 * 2 ** (k / 2)) for k in range(20)]  # letters


@dataclass
class Model:
    labels: list[str]  # of each centroid
    centroids: np.ndarray  # one row per centroid, unit length
    idf: np.ndarray
    radius: np.ndarray  # largest accepted distance, per centroid and octave


def letter_table() -> np.ndarray:
    """For every code point, itself where it is a letter, else a space."""
    points = np.arange(0x110000, dtype=np.uint32)
    text = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return np.where(np.fromiter(map(str.isalpha, text), bool, len(text)), points, 32).astype(np.uint32)


def feature_counts(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Counts of the hashed n-grams of a text; None where it has no letter."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    c = letters[raw]
    gap = c == 32
    keep = ~gap
    keep[1:] |= ~gap[:-1]  # one space after each word
    c = c[keep]
    if len(c) < 2:
        return None
    c = np.concatenate([np.array([32], np.uint32), c])
    one = c[1:] * np.uint32(2654435761)
    two = one + c[:-1] * np.uint32(2246822519)
    three = two[1:] + c[:-2] * np.uint32(3266489917)
    hashed = np.concatenate([one, two ^ np.uint32(0x5bd1e995), three ^ np.uint32(0x27d4eb2f)])
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x85ebca6b)
    return np.bincount(hashed >> np.uint32(18), minlength=DIMS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows of count rows."""
    v = np.log1p(counts.astype(np.float32))
    v *= idf.astype(np.float32)
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.maximum(norm, 1e-12)


def _count_documents(batches):
    letters, total, seen = letter_table(), np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            counts = feature_counts(text, letters)
            if counts is not None:
                total += counts > 0
                seen += 1
    if seen:
        yield pd.DataFrame({"feature": np.arange(-1, DIMS), "n": np.concatenate([[seen], total])})


def cluster(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the mean's nearest point and then the farthest ones."""
    first = int(np.argmax(points @ points.mean(axis=0)))
    chosen = [first]
    near = points @ points[first]
    while len(chosen) < min(k, len(points)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, points @ points[chosen[-1]])
    centres = points[chosen]
    for _ in range(rounds):
        own = np.argmax(points @ centres.T, axis=1)
        for c in range(len(centres)):
            mean = points[own == c].sum(axis=0)
            if (size := np.linalg.norm(mean)) > 0:
                centres[c] = mean / size
    return centres


def pieces(text: str):
    """Pieces from the middle of a text, widened to whole words where a word ends nearby (not in scripts without spaces)."""
    text = " ".join(text.split())
    for n in PIECES:
        if n >= len(text):
            break
        lo = (len(text) - n) // 2
        hi = text.find(" ", lo + n, lo + n + 16)
        yield text[text.rfind(" ", max(0, lo - 16), lo) + 1 or lo:hi if hi >= 0 else lo + n]


def octave(counts: np.ndarray) -> int:
    """Length class of a text by its number of different n-grams."""
    return int(np.count_nonzero(counts)).bit_length() - 1


def radii(octaves: np.ndarray, distances: np.ndarray) -> np.ndarray:
    """The largest accepted distance for every octave."""
    out = np.full(OCTAVES, np.nan)
    for k in range(OCTAVES):
        d = distances[octaves == k]
        if len(d) >= LEAST:
            out[k] = 1 - SHARE * (1 - np.quantile(d, QUANTILE))
        elif k:
            out[k] = out[k - 1]
    fitted = out[~np.isnan(out)]
    out[np.isnan(out)] = fitted[0] if len(fitted) else distances.max()  # shorter than the pieces, or a small sample
    return np.maximum.accumulate(out[::-1])[::-1]


def _fit_label(idf: np.ndarray, clusters: int):
    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        letters = letter_table()
        counts = [c for t in sample.sort_values("pick")["text"] if (c := feature_counts(t, letters)) is not None]
        if not counts:
            return pd.DataFrame({"label": [], "centroid": [], "far": []})
        points = vectors(np.array(counts), idf)
        centres = cluster(points, clusters)
        octaves, distances = [octave(c) for c in counts], [1 - (points @ centres.T).max(axis=1)]
        for text in sample["text"]:
            short = [c for t in pieces(text) if (c := feature_counts(t, letters)) is not None]
            if short:
                octaves += [octave(c) for c in short]
                distances.append(1 - (vectors(np.array(short), idf) @ centres.T).max(axis=1))
        far = radii(np.array(octaves), np.concatenate(distances).astype(float)).tolist()
        return pd.DataFrame({"label": sample["label"].iloc[0], "centroid": [c.astype("<f4").tobytes() for c in centres], "far": [far] * len(centres)})

    return fit


def fit_language_model(train: DataFrame, text_col: str = "text", label_col: str = "lang", clusters: int = 4, sample_per_label: int = 600,
                       slack: float = 1.0) -> Model:
    rows = train.select(col(text_col).alias("text"), col(label_col).cast("string").alias("label")).where("text IS NOT NULL AND label IS NOT NULL")
    found = {r["feature"]: r["n"] for r in rows.select("text").mapInPandas(lean(_count_documents), "feature int, n long")
             .groupBy("feature").agg(F.sum("n").alias("n")).collect()}  # DIMS + 1 rows
    n = found.get(-1, 0)
    idf = np.log((1 + n) / (1 + np.array([found.get(k, 0) for k in range(DIMS)]))) + 1
    picks = rows.select("label", F.xxhash64("text").alias("pick")).distinct()
    picks = picks.withColumn("part", F.pmod("pick", F.lit(SAMPLE_PARTS)))
    for keys in (["label", "part"], ["label"]):  # the smallest of each part first: a label may hold most of the rows
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("pick"))
        picks = picks.withColumn("rank", rank).where(F.col("rank") <= sample_per_label).drop("rank")
    picks = picks.drop("part")
    sample = (rows.withColumn("pick", F.xxhash64("text")).join(picks, ["label", "pick"], "left_semi").dropDuplicates(["label", "pick"]))
    fitted = sorted(sample.groupBy("label").applyInPandas(_fit_label(idf, clusters), "label string, centroid binary, far array<double>").collect(),
                    key=lambda r: (r["label"], bytes(r["centroid"])))
    centroids = np.array([np.frombuffer(r["centroid"], "<f4") for r in fitted], np.float32).reshape(-1, DIMS)
    return Model([r["label"] for r in fitted], centroids, idf, np.array([r["far"] for r in fitted], float).reshape(-1, OCTAVES) * slack)


def _predictor(model: Model):
    labels, idf, radius = model.labels, model.idf, model.radius
    by_feature = np.ascontiguousarray(model.centroids.T.astype(np.float64))

    def predict(batches):
        letters = letter_table()
        for batch in batches:
            texts = batch["text"].tolist()
            label, score, out = [NONE] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            for k, text in enumerate(texts if labels else []):
                counts = feature_counts(text, letters) if text else None
                if counts is None:
                    continue
                at = np.flatnonzero(counts)
                weights = np.log1p(counts[at]) * idf[at]
                cosine = weights @ by_feature[at] / np.sqrt(weights @ weights)
                best = int(np.argmax(cosine))
                label[k], score[k] = labels[best], min(1.0, max(0.0, float(cosine[best])))
                out[k] = 1 - score[k] > radius[best, octave(counts)]
            yield pd.DataFrame({"key": batch["key"], "lang_pred": label, "score": score, "rejected": out})

    return predict


def predict_language(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, rejected.  Only the text is an input of the prediction."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(col(id_col).cast("string").alias("key"), col(text_col).alias("text"))
    found = rows.mapInPandas(lean(_predictor(model)), "key string, lang_pred string, score double, rejected boolean")
    return found.select(F.col("key").cast(kind).alias("doc_id"), "lang_pred", "score", "rejected")


def keep_known_languages(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is recognised, with all their columns; the rejected ones go."""
    verdict = fresh("rejected", docs.columns)
    judge = F.pandas_udf(_judge(model), "boolean")
    return docs.withColumn(verdict, judge(col(text_col))).where(~F.col(verdict)).drop(verdict)


def _judge(model: Model):
    predict = _predictor(model)

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield next(predict([pd.DataFrame({"key": "", "text": texts})]))["rejected"]

    judge.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}  # types, not their names
    return judge


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def split_fit_predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: fitted on the rows that are not held out, applied to all."""
    model = fit_language_model(docs.where(~held_out(col(id_col))), text_col, label_col, **options)
    found = predict_language(docs, model, id_col, text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
