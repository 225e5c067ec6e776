"""Partial pair sums as lists on their way to the tasks that add them.

Most products of cells are the only one of their item pair, so partial sums of their own would travel as eight numbers each.
A kernel's chunk leaves as one row per item i instead: the other items as gaps of as few bytes as the list needs, and
with each of them

* x and y alone if the sums are those of one product of two single ratings (n = 1, sxx = x^2, syy = y^2, sxy = x y; checked, so nothing is lost),
* all six sums otherwise,

in the smallest of a few types that holds the chunk's values exactly.  A task of :func:`added_lists` gets all lists of its items and
keeps the sums of the pairs that it has seen, merging new ones in when they are as many; nothing is sorted or spilled by the
JVM.  The pairs of an item with very many products are dealt to several tasks by their other item (``salt``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
LISTS = "i long, part int, data binary"
# value layouts of an entry: two 4-bit numbers x, y in a byte; x, y; all sums
LAYOUTS = (("u1", 1), ("u1", 2), ("<f8", 2), ("u1", 6), ("<u2", 6), ("<f8", 6))
STEPS = np.array([1 << 8 * k for k in range(1, 8)], np.uint64)  # least gaps of 2, 3, .. 8 bytes
HOLD_ROWS = 1 << 20
OUT_ROWS = 1 << 17


def _tag_type(tags: int) -> str:
    return "u1" if tags * tags <= 256 else "<u4"


def _bytes(values: np.ndarray) -> np.ndarray:
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), -1)


def _layout(values: np.ndarray, single: bool) -> tuple[int, np.ndarray]:
    """The smallest layout that holds ``values`` (entries x columns) exactly, and the values in it."""
    low, top = values.min(), values.max()
    whole = low >= 0 and top < 1 << 16 and bool((values == np.floor(values)).all())  # false with a NaN
    if single and whole and top < 16:
        return 0, (values[:, 0] * 16 + values[:, 1]).astype("u1")
    if whole and top < 256:
        return 1 if single else 3, values.astype("u1")
    if whole and not single:
        return 4, values.astype("<u2")
    return 2 if single else 5, values.astype("<f8")


def pack_lists(sums: dict, salts: tuple[np.ndarray, np.ndarray] | None = None, tags: int = 0) -> pd.DataFrame:
    """List rows (i, part, data) of a chunk of partial sums; ``salts``: sorted items and over how many parts their pairs go."""
    i, j = (np.asarray(sums[c], np.int64) for c in "ij")
    part = np.zeros(len(i), np.int32)
    if salts is not None and len(salts[0]):
        at = np.minimum(np.searchsorted(salts[0], i), len(salts[0]) - 1)
        hot = salts[0][at] == i
        spread = (j[hot].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        part[hot] = (spread % salts[1][at[hot]].astype(np.uint64)).astype(np.int32)
    same = i[1:] == i[:-1]
    if part.any() or not ((i[1:] > i[:-1]) | (same & (j[1:] >= j[:-1]))).all():
        order = np.lexsort((j, part, i))
    else:
        order = np.arange(len(i))
    six = np.stack([np.asarray(sums[c], np.float64)[order] for c in SUMS], axis=1)
    i, j, part = i[order], j[order], part[order]
    tag = (np.asarray(sums["ti"])[order] * tags + np.asarray(sums["tj"])[order]).astype(_tag_type(tags)) if tags else None
    n, x, y = six[:, 0], six[:, 1], six[:, 2]
    single = (n == 1) & (six[:, 3] == x * x) & (six[:, 4] == y * y) & (six[:, 5] == x * y)
    out = ([], [], [])
    for which, cols in ((single, slice(1, 3)), (~single, slice(0, 6))):
        if which.any():
            kind, values = _layout(six[which, cols], cols.start == 1)
            values = _bytes(values)
            if tags:
                values = np.concatenate([values, _bytes(tag[which])], axis=1)
            _add_lists(out, i[which], part[which], j[which], kind, values)
    return pd.DataFrame({"i": np.concatenate(out[0]), "part": np.concatenate(out[1]), "data": pd.Series(out[2], dtype=object)})


def _add_lists(out, i, part, j, kind: int, values: np.ndarray) -> None:
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    gap = j.view(np.uint64).copy()  # modulo 2^64, as the sums that undo it
    gap[1:] -= j[:-1].view(np.uint64)
    gap[first] = j[first].view(np.uint64) - i[first].view(np.uint64)
    length = np.diff(np.append(first, len(i)))
    width = np.searchsorted(STEPS, np.maximum.reduceat(gap, first), side="right") + 1
    raw = _bytes(gap.astype("<u8"))
    of_entry = np.repeat(width, length)
    for w in np.unique(width).tolist():
        lists, entries = width == w, of_entry == w
        records = np.concatenate([raw[entries, :w], values[entries]], axis=1)
        data, head = records.tobytes(), bytes([kind * 16 + w])
        ends = (np.cumsum(length[lists]) * records.shape[1]).tolist()
        out[0].append(i[first[lists]])
        out[1].append(part[first[lists]])
        out[2].extend(head + data[a:b] for a, b in zip([0, *ends], ends))


def unpack_lists(i: np.ndarray, data: list[bytes], tags: int = 0) -> Iterator[tuple]:
    """(number of the list, j, tag or None, six sums) of all entries, in a few parts."""
    forms = np.array([d[0] for d in data])
    extra = np.dtype(_tag_type(tags)).itemsize if tags else 0
    for form in np.unique(forms).tolist():
        at = np.flatnonzero(forms == form)
        (name, count), w = LAYOUTS[form >> 4], form & 15
        kind = np.dtype(name)
        size = w + kind.itemsize * count + extra
        length = np.array([(len(data[k]) - 1) // size for k in at.tolist()])
        records = np.frombuffer(b"".join([data[k][1:] for k in at.tolist()]), np.uint8).reshape(-1, size)
        gap = np.zeros((len(records), 8), np.uint8)
        gap[:, :w] = records[:, :w]
        total = np.cumsum(gap.view("<u8").reshape(-1).astype(np.uint64))
        first = np.cumsum(length) - length
        base = np.concatenate([np.zeros(1, np.uint64), total])[first]
        j = (np.repeat(i[at].view(np.uint64) - base, length) + total).view(np.int64)
        values = np.ascontiguousarray(records[:, w:size - extra]).view(kind).reshape(-1, count)
        if count < 6:
            x, y = (values[:, 0] >> 4, values[:, 0] & 15) if count == 1 else (values[:, 0], values[:, 1])
            x, y = x.astype(np.float64), y.astype(np.float64)
            six = np.stack([np.ones(len(x)), x, y, x * x, y * y, x * y])
        else:
            six = np.ascontiguousarray(values.T.astype(np.float64))
        tag = np.ascontiguousarray(records[:, size - extra:]).view(_tag_type(tags)).reshape(-1).astype(np.int64) if tags else None
        yield np.repeat(at, length), j, tag, six


class PairAdder:
    """The sums of the pairs of a task (per tags, if there are any): few rows are waiting to be merged in at a time."""

    def __init__(self, tags: int = 0):
        self.tags, self.waiting, self.rows, self.most = tags, [], 0, HOLD_ROWS
        self.keys = {}  # (by.., i) -> number

    def add(self, keys: list[tuple], data: list[bytes]) -> None:
        number = np.array([self.keys.setdefault(k, len(self.keys)) for k in keys], np.int64)
        for at, j, tag, six in unpack_lists(np.array([k[-1] for k in keys], np.int64), data, self.tags):
            self.waiting.append((number[at], j, tag if self.tags else np.zeros(0, np.int64), six))
            self.rows += len(j)
            if self.rows >= self.most:
                self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        key, j, tag = (np.concatenate([x[k] for x in self.waiting]) for k in range(3))
        six = np.concatenate([x[3] for x in self.waiting], axis=1)
        self.waiting = []
        order = sort_order([key, j, tag] if self.tags else [key, j])
        key, j, six = key[order], j[order], six[:, order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (j[1:] != j[:-1])
        if self.tags:
            tag = tag[order]
            new[1:] |= tag[1:] != tag[:-1]
        first = np.flatnonzero(new)
        if len(first) < len(key):
            key, j, tag, six = key[first], j[first], tag[first] if self.tags else tag, np.add.reduceat(six, first, axis=1)
        self.waiting, self.rows, self.most = [(key, j, tag, six)], len(key), 2 * len(key) + HOLD_ROWS

    def result(self):
        """(number of the key, j, tag, six sums), ordered by them."""
        self.merge()
        return self.waiting[0] if self.waiting else None


def sort_order(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by the columns; one sort of one number where their ranges allow it."""
    low, high = zip(*[(int(c.min()), int(c.max())) for c in columns])
    room = 1
    for a, b in zip(low, high):
        room *= b - a + 1
    if room >= 1 << 62:
        return np.lexsort(columns[::-1])
    code = np.zeros(len(columns[0]), np.int64)
    for c, a, b in zip(columns, low, high):
        code = code * (b - a + 1) + (c - a)
    return np.argsort(code, kind="stable")


def _deal_folds(key, j, tag, six, tags: int, min_support: int):
    """(fold, rows' key, j, sums) of the training sets 0 to ``tags`` - 3: a product goes to all but the folds of its cells.

    Pairs that have no more than ``min_support`` common ratings in all are left out, then those with fewer in the training set.
    """
    k = tags - 2
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (j[1:] != j[:-1])
    first = np.flatnonzero(new)
    enough = np.add.reduceat(six[0], first) > min_support
    ti, tj = tag // tags, tag % tags
    rated = np.repeat(enough, np.diff(np.append(first, len(key)))) & (ti != k) & (tj != k)
    for fold in range(k):
        at = np.flatnonzero(rated & (ti != fold) & (tj != fold))
        if len(at):
            own_key, own_j = key[at], j[at]
            new = np.ones(len(at), bool)
            new[1:] = (own_key[1:] != own_key[:-1]) | (own_j[1:] != own_j[:-1])
            start = np.flatnonzero(new)
            sums = np.add.reduceat(six[:, at], start, axis=1)
            kept = sums[0] >= min_support
            yield fold, own_key[start][kept], own_j[start][kept], sums[:, kept]


def _add_kernel(by: list[str], tags: int, out: str | None, min_support: int):
    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        adder = PairAdder(tags)
        for batch in batches:
            if len(batch):
                adder.add(list(zip(*[batch[c].tolist() for c in (*by, "i")])), batch["data"].tolist())
        found = adder.result()
        if found is None:
            return
        names = pd.DataFrame(list(adder.keys), columns=[*by, "i"])
        key, j, tag, six = found
        for fold, key, j, six in (_deal_folds(key, j, tag, six, tags, min_support) if tags else [(None, key, j, six)]):
            for lo in range(0, len(key), OUT_ROWS):
                rows = names.iloc[key[lo:lo + OUT_ROWS]].reset_index(drop=True)
                rows["j"] = j[lo:lo + OUT_ROWS]
                for name, column in zip(SUMS, six):
                    rows[name] = column[lo:lo + OUT_ROWS]
                if tags:
                    rows.insert(0, out, np.full(len(rows), fold, np.int32))
                yield rows

    return kernel


def added_lists(lists: DataFrame, tasks: int, by_schema: str = "", by=(), integer_sums: bool = True, tags: int = 0, out: str | None = None,
                min_support: int = 1) -> DataFrame:
    """(by.., i, j, n, sx, sy, sxx, syy, sxy): the sums of all lists, made in ``tasks`` tasks.

    With ``tags`` the sums of every training set (column ``out``, see ``similarity.fold_pair_sums``).
    """
    by = list(by)
    schema = (f"{out} int, " if tags else "") + by_schema + "i long, j long, " + ", ".join(f"{c} double" for c in SUMS)
    added = lists.repartition(tasks, *by, "i", "part").mapInPandas(_add_kernel(by, tags, out, min_support), schema)
    cast = "bigint" if integer_sums else "double"
    return added.select(*([out] if tags else []), *by, "i", "j", F.col("n").cast("bigint").alias("n"), *[F.col(c).cast(cast).alias(c) for c in SUMS[1:]])


from recspark.functions.shipping import ship_by_value  # noqa: E402

ship_by_value(__name__)  # packing and adding run on executors
