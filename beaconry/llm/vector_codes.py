"""Vector compression by codebooks per part of a vector, the nearest entry found in a GNAT over the entries.

A geometric near-neighbour access tree picks a few entries as split points, deals the others to the nearest split point
and keeps, for each split point and each child, the range of distances between that point and the child's entries.
A query's distance to one split point then rules out every child whose range lies further from it than the best entry
seen. Ranges and distances are rounded outwards and a child goes only if its bound is strictly larger, so no nearest
entry and no tie is lost; what is left is compared in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import quoted
from beaconry.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
DEGREE = 4
#: relative rounding of floating distances, far above their true error
ROUGH = 1e-12
#: whole numbers below this are exact as doubles; beyond it a difference may be off by so much of either number
EXACT, BEYOND = 2.0**50, 2.0**-48
#: larger components, which only double columns can hold, count as infinite
LARGEST = 2.0**380
#: whole numbers are sent to Spark in pieces of so many bits, whose sums fit a long
LIMB = 32
LONG = 1 << 63


class Gnat:
    """The entries of one codebook; ``nearest`` answers many queries together."""

    def __init__(self, entries: list[tuple[int, ...]], degree: int = DEGREE):
        self.entries = entries
        self.wide = np.array(entries, object).reshape(len(entries), -1)
        self.points = self.wide.astype(np.float64)
        self.size = np.abs(self.points).max(axis=1, initial=0)
        self.degree = degree
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[int | None]]] = []
        if entries:
            self._node(np.arange(len(entries)))

    def _bounds(self, queries: np.ndarray, size: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances of queries to an entry, rounded down and up."""
        gap = queries - self.points[at]
        gap = np.sqrt((gap * gap).sum(axis=1))
        off = size + self.size[at]
        off = np.where(off < EXACT, 0, off * BEYOND * max(1, self.points.shape[1]))
        return np.maximum(gap * (1 - ROUGH) - off, 0), gap * (1 + ROUGH) + off

    def _node(self, rows: np.ndarray) -> int:
        place = len(self.nodes)
        self.nodes.append(())
        low, high = np.empty((0, len(rows))), np.empty((0, len(rows)))
        splits: list[int] = []
        # each next split point is the entry farthest from those before
        while len(splits) < min(self.degree, len(rows)):
            free = np.setdiff1d(rows, splits)
            near = high[:, np.searchsorted(rows, free)]
            splits.append(int(free[near.min(axis=0).argmax()] if splits else rows[0]))
            lo, hi = self._bounds(self.points[rows], self.size[rows], splits[-1])
            low, high = np.vstack((low, lo)), np.vstack((high, hi))
        is_split = np.isin(rows, splits)
        child = high.argmin(axis=0)
        child[np.searchsorted(rows, splits)] = np.arange(len(splits))
        least, most = np.full((len(splits),) * 2, np.inf), np.full((len(splits),) * 2, -np.inf)
        below: list[int | None] = []
        for j in range(len(splits)):
            own, rest = child == j, (child == j) & ~is_split
            for i in range(len(splits)):
                # a child's range counts its split point, but a split point's range to its own child does not
                seen = rest if i == j else own
                if seen.any():
                    least[i, j], most[i, j] = low[i][seen].min(), high[i][seen].max()
            below.append(self._node(rows[rest]) if rest.any() else None)
        self.nodes[place] = (np.array(splits), least, most, below)
        return place

    def candidates(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Pairs (query, entry) that may be nearest, ordered, and how many distances that took."""
        size = np.abs(queries).max(axis=1, initial=0)
        lower = np.full((len(queries), len(self.entries)), np.inf)
        best = np.full(len(queries), np.inf)
        taken = 0
        work = [(0, np.arange(len(queries)))]
        while work:
            node, rows = work.pop()
            splits, least, most, below = self.nodes[node]
            alive = np.ones((len(rows), len(splits)), bool)
            down, up = np.full(alive.shape, np.nan), np.full(alive.shape, np.nan)

            def rule_out(i: int, seen: np.ndarray) -> None:
                reach = best[rows[seen]]
                far = np.maximum(down[seen, i][:, None] - most[i], least[i] - up[seen, i][:, None])
                alive[seen] &= far <= reach[:, None]

            for i, entry in enumerate(splits):
                seen = np.flatnonzero(alive[:, i])
                down[seen, i], up[seen, i] = self._bounds(queries[rows[seen]], size[rows[seen]], entry)
                lower[rows[seen], entry] = down[seen, i]
                best[rows[seen]] = np.minimum(best[rows[seen]], up[seen, i])
                taken += len(seen)
                rule_out(i, seen)
            for i in range(len(splits)):  # once more with the final best
                rule_out(i, np.flatnonzero(~np.isnan(down[:, i])))
            for i, next_ in enumerate(below):
                if next_ is not None and alive[:, i].any():
                    work.append((next_, rows[alive[:, i]]))
        # an entry that was ruled out has an infinite lower bound
        pairs = np.nonzero((lower <= best[:, None]) & np.isfinite(lower))
        return *pairs, taken

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Per query (rows of whole numbers) the nearest entry, ties to the lower index, and its squared distance."""
        row, entry, taken = self.candidates(queries.astype(np.float64))
        width = max(1, queries.shape[1])
        size = np.abs(queries).max(axis=1, initial=0).astype(np.float64)[row] + self.size[entry]
        small = bool(len(row) == 0 or size.max() ** 2 * width < 2.0**59)
        kind = np.int64 if small else object
        used = np.unique(entry)
        table = np.zeros(self.wide.shape, kind)
        table[used] = self.wide[used].astype(kind)
        gap = queries[row].astype(kind) - table[entry]
        gap = (gap * gap).sum(axis=1) if queries.shape[1] else np.zeros(len(row), kind)
        if small:
            order = np.lexsort((entry, gap, row))
        else:
            order = np.array(sorted(range(len(row)), key=lambda i: (row[i], gap[i], entry[i])))
        first = order[np.concatenate(([True], row[order][1:] != row[order][:-1]))] if len(order) else order
        return entry[first], gap[first], taken


@dataclass
class Codebooks:
    """Per part the entries, each a tuple of whole numbers, for vectors of ``length`` components."""

    length: int
    parts: list[list[tuple[int, ...]]]
    scale: float = SCALE

    @property
    def width(self) -> int:
        return -(-self.length // len(self.parts))

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(c) for p in self.parts for e in p for c in e).encode()).hexdigest()


def _whole(column: pa.Array, length: int, books: Codebooks) -> np.ndarray:
    """The scaled vectors of a batch as whole numbers, zeros filling up the last part."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length) * float(books.scale))
    values = np.pad(values, ((0, 0), (0, books.width * len(books.parts) - length)))
    if np.abs(values).max(initial=0) < EXACT:
        return values.astype(np.int64)
    return np.array([[int(c) for c in row] for row in values], object).reshape(values.shape)


def _each_part(batch: pa.RecordBatch, books: Codebooks, trees: list[Gnat]) -> Iterator[tuple]:
    """Per part its whole numbers, nearest entries and squared distances."""
    vectors = _whole(batch.column("vector"), books.length, books)
    for p, tree in enumerate(trees):
        own = vectors[:, p * books.width:(p + 1) * books.width]
        yield own, *tree.nearest(own)[:2]


def _sums(books: Codebooks) -> Callable:
    """Component sums and counts of the vectors dealt to each entry, in pieces that Spark can add up in longs."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(part) for part in books.parts]
        totals: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for p, (own, entry, _) in enumerate(_each_part(batch, books, trees)):
                for e in np.unique(entry):
                    mine = own[entry == e]
                    known = totals.setdefault((p, int(e)), [0] * (books.width + 1))
                    for i, v in enumerate([len(mine), *mine.sum(axis=0).tolist()]):
                        known[i] += int(v)
        rows = []
        for (p, e), values in totals.items():
            for i, v in enumerate(values):
                limb = 0
                while not -(1 << LIMB) < v < 1 << LIMB:
                    rows.append((p, e, i, limb, v & ((1 << LIMB) - 1)))
                    v >>= LIMB
                    limb += 1
                rows.append((p, e, i, limb, v))
        if rows:
            names = ["part", "entry", "position", "limb", "value"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return of_batches


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < LARGEST)), F.lit(False))


def prepare(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``key, label, vector`` of the rows whose vector and components are neither null nor infinite, as a written table."""
    usable = vectors.filter(_usable(quoted(vector)))
    return materialize(usable.select(quoted(key).alias("key"), quoted(label).alias("label"),
                                     quoted(vector).cast("array<double>").alias("vector")), "code-vectors")


def fit_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                  scale: float = SCALE) -> Codebooks | None:
    """Codebooks of a prepared table, or None if it is empty.

    They start from the rows with the ``entries`` smallest keys (nulls last, repeated keys by vector). Each round all
    rows are dealt to their nearest entries, which move to the floor of the mean. The driver sees the sums of the
    entries only, however many rows there are.
    """
    if not (parts >= 1 and 1 <= entries <= 256):
        raise ValueError("there must be a part and between 1 and 256 entries")
    order = [F.asc_nulls_last("key"), F.asc("vector")]
    first = kept.orderBy(*order).select("vector").first()
    if first is None:
        return None
    length = len(first.vector)
    same = kept.filter(F.size("vector") == length)
    books = Codebooks(length, [[] for _ in range(parts)], scale)
    start = same.orderBy(*order).select("vector").limit(entries).toArrow().column("vector").combine_chunks()
    start = _whole(start, length, books) if length else np.zeros((len(start), 0), np.int64)
    width = books.width
    for p in range(parts):
        books.parts[p] = [tuple(int(c) for c in row[p * width:(p + 1) * width]) for row in start]
    for _ in range(rounds):
        sums = same.select("vector").mapInArrow(_sums(books), "part long, entry long, position long, limb long, value long") \
            .groupBy("part", "entry", "position", "limb").agg(F.sum("value").alias("value"))
        totals: dict[tuple[int, int], list[int]] = {}
        for r in sums.collect():
            totals.setdefault((r.part, r.entry), [0] * (width + 1))[r.position] += r.value << LIMB * r.limb
        for (p, e), (n, *total) in totals.items():
            books.parts[p][e] = tuple(t // n for t in total)
    return books


def _coded(books: Codebooks) -> Callable:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(part) for part in books.parts]
        for batch in batches:
            fits = np.array([s.as_py() == books.length for s in batch.column("vector").value_lengths()], bool)
            own = batch.filter(pa.array(fits))
            done = list(_each_part(own, books, trees)) if own.num_rows else []
            codes = np.stack([d[1] for d in done], axis=1).tolist() if done else []
            errors = sum((d[2].astype(object) for d in done), np.zeros(own.num_rows, object)).tolist()
            place = iter(zip(codes, errors))
            rows = [next(place) if f else (None, None) for f in fits]
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), batch.column("label"), pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                pa.array([r[1] if r[1] is not None and r[1] < LONG else None for r in rows], pa.int64())],
                ["key", "label", "codes", "error"])

    return of_batches


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """``key, label, codes, error`` of a prepared table: per part the index of the nearest entry, and the squared error."""
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    return kept.mapInArrow(_coded(books),
                           f"key {kinds['key']}, label {kinds['label']}, codes array<int>, error long")


def compress_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                     scale: float = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """Codes of all vectors, with errors, and the codebooks behind them.

    Components become ``floor(scale * x)``; a vector is cut into ``parts`` equal consecutive parts, zeros filling up the
    last. Rows ``key, label, codes, error, label_error``: the error is the squared distance to the entries, summed over
    the parts, and ``label_error`` the errors of all rows with that label (nulls together). Other input columns, whatever
    they are called, are not returned.

    Rows whose vector is null or holds a null or non-finite component are left out. Repeated rows and keys count each.
    All vectors have the length of the one with the smallest key; one of another length is returned with null codes and
    error and counts nowhere. Fewer rows than entries give fewer entries. Components may be of any size; an error, or a
    label's, that does not fit a long is null. An empty table gives an empty table and no codebooks.
    """
    kept = prepare(vectors, key, vector, label)
    books = fit_codebooks(kept, parts, entries, rounds, scale)
    if books is None:
        none = kept.select("key", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error"))
        return none.withColumn("label_error", F.col("error")), None
    coded = materialize(encode(kept, books), "vector-codes")
    lost = F.bool_or(F.col("codes").isNotNull() & F.col("error").isNull())
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    errors = coded.groupBy("label").agg(F.when(~lost, total).alias("total")).select(
        F.col("label").alias("same_label"), F.expr("try_cast(total as long)").alias("label_error"))
    joined = coded.join(errors, F.col("label").eqNullSafe(F.col("same_label")), "left")
    return joined.select("key", "label", "codes", "error", "label_error"), books
