"""Near duplicates: SimHash fingerprints linked through a hierarchical index in Gray order."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.llm.common import all_of, packed, quoted, unpacked, wide_hash
from beaconry.llm.components import connected
from beaconry.operators.skew import sized_join
from beaconry.session import materialize

SEED = 42
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
FANOUT = 8
#: candidate pairs of a query and an index node that are held at once
FRONTIER = 1 << 20


def fingerprint(text: bytes | None, size: int) -> int:
    """SimHash of the word shingles of a text: the majority bits of their XXH64; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    if len(words) > size:
        starts, ends = starts[:len(words) - size + 1], ends[size - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), 1 << 14):
        a, b = starts[at:at + (1 << 14)].tolist(), (ends[at:at + (1 << 14)] - 1).tolist()
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(a, b)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Rows ``(key, fingerprint)``; the fingerprint is a long of the same 64 bits."""
    picked = docs.select(quoted(key).alias("key"), *[h.alias(n) for h, n in zip(
        wide_hash(F.coalesce(quoted(text), F.lit(""))), ("k1", "k2"))], quoted(text).cast("binary").alias("text"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(t.as_py(), size) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.array(codes, np.uint64).view(np.int64))], ["key", "k1", "k2", "fingerprint"])

    schema = T.StructType([*picked.schema.fields[:3], T.StructField("fingerprint", T.LongType())])
    return picked.mapInArrow(of_batches, schema)


# ------------------------------------------------------------ the index


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The position of a code in the Gray sequence: neighbours in that order differ in few bits."""
    for shift in (1, 2, 4, 8, 16, 32):
        codes = codes ^ (codes >> np.uint64(shift))
    return codes


class GrayIndex:
    """Codes sorted by Gray rank under levels of nodes.

    A node keeps the bits its members share and its parent does not have yet, as mask and pattern. Adding up the
    differences on the way down gives the exact distance at the leaves and a lower bound at every node.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        ones, zeros = [codes], [~codes]
        while len(ones[-1]) > 1:
            cut = np.arange(0, len(ones[-1]), FANOUT)
            ones.append(np.bitwise_and.reduceat(ones[-1], cut))
            zeros.append(np.bitwise_and.reduceat(zeros[-1], cut))
        self.pattern, shared = ones, [a | b for a, b in zip(ones, zeros)]
        self.mask = [own & ~np.repeat(above, FANOUT)[:len(own)] for own, above in zip(shared, shared[1:])] + [shared[-1]]
        self.root = np.arange(len(codes))

    def _node_roots(self) -> list[np.ndarray]:
        """Per node the component all its members are in, or -1."""
        levels = [self.root]
        while len(levels[-1]) > 1:
            cut = np.arange(0, len(levels[-1]), FANOUT)
            low, high = np.minimum.reduceat(levels[-1], cut), np.maximum.reduceat(levels[-1], cut)
            levels.append(np.where(low == high, low, -1))
        return levels

    def _union(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            ra, rb = root[a], root[b]
            differ = ra != rb
            if not differ.any():
                return
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root[:] = up

    def link(self, distance: int, queries: int = 1024, same: int = 0) -> np.ndarray:
        """Per code the smallest position of its component under links of at most ``distance`` differing bits, none of
        them among the bits of ``same``.

        Nodes beyond the distance are left out with everything below them, as are nodes that already are in the
        query's component; the frontier is worked off in parts of bounded size.
        """
        same = np.uint64(same)
        top = len(self.mask) - 1
        for begin in range(0, len(self.codes), queries):
            roots = self._node_roots()
            who = np.arange(begin, min(begin + queries, len(self.codes)))
            work = [(top, who, np.zeros(len(who), np.int64), np.zeros(len(who), np.uint8))]
            while work:
                level, query, node, far = work.pop()
                if len(query) > FRONTIER:
                    half = len(query) // 2
                    work += [(level, query[:half], node[:half], far[:half]), (level, query[half:], node[half:], far[half:])]
                    continue
                differ = (self.codes[query] ^ self.pattern[level][node]) & self.mask[level][node]
                far = far + np.bitwise_count(differ)
                last = (node + 1) * FANOUT ** level - 1
                near = (far <= distance) & (differ & same == 0) & (last > query) & (roots[level][node] != roots[0][query])
                query, node, far = query[near], node[near], far[near]
                if not len(query):
                    continue
                if level == 0:
                    self._union(query, node)
                    continue
                below = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                query, far = np.repeat(query, FANOUT), np.repeat(far, FANOUT)
                there = below < len(self.pattern[level - 1])
                work.append((level - 1, query[there], below[there], far[there]))
        return self.root


# ------------------------------------------------------------ distribution


def _layout(count: int, distance: int) -> list[list[tuple[int, int]]]:
    """Ways to choose bit blocks, as (shift, width) with the chosen blocks first.

    Codes within the distance agree on some way's chosen blocks (pigeonhole), so all links are found inside groups
    of equal chosen bits. With more codes more blocks are chosen, which keeps the groups small; the links are the same.
    """
    blocks = distance + 1
    while blocks < 16 and (blocks - distance) * (64 // blocks) < 63 and count > 64 << ((blocks - distance) * (64 // blocks)):
        blocks += 1
    cuts = np.linspace(0, 64, blocks + 1).astype(int).tolist()
    fields = [(a, b - a) for a, b in zip(cuts, cuts[1:])]
    return [[fields[i] for i in chosen] + [f for i, f in enumerate(fields) if i not in chosen]
            for chosen in combinations(range(blocks), blocks - distance)]


def _rearranged(codes: np.ndarray, fields: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros_like(codes)
    for shift, width in fields:
        out = (out << np.uint64(width)) | ((codes >> np.uint64(shift)) & np.uint64((1 << width) - 1))
    return out


#: codes of a group that one task searches; a larger group is cut by more of its bits
HOT = 1 << 20


def _finer(way: list[tuple[int, int]], chosen: int) -> list[list[tuple[int, int]]]:
    """Ways to choose, beside a way's chosen blocks, half of the halves of its other blocks (pigeonhole again)."""
    halves = [f for shift, width in way[chosen:] for f in ((shift + width // 2, width - width // 2), (shift, width // 2)) if f[1]]
    free = len(way) - chosen
    return [way[:chosen] + [halves[i] for i in more] + [f for i, f in enumerate(halves) if i not in more]
            for more in combinations(range(len(halves)), len(halves) - free)]


def _linked(ways: list[list[tuple[int, int]]], chosen: list[int], distance: int):
    """Star edges inside the groups of codes that agree on a way's chosen blocks."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not parts:
            return
        way = np.concatenate([p[0] for p in parts])
        code = np.concatenate([p[1] for p in parts]).view(np.uint64)
        for n in np.unique(way):
            own = code[way == n]
            own = own[np.argsort(gray_rank(_rearranged(own, ways[n])))]
            # other groups' codes are found where they are in a group with this one
            chosen_bits = sum(width for _, width in ways[n][:chosen[n]])
            root = GrayIndex(_rearranged(own, ways[n])).link(distance, same=(1 << 64) - (1 << 64 - chosen_bits))
            value = own.view(np.int64)
            # the smallest code of a component, so that all tasks name it alike
            least = value.copy()
            np.minimum.at(least, root, value)
            least = least[root]
            moved = least != value
            yield pa.RecordBatch.from_arrays([pa.array(value[moved]), pa.array(least[moved])], ["a", "b"])

    return of_batches


def _spread(codes: DataFrame, ways: list[list[tuple[int, int]]], chosen: list[int], of_way: Column | None = None) -> DataFrame:
    """Each code with its group in every way, or in the finer ways of the way it is in."""
    def masked(n: int) -> int:
        bits = sum(((1 << width) - 1) << shift for shift, width in ways[n][:chosen[n]])
        return bits - (1 << 64) if bits >> 63 else bits

    def groups(numbers: list[int]) -> Column:
        return F.array(*[F.struct(F.lit(n).alias("way"), F.col("code").bitwiseAND(F.lit(masked(n))).alias("part")) for n in numbers])

    return codes.select("code", F.explode(groups(list(range(len(ways)))) if of_way is None else of_way(groups)).alias("p")) \
        .select("p.way", "p.part", "code")


def link_codes(codes: DataFrame, distance: int) -> DataFrame:
    """Star edges ``(a, b)`` between codes, ``b < a``, that join all codes within the distance of each other.

    ``codes`` has distinct longs ``code``. A ball of radius 3 holds 43,745 codes, so a group that is larger is not
    dense and the index prunes it. Groups are counted first, and those of more than ``HOT`` codes are dealt out again by
    half of their other bits, with the same links.
    """
    ways = _layout(codes.count(), distance)
    chosen = [len(ways[0]) - distance] * len(ways)
    spread = _spread(codes, ways, chosen)
    hot = materialize(spread.groupBy("way", "part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("way", "part"),
                      "simhash-hot")
    edges = "a long, b long"
    if hot.isEmpty():
        return spread.repartition("way", "part").select("way", "code").mapInArrow(_linked(ways, chosen, distance), edges).distinct()
    cold = sized_join(spread, hot, ["way", "part"], "left_anti")
    found = cold.repartition("way", "part").select("way", "code").mapInArrow(_linked(ways, chosen, distance), edges)
    finer, of, more = [], [], []
    for n, way in enumerate(ways):
        for f in _finer(way, chosen[n]):
            finer.append(f)
            of.append(n)
            more.append(len(f) - distance)

    def under(groups) -> Column:
        return reduce(lambda other, n: F.when(F.col("way") == n, groups([i for i, w in enumerate(of) if w == n])).otherwise(other),
                      range(len(ways)), F.lit(None))

    again = _spread(sized_join(spread, hot, ["way", "part"], "left_semi"), finer, more, under)
    split = again.repartition("way", "part").select("way", "code").mapInArrow(_linked(finer, more, distance), edges)
    return found.unionByName(split).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    distance: int = 3) -> DataFrame:
    """One row per document: ``key, k1, k2, fingerprint, root, component``.

    ``fingerprint`` holds the 64 bits of the SimHash as a long, ``component`` is the smallest key among all
    documents that links of at most ``distance`` differing bits reach, ``root`` the smallest fingerprint among them.
    ``k1, k2`` hash the text.

    A null, empty or blank text has fingerprint zero and is linked like any other. Null keys count last: a component
    of null keys only has a null component. Repeated rows share a fingerprint and each appear; an empty table gives
    an empty table. Other columns are not read.
    """
    marked = materialize(fingerprints(docs, key, text, shingle), "simhash")
    codes = materialize(
        marked.groupBy(F.col("fingerprint").alias("code")).agg(F.min("key").alias("least")), "simhash-codes")
    edges = connected(link_codes(codes.select("code"), distance))
    rooted = codes.join(edges.select(F.col("a").alias("code"), F.col("b").alias("root")), "code", "left").withColumn(
        "root", F.coalesce("root", "code"))
    least = materialize(rooted.groupBy("root").agg(F.min("least").alias("component")), "simhash-roots")
    # written, so that Spark can split the documents of a frequent fingerprint
    named = materialize(rooted.select("code", "root").join(least, "root").select(
        F.col("code").alias("fingerprint"), "root", "component"), "simhash-components")
    return marked.join(named, "fingerprint").select("key", "k1", "k2", "fingerprint", "root", "component")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The input's rows without near duplicates: of each component the row with the smallest key stays.

    Rows without a key come last, then the smaller text hash decides, and of rows that still are alike one stays.
    """
    judged = near_duplicates(docs, key, text, shingle, distance)
    alike = judged.groupBy("root", "key", "k1", "k2").agg(F.count(F.lit(1)).alias("rows"))
    place = F.struct(F.col("key").isNull().alias("keyless"), "key", "k1", "k2", "rows")
    first = materialize(alike.groupBy("root").agg(F.min(place).alias("first")).select(
        F.col("first.key").alias("key"), F.col("first.k1").alias("k1"), F.col("first.k2").alias("k2"), "first.rows"),
        "simhash-first")
    k1, k2 = wide_hash(F.coalesce(quoted(text), F.lit("")))
    rows = packed(docs, key=quoted(key), k1=k1, k2=k2).alias("d").join(first.alias("f"), all_of([
        F.col("d.key").eqNullSafe(F.col("f.key")), F.col("d.k1") == F.col("f.k1"), F.col("d.k2") == F.col("f.k2")]))
    rows = rows.select("row", "d.key", "d.k1", "d.k2", "rows")
    kept = rows.filter("rows = 1").select("row")
    if not first.filter("rows > 1").isEmpty():
        again = rows.filter("rows > 1").groupBy("key", "k1", "k2").agg(F.first("row").alias("row"))
        kept = kept.unionByName(again.select("row"))
    return unpacked(kept, docs.columns, {}, {})
