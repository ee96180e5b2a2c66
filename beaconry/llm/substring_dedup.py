"""Passages that occur more than once, found by factoring documents against an index of the corpus.

After relative Lempel-Ziv parsing, with two departures. The reference is the corpus itself, and its index is cut into
blocks by anchor: the least hashed phrase of ``PHRASE`` words in a window. Equal windows have equal anchors, so a document
has to meet only the blocks of its repeated anchors. And factors are not grown greedily from a place of the reference: in
a block the windows of all documents are compared by 96-bit hashes, and a factor is a run of windows that occur again,
also across the ends of anchors' runs. Greedy factors would need every place of a frequent phrase at one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import packed, quoted, unpacked, wide_hash
from beaconry.llm.textbytes import chunked, mixed, windows_hash, word_bounds, word_stream
from beaconry.session import materialize

PHRASE = 8
#: an anchor in more places than this has its windows dealt out one by one
HOT = 1000
#: hot windows a task remembers before it starts anew
REMEMBERED = 1 << 20
FACTOR = np.dtype([("high", "<u8"), ("low", "<u4")])


class Runs:
    """The runs of windows that share an anchor, in a stream of texts."""

    def __init__(self, texts: list[bytes], size: int):
        self.words, self.begins = word_stream(texts)
        phrase = min(PHRASE, size)
        least = windows_hash(self.words, phrase)
        place = np.arange(len(least))
        self.starts = self.owner = self.anchor = np.zeros(0, np.int64)
        if len(self.words) < size:
            return
        # sliding minimum over the phrases of a window, the leftmost of equals, by doubling
        span, width = size - phrase + 1, 1

        def merged(shift: int, least: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            left = least[:-shift] <= least[shift:]
            return np.where(left, least[:-shift], least[shift:]), np.where(left, place[:-shift], place[shift:])

        while width * 2 <= span:
            least, place = merged(width, least, place)
            width *= 2
        if span > width:
            least, place = merged(span - width, least, place)
        count = len(self.words) - size + 1
        owner = np.repeat(np.arange(len(texts)), np.diff(self.begins))
        whole = owner[:count] == owner[size - 1:]
        fresh = np.concatenate(([True], (place[1:count] != place[:count - 1]) | ~whole[:-1])) & whole
        self.starts = np.flatnonzero(fresh)
        self.owner = owner[self.starts]
        self.anchor = least[self.starts].view(np.int64)
        # a run ends before the next begins or where windows stop being whole
        ends = np.flatnonzero(~whole)
        nearest = np.concatenate((ends, [count]))[np.searchsorted(ends, self.starts)]
        self.stops = np.minimum(np.concatenate((self.starts[1:], [count])), nearest)


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t or b"" for t in batch.column(column).to_pylist()]


def _anchors(size: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch, "text")
            for part in chunked([len(t) for t in texts]):
                runs = Runs(texts[part], size)
                rows = pa.array(runs.owner + part.start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(runs.anchor), batch.column("k1").take(rows), batch.column("k2").take(rows)],
                    ["anchor", "k1", "k2"])

    return of_batches


def _factors(size: int):
    """Windows under repeated anchors, one row per run: what it is dealt by, where it starts, the windows' hashes.

    Windows of hot anchors are rows of their own, dealt by window. Of one a task has seen before, the later places
    are known repeats; they are dealt anywhere, and the index is told once that the window repeats.
    """
    names = ["deal", "k1", "k2", "start", "factors", "known"]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, bool] = {}
        for batch in batches:
            texts = _texts(batch, "text")
            keys = [batch.column("k1").to_numpy(), batch.column("k2").to_numpy()]
            cold, hot = ([np.unique(np.array(a.as_py() or [], np.int64)) for a in batch.column(c)] for c in ("cold", "hot"))
            for part in chunked([len(t) for t in texts]):
                runs = Runs(texts[part], size)
                first = windows_hash(runs.words, size)
                second = windows_hash(mixed(runs.words ^ np.uint64(0xA5A5A5A55A5A5A5A)), size)
                factors = np.empty(len(first), FACTOR)
                factors["high"], factors["low"] = first, second & np.uint64(0xFFFFFFFF)
                cuts = np.searchsorted(runs.owner, np.arange(part.stop - part.start + 1)) if len(runs.owner) else None
                rows: list[tuple] = []
                for n in range(part.stop - part.start if cuts is not None else 0):
                    own = slice(cuts[n], cuts[n + 1])
                    k1, k2 = int(keys[0][part.start + n]), int(keys[1][part.start + n])
                    begin = int(runs.begins[n])
                    anchors, starts, stops = runs.anchor[own], runs.starts[own], runs.stops[own]
                    for i in np.flatnonzero(np.isin(anchors, cold[part.start + n])):
                        a, b = int(starts[i]), int(stops[i])
                        rows.append((int(anchors[i]), k1, k2, a - begin, factors[a:b].tobytes(), False))
                    for i in np.flatnonzero(np.isin(anchors, hot[part.start + n])):
                        for a in range(int(starts[i]), int(stops[i])):
                            code = factors[a].tobytes()
                            deal = int(first[a:a + 1].view(np.int64)[0])
                            told = seen.get(code)
                            if told is None:
                                seen[code] = False
                                rows.append((deal, k1, k2, a - begin, code, False))
                                continue
                            if not told:
                                seen[code] = True
                                rows.append((deal, None, None, None, code, True))
                            spread = int(mixed(first[a:a + 1] + np.uint64(a - begin) ^ np.uint64(k1 & (2**64 - 1)))
                                         .view(np.int64)[0])
                            rows.append((spread, k1, k2, a - begin, b"", True))
                    if len(seen) > REMEMBERED:
                        seen = {}
                if rows:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(c, t) for c, t in zip(zip(*rows), (
                            pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()))], names)

    return of_batches


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of all runs dealt to a task: which of their windows occur again, as bits from the run's start on."""
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None:
        return
    table = table.combine_chunks()
    column = table.column("factors").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    codes = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(FACTOR) if data is not None and len(column) else \
        np.zeros(0, FACTOR)
    counts = np.diff(offsets) // FACTOR.itemsize
    row = np.repeat(np.arange(len(column)), counts)
    begin = np.concatenate(([0], np.cumsum(counts)))[:-1]
    known = table.column("known").to_numpy()
    order = np.lexsort((codes["low"], codes["high"]))
    high, low = codes["high"][order], codes["low"][order]
    new = np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1]))) if len(order) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    # a word from a task that a window repeats weighs as two places
    weight = np.bincount(group, 1 + known[row[order]]) if len(order) else np.zeros(0)
    again = np.empty(len(order), bool)
    again[order] = weight[group] > 1
    bits = np.zeros(len(column), np.int64)
    np.bitwise_or.at(bits, row[again], np.int64(1) << (np.arange(len(row)) - begin[row])[again])
    bits[known & (counts == 0)] = 1
    hit = np.flatnonzero((bits != 0) & ~table.column("k1").is_null().to_numpy())
    picked = table.select(["k1", "k2", "start"]).take(pa.array(hit)).append_column("bits", pa.array(bits[hit]))
    yield from picked.to_batches()


def _applied(size: int):
    """Removes the words under repeated windows from a text."""
    kind = pa.struct([("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])

    def one(text: bytes | None, starts: list | None, bits: list | None) -> tuple[bytes, int, int]:
        if not starts:
            words = (text or b"").split()
            return b" ".join(words), len(words), 0
        begins, ends = word_bounds(np.frombuffer(text, np.uint8))
        edge = np.zeros(len(begins) + 1, np.int64)
        for at, mask in zip(starts, bits):
            while mask:
                # a factor: consecutive repeated windows
                skip = (mask & -mask).bit_length() - 1
                mask >>= skip
                at += skip
                run = (~mask & (mask + 1)).bit_length() - 1
                edge[at] += 1
                edge[at + run - 1 + size] -= 1
                mask >>= run
                at += run
        keep = np.cumsum(edge[:-1]) == 0
        words = [text[a:b] for a, b in zip(begins[keep].tolist(), ends[keep].tolist())]
        return b" ".join(words), len(begins), int(len(begins) - keep.sum())

    def apply(text: pa.Array, starts: pa.Array, bits: pa.Array) -> pa.Array:
        rows = [one(*r) for r in zip(text.to_pylist(), starts.to_pylist(), bits.to_pylist())]
        kept = pa.array([r[0] for r in rows], pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays(
            [kept, pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], fields=list(kind))

    return F.arrow_udf(apply, "kept string, n_words long, n_removed long")


def dedup_substrings(docs: DataFrame, text: str = "text", size: int = 35) -> DataFrame:
    """Remove every word under a window of ``size`` words whose word sequence also starts at any other place.

    Words are runs of bytes other than space and 09-0D, compared as they are. Windows lie inside one document and
    are judged on the input; another place may be in the same document. Windows are compared by 96-bit hashes.

    Returns all input columns with ``text`` replaced by the kept words, joined by one space, plus ``n_words`` (before)
    and ``n_removed``, which take the place of input columns of those names. A null, empty or blank text has no
    words and comes out empty; a text of fewer than ``size`` words keeps them all; texts of any length are worked
    off in pieces; of repeated rows each counts as a place; an empty table gives an empty table.

    Only anchors leave every document. Hashes of windows are dealt out just for anchors that occur twice. A hot
    anchor's windows are dealt one by one, at most two rows a task and window, so no passage, however frequent,
    gathers in one task. ``size`` is at most 69, as the windows of a run are bits of one long.
    """
    if not 1 <= size <= PHRASE + 61:
        raise ValueError(f"size must be between 1 and {PHRASE + 61} words")
    k1, k2 = wide_hash(F.coalesce(quoted(text), F.lit("")))
    texts = docs.select(k1.alias("k1"), k2.alias("k2"), quoted(text).cast("binary").alias("text"))

    anchors = materialize(texts.mapInArrow(_anchors(size), "anchor long, k1 long, k2 long"), "factor-anchors")
    repeated = materialize(
        anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select("anchor", (F.col("n") > HOT).alias("is_hot")), "factor-repeated")

    def of(hot: bool) -> Column:
        return F.collect_set(F.when(F.col("is_hot") == hot, F.col("anchor")))

    # written, so that Spark can split the texts of a large group of copies
    wanted = materialize(anchors.join(repeated, "anchor").groupBy("k1", "k2").agg(
        of(False).alias("cold"), of(True).alias("hot")), "factor-wanted")

    dealt = texts.join(wanted, ["k1", "k2"]).mapInArrow(
        _factors(size), "deal long, k1 long, k2 long, start int, factors binary, known boolean")
    found = dealt.repartition("deal").mapInArrow(_repeats, "k1 long, k2 long, start int, bits long")
    marks = materialize(
        found.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "bits")).alias("m"))
        .select("k1", "k2", F.col("m.start").alias("starts"), F.col("m.bits").alias("bits")), "factor-marks")

    rows = packed(docs, k1=k1, k2=k2).join(marks, ["k1", "k2"], "left")
    done = rows.select("row", _applied(size)(F.col("row")[text].cast("binary"), "starts", "bits").alias("done"))
    return unpacked(done, docs.columns, {text: F.col("done.kept")},
                    {"n_words": F.col("done.n_words"), "n_removed": F.col("done.n_removed")})
