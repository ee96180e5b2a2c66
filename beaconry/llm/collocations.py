"""Phrases whose words occur together more often than apart, mined by Rabin-Karp fingerprints.

Every phrase of up to ``longest`` words gets a fingerprint from prefix polynomials over the hashes of its words. The
shuffle adds up fingerprints, each with a pointer to a document it occurs in and a checksum over all its occurrences,
level by level: a phrase can be frequent only if all pairs of words in it are, so longer phrases with an infrequent part
are left out. Only the document pointed at spells a frequent fingerprint's phrase. If the checksum is not that of as many
occurrences of this text, several phrases share the fingerprint, and these few are counted by their text instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import batches_of, quoted
from beaconry.llm.textbytes import chunked, folded, mixed, spans_hash, windows_hash, word_bounds, word_hashes
from beaconry.session import materialize

UNNAMED = "und"
#: bytes of text looked at together; longer texts are cut between pieces
CHUNK = 1 << 20
#: distinct fingerprints, or phrases, a task gathers before it hands them on
GATHERED = 1 << 18
#: texts a worker takes, and rows it hands on, at a time
TEXTS = 1000
ROWS = 1 << 16
#: at most so many bits say which fingerprints are frequent: 32 MB, however many there are
MOST_BITS = 1 << 28
SECOND = np.uint64(0xA5A5A5A55A5A5A5A)
#: so many that the checks of 2**41 occurrences add up in a long
CHECK_BITS = 22
SUMS = ["size", "print", "n", "checks", "owner"]
POINTED = ["lang", "size", "print", "phrase", "check", "key"]
SPELLED = {"lang": pa.string(), "size": pa.int32(), "print": pa.int64(), "phrase": pa.binary(), "n": pa.int64(), "key": pa.int64()}

#: blanks separate words; the other characters end a piece
IS_END = np.zeros(256, bool)
IS_END[list(b".,;:!?\n\x0b\x0c\r")] = True
IS_EDGE = IS_END.copy()
IS_EDGE[list(b" \t")] = True


class Words:
    """The words of some segments of text in a row: their bytes, hashes, pieces and languages."""

    def __init__(self, segments: list[bytes], seeds: np.ndarray):
        self.raw = folded(np.frombuffer(b"\n".join(segments), np.uint8))
        self.starts, self.stops = word_bounds(self.raw, IS_EDGE)
        self.hashes = word_hashes(self.raw, IS_EDGE)
        self.piece = np.cumsum(IS_END[self.raw], dtype=np.int32)[self.starts]
        self.begins = np.cumsum([0] + [len(s) + 1 for s in segments])
        self.segment = np.searchsorted(self.begins, self.starts, "right") - 1
        self.seeds = seeds[self.segment]

    def whole(self, size: int) -> np.ndarray:
        """Whether the phrase of ``size`` words that starts at a word lies in one piece."""
        count = max(0, len(self.starts) - size + 1)
        return self.piece[:count] == self.piece[size - 1:][:count]

    def fingerprints(self, size: int, bits: int) -> np.ndarray:
        prints = windows_hash(self.hashes, size)
        return mixed(prints ^ self.seeds[:len(prints)] + np.uint64(size)) >> np.uint64(64 - bits)


def _segments(texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """Texts with their number, the long ones cut after an end of a piece."""
    for n, text in enumerate(texts):
        at = 0
        while len(text) - at > CHUNK:
            ends = np.flatnonzero(IS_END[np.frombuffer(text, np.uint8, CHUNK, at)])
            if len(ends):
                stop = at + int(ends[-1]) + 1
            else:
                rest = np.flatnonzero(IS_END[np.frombuffer(text, np.uint8, -1, at + CHUNK)])
                stop = at + CHUNK + int(rest[0]) + 1 if len(rest) else len(text)
            yield n, text[at:stop]
            at = stop
        yield n, text[at:] if at else text


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[Words, np.ndarray, pa.Array]]:
    """A batch of (lang, text) in parts of bounded size: words, each segment's row, and the languages."""
    langs = batch.column("lang").dictionary_encode()
    names = langs.dictionary
    seed = np.array([int(spans_hash(np.frombuffer(b"\0" + n.encode(), np.uint8).astype(np.uint64), np.zeros(1, int),
                                    np.array([len(n.encode()) + 1]))[0]) for n in names.to_pylist()], np.uint64)
    code = langs.indices.to_numpy()
    pieces = list(_segments([t or b"" for t in batch.column("text").to_pylist()]))
    for part in chunked([len(p[1]) for p in pieces], CHUNK):
        rows = np.array([p[0] for p in pieces[part]])
        yield Words([p[1] for p in pieces[part]], seed[code[rows]]), rows, langs


def _sliced(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, rows.num_rows, ROWS):
        yield rows.slice(at, ROWS)


class Marks:
    """Which fingerprints are frequent, one bit each; bits may be shared, so some others pass as well."""

    def __init__(self, bits: int, words: np.ndarray, values: np.ndarray):
        self.mask = np.uint64(bits - 1)
        self.table = np.zeros(bits // 64, np.uint64)
        self.table[words] = values.view(np.uint64)

    def __call__(self, prints: np.ndarray) -> np.ndarray:
        at = prints & self.mask
        return (self.table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _possible(words: Words, size: int, marks: dict[int, Broadcast], bits: int) -> np.ndarray:
    """Where a phrase of ``size`` words starts all of whose parts with marks are frequent."""
    open_ = words.whole(size)
    for part in sorted(p for p in marks if p <= size):
        hit = marks[part].value(words.fingerprints(part, bits))
        for k in range(size - part + 1):
            open_ &= hit[k:][:len(open_)]
    return open_


def _checks(words: Words, size: int) -> np.ndarray:
    """Some bits of a second, independent fingerprint of each phrase."""
    return (mixed(windows_hash(mixed(words.hashes ^ SECOND), size) ^ words.seeds[:max(0, len(words.hashes) - size + 1)])
            >> np.uint64(64 - CHECK_BITS)).astype(np.int64)


class Sums:
    """Fingerprints with counts, checksums and smallest pointers, added up whenever there are many."""

    def __init__(self):
        self.columns: list[tuple[np.ndarray, ...]] = []

    def __len__(self) -> int:
        return sum(len(c[0]) for c in self.columns)

    def add(self, prints: np.ndarray, n: np.ndarray, check: np.ndarray, owner: np.ndarray) -> None:
        if len(prints):
            order = np.argsort(prints)
            prints = prints[order]
            first = np.flatnonzero(np.concatenate(([True], prints[1:] != prints[:-1])))
            self.columns.append((prints[first], np.add.reduceat(n[order], first), np.add.reduceat(check[order], first),
                                 np.minimum.reduceat(owner[order], first)))

    def merge(self) -> None:
        columns, self.columns = self.columns, []
        if columns:
            self.add(*map(np.concatenate, zip(*columns)))

    def rows(self, size: int) -> Iterator[pa.RecordBatch]:
        self.merge()
        for prints, n, check, owner in self.columns:
            for low in range(0, len(prints), ROWS):
                part = slice(low, low + ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(prints[part]), size, np.int32)), pa.array(prints[part].view(np.int64)),
                     pa.array(n[part]), pa.array(check[part]), pa.array(owner[part])], SUMS)
        self.columns = []


def _counted(sizes: list[int], marks: dict[int, Broadcast], bits: int):
    """Fingerprints of possible phrases with their counts, checksums and pointers, added up within a task."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {size: Sums() for size in sizes}
        for batch in batches:
            owners = batch.column("owner").to_numpy()
            for words, row_of, _ in _parts(batch):
                owner = owners[row_of][words.segment] if len(words.starts) else np.zeros(0, np.int64)
                for size, sums in held.items():
                    at = np.flatnonzero(_possible(words, size, marks, bits))
                    sums.add(words.fingerprints(size, bits)[at], np.ones(len(at), np.int64), _checks(words, size)[at], owner[at])
                    if len(sums) > 2 * GATHERED:
                        sums.merge()
                        if len(sums) > GATHERED:
                            yield from sums.rows(size)
        for size, sums in held.items():
            yield from sums.rows(size)

    return of_batches


def _signed(owner: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """A fingerprint of (fingerprint, owner)."""
    return mixed(prints ^ mixed(owner.view(np.uint64)))


def _pointed(longest: int, marks: dict[int, Broadcast], bits: int):
    """The phrases of frequent fingerprints as text, from the documents their pointers name, with their checks.

    Per language one row more, of size 0, counts its words.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        for batch in batches:
            owners = batch.column("owner").to_numpy()
            keys = batch.column("key")
            for words, row_of, langs in _parts(batch):
                names = langs.dictionary
                code = langs.indices.to_numpy()[row_of]
                for c, n in zip(*np.unique(code[words.segment], return_counts=True)):
                    name = names[int(c)].as_py()
                    totals[name] = totals.get(name, 0) + int(n)
                if not len(words.starts):
                    continue
                owner = owners[row_of][words.segment]
                for size in range(1, longest + 1):
                    prints = words.fingerprints(size, bits)
                    at = np.flatnonzero(words.whole(size) & marks[size].value(_signed(owner[:len(prints)], prints)))
                    # once per part of a batch, whatever text it has
                    checks = _checks(words, size)[at]
                    order = np.lexsort((checks, prints[at]))
                    p, c = prints[at][order], checks[order]
                    at = at[order][np.concatenate(([True], (p[1:] != p[:-1]) | (c[1:] != c[:-1])))] if len(order) else at
                    if not len(at):
                        continue
                    pieces = [pa.array([words.raw[a:b].tobytes() for a, b in zip(words.starts[at + k], words.stops[at + k])], pa.binary())
                              for k in range(size)]
                    phrase = pc.binary_join_element_wise(*pieces, b" ") if size > 1 else pieces[0]
                    row = row_of[words.segment[at]]
                    yield pa.RecordBatch.from_arrays([
                        names.take(pa.array(code[words.segment[at]])), pa.array(np.full(len(at), size, np.int32)),
                        pa.array(prints[at].view(np.int64)), phrase, pa.array(_checks(words, size)[at]), keys.take(pa.array(row))], POINTED)
        if totals:
            count = len(totals)
            yield pa.RecordBatch.from_arrays([
                pa.array(totals, pa.string()), pa.array([0] * count, pa.int32()), pa.nulls(count, pa.int64()),
                pa.nulls(count, pa.binary()), pa.array(totals.values(), pa.int64()), pa.nulls(count, pa.int64())], POINTED)

    return of_batches


def _spelled(longest: int, marks: dict[int, Broadcast], bits: int):
    """Phrases with marked fingerprints as text, counted by text within a task, with a key they were seen at."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            columns = [pa.array(c, t) for c, t in zip(zip(*[(*k, *v) for k, v in held.items()]), SPELLED.values())]
            held.clear()
            if columns:
                yield from _sliced(pa.RecordBatch.from_arrays(columns, list(SPELLED)))

        for batch in batches:
            keys = batch.column("key").to_pylist()
            for words, row_of, langs in _parts(batch):
                names = langs.dictionary.to_pylist()
                code = langs.indices.to_numpy()[row_of]
                for size in range(1, longest + 1):
                    prints = words.fingerprints(size, bits)
                    for i in np.flatnonzero(words.whole(size) & marks[size].value(prints)).tolist():
                        phrase = b" ".join(words.raw[a:b].tobytes() for a, b in zip(words.starts[i:i + size], words.stops[i:i + size]))
                        segment = words.segment[i]
                        place = (names[code[segment]], size, int(prints[i:i + 1].view(np.int64)[0]), phrase)
                        held.setdefault(place, [0, keys[row_of[segment]]])[0] += 1
                if len(held) > GATHERED:
                    yield from rows()
        yield from rows()

    return of_batches


def _marks(prints: DataFrame, size: int) -> Broadcast:
    """The fingerprints of one size as bits, sixteen per fingerprint but at most ``MOST_BITS`` in all."""
    spark = prints.sparkSession
    own = prints.filter(F.col("size") == size)
    bits = 1 << 16
    while bits < min(MOST_BITS, 16 * own.count()):
        bits *= 2
    at = F.col("print").bitwiseAND(bits - 1)
    table = own.groupBy(F.shiftright(at, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(print & 63))")).alias("bits")).toPandas()
    return spark.sparkContext.broadcast(Marks(bits, table["word"].to_numpy(np.int64), table["bits"].to_numpy(np.int64)))


def _signed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("print").to_numpy().view(np.uint64)
        signed = _signed(batch.column("owner").to_numpy(), prints).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("size"), pa.array(signed)], ["size", "print"])


def count_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", longest: int = 4,
                  least: int = 30, print_bits: int = 64) -> DataFrame:
    """Exact counts of all phrases of 1 to ``longest`` words that occur ``least`` times or more in a language.

    Rows ``lang, size, phrase, f, first_key``, where the pointer is the smallest key of a row that holds the phrase (null
    keys, and keys that are no whole numbers, give null); and per language a row of size 0 whose ``f`` counts all its words.
    """
    if not (1 <= print_bits <= 64 and longest >= 1):
        raise ValueError("print_bits must be between 1 and 64, longest at least 1")
    named = F.coalesce(quoted(lang).cast("string"), F.lit(UNNAMED)).alias("lang")
    whole = docs.select(quoted(key)).schema[0].dataType.typeName() in ("byte", "short", "integer", "long")
    pointer = quoted(key).cast("long") if whole else F.lit(None).cast("long")
    # rows without a key point by their text
    owner = F.coalesce(pointer, F.xxhash64(quoted(text)))
    texts = docs.select(named, quoted(text).cast("binary").alias("text"), pointer.alias("key"), owner.alias("owner"))
    with batches_of(docs.sparkSession, TEXTS):
        return _count(texts, longest, least, print_bits)


def _count(texts: DataFrame, longest: int, least: int, print_bits: int) -> DataFrame:
    marks: dict[int, Broadcast] = {}
    found = []
    # words, then pairs, then all longer phrases at once
    for sizes in [s for s in ([1], [2], list(range(3, longest + 1))) if s and s[0] <= longest]:
        latest = {p: m for p, m in marks.items() if p == max(marks)}
        sums = texts.select("lang", "text", "owner").mapInArrow(
            _counted(sizes, latest, print_bits), "size int, print long, n long, checks long, owner long")
        found.append(materialize(
            sums.groupBy("size", "print").agg(F.sum("n").alias("f"), F.sum("checks").alias("checks"), F.min("owner").alias("owner"))
            .filter(F.col("f") >= least), "phrase-prints"))
        if sizes[-1] < min(3, longest):
            marks |= {size: _marks(found[-1], size) for size in sizes}
    frequent = reduce(DataFrame.unionByName, found)

    signed = materialize(frequent.mapInArrow(_signed_rows, "size int, print long"), "phrase-pointers")
    at_owner = {size: _marks(signed, size) for size in range(1, longest + 1)}
    pointed = materialize(
        texts.mapInArrow(_pointed(longest, at_owner, print_bits),
                         "lang string, size int, print long, phrase binary, check long, key long"), "phrase-texts")
    totals = pointed.filter("size = 0").groupBy("lang").agg(F.sum("check").alias("f")).select(
        "lang", F.lit(0).alias("size"), F.lit(None).cast("string").alias("phrase"), "f", F.lit(None).cast("long").alias("first_key"))
    spelled = pointed.filter("size > 0").groupBy("lang", "size", "print", "phrase", "check").agg(F.min("key").alias("first_key"))
    one_text = F.count(F.lit(1)).over(Window.partitionBy("size", "print")) == 1
    held = materialize(
        frequent.join(spelled, ["size", "print"], "left")
        .withColumn("sure", F.coalesce(one_text & (F.col("f") * F.col("check") == F.col("checks")), F.lit(False))), "phrase-held")
    sure = held.filter("sure").select("lang", "size", F.col("phrase").cast("string").alias("phrase"), "f", "first_key")
    parts = [sure, totals]
    shared = materialize(held.filter("NOT sure").select("size", "print").distinct(), "phrase-shared")
    if not shared.isEmpty():
        by_text = {size: _marks(shared, size) for size in range(1, longest + 1)}
        rows = texts.mapInArrow(_spelled(longest, by_text, print_bits),
                                "lang string, size int, print long, phrase binary, n long, key long")
        parts.append(rows.join(shared, ["size", "print"], "left_semi")
                     .groupBy("lang", "size", F.col("phrase").cast("string").alias("phrase"))
                     .agg(F.sum("n").alias("f"), F.min("key").alias("first_key")).filter(F.col("f") >= least))
    return materialize(reduce(DataFrame.unionByName, parts), "phrases")


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def mine_collocations(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", longest: int = 4,
                      least: int = 30, top: int = 2000, scale: int = 2_000_000, covered: int = 80,
                      print_bits: int = 64) -> DataFrame:
    """Each language's best phrases of 2 to ``longest`` words by how often their parts occur together.

    Words are runs of characters other than space and tab, A-Z in lower case, in pieces that end at ``.,;:!?`` and
    0A-0D. A phrase is scored ``floor(scale * a / (l + r))`` at its worst cut into two parts, ties to the first cut; a
    phrase inside a longer candidate with at least ``covered`` percent of its occurrences is left out. ``top`` per
    language stay, by score, count and phrase in byte order.

    Returns ``lang, rank, phrase, a, l, r, n, score, first_key`` and nothing of the input's other columns,
    whatever they are called. A null language counts as ``und`` together with a language of that name; null, empty and
    blank texts have no words; repeated rows count each; texts of any length are worked off in parts that end with a
    piece, so memory follows the longest piece; an empty table gives an empty table. Text that is not valid UTF-8 is
    counted by its bytes.
    """
    counts = count_phrases(docs, text, lang, key, longest, least, print_bits)
    single = F.col("size") >= 1
    totals = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    found = counts.filter("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"), "first_key")

    words = F.split("phrase", " ")
    cuts = found.select("lang", "phrase", "size", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail"))
    parts = counts.filter(single)
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    # written, so that Spark can split the phrases of a very common part
    cuts = materialize(cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
                       .select("lang", "phrase", "a", "k", "l", "r"), "phrase-cuts")
    score = F.expr(f"cast((cast(a as decimal(20,0)) * {scale}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    worst = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = F.expr("""flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),
                      i -> array_join(slice(w, i, m), ' '))))""")
    longer = found.filter("size >= 3").withColumn("w", words).select("lang", F.explode(inner).alias("phrase"), "a") \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    scored = found.join(worst, ["lang", "phrase"]).join(longer, ["lang", "phrase"], "left")
    # either factor may pass 64 bits
    kept = scored.filter(F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * covered))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "first_key") \
        .withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_key")
