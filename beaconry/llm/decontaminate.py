"""Training documents that hold benchmark items: BM25 with block maxima, then overlap of question and answer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import packed, quoted, unpacked
from beaconry.llm.textbytes import IS_GAP, chunked, word_stream
from beaconry.session import materialize

K1, B = 1.2, 0.75
#: items under one block maximum
BLOCK = 4
#: postings of an index part; a larger benchmark is searched part by part, with the same results
PART_POSTINGS = 1_000_000
#: parts that the driver and a task hold together, about 200 MB; of a larger benchmark what was found is written between
HELD_PARTS = 4
#: cells of the passages-by-blocks table that is held at once
CELLS = 1 << 22

HIT = "array<struct<item:bigint,score:double,question:double,answer:double,passage:bigint>>"


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: what stands before and after the last question mark or line break that text follows;
    without one the first three quarters of the words and the rest."""
    body = text.strip()
    cut = max(body.rfind("?", 0, -1), body.rfind("\n"))
    if cut >= 0:
        return body[:cut + 1], body[cut + 1:]
    words = body.split()
    at = len(words) - len(words) // 4
    return " ".join(words[:at]), " ".join(words[at:])


def tokens(text: bytes) -> np.ndarray:
    return word_stream([text], IS_GAP, True)[0]


class Index:
    """Postings of items of one length class, with impacts as shares of an item's own score, and their block maxima."""

    def __init__(self, postings: pd.DataFrame, items: pd.DataFrame, longest: int):
        """``postings``: item, term, impact; ``items``: item, its keys, question, answer (token hashes of both);
        ``longest``: the most tokens an item of the class can have, repeats counted."""
        own = postings.groupby("item")["impact"].sum()
        # items of like size lie in one block, which keeps its maxima close to its members' impacts
        order = own.sort_values(kind="stable").index
        self.items = order.to_numpy(np.int64)
        place = pd.Series(np.arange(len(order)), index=order)
        table = postings.assign(at=postings["item"].map(place), share=postings["impact"] / postings["item"].map(own))
        table = table.sort_values(["term", "at"], kind="stable")
        term = table["term"].to_numpy(np.int64)
        self.terms, first = np.unique(term, return_index=True)
        self.first = np.append(first, len(term))
        self.at, self.share = table["at"].to_numpy(np.int64), table["share"].to_numpy()
        block = self.at // BLOCK
        new = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1]))))
        self.block, self.most = block[new], np.maximum.reduceat(self.share, new)
        self.block_first = np.searchsorted(new, self.first)
        self.blocks = -(-len(self.items) // BLOCK)
        sides = items.set_index("item").loc[order]
        self.keys, self.question, self.answer = list(sides["keys"]), list(sides["question"]), list(sides["answer"])
        # any item with up to a quarter of tokens put in lies within one passage
        self.stride = max(1, -(-longest * 5 // 4))
        # term numbers by the top bits of their hash; terms that share a slot are searched
        self.slot = np.full(1 << 16, -1, np.int64)
        slots = self.terms.view(np.uint64) >> np.uint64(48)
        self.slot[slots] = np.arange(len(self.terms))
        self.shared = np.bincount(slots.astype(np.int64), minlength=1 << 16) > 1

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The index's number of each token, -1 for tokens it does not have."""
        slots = (words >> np.uint64(48)).astype(np.int64)
        number = self.slot[slots]
        found = np.flatnonzero(number >= 0)
        number = number[found]
        again = self.shared[slots[found]]
        signed = words.view(np.int64)[found]
        number[again] = np.minimum(np.searchsorted(self.terms, signed[again]), len(self.terms) - 1)
        out = np.full(len(words), -1, np.int64)
        out[found] = np.where(self.terms[number] == signed, number, -1)
        return out

    @staticmethod
    def _opened(first: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list entries of all given terms, and which of the given each belongs to."""
        size = first[term + 1] - first[term]
        owner = np.repeat(np.arange(len(term)), size)
        start = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else size
        return np.arange(len(owner)) - start[owner] + first[term][owner], owner

    def retrieve(self, passage: np.ndarray, term: np.ndarray, count: int, least: float) -> Iterator[tuple]:
        """All ``(passage, item place, score)`` with a score of at least ``least``, of distinct (passage, term) pairs.

        As in block-max WAND a passage moves on to the next block whose summed maxima can reach the threshold and
        skips the blocks before it; postings are opened in those blocks only. All passages move at once.
        """
        step = max(1, CELLS // self.blocks)
        for low in range(0, count, step):
            a, b = np.searchsorted(passage, (low, low + step))
            own, terms = passage[a:b] - low, term[a:b]
            rows = min(step, count - low)
            entry, owner = self._opened(self.block_first, terms)
            bound = np.bincount(own[owner] * self.blocks + self.block[entry], self.most[entry], rows * self.blocks)
            open_block = (bound >= least - 1e-9).reshape(rows, self.blocks)
            keep = open_block.any(axis=1)[own]
            own, terms = own[keep], terms[keep]
            entry, owner = self._opened(self.first, terms)
            row, at = own[owner], self.at[entry]
            inside = open_block[row, at // BLOCK]
            cell, where = np.unique(row[inside] * len(self.items) + at[inside], return_inverse=True)
            score = np.bincount(where, self.share[entry][inside], len(cell))
            for n in np.flatnonzero(score >= least):
                yield low + int(cell[n] // len(self.items)), int(cell[n] % len(self.items)), float(score[n])

    def search(self, words: np.ndarray, begins: np.ndarray, least: float, overlap: float) -> list[list[tuple]]:
        """Per text its verified items: (item key, score, question overlap, answer overlap, passage), best passage each."""
        number = self.numbers(words)
        lengths = np.diff(begins)
        # passages of two strides, one stride apart
        per_text = np.maximum(1, -(-lengths // self.stride) - 1)
        base = np.concatenate(([0], np.cumsum(per_text)))
        hit = np.flatnonzero(number >= 0)
        owner = np.searchsorted(begins, hit, "right") - 1
        nth = (hit - begins[owner]) // self.stride
        pairs = []
        for back in (0, 1):
            fits = (nth >= back) & (nth - back < per_text[owner])
            pairs.append((base[owner] + nth - back)[fits] * len(self.terms) + number[hit][fits])
        pairs = np.unique(np.concatenate(pairs)) if len(hit) else np.zeros(0, np.int64)
        found: list[dict] = [{} for _ in lengths]
        for passage, place, score in self.retrieve(
                pairs // max(1, len(self.terms)), pairs % max(1, len(self.terms)), int(base[-1]), least):
            text = int(np.searchsorted(base, passage, "right")) - 1
            start = int(begins[text]) + (passage - int(base[text])) * self.stride
            window = words[start:min(start + 2 * self.stride, int(begins[text + 1]))]
            sides = [float(np.isin(side, window).mean()) if len(side) else 1.0
                     for side in (self.question[place], self.answer[place])]
            if min(sides) >= overlap:
                best = found[text].get(place)
                if best is None or score > best[0] + 1e-12:
                    found[text][place] = (score, *sides, passage - int(base[text]))
        return [[(key, *hit) for place, hit in f.items() for key in self.keys[place]] for f in found]


def _build(items: DataFrame) -> Iterator[list[Index]]:
    """The index of all items, one part of bounded size after the other, each a list by length class; document frequencies count over
    all parts. An item's class is the power of two that its tokens fill, so its passages depend on no other item."""
    # an item is a distinct text, whatever ids it is given under, or none
    named = items.filter(F.col("text").isNotNull()).select(
        F.col("key").cast("bigint").alias("key"), F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("item"))
    rows = materialize(named.groupBy("item", "text").agg(
        F.sort_array(F.collect_set("key")).alias("keys_"), F.bool_or(F.col("key").isNull()).alias("keyless")), "bm25-items")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                term, count = np.unique(tokens(text), return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(term), item)), pa.array(term.view(np.int64)), pa.array(count)], ["item", "term", "n"])

    postings = materialize(rows.select("item", "text").mapInArrow(listed, "item long, term long, n long"), "bm25-postings")
    whole = postings.agg(F.countDistinct("item").alias("items"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("rows")).first()
    if not whole["items"]:
        return
    mean = whole["size"] / whole["items"]
    spread = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    length = postings.groupBy("item").agg(F.sum("n").alias("length"))
    idf = F.log(1 + (whole["items"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    impact = idf * F.col("n") * (K1 + 1) / (F.col("n") + K1 * (1 - B + B * F.col("length") / mean))
    scored = postings.join(spread, "term").join(length, "item").select("item", "term", "length", impact.alias("impact"))
    parts = -(-whole["rows"] // PART_POSTINGS)
    for part in range(parts):
        own = F.pmod(F.xxhash64("item"), F.lit(parts)) == part
        table = scored.filter(own).toPandas()
        if not len(table):
            continue
        sides = []
        for row in rows.filter(own).collect():
            question, answer = split_item(bytes(row.text).decode("utf-8", "replace"))
            keys = [None] * row.keyless + list(row.keys_)
            sides.append((row.item, keys, np.unique(tokens(question.encode())), np.unique(tokens(answer.encode()))))
        sides = pd.DataFrame(sides, columns=["item", "keys", "question", "answer"])
        table = table.sort_values(["item", "term"])
        longest = table["length"].map(lambda n: 1 << (int(n) - 1).bit_length())
        yield [Index(own, sides[sides["item"].isin(own["item"])], most) for most, own in table.groupby(longest)]


def _searching(classes: list[Index], least: float, overlap: float):
    names = ("item", "score", "question", "answer", "passage")
    kind = pa.list_(pa.struct([(n, pa.int64() if n in ("item", "passage") else pa.float64()) for n in names]))

    def of_text(texts: pa.Array) -> pa.Array:
        raw = [t or b"" for t in texts.to_pylist()]
        rows = []
        for part in chunked([len(t) for t in raw]):
            words, begins = word_stream(raw[part], IS_GAP, True)
            found = [index.search(words, begins, least, overlap) for index in classes]
            rows += [[dict(zip(names, hit)) for own in hits for hit in own] for hits in zip(*found)]
        return pa.array(rows, kind)

    return of_text


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
               least: float = 0.6, overlap: float = 0.8) -> DataFrame:
    """Add ``leaks``: the benchmark items that a document holds, as an array of
    ``(item, score, question, answer, passage)`` sorted by item.

    For each length class of the items (up to 1, 2, 4, 8, ... tokens, repeats counted) every document is cut into
    overlapping passages, each long enough for any item of the class, and every passage is a query to the BM25 index of
    the class; ``passage`` numbers the passages of the item's class. ``score`` is the share of the item's own BM25 score that the passage reaches, at
    least ``least``. A retrieved item counts if at least ``overlap`` of the distinct tokens of its question, and of
    its answer, occur in the passage. Tokens are runs of letters and digits with A-Z lower-cased. Of several passages
    with one item the best is given, the first of equals.

    Documents without text, and all documents if there are no items, have an empty array; items without text or token
    find nothing. An item is a text: texts that share a key are items each, and a text given under several keys, a null
    one among them, counts once and is reported under each. Repeated documents are judged alike; an input column
    ``leaks`` is replaced. Documents are not shuffled. The index is made in parts of bounded size, at most ``HELD_PARTS``
    of which are held at a time; only a benchmark of more parts has the documents written between.
    """
    rows, body, leaks = packed(docs), F.col("row")[text].cast("binary"), F.from_json(F.lit("[]"), HIT)
    for n, classes in enumerate(_build(items.select(quoted(item_key).alias("key"), quoted(item_text).alias("text")))):
        if n and n % HELD_PARTS == 0:
            rows, leaks = materialize(rows.select("row", leaks.alias("leaks")), "leaks-so-far"), F.col("leaks")
        leaks = F.concat(leaks, F.arrow_udf(_searching(classes, least, overlap), HIT)(body))
    return unpacked(rows.select("row", F.array_sort(leaks).alias("leaks")), docs.columns, {}, {"leaks": F.col("leaks")})


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **how) -> DataFrame:
    """The documents that hold no benchmark item, with their input columns."""
    found = find_leaks(packed(docs, text=quoted(text)), items, "text", **how)
    return unpacked(found.filter(F.size("leaks") == 0), docs.columns, {}, {})
