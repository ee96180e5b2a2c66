"""Language of texts, word by word, by a linear-chain conditional random field."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.llm.common import any_of, packed, quoted, unpacked
from beaconry.llm.textbytes import CHUNK, chunked, folded, word_bounds, word_hashes

#: rows of the feature table; the features are hashed
BUCKETS = 1 << 16
#: words of a block in the forward-backward pass
BLOCK = 32
UNDETERMINED = "und"


# ------------------------------------------------------------ features


def _slots(codes: np.ndarray, kind: int) -> np.ndarray:
    salt = np.uint64((kind * 2 + 1) * 0xC2B2AE3D27D4EB4F % 2**64)
    salted = codes * np.uint64(0x9E3779B97F4A7C15) + salt
    return ((salted ^ (salted >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)


def features(joined: bytes) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Feature groups ``(slots, word of each slot)`` of a joined text, and the number of words.

    Byte n-grams of 2 to 4 inside a word, affixes of 1 to 3 bytes at either end, and the word itself as lexicon entry.
    """
    raw = np.frombuffer(joined, np.uint8)
    starts, stops = word_bounds(raw)
    if not len(starts):
        return [], 0
    lower = folded(raw)
    byte = lower.astype(np.uint64) + np.uint64(1)
    size = stops - starts
    word = np.arange(len(starts))
    inside = np.repeat(word, size)
    at = np.arange(size.sum()) + np.repeat(starts - np.concatenate(([0], np.cumsum(size)[:-1])), size)
    left = np.repeat(stops, size) - at
    groups, gram = [], byte[at]
    for n in (2, 3, 4):
        fits = left >= n
        at, left, inside, gram = at[fits], left[fits], inside[fits], gram[fits]
        gram = (gram << np.uint64(9)) | byte[at + n - 1]
        groups.append((_slots(gram, n), inside))
    head = tail = np.zeros(len(word), np.uint64)
    for n in (1, 2, 3):
        head = (head << np.uint64(9)) | byte[starts + np.minimum(n, size) - 1]
        tail = (tail << np.uint64(9)) | byte[stops - np.minimum(n, size)]
        groups += [(_slots(head, 10 + n), word), (_slots(tail, 20 + n), word)]
    groups.append((_slots(word_hashes(lower), 30), word))
    return groups, len(word)


def emissions(joined: bytes, table: np.ndarray) -> np.ndarray:
    """Summed weights of each word's features, words by labels."""
    groups, count = features(joined)
    out = np.zeros((count, table.shape[1]), np.float32)
    for slots, word in groups:
        rows = table[slots]
        if len(word) == count:
            out += rows
        elif len(word):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            out[word[first]] += np.add.reduceat(rows, first, axis=0)
    return out


# ------------------------------------------------------------ forward-backward


def marginals(scores: np.ndarray, transition: np.ndarray, begins: np.ndarray,
              pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Label probabilities of every word and, if asked for, the expected counts of neighbouring labels.

    ``begins`` tells where texts begin in the stream. The pass is exact for texts of any length: blocks of words are
    multiplied into one matrix each, the blocks of all texts at once, then blocks are chained within their texts,
    then words are worked off inside all blocks at once.
    """
    count, labels = scores.shape
    lengths = np.diff(begins)
    per_text = -(-lengths // BLOCK)
    blocks = int(per_text.sum())
    if not count:
        return np.zeros((0, labels)), np.zeros((labels, labels)) if pairs else None
    first_block = np.concatenate(([0], np.cumsum(per_text)))
    text_of = np.repeat(np.arange(len(lengths)), per_text)
    nth = np.arange(blocks) - first_block[text_of]
    low = begins[text_of] + nth * BLOCK
    size = np.minimum(BLOCK, begins[text_of + 1] - low)
    spot = np.minimum(low[:, None] + np.arange(BLOCK), count - 1)
    there = np.arange(BLOCK) < size[:, None]
    emit = np.exp(scores - scores.max(axis=1, keepdims=True), dtype=np.float64)
    emit = np.where(there[:, :, None], emit[spot], 1.0)
    step = np.exp(transition)
    # the product of a block's words; its first word comes by a transition unless it begins a text
    opens = nth == 0
    product = np.where(opens[:, None, None], np.eye(labels), step) * emit[:, 0, None, :]
    for t in range(1, int(size.max())):
        grown = (product.reshape(-1, labels) @ step).reshape(product.shape) * emit[:, t, None, :]
        grown /= grown.max(axis=(1, 2), keepdims=True)
        product = np.where(there[:, t, None, None], grown, product)
    before = np.full((blocks, labels), 1.0)
    after = np.full((blocks, labels), 1.0)
    for k in range(1, int(per_text.max())):
        b = first_block[:-1][per_text > k] + k
        v = (before[b - 1, None, :] @ product[b - 1])[:, 0]
        before[b] = v / v.sum(axis=1, keepdims=True)
    last = per_text - 1
    for k in range(1, int(per_text.max())):
        b = (first_block[:-1] + last - k)[per_text > k]
        v = (product[b + 1] @ after[b + 1, :, None])[..., 0]
        after[b] = v / v.sum(axis=1, keepdims=True)
    forward = np.empty((blocks, BLOCK, labels))
    v = np.where(opens[:, None], 1.0, before @ step) * emit[:, 0]
    forward[:, 0] = v / v.sum(axis=1, keepdims=True)
    deep = int(size.max())
    for t in range(1, deep):
        v = (forward[:, t - 1] @ step) * emit[:, t]
        forward[:, t] = v / v.sum(axis=1, keepdims=True)
    # what follows the last word of a block is the message of the next block
    backward = np.empty((blocks, BLOCK, labels))
    v = after
    for t in range(deep - 1, -1, -1):
        backward[:, t] = v
        w = (emit[:, t] * v) @ step.T
        v = np.where((there[:, t] & (t > 0))[:, None], w / w.sum(axis=1, keepdims=True), v)
    belief = forward[:, :deep] * backward[:, :deep]
    belief /= belief.sum(axis=2, keepdims=True)
    out = belief[there[:, :deep]]
    if not pairs:
        return out, None
    flat_f, flat_b, flat_e = (x[:, :deep][there[:, :deep]] for x in (forward, backward, emit))
    joint = flat_f[:-1, :, None] * step * (flat_e[1:] * flat_b[1:])[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return out, joint[owner[1:] == owner[:-1]].sum(axis=0)


# ------------------------------------------------------------ learning


@dataclass
class Model:
    labels: list[str] = field(default_factory=list)
    table: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))


def spliced(samples: list[tuple[bytes, int]], rng: np.random.Generator) -> list[tuple[bytes, np.ndarray]]:
    """Code-switched training texts: pieces of 8 to 40 words of all samples, one to four in a row, with word labels."""
    pieces = []
    for text, label in samples:
        words = text.split()
        at = 0
        while at < len(words):
            size = int(rng.integers(8, 41))
            pieces.append((words[at:at + size], label))
            at += size
    order = rng.permutation(len(pieces))
    texts, at = [], 0
    while at < len(order):
        take = [pieces[i] for i in order[at:at + int(rng.integers(1, 5))]]
        at += len(take)
        texts.append((b" ".join(w for words, _ in take for w in words), np.concatenate([np.full(len(w), n) for w, n in take])))
    return texts


def learn(samples: list[tuple[bytes, str]], rounds: int = 6, batch: int = 120_000, rate: float = 0.3,
          decay: float = 1e-6, seed: int = 11) -> Model:
    """Weights and transitions that maximise the conditional likelihood of the samples' word labels (AdaGrad)."""
    labels = sorted({lang for _, lang in samples})
    if not labels:
        return Model()
    rng = np.random.default_rng(seed)
    number = {lang: n for n, lang in enumerate(labels)}
    count = len(labels)
    table, power = np.zeros((BUCKETS, count), np.float32), np.full((BUCKETS, count), 1e-2, np.float32)
    transition, tpower = np.zeros((count, count)), np.full((count, count), 1e-2)
    for _ in range(rounds):
        texts = spliced([(t, number[lang]) for t, lang in samples], rng)
        for part in chunked([len(t) for t, _ in texts], batch):
            own = texts[part]
            groups, words = features(b"\n".join(t for t, _ in own))
            gold = np.concatenate([y for _, y in own])
            begins = np.cumsum([0] + [len(y) for _, y in own])
            scores = np.zeros((words, count), np.float32)
            for slots, word in groups:
                for n in range(count):
                    scores[:, n] += np.bincount(word, table[slots, n], words)
            belief, expected = marginals(scores, transition, begins, pairs=True)
            wrong = np.eye(count)[gold] - belief
            step = np.zeros((BUCKETS, count))
            for slots, word in groups:
                for n in range(count):
                    step[:, n] += np.bincount(slots, wrong[word, n], BUCKETS)
            step -= decay * words * table
            power += step * step
            table += rate * step / np.sqrt(power)
            owner = np.repeat(np.arange(len(own)), np.diff(begins))
            inner = owner[1:] == owner[:-1]
            seen = np.zeros((count, count))
            np.add.at(seen, (gold[:-1][inner], gold[1:][inner]), 1)
            tstep = seen - expected
            tpower += tstep * tstep
            transition += rate * tstep / np.sqrt(tpower)
    return Model(labels, table, transition)


def fit_languages(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", rows_per_label: int = 120,
                  max_chars: int = 6000) -> Model:
    """Learn from a bounded sample: ``rows_per_label`` rows of each label, those of smallest key and text hash.

    Of a text of more than ``max_chars`` characters a piece of that length is learned from, at a place that its hash
    names. Null and empty texts and null labels teach nothing; without any sample the model knows no label. The sample
    depends on the rows alone, not on how they are cut, also where keys are null or repeated.
    """
    known = docs.select(quoted(key).alias("key"), quoted(text).alias("text"), quoted(label).alias("label")).filter(
        F.col("label").isNotNull() & (F.length("text") > 0))
    known = known.select("label", "text", F.xxhash64("key", "label").alias("place"), F.xxhash64("text").alias("mark"))
    # narrow first: the rank needs no texts, and Spark keeps a few rows per label and task before it shuffles
    by_label = F.row_number().over(Window.partitionBy("label").orderBy("place", "mark"))
    bounds = known.select("label", "place", "mark").withColumn("n", by_label).filter(F.col("n") <= rows_per_label).groupBy("label").agg(
        F.max(F.struct("place", "mark")).alias("upto")).collect()
    if not bounds:
        return Model()
    chosen = any_of([(F.col("label") == r.label) & (
        (F.col("place") < r.upto.place) | (F.col("place") == r.upto.place) & (F.col("mark") <= r.upto.mark)) for r in bounds])
    start = F.pmod(F.col("mark"), F.greatest(F.length("text") - max_chars, F.lit(0)) + 1) + 1
    piece = F.substr("text", start.cast("int"), F.lit(max_chars)).cast("binary").alias("text")
    # equal rows share a place and may be many; as many as the rank asks for stay
    rows = known.filter(chosen).select("label", "place", "mark", piece).withColumn("n", by_label).filter(
        F.col("n") <= rows_per_label).collect()
    return learn([(bytes(r.text), r.label) for r in sorted(rows, key=lambda r: (r.label, r.place, bytes(r.text)))])


# ------------------------------------------------------------ prediction


def _beliefs(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word marginals of a chunk of texts, where texts begin, and which words can hold a letter."""
    joined = b"\n".join(texts)
    raw = np.frombuffer(joined, np.uint8)
    starts, stops = word_bounds(raw)
    begins = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
    letter = np.concatenate(([0], np.cumsum(((raw | 32) - 97 < 26) | (raw >= 128))))
    belief, _ = marginals(emissions(joined, model.table), model.transition, begins)
    return belief, begins, letter[stops] > letter[starts]


def _pieces(text: bytes) -> list[bytes]:
    """A text as pieces of about ``CHUNK`` bytes that end between words."""
    pieces, at = [], 0
    while len(text) - at > CHUNK:
        starts, stops = word_bounds(np.frombuffer(text, np.uint8, min(len(text) - at, 2 * CHUNK), at))
        later = starts[starts >= CHUNK]
        cut = int(later[0]) if len(later) else CHUNK
        pieces.append(text[at:at + cut])
        at += cut
    return [*pieces, text[at:]]


def predict_languages(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``: the label with the largest mean word probability, and that mean (0 to 1).

    The mean is over words that can hold a letter. A text that is null or has no letter gets ``und`` and score 0, as
    does every text if the model knows no label; equal means go to the first label in order. Texts of any length are
    worked off whole, very long ones in pieces of about a megabyte that count by their words. Repeated rows are
    judged alike, an empty table stays empty, and input columns called ``lang_pred`` or ``score`` are replaced.
    """
    labels = model.labels

    def of_text(texts: pa.Array) -> pa.Array:
        raw = [t or b"" for t in texts.to_pylist()]
        pieces = [(n, p) for n, t in enumerate(raw) for p in (_pieces(t) if len(t) > CHUNK else (t,))]
        total, weight = np.zeros((len(raw), len(labels))), np.zeros(len(raw))
        for part in chunked([len(p) for _, p in pieces]):
            own = pieces[part]
            belief, begins, lettered = _beliefs([p for _, p in own], model)
            row = np.repeat(np.array([n for n, _ in own]), np.diff(begins))[lettered]
            for n in range(len(labels)):
                total[:, n] += np.bincount(row, belief[lettered, n], len(raw))
            weight += np.bincount(row, minlength=len(raw))
        mean = np.round(total / np.maximum(weight, 1)[:, None], 6)
        best = mean.argmax(axis=1)
        found = weight > 0
        return pa.StructArray.from_arrays([
            pa.array([labels[b] if f else None for b, f in zip(best, found)], pa.string()),
            pa.array(np.where(found, mean[np.arange(len(raw)), best], 0.0))], ["lang", "score"])

    lettered = F.coalesce(quoted(text).rlike(r"\p{L}"), F.lit(False))
    if not labels:
        return unpacked(packed(docs), docs.columns, {}, {"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    guess = F.arrow_udf(of_text, "lang string, score double")(quoted(text).cast("binary"))
    rows = packed(docs, lettered=lettered, guess=guess)

    def told(name: str, other: Column) -> Column:
        return F.when(F.col("lettered"), F.coalesce(F.col("guess")[name], other)).otherwise(other)

    return unpacked(rows, docs.columns, {}, {
        "lang_pred": told("lang", F.lit(UNDETERMINED)), "score": told("score", F.lit(0.0))})


def language_runs(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``runs``: an array of ``(first, words, lang)``, the runs of words of one most likely language.

    For code-switched texts. A null, empty or blank text, and any text under a model without labels, has no runs.
    """
    kind = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("words", T.LongType()),
                                     T.StructField("lang", T.StringType())]))

    def of_text(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.to_pylist():
            best = [_beliefs([p], model)[0].argmax(axis=1) for p in _pieces(t or b"")] if model.labels else []
            best = np.concatenate(best) if best else np.zeros(0, int)
            cut = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1]))) if len(best) else best
            size = np.diff(np.concatenate((cut, [len(best)])))
            rows.append([{"first": int(a), "words": int(n), "lang": model.labels[best[a]]} for a, n in zip(cut, size)])
        return pa.array(rows, pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())])))

    runs = F.arrow_udf(of_text, kind)(quoted(text).cast("binary"))
    return unpacked(packed(docs, runs=runs), docs.columns, {}, {"runs": F.col("runs")})
