"""Quality rules on documents: counts of what junk repeats, and how well public vocabularies fit the text.

A tokeniser splits prose of the languages it was made for into few, varied tokens. Text that it cuts into single bytes
or very short tokens, or always into the same ones, is noise, markup or another script than it says. What is usual
differs between languages and lengths, so each measure has a band per language (or script) and length class, taken from
the quartiles of all documents that pass the base rules.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import BLANKS, quoted
from beaconry.llm.textbytes import IS_BLANK, chunked, pair_ids, word_bounds, word_hashes, word_ids
from beaconry.operators.skew import sized_join
from beaconry.session import materialize

REPEAT_WORDS = 5
CHUNK = 1 << 21
#: longer words are encoded in pieces of so many characters, so a text without blanks takes linear time
LONG_WORD = 512
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
# fixed value: how the texts of byte-level vocabularies are split before merging
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# fixed values: blocks of letters by script, for documents without a language
SCRIPTS = {"Latin": (0x41, 0x24F), "Greek": (0x370, 0x3FF), "Cyrillic": (0x400, 0x52F), "Hebrew": (0x590, 0x5FF),
           "Arabic": (0x600, 0x6FF), "Devanagari": (0x900, 0x97F), "Thai": (0xE00, 0xE7F), "Kana": (0x3040, 0x30FF),
           "Han": (0x4E00, 0x9FFF), "Hangul": (0xAC00, 0xD7AF)}
#: characters per token and bits of entropy in hundredths, share of byte tokens in thousandths
MEASURES = ("chars_per_token", "byte_share", "entropy")
#: a band is never narrower than this beyond its quartiles: half a character, 50 per mille, one bit
LEAST_SLACK = (50, 50, 100)
#: quartile ranges beyond the quartiles that still count as usual
REACH = 3

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
KIND = pa.struct([(f, pa.int64()) for f in FIELDS] + [("script", pa.string()), ("n_tokens", pa.int64()),
                                                      ("measures", pa.list_(pa.int64()))])
KIND_SQL = ", ".join(f"{f} long" for f in FIELDS) + ", script string, n_tokens long, measures array<long>"


@dataclass(frozen=True)
class Vocabulary:
    """A public vocabulary: a SentencePiece model (``pieces``) or base64 ranks of byte-level tokens (``ranks``)."""

    kind: str
    data: bytes

    def coder(self) -> tuple[Callable[[list[str]], list[list[int]]], np.ndarray]:
        """How words become tokens, and which tokens are bytes that make no whole character."""
        if self.kind == "pieces":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.data)
            count = model.get_piece_size()
            return (lambda words: model.encode(words, num_threads=1) if words else []), \
                np.array([model.is_byte(n) or model.is_unknown(n) for n in range(count)])
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.data.splitlines())}
        # no word is a special token
        model = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        single = np.zeros(max(ranks.values()) + 1, bool)
        for token, rank in ranks.items():
            single[rank] = token.decode(errors="ignore") == ""
        return (lambda words: [model.encode_ordinary(" " + w) for w in words]), single


def _coder(vocabulary: Vocabulary) -> tuple[Callable, np.ndarray]:
    """A vocabulary's coder, built once per worker process: functions that travel with a job keep nothing between tasks."""
    built = sys.modules.setdefault("beaconry_coders", ModuleType("beaconry_coders")).__dict__
    name = hashlib.sha256(vocabulary.data).hexdigest()
    if name not in built:
        built[name] = vocabulary.coder()
    return built[name]


def load_vocabularies(paths: Sequence[str]) -> list[Vocabulary]:
    """Read vocabulary files on the driver; they travel with the job."""
    found = []
    for path in paths:
        with open(path, "rb") as file:
            found.append(Vocabulary("pieces" if path.endswith(".model") else "ranks", file.read()))
    return found


def _script(text: bytes) -> str | None:
    """The script most letters are of."""
    code = np.frombuffer(text.decode(errors="replace").encode("utf-32-le", "replace"), np.uint32)
    code = code[(code >= 0xC0) | ((code | 32) >= 97) & ((code | 32) <= 122)]
    counts = {name: int(((code >= a) & (code <= b)).sum()) for name, (a, b) in SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else None


def _repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    lines = [x for x in text.split(b"\n") if x.strip(BLANKS.encode())]
    return sum(x in seen or seen.add(x) is not None for x in lines)


class Texts:
    """The words of some texts in a row, and what is counted of them."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.raw = np.frombuffer(b"\n".join(texts), np.uint8)
        self.bytes_at = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.starts, self.stops = word_bounds(self.raw)
        self.ids = word_ids(self.raw, self.starts, self.stops, word_hashes(self.raw))
        self.begins = np.searchsorted(self.starts, self.bytes_at)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.begins))

    def per_text(self, flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return np.diff(sums[np.minimum(at, len(flags))])

    def repeated(self, size: int) -> np.ndarray:
        """Per text the words in windows of ``size`` words that occur more than once in it."""
        count = max(0, len(self.ids) - size + 1)
        chain = self.ids
        for step in range(1, size):
            chain = pair_ids(chain[:len(self.ids) - step], self.ids[step:])
        at = np.flatnonzero(self.owner[:count] == self.owner[size - 1:][:count])
        window = pair_ids(self.owner[at], chain[at])
        again = at[np.bincount(window)[window] > 1] if len(at) else at
        edge = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(edge, again, 1)
        np.add.at(edge, again + size, -1)
        return self.per_text(np.cumsum(edge[:-1]) > 0, self.begins)

    def tokens(self, coder: Callable, byte_tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the number of tokens, of byte tokens, and the entropy of its tokens in bits.

        Each word is encoded by itself, with one blank before it, and each distinct word once.
        """
        _, first, ids = np.unique(self.ids, return_index=True, return_inverse=True)
        pieces, owner = [], []
        for n, i in enumerate(first.tolist()):
            word = self.raw[self.starts[i]:self.stops[i]].tobytes().decode(errors="replace")
            cut = [word[k:k + LONG_WORD] for k in range(0, len(word), LONG_WORD)]
            pieces += cut
            owner += [n] * len(cut)
        coded = coder(pieces)
        sizes = np.bincount(np.array(owner, np.int64), [len(c) for c in coded], len(first)).astype(np.int64)
        flat = np.fromiter((t for c in coded for t in c), np.int64, int(sizes.sum()))
        offset = np.cumsum(sizes) - sizes
        n_of = sizes[ids]
        text = np.repeat(self.owner, n_of)
        step = np.arange(len(text)) - np.repeat(np.cumsum(n_of) - n_of, n_of)
        token = flat[np.repeat(offset[ids], n_of) + step]
        count = len(self.texts)
        total = np.bincount(text, minlength=count)
        of_bytes = np.bincount(text, byte_tokens[token], count).astype(np.int64)
        pair, times = np.unique(text * len(byte_tokens) + token, return_counts=True)
        spread = np.bincount(pair // len(byte_tokens), times * np.log2(times), count)
        entropy = np.log2(np.maximum(total, 1)) - spread / np.maximum(total, 1)
        return total, of_bytes, entropy


def _measured(vocabularies: list[Vocabulary]):
    """Counts and measures of whole texts."""
    loaded: list = []

    def of_texts(texts: list[bytes], unnamed: list[bool]) -> list[dict]:
        own = Texts(texts)
        inside = ~IS_BLANK[own.raw]
        n_words = np.diff(own.begins)
        chars = own.per_text(inside & (own.raw & 0xC0 != 0x80), own.bytes_at)
        columns = {"n_words": n_words, "word_chars": chars, "n_symbols": own.per_text(IS_SYMBOL[own.raw], own.bytes_at),
                   "n_dup_lines": np.array([_repeated_lines(t) for t in texts]), "n_repeat_words": own.repeated(REPEAT_WORDS)}
        measures, n_tokens = [], None
        for coder, byte_tokens in loaded:
            total, of_bytes, entropy = own.tokens(coder, byte_tokens)
            least = np.maximum(total, 1)
            measures += [100 * chars // least, 1000 * of_bytes // least, np.floor(100 * entropy + 1e-6).astype(np.int64)]
            n_tokens = total if n_tokens is None else n_tokens
        columns["n_tokens"] = n_tokens
        rows = [dict(zip(columns, r)) for r in zip(*[c.tolist() for c in columns.values()])]
        for n, row in enumerate(rows):
            row["script"] = _script(texts[n]) if unnamed[n] else None
            row["measures"] = [int(m[n]) for m in measures] if row["n_words"] else None
        return rows

    def apply(text: pa.Array, unnamed: pa.Array) -> pa.Array:
        if not loaded:
            loaded.extend(map(_coder, vocabularies))
        texts = [t or b"" for t in text.to_pylist()]
        flags = unnamed.to_pylist()
        rows: list[dict] = []
        for part in chunked([len(t) for t in texts], CHUNK):
            rows += of_texts(texts[part], flags[part])
        return pa.array(rows, KIND)

    return F.arrow_udf(apply, KIND_SQL)


def judge_quality(docs: DataFrame, vocabularies: list[Vocabulary], text: str = "text", lang: str = "lang",
                  carry: Sequence[str] | None = None, least_words: int = 10, most_repeated: int = 20,
                  reach: int = REACH) -> DataFrame:
    """Documents with their counts, measures and verdict.

    Words are runs of characters other than space and 09-0D. ``word_chars`` counts code points in words, ``n_symbols`` the
    characters ``#*$%&|<>``, ``n_dup_lines`` lines with a word that equal an earlier line, ``n_repeat_words`` the words in
    five-word windows found at least twice in the text. ``base_failed``: fewer than ``least_words`` words, or more than
    ``most_repeated`` percent of them repeated.

    Each vocabulary adds three ``measures``, in this order: characters per token (hundredths), byte tokens (thousandths)
    and entropy of the tokens in bits (hundredths). The ``band`` of a document is its language, or ``script:`` and its
    most frequent script if the language is null, and ``size_class`` the digits of its token count in base 4. Within
    these, a measure may lie ``reach`` quartile ranges, or ``LEAST_SLACK``, beyond the quartiles of all documents that did
    not fail the base rules; counts per value are added up, so the quartiles are exact. ``kept`` is false if the
    base rules failed or a measure lies outside; ``outside`` lists the numbers of those measures.

    Returns the columns ``carry`` (default: all; name fewer to leave the texts out) and the added ones, which take the
    place of input columns of those names. Null, empty and blank texts have no words, no measures and fail. Repeated
    rows count each. Words of any length are encoded in pieces of ``LONG_WORD`` characters, so very long texts take
    linear time; bytes that are not UTF-8 count as one replacement character each in tokens and scripts. An empty table
    gives an empty table.
    """
    columns = [c for c in (docs.columns if carry is None else carry)]
    own = docs.select(*[quoted(c) for c in dict.fromkeys([*columns, text, lang])])
    named = quoted(lang).cast("string")
    rows = own.select(F.struct(*[quoted(c) for c in columns]).alias("row") if columns else F.lit(0).alias("row"),
                      named.alias("lang"), _measured(vocabularies)(quoted(text).cast("binary"), named.isNull()).alias("m"))
    failed = (F.col("m.n_words") < least_words) | (F.col("m.n_repeat_words") * 100 > F.col("m.n_words") * most_repeated)
    digits = F.when(F.col("m.n_tokens") > 0, F.length(F.conv(F.col("m.n_tokens").cast("string"), 10, 4))).otherwise(0)
    judged = materialize(rows.select(
        "row", "m", failed.alias("base_failed"), digits.alias("size_class"),
        F.coalesce("lang", F.concat(F.lit("script:"), F.coalesce("m.script", F.lit("none")))).alias("band")), "quality-measures")

    same = ["band", "size_class", "measure"]
    bins = judged.filter(~F.col("base_failed")).select("band", "size_class", F.posexplode("m.measures").alias("measure", "value")) \
        .groupBy(*same, "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*same).orderBy("value"))
    total = F.sum("n").over(Window.partitionBy(*same))
    quartiles = bins.select(*same, "value", upto.alias("upto"), total.alias("total")).groupBy(*same).agg(
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("value"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("value"))).alias("q3"))
    slack = F.element_at(F.array(*[F.lit(s) for s in LEAST_SLACK]), F.col("measure") % len(MEASURES) + 1)
    width = F.greatest((F.col("q3") - F.col("q1")) * reach, slack)
    # one row per language and length class: broadcast within a measured size, so that a common language is no single task
    usual = materialize(quartiles.groupBy("band", "size_class").agg(F.map_from_entries(F.collect_list(F.struct(
        "measure", F.struct((F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))))).alias("usual")),
        "quality-bands")
    outside = F.expr("""filter(sequence(0, size(m.measures) - 1), i -> m.measures[i] < usual[i].low or m.measures[i] > usual[i].high)""")
    done = sized_join(judged, usual, ["band", "size_class"], "left").withColumn(
        "outside", F.when(F.col("base_failed"), F.lit(None)).otherwise(outside))
    added = {**{f: F.col("m")[f] for f in FIELDS}, "base_failed": F.col("base_failed"), "band": F.col("band"),
             "size_class": F.col("size_class"), "measures": F.col("m.measures"), "outside": F.col("outside"),
             "kept": ~F.col("base_failed") & (F.size("outside") == 0)}
    kept = [F.col("row")[c].alias(c) for c in columns if c not in added]
    return done.select(*kept, *[c.alias(n) for n, c in added.items()])
