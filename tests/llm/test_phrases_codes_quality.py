import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import beaconry.llm.collocations as phrases
import beaconry.llm.quality_rules as quality
from beaconry.llm.collocations import count_phrases, mine_collocations
from beaconry.llm.queries import QUERIES, VOCABULARIES
from beaconry.llm.quality_rules import FIELDS, LEAST_SLACK, REACH, judge_quality, load_vocabularies
from beaconry.llm.textbytes import word_ids
from beaconry.llm.vector_codes import Gnat, compress_vectors
from tests.llm.helpers import awkward_docs, empty_docs

WORD = re.compile("[^\x20\x09-\x0d]+")


def folded(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute_counts(rows, longest):
    """(lang, phrase) -> occurrences, and lang -> words."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, " ".join(words[i:i + size])) for i in range(len(words) - size + 1))
    return f, n


def brute_collocations(rows, least, top, longest=4, scale=2_000_000, covered=80):
    f, n = brute_counts(rows, longest)
    candidates = {k: a for k, a in f.items() if a >= least and " " in k[1]}
    hidden, found = set(), defaultdict(list)
    for (lang, phrase), a in candidates.items():
        words = phrase.split(" ")
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                inner = lang, " ".join(words[i:i + m])
                if 100 * a >= covered * f[inner]:
                    hidden.add(inner)
    for (lang, phrase), a in candidates.items():
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, " ".join(words[:k])], f[lang, " ".join(words[k:])]
            cuts.append((scale * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        if (lang, phrase) not in hidden:
            found[lang].append((-score, -a, phrase.encode(), left, right))
    out = []
    for lang, all_ in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(all_)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def prose(seed, count):
    rng = np.random.default_rng(seed)
    words = "the of and to in Is É a b c d new york city Bank of. island, long".split()
    return [" ".join(rng.choice(words, rng.integers(0, 40))) for _ in range(count)]


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("print_bits, least", [(64, 3), (64, 1), (1, 2)])
def test_collocations_against_brute_force(spark, print_bits, least):
    texts = [(r.doc_id, r.text if r.text is None or len(r.text) < 10_000 else r.text[:3000], r.lang) for r in awkward_docs(spark).collect()]
    texts += [(1000 + n, t, ["en", "de", None, "und", ""][n % 5]) for n, t in enumerate(prose(1, 120))]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(5) \
        .select("*", *[F.lit("clash").alias(c) for c in ("phrase", "n", "f", "size", "print", "key", "word")])
    found = mine_collocations(docs, least=least, top=30, print_bits=print_bits)
    want = brute_collocations([(lang, t) for _, t, lang in texts], least, 30)
    assert sorted(tuple(r) for r in found.select(*COLUMNS).collect()) == want
    assert len({r[0] for r in want}) >= 4


def test_phrase_pointers_and_counts(spark):
    texts = [(None, "x y", "en"), (7, "é. the x y", "en"), (7, "x y, x y", "en"), (9, "x y", "en")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    found = {r.phrase: r for r in count_phrases(docs, longest=3, least=2).collect()}
    assert (found["x y"].f, found["x y"].first_key) == (5, 7)
    assert (found[None].size, found[None].f) == (0, 12)
    assert set(found) == {None, "x", "y", "x y"}


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    text = " ".join(f"w{i % 7} v{i % 5}" + ("." if i % 11 == 0 else "") for i in range(3000)) + ". " + "z" * 900
    want = [tuple(r) for r in mine_collocations(spark.createDataFrame([(1, text, "en")], "doc_id int, text string, lang string"),
                                                least=30).collect()]
    monkeypatch.setattr(phrases, "CHUNK", 256)
    monkeypatch.setattr(phrases, "GATHERED", 8)
    again = mine_collocations(spark.createDataFrame([(1, text, "en")], "doc_id int, text string, lang string"), least=30)
    assert [tuple(r) for r in again.collect()] == want and len(want) > 5


def test_a_megabyte_of_one_text(spark):
    text = "\n".join(" ".join(f"w{(i * j) % 50}" for j in range(40)) for i in range(10_000))
    docs = spark.createDataFrame([(1, text, None)], "doc_id int, text string, lang string")
    assert len(text) > 1_000_000
    found = mine_collocations(docs).collect()
    assert {r.lang for r in found} == {"und"} and found[0].n == 400_000


def test_collocations_of_an_empty_table(spark):
    assert mine_collocations(empty_docs(spark)).count() == 0


def test_words_are_told_apart_by_their_bytes():
    raw = np.frombuffer(b"ab cd ab abc cd", np.uint8)
    starts, stops = np.array([0, 3, 6, 9, 13]), np.array([2, 5, 8, 12, 15])
    for hashes in ([1, 2, 1, 3, 2], [1, 1, 1, 1, 1]):
        ids = word_ids(raw, starts, stops, np.array(hashes, np.uint64)).tolist()
        assert ids[0] == ids[2] and ids[1] == ids[4] and len(set(ids)) == 3


# codes


def brute_codes(rows, parts, entries, rounds, scale=4096):
    kept = [(k, [math.floor(scale * x) for x in v], lab) for k, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(kept[0][1])
    width = -(-length // parts)
    same = [(k, (v + [0] * (width * parts - length)), lab) for k, v, lab in kept if len(v) == length]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in same]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), n) for n, e in enumerate(books[part]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for c in cut:
            for p in range(parts):
                groups[p, nearest(p, c[p])[1]].append(c[p])
        for (p, e), members in groups.items():
            books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    coded = []
    for (k, _, lab), c in zip(same, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        coded.append((k, lab, tuple(b[1] for b in best), sum(b[0] for b in best)))
    coded += [(k, lab, None, None) for k, v, lab in kept if len(v) != length]
    return coded, books


def vectors(kind):
    rng = np.random.default_rng(3)
    rows = [(int(n), (rng.normal(0, 1, 16) + n % 4).tolist(), n % 3 or None) for n in range(300)]
    rows += [(5, rows[5][1], 1), (None, rows[9][1], None), (400, rows[10][1], 7), (401, None, 1), (402, [1.0] * 15 + [None], 1),
             (403, [float("nan")] * 16, 1), (404, [float("inf")] + [0.0] * 15, None), (405, [1.0, 2.0], 2), (406, [], 2)]
    if kind == "ties":
        rows = [(n, [float(n % 2), float(n // 2 % 2)] * 8, None) for n in range(64)]
    if kind == "huge":
        rows += [(500, [3e38] + [0.0] * 15, 9), (501, [-1e30] * 16, 9), (2, [2.0**60] * 16, 4), (502, [1e9 + 64] * 16, 5), (503, [1e9] * 16, 5)]
    return [(k, v and [None if x is None else float(np.float32(x)) for x in v], lab) for k, v, lab in rows]


@pytest.mark.parametrize("kind, parts, entries, rounds", [
    ("plain", 8, 16, 6), ("plain", 3, 40, 2), ("ties", 8, 16, 6), ("ties", 1, 64, 1), ("huge", 8, 16, 3), ("plain", 16, 1, 0)])
def test_codes_against_brute_force(spark, kind, parts, entries, rounds):
    rows = vectors(kind)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4) \
        .select("*", F.lit("clash").alias("key"), F.lit("clash").alias("vector"), F.lit("clash").alias("codes"), F.lit(1).alias("error"))
    found, books = compress_vectors(df, parts=parts, entries=entries, rounds=rounds)
    want, want_books = brute_codes(rows, parts, entries, rounds)
    assert [[list(e) for e in p] for p in books.parts] == want_books
    got = [(r.key, r.label, r.codes and tuple(r.codes), r.error) for r in found.collect()]

    def fits(x):
        return x if x is None or x < 1 << 63 else None

    assert sorted(got, key=repr) == sorted([(k, lab, c, fits(e)) for k, lab, c, e in want], key=repr)
    for lab in {w[1] for w in want}:
        own = [e for _, x, c, e in want if x == lab and c is not None]
        total = fits(sum(own)) if own and all(fits(e) is not None for e in own) else None
        assert {r.label_error for r in found.filter(F.col("label").eqNullSafe(F.lit(lab))).collect()} == {total}


def test_codes_of_few_and_no_rows(spark):
    df = spark.createDataFrame(vectors("plain"), "vec_id long, embedding array<float>, label int")
    found, books = compress_vectors(df.filter("vec_id = 4"))
    assert [r.error for r in found.collect()] == [0] and [len(p) for p in books.parts] == [1] * 8
    for none in (df.limit(0), df.filter("vec_id = 403")):
        found, books = compress_vectors(none)
        assert found.count() == 0 and books is None


@pytest.mark.parametrize("degree", [2, 4, 7])
def test_tree_rules_out_entries_but_no_tie(degree):
    rng = np.random.default_rng(degree)
    centers = rng.integers(-10**6, 10**6, (12, 6))
    entries = [tuple(map(int, centers[n % 12] + rng.integers(-50, 50, 6))) for n in range(150)]
    entries += [entries[3], entries[3], entries[77]]
    queries = np.vstack([np.array(entries), (centers[rng.integers(0, 12, 400)] + rng.integers(-80, 80, (400, 6)))])
    tree = Gnat(entries, degree)
    found, gap, taken = tree.nearest(queries)
    exact = ((queries[:, None, :] - np.array(entries)[None]) ** 2).sum(axis=2)
    assert (found == exact.argmin(axis=1)).all() and (gap == exact.min(axis=1)).all()
    assert taken < len(queries) * len(entries) / 3


# quality


def brute_quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def brute_measures(text, coders):
    words = WORD.findall(text or "")
    chars = sum(map(len, words))
    out, first = [], 0
    for coder, of_bytes in coders:
        tokens = [t for w in words for k in range(0, len(w), quality.LONG_WORD) for t in coder([w[k:k + quality.LONG_WORD]])[0]]
        if not tokens:
            return 0, None
        first = first or len(tokens)
        share = [c / len(tokens) for c in Counter(tokens).values()]
        entropy = -sum(s * math.log2(s) for s in share)
        out += [100 * chars // len(tokens), 1000 * sum(bool(of_bytes[t]) for t in tokens) // len(tokens), math.floor(100 * entropy + 1e-6)]
    return first, out


def base4(n):
    return 0 if n == 0 else 1 + base4(n // 4)


def brute_verdicts(rows, coders):
    """doc -> (counts, base_failed, kept); rows are (lang, text)."""
    done = []
    for lang, text in rows:
        counts = brute_quality(text)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        n, measures = brute_measures(text, coders)
        script = quality._script((text or "").encode())
        band = (lang if lang is not None else f"script:{script or 'none'}", base4(n))
        done.append((counts, failed, band, measures))
    pools = defaultdict(list)
    for _, failed, band, measures in done:
        for i, m in enumerate(measures or []):
            if not failed:
                pools[band, i].append(m)
    out = []
    for counts, failed, band, measures in done:
        kept = not failed
        for i, m in enumerate(measures or []):
            if kept:
                own = sorted(pools[band, i])
                q1, q3 = own[-(-len(own) // 4) - 1], own[-(-3 * len(own) // 4) - 1]
                width = max(REACH * (q3 - q1), LEAST_SLACK[i % 3])
                kept = q1 - width <= m <= q3 + width
        out.append((*counts, failed, kept))
    return out


@pytest.fixture(scope="module")
def vocabularies():
    if not all(Path(p).exists() for p in VOCABULARIES):
        pytest.skip("no vocabulary files")
    return load_vocabularies(VOCABULARIES)


def test_quality_against_brute_force(spark, vocabularies):
    rows = [(r.lang, r.text) for r in awkward_docs(spark).collect()]
    rows = [(lang, t if t is None or len(t) < 20_000 else t[:20_000]) for lang, t in rows]
    tail = " and so the long day went on as the other days had gone before it, with much work and many guests of the house"
    rows += [("en", t + f" {n} " + " ".join(str(n * k) for k in range(3, 13)) + tail) for n, t in enumerate(prose(5, 60))]
    rows += [("en", " ".join(chr(0x13000 + 7 * i + k) for k in range(30))) for i in range(2)]
    rows += [(None, "слово и дело для всех людей на этой большой земле под небом"), (None, "#*$ %&|<> one\none\none\n \n \n" + "x" * 700),
             ("en", "a b c d e f g h i j k l m n o p a b c d e"), ("en", "\r\n".join(["same line here"] * 9))]
    docs = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "doc_id int, lang string, text string").repartition(4) \
        .select("*", F.lit("clash").alias("kept"), F.lit("clash").alias("band"), F.lit("clash").alias("row"), F.lit("clash").alias("m"))
    found = judge_quality(docs, vocabularies)
    assert {"doc_id", "lang", "text", "row", "m", "kept"} <= set(found.columns)
    got = {r.doc_id: (*[r[f] for f in FIELDS], r.base_failed, r.kept) for r in found.collect()}
    want = brute_verdicts(rows, [v.coder() for v in vocabularies])
    assert got == dict(enumerate(want))
    assert {w[-2:] for w in want} == {(True, False), (False, True), (False, False)}


def test_quality_of_long_texts_and_an_empty_table(spark, vocabularies):
    text = " ".join(f"word{i % 5000}" for i in range(300_000))
    docs = spark.createDataFrame([(1, "en", text), (2, "en", "y" * 2_000_000), (3, "en", "\n" * 1_000_000)], "doc_id int, lang string, text string")
    found = {r.doc_id: r for r in judge_quality(docs, vocabularies, carry=["doc_id"]).collect()}
    assert (found[1].n_words, found[1].n_repeat_words, found[2].word_chars, found[3].n_words) == (300_000, 300_000, 2_000_000, 0)
    assert judge_quality(empty_docs(spark), vocabularies).count() == 0


def test_quality_query_against_brute_force(spark, vocabularies):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text").collect()
    want = brute_verdicts([(r.lang, r.text) for r in rows], [v.coder() for v in vocabularies])
    got = QUERIES["op12_quality_rules"](spark, folder).collect()
    assert {tuple(r) for r in got} == {(r.doc_id, *w) for r, w in zip(rows, want)}
