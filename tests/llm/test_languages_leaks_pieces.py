import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import beaconry.llm.decontaminate as leaks
from beaconry.llm.language_id import (BLOCK, CHUNK, Model, _pieces, fit_languages, language_runs, learn, marginals,
                                      predict_languages)
from beaconry.llm.piece_sampling import Lattices, Pieces, decode_pieces, load_pieces, sample_pieces, sample_texts
from beaconry.llm.queries import PIECE_MODEL, held_out, language_model
from tests.llm.helpers import awkward_docs, empty_docs
from tests.llm.test_leak_windows import brute_leaks
from tests.oracle import DATA

# ------------------------------------------------------------ languages


def brute_marginals(scores, transition):
    forward, backward = [scores[0]], [np.zeros(scores.shape[1])]
    for row in scores[1:]:
        forward.append(np.logaddexp.reduce(forward[-1][:, None] + transition, axis=0) + row)
    for row in scores[:0:-1]:
        backward.insert(0, np.logaddexp.reduce(transition + row + backward[0], axis=1))
    whole = np.logaddexp.reduce(forward[-1])
    pairs = sum((np.exp(f[:, None] + transition + s + b - whole) for f, s, b in zip(forward, scores[1:], backward[1:])),
                np.zeros(transition.shape))
    return np.exp(np.array(forward) + np.array(backward) - whole), pairs


@pytest.mark.parametrize("labels", [1, 2, 5])
def test_forward_backward_against_brute_force(labels):
    rng = np.random.default_rng(labels)
    lengths = [0, 1, 5, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK + 7, 0, 200]
    begins = np.cumsum([0] + lengths)
    scores, transition = rng.normal(size=(begins[-1], labels)) * 3, rng.normal(size=(labels, labels))
    belief, pairs = marginals(scores, transition, begins, pairs=True)
    want = [brute_marginals(scores[a:b], transition) for a, b in zip(begins, begins[1:]) if b > a]
    assert np.allclose(belief, np.concatenate([w[0] for w in want]), atol=1e-9)
    assert np.allclose(pairs, sum(w[1] for w in want), atol=1e-8)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    named = predict_languages(docs.filter(held_out()), language_model(docs)).filter("lang IS NOT NULL AND lang_pred <> 'und'")
    right = named.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert named.count() > 200 and right >= 0.97


def test_awkward_texts_have_defined_languages(spark):
    docs = awkward_docs(spark)
    out = predict_languages(docs, fit_languages(docs))
    assert set(out.columns) == set(docs.columns)
    rows = out.select("doc_id", "text", "lang_pred", "score").collect()
    assert len(rows) == docs.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered)
        assert 0 <= r.score <= 1 and (lettered or r.score == 0)
    assert {r.lang_pred for r in rows if r.doc_id == 1} == {"de"}
    assert predict_languages(empty_docs(spark), fit_languages(docs)).count() == 0
    unknown = fit_languages(empty_docs(spark))
    assert {(r.lang_pred, r.score) for r in predict_languages(docs, unknown).collect()} == {("und", 0.0)}


def test_runs_of_code_switched_text(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    model = language_model(docs)
    of = {lang: docs.filter((F.col("lang") == lang) & F.length("text").between(400, 900)).orderBy("doc_id").first().text.split()[:30]
          for lang in ("en", "de")}
    mixed = spark.createDataFrame([(1, " ".join(of["en"] + of["de"])), (2, None), (3, "")], "doc_id long, text string")
    runs = {r.doc_id: r.runs for r in language_runs(mixed, model).collect()}
    assert runs[2] == runs[3] == []
    assert sum(r.words for r in runs[1]) == 60
    label = [r.lang for r in runs[1] for _ in range(r.words)]
    assert np.mean([a == b for a, b in zip(label, ["en"] * 30 + ["de"] * 30)]) >= 0.9


def test_very_long_texts_are_cut_between_words():
    text = b" ".join(b"word%d" % n for n in range(400_000))
    pieces = _pieces(text)
    assert len(pieces) > 2 and b"".join(pieces) == text
    assert [w for p in pieces for w in p.split()] == text.split()
    assert b"".join(_pieces(b"x" * (3 * CHUNK))) == b"x" * (3 * CHUNK)


def test_learning_is_repeatable():
    samples = [(b"the cat and the dog", "en"), (b"der hund und die katze", "de")] * 5
    one, two = learn(samples), learn(samples)
    assert np.array_equal(one.table, two.table) and one.labels == ["de", "en"]
    assert learn([]).labels == Model().labels == []


def test_every_label_is_learned_however_long_its_texts(spark):
    english = "the cat and the dog went over the hill with the man who had the old house by the sea " * 95
    german = "der hund und die katze gingen ueber den berg"
    docs = spark.createDataFrame([(n, f"{english} {n}", "en") for n in range(20)] + [(n, f"{german} {n}", "de") for n in range(20)],
                                 "doc_id int, text string, lang string")
    assert len(english) > 7000
    model = fit_languages(docs)
    assert model.labels == ["de", "en"]
    named = predict_languages(docs, model).collect()
    assert all(r.lang_pred == r.lang for r in named)


def test_the_sample_is_the_same_however_rows_are_cut(spark):
    """Null and repeated keys tie; the texts then decide, and as many rows as asked for are learned from."""
    rows = [(None, f"the cat number {n} and the dog", "en") for n in range(300)] + [(1, "same words again and again", "en")] * 200
    rows += [(None, f"der hund nummer {n} und die katze", "de") for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    models = [fit_languages(docs.repartition(n), rows_per_label=30) for n in (1, 7)]
    assert models[0].labels == models[1].labels == ["de", "en"]
    assert np.array_equal(models[0].table, models[1].table) and np.array_equal(models[0].transition, models[1].transition)


# ------------------------------------------------------------ leaks

ITEMS = [(n, " ".join(f"item{n}word{i % 17}x{(i * 7 + n) % 23}" for i in range(12 + 3 * n)) + " the end") for n in range(30)]


@pytest.mark.parametrize("part", [1_000_000, 60])
def test_leaks_against_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(leaks, "PART_POSTINGS", part)
    rng = np.random.default_rng(3)
    noise = [w for _, t in ITEMS for w in t.split()] + ["the", "end", "other", "words"]
    texts = [r.text for r in awkward_docs(spark).collect()]
    for n, t in ITEMS:
        words = t.split()
        around = rng.choice(noise, 150).tolist()
        texts.append(" ".join(around[:70] + words + around[70:]).upper())
        half = [w for w in words if rng.random() < 0.85]
        texts.append(", ".join(around[:40] + half + around[40:90]))
        texts.append(" ".join(rng.choice(words, len(words) // 2).tolist() + around))
    items = ITEMS + [ITEMS[3], (77, None), (78, ""), (None, "no key at all")]
    docs = spark.createDataFrame([(n, t, "x") for n, t in enumerate(texts)], "doc_id long, text string, leaks string")
    bench = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, row string")
    found = leaks.find_leaks(docs, bench)
    assert found.columns == ["doc_id", "text", "leaks"]
    rows = found.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*").collect()
    want = brute_leaks(texts, [*ITEMS, (None, "no key at all")])
    assert len(want) > 30 and {(r.doc_id, r.item) for r in rows} == want
    assert all(r.score >= 0.6 and r.question >= 0.8 and r.answer >= 0.8 for r in rows)
    kept = leaks.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {r.doc_id for r in rows}


def test_no_items_or_documents(spark):
    docs = awkward_docs(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks.find_leaks(docs, none).filter(F.size("leaks") > 0).count() == 0
    assert leaks.decontaminate(docs, none).count() == docs.count()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert leaks.find_leaks(empty_docs(spark), items).count() == 0


def test_questions_and_answers():
    assert leaks.split_item("What is it? A cat.") == ("What is it?", " A cat.")
    assert leaks.split_item("line\nanswer") == ("line\n", "answer")
    assert leaks.split_item("a b c d e f g h") == ("a b c d e f", "g h")
    assert leaks.split_item("really?") == ("really?", "")


# ------------------------------------------------------------ pieces


@pytest.fixture(scope="module")
def pieces():
    return load_pieces(PIECE_MODEL)


def toy(byte: bool) -> Pieces:
    parts = [b"<unk>"] + ["▁", "a", "b", "ab", "▁a", "▁ab", "ba", "▁▁"] * 1
    parts = [p.encode() if isinstance(p, str) else p for p in parts]
    parts[0] = b""
    of_byte = np.full(256, -1, np.int64)
    if byte:
        of_byte = np.arange(256) + len(parts)
        parts += [b"<%d>" % n for n in range(256)]
    return Pieces(parts, np.concatenate(([-9.0], -np.linspace(1, 3, 8), np.full(256 * byte, -9.0))), of_byte, 0)


def all_ways(text, p):
    """Every segmentation of a marked text with its weight."""
    marked = ("▁" + text.replace(" ", "▁")).encode()
    index = {p.parts[n]: n for n in p.normal.tolist()}
    out = []

    def go(at, ids, weight):
        if at == len(marked):
            out.append((tuple(ids), weight))
        for size in range(1, len(marked) - at + 1):
            n = index.get(marked[at:at + size])
            if n is not None:
                go(at + size, ids + [n], weight + p.weight[n])

    go(0, [], 0.0)
    whole = np.logaddexp.reduce([w for _, w in out])
    return {ids: math.exp(w - whole) for ids, w in out}


@pytest.mark.parametrize("text", ["ab", "abab", "ab a", "  ba"])
def test_samples_follow_the_distribution(text):
    p, count = toy(False), 20_000
    probability = all_ways(text, p)
    found = sample_texts([text.encode()] * count, np.arange(count).astype(np.uint64), Lattices(p), 2)
    pairs = Counter()
    for a, b in zip(found[::2], found[1::2]):
        assert (a.rank, b.rank) == (1, 2) and a.key > b.key
        for s in (a, b):
            assert math.isclose(s.log_prob, math.log(probability[tuple(s.ids.tolist())]), abs_tol=1e-9)
            assert s.log_inclusion <= 0
        pairs[tuple(a.ids.tolist()), tuple(b.ids.tolist())] += 1
    # without replacement, in order: p(a) p(b) / (1 - p(a))
    for a, pa_ in probability.items():
        for b, pb in probability.items():
            want = 0 if a == b else pa_ * pb / (1 - pa_)
            assert abs(pairs[a, b] / count - want) <= 4.5 * math.sqrt(max(want, 1e-4) / count)


def test_inclusion_scores_weigh_samples_without_bias():
    # sum of p / q over a sample estimates 1
    p, count = toy(False), 4000
    found = sample_texts([b"abab ab"] * count, np.arange(count).astype(np.uint64), Lattices(p), 3)
    sums = np.zeros(count)
    for s in found:
        sums[s.text] += math.exp(s.log_prob - s.log_inclusion)
    assert abs(sums.mean() - 1) < 0.03


def test_every_segmentation_comes_out_once():
    p = toy(False)
    for text in ("ab", "abab", "ba ab", ""):
        found = sample_texts([text.encode()], np.array([5], np.uint64), Lattices(p), 500)
        ways = all_ways(text, p) if text else {(): 1.0}
        assert {tuple(s.ids.tolist()) for s in found} == set(ways) and len(found) == len(ways)
        assert [s.key for s in found] == sorted((s.key for s in found), reverse=True)
        assert all(s.log_inclusion == 0 for s in found)


def test_texts_are_sampled_alike_in_any_company(pieces):
    texts = [b"one text", b"", "zwei Wörter\nund  mehr ".encode(), b"three " * 50]
    seeds = np.array([7, 8, 9, 10], np.uint64)
    together = {(s.text, s.rank): s.ids.tolist() for s in sample_texts(texts, seeds, Lattices(pieces), 3)}
    for n, t in enumerate(texts):
        for s in sample_texts([t], seeds[n:n + 1], Lattices(pieces), 3):
            assert s.ids.tolist() == together[n, s.rank]


def test_round_trip_of_awkward_texts(spark, pieces):
    docs = awkward_docs(spark)
    more = [(500, "\U0001f600☃\x00\x07 ▁ mark", None, None, None), (501, "no" * 3000, None, None, None), (502, " lead", None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"),
                            allowMissingColumns=True)
    found = decode_pieces(sample_pieces(docs, pieces, want=2), pieces).collect()
    at_once = sample_pieces(docs, pieces, want=2, decoded=True).select("key", "rank", "ids", "decoded").collect()
    assert Counter((r.key, r["rank"], tuple(r.ids), r.decoded) for r in found) == Counter(
        (r.key, r["rank"], tuple(r.ids), r.decoded) for r in at_once)
    texts = Counter((r.doc_id, (r.text or "").replace("▁", " ")) for r in docs.collect())
    assert Counter((r.key, r.decoded) for r in found if r["rank"] == 1) == texts
    assert {(r.key, r.decoded) for r in found} <= set(texts)
    by_text = {}
    for r in found:
        by_text.setdefault((r.key, r.decoded), set()).add(tuple(r.ids))
    assert len(by_text[0, docs.filter("doc_id = 0").first().text]) == 2
    assert sample_pieces(empty_docs(spark), pieces).count() == 0


def test_decoding_odd_ids(spark, pieces):
    rows = spark.createDataFrame([([5, None, -1, 10**6, 1, 2],), (None,), ([],), ([0xE9 + 3],)], "ids array<int>")
    assert [r.decoded for r in decode_pieces(rows, pieces).collect()] == ["\x02", "", "", "�"]


def test_models_without_byte_pieces():
    p = toy(False)
    found = sample_texts(["aéb".encode()], np.array([1], np.uint64), Lattices(p), 2)
    assert all(0 in s.ids for s in found)
    q = toy(True)
    found = sample_texts(["aéb".encode()], np.array([1], np.uint64), Lattices(q), 2)
    assert all(pa.array(s.ids).to_pylist().count(int(q.of_byte[0xC3])) == 1 for s in found)


def test_lattices_built_anew_sample_alike(pieces, monkeypatch):
    import beaconry.llm.piece_sampling as sampling
    texts = [f"text number {n} with wörds".encode() for n in range(20)]
    seeds = np.arange(20).astype(np.uint64)
    grown = Lattices(pieces)
    one = [s.ids.tolist() for n in range(20) for s in sample_texts(texts[n:n + 1], seeds[n:n + 1], grown, 2)]
    monkeypatch.setattr(sampling, "MOST_NODES", 50)
    small = Lattices(pieces)
    two = [s.ids.tolist() for n in range(20) for s in sample_texts(texts[n:n + 1], seeds[n:n + 1], small, 2)]
    assert one == two and len(small.total) < len(grown.total)
