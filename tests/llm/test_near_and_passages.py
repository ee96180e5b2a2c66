import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import beaconry.llm.simhash as simhash
import beaconry.llm.substring_dedup as substrings
from beaconry.llm.components import connected
from beaconry.llm.simhash import GrayIndex, _layout, _rearranged, gray_rank, link_codes, near_duplicates, one_of_each
from tests.llm.helpers import awkward_docs, empty_docs

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_fingerprint(text, size=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, distance=3):
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in codes:
        for b in codes:
            if (a ^ b).bit_count() <= distance and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {c: find(c) for c in codes}


def test_near_duplicates_against_brute_force(spark):
    docs = awkward_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    code = {t: brute_fingerprint(t) for _, t in rows}
    root = brute_components(set(code.values()))
    least = {}
    for key, t in rows:
        if key is not None:
            least[root[code[t]]] = min(key, least.get(root[code[t]], key))
    want = Counter((key, code[t], least.get(root[code[t]])) for key, t in rows)
    found = near_duplicates(docs).select("key", "fingerprint", "component").collect()
    assert Counter((r.key, r.fingerprint % 2**64, r.component) for r in found) == want
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(root[code[r.text]] for r in kept.collect()) == Counter(set(root.values()))
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == set(least.values())


def test_near_duplicates_of_an_empty_table(spark):
    assert near_duplicates(empty_docs(spark)).count() == 0
    assert one_of_each(empty_docs(spark)).count() == 0


def clustered(seed, size):
    """Codes around a few centres: dense groups, chains and strangers."""
    rng = np.random.default_rng(seed)
    codes = set()
    for center in rng.integers(0, 2**64, 5, dtype=np.uint64).tolist():
        at = center
        for _ in range(size):
            codes.add(at)
            near = center if rng.random() < 0.5 else at
            for bit in rng.integers(0, 64, int(rng.integers(1, 6))).tolist():
                near ^= 1 << bit
            at = near
    return sorted(codes | set(rng.integers(0, 2**64, size, dtype=np.uint64).tolist()))


@pytest.mark.parametrize("seed, distance", [(1, 3), (2, 3), (3, 1), (4, 5), (5, 0)])
def test_links_against_brute_force(spark, seed, distance):
    codes = clustered(seed, 60)
    frame = spark.createDataFrame([(c - 2**64 if c >= 2**63 else c,) for c in codes], "code long")
    found = connected(link_codes(frame, distance))
    root = {c: c for c in codes} | {r.a % 2**64: r.b % 2**64 for r in found.collect()}
    classes = {}
    for c, r in brute_components(codes, distance).items():
        classes.setdefault(r, set()).add(c)
    mine = {}
    for c, r in root.items():
        mine.setdefault(r, set()).add(c)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, mine.values()))


def test_index_finds_all_links_of_sorted_codes():
    codes = np.array(clustered(9, 300), np.uint64)
    codes = codes[np.argsort(gray_rank(codes))]
    root = GrayIndex(codes).link(3, queries=64)
    want = brute_components(codes.tolist())
    assert len(set(root.tolist())) == len(set(want.values()))
    for a, b in zip(codes.tolist(), root.tolist()):
        assert want[a] == want[int(codes[b])]


def test_layouts_cover_all_bits():
    for count in (0, 10**7, 10**11):
        for way in _layout(count, 3):
            assert sorted(b for s, w in way for b in range(s, s + w)) == list(range(64))
    code = np.array([0x0123456789ABCDEF], np.uint64)
    assert int(np.bitwise_count(_rearranged(code, _layout(10**7, 3)[0]))[0]) == int(np.bitwise_count(code)[0])


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert {tuple(r) for r in connected(chain).collect()} == {(n, 0) for n in range(1, 300)}


# ------------------------------------------------------------ passages


def brute_kept(texts, size):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        keep = [True] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                keep[i:i + size] = [False] * size
        kept = [x for x, k in zip(w, keep) if k]
        out.append((" ".join(kept), len(w), len(w) - len(kept)))
    return out


@pytest.mark.parametrize("size, hot", [(35, 1000), (35, 1), (12, 1000), (12, 1), (4, 2), (1, 1000), (69, 1000)])
def test_passages_against_brute_force(spark, monkeypatch, size, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    rng = np.random.default_rng(size)
    shared = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "é"], 50).tolist()) for _ in range(3)]
    more = [(100 + n, " ".join(f"u{n}_{i}" for i in range(int(rng.integers(0, 40)))) + " " + shared[n % 3] + "\tend " + shared[n % 2][:n * 7],
             None, None, None) for n in range(40)]
    docs = awkward_docs(spark)
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"),
                            allowMissingColumns=True).repartition(5)
    texts = [r.text for r in docs.collect()]
    out = substrings.dedup_substrings(docs, size=size)
    assert set(out.columns) == set(docs.columns)
    assert sorted(map(tuple, out.select("text", "n_words", "n_removed").collect())) == sorted(brute_kept(texts, size))


def test_passages_of_an_empty_table(spark):
    assert substrings.dedup_substrings(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        substrings.dedup_substrings(empty_docs(spark), size=70)


@pytest.mark.parametrize("hot", [1 << 20, 40, 3])
def test_links_do_not_depend_on_how_groups_are_cut(spark, monkeypatch, hot):
    """A template that most fingerprints share, with links over the cut bits."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = np.random.default_rng(2)
    template = int(rng.integers(0, 2**63)) << 1
    codes = {template ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for _ in range(500)}
    codes |= {int(c) for c in rng.integers(0, 2**63, 60)}
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    edges = link_codes(spark.createDataFrame([(c,) for c in signed], "code long").repartition(3), 3).collect()
    root = {c: c for c in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in edges:
        assert ((r.a ^ r.b) % 2**64).bit_count() and r.b < r.a
        x, y = find(r.a), find(r.b)
        root[max(x, y)] = min(x, y)
    want = brute_components(codes)
    groups = {}
    for c in signed:
        groups.setdefault(find(c), set()).add(c % 2**64)
    wanted = {}
    for c, r in want.items():
        wanted.setdefault(r, set()).add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values())) and len(wanted) < len(codes)
