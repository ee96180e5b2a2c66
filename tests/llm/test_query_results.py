"""The registered queries that SQL cannot express, on whole test tables against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from beaconry.llm.queries import QUERIES
from tests.llm.test_leak_windows import brute_leaks
from tests.llm.test_near_and_passages import brute_components, brute_fingerprint

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


def test_repeated_passages(spark, docs):
    size = 35
    words = [WORD.findall(d.text or "") for d in docs]
    places = defaultdict(list)
    for n, w in enumerate(words):
        for i in range(len(w) - size + 1):
            places[tuple(w[i:i + size])].append((n, i))
    gone = [set() for _ in docs]
    for at in places.values():
        if len(at) > 1:
            for n, i in at:
                gone[n].update(range(i, i + size))
    want = Counter()
    for d, w, out in zip(docs, words, gone):
        kept = " ".join(x for i, x in enumerate(w) if i not in out)
        want[d.doc_id, len(w), len(out), hashlib.sha256(kept.encode()).hexdigest()] += 1
    found = QUERIES["op3_substring_dedup"](spark, FOLDER).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, found)) == want and any(gone)


def test_near_duplicates(spark, docs):
    code = {d.doc_id: brute_fingerprint(d.text) for d in docs}
    root = brute_components(set(code.values()))
    least = {}
    for key, c in code.items():
        least[root[c]] = min(key, least.get(root[c], key))
    want = {(key, f"{c:016x}", least[root[c]]) for key, c in code.items()}
    found = QUERIES["op4_simhash_near_dedup"](spark, FOLDER).select("doc_id", "fingerprint", "component_id").collect()
    assert set(map(tuple, found)) == want and len(found) == len(docs)
    assert len({w[2] for w in want}) < len(docs)


def test_languages(spark, docs):
    found = {r.doc_id: r for r in QUERIES["op6_language_id"](spark, FOLDER).collect()}
    lang = {d.doc_id: d.lang for d in docs}
    lettered = {d.doc_id for d in docs if any(c.isalpha() for c in d.text or "")}
    assert set(found) == set(lang)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*lang.values(), "und"} for r in found.values())
    assert {k for k, r in found.items() if r.lang_pred == "und"} == set(lang) - lettered
    held = [k for k, r in found.items() if r.held_out and k in lettered and lang[k]]
    crc = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", F.expr("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"))
    assert {k for k, out in crc.collect() if out} == {k for k, r in found.items() if r.held_out}
    assert sum(found[k].lang_pred == lang[k] for k in held) >= 0.9 * len(held) > 10


def test_sampled_pieces(spark, docs):
    found = QUERIES["op9_sentencepiece_sampling"](spark, FOLDER).collect()
    text = {d.doc_id: hashlib.sha256((d.text or "").encode()).hexdigest() for d in docs}
    ranks = defaultdict(list)
    for r in found:
        assert r.text_sha256 == text[r.doc_id]
        ranks[r.doc_id].append((r["rank"], r.ids_hash, r.log_prob, r.log_inclusion))
    assert set(ranks) == set(text)
    for own in ranks.values():
        own.sort()
        assert [o[0] for o in own] == list(range(own[0][0], own[0][0] + len(own)))
        assert len({o[1] for o in own}) == len(own) and all(o[2] < 0 and o[3] <= 1e-9 for o in own)
    again = QUERIES["op9_sentencepiece_sampling"](spark, FOLDER).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_benchmark_items_in_documents(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = {(docs[n].doc_id, key) for n, key in brute_leaks([d.text for d in docs], items)}
    found = QUERIES["op10_decontaminate"](spark, FOLDER).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and want
    assert all(r.bm25_share >= 0.6 and min(r.question_overlap, r.answer_overlap) >= 0.8 for r in found)
