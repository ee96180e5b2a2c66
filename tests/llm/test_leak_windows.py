"""Passages are long enough for every item, whatever its words."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import beaconry.llm.decontaminate as leaks

ITEM = (5, "ua ub uc ud ue " + "same " * 60 + "? va vb vc vd ve")
SMALL = (6, "which word comes after the first of them? none of those")


def found_in(spark, texts, items, docs_parts=2):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(docs_parts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = leaks.find_leaks(docs, bench).select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*").collect()
    return sorted(rows, key=repr)


def at_offsets(item, count, after=200):
    return [" ".join(f"n{i}" for i in range(n)) + " " + item[1] + " " + " ".join(f"m{i}" for i in range(after)) for n in range(count)]


def test_an_item_of_few_distinct_words_is_found_at_every_offset(spark):
    texts = at_offsets(ITEM, 180)
    assert {r.doc_id for r in found_in(spark, texts, [ITEM, SMALL]) if r.item == ITEM[0]} == set(range(len(texts)))


def brute_leaks(texts, items, least=0.6, overlap=0.8):
    """Every passage of every item's own length class, one at a time; items of equal texts are given once."""
    token = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    items = [i for i in items if token(i[1])]
    bags = [Counter(token(t)) for _, t in items]
    mean = sum(sum(b.values()) for b in bags) / len(bags)
    df = Counter(t for b in bags for t in b)
    found = set()
    for (key, text), bag in zip(items, bags):
        size = sum(bag.values())
        raw = {t: math.log(1 + (len(bags) - df[t] + .5) / (df[t] + .5)) * c * (leaks.K1 + 1) / (
            c + leaks.K1 * (1 - leaks.B + leaks.B * size / mean)) for t, c in bag.items()}
        sides = [set(token(s)) for s in leaks.split_item(text)]
        longest = 1
        while longest < size:
            longest *= 2
        stride = -(-longest * 5 // 4)
        for row, t in enumerate(texts):
            words = token(t)
            for p in range(max(1, -(-len(words) // stride) - 1)):
                window = set(words[p * stride:(p + 2) * stride])
                if sum(v for x, v in raw.items() if x in window) >= (least - 1e-12) * sum(raw.values()) and all(
                        len(s & window) >= overlap * len(s) for s in sides):
                    found.add((row, key))
    return found


@pytest.mark.parametrize("part", [1_000_000, 40])
def test_passages_do_not_depend_on_other_items(spark, monkeypatch, part):
    """A short item whose words lie far apart is no leak, however long another item is and whatever part it is in."""
    short = [(n, f"why{n} does this{n} come first{n}? because{n} it{n}") for n in range(100, 112)]
    items = short + [(50, "long " + " ".join(f"l{i}" for i in range(400)) + "? end " + " ".join(f"e{i}" for i in range(90))), ITEM, SMALL]
    apart = [" ".join(w + " filler" * 15 for w in t.split()) for _, t in short]
    near = [f"so far {t} and on" for _, t in short]
    texts = apart + near + [items[12][1] + " tail", "head " + items[12][1], *at_offsets(ITEM, 20), *at_offsets(SMALL, 20)]
    monkeypatch.setattr(leaks, "PART_POSTINGS", part)
    monkeypatch.setattr(leaks, "HELD_PARTS", 2 if part < 100 else 4)
    rows = found_in(spark, texts, items)
    want = brute_leaks(texts, items)
    assert {(r.doc_id, r.item) for r in rows} == want
    assert not any(r.doc_id < len(apart) for r in rows) and {n for n, _ in want} == set(range(len(apart), len(texts)))
    monkeypatch.setattr(leaks, "PART_POSTINGS", 200)
    assert found_in(spark, texts, items) == rows


def test_items_that_share_a_key_or_have_none_are_found_at_every_offset(spark):
    texts = {n: "what " + " ".join(f"{n}{i}" for i in range(12)) + "? then " + " ".join(f"{n}end{i}" for i in range(4)) for n in "abc"}
    items = [(1, texts["a"]), (1, texts["b"]), (None, texts["c"]), (2, texts["c"]), (2, texts["c"])]
    want = {"a": [1], "b": [1], "c": [2, None]}
    docs = [t for n in texts for t in at_offsets((n, texts[n]), 60, 90)]
    rows = found_in(spark, docs, items)
    for n, (name, keys) in enumerate(want.items()):
        for at in range(60):
            assert sorted((r.item for r in rows if r.doc_id == n * 60 + at), key=repr) == sorted(keys, key=repr)
    clean = leaks.decontaminate(spark.createDataFrame(list(enumerate(docs + ["clean text"])), "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"))
    assert [r.text for r in clean.collect()] == ["clean text"]
