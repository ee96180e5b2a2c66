"""The pipeline's stages one by one against brute force, on awkward rows and on whole runs."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from beaconry.llm.language_id import fit_languages, predict_languages
from beaconry.session import materialize
from tests.llm.helpers import awkward_docs, empty_docs
from tests.llm.test_languages_leaks_pieces import ITEMS
from tests.llm.test_leak_windows import brute_leaks
from tests.llm.test_lines_urls_secrets import BLANK, folded
from tests.llm.test_near_and_passages import brute_components, brute_fingerprint

STAGES = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with boilerplate lines, near copies, leaks and awkward rows, and its benchmark."""
    root = str(tmp_path_factory.mktemp("corpus"))
    rows = []
    for n in range(60):
        body = " ".join(f"the river{n}x{i} runs to the old mill{(i * n) % 13} and the sea" for i in range(6 + n % 5))
        rows.append((1000 + n, f"Cookie NOTICE\n{body}\n  cookie notice \nown line {n}", "en", f"s{n % 3}", 0))
        rows.append((2000 + n, f"Der Fluss{n} läuft über die Mühle{n % 7} und der Hund{n} springt\nCookie notice", "de", "s1", 0))
    rows += [(3000 + n, rows[2 * n][1] + (" end" if n % 2 else ""), "en", "s0", 0) for n in range(20)]
    rows += [(4000 + n, f"before {n} the old river and the sea. " + t + f" after {n} the mill", "en", "s2", 0) for n, t in ITEMS[:8]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    awkward_docs(spark).select(*docs.columns).unionByName(docs).repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages_and_their_order():
    assert [n for n, _ in pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "sentencepiece_sampling"]
    assert pipeline.ORACLE_SQL is None


def brute_lines(texts):
    seen = {}
    for n, t in enumerate(texts):
        for line in (t or "").split("\n"):
            seen.setdefault(folded(line.strip(BLANK)), set()).add(n)
    gone = {k for k, v in seen.items() if len(v) >= 10 and k}
    return ["\n".join(x for x in (t or "").split("\n") if folded(x.strip(BLANK)) not in gone) for t in texts]


def test_whole_run_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    # stage 1: what has a letter and a likely language stays; the labels come from the operator, tested elsewhere
    model = fit_languages(docs)
    named = predict_languages(docs, model).collect()
    least = (1 + (len(model.labels) - 1) / 15) / len(model.labels) - 1e-6
    keep = Counter((r.doc_id, r.text) for r in named if r.lang_pred != "und" and r.score >= least)
    one = materialize(STAGES["language_id"](spark, docs, folder), "t")
    assert one.columns == columns and Counter((r.doc_id, r.text) for r in one.collect()) == keep
    assert all(any(c.isalpha() for c in t) for _, t in keep)
    # stage 2
    rows = [(r.doc_id, r.text) for r in one.collect()]
    cut = Counter(zip((k for k, _ in rows), brute_lines([t for _, t in rows])))
    two = materialize(STAGES["line_dedup"](spark, one, folder), "t")
    assert two.columns == columns and Counter((r.doc_id, r.text) for r in two.collect()) == cut
    assert all(r.n_chars == len(r.text) for r in two.collect())
    assert any("ookie" in (t or "") for _, t in keep) and not any("ookie" in t for _, t in cut)
    # stage 3: one document of each group, the one with the smallest id
    code = {t: brute_fingerprint(t) for _, t in cut}
    root = brute_components(set(code.values()))
    least = {}
    for k, t in cut:
        least[root[code[t]]] = min(least.get(root[code[t]], (True, 0)), (k is None, k or 0))
    three = materialize(STAGES["simhash_near_dedup"](spark, two, folder), "t")
    kept = [(r.doc_id, r.text) for r in three.collect()]
    assert three.columns == columns
    assert Counter(root[code[t]] for _, t in kept) == Counter(least.keys())
    assert all(least[root[code[t]]] == (k is None, k or 0) for k, t in kept)
    assert not any(k and 3000 <= k < 4000 for k, _ in kept)
    # stage 4
    leaking = {n for n, _ in brute_leaks([t for _, t in kept], ITEMS)}
    four = materialize(STAGES["benchmark_decontamination"](spark, three, folder), "t")
    clean = [r for n, r in enumerate(kept) if n not in leaking]
    assert len(leaking) >= 8 and four.columns == columns
    assert Counter((r.doc_id, r.text) for r in four.collect()) == Counter(clean)
    # stage 5: what is decoded is what was encoded
    five = STAGES["sentencepiece_sampling"](spark, four, folder).collect()
    digest = {(k, hashlib.sha256(t.encode()).hexdigest()) for k, t in clean}
    assert {(r.doc_id, r.text_sha256) for r in five} == digest
    assert all(r.n_pieces == len(r.ids) for r in five)
    found = Counter((r.doc_id, r["rank"], tuple(r.ids)) for r in pipeline.run(spark, folder).collect())
    assert found == Counter((r.doc_id, r["rank"], tuple(r.ids)) for r in five)


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, folder, name):
    docs = awkward_docs(spark)
    out = STAGES[name](spark, docs, folder)
    assert out.count() > 0
    assert STAGES[name](spark, empty_docs(spark), folder).count() == 0
    if name != pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
        assert out.filter(F.col("row") != "clash").count() == 0
