"""Every row with a key and a finite vector takes part, whatever its size and however often its key occurs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import beaconry.llm.topk_search as top
from beaconry.llm.queries import QUERIES

KIND = "vec_id long, embedding array<double>"


def brute_rows(rows, k, every=5):
    whole = [(key, [int(np.floor(256.0 * x)) for x in v]) for key, v in rows
             if key is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in {key for key, _ in whole if key % every == 0}:
        scores = sorted((-sum(x * y for x, y in zip(a, b)), d) for key, a in whole if key == q
                        for d, b in whole if d != q and len(a) == len(b))
        out += [(q, n + 1, d, -s) for n, (s, d) in enumerate(scores[:k])]
    return sorted(out)


def awkward_rows(seed, count, dims=6):
    rng = np.random.default_rng(seed)
    rows = [(n, v.tolist()) for n, v in enumerate(rng.normal(size=(4, dims))[rng.integers(0, 4, count)] + rng.normal(size=(count, dims)) * 0.1)]
    again = [(n, (rng.normal(size=dims) * 2).tolist()) for n in rng.integers(0, count, count // 4).tolist()]
    large = [(count + 1, [2.0**20] + [0.5] * (dims - 1)), (count + 2, [-(2.0**40), 2.0**40] + [0.0] * (dims - 2)),
             (count + 6, [2.0**22] * dims), (5, [0.0] * (dims - 2) + [2.0**21, 0.25])]
    none = [(count + 7, None), (count + 8, [float("nan")] * dims), (count + 9, [None] * dims), (None, [9.0] * dims),
            (count + 11, [float("inf")] + [0.0] * (dims - 1)), (count + 12, [0.5] * (dims - 1)), (5, [0.25] * (dims - 1))]
    return rows + again + [rows[3], rows[3], rows[10], rows[10]] + large + none


def found_in(spark, rows, k=5):
    found = top.search_rows(spark.createDataFrame(rows, KIND).repartition(3), F.col("vec_id") % 5 == 0, k=k).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)


@pytest.mark.parametrize("seed, count, block, fan, k", [(1, 300, 4096, 256, 5), (2, 300, 60, 256, 2), (3, 400, 20, 4, 5),
                                                        (5, 4, 4096, 256, 5)])
def test_all_rows_against_brute_force(spark, monkeypatch, seed, count, block, fan, k):
    """One block, cells under one upper cell each, and cells under upper cells that hold several."""
    monkeypatch.setattr(top, "BLOCK_ROWS", block)
    monkeypatch.setattr(top, "BATCH_ROWS", max(2, block // 4))
    monkeypatch.setattr(top, "FAN_CELLS", fan)
    rows = awkward_rows(seed, count) if count > 10 else awkward_rows(seed, 12)[:count]
    assert found_in(spark, rows, k) == brute_rows(rows, k)


def test_ties_go_to_the_smaller_key(spark, monkeypatch):
    monkeypatch.setattr(top, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(9)
    rows = [(n, v.tolist()) for n, v in enumerate(rng.integers(-1, 2, (400, 6)) / 256)]
    assert found_in(spark, rows, 3) == brute_rows(rows, 3)


def test_no_rows_and_no_queries(spark):
    frame = spark.createDataFrame(awkward_rows(1, 20), KIND)
    assert top.search_rows(frame.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert top.search_rows(frame, F.lit(False)).count() == 0


def test_pairs_of_blocks_grow_less_than_with_the_square(spark, monkeypatch):
    """Clusters that lie apart: a batch meets the blocks of its own cluster, however many others there are."""
    monkeypatch.setattr(top, "BLOCK_ROWS", 25)
    monkeypatch.setattr(top, "FAN_CELLS", 64)
    met = []
    written = top.materialize
    monkeypatch.setattr(top, "materialize", lambda df, label: (lambda t: (met.append((label, t.count())), t)[1])(written(df, label)))
    pairs, covers = [], []
    for clusters in (4, 16):
        rng = np.random.default_rng(clusters)
        centers = np.eye(16)[:clusters] * 50
        rows = [(n, (centers[n % clusters] + rng.normal(size=16) * 0.01).tolist()) for n in range(100 * clusters)]
        met.clear()
        assert found_in(spark, rows) == brute_rows(rows, 5)
        pairs.append(sum(n for label, n in met if label == "top-pairs"))
        covers.append([n for label, n in met if label in ("top-block-covers", "top-batch-covers")])
    # four times the rows, well under sixteen times the pairs, which all pairs of covers would be
    assert pairs[1] < 8 * pairs[0] and pairs[1] < covers[1][0] * covers[1][1] / 3, (pairs, covers)


def test_the_query_takes_all_rows(spark, tmp_path):
    rows = awkward_rows(3, 120)
    spark.createDataFrame(rows, KIND).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = QUERIES["op8_top_search"](spark, str(tmp_path)).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == brute_rows(rows, 5, 50)


def test_a_score_beyond_a_long_is_no_wrong_score(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [-(2.0**40), 1.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0])]
    of = lambda rows, k: top.search_rows(spark.createDataFrame(rows, KIND), F.col("vec_id") % 5 == 0, k=k)
    assert [(r.vec_id, r.score) for r in of(rows, 2).orderBy("rank").collect()] == [(2, 2**56 + 2**16), (3, 2**16)]
    # a score that does not fit is null, but it is the best or the worst
    assert [(r.vec_id, r.score) for r in of(rows, 3).orderBy("rank").collect()] == [(2, 2**56 + 2**16), (3, 2**16), (1, None)]
    assert [(r.vec_id, r.score) for r in of(rows + [(4, [2.0**40, 0.0])], 2).orderBy("rank").collect()] == [(4, None), (2, 2**56 + 2**16)]
    assert of([(0, [1e307]), (1, [1.0])], 2).count() == 0


def test_products_of_any_size():
    rng = np.random.default_rng(3)
    size = 2.0 ** rng.integers(0, 120, (60, 1))
    x = np.floor(rng.normal(size=(60, 8)) * size)
    y = np.concatenate((np.floor(rng.normal(size=(40, 8)) * 50), x[:30][:, ::-1] * ([1, -1] * 4), np.full((1, 8), 1e300)))
    want = [[max(-top.BEYOND, min(top.BEYOND, sum(int(p) * int(q) for p, q in zip(a, b)))) for b in y] for a in x]
    assert top.wide_products(x, y).tolist() == want
