import base64
import gzip
import hashlib

import numpy as np
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

import beaconry.llm.topk_search as top
import beaconry.llm.warc as warc
from beaconry.llm.topk_search import CoverTree, dual_search
from beaconry.llm.warc import _line, _unline, read_warc, records_of, write_warc
from beaconry.session import fresh_path

PAGES = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, None), (4, "http://a/4", ""), (5, "bad\r\nurl % é", "é" * 9000),
         (None, "http://n", "<p>one</p>"), (None, None, None), (2, "http://a/2", "<p>one</p>"), (0, "http://z", "\r\n\r\nWARC/1.1\r\n"),
         (7, "http://a/7", "x" * 300_000), (6, "u", "short"), (8, "u", "short")]


def pages_of(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, sha1 string").repartition(3)


def brute_records(rows, min_bytes):
    def place(r):
        return (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")

    first = {}
    for r in sorted(rows, key=place):
        body = (r[2] or "").encode()
        if len(body) >= min_bytes:
            first.setdefault(body, r[0])
    out, used = [], set()
    for r in sorted(rows, key=place):
        body = (r[2] or "").encode()
        again = len(body) >= min_bytes and body in used
        used.add(body)
        out.append((r[0], r[1], len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response",
                    first[body] if again else None))
    return out


def parsed(df):
    number = lambda x: None if x is None else int(x)
    return [(number(r.key), r.url, r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in df.collect()]


@pytest.mark.parametrize("min_bytes, shard_bytes, file_bytes", [(0, 1 << 20, 1 << 20), (6, 1 << 20, 300), (0, 1000, 100)])
def test_archive_round_trip(spark, min_bytes, shard_bytes, file_bytes):
    base = fresh_path(spark, "warc-test")
    manifest = write_warc(pages_of(spark), base, min_bytes=min_bytes, shard_bytes=shard_bytes, file_bytes=file_bytes)
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    back = read_warc(spark, base)
    assert sorted(parsed(back), key=repr) == sorted(brute_records(PAGES, min_bytes), key=repr)
    texts = {r.payload_digest: r.payload for r in back.filter("record_type = 'response'").collect()}
    assert sorted(bytes(t).decode() for t in texts.values()) == sorted({r[2] or "" for r in PAGES})
    # no file but the last of a shard is below the roll size, and the manifest's digests hold
    store, root = fs.FileSystem.from_uri(base)
    rows = sorted(manifest.collect())
    for a, b in zip(rows, rows[1:]):
        assert a.shard != b.shard or a.bytes >= file_bytes
    for r in rows:
        with store.open_input_stream(f"{root}/{r.file}", compression=None) as f:
            data = f.read()
        assert hashlib.sha256(data).hexdigest() == r.sha256 and len(data) == r.bytes
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
    assert not [i for i in store.get_file_info(fs.FileSelector(f"{root}/_temporary", recursive=True)) if i.is_file]


def test_archives_are_the_same_however_rows_arrive(spark):
    digests = []
    for parts in (1, 5):
        base = fresh_path(spark, "warc-test")
        write_warc(pages_of(spark).repartition(parts, "html"), base, shard_bytes=2000, file_bytes=200)
        digests.append(sorted((r.file, r.sha256) for r in spark.read.parquet(f"{base}/_manifest").collect()))
    assert digests[0] == digests[1] and len(digests[0]) > 2


def test_unlisted_files_are_no_part_of_an_archive(spark):
    base = fresh_path(spark, "warc-test")
    write_warc(pages_of(spark), base)
    store, root = fs.FileSystem.from_uri(base)
    with store.open_output_stream(f"{root}/part-99999999-0000.warc.gz", compression=None) as f:
        f.write(b"half a file")
    assert read_warc(spark, base, payload=False).count() == len(PAGES)


def test_archive_of_an_empty_table(spark):
    base = fresh_path(spark, "warc-test")
    assert write_warc(pages_of(spark).limit(0), base).count() == 0
    assert read_warc(spark, base).count() == 0


def test_damage_is_found(spark):
    import io
    base = fresh_path(spark, "warc-test")
    file = write_warc(pages_of(spark, PAGES[:2]), base).first().file
    store, root = fs.FileSystem.from_uri(base)
    with store.open_input_stream(f"{root}/{file}", compression=None) as f:
        data = gzip.decompress(f.read())
    assert len(list(records_of(io.BytesIO(gzip.compress(data))))) == 2
    for bad in (data.replace(b"<p>one", b"<p>two"), data[:-7], b"x" + data):
        with pytest.raises(ValueError):
            list(records_of(io.BytesIO(gzip.compress(bad))))


def test_header_values_stay_on_a_line():
    for value in ("plain", "a\r\nb: c", "50% \x7f é", ""):
        assert "\n" not in _line(value) and _unline(_line(value)) == value


# ------------------------------------------------------------ search


def test_cover_tree_covers(monkeypatch):
    monkeypatch.setattr(top, "LEAF", 20)
    points = np.random.default_rng(5).normal(size=(700, 8))
    points[100:300] = points[0]
    tree = CoverTree(points)
    for node, rows in enumerate(tree.members):
        gap = np.linalg.norm(points[rows] - points[tree.center[node]], axis=1)
        assert gap.max() <= tree.radius[node] + 1e-12
        kids = tree.children[node]
        if len(kids):
            assert sorted(np.concatenate([tree.members[c] for c in kids])) == sorted(rows)
            heads = points[[tree.center[c] for c in kids]]
            apart = np.linalg.norm(heads[:, None] - heads[None], axis=2) + np.eye(len(heads)) * 1e9
            assert apart.min() >= max(tree.radius[c] for c in kids) - 1e-9
        else:
            assert len(rows) <= 20 or tree.radius[node] == 0


def test_dual_search_prunes(monkeypatch):
    monkeypatch.setattr(top, "LEAF", 20)
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(20, 16)) * 1000
    data = np.floor(centers[rng.integers(0, 20, 6000)] + rng.normal(size=(6000, 16)))
    queries, ids = data[::50], np.arange(6000)
    compared = []
    real = CoverTree.members_of
    monkeypatch.setattr(CoverTree, "members_of", lambda self, node: compared.append(len(real(self, node))) or real(self, node))
    row, names, scores = dual_search(queries, ids[::50], np.full(120, top.LOWEST), data, ids, 5)
    whole = (queries @ data.T).astype(np.int64)
    whole[np.arange(120), ids[::50]] = top.LOWEST
    assert scores.reshape(120, 5).tolist() == np.sort(whole, axis=1)[:, :-6:-1].tolist()
    # pairs of leaves whose vectors were multiplied
    assert sum(a * b for a, b in zip(compared[::2], compared[1::2])) < 120 * 6000 / 10


def test_scores_beyond_doubles_are_exact():
    rng = np.random.default_rng(7)
    data = rng.integers(-2**27, 2**27, (90, 40)).astype(float)
    row, names, scores = dual_search(data[:9], np.arange(9), np.full(9, top.LOWEST), data, np.arange(90), 4)
    whole = data.astype(np.int64)
    for r, n, s in zip(row, names, scores):
        assert s == sum(int(a) * int(b) for a, b in zip(whole[r], whole[n]))


def test_ends_of_keys_and_urls_are_kept_and_schemes_checked(spark, tmp_path):
    rows = [(" a ", "  http://x/ ", "one"), ("a", "http://x/", "two"), ("  ", " ", "three"), (None, "", "four")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    base = str(tmp_path / "warc")
    warc.write_warc(pages, base)
    assert sorted((r.key, r.url, bytes(r.payload).decode()) for r in warc.read_warc(spark, base).filter("key IS NOT NULL").collect()) == sorted(rows[:3])
    # a path without a scheme is where Spark puts it
    assert warc.located(spark, base)[1] == f"file://{base}"
    with pytest.raises(ValueError, match="archives cannot be kept under viewfs"):
        warc.write_warc(pages, "viewfs://store/warc")


def test_a_task_reads_one_file_and_writes_one_shard(spark, tmp_path):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.concat(F.lit("http://x/"), "id").alias("url"),
                                    F.concat(F.repeat(F.lit("text "), 200), "id").alias("html"))
    base = str(tmp_path / "warc")
    files = warc.write_warc(pages, base, shard_bytes=20_000).count()
    read = warc.read_warc(spark, base)
    assert files >= 15 and read.rdd.getNumPartitions() == files
    per_task = read.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == files and sum(r["count"] for r in per_task) == 400
