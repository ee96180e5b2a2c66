"""One read of the trunk for all metrics: raw rows, quarantine, late rows and the input of the windows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beaconry import schemas
from beaconry.functions.times import ceil_tick, epoch_seconds
from beaconry.operators.lookup import metric_thresholds
from beaconry.operators.skew import sized_join, task_parts
from beaconry.session import materialize, scratch
from beaconry.sources.messages import accepted, decode_metric, quarantined
from beaconry.streaming import windows as w
from beaconry.streaming.carried import newest_times, read_carried, record_times, write_carried
from beaconry.streaming.sinks import METRIC_SINK, STATE_SINK_COLUMNS, read_upserts, start_query, state_keys, upsert_sink
from beaconry.streaming.streams import UNKNOWN_COLUMNS, Table, metric_windows, now

KIND, WATERMARK = "kind", "watermark"
LATE = schemas.extend(schemas.METRIC, kind=schemas.STR, watermark=schemas.LONG)
HEALTH_KEYS = ["server_id", "timestamp"]
HEALTH = schemas.struct(server_id=schemas.LONG, timestamp=schemas.LONG, severity=schemas.INT)
NEWEST = "newest"
# what the windows of a metric carry: rows seen and sums per slide, as far back as a row to come can reach
SEEN = schemas.struct(id=schemas.LONG, timestamp=schemas.TS)
TILES = schemas.struct(hostname=schemas.STR, tile=schemas.LONG, total=schemas.T.DoubleType(), n=schemas.LONG)


def fan_out(trunk: DataFrame, root: str, metrics: Mapping[str, str], delay: int = 60, available_now: bool = False) -> StreamingQuery:
    """Read the trunk once and write what every metric needs.

    ``metrics`` maps a metric to its key prefix. Under ``root``: ``<metric>`` raw rows (keyed sink), ``quarantine`` unusable
    messages, ``late`` rows that are not younger than their metric's watermark, with that watermark, and ``window_input/<metric>``
    all others, for ``window_query``. A batch runs under the watermark that the batches before it left: the newest event
    time of a metric less ``delay`` seconds. It is recorded with the batch, so a batch that runs again splits its rows in
    the same way. Every accepted message is in ``late`` or in ``window_input``.
    """
    raw = {m: upsert_sink(f"{root}/{m}", METRIC_SINK[1], METRIC_SINK[0]) for m in metrics}
    bad = upsert_sink(f"{root}/quarantine", ["raw"])
    late_sink = upsert_sink(f"{root}/late", LATE.names)
    kind = F.lit(None).cast("string")
    for metric, prefix in metrics.items():
        kind = F.when(F.col("key").startswith(prefix), metric).otherwise(kind)

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # written, not cached: six steps read it, and none of them should decode a message again
        kept = materialize(batch, "fan-out")
        bad(quarantined(kept), batch_id)
        rows = accepted(kept)
        before = newest_times(spark, f"{root}/times", batch_id)
        marks = spark.createDataFrame([(m, t - delay) for m, t in before.items()], f"{KIND} string, {WATERMARK} long")
        marked = rows.join(F.broadcast(marks), KIND, "left")
        # as a stream that removes duplicates sees it
        is_late = F.coalesce(epoch_seconds("timestamp") <= F.col(WATERMARK), F.lit(False))
        late_sink(marked.filter(is_late), batch_id)
        for metric, sink in raw.items():
            own = rows.filter(F.col(KIND) == metric)
            sink(own, batch_id)
            fresh = marked.filter((F.col(KIND) == metric) & ~is_late).select(*METRIC_SINK[1])
            fresh.write.mode("overwrite").parquet(f"{root}/window_input/{metric}/batch_id={batch_id}")
        newest = dict(rows.groupBy(KIND).agg(F.unix_timestamp(F.max("timestamp"))).collect())
        record_times(spark, f"{root}/times", batch_id, before, newest)

    routed = trunk.withColumn(KIND, kind).filter(F.col(KIND).isNotNull())
    decoded = decode_metric(routed, KIND)
    return start_query(decoded, handle, f"{root}/checkpoints/fan_out", "fan_out", available_now)


def updated_windows(batch: DataFrame, batch_id: int, folder: str, delay: int, size: int, slide: int) -> DataFrame:
    """The windows that a batch of one metric's rows changes, each with its mean over all rows so far.

    What Spark's state does in update mode for ``metric_windows``: rows not younger than the watermark that the batches
    before left are dropped, a row counts once by (id, timestamp), and every window a new row lies in is given out. But
    the state is one sum per host and slide, not one per window, it lies in ``folder`` as a table, and only what is
    younger than the watermark, or shares a window with rows that are, goes on to the next batch.
    """
    spark = batch.sparkSession
    before = newest_times(spark, f"{folder}/times", batch_id)
    newest = batch.agg(epoch_seconds(F.max("timestamp"))).first()[0]
    rows = batch.select("id", "hostname", "timestamp", F.col("value").cast("double").alias("value"))
    if NEWEST in before:
        rows = rows.filter(epoch_seconds("timestamp") > before[NEWEST] - delay)
    seen = read_carried(spark, f"{folder}/seen", batch_id, SEEN)
    fresh = sized_join(w.dedup_stream(rows, ["id"], "timestamp"), seen, SEEN.names, "left_anti", null_safe=True)
    sums = w.tile_sums(fresh, ["hostname"], "timestamp", "value", slide).withColumn("fresh", F.lit(True))
    held = read_carried(spark, f"{folder}/tiles", batch_id, TILES).withColumn("fresh", F.lit(False))
    both = sums.unionByName(held).groupBy("hostname", "tile")
    tiles = materialize(both.agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("fresh").alias("fresh")), "tiles")
    after = record_times(spark, f"{folder}/times", batch_id, before, {NEWEST: newest})
    if after:
        watermark = after[NEWEST] - delay
        # a row to come is younger than the watermark, and its windows begin less than their size before it
        write_carried(tiles.filter(F.col("tile") > watermark - size).select(*TILES.names), f"{folder}/tiles", batch_id)
        young = rows.select(*SEEN.names).unionByName(seen).filter(epoch_seconds("timestamp") > watermark)
        write_carried(young.distinct(), f"{folder}/seen", batch_id)
    return w.tile_means(tiles, ["hostname"], size, slide, w.window_parts(tiles, size, slide), "fresh")


def window_query(spark: SparkSession, root: str, metric: str, server: Table, threshold: Table, delay: int = 60,
                 available_now: bool = False, final: bool = False, offer: bool = False, size: int = w.WINDOW_SECONDS,
                 slide: int = w.SLIDE_SECONDS) -> StreamingQuery:
    """Rate the windows of one metric from what ``fan_out`` has set out for it.

    A batch of the fan-out that ran again sets its rows out again; the removal of duplicates takes them out.
    The watermark here never passes that of the fan-out, so nothing is dropped that is not in ``late``. States go to
    ``server_state_<metric>``, and with ``offer`` also to ``health_input`` for ``health_query``. Windows are those of
    ``updated_windows``, whose state is under ``window_state/<metric>``; with ``final``, or where the slide does not divide
    the size, they are kept by Spark.
    """
    folder = f"{root}/window_input/{metric}"
    rows = spark.readStream.schema(schemas.METRIC).option("recursiveFileLookup", "true").parquet(folder)
    states = upsert_sink(f"{root}/server_state_{metric}", STATE_SINK_COLUMNS, state_keys())
    unknown = upsert_sink(f"{root}/quarantine_{metric}_unknown", UNKNOWN_COLUMNS, UNKNOWN_COLUMNS)

    def rate(windows: DataFrame, batch_id: int) -> None:
        thresholds = metric_thresholds(now(server), now(threshold), metric)
        rated = materialize(w.evaluate_metric(windows, thresholds, metric), "rated")
        known = w.known_states(rated)
        states(known, batch_id)
        if offer:
            offer_states(known, root, metric, batch_id)
        unknown(w.unknown_hosts(rated), batch_id)

    def update(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            rate(updated_windows(batch, batch_id, f"{root}/window_state/{metric}", delay, size, slide), batch_id)

    name = f"windows_{metric}"
    checkpoint = f"{root}/checkpoints/{name}"
    if final or size % slide:
        windows = metric_windows(rows, f"{delay} seconds", final=final, size=size, slide=slide)
        return start_query(windows, rate, checkpoint, name, available_now, mode="append" if final else "update")
    return start_query(rows, update, checkpoint, name, available_now)


def offer_states(states: DataFrame, root: str, source: str, batch_id: int) -> None:
    """Set a batch of one source's states out for ``health_query``, numbered by batch."""
    numbered = states.select("server_id", F.timestamp_seconds("timestamp").alias("timestamp"), "src_type", "severity",
                             F.lit(batch_id).cast("long").alias("seq"))
    numbered.write.mode("overwrite").parquet(f"{root}/health_input/{source}-{batch_id}")


HEALTH_INPUT = schemas.struct(server_id=schemas.LONG, timestamp=schemas.TS, src_type=schemas.STR, severity=schemas.INT, seq=schemas.LONG)
# states that one task groups by server and tick, in a table of as many entries as they may be
STATES_PER_TASK = 500_000
# what health carries: the last rating of each source in the ticks that a state to come can still belong to
RATINGS = schemas.struct(server_id=schemas.LONG, timestamp=schemas.LONG, src_type=schemas.STR, severity=schemas.INT, seq=schemas.LONG)


def updated_health(batch: DataFrame, batch_id: int, folder: str, sources: list[str], delay: int, step: int) -> DataFrame:
    """Overall health of the servers and ticks that a batch of states changes, from the last rating of each source so far.

    States of ticks that the watermark of the batches before has passed are dropped. Ratings of the others go on to the
    next batch as a table in ``folder``; a watermark behind the newest state leaves few of them, however long the batch.
    """
    spark = batch.sparkSession
    before = newest_times(spark, f"{folder}/times", batch_id)
    newest, count = batch.agg(epoch_seconds(F.max("timestamp")), F.count("timestamp")).first()
    # a state on the grid belongs to its own tick, any other to the next
    rows = batch.filter("timestamp IS NOT NULL").withColumn("timestamp", ceil_tick("timestamp", step)).select(*RATINGS.names)
    if NEWEST in before:
        rows = rows.filter(F.col("timestamp") >= before[NEWEST] - delay)
    held = read_carried(spark, f"{folder}/ratings", batch_id, RATINGS)
    after = record_times(spark, f"{folder}/times", batch_id, before, {NEWEST: newest})
    if after:
        young = rows.unionByName(held).filter(F.col("timestamp") >= after[NEWEST] - delay)
        last = young.groupBy("server_id", "timestamp", "src_type").agg(F.max_by("severity", "seq").alias("severity"), F.max("seq").alias("seq"))
        write_carried(last.select(*RATINGS.names), f"{folder}/ratings", batch_id)
    both = rows.withColumn("fresh", F.lit(True)).unionByName(held.withColumn("fresh", F.lit(False)))
    # dealt out before they are grouped: few states are equal in server and tick, so grouping in place first would hold them all
    parts = task_parts(spark, count, STATES_PER_TASK)
    last = [F.max_by("severity", F.when(F.col("src_type") == s, F.col("seq"))).alias(f"of_{i}") for i, s in enumerate(sources)]
    ticks = both.repartition(parts, *HEALTH_KEYS).groupBy(*HEALTH_KEYS).agg(F.max("fresh").alias("fresh"), *last).filter("fresh")
    severity = F.greatest(*[F.col(f"of_{i}") for i in range(len(sources))], F.lit(0))
    return ticks.select(*HEALTH_KEYS, severity.cast("int").alias("severity"))


def health_query(spark: SparkSession, root: str, sources: list[str], delay: int = 600, step: int = w.SLIDE_SECONDS,
                 available_now: bool = False) -> StreamingQuery:
    """Overall health of each server, live: the highest of its sources' last severities, per tick of the common grid.

    Metric windows are rated again while rows come in, so of each source the last rating counts, not the highest. A
    tick's state is kept until the watermark, ``delay`` seconds behind the newest state, has passed it; see
    ``updated_health``. It lies under ``health_state``.
    """
    rows = spark.readStream.schema(HEALTH_INPUT).option("recursiveFileLookup", "true").parquet(f"{root}/health_input")
    sink = upsert_sink(f"{root}/server_health", HEALTH.names, HEALTH_KEYS, costly=True)

    def update(batch: DataFrame, batch_id: int) -> None:
        sink(updated_health(batch, batch_id, f"{root}/health_state", sources, delay, step), batch_id)

    return start_query(rows, update, f"{root}/checkpoints/health", "health", available_now)


def read_health(spark: SparkSession, root: str) -> DataFrame:
    return read_upserts(spark, f"{root}/server_health", HEALTH, HEALTH_KEYS, few=True)
