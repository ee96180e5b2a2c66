"""Event time, duplicates, sliding windows and their ratings, on streams and on tables alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beaconry.functions.rating import severity
from beaconry.functions.times import align_tick
from beaconry.operators.joins import enrich_server
from beaconry.operators.skew import fits_broadcast, part_of, sized_join, task_parts

# fixed values: delays and window shape
METRIC_WATERMARK, ALERT_WATERMARK = "60 seconds", "86400 seconds"
WINDOW_SECONDS, SLIDE_SECONDS = 60, 5
# windows of a table that one task meets, counted as if no two rows of it shared one
WINDOWS_PER_TASK = 2_000_000
STATE_COLUMNS = ("server_id", "timestamp", "src_type", "severity")


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withWatermark(ts, delay)


def dedup_stream(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """One row per (keys, event time); on a watermarked stream old keys leave the state."""
    return df.dropDuplicates([*keys, ts])


def sliding_mean(df: DataFrame, host: str = "hostname", ts: str = "timestamp", value: str = "value",
                 size: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS, by: Sequence[str] = (),
                 final: bool = False, parts: int | None = None) -> DataFrame:
    """Mean per host (and further columns ``by``) and sliding window, labelled with the window end in epoch seconds.

    A stream allows one aggregation in update mode, so there each row is expanded by
    Spark's window function. ``final`` is for append mode, where a window is given out once, when the watermark has passed
    its end: see ``_final_mean``. A table takes the cheaper way of ``_tiled_mean``, in ``parts`` parts (``window_parts``).
    """
    if not df.isStreaming:
        return _tiled_mean(df, [host, *by], ts, value, size, slide, parts)
    if final:
        return _final_mean(df, [host, *by], ts, value, size, slide)
    end = F.unix_timestamp("window.end").cast("bigint")
    return (
        df.groupBy(host, *by, F.window(ts, f"{size} seconds", f"{slide} seconds").alias("window"))
        .agg(F.avg(value).alias("avg"))
        .select(host, *by, end.alias("timestamp"), "avg")
    )


def _final_mean(df: DataFrame, keys: Sequence[str], ts: str, value: str, size: int, slide: int) -> DataFrame:
    """Sliding means of a stream from one (sum, count) per slide, by two chained aggregations.

    The first keeps a sum and a count per slide, so a row touches one state entry; only its finished tiles, of which a
    host has one per slide however many rows it sends, are expanded to the windows they lie in.
    """
    if size % slide:
        raise ValueError("the window size must be a multiple of the slide")
    tiles = df.groupBy(*keys, F.window(ts, f"{slide} seconds").alias("tile")).agg(
        F.sum(value).alias("total"), F.count(value).alias("n"))
    windows = tiles.groupBy(*keys, F.window("tile", f"{size} seconds", f"{slide} seconds").alias("window"))
    means = windows.agg((F.sum("total") / F.sum("n")).alias("avg"))
    return means.select(*keys, F.unix_timestamp("window.end").cast("bigint").alias("timestamp"), "avg")


def window_parts(df: DataFrame, size: int, slide: int) -> int:
    """Into how many parts the windows of a table's rows are dealt, so that a task meets a bounded number of them.

    A row lies in size/slide windows; the rows are counted, for a Parquet table from its footers.
    """
    return task_parts(df.sparkSession, df.count() * (size // slide), WINDOWS_PER_TASK)


def tile_sums(df: DataFrame, keys: Sequence[str], ts: str, value: str, slide: int) -> DataFrame:
    """One (sum, count) per key and slide; ``tile`` is the start of the slide in epoch seconds."""
    epoch = F.unix_timestamp(ts)
    tile = epoch - F.pmod(epoch, F.lit(slide))
    return df.groupBy(*keys, tile.alias("tile")).agg(F.sum(value).alias("total"), F.count(value).alias("n"))


def _tiled_mean(df: DataFrame, keys: Sequence[str], ts: str, value: str, size: int, slide: int,
                parts: int | None = None) -> DataFrame:
    """Sliding means from one (sum, count) per slide instead of from repeated rows."""
    if size % slide:
        raise ValueError("the window size must be a multiple of the slide")
    return tile_means(tile_sums(df, keys, ts, value, slide), keys, size, slide, parts or window_parts(df, size, slide))


def tile_means(tiles: DataFrame, keys: Sequence[str], size: int, slide: int, parts: int, only: str | None = None) -> DataFrame:
    """Sliding means of ``tile_sums``, which have one row per key and tile.

    A tile counts in size/slide windows, but is not shuffled once for each: it is sent to
    the one or two blocks of time its windows end in. Blocks also split a host with very many rows over several tasks.
    In a block the tiles are sorted, and each gives out the windows it is the last tile of, from itself and those up to
    size - slide before it. So no table of windows is held, and a task sorts a bounded number of tiles.
    With ``only``, a Boolean column of the tiles, windows without a tile where it is true are left out.
    """
    span = size * 10
    fields = ["tile", "total", "n", *([only] if only else [])]
    kind = tiles.schema["total"].dataType
    first, last = F.col("tile") + slide, F.col("tile") + size
    blocks = F.explode(F.sequence(F.floor(first / span), F.floor(last / span)))
    low, high = F.col("block") * span, (F.col("block") + 1) * span - slide
    sorted_tiles = W.partitionBy(*keys, "block").orderBy("tile")
    # a window ends with this tile if it is over before the next one
    begin, end = F.greatest(first, low), F.least(last, high, F.lead("tile").over(sorted_tiles))
    held = F.collect_list(F.struct(*fields)).over(sorted_tiles.rangeBetween(slide - size, 0))
    ends = F.explode(F.when(F.col("begin") <= F.col("end"), F.sequence("begin", "end", F.lit(slide).cast("bigint"))))
    inside = F.filter("held", lambda t: t["tile"] >= F.col("timestamp") - size)
    summed = F.aggregate(
        inside, F.struct(F.lit(0).cast(kind).alias("total"), F.lit(0).cast("bigint").alias("n")),
        lambda a, t: F.struct((a["total"] + F.coalesce(t["total"], F.lit(0).cast(kind))).cast(kind).alias("total"),
                              (a["n"] + t["n"]).alias("n")),
        lambda a: F.when(a["n"] > 0, a["total"] / a["n"]))
    windows = (
        tiles.withColumn("block", blocks)
        .repartition(parts, *keys, "block")
        .select(*keys, begin.alias("begin"), end.alias("end"), held.alias("held"))
        .select(*keys, "held", ends.alias("timestamp"))
    )
    if only:
        windows = windows.filter(F.exists("held", lambda t: t[only] & (t["tile"] >= F.col("timestamp") - size)))
    return windows.select(*keys, "timestamp", summed.alias("avg"))


def evaluate_metric(windows: DataFrame, servers: DataFrame, metric: str, limit: int | None = None) -> DataFrame:
    """Rate each window against its host's thresholds.

    ``servers`` has one row per host (see ``metric_thresholds``). A window of an unknown
    host, or of one without thresholds, has no severity; see ``known_states``.
    """
    rated = enrich_server(windows, servers, ("server_id", "amber_threshold", "red_threshold"), limit=limit)
    return rated.select(
        "hostname", "server_id", "timestamp", F.lit(metric).alias("src_type"),
        severity("avg", "amber_threshold", "red_threshold").alias("severity"),
    )


def evaluate_metrics(windows: DataFrame, thresholds: DataFrame, limit: int | None = None, parts: int | None = None) -> DataFrame:
    """Rate the windows of all metrics at once: ``windows`` by host and ``name``, ``thresholds`` from ``all_thresholds``.

    Where the thresholds are too large to broadcast, both are dealt into ``parts`` parts, if given.
    """
    keys = ["hostname", "name"]
    side = part_of(thresholds.select(
        "hostname", F.col("metric_name").alias("name"), "server_id", "amber_threshold", "red_threshold"), thresholds)
    if parts and not fits_broadcast(side, limit):
        # a host and metric have no more windows than there are slides, so no key fills a part
        windows, side = windows.repartition(parts, *keys), part_of(side.repartition(parts, *keys), thresholds)
    rated = sized_join(windows, side, keys, "left", limit=limit)
    return rated.select(
        "hostname", "server_id", "timestamp", F.col("name").alias("src_type"),
        severity("avg", "amber_threshold", "red_threshold").alias("severity"))


def known_states(rated: DataFrame) -> DataFrame:
    return rated.filter(F.col("severity").isNotNull()).select(*STATE_COLUMNS)


def unknown_hosts(rated: DataFrame) -> DataFrame:
    return rated.filter(F.col("severity").isNull()).select("hostname", "timestamp", "src_type")


def server_health(states: DataFrame, step: int = SLIDE_SECONDS, parts: int | None = None) -> DataFrame:
    """Highest severity of a server over all its sources, per tick of the common grid.

    With ``parts`` the states are dealt into so many parts before they are grouped. Otherwise every task groups what it
    has beforehand, in a table that grows with its share of the states, as few of them are equal in server and tick.
    """
    ticks = states.select("server_id", align_tick("timestamp", step, strict=False).alias("timestamp"), "severity")
    if parts:
        ticks = ticks.repartition(parts, "server_id", "timestamp")
    return ticks.groupBy("server_id", "timestamp").agg(F.max("severity").alias("severity"))


def late_rows(arriving: DataFrame, seen: DataFrame, ts: str, delay: str) -> DataFrame:
    """Arriving rows that are older than the newest event time already seen minus the delay."""
    watermark: Column = seen.agg((F.max(ts) - F.expr(f"INTERVAL {delay}")).alias("w")).scalar()
    return arriving.filter(F.col(ts) < watermark)


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows a running query has dropped as late so far."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
