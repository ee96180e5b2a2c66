"""Allow and block rules on URLs, matched by a sort-merge range join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import fold_case, packed, quoted, unpacked
from beaconry.session import materialize


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as written; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = fold_case(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels in reverse, each closed by a dot: a host and its subdomains are the keys with its key as prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _bounds(prefix: Column) -> tuple[Column, Column]:
    """The interval of byte strings that begin with a prefix; no UTF-8 text holds the byte FF."""
    low = F.encode(prefix, "UTF-8")
    return low, F.concat(low, F.unhex(F.lit("FF")))


def _swept(points: DataFrame, events: DataFrame) -> DataFrame:
    """For each point the ``mark`` of the last event at or before it in the order of ``(space, at)``.

    Points have ``space, at, point``; events have ``space, at, mark``. Both are range-sorted together, so a host
    with a third of all URLs is spread over many ranges, and each range takes over what was open at its start.
    """
    none = F.lit(None)
    kind = dict(points.dtypes)["point"]
    mark = dict(events.dtypes)["mark"]
    both = events.select("space", "at", F.lit(0).alias("later"), none.cast(kind).alias("point"), "mark").unionByName(
        points.select("space", "at", F.lit(1).alias("later"), "point", none.cast(mark).alias("mark")))
    order = ["space", "at", "later", F.xxhash64("point")]
    parts = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(
        both.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "url-ranges")
    # one row per range
    last = ranged.groupBy("part").agg(F.max(F.when(F.col("later") == 0, F.struct("space", "at", "mark"))).alias("last"))
    carried = last.select("part", F.last("last.mark", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    upto = Window.partitionBy("part").orderBy("space", "at", "later").rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.join(F.broadcast(carried), "part")
            .withColumn("mark", F.coalesce(F.last("mark", ignorenulls=True).over(upto), "carried"))
            .filter("later = 1").select("point", "mark"))


def _host_events(rules: DataFrame) -> DataFrame:
    """Where a rule host's interval opens and closes, with the stack of hosts that are open from there on."""
    hosts = rules.select("host").distinct()
    labels = F.split("host", r"\.", -1)
    above = hosts.select(
        F.col("host").alias("of"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)),
                              lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))).alias("host"))
    stacks = above.join(hosts, "host").groupBy("of").agg(F.collect_set("host").alias("stack"))
    low, high = _bounds(host_key(F.col("of")))
    outer = F.array_remove("stack", F.col("of"))
    return stacks.select(F.lit("").alias("space"), F.explode(F.array(
        F.struct(low.alias("at"), F.col("stack").alias("mark")), F.struct(high.alias("at"), outer.alias("mark"))))
        .alias("e")).select("space", "e.*")


def _path_events(rules: DataFrame) -> DataFrame:
    """The same for the paths of one host, with the longest open rule; what it encloses is shorter."""
    best = rules.groupBy("host", "path").agg(F.max("action").alias("action"))
    own = F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
        F.concat("host", "path").alias("rule"), F.col("action").alias("action"))
    best = best.withColumn("own", own)
    above = best.filter(F.length("path") > 0).select("host", F.col("path").alias("of"), F.explode(F.transform(
        F.sequence(F.lit(0), F.length("path") - 1), lambda n: F.substring(F.col("path"), F.lit(1), n))).alias("path"))
    outer = (above.join(best, ["host", "path"]).groupBy("host", "of").agg(F.max("own").alias("outer"))
             .withColumnRenamed("of", "path"))
    low, high = _bounds(F.col("path"))
    # a mark is never null, so that a closing event ends what was open
    return best.join(outer, ["host", "path"], "left").select(F.col("host").alias("space"), F.explode(F.array(
        F.struct(low.alias("at"), F.struct(F.col("own").alias("best")).alias("mark")),
        F.struct(high.alias("at"), F.struct(F.col("outer").alias("best")).alias("mark")))).alias("e")).select("space", "e.*")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Judge URLs by the longest rule that fits.

    ``rules`` has ``host, path, action`` (``allow`` or ``block``). A rule fits URLs on its host and all subdomains
    whose path begins with the rule's. The longest wins: by characters of host and path together, then the longer
    host; a rule given twice blocks if one of the two does.

    Returns the input's columns plus ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``, which take the
    place of input columns of those names. A URL that is null or has no ``://`` has an empty host and path and gets
    ``default``; repeated rows are judged alike; rules with a null part fit nothing; an empty table stays empty.

    Two sweeps, both over range-sorted rows: the first runs over reversed-host keys and keeps the stack of rule
    hosts open at each URL, the second over the paths below each open host. Only distinct URLs are swept; the rows
    meet the verdict of their URL in a join that Spark can split.
    """
    rules = rules.select("host", "path", "action").dropna().withColumn("host", fold_case(F.col("host")))
    urls = pages.select(quoted(url).alias("url")).dropna().distinct()
    host, path = url_parts(F.col("url"))
    points = urls.select("url", host.alias("host"), path.alias("path")).select(
        F.lit("").alias("space"), F.encode(F.concat(host_key(F.col("host")), "path"), "UTF-8").alias("at"),
        F.struct("url", "host", "path").alias("point"))
    opened = materialize(_swept(points, _host_events(rules)).select("point.*", F.coalesce(
        "mark", F.array().cast("array<string>")).alias("stack")), "url-hosts")
    below = opened.select(F.explode("stack").alias("space"), F.encode("path", "UTF-8").alias("at"),
                          F.struct("url").alias("point"))
    found = (_swept(below, _path_events(rules)).filter("mark.best IS NOT NULL")
             .groupBy("point.url").agg(F.max("mark.best").alias("best")))
    # written, so that Spark can split the rows of a URL that a large part of the table has
    judged = materialize(opened.join(found, "url", "left").select("url", "host", "path", "best"), "url-verdicts")
    rows = packed(pages, url=quoted(url)).join(judged, "url", "left")
    return unpacked(rows, pages.columns, {}, {
        "host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit("")), "rule": F.col("best.rule"),
        "verdict": F.coalesce("best.action", F.lit(default))})
