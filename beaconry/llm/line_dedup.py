"""Lines that many documents share are dropped from all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import BLANKS, fold_case, packed, quoted, unpacked, wide_hash
from beaconry.session import materialize


def lines_of(text: Column) -> Column:
    """The lines between line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return fold_case(F.btrim(line, F.lit(BLANKS)))


def _without(lines: Column, dropped: Column) -> Column:
    """The lines but those at the sorted positions: slices between them, so the work is linear."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
    ends = F.concat(dropped, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a)))


def dedup_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Drop every line whose normalised form occurs in at least ``min_docs`` documents.

    The key of a line is the line without surrounding white space and with A-Z lower-cased; keys of fewer than
    ``min_chars`` code points are never dropped. A document is a row, so repeated rows count each.

    Returns all input columns with ``text`` replaced, plus ``n_lines`` (before dropping) and ``n_dropped``, which
    take the place of input columns of those names. A null or empty text counts as one empty line and comes out
    empty, as does a text that loses all its lines; an empty table gives an empty table.

    Only hashes are exploded and counted; what goes through the count is partially aggregated, so a line that
    every document has is one row per task. The work on a text is linear in its lines. Texts are shuffled once, to meet the positions of their dropped lines.
    Documents are identified by the 128-bit hash of their text: equal texts lose equal lines, and the result is
    the same whichever task is run again.
    """
    def digest(line: Column) -> Column:
        key = line_key(line)
        a, b = wide_hash(key)
        return F.when(F.length(key) >= min_chars, F.struct(a.alias("a"), b.alias("b")))

    body = F.coalesce(quoted(text), F.lit(""))
    k1, k2 = wide_hash(body)
    keyed = materialize(
        docs.select(k1.alias("k1"), k2.alias("k2"), F.transform(lines_of(body), digest).alias("keys")), "line-keys")

    # distinct as text: of strings Spark finds the distinct ones by hash, structs it would compare pair by pair
    named = F.array_distinct(F.transform("keys", lambda k: F.concat(k["a"].cast("string"), F.lit(","), k["b"].cast("string"))))
    once = keyed.select(F.explode(named).alias("key")).filter("key IS NOT NULL").select(*[
        F.substring_index("key", ",", side).cast("long").alias(name) for name, side in (("a", 1), ("b", -1))])
    counted = once.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    common = materialize(counted.filter(F.col("n") >= min_docs).select("a", "b"), "line-common")

    placed = keyed.select("k1", "k2", F.posexplode("keys").alias("pos", "key")).select("k1", "k2", "pos", "key.a", "key.b")
    dropped = (placed.join(common, ["a", "b"]).groupBy("k1", "k2")
               .agg(F.array_sort(F.collect_set("pos")).alias("dropped")))
    # written, so that the join below reads both sides from tables and Spark can split a group of equal texts
    dropped = materialize(dropped, "line-dropped")

    rows = packed(docs, k1=k1, k2=k2).join(dropped, ["k1", "k2"], "left")
    lines = lines_of(F.col("row")[text])
    kept = F.when(F.col("dropped").isNull(), F.coalesce(F.col("row")[text], F.lit(""))).otherwise(
        F.array_join(_without(lines, F.col("dropped")), "\n"))
    return unpacked(rows, docs.columns, {text: kept}, {
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.when(F.col("dropped").isNull(), F.lit(0)).otherwise(F.size("dropped")).cast("long"),
    })
