"""Secrets in texts, found through a trigram index and verified by regular expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as codes
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import any_of, packed, quoted, unpacked
from beaconry.session import materialize


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched leftmost and without overlap; a match stays if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the three base kinds, in the order in which spans of equal start are listed
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # runs of 16 and more; shorter ones would be matched by "+" only to be dropped for their length
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# fixed values: well-known public token formats, searched beside the base kinds
EXTRA_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + EXTRA_RULES

# A Boolean query is True (no condition), or ("and", {trigrams}, [queries]) or ("or", [queries]).
_MANY = 64


def _trigrams_of(strings: set[str]):
    """What holds for a text that contains one of the strings."""
    if any(len(s) < 3 for s in strings):
        return True
    return ("or", [("and", {s[i:i + 3] for i in range(len(s) - 2)}, []) for s in sorted(strings)])


def _exact(node) -> set[str] | None:
    """The strings a part of a pattern can match, in lower case, if they are few."""
    op, arg = node
    if op is codes.LITERAL:
        return {chr(arg).lower()}
    if op is codes.IN and all(kind is codes.LITERAL for kind, _ in arg) and len(arg) <= 8:
        return {chr(c).lower() for _, c in arg}
    if op is codes.SUBPATTERN:
        return _product(arg[3])
    if op is codes.BRANCH:
        sets = [_product(branch) for branch in arg[1]]
        found = None if None in sets else set().union(*sets)
        return found if found is None or len(found) <= _MANY else None
    if op in (codes.MAX_REPEAT, codes.MIN_REPEAT) and arg[1] is not codes.MAXREPEAT and arg[1] <= 8:
        inner = _product(arg[2])
        sets = None if inner is None else {
            "".join(p) for n in range(arg[0], arg[1] + 1) for p in product(sorted(inner), repeat=n)}
        return sets if sets is not None and len(sets) <= _MANY else None
    return None


def _product(nodes) -> set[str] | None:
    strings = {""}
    for node in nodes:
        own = _exact(node)
        if own is None or len(strings) * len(own) > _MANY:
            return None
        strings = {a + b for a in strings for b in own}
    return strings


def _mandatory(nodes):
    """The conjunction of what the parts of a sequence demand; runs of exact parts are joined first."""
    demands, run = [], {""}
    for node in nodes:
        own = _exact(node)
        if own is not None and len(run) * len(own) <= _MANY:
            run = {a + b for a in run for b in own}
            continue
        demands.append(_trigrams_of(run))
        run = {""} if own is None else own
        op, arg = node
        if own is None and op is codes.SUBPATTERN:
            demands.append(_mandatory(arg[3]))
        elif own is None and op is codes.BRANCH:
            branches = [_mandatory(b) for b in arg[1]]
            demands.append(True if True in branches else ("or", branches))
        elif own is None and op in (codes.MAX_REPEAT, codes.MIN_REPEAT) and arg[0] >= 1:
            demands.append(_mandatory(arg[2]))
    demands = [d for d in [*demands, _trigrams_of(run)] if d is not True]
    return ("and", set(), demands) if demands else True


def trigram_query(pattern: str):
    """The Boolean trigram query that the lower-cased text of every match satisfies; True if there is none."""
    return _mandatory(parser.parse(pattern))


def trigrams_in(query) -> set[str]:
    if query is True:
        return set()
    inner = query[1] if query[0] == "or" else query[2]
    return set().union(query[1] if query[0] == "and" else (), *map(trigrams_in, inner))


def _candidates(query, posting: dict[str, Column]) -> Column:
    """Intersections and unions of posting lists, as the query asks."""
    if query[0] == "or":
        return reduce(F.array_union, [_candidates(q, posting) for q in query[1]])
    return reduce(F.array_intersect, [posting[t] for t in sorted(query[1])] + [_candidates(q, posting) for q in query[2]])


#: matches whose positions are added up together; blocks of them are added up in turn
SPAN_BLOCK = 256


def _bound(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once, however often it occurs there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """The verified spans of one rule: between the pieces that the pattern splits off lie the matches.

    Positions are added up within blocks of matches, then over the blocks, as adding to an array copies it.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    sizes = F.zip_with(
        F.zip_with(F.split(text, rule.pattern, -1), whole, lambda p, w: F.struct(
            F.length(p).alias("gap"), F.length(w).alias("size"))),
        tested, lambda s, t: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), F.length(t).alias("tested")))
    one = "struct<start:int,rank:int,stop:int,kind:string>"
    none = F.from_json(F.lit("[]"), f"array<{one}>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        stop = start + F.coalesce(x["size"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("rank"), stop.alias("stop"), F.lit(rule.kind).alias("kind"))
        passes = F.coalesce(x["tested"] >= rule.least, F.lit(False))
        return F.struct(stop.alias("at"), F.when(passes, F.concat(state["found"], F.array(span))).otherwise(state["found"])
                        .alias("found"))

    def blocks(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / SPAN_BLOCK).cast("int")), lambda n: F.aggregate(
            F.slice(s, n * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)), F.struct(F.lit(0).alias("at"), none.alias("found")), step))

    def begins(b: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))
        return F.aggregate(b, first, lambda state, x: F.struct(
            (state["at"] + x["at"]).alias("at"), F.concat(state["begins"], F.array(state["at"])).alias("begins")), lambda s: s["begins"])

    def moved(block: Column, at: Column) -> Column:
        return F.transform(block["found"], lambda x: F.struct(
            (x["start"] + at).alias("start"), x["rank"].alias("rank"), (x["stop"] + at).alias("stop"), x["kind"].alias("kind")))

    found = _bound(_bound(sizes, blocks), lambda b: F.flatten(F.zip_with(b, begins(b), moved)))
    return F.when(F.size(whole) > 0, found).otherwise(none)


def trigram_candidates(docs: DataFrame, text: str, rules: tuple[Rule, ...], block_rows: int = 8192) -> DataFrame:
    """Rows ``(k, rules)``: for the hash of a text, the numbers of the indexed rules whose query it satisfies.

    The index covers the trigrams that the queries name. A posting list is cut into blocks of about ``block_rows``
    texts (by hash, so however many texts have a trigram, no list grows beyond its block), and the lists of one
    block are intersected and united together.
    """
    queries = {n: q for n, q in enumerate(trigram_query(r.pattern) for r in rules) if q is not True}
    terms = sorted(set().union(*map(trigrams_in, queries.values())))
    low = F.lower(F.coalesce(quoted(text), F.lit("")))
    held = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(n)) for n, t in enumerate(terms)]))
    blocks = max(1, -(-docs.count() // block_rows))
    k = F.xxhash64(F.coalesce(quoted(text), F.lit("")))
    postings = (docs.select(k.alias("k"), F.explode(held).alias("term")).distinct()
                .withColumn("block", F.pmod(F.xxhash64("k"), F.lit(blocks)))
                .groupBy("block", "term").agg(F.collect_list("k").alias("texts")))
    none = F.array().cast("array<bigint>")
    by_block = postings.groupBy("block").agg(*[
        F.coalesce(F.first(F.when(F.col("term") == n, F.col("texts")), ignorenulls=True), none).alias(f"t{n}")
        for n in range(len(terms))])
    posting = {t: F.col(f"t{n}") for n, t in enumerate(terms)}

    def hits(rule: int) -> Column:
        return F.transform(_candidates(queries[rule], posting), lambda k: F.struct(k.alias("k"), F.lit(rule).alias("rule")))

    found = by_block.select(F.inline(F.flatten(F.array(*map(hits, queries)))))
    return found.groupBy("k").agg(F.collect_set("rule").alias("rules"))


def scan_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, block_rows: int = 8192) -> DataFrame:
    """Add ``spans``, an array of ``(start, rank, stop, kind)`` sorted by start and then by the order of the rules.

    Positions count code points; ``stop`` is exclusive. Rules whose pattern has mandatory trigrams are verified on
    the candidates of the index only, the others on every text. Only built-in functions are used.

    Returns all input columns, with ``spans`` in place of an input column of that name. A null or empty text has no
    spans; repeated rows are judged alike; a text of megabytes takes time in proportion to its matches; an empty table
    gives an empty table.
    """
    indexed = {n for n, r in enumerate(rules) if trigram_query(r.pattern) is not True}
    # written, so that Spark can broadcast it if it is small and split groups of equal texts if not
    candidates = materialize(trigram_candidates(docs, text, rules, block_rows), "secret-candidates")
    rows = packed(docs, k=F.xxhash64(F.coalesce(quoted(text), F.lit("")))).join(candidates, "k", "left")
    body = F.coalesce(F.col("row")[text], F.lit(""))
    none = F.from_json(F.lit("[]"), "array<struct<start:int,rank:int,stop:int,kind:string>>")
    found = [F.when(F.array_contains("rules", n), _spans(body, r, n)).otherwise(none) if n in indexed
             else _spans(body, r, n) for n, r in enumerate(rules)]
    return unpacked(rows, docs.columns, {}, {"spans": F.array_sort(F.concat(*found))})


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: any_of([s["kind"] == k for k in kinds]))
