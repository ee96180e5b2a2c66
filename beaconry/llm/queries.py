"""The corpus operators as queries over the test tables, with the statements that check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.llm.collocations import mine_collocations
from beaconry.llm.common import read_table
from beaconry.llm.decontaminate import find_leaks
from beaconry.llm.language_id import fit_languages, predict_languages
from beaconry.llm.line_dedup import dedup_lines
from beaconry.llm.piece_sampling import load_pieces, sample_pieces
from beaconry.llm.quality_rules import judge_quality, load_vocabularies
from beaconry.llm.secrets import BASE_RULES, EXTRA_RULES, RULES, listed, of_kinds, scan_secrets
from beaconry.llm.simhash import near_duplicates
from beaconry.llm.substring_dedup import dedup_substrings
from beaconry.llm.topk_search import search_rows
from beaconry.llm.url_filter import filter_urls
from beaconry.llm.vector_codes import ROUNDS, compress_vectors
from beaconry.llm.warc import read_warc, write_warc
from beaconry.session import fresh_path, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str, sql: str | None = None):
    def register(build: Callable[[DataFrame, SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(read_table(tune(spark), folder, table), spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return build

    return register


# what the oracles share: white space at both ends of a line, and A-Z in lower case
STRIPPED = r"regexp_replace({0}, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
FOLDED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query("op2_url_filter", "pages", f"""
    WITH rules AS (SELECT * FROM (VALUES {', '.join(map(str, URL_RULES))}) AS t(h, p, action)),
    rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
             FROM pages),
    parts AS (SELECT row_number() OVER () AS n, page_id, {FOLDED.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    fits AS (SELECT n, max({{'size': length(h) + length(p), 'h': length(h), 'rule': h || p, 'action': action}}) AS best
             FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
    SELECT page_id, host, path, best.rule AS rule, coalesce(best.action, 'allow') AS verdict
    FROM parts LEFT JOIN fits USING (n)""")
def op2(pages, spark, folder):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    judged = filter_urls(pages.select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _spans_sql(kind: str, pattern: str, tested: str = "m") -> str:
    """Spans of one kind: lengths of pieces and matches, added up."""
    return f"""
    SELECT n, '{kind}' AS kind, unnest(range(len(m))) AS i, p, m, t FROM (
        SELECT n, string_split_regex(body, '{pattern}') AS p, regexp_extract_all(body, '{pattern}') AS m,
               {tested} AS t FROM texts)"""


_ASSIGN = ("(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in
                          ("password", "passwd", "secret", "token", "api_?key"))
           + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")


_LISTED = """string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + size AS BIGINT), ','
                                 ORDER BY s, list_position([{0}], kind))""".format(", ".join(f"'{r.kind}'" for r in RULES))


@query("op5_secret_scan", "documents", f"""
    WITH texts AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS body FROM documents),
    found AS ({_spans_sql("assign", _ASSIGN, f"regexp_extract_all(body, '{_ASSIGN}', 2)")}
      UNION ALL {_spans_sql("access", "AKIA[A-Z0-9]+")}
      UNION ALL {_spans_sql("hex", "[0-9a-f]+")}
      {" ".join("UNION ALL " + _spans_sql(r.kind, r.pattern) for r in EXTRA_RULES)}),
    placed AS (SELECT n, kind, list_sum(list_transform(p[:i + 1], lambda x: length(x)))
                        + coalesce(list_sum(list_transform(m[:i], lambda x: length(x))), 0) AS s, length(m[i + 1]) AS size
               FROM found WHERE length(t[i + 1]) >= CASE kind WHEN 'assign' THEN 12 WHEN 'access' THEN 18 WHEN 'hex' THEN 16
                                                    ELSE 1 END),
    listed AS (SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                      count(*) FILTER (kind = 'hex') AS n_hex, {_LISTED} AS spans,
                      {_LISTED} FILTER (kind IN ('assign', 'access', 'hex')) AS base
               FROM placed GROUP BY n)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN listed USING (n)""")
def op5(docs, spark, folder):
    found = scan_secrets(docs.select("doc_id", "text"))
    base = tuple(r.kind for r in BASE_RULES)
    counts = [F.size(of_kinds(F.col("spans"), (k,))).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(listed(of_kinds(F.col("spans"), base)), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


@query("op7_line_dedup", "documents", f"""
    WITH lines AS (
      SELECT n, doc_id, pos, l[pos] AS line, {FOLDED.format(STRIPPED.format("l[pos]"))} AS key
      FROM (SELECT n, doc_id, l, unnest(range(1, len(l) + 1)) AS pos FROM (
        SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
    common AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT n) >= 10),
    marked AS (SELECT l.*, c.key IS NOT NULL AS dropped FROM lines l LEFT JOIN common c ON l.key = c.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY n, doc_id""")
def op7(docs, spark, folder):
    kept = dedup_lines(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op4_simhash_near_dedup", "documents")
def op4(docs, spark, folder):
    found = near_duplicates(docs.select("doc_id", "text"))
    code = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select(F.col("key").alias("doc_id"), code.alias("fingerprint"), F.col("component").alias("component_id"))


@query("op3_substring_dedup", "documents")
def op3(docs, spark, folder):
    kept = dedup_substrings(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def held_out() -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_model(docs: DataFrame):
    return fit_languages(docs.filter(~held_out()))


@query("op6_language_id", "documents")
def op6(docs, spark, folder):
    named = predict_languages(docs.select("doc_id", "text"), language_model(docs))
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op10_decontaminate", "documents")
def op10(docs, spark, folder):
    found = find_leaks(docs.select("doc_id", "text"), read_table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", F.col("leak.item").alias("item_id"), F.round("leak.score", 6).alias("bm25_share"),
        F.col("leak.question").alias("question_overlap"), F.col("leak.answer").alias("answer_overlap"), "leak.passage")


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query("op9_sentencepiece_sampling", "documents")
def op9(docs, spark, folder):
    sampled = sample_pieces(docs.select("doc_id", "text"), load_pieces(PIECE_MODEL), decoded=True)
    return sampled.select(
        F.col("key").alias("doc_id"), "rank", F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"), F.round("log_prob", 4).alias("log_prob"),
        F.round("log_inclusion", 4).alias("log_inclusion"), F.sha2("decoded", 256).alias("text_sha256"))


@query("op8_top_search", "embeddings", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
               FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(CAST(q.p AS DOUBLE[]), CAST(d.p AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op8(vectors, spark, folder):
    return search_rows(vectors, F.col("vec_id") % 50 == 0)


@query("op1_warc", "pages", """
    WITH p AS (SELECT row_number() OVER (ORDER BY page_id NULLS LAST, url) AS n, page_id,
                      sha1(encode(coalesce(html, ''))) AS h, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
    f AS (SELECT *, min(n) OVER (PARTITION BY h) AS first_n, first(page_id) OVER (PARTITION BY h ORDER BY n) AS first_id FROM p),
    bits AS (SELECT *, list_transform(range(0, 40), lambda i: instr('0123456789abcdef', h[i + 1]) - 1) AS nibbles FROM f)
    SELECT page_id, payload_bytes,
           list_aggregate(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST(
             list_sum(list_transform(range(0, 5), lambda b: (((nibbles[1 + (i * 5 + b) // 4]) >> (3 - (i * 5 + b) % 4)) & 1) << (4 - b)))
             AS INTEGER)]), 'string_agg', '') AS payload_digest,
           CASE WHEN n = first_n THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN n <> first_n THEN first_id END AS refers_to
    FROM bits""")
def op1(pages, spark, folder):
    base = fresh_path(spark, "warc")
    write_warc(pages, base)
    return read_warc(spark, base, payload=False).select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


@query("op11_collocations", "documents", f"""
    WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                           unnest(string_split_regex({FOLDED.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
    grams AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM (
        SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, range(1, 5) AS s(size))),
    f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
    cand AS MATERIALIZED (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2),
    cuts AS (SELECT c.lang, c.phrase, c.k, h.f AS l, t.f AS r,
                    CAST((2000000 * CAST(a AS HUGEINT)) // (CAST(h.f AS HUGEINT) + t.f) AS BIGINT) AS score
             FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) c
             JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[:k], ' ')
             JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[k + 1:], ' ')),
    worst AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts),
    inner_ AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM (
        SELECT lang, w, a, m, unnest(range(1, size - m + 2)) AS i FROM cand, range(2, 4) AS s(m) WHERE m < size) GROUP BY ALL),
    kept AS (SELECT c.lang, c.phrase, c.a, l, r, score FROM cand c JOIN worst w ON w.lang = c.lang AND w.phrase = c.phrase AND place = 1
             LEFT JOIN inner_ i ON i.lang = c.lang AND i.phrase = c.phrase
             WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(c.a AS HUGEINT)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""")
def op11(docs, spark, folder):
    found = mine_collocations(docs.select("doc_id", "lang", "text"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


VOCABULARIES = ("/opt/tokenizers/piece_bpe_32k.model", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


@query("op12_quality_rules", "documents")
def op12(docs, spark, folder):
    judged = judge_quality(docs.select("doc_id", "lang", "text"), load_vocabularies(VOCABULARIES), carry=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _nearest_sql(books: str) -> str:
    """Per row and part the nearest entry (ties to the lower) and its squared distance."""
    return f"""SELECT n, part, v, CAST(best % 16 AS BIGINT) AS e, CAST(best // 16 AS BIGINT) AS d FROM (
        SELECT n, p.part, any_value(p.v) AS v, min(16 * list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
               + b.e) AS best FROM parts p JOIN {books} b USING (part) GROUP BY n, p.part)"""


_ROUNDS_SQL = "".join(f"""
    a{r} AS MATERIALIZED ({_nearest_sql(f"b{r}")}),
    s{r} AS (SELECT part, e, i, sum(x) AS s, count(*) AS c FROM (SELECT part, e, unnest(v) AS x, unnest(range(1, 9)) AS i FROM a{r}) GROUP BY ALL),
    b{r + 1} AS MATERIALIZED (SELECT part, e, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN (
        SELECT part, e, list(CAST((s - ((s % c) + c) % c) // c AS BIGINT) ORDER BY i) AS v FROM s{r} GROUP BY part, e) m USING (part, e)),
""" for r in range(ROUNDS))


@query("op13_vector_codes", "embeddings", f"""
    WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS n, vec_id, label,
                         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS p FROM embeddings
                  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (SELECT n, part, p[part * 8 + 1:part * 8 + 8] AS v FROM kept, range(0, 8) AS t(part)),
    b0 AS MATERIALIZED (SELECT part, n - 1 AS e, v FROM parts WHERE n <= 16), {_ROUNDS_SQL}
    last AS (SELECT n, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
             FROM ({_nearest_sql(f"b{ROUNDS}")}) GROUP BY n),
    hashed AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b{ROUNDS})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM last JOIN kept USING (n), hashed""")
def op13(vectors, spark, folder):
    coded, books = compress_vectors(vectors.select("vec_id", "label", "embedding"))
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return coded.select(F.col("key").alias("vec_id"), F.array_join(digits, "").alias("code"), "error", "label_error",
                        F.lit(books and books.sha256()).cast("string").alias("codebooks_sha256"))
