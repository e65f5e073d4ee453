"""Registered queries of the operators, over the driver's whole tables with production parameters.

``ORACLE_SQL`` has the DuckDB twin where SQL can express the result; the other queries are tested against brute force.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.llm import (byte_bpe, decontaminate, importance, near_dup, pii, quality, secrets_scan, simhash, token_output, toxicity, url_filter, warc,
                          whitening)
from vecframe.llm.common import held_out, read_table
from vecframe.session import scratch_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)  # Python tasks import the package on the workers
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's vocabulary (installed on every machine)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def hex16(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# The rules (host, path) of the url query.
BLOCK_RULES = [("net", "/"), ("example.com", "/de/")]
ALLOW_RULES = [("example.net", "/en/"), ("org", "/fr/")]

OP1_SQL = r"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
     parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
     rules(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
     fits AS (SELECT page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
              FROM parts LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fits
"""


@register("op1_url_filter", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against block and allow rules."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_filter.build(pages, url_filter.rule_table(spark, BLOCK_RULES), url_filter.rule_table(spark, ALLOW_RULES))
    return found.judge(pages).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
     f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND n >= 100
"""


@register("op2_warc", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record for every page, read back: payload digests and revisits."""
    path = scratch_path(spark, "warc")
    pages = read_table(spark, sf_dir, "pages")
    warc.write_archive(pages, path)
    records = warc.read_archive(spark, path)
    field = lambda name: F.regexp_extract("head", f"(?m)^{name}: *([^\r\n]*)", 1)
    page = lambda name: F.regexp_extract(field(name), "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    again = field("WARC-Type") == "revisit"
    kind = pages.schema["page_id"].dataType
    return records.select(
        page("WARC-Record-ID").cast(kind).alias("page_id"),
        F.when(again, field("WARC-Payload-Length").try_cast("long")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(again, F.replace(field("WARC-Payload-Digest"), F.lit("sha256:"), F.lit(""))).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        field("WARC-Type").alias("record_type"), F.when(again, page("WARC-Refers-To")).cast(kind).alias("refers_to"))


@register("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; the model learns from labelled rows outside the held-out fold."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "n_exact", "n_misspelled", "n_quoted", "n_direct")


@register("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: counts of the base rules' spans, and all spans."""
    found = secrets_scan.scan(read_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets_scan.BASE]
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    of_kind = lambda k: F.filter("spans", lambda s: s.kind == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(listed(F.filter("spans", lambda s: s.kind.isin(base))), 256).alias("base_sha256"), listed("spans").alias("spans"))


@register("op5_token_output")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-BPE ids of every text with end id 2, written as Simple-8b blocks in ascending id order and read back."""
    path = scratch_path(spark, "tokens")
    token_output.write_tokens(read_table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), end_id=2)
    return token_output.read_tokens(spark, path, with_ids=False)


@register("op6_near_dup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose three-word SimHash fingerprints chain within two bits."""
    found = near_dup.groups(read_table(spark, sf_dir, "documents"), words=3, max_bits=2)
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


@register("op7_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every text and of its edited text, and how near they and the next document are."""
    found = simhash.compared(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", hex16(F.col("fp")).alias("fingerprint"),
                        hex16(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next")


OP8_SQL = """
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, q, q + least(10, len(w)) - 1), ' ') AS win
                 FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS q FROM items WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT k FROM windows),
     places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM docs),
     hits AS (SELECT doc_id, p, s.k, item_id FROM places CROSS JOIN sizes s
              JOIN windows v ON v.k = s.k AND v.win = array_to_string(list_slice(w, p, p + s.k - 1), ' ') WHERE p + s.k - 1 <= len(w)),
     covered AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS x FROM hits) GROUP BY doc_id),
     named AS (SELECT doc_id, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS h
               FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(n.n, 0) AS BIGINT) AS n_items,
       coalesce(n.h, sha256('')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
"""


@register("op8_decontamination", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text that lie in ten-word windows of benchmark items."""
    found = decontaminate.find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(F.col("spans"), F.lit(0).cast("long"), lambda total, x: x - total)  # (e1 - s1) + (e2 - s2) + ...
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


@register("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every text and back, as digests."""
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"))


@register("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance resampling of all documents towards those labelled good."""
    return quality.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


_OP11_CUT = "\n  UNION ALL ".join(
    rf"SELECT doc_id, '{kind}' AS kind, {i} AS o, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM d"
    for i, (kind, pattern) in enumerate([
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]))
_OP11_WORDS = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}]+'), lambda w: len(w) BETWEEN 4 AND 40)"

OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     cut AS ({_OP11_CUT}),
     matches AS (SELECT doc_id, kind, o, i, m[i] AS v, g[i] AS before, g[i + 1] AS after FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM cut)),
     placed AS (SELECT *, CAST(sum(len(before)) OVER upto + coalesce(sum(len(v)) OVER past, 0) AS BIGINT) AS start, regexp_replace(v, '[^0-9]', '', 'g') AS num FROM matches
                WINDOW upto AS (PARTITION BY doc_id, kind ORDER BY i), past AS (PARTITION BY doc_id, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
     base AS (SELECT * FROM placed WHERE CASE kind
                WHEN 'email' THEN TRUE
                WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda p: len(ltrim(p, '0')) > 3 OR coalesce(TRY_CAST(p AS DOUBLE), 0) > 255)) = 0
                WHEN 'card' THEN len(num) BETWEEN 13 AND 19 AND list_sum(list_transform(range(len(num)), lambda k: CASE WHEN k % 2 = 0 THEN CAST(substr(num, CAST(len(num) - k AS BIGINT), 1) AS INT)
                       ELSE (2 * CAST(substr(num, CAST(len(num) - k AS BIGINT), 1) AS INT)) // 10 + (2 * CAST(substr(num, CAST(len(num) - k AS BIGINT), 1) AS INT)) % 10 END)) % 10 = 0
                ELSE len(num) BETWEEN 9 AND 15 END),
     mentions AS (SELECT row_number() OVER () AS id, kind || ':' || CASE kind WHEN 'email' THEN lower(v) WHEN 'ip' THEN v ELSE num END AS entity,
                         CASE WHEN len(before) > 100 THEN regexp_replace(right(before, 100), '^\p{{L}}+', '') ELSE before END || ' ' ||
                         CASE WHEN len(after) > 100 THEN regexp_replace(left(after, 100), '\p{{L}}+$', '') ELSE after END AS near FROM base),
     near_words AS (SELECT id, entity, near, unnest(list_distinct({_OP11_WORDS.format("near")})) AS w FROM mentions),
     pairs AS (SELECT entity, w, count(*) AS both FROM near_words GROUP BY entity, w HAVING count(DISTINCT near) >= 3),
     class_pairs AS (SELECT entity, b, count(*) AS both FROM (SELECT DISTINCT id, entity, left(w, 3) AS b FROM near_words) GROUP BY entity, b),
     entities AS (SELECT entity, count(*) AS n FROM mentions GROUP BY entity),
     every AS (SELECT unnest({_OP11_WORDS.format("t")}) AS w FROM d),
     terms AS (SELECT w, count(*) AS n FROM every WHERE w IN (SELECT w FROM pairs) GROUP BY w),
     classes AS (SELECT left(w, 3) AS b, count(*) AS n FROM every WHERE left(w, 3) IN (SELECT left(w, 3) FROM pairs) GROUP BY 1),
     size AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM every),
     told AS (SELECT p.w, 1 + log2(p.both / t.n) / log2(size.n / e.n) AS share, 1 + log2(c.both / k.n) / log2(size.n / e.n) AS class_share
              FROM pairs p JOIN entities e USING (entity) JOIN terms t USING (w) JOIN class_pairs c ON c.entity = p.entity AND c.b = left(p.w, 3)
              JOIN classes k ON k.b = left(p.w, 3) CROSS JOIN size WHERE e.n < size.n),
     chosen AS (SELECT w, CASE WHEN max(least(1, class_share)) < 0.9 THEN 'generalise' ELSE 'remove' END AS action FROM told WHERE least(1, share) >= 0.9 GROUP BY w),
     plain AS (SELECT doc_id, array_to_string(list_transform(range(1, len(g) + 1), lambda i: g[i] || repeat(chr(2), CAST(coalesce(len(m[i]), 0) AS BIGINT))), '') AS t FROM cut WHERE kind = 'email'),
     runs AS (SELECT doc_id, i, m[i] AS v, g[i] AS before FROM (SELECT doc_id, regexp_extract_all(t, '\p{{L}}+') AS m, string_split_regex(t, '\p{{L}}+') AS g,
                     unnest(range(1, len(regexp_extract_all(t, '\p{{L}}+')) + 1)) AS i FROM plain WHERE EXISTS (SELECT 1 FROM chosen))),
     run_places AS (SELECT *, CAST(sum(len(before)) OVER upto + coalesce(sum(len(v)) OVER past, 0) AS BIGINT) AS start FROM runs
                    WINDOW upto AS (PARTITION BY doc_id ORDER BY i), past AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
     spans AS (SELECT doc_id, kind, o, start, len(v) AS n FROM base
               UNION ALL SELECT doc_id, action, CASE action WHEN 'generalise' THEN 4 ELSE 5 END, start, len(v) FROM run_places r JOIN chosen c ON lower(r.v) = c.w),
     listed AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
                       count(*) FILTER (kind = 'phone') AS n_phone, string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY o, start) FILTER (o < 4) AS own,
                       string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY o, start) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (doc_id)
"""


@register("op11_pii", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text, and the terms that disclose it."""
    found = pii.scan(read_table(spark, sf_dir, "documents")).rows
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    of_kind = lambda k: F.filter("spans", lambda s: s.kind == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(F.filter("spans", lambda s: s.kind.isin(pii.KINDS))), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


OP12_SQL = r"""
WITH words_of AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     target AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
     corpus AS (SELECT unnest(w) AS w FROM words_of),
     tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
     bucket AS (SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(strlen(w)), lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
                                          lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS b
                FROM (SELECT w FROM corpus UNION SELECT w FROM target) CROSS JOIN tab),
     s AS (SELECT b, count(*) AS n FROM corpus JOIN bucket USING (w) GROUP BY b),
     t AS (SELECT b, count(*) AS n FROM target JOIN bucket USING (w) GROUP BY b),
     totals AS (SELECT CAST((SELECT count(*) FROM corpus) AS DOUBLE) AS s_all, CAST((SELECT count(*) FROM target) AS DOUBLE) AS t_all),
     gain AS (SELECT k AS b, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1) * (s_all + 10000) / ((coalesce(s.n, 0) + 1) * (t_all + 10000)))) AS BIGINT) AS g
              FROM range(10000) r(k) CROSS JOIN totals LEFT JOIN s ON s.b = k LEFT JOIN t ON t.b = k),
     weight AS (SELECT doc_id, CAST(sum(g) AS BIGINT) AS weight FROM (SELECT doc_id, unnest(w) AS w FROM words_of) JOIN bucket USING (w) JOIN gain USING (b) GROUP BY doc_id),
     scored AS (SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_features, coalesce(x.weight, 0) AS weight,
                       coalesce(x.weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
                FROM words_of d LEFT JOIN weight x USING (doc_id)),
     able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN rank <= 10 * (SELECT count(*) FROM able) // 100 THEN rank END AS BIGINT) AS rank
FROM scored LEFT JOIN able USING (doc_id)
"""


@register("op12_importance", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance resampling of all documents towards the benchmark's words: weights, scores, and ranks of those drawn."""
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 16 leading whitened components."""
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))
