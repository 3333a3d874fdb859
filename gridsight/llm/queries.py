"""Every operator of this subpackage as a query over the supplied tables, beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.llm import (
    collocations, decontamination, extraction, licenses, mixing, pseudonyms, quality, secret_scan, simhash, spelling, topk, toxicity, warc,
)
from gridsight.llm.common import table
from gridsight.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(function, sql: str | None = None):
    QUERIES[function.__name__] = function
    if sql:
        ORACLE[function.__name__] = sql
    return function


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontamination.mark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.col("leaks.items")
    return marked.select(
        "doc_id", "leaks.n_words", decontamination.n_hit().alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("leaks.spans") > 0).alias("contaminated"),
    )


query(op1_decontamination, rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), i AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
    FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(p) WHERE len(w) > 0
), slid AS (
    SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS g
    FROM d, (SELECT DISTINCT n FROM win) AS l, unnest(range(1, len(w) - n + 2)) AS t(p)
), hit AS (
    SELECT r, p, n, item FROM slid JOIN win USING (n, g)
), words AS (
    SELECT r, count(DISTINCT q) AS n_hit FROM hit, unnest(range(p, p + n)) AS t(q) GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


query(op5_simhash)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


query(op2_mixing, r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, md5('0|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS k,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
    FROM d GROUP BY source
), everything AS (
    SELECT sum(source_size) AS words FROM s
), rounds AS (
    SELECT 0 AS round, source, source_size, w, false AS full_up, NULL::DOUBLE AS share FROM s
    UNION ALL
    SELECT round + 1, source, source_size, w, full_up OR source_size * 3 < share, share
    FROM (
        SELECT round, source, source_size, w, full_up,
               (words - coalesce(sum(CASE WHEN full_up THEN source_size * 3 END) OVER (), 0)) * w
               / sum(CASE WHEN full_up THEN 0 ELSE w END) OVER () AS share
        FROM rounds, everything WHERE round <= (SELECT count(*) FROM s)
    )
), goal AS (
    SELECT source, source_size, CASE WHEN full_up THEN source_size * 3 ELSE share END AS target
    FROM rounds WHERE round = (SELECT max(round) FROM rounds)
), p AS (
    SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
           CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs,
           sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS UNBOUNDED PRECEDING) - size AS start
    FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - start)) AS BIGINT) AS taken
FROM p
""")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


query(op7_toxicity)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = new_folder(spark, "ledger")
    secret_scan.scan_load(table(spark, sf_dir, "documents"), ledger, "1")
    base = F.filter("spans", lambda s: s["nth"] < len(secret_scan.BASE_RULES))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return secret_scan.report(spark, ledger, "1").select(
        F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed("spans").alias("spans"))


#: As RULES, but for private keys, whose END line SQL cannot tie to its BEGIN line: it has the BEGIN line alone,
#: which is the same on tables without keys. The tests hold whole keys against a search by hand.
_KINDS = {
    "assign": """([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]{32,}",
    "pem": "-----BEGIN [A-Z ]*PRIVATE KEY-----", "forge": "gh[pousr]_[A-Za-z0-9]{36,}",
}
_RUNS = " UNION ALL ".join(
    f"SELECT r, {i} AS nth, '{kind}' AS kind, regexp_extract_all(text, '{rx}') AS found, "
    + (f"regexp_extract_all(text, '{rx}', 2)" if kind == "assign" else f"regexp_extract_all(text, '{rx}')")
    + f" AS part, string_split_regex(text, '{rx}') AS gaps FROM d"
    for i, (kind, rx) in enumerate(_KINDS.items()))

query(op4_secret_scan, f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), runs AS ({_RUNS}), steps AS (
    SELECT r, nth, kind, found[p] AS m, part[p] AS v,
           list_sum(list_transform(gaps[1:p], lambda x: len(x))) + list_sum(list_transform(found[1:p], lambda x: len(x))) AS stop
    FROM runs, unnest(range(1, len(found) + 1)) AS t(p)
), spans AS (
    SELECT r, nth, kind, stop - len(m) AS start, kind || ':' || CAST(stop - len(m) AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span
    FROM steps
    WHERE CASE kind WHEN 'assign' THEN len(v) >= 8 WHEN 'access' THEN len(m) >= 16 ELSE true END
), per AS (
    SELECT r, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
           count(*) FILTER (WHERE kind = 'hex') AS n_hex,
           string_agg(span, ',' ORDER BY start, nth) FILTER (WHERE nth < 3) AS base,
           string_agg(span, ',' ORDER BY start, nth) AS spans
    FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (r)
""")


def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", extraction.extracted("html").alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


query(op6_extraction)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


query(op3_warc, """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), l AS (
    SELECT *, max(page_id) OVER (PARTITION BY body) AS last FROM p
)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM l
""")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judged(docs, model).select(
        "doc_id", "judged.n_words", "judged.word_chars", "judged.n_symbols", "judged.n_dup_lines",
        "judged.n_repeat_words", "judged.base_failed", "judged.kept", "judged.quality")


query(op9_quality)


#: The key of the registered query; a user's own is secret.
DEMONSTRATION_KEY = b"gridsight demonstration key"


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pseudonyms.pseudonymised(table(spark, sf_dir, "documents"), DEMONSTRATION_KEY)
    return docs.select(
        "doc_id", "text", F.size("values").cast("bigint").alias("n_values"),
        F.array_join(F.transform("values", lambda v: F.concat_ws(":", v["kind"], v["start"], v["end"])), ",").alias("spans"))


query(op8_pseudonyms)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = licenses.scanned(table(spark, sf_dir, "documents"))
    return docs.select(
        "doc_id", F.size("licenses").cast("bigint").alias("n_licenses"),
        F.array_join(F.transform("licenses", lambda m: F.concat_ws(":", m["name"], m["start"], m["end"])), ",").alias("spans"),
        F.array_join(F.transform("licenses", lambda m: m["differences"].cast("string")), ",").alias("differences"),
        F.array_max(F.transform("licenses", lambda m: m["reduction"])).alias("best_reduction"))


query(op10_licenses)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


query(op11_collocations, rf"""
WITH p AS (
    SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), f AS (
    SELECT lang, k AS size, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM p, unnest(range(1, 6)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY ALL
), total AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), often AS (
    SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 100
), inside AS (
    SELECT DISTINCT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, f
    FROM often, unnest(range(2, size)) AS s(k), unnest(range(1, size - k + 2)) AS t(i)
), c AS (
    SELECT * FROM often AS o
    WHERE NOT EXISTS (SELECT 1 FROM inside AS i WHERE i.lang = o.lang AND i.phrase = o.phrase AND 100 * i.f >= 100 * o.f)
), cut AS (
    SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, n, k,
           1000::HUGEINT * c.f * n // (x.f::HUGEINT * y.f) AS score
    FROM c JOIN total USING (lang), unnest(range(1, size)) AS s(k)
    JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
    JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
), best AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= 2000
""")


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


query(op12_topk, """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS w
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
""")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    def spelt(run):
        """The run, or without one code point where its checksum in its document says so."""
        check = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
        place = (check % F.length(run)).cast("int")
        cut = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
        return F.when(check % 31 == 0, cut).otherwise(run)

    words = spelling.vocabulary(table(spark, sf_dir, "documents"), spelling=spelt)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


query(op13_spelling)
