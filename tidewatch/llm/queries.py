"""One query for each operator, with production parameters over whole tables."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm import (bpe, decontam, jaccard, langid, lines, mixing, negatives, periodic, quality, sharding, suffixes,
                           toxicity, warc)
from tidewatch.llm.common import table
from tidewatch.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def key_crc(mod: int):
    """crc32 of the key as text, modulo."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod


@query("op1_toxicity")
def op1(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"), learn=key_crc(4) != 2)
    return (toxicity.score(docs, model)
            .select("doc_id", (key_crc(4) == 2).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "n_features"))


@query("op7_bpe_roundtrip")
def op7(spark, sf):
    out = bpe.encode_decode(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op10_language_id")
def op10(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.train(docs, learn=key_crc(3) != 1)
    return langid.predict(docs, model).select(
        "doc_id", (key_crc(3) == 1).alias("held_out"), "lang_pred", "score", "margin", "rejected")


@query("op2_quality_llr")
def op2(spark, sf):
    docs = table(spark, sf, "documents")
    ratios = quality.ratios(docs, table(spark, sf, "labels").where("quality = 1"))
    return quality.judge(docs, ratios)


_LINES_SQL = r"""
WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t0,
                    unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL),
occ AS (SELECT doc_id, i, trim(t0, ' ' || chr(9) || chr(13)) AS t FROM raw WHERE trim(t0, ' ' || chr(9) || chr(13)) <> ''),
firsts AS (SELECT t, min((doc_id, i)) AS f, length(t) AS n FROM occ GROUP BY t),
halves AS (SELECT t, n, unnest([(1, n, left(t, n // 2)), (2, n, right(t, n - n // 2)),
                                (1, n - 1, left(t, (n - 1) // 2)), (2, n - 1, right(t, n - 1 - (n - 1) // 2))]) AS h
           FROM firsts WHERE n >= 24),
able AS (SELECT DISTINCT t, n FROM halves WHERE h IN (SELECT h FROM halves GROUP BY h HAVING count(*) > 1)),
places AS (SELECT t, n, unnest(range(1, n + 1)) AS p FROM able),
vars AS (SELECT t, p, left(t, p - 1) || substr(t, p + 1) AS v FROM places),
pairs AS (SELECT a.t, b.t AS u FROM vars a JOIN vars b ON a.v = b.v AND a.p = b.p AND a.t <> b.t
          UNION SELECT a.t, b.t FROM vars a JOIN able b ON a.v = b.t
          UNION SELECT b.t, a.t FROM vars a JOIN able b ON a.v = b.t),
near AS (SELECT DISTINCT p.t FROM pairs p JOIN firsts x ON p.t = x.t JOIN firsts y ON p.u = y.t WHERE y.f < x.f),
gone AS (SELECT o.doc_id, o.i FROM occ o JOIN firsts f ON o.t = f.t
         WHERE (o.doc_id, o.i) <> f.f OR o.t IN (SELECT t FROM near)),
kept AS (SELECT r.doc_id, string_agg(r.t0, chr(10) ORDER BY r.i) AS text FROM raw r
         LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.i = g.i WHERE g.i IS NULL GROUP BY r.doc_id)
SELECT d.doc_id, (SELECT count(*) FROM occ o WHERE o.doc_id = d.doc_id) AS n_lines,
       (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS kept_md5
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id"""


@query("op5_line_dedup", _LINES_SQL)
def op5(spark, sf):
    return lines.dedup(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


@query("op6_sharding_kk")
def op6(spark, sf):
    return sharding.by_bytes(table(spark, sf, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
             min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to FROM d"""


@query("op9_warc", _WARC_SQL)
def op9(spark, sf):
    got = warc.round_trip(table(spark, sf, "pages"))
    own = F.col("record_type") == "response"
    return got.select("page_id",
                      F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
                      F.when(own, F.sha2("payload", 256)).otherwise(F.col("declared_digest")).alias("payload_digest"),
                      "record_type", "refers_to")


@query("op8_decontamination")
def op8(spark, sf):
    return decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


_JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE 100 * p.o >= 75 * (x.n + y.n - p.o)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, coalesce(min(r.b), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN r ON r.a = w.doc_id GROUP BY w.doc_id"""


@query("op3_jaccard_join", _JACCARD_SQL)
def op3(spark, sf):
    return jaccard.link(table(spark, sf, "documents")).drop("row", "kept")


_SUFFIX_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, h, unnest(range((length(h) + 1023) // 1024)) AS j FROM d),
q AS (SELECT doc_id, j, substr(h, 1024 * j + 1, 1024 + 98) AS h FROM c),
b AS (SELECT doc_id, 512 * j + p AS p, substr(h, 2 * p + 1, 2) AS c, substr(h, 2 * p + 1, 100) AS w
      FROM (SELECT doc_id, j, h, unnest(range(least(512, length(h) // 2))) AS p FROM q)),
f AS (SELECT w, min(doc_id) AS k FROM b WHERE length(w) = 100 GROUP BY w),
g AS (SELECT b.doc_id, b.p, b.c, coalesce(f.k < b.doc_id, false) AS x FROM b LEFT JOIN f ON f.w = b.w),
r AS (SELECT doc_id, p, c, max(CAST(x AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS x
      FROM g),
t AS (SELECT *, coalesce(lag(x) OVER (PARTITION BY doc_id ORDER BY p), 0) AS before FROM r),
o AS (SELECT doc_id, CAST(sum(x) AS BIGINT) AS n_removed, CAST(count_if(x = 1 AND before = 0) AS BIGINT) AS n_spans,
             coalesce(string_agg(c, '' ORDER BY p) FILTER (x = 0), '') AS kept FROM t GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(o.n_removed, 0) AS n_removed,
       coalesce(o.n_spans, 0) AS n_spans, sha256(unhex(coalesce(o.kept, ''))) AS kept_sha256
FROM d LEFT JOIN o ON o.doc_id = d.doc_id"""


@query("op4_suffix_dedup", _SUFFIX_SQL)
def op4(spark, sf):
    return suffixes.dedup(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


_MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  coalesce(CAST(doc_id AS VARCHAR), md5(text), '') AS seed FROM documents),
w AS (SELECT source, CAST(sum(size) AS BIGINT) AS s,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
      FROM d GROUP BY source),
share AS (SELECT arg_max(n, n / w) AS n, arg_max(w, n / w) AS w FROM (
  SELECT (SELECT sum(s) FROM w) - coalesce(sum(3 * s) OVER (ORDER BY s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n,
         sum(w) OVER (ORDER BY s / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w FROM w)),
t AS (SELECT source, s, CASE WHEN 3 * s * share.w < share.n * w.w THEN CAST(3 * s AS DOUBLE)
                             ELSE CAST(share.n AS DOUBLE) * w.w / CAST(share.w AS DOUBLE) END AS target FROM w, share),
r AS (SELECT source, s, target, CASE WHEN s > 0 THEN target / s ELSE 0.0 END AS rate FROM t),
h AS (SELECT *, [sha256('mix:0:' || seed), sha256('mix:1:' || seed)] AS h FROM d),
u AS (SELECT h.doc_id, h.source, h.size, r.s, r.target, r.rate, unnest(range(16)) AS j, h.h FROM h JOIN r ON h.source IS NOT DISTINCT FROM r.source),
v AS (SELECT *, floor(rate) + CASE WHEN CAST('0x' || substr(h[1 + j // 8], 8 * (j % 8) + 1, 8) AS BIGINT) / 4294967296.0 < rate - floor(rate)
                                   THEN 1 ELSE 0 END AS copies FROM u),
m AS (SELECT source, j, abs(floor(any_value(rate)) * any_value(s) + sum((copies - floor(rate)) * size) - any_value(target)) AS miss
      FROM v GROUP BY source, j),
best AS (SELECT source, min((miss, j))[2] AS j FROM m GROUP BY source)
SELECT v.doc_id, v.size, v.s AS source_size, v.target, CAST(v.size * v.copies AS BIGINT) AS taken, CAST(v.copies AS INTEGER) AS copies
FROM v JOIN best b ON v.source IS NOT DISTINCT FROM b.source AND v.j = b.j"""


@query("op11_mixing", _MIX_SQL)
def op11(spark, sf):
    docs = table(spark, sf, "documents")
    return mixing.plan(docs, mixing.rates(docs)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def loops(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts as they are, a tenth of them with words that repeat from a place on."""
    spaces, h = F.lit(" \t\n\x0b\x0c\r"), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", h.alias("h"), F.btrim("text", spaces).alias("t"))
    d = d.withColumn("w", F.when((F.col("h") % 10 == 0) & (F.col("t") != ""), F.split("t", "[\\x20\\x09-\\x0D]+")))
    d = d.withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    d = d.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    looped = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest)), " ")
    return d.select("doc_id", F.when(F.col("w").isNotNull(), looped).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark, sf):
    d = periodic.find_runs(loops(table(spark, sf, "documents")))
    runs = F.col("runs")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    d = d.select("doc_id", "runs", "collapsed", best.alias("b"))
    d = d.select("doc_id", "runs", "collapsed", (-F.col("b.col2")).alias("start"), F.col("b.length").alias("length"),
                 (-F.col("b.col3")).alias("period"))
    lines = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size(runs) > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return d.select("doc_id", F.size(runs).cast("long").alias("n_runs"), "start", "length", "period",
                    F.floor(1000 * F.col("length") / F.col("period")).alias("exponent_milli"),
                    F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


_NEGATIVES_SQL = """
WITH e AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.id AS a, a.label = e.label AS same, e.id AS b, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS s
      FROM e a JOIN e ON a.id % 50 = 0 AND a.id <> e.id),
pos AS (SELECT a, b, s FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT pos.a AS anchor_id, pos.b AS positive_id,
       CAST(row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY p.s DESC, p.b) AS INTEGER) AS rank,
       p.b AS negative_id, pos.s AS positive_score, p.s AS negative_score
FROM pos JOIN p ON p.a = pos.a AND NOT p.same AND 50 * pos.s <= 100 * p.s AND 100 * p.s <= 95 * pos.s
QUALIFY row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY p.s DESC, p.b) <= 3"""


@query("op13_hard_negatives", _NEGATIVES_SQL)
def op13(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return negatives.mine(rows, anchor=F.col("id") % 50 == 0)
