"""One registered query per operator, over whole tables, and the DuckDB SQL
of those that SQL can express.  The others are held against brute force in
``tests/llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import bpe, conversations, decontaminate, jaccard, licenses, lines, mixing, sharding, tokens, toxicity, urls, variants, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BLANK = r"regexp_extract_all(" + _LOWER.format("text") + r", '[^\x20\x09-\x0D]+')"

#: Components of links (a, b) between nodes, named by their smallest node.
_COMPONENTS = """
e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)"""

#: crc32 in SQL: ``crc`` has the table ``t``; ``_CRC32`` takes a text.
_CRC_TABLE = """
bits(k, b, v) AS (SELECT 0, b, CAST(b AS BIGINT) FROM range(256) AS t(b)
  UNION ALL SELECT k + 1, b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8)"""
_CRC32 = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, length(hex(encode({0}))) // 2), "
          "lambda i: CAST('0x' || substr(hex(encode({0})), 2 * i + 1, 2) AS BIGINT))), "
          "lambda a, y: xor(a // 256, t[xor(a % 256, y) + 1])), 4294967295)")


@_query("op2_decontamination", f"""
WITH w AS (SELECT doc_id, coalesce({_ALNUM}, []) AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
i AS (SELECT item, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(ws[k:k + n - 1], ' ') AS g FROM i, unnest(range(1, len(ws) - n + 2)) AS t(k)),
d AS (SELECT doc_id, n, k, array_to_string(ws[k:k + n - 1], ' ') AS g
      FROM w, (SELECT DISTINCT n FROM win) AS sizes, unnest(range(1, len(ws) - n + 2)) AS t(k)),
h AS (SELECT DISTINCT doc_id, n, k, item FROM d JOIN win USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_hits(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("hits.n_hit") > 0).alias("contaminated"))


@_query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity.fit_on_labels(docs, _table(spark, sf_dir, "labels"))
    return toxicity.classify(docs, weights).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query("op7_ngram_jaccard_join", f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce({_BLANK}, []) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + 4], ' ') AS g
      FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(k) WHERE len(ws) > 0),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * shared >= 75 * (ca.n + cb.n - shared)),
{_COMPONENTS}
SELECT doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(least(low, doc_id), doc_id) AS component_id
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN lowest ON lowest.a = doc_id
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query("op5_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@_query("op10_mixing", r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
             CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2 * source_size AS cap FROM r),
f AS (SELECT *, sum(source_size) OVER () AS total,
        coalesce(sum(cap) OVER (ORDER BY cap * 10 // w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
        sum(w) OVER (ORDER BY cap * 10 // w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr FROM w),
o AS (SELECT *, CAST(total * 150 - filled * 100 AS DOUBLE) / CAST(100 * wr AS DOUBLE) AS level,
        cap * 100 * wr >= (total * 150 - filled * 100) * w AS open FROM f),
g AS (SELECT source, rank, source_size, total,
        CASE WHEN open THEN w * max(level) FILTER (WHERE open) OVER () ELSE CAST(cap AS DOUBLE) END AS target FROM o),
q AS (SELECT d.doc_id, d.size, g.*, sum(d.size) OVER (PARTITION BY g.rank ORDER BY h, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, row_number() OVER () AS n
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT n, e AS copy, rank, cum, size, total, CAST(e * source_size + cum AS DOUBLE) / target AS v
      FROM q, (VALUES (0), (1)) AS t(e) WHERE size > 0),
t AS (SELECT n, size, sum(size) OVER (ORDER BY v, rank, copy, cum ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto, total FROM c),
k AS (SELECT n, sum(size) AS taken FROM t WHERE upto * 100 <= total * 150 GROUP BY n)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN k USING (n)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@_query("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "found.n_words", F.size("found.licenses").cast("long").alias("n_licenses"),
                        F.array_join("found.licenses.license", ",").alias("licenses"),
                        F.array_max("found.licenses.coverage").alias("best_coverage"),
                        F.aggregate("found.licenses", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1).alias("license_words"))


@_query("op4_embedding_near_dedup", f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT vec_id, x, sqrt(list_sum(list_transform(x, lambda c: c * c))) AS norm FROM v
      WHERE len(list_filter(x, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM u p JOIN u q ON p.vec_id < q.vec_id AND len(p.x) = len(q.x)
          WHERE p.norm > 0 AND q.norm > 0 AND list_dot_product(p.x, q.x) / (p.norm * q.norm) >= 0.9),
{_COMPONENTS},
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(low, vec_id), vec_id) AS component_id,
  coalesce(least(low, vec_id), vec_id) = vec_id AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN lowest ON lowest.a = vec_id
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@_query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = tokens.count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@_query("op8_line_dedup", r"""
WITH l AS (SELECT doc_id, i AS pos, x AS line, lower_ascii AS key FROM (
  SELECT doc_id, i, lines[i] AS x, translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents), unnest(range(1, len(lines) + 1)) AS t(i))),
k AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT l.*, k.keeper IS NOT NULL AND l.doc_id <> k.keeper AS lost FROM l LEFT JOIN k ON l.key = k.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM j GROUP BY doc_id
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: Stand-ins derived from ``pages``: when a page was fetched (within 2024), and the
#: dated history of a block list over a third of all hosts and domains.
_YEAR, _START = 366 * 86_400, 1_704_067_200


@_query("op9_url_filters", rf"""
WITH h AS (SELECT page_id, {_START} + page_id * 7919 * 61 % {_YEAR} AS fetched,
    nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', ''), '') AS host FROM pages),
d AS (SELECT DISTINCT host, list_aggregate(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), 'string_agg', '.') AS entry
  FROM (SELECT DISTINCT host FROM h WHERE host IS NOT NULL), unnest(range(1, CASE WHEN regexp_matches(host, '^[0-9]+(\.[0-9]+){{3}}$') THEN 1 ELSE greatest(len(string_split(host, '.')) - 1, 1) END + 1)) AS t(i)),
e AS (SELECT entry, ('0x' || substr(md5(entry), 1, 7))::BIGINT AS a, ('0x' || substr(md5(entry), 8, 7))::BIGINT AS b
  FROM (SELECT DISTINCT entry FROM d)),
v AS (SELECT entry, {_START} + b % {_YEAR} AS since, {_START} + b % {_YEAR} + 86400 * (10 + a % 50) AS until FROM e WHERE a % 3 = 0
  UNION ALL SELECT entry, {_START} + b % {_YEAR} + 86400 * 90, NULL FROM e WHERE a % 3 = 0),
j AS (SELECT page_id, d.entry, v.since, row_number() OVER (PARTITION BY page_id ORDER BY length(d.entry) DESC) AS n
  FROM h JOIN d USING (host) JOIN v ON v.entry = d.entry AND v.since <= h.fetched AND (v.until IS NULL OR h.fetched < v.until))
SELECT h.page_id, h.host, h.fetched, j.entry IS NOT NULL AS blocked, j.entry, j.since
FROM h LEFT JOIN j ON h.page_id = j.page_id AND j.n = 1
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.lit(_START) + F.col("page_id") * 7919 * 61 % _YEAR)
    hosts = pages.select(urls.host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    entries = hosts.select(F.explode(urls.domains(F.col("host"))).alias("entry")).distinct()
    part = lambda at: F.conv(F.substring(F.md5(F.col("entry").cast("binary")), at, 7), 16, 10).cast("long")
    listed = entries.withColumns({"a": part(1), "b": part(8)}).where("a % 3 = 0").withColumn("t", F.lit(_START) + F.col("b") % _YEAR)
    changes = F.array(F.struct(F.col("t").alias("at"), F.lit(True).alias("listed")),
                      F.struct((F.col("t") + 86_400 * (10 + F.col("a") % 50)).alias("at"), F.lit(False).alias("listed")),
                      F.struct((F.col("t") + 86_400 * 90).alias("at"), F.lit(True).alias("listed")))
    history = listed.select("entry", F.explode(changes).alias("c")).select("entry", "c.at", "c.listed")
    return urls.judge(captures, history).select("page_id", "host", "fetched", "blocked", "entry", "since")


@_query("op12_spelling_variants", rf"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, run, count(*) AS m FROM (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY doc_id, run),
h AS (SELECT run, m, {_CRC32.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM r, crc),
d AS (SELECT m, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
w AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM d WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3),
e AS (SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM w, unnest(range(0, length(word))) AS t(i)),
p AS (SELECT x.word, y.word AS other, y.n AS m FROM e x JOIN e y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM e x JOIN w y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM e x JOIN w y ON x.rest = y.word),
best AS (SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS k FROM p),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word AND best.k = 1),
way(word, up) AS (SELECT word, word FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON f.word = way.up WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.up AS root, f.n, f.n_near, f.form_n
FROM f JOIN way ON way.word = f.word JOIN f AS top ON top.word = way.up AND top.form IS NULL
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.explode(variants.runs(F.col("text"))).alias("run"))
    words = variants.count_words(docs.select(variants.mistyped(F.col("doc_id"), F.col("run"), 97).alias("word")))
    return variants.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def _add(state: str, cost: str, letter: str) -> str:
    """SQL of an audit state (eight digits of cost, then the audit) with one edit more."""
    return f"lpad(CAST(least(CAST(substr({state}, 1, 8) AS BIGINT) + {cost}, 99999999) AS VARCHAR), 8, '0') || substr({state}, 9) || '{letter}'"


@_query("op11_conversation_repair", rf"""
WITH RECURSIVE {_CRC_TABLE},
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC32.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(0, CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM o WHERE k <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM d),
f AS (SELECT conv_id, i, turn, role, text, substr(role, 1, 1) AS r, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS r0,
    CASE WHEN bare = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN bare[-1:] NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM n),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
    count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
    count(*) FILTER (WHERE r0 IS NOT NULL AND r0 || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS m FROM f GROUP BY conv_id),
-- a state is its cost in eight digits and its audit: nothing yet (e), after system (s), user (u), assistant (a)
dp(conv_id, i, e, s, u, a) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '00000000', '50000000', '00000005I', '00000010II' FROM s
  UNION ALL
  SELECT conv_id, i, e, s, u, least(a, {_add('u', '5', 'I')}) FROM (
    SELECT conv_id, i, e, s, a, least(u, {_add('e', '5', 'I')}, {_add('s', '5', 'I')}, {_add('a', '5', 'I')}) AS u FROM (
      SELECT dp.conv_id, f.i, {_add('e', '2', 'D')} AS e, least({_add('s', '2', 'D')}, {_add('e', 'ks', 'K')}) AS s,
        least({_add('u', '2', 'D')}, {_add('e', 'ku', 'K')}, {_add('s', 'ku', 'K')}, {_add('a', 'ku', 'K')}, {_add('e', 'kr', 'R')}, {_add('s', 'kr', 'R')}, {_add('a', 'kr', 'R')}) AS u,
        least({_add('a', '2', 'D')}, {_add('u', 'ka', 'K')}, {_add('u', 'kr', 'R')}) AS a
      FROM dp JOIN (SELECT *, CASE WHEN fault IN ('b', 'd') THEN 50000000 WHEN fault = 't' THEN 5 ELSE 0 END AS kr0,
          kr0 + 1 AS kr, CASE WHEN r = 's' THEN kr0 ELSE 50000000 END AS ks, CASE WHEN r = 'u' THEN kr0 ELSE 50000000 END AS ku, CASE WHEN r = 'a' THEN kr0 ELSE 50000000 END AS ka FROM f) AS f
        ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1))),
best AS (SELECT s.*, least(e, a) AS z, CAST(substr(least(e, a), 1, 8) AS BIGINT) AS cost, substr(least(e, a), 9) AS audit
  FROM s JOIN dp ON dp.conv_id IS NOT DISTINCT FROM s.conv_id AND dp.i = s.m),
l AS (SELECT conv_id, j, audit[j] AS letter, j - (length(audit[:j]) - length(replace(audit[:j], 'I', ''))) AS i, length(replace(audit[:j], 'D', '')) AS pos
  FROM best, unnest(range(1, length(audit) + 1)) AS t(j)),
t AS (SELECT l.conv_id, l.j, l.pos, CASE WHEN letter = 'K' THEN f.role END AS kept, CASE WHEN letter <> 'I' THEN f.text ELSE '' END AS text
  FROM l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i WHERE letter <> 'D'),
v AS (SELECT *, coalesce(max(CASE WHEN pos = 1 AND kept[1:1] = 's' THEN 1 END) OVER (PARTITION BY conv_id), 0) AS sys FROM t),
h AS (SELECT conv_id, sha256(string_agg(coalesce(kept, CASE WHEN (pos - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY j)) AS sha FROM v GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = conversations.repair(conversations.damaged(convs), convs)
    return done.withColumnRenamed("digest", "repaired_sha256")


@_query("op13_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    both = _table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip(F.col("text"), vocabulary).alias("bpe"))
    return both.select("doc_id", bpe.n_tokens(F.col("bpe.ids")).alias("n_tokens"), F.sha2("bpe.ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("bpe.decoded").cast("binary"), 256).alias("decoded_sha256"))
