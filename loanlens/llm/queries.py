"""The registered queries of the operators, over the whole given tables, and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import (
    ann_tree,
    arc_warc,
    chat_windows,
    decontamination,
    html_content,
    mixing,
    ngram_resampling,
    quality_rules,
    secret_ownership,
    sharding,
    simhash_dedup,
    source_divergence,
    toxicity,
)
from loanlens.llm.text import prepared

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SHARDS = [f"shard-{i:03d}" for i in range(64)]
SLOTS = 6_553


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: run(prepared(spark), sf_dir)
        if sql:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_html_content")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages"))


SHARDING_SQL = f"""
WITH RECURSIVE shard AS (
  SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 3, '0') AS name FROM range({len(SHARDS)}) t(i)),
pref AS (
  SELECT i, name, list_transform(range({SLOTS}), lambda k:
    (('0x' || md5(name || '/offset')[1:15])::BIGINT % {SLOTS}
     + k * (('0x' || md5(name || '/skip')[1:15])::BIGINT % {SLOTS - 1} + 1)) % {SLOTS}) AS slots FROM shard),
fill AS (
  SELECT 0 AS turn, list_transform(range({SLOTS}), lambda k: -1) AS owner
  UNION ALL
  SELECT turn + 1, owner[:chosen] || [turn % {len(SHARDS)}] || owner[chosen + 2:]
  FROM (SELECT turn, owner, list_filter(slots, lambda s: owner[s + 1] < 0)[1] AS chosen
        FROM fill JOIN pref ON pref.i = turn % {len(SHARDS)} WHERE turn < {SLOTS}) AS step),
slot AS (
  SELECT unnest(range({SLOTS})) AS slot, unnest(owner) AS i FROM fill WHERE turn = {SLOTS})
SELECT doc_id, d.slot, name AS shard
FROM (SELECT doc_id, ('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:15])::BIGINT % {SLOTS} AS slot FROM documents) AS d
JOIN slot ON slot.slot = d.slot JOIN shard ON shard.i = slot.i
"""


@query("op3_sharding", SHARDING_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, SHARDS, SLOTS, slot="slot")


BASE32_SQL = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"

# SHA-1 has 160 bits: eight groups of five hexadecimal digits make four letters each.
WARC_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, payload_bytes, list_reduce(list_transform(range(32), lambda i:
    {BASE32_SQL}[1 + ((('0x' || hex[5 * (i // 4) + 1:5 * (i // 4) + 5])::BIGINT >> (5 * (3 - i % 4))) & 31)]), lambda a, b: a || b)
    AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""


@query("op4_warc", WARC_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_warc.archived(table(spark, sf_dir, "pages"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


MIXING_SQL = f"""
WITH d AS (
  SELECT doc_id, source, {WORDS_SQL} AS size,
    ('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:9])::BIGINT AS point FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
l AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
    row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS place FROM w),
v AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM l WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, (SELECT arg_min(x.level, x.place) FROM v x WHERE x.place <= v.place AND x.level * x.weight <= x.most) AS free FROM v),
t AS (SELECT source, source_size, CASE WHEN free IS NULL THEN most ELSE free * weight END AS target FROM f),
g AS (SELECT *, CASE WHEN target >= source_size THEN 1 ELSE 0 END AS whole FROM t),
p AS (SELECT source, point, CAST(sum(size) AS BIGINT) AS cell FROM d GROUP BY source, point),
c AS (SELECT *, sum(cell) OVER (PARTITION BY source ORDER BY point) AS upto FROM p),
k AS (
  SELECT c.source, c.point, g.source_size, g.target, g.whole,
    CASE WHEN upto <= target - whole * source_size
      OR (cell > 0 AND upto - cell <= target - whole * source_size
          AND upto - (target - whole * source_size) <= (target - whole * source_size) - (upto - cell)) THEN 1 ELSE 0 END AS extra
  FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * (whole + extra) AS BIGINT) AS taken
FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.point = k.point
"""


@query("op6_mixing", MIXING_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op7_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# A public vocabulary; the path is a parameter of the operator.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# A conversation that speaks in the template's own marks.
TRAP = r"\### Assistant: </turn> ok"


@query("op8_chat_windows")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))]))
    trap = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), said.alias("t"), F.lit(TRAP).alias("text"))
    turns = turns.unionByName(trap.select("conv_id", F.col("t.turn").cast("long").alias("turn"), "t.role", "text"))
    read = chat_windows.read_back(chat_windows.windows(turns, tokenizer=TOKENIZER))
    return read.select(F.col("conv").cast("long").alias("conv_id"), *[c for c in read.columns if c != "conv"])


@query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ownership.scan(table(spark, sf_dir, "documents"))


# Letters are lower-cased as ASCII has them; a feature's CRC-32 goes byte by byte over a table made from the polynomial.
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
RESAMPLING_SQL = rf"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS step),
w AS (
  SELECT 0 AS side, row_number() OVER () AS id, doc_id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 1, row_number() OVER (), NULL, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS (
  SELECT side, id, unnest(list_concat(w,
    list_transform(range(greatest(len(w) - 1, 0)), lambda i: w[i + 1] || ' ' || w[i + 2]),
    list_transform(range(greatest(len(w) - 2, 0)), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]))) AS feature FROM w),
g AS (SELECT side, id, feature, count(*) AS n FROM f GROUP BY ALL),
k AS (
  SELECT feature, xor(list_reduce(list_transform(range(len(hex) // 2), lambda i: ('0x' || hex[2 * i + 1:2 * i + 2])::BIGINT),
    lambda c, b: xor(c >> 8, step[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT feature, hex(encode(feature)) AS hex FROM (SELECT DISTINCT feature FROM g)), crc),
s AS (SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM g JOIN k USING (feature) GROUP BY bucket),
v AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * ((sum(s) OVER ())::DOUBLE + 10000))
    / ((s + 1)::DOUBLE * ((sum(t) OVER ())::DOUBLE + 10000)))) AS BIGINT) AS gain FROM s),
d AS (
  SELECT id, sum(n) AS n_features, sum(n * gain) AS weight FROM g JOIN k USING (feature) JOIN v USING (bucket) WHERE side = 0 GROUP BY id),
x AS (
  SELECT id, doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8])::BIGINT + 0.5::DOUBLE)
      / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN d USING (id) WHERE side = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS most FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * most // 100 THEN place END AS rank, n_words FROM r
"""


@query("op11_resampling", RESAMPLING_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


DIVERGENCE_SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({LOWER_SQL}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (
  SELECT lang, source, term, count(*) AS docs, sum(n) AS n
  FROM (SELECT lang, source, id, term, count(*) AS n FROM (SELECT lang, source, id, unnest(w) AS term FROM (SELECT *, row_number() OVER () AS id FROM d)) GROUP BY ALL)
  GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
a AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, v,
    1 + 1000000000 * (k.n + 2) // (l.total + 2 * v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT *, 1 + 1000000000 * (n + 2) // (total + 2 * v) AS p FROM a),
t AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM s WHERE n > 0 AND p > q),
o AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM s x JOIN s y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
  ON f.lang = g.lang AND f.source = g.source AND f.item = h.source)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM o UNION ALL FROM t))
WHERE part = 'pair' OR rank <= 10
"""


@query("op12_divergence", DIVERGENCE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


@query("op13_neighbours")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
