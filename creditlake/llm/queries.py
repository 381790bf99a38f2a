"""The operators as queries over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.llm import ann, decontaminate, divergence, fim, html, langid, mixing, pii, sharding, simhash, tokens, toxicity, warc
from creditlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def keep(f):
        QUERIES[name] = f
        return f

    return keep


@query("op1_simhash_groups")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.as_hex(F.col("bits")).alias("fingerprint"), "component_id")


@query("op2_source_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


ORACLES["op2_source_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, md5(text) AS text_key,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size,
    CAST(CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight
  FROM sources),
levels AS (
  SELECT *, 2 * source_size / weight AS ratio,
    (CAST(1.5 AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(CAST(2 * source_size AS DOUBLE)) OVER lower, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0)) AS level
  FROM weighed
  WINDOW lower AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), weight * (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, source LIMIT 1)) AS target
  FROM levels),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST, text_key NULLS FIRST) - 1 AS place FROM sized),
drawn AS (
  SELECT p.doc_id, p.size, g.source_size, g.target, place,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS expected,
    CAST('0x' || substr(md5('mix-1:' || coalesce(p.source, '')), 1, 5) AS BIGINT) / CAST(1048576 AS DOUBLE) AS shift
  FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  CAST(floor((place + 1) * expected + shift) - floor(place * expected + shift) AS BIGINT) * size AS taken
FROM drawn"""


@query("op3_hilbert_neighbours")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query("op4_toxicity_nnpu")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_feistel_pseudonyms")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_personal_data(table(spark, sf_dir, "documents")).select("doc_id", "text", "replaced")


@query("op6_edit_matches")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_token_orc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(table(spark, sf_dir, "documents"))


@query("op8_page_wrappers")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query("op9_language_profiles")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(table(spark, sf_dir, "documents"))


@query("op10_hash_ring_shards")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op11_warc_bundles")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = warc.archive_facts(table(spark, sf_dir, "pages"))
    return facts.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op11_warc_bundles"] = """
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM rows)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts"""


@query("op12_wavelet_fim")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op12_wavelet_fim"] = """
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents),
hashed AS (
  SELECT *, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (n + 1) AS c2,
    CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
  FROM rows),
formed AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS z,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed),
parts AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, z - a) AS middle, substr(text, z + 1) AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""


@query("op13_pair_divergence")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op13_pair_divergence"] = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT r, lang, source, unnest(terms) AS term FROM rows),
vocabulary AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
languages AS (SELECT lang, count(*) AS v, CAST(sum(n) AS HUGEINT) AS total FROM vocabulary GROUP BY lang),
own AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN vocabulary USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM own GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(t.total, 0) AS total, l.v FROM (SELECT DISTINCT lang, source FROM rows) g
  LEFT JOIN totals t USING (lang, source) LEFT JOIN languages l USING (lang)),
shares AS (
  SELECT g.lang, g.source, v.term, coalesce(o.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
    1 + (1000000000::HUGEINT * (v.n + 2)) // (l.total + 2 * l.v) AS q
  FROM groups g JOIN vocabulary v USING (lang) JOIN languages l USING (lang) LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = v.term),
term_values AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q),
pair_values AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT s.lang, s.source, t.source AS other, sum(((s.p - t.p) * (s.p - t.p)) // (s.p + t.p)) AS value
    FROM shares s JOIN shares t ON s.lang = t.lang AND s.term = t.term AND s.source <> t.source GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.other = b.source),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM term_values UNION ALL SELECT * FROM pair_values))
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM numbered WHERE part = 'pair' OR rank <= 10"""
