"""The named queries of the operators over their whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.llm import (bpe, collocations, fuzzy_hash, licenses, mixing, paragraphs, pii, quality, resampling, simhash, topk,
                            toxicity, url_filter)
from riskstream.llm.common import table

#: The rules that every page is judged by.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    return url_filter.judge_urls(spark, table(spark, sf_dir, "pages"), rules)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return topk.top_k(vectors.where("vec_id % 20 = 0"), vectors)


def op5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, its text without repeated paragraphs and passages, and how many words were cut."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return paragraphs.drop_repeated_paragraphs(docs, counted="n_removed")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_fuzzy_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_hash.fingerprint_edits(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_toxicity, op3_simhash, op4_topk, op5_paragraphs, op6_bpe, op7_mixing,
                            op8_fuzzy_hash, op9_quality, op10_licenses, op11_pii, op12_collocations, op13_resampling)}


def _url_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    return f"""
WITH parsed AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         row_number() OVER () AS row_no
  FROM pages),
rules(rule_host, rule_path, action) AS (VALUES {rules}),
fits AS (
  SELECT row_no, rule_host || rule_path AS rule, action,
         row_number() OVER (PARTITION BY row_no ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parsed LEFT JOIN (SELECT * FROM fits WHERE place = 1) f USING (row_no)"""


TOPK_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64.0 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 20"""

MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')) AS h
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, 2.0::DOUBLE * source_size AS cap,
         [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS w
  FROM sources),
levels AS (
  SELECT *, row_number() OVER o AS place,
         (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM ranked WINDOW o AS (ORDER BY cap / w, rank)),
targets AS (
  SELECT source, source_size,
         coalesce(least(cap, CASE WHEN cap > 0 THEN (SELECT arg_min(level, place) FROM levels WHERE level * w < cap) * w END), 0.0)::DOUBLE AS target
  FROM levels),
plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM targets),
summed AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.copies, p.target - p.copies * p.source_size AS budget,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS upto,
         (sum(d.size) OVER (PARTITION BY d.source, d.h))::BIGINT AS tied
  FROM docs d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       size * (copies + CASE WHEN budget > 0 AND (upto <= budget OR upto - budget < budget - (upto - tied)) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM summed"""


def _license_sql() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def canonical(column: str) -> str:
        sql = f"trim(regexp_replace(lower(regexp_replace({column}, {text(licenses.COPYRIGHT_LINE)}, ' ', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        sql = f"' ' || replace({sql}, ' ', '  ') || ' '"
        for other, one in licenses.EQUIVALENT:
            sql = f"replace({sql}, ' {other.replace(' ', '  ')} ', ' {one.replace(' ', '  ')} ')"
        return f"trim(replace({sql}, '  ', ' '))"

    known = ", ".join(f"({text(name)}, {text(words)})" for name, words in licenses.KNOWN)
    return f"""
WITH known AS (SELECT {canonical('words')} AS words, min(license) AS license FROM (VALUES {known}) k(license, words) GROUP BY 1),
docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_no FROM documents),
units AS (
  SELECT row_no, TRUE AS entire, text AS unit FROM docs
  UNION ALL SELECT row_no, FALSE, unnest(regexp_split_to_array(text, '\\n\\s*\\n')) FROM docs WHERE regexp_matches(text, '\\n\\s*\\n')
  UNION ALL SELECT row_no, FALSE, unnest(string_split(text, chr(10))) FROM docs WHERE contains(text, chr(10))),
found AS (
  SELECT row_no, min(license) FILTER (WHERE entire) AS license, count(*) AS n,
         array_to_string(list_sort(list_distinct(list(license))), ',') AS licenses
  FROM units JOIN known ON {canonical('unit')} = known.words GROUP BY row_no)
SELECT doc_id, license, coalesce(licenses, '') AS licenses, coalesce(n, 0)::BIGINT AS n_matches
FROM docs LEFT JOIN found USING (row_no)"""


COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
phrases AS (
  SELECT lang, p, count(*) AS f FROM (
    SELECT lang, unnest(list_concat(list_transform(w, lambda x: [x]), list_transform(range(1, len(w)), lambda i: w[i:i + 1]),
                                    list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]))) AS p FROM words) GROUP BY ALL),
sizes AS (SELECT lang, sum(f) FILTER (WHERE len(p) = 1)::BIGINT AS n FROM phrases GROUP BY lang),
candidates AS (SELECT * FROM phrases WHERE len(p) >= 2 AND f >= 10),
longer AS (
  SELECT lang, q, max(f) AS longest FROM (SELECT lang, unnest([p[1:2], p[2:3]]) AS q, f FROM candidates WHERE len(p) = 3) GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.p, c.f, k, l.f AS l, r.f AS r, (1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
  JOIN phrases l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN phrases r ON r.lang = c.lang AND r.p = c.p[k + 1:]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
  SELECT lowest.lang, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, f DESC, array_to_string(p, ' ')) AS rank,
         array_to_string(p, ' ') AS phrase, f AS a, l, r, score::BIGINT AS score
  FROM lowest LEFT JOIN longer ON longer.lang = lowest.lang AND q = p
  WHERE longest IS NULL OR 100 * longest < 50 * f)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""

RESAMPLE_SQL = r"""
WITH bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i::BIGINT], [0::BIGINT,0,0,0,0,0,0,0]), lambda c, x: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (
  SELECT row_number() OVER () AS r, doc_id, TRUE AS source, text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, FALSE, text FROM benchmark),
words AS (
  SELECT r, doc_id, source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
features AS (
  SELECT r, source, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
hashed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(strlen(f)), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT)),
                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM features), bits),
placed AS (SELECT r, source, bucket FROM features JOIN hashed USING (f)),
totals AS (SELECT count(*) FILTER (WHERE source) AS all_s, count(*) FILTER (WHERE NOT source) AS all_t FROM placed),
gains AS (
  SELECT bucket, floor(1000.0::DOUBLE * ln((count(*) FILTER (WHERE NOT source) + 1)::DOUBLE * (any_value(all_s) + 10000)::DOUBLE
                          / ((count(*) FILTER (WHERE source) + 1)::DOUBLE * (any_value(all_t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM placed, totals GROUP BY bucket),
weights AS (SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE source GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score
  FROM words LEFT JOIN weights USING (r) WHERE source),
drawn AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM drawn) * 25 // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": _url_sql(), "op4_topk": TOPK_SQL, "op7_mixing": MIX_SQL, "op10_licenses": _license_sql(),
            "op12_collocations": COLLOCATION_SQL, "op13_resampling": RESAMPLE_SQL}
