"""The registered queries of the operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (curvepack, decontam, filteraudit, fingerprints, licenses, lines, neardup, ngramlm, passages, quality, rangecoder, resample,
               wordtable)
from .common import documents


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_range_coded_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rangecoder.digest(rangecoder.write_tokens(documents(spark, sf_dir), _tokenizer("word_bpe_49k.json")))


def op2_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curvepack.packed(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json")).drop("ids")


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir))


def op5_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeats(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", "text")


def op7_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contained(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found")


def op8_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op9_ngram_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramlm.lm_scores(documents(spark, sf_dir))


def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), size=2).select("doc_id", "n_shingles", "component_id", "kept")


def op11_word_table_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordtable.digests(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_range_coded_tokens, op2_ngram_quality, op3_curve_packing, op4_repeated_passages, op5_license_digests,
                            op6_fuzzy_lines, op7_benchmark_containment, op8_edit_fingerprints, op9_ngram_trie_scores,
                            op10_circulant_minhash, op11_word_table_bpe, op12_importance_resampling, op13_filter_audit, pipeline)}


def _license_sql() -> str:
    def canonical(text: str) -> str:
        c = f"regexp_replace(lower({text}), '{licenses._COPYRIGHT}', '', 'g')"
        c = f"regexp_replace({c}, '[^a-z0-9]+', ' ', 'g')"
        for a, b in licenses.SPELLINGS:
            c = f"replace({c}, '{a}', '{b}')"
        return f"sha256(trim({c}))"

    rows = [(k, n.format(name)) for k, names in licenses.NAMES.items() for name in names for n in licenses.NOTICES]
    rows += [(k, t) for k, t in licenses.TEXTS.items()] + [(k, t.split("\n\n", 1)[1]) for k, t in licenses.TEXTS.items()]
    quoted = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in rows)
    return f"""
WITH known AS (
  SELECT digest, min(license_id) AS license_id
  FROM (SELECT license_id, {canonical('t')} AS digest FROM (VALUES {quoted}) v(license_id, t)) GROUP BY digest),
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
line AS (SELECT row, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM d),
hit AS (SELECT row, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS l
        FROM line JOIN known ON known.digest = {canonical('line')} GROUP BY row)
SELECT d.doc_id, {canonical('d.text')} AS digest, known.license_id, coalesce(hit.l, '') AS line_licenses,
       CAST(coalesce(hit.n, 0) AS INTEGER) AS n_license_lines,
       CAST(len(regexp_extract_all(lower(d.text), '{licenses._COPYRIGHT}')) AS INTEGER) AS n_copyright_lines
FROM d LEFT JOIN known ON known.digest = {canonical('d.text')} LEFT JOIN hit ON hit.row = d.row"""


#: CRC-32 here is the xor, over a feature's bytes, of each byte's share at its distance from the end, and of the share of the length alone.
_RESAMPLE_SQL = """
WITH RECURSIVE bit AS (
  SELECT CAST(range AS BIGINT) AS b, CAST(range AS BIGINT) AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
tab AS MATERIALIZED (SELECT b, c FROM bit WHERE k = 8),
src AS (SELECT row_number() OVER () AS row, doc_id, text, 0 AS side FROM documents),
doc AS (SELECT * FROM src UNION ALL SELECT row_number() OVER (), 0, text, 1 FROM benchmark),
word AS MATERIALIZED (
  SELECT side, row, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM doc),
feat AS MATERIALIZED (
  SELECT side, row, array_to_string(w[i:i + n - 1], ' ') AS f, count(*) AS m
  FROM (SELECT side, row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM word, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n)
  GROUP BY ALL),
name AS MATERIALIZED (SELECT f, row_number() OVER () AS id, hex(encode(f)) AS h, CAST(octet_length(encode(f)) AS BIGINT) AS size
                      FROM (SELECT DISTINCT f FROM feat)),
longest AS (SELECT max(size) AS n FROM name),
share AS (
  SELECT CAST(0 AS BIGINT) AS d, b, c FROM tab
  UNION ALL SELECT s.d + 1, s.b, xor(tab.c, s.c >> 8) FROM share s JOIN tab ON tab.b = s.c % 256 WHERE s.d + 1 < (SELECT n FROM longest)),
blank AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST(4294967295 AS BIGINT) AS c
  UNION ALL SELECT z.n + 1, xor(tab.c, z.c >> 8) FROM blank z JOIN tab ON tab.b = z.c % 256 WHERE z.n < (SELECT n FROM longest)),
one AS (SELECT d, printf('%02X', b) AS h, c FROM share),
crc AS (
  SELECT x.id, bit_xor(one.c) AS c
  FROM (SELECT id, size - i AS d, substr(h, CAST(2 * i - 1 AS BIGINT), 2) AS h FROM (SELECT id, h, size, unnest(range(1, size + 1)) AS i FROM name)) x
  JOIN one ON one.d = x.d AND one.h = x.h GROUP BY x.id),
cell AS MATERIALIZED (
  SELECT name.f, xor(xor(crc.c, blank.c), 4294967295) % 10000 AS bucket
  FROM name JOIN crc ON crc.id = name.id JOIN blank ON blank.n = name.size),
hit AS MATERIALIZED (SELECT side, row, bucket, sum(m) AS m FROM feat JOIN cell ON cell.f = feat.f GROUP BY ALL),
total AS (SELECT coalesce(sum(m) FILTER (side = 0), 0) AS s, coalesce(sum(m) FILTER (side = 1), 0) AS t FROM hit),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(sum(m) FILTER (side = 1), 0) AS DOUBLE) + 1) * (CAST(any_value(total.s) AS DOUBLE) + 10000)
         / ((CAST(coalesce(sum(m) FILTER (side = 0), 0) AS DOUBLE) + 1) * (CAST(any_value(total.t) AS DOUBLE) + 10000)))) AS BIGINT) AS g
  FROM hit, total GROUP BY bucket),
weight AS (SELECT row, CAST(sum(m) AS BIGINT) AS n_features, CAST(sum(m * g) AS BIGINT) AS weight FROM hit JOIN gain USING (bucket) WHERE side = 0 GROUP BY row),
scored AS (
  SELECT word.row, doc_id, len(w) >= 20 AS eligible, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
         AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM word LEFT JOIN weight ON weight.row = word.row WHERE side = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS LAST) AS r, count(*) OVER (PARTITION BY eligible) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND r <= 5 * n // 100 THEN r END AS rank FROM ranked"""

_AUDIT_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
least AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
f AS (
  SELECT d.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 10 * length(d.text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN coalesce(d.doc_id, 9223372036854775807) > least.first THEN 'E' ELSE '' END AS failed
  FROM d JOIN least ON least.text = d.text LEFT JOIN l ON l.doc_id = d.doc_id),
p AS (SELECT part, good, toxic, failed, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || e.c || g.c || h.c AS filter_order FROM x a, x b, x e, x g, x h
      WHERE len(list_distinct([a.c, b.c, e.c, g.c, h.c])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, CAST(step AS BIGINT), 1) AS letter, '[' || left(filter_order, step - 1) || '_]' AS earlier
      FROM o, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step)),
c AS (SELECT part, filter_order, step, letter, failed, good, toxic, n, contains(failed, letter) AS fails, regexp_matches(failed, earlier) AS gone FROM p, s),
r AS (
  SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept,
         coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (failed = letter), 0) AS unique_fails, coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0) AS toxic_lost
  FROM c GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r"""


ORACLE_SQL = {
    "op12_importance_resampling": _RESAMPLE_SQL,
    "op13_filter_audit": _AUDIT_SQL,
    "op5_license_digests": _license_sql(),
    "op7_benchmark_containment": """
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM benchmark),
item AS (SELECT DISTINCT item_id, least(len(w), 5) AS size, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
           lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS s FROM b WHERE len(w) > 0),
total AS (SELECT item_id, count(*) AS n FROM item GROUP BY item_id),
size AS (SELECT DISTINCT size FROM item),
shingle AS (SELECT DISTINCT doc_id, size, unnest(list_transform(range(1, len(w) - size + 2),
              lambda i: array_to_string(w[i:i + size - 1], ' '))) AS s FROM d, size WHERE len(w) >= size)
SELECT doc_id, item_id, CAST(any_value(n) AS INTEGER) AS n_shingles, CAST(count(*) AS INTEGER) AS n_found
FROM shingle JOIN item USING (size, s) JOIN total USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) * 100 >= any_value(n) * 80""",
}
