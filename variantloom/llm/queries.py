"""The registered queries of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dedup, idfiles, lm, mixing, packing, pii, quality, rules, setjoin, urls
from .common import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.link_texts(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.groups(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).drop("text")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "ids")
    idfiles.write(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"))
    return idfiles.digest(idfiles.read(spark, path))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("spark.variantloom.surrogate.key", None)
    return pii.surrogates(table(spark, sf_dir, "documents"), key.encode() if key else pii.KEY)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_lm_scoring, op2_ngram_join, op3_exact_dedup, op4_url_filters, op5_mixing, op6_quality_rules, op7_packing, op8_token_files, op9_pii_surrogates, op10_quality_classifier)}

_SPACE = "[\\x20\\x09-\\x0D]"

OP3 = f"""
WITH h AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept, text_sha256
FROM h
"""

_OWN = " OR ".join(f"regexp_matches(lower(url), '{r.pattern}')" for r in urls.OWN)
_LISTED = ", ".join(f"('{r.name}', '{r.verdict}')" for r in urls.LISTED)
OP4 = f"""
WITH a AS (SELECT page_id, coalesce(url, '') AS url, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
l(rule, verdict) AS (VALUES {_LISTED}),
m AS (SELECT page_id, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, verdict) AS k
      FROM p JOIN l ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
                   AND starts_with(path, substring(rule, instr(rule, '/'))))
SELECT p.page_id, host, path, m.rule, coalesce(m.verdict, CASE WHEN {_OWN} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.k = 1
"""

_FILLS = ",\n".join(f"""f{i} AS (SELECT b.source, b.hash, b.words FROM b JOIN n{i} ON b.source IS NOT DISTINCT FROM n{i}.source
       WHERE NOT under AND words > 0 AND {"abs(words - need) < need" if i == mixing.FILLS - 1 else "words <= need"}{''.join(f" AND NOT EXISTS (SELECT 1 FROM f{j} WHERE f{j}.source IS NOT DISTINCT FROM b.source AND f{j}.hash = b.hash)" for j in range(i))}
       QUALIFY row_number() OVER (PARTITION BY b.source ORDER BY abs(words - need), b.hash) = 1),
n{i + 1} AS (SELECT n{i}.source, need - coalesce(words, 0) AS need FROM n{i} LEFT JOIN f{i} ON n{i}.source IS NOT DISTINCT FROM f{i}.source)""" for i in range(mixing.FILLS))
_FILLED = "".join(f" UNION ALL SELECT source, hash FROM f{i}" for i in range(mixing.FILLS))
OP5 = f"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> ''))::BIGINT AS size FROM documents),
h AS (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || size::VARCHAR), 1, 15))::BIGINT AS hash FROM d),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight, (3 * source_size)::DOUBLE AS cap FROM s0),
s2 AS (SELECT *, cap / weight AS ratio FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER w, 0.0::DOUBLE) AS remaining, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0::DOUBLE) AS shares
       FROM s2 WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, arg_min(remaining / shares, ratio) FILTER (WHERE remaining / shares <= ratio) OVER () AS water FROM s3),
s5 AS (SELECT *, round(least(cap, water * weight), 6) AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size))::BIGINT ELSE 0 END AS whole FROM s5),
s7 AS (SELECT *, target - whole * source_size AS rest FROM s6),
k AS (SELECT source, hash, any_value(size) AS one, sum(size) AS words FROM h GROUP BY source, hash),
c AS (SELECT k.source, hash, one, words, sum(words) OVER (PARTITION BY k.source ORDER BY hash) AS upto, rest FROM k JOIN s7 ON k.source IS NOT DISTINCT FROM s7.source WHERE rest > 0),
m0 AS (SELECT source, any_value(rest) - coalesce(sum(words) FILTER (WHERE upto < rest), 0) AS need FROM c GROUP BY source),
c2 AS (SELECT c.source, hash, words, need, sum(words) OVER (PARTITION BY c.source ORDER BY hash) AS upto FROM c JOIN m0 ON c.source IS NOT DISTINCT FROM m0.source WHERE c.upto >= rest AND words > 0 AND one <= floor(need / {mixing.SHORT})),
b AS (SELECT c.source, c.hash, c.words, c.upto < rest OR coalesce(c2.upto < c2.need, false) AS under FROM c LEFT JOIN c2 ON c.source IS NOT DISTINCT FROM c2.source AND c.hash = c2.hash),
n0 AS (SELECT m0.source, need - coalesce((SELECT sum(words) FROM c2 WHERE c2.source IS NOT DISTINCT FROM m0.source AND c2.upto < c2.need), 0) AS need FROM m0),
{_FILLS},
e AS (SELECT source, hash FROM b WHERE under{_FILLED})
SELECT h.doc_id, h.size, s7.source_size, s7.target, (h.size * (s7.whole + (e.hash IS NOT NULL)::BIGINT))::BIGINT AS taken
FROM h JOIN s7 ON h.source IS NOT DISTINCT FROM s7.source LEFT JOIN e ON h.source IS NOT DISTINCT FROM e.source AND h.hash = e.hash
"""

_BAD = " OR ".join(f"regexp_matches(x, '{p}')" for p in (rules.NAVIGATION, rules.PUNCTUATION, rules.BOILERPLATE))
OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda x: x <> '') AS words FROM d),
g AS (SELECT r, i, unnest(list_transform(range(1, len(words) - 3), lambda j: array_to_string(words[j:j + 4], ' '))) AS gram, unnest(range(1, len(words) - 3)) AS j FROM w, (SELECT 0 AS i)),
t AS (SELECT r, j, count(*) OVER (PARTITION BY r, gram) AS times FROM g),
u AS (SELECT r, least(5, coalesce(lead(j) OVER (PARTITION BY r ORDER BY j) - j, 5)) AS covers FROM t WHERE times > 1),
v AS (SELECT r, sum(covers)::BIGINT AS again FROM u GROUP BY r),
l AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
m AS (SELECT r, (len(lines) - len(list_distinct(lines)))::BIGINT AS dup, length(regexp_replace(array_to_string(list_filter(lines, lambda x: NOT ({_BAD})), chr(10)), '{_SPACE}', '', 'g')) AS clean FROM l),
a AS (SELECT d.doc_id, len(w.words)::BIGINT AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, dup AS n_dup_lines, coalesce(again, 0) AS n_repeat_words, clean
      FROM d JOIN w USING (r) JOIN m USING (r) LEFT JOIN v USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND clean >= {rules.LEAST_KEPT} * word_chars AS kept
FROM a
"""

ORACLES = {"op3_exact_dedup": OP3, "op4_url_filters": OP4, "op5_mixing": OP5, "op6_quality_rules": OP6}
