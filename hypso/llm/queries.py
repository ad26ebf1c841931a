"""The queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe_chunks, dedup_exact, langid, minhash, packing, quality, sharding, tokencount, urlfilter
from .shared import file_bytes, release, scratch, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search_table(table(spark, sf_dir, "embeddings"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), file_bytes(WORD_BPE))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), 24)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact.exact_dedup(table(spark, sf_dir, "documents"))


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Labelled outcomes of pages: the labels table has them by id; a page is bad if toxic or of low quality."""
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    return labels.select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), page_outcomes(table(spark, sf_dir, "labels")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted twice through a cache that begins empty: the first time each distinct text is a miss and is encoded,
    the second time all counts that are returned are hits."""
    docs, model, cache = table(spark, sf_dir, "documents"), file_bytes(PIECE_BPE), scratch(spark, "token-cache")
    tokencount.count_tokens(docs, model, cache)
    release(spark)
    return tokencount.count_tokens(docs, model, cache)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.encode(table(spark, sf_dir, "documents"), file_bytes(WORD_BPE), digests=True)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_language, op2_neighbours, op3_packing, op4_sharding, op5_exact_dedup, op6_url_filter, op7_token_counts, op8_bpe, op9_near_duplicates, op10_quality)
    return {f.__name__: f for f in own}


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_OP5 = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')) AS text_sha256 FROM documents)
WINDOW w AS (PARTITION BY text_sha256)
"""


def _weight_sql(level: str) -> str:
    low, high = urlfilter.WEIGHTS
    return f"""SELECT CASE WHEN spread > noise THEN greatest({low}::DOUBLE, least({high}::DOUBLE, rate * (1 - rate) / (spread - noise) - 1)) ELSE {high}::DOUBLE END AS m
    FROM (SELECT rate, sq - rate * rate AS spread, rate * (1 - rate) * k / total AS noise FROM (
      SELECT sum(bad)::DOUBLE / sum(n) AS rate, sum(n * (bad::DOUBLE / n) * (bad::DOUBLE / n)) / sum(n) AS sq, count(*) AS k, sum(n) AS total FROM {level}))"""


def _rules_sql() -> tuple[str, str]:
    rule, verdict = [], []
    for told, r in sorted(urlfilter.RULES, key=lambda x: (-len(x[1]), x[1])):
        own, _, rest = r.partition("/")
        fits = f"(host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '/{rest}')"
        rule.append(f"WHEN {fits} THEN '{r}'")
        verdict.append(f"WHEN {fits} THEN '{told}'")
    return "CASE " + " ".join(rule) + " END", "CASE " + " ".join(verdict) + " END"


def _op6() -> str:
    rule, verdict = _rules_sql()
    x = 0.5
    two = ", ".join(f"'{s}'" for s in urlfilter.TWO_LABEL)
    return f"""
WITH RECURSIVE u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substring(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
told AS (SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
h0 AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM p JOIN told USING (page_id) WHERE host <> '' GROUP BY 1),
h1 AS (SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS l FROM h0),
h2 AS (SELECT *, array_to_string(list_slice(l, greatest(1, len(l) - 1), len(l)), '.') AS last2 FROM h1),
hosts AS (SELECT host, n, bad, CASE WHEN last2 IN ({two}) THEN last2 ELSE l[len(l)] END AS suffix,
                 CASE WHEN last2 IN ({two}) THEN array_to_string(list_slice(l, greatest(1, len(l) - 2), len(l)), '.') ELSE last2 END AS domain FROM h2),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY 1),
w0 AS ({_weight_sql("suffixes")}), w1 AS ({_weight_sql("domains")}), w2 AS ({_weight_sql("hosts")}),
s AS (SELECT suffix, (bad + w0.m * p0) / (n + w0.m) AS ps FROM suffixes, w0, (SELECT sum(bad)::DOUBLE / sum(n) AS p0 FROM suffixes)),
d AS (SELECT domain, suffix, (bad + w1.m * ps) / (n + w1.m) AS pd FROM domains JOIN s USING (suffix), w1),
post AS (SELECT host, bad + w2.m * pd AS a, n - bad + w2.m * (1 - pd) AS b FROM hosts JOIN d USING (suffix, domain), w2),
near AS (SELECT *, {x}::DOUBLE < (a + 1) / (a + b + 2) AS near FROM post WHERE a + b <= {urlfilter.EVIDENCE}::DOUBLE),
side AS (SELECT host, near, CASE WHEN near THEN a ELSE b END AS p, CASE WHEN near THEN b ELSE a END AS q, CASE WHEN near THEN {x}::DOUBLE ELSE {1 - x}::DOUBLE END AS x FROM near),
cf(host, near, p, q, x, m, c, d, h) AS (
  SELECT host, near, p, q, x, 1, 1::DOUBLE, 1 / (1 - (p + q) * x / (p + 1)), 1 / (1 - (p + q) * x / (p + 1)) FROM side
  UNION ALL SELECT host, near, p, q, x, m + 1, c2, 1 / (1 + odd * d1), h * d1 * c1 * c2 / (1 + odd * d1) FROM
    (SELECT *, 1 + odd / c1 AS c2 FROM (SELECT *, 1 / (1 + even * d) AS d1, 1 + even / c AS c1 FROM
      (SELECT *, m * (q - m) * x / ((p - 1 + 2 * m) * (p + 2 * m)) AS even, -(p + m) * (p + q + m) * x / ((p + 2 * m) * (p + 1 + 2 * m)) AS odd FROM cf WHERE m <= {urlfilter.STEPS})))),
tail AS (SELECT host, near, exp(p * ln(x) + q * ln(1 - x) + lgamma(p + q) - lgamma(p) - lgamma(q)) * h / p AS t FROM cf WHERE m = {urlfilter.STEPS} + 1),
blocked AS (SELECT host FROM tail WHERE CASE WHEN near THEN t ELSE 1 - t END < {urlfilter.SHARE}::DOUBLE UNION ALL
  SELECT host FROM post WHERE a + b > {urlfilter.EVIDENCE}::DOUBLE AND a / (a + b) - {urlfilter.NORMAL}::DOUBLE * sqrt(a / (a + b) * (b / (a + b)) / (a + b + 1)) > {x}::DOUBLE)
SELECT page_id, host, path, {rule} AS rule,
       coalesce({verdict}, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": _OP5, "op6_url_filter": _op6()}
