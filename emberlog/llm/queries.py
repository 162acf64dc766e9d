"""Registered queries of the operators here, and their oracle where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import decontaminate, fingerprints, hmm, mixing, multiindex, nearcopies, secrets, sharding, spelling, suffixes, toxicity, warc, whitening
from emberlog.llm.tables import id_fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"), id_fold("doc_id", 10) == 0)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    out = toxicity.score(docs, model)
    return out.select("doc_id", (id_fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@query
def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op9_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_duplicates(table(spark, sf_dir, "documents"), num=85, den=100)


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


@query
def op11_nearest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.nearest_rows(table(spark, sf_dir, "embeddings"), every=20)


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


ORACLES["op10_warc"] = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""

# crc32 over UTF-8 bytes from a table made by its rule; near words meet by the place and the rest of a cut letter
ORACLES["op12_spelling_variants"] = """WITH RECURSIVE bits AS (SELECT range AS i, range::UBIGINT AS c, 0 AS k FROM range(256)
 UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{6,}')) AS run FROM documents),
d AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM r GROUP BY 1, 2),
b AS (SELECT run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::UBIGINT] ELSE [195::UBIGINT, (unicode(c) - 64)::UBIGINT] END)) AS s FROM d),
h AS (SELECT run, n, xor(list_reduce(s, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255)::BIGINT + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT)::BIGINT AS h FROM b, tab),
v AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n FROM h GROUP BY 1),
w AS (SELECT word, n FROM v WHERE length(word) >= 6 AND n >= 5),
k AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n FROM k a JOIN k b ON a.cut = b.cut AND a.i = b.i AND length(a.word) = length(b.word) AND a.word <> b.word
 UNION SELECT k.word, w.word, w.n FROM k JOIN w ON w.word = k.cut UNION SELECT w.word, k.word, k.n FROM k JOIN w ON w.word = k.cut),
f AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS best, max(n) AS best_n FROM p GROUP BY word),
g AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n FROM w LEFT JOIN f USING (word)),
c AS (SELECT word, word AS root, 0 AS step FROM g UNION ALL SELECT c.word, g.form, step + 1 FROM c JOIN g ON g.word = c.root WHERE g.form IS NOT NULL)
SELECT word, form, arg_max(root, step) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n FROM g JOIN c USING (word) GROUP BY word, form"""
