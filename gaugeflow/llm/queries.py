"""One query per operator over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (
    clusters,
    decontamination,
    language,
    near_duplicates,
    packing,
    periodic_runs,
    pseudo_likelihood,
    quality,
    revisits,
    rules,
    secret_scan,
    token_file,
    wrappers,
)
from gaugeflow.llm.arrays import once
from gaugeflow.llm.ship import ship_package
from gaugeflow.session import shared_folder, write_out

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = shipped
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out() -> Column:
    """The quarter of the documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


@query("op2_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(documents(spark, sf_dir), tokenizer, plain_special=False)


@query("op5_token_file")
def tokens_in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-file")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_file.write_tokens(documents(spark, sf_dir), path, tokenizer, plain_special=False)
    return token_file.read_tokens(spark, path)


_STOP_WORDS_SQL = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)

RULES_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1)
  GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(words) AS n_words, list_sum([0] || list_transform(words, lambda x: length(x)))
           ::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(words, lambda x: list_contains([{_STOP_WORDS_SQL}], lower(x))))
           AS n_stop_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS n_bullet_lines
  FROM d LEFT JOIN repeated USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND n_words >= 50
  AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 15
  AND n_symbols / greatest(word_chars, 1) <= 0.1
  AND n_stop_words / greatest(n_words, 1) >= 0.02
  AND n_dup_lines / greatest(n_lines, 1) <= 0.5
  AND n_repeat_words / greatest(n_words, 1) <= 0.5
  AND n_bullet_lines / greatest(n_lines, 1) <= 0.9 AS kept
FROM failed"""


@query("op10_quality_rules", RULES_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(documents(spark, sf_dir))


DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS m,
         array_to_string(words[i:i + least(13, len(words)) - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
places AS (
  SELECT doc_id, m, i, array_to_string(words[i:i + m - 1], ' ') AS w
  FROM (SELECT doc_id, words, m, unnest(range(1, len(words) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM windows))),
hits AS (SELECT doc_id, item_id, i, m FROM places JOIN windows USING (m, w)),
n_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hits))
  GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN item USING (doc_id)"""


@query("op6_decontamination", DECONTAMINATION_SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(documents(spark, sf_dir), items)
    digest = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query("op8_secret_scan")
def secrets_in_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = secret_scan.train(secret_scan.labelled_samples(docs))
    found = secret_scan.find_secrets(docs, model)
    counts = [
        F.expr(f"size(filter(base_spans, x -> x.kind = {k}))").cast("long").alias(f"n_{kind}")
        for k, (kind, *_) in enumerate(secret_scan.BASE)
    ]
    digest = F.sha2(secret_scan.spans_text("base_spans"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secret_scan.spans_text("spans").alias("spans"))


@query("op4_language")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out())
    filters = language.train(docs.where("NOT held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), filters).drop("text")


@query("op9_near_duplicates")
def near_duplicate_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, sf_dir)).drop("node")


@query("op3_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = write_out(quality.with_statistics(documents(spark, sf_dir)), "statistics")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.where(~held_out()).groupBy("doc_id").agg(
        F.min("quality").alias("label"), F.max("quality").alias("other")
    )
    labels = labels.where("label = other").select("doc_id", "label")  # one label of each id
    model = quality.fit(measured.join(labels, "doc_id"))
    return quality.predict(measured, model).withColumn("held_out", held_out())


@query("op7_pseudo_likelihood")
def pseudo_likelihoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.pseudo_likelihood(documents(spark, sf_dir))


#: Seconds between the captures of two neighbouring pages, and until a page's revisit.
CAPTURE_EVERY, REVISIT_AFTER = 60, 86_400

#: An archive made of the pages: each is fetched, asked for again a day later under a variant of its
#: URL, with one of six kinds of validators, and its host's robots file is asked for; every fiftieth
#: time that is sent in full.
_ARCHIVE = f"""
SELECT inline(array(
  named_struct('record_id', concat('p', page_id), 'url', url, 'ts', page_id * {CAPTURE_EVERY},
    'kind', 'response', 'headers', map('Content-Type', 'text/html', 'Content-Length',
      cast(length(html) AS string), 'ETag', tag, 'Last-Modified', cast(page_id AS string),
      'Cache-Control', 'max-age=60'), 'body', html),
  named_struct('record_id', concat('v', page_id), 'url',
    CASE page_id % 3 WHEN 0 THEN concat(url, '#again') WHEN 1 THEN replace(url, 'http://', 'https://')
      ELSE url END,
    'ts', page_id * {CAPTURE_EVERY} + {REVISIT_AFTER}, 'kind', 'revisit', 'headers',
    map_filter(map('Date', cast(page_id AS string), 'content-length', '0',
      'cache-control', 'max-age=120',
      'etag', CASE page_id % 6 WHEN 3 THEN concat('W/', tag) WHEN 4 THEN '"other"'
              WHEN 5 THEN NULL ELSE tag END,
      'last-modified', CASE WHEN page_id % 6 = 5 THEN cast(page_id AS string) END),
      (k, v) -> v IS NOT NULL), 'body', cast(NULL AS string)),
  named_struct('record_id', concat('h', page_id), 'url',
    concat(regexp_extract(url, '^[a-z]+://[^/]*', 0), '/robots.txt'),
    'ts', page_id * {CAPTURE_EVERY}, 'kind', if(page_id % 50 = 0, 'response', 'revisit'),
    'headers', map('etag', '"1"', 'date', cast(page_id AS string)),
    'body', if(page_id % 50 = 0, concat('Disallow: /', page_id), NULL))))
FROM (SELECT *, concat('"', md5(html), '"') AS tag FROM {{pages}})"""

REVISITS_SQL = rf"""
WITH p AS (
  SELECT *, '"' || md5(html) || '"' AS tag,
    regexp_replace(lower(regexp_extract(url, '//([^/?#]*)', 1)), '^www\.', '') AS host,
    regexp_replace(regexp_extract(url, '//[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(
      string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS q
  FROM pages),
c AS (SELECT *, host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical FROM p),
responses AS (
  SELECT canonical, page_id * {CAPTURE_EVERY} AS ts, max('p' || page_id) AS refers_to,
         max_by(page_id, 'p' || page_id) AS of
  FROM c GROUP BY ALL
  UNION ALL
  SELECT host || '/robots.txt', page_id * {CAPTURE_EVERY}, 'h' || page_id, page_id
  FROM c WHERE page_id % 50 = 0),
revisits AS (
  SELECT 'v' || page_id AS record_id, page_id, canonical,
         page_id * {CAPTURE_EVERY} + {REVISIT_AFTER} AS ts,
         CASE page_id % 6 WHEN 4 THEN '"other"' WHEN 5 THEN NULL ELSE tag END AS tag,
         page_id % 6 = 3 AS weak, CASE WHEN page_id % 6 = 5 THEN page_id END AS modified
  FROM c
  UNION ALL
  SELECT 'h' || page_id, page_id, host || '/robots.txt', page_id * {CAPTURE_EVERY}, '"1"', false, NULL
  FROM c WHERE page_id % 50 <> 0),
found AS (
  SELECT v.*, r.ts AS refers_ts, r.refers_to, o.tag AS old_tag, o.page_id AS old_modified,
         o.html AS old_html, v.record_id LIKE 'h%' AS robots
  FROM revisits v ASOF LEFT JOIN responses r ON v.canonical = r.canonical AND v.ts > r.ts
  LEFT JOIN c o ON o.page_id = r.of),
judged AS (
  SELECT *, CASE WHEN refers_to IS NULL THEN 'no_response'
    WHEN robots OR tag = old_tag OR tag IS NULL AND modified = old_modified THEN 'resolved'
    ELSE 'changed' END AS outcome
  FROM found)
SELECT record_id, canonical, ts, outcome, refers_to, coalesce(refers_ts, -1) AS refers_ts,
  CASE WHEN robots THEN 'date=' || page_id || ';etag="1"'
    WHEN outcome = 'resolved' THEN 'cache-control=max-age=120;content-length=' || length(old_html)
      || ';content-type=text/html;date=' || page_id || ';etag=' || CASE WHEN weak THEN 'W/' ELSE '' END
      || old_tag || ';last-modified=' || old_modified
    ELSE 'cache-control=max-age=120;content-length=0;date=' || page_id
      || CASE WHEN tag IS NULL THEN '' ELSE ';etag=' || CASE WHEN weak THEN 'W/' ELSE '' END || tag END
      || CASE WHEN modified IS NULL THEN '' ELSE ';last-modified=' || modified END
  END AS headers,
  CASE WHEN outcome = 'resolved' THEN
    md5(CASE WHEN robots THEN 'Disallow: /' || substr(refers_to, 2) ELSE old_html END) END AS body_md5
FROM judged"""


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as records of a web archive."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return spark.sql(_ARCHIVE, pages=pages)


@query("op1_revisits", REVISITS_SQL)
def resolved_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive(spark, sf_dir)
    found = revisits.with_bodies(revisits.resolve_revisits(records), records)
    headers = F.expr("""array_join(transform(array_sort(map_entries(headers)),
        e -> concat(e.key, '=', e.value)), ';')""")
    columns = ["record_id", "canonical", "ts", "outcome", "refers_to"]
    columns.append(F.coalesce("refers_ts", F.lit(-1)).alias("refers_ts"))
    return found.select(*columns, headers.alias("headers"), F.md5("body").alias("body_md5"))


CENTROIDS, ROUNDS, SEED = 40, 5, "2"

_NEAREST = """{to} AS (
  SELECT i, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT i, c, list_sum(list_transform(list_zip(x, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
        FROM kept, {of}) GROUP BY i)"""

_MOVED = """c{n} AS (
  SELECT c, CASE WHEN s.m IS NULL THEN old.m ELSE s.m END AS m
  FROM c{o} old LEFT JOIN (
    SELECT c, list(v ORDER BY p) AS m
    FROM (SELECT a.c, p, ((sum(x[p]) - ((sum(x[p]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS v
          FROM a{o} a JOIN kept USING (i), range(1, 65) r(p) GROUP BY a.c, p) GROUP BY c) s USING (c))"""

CLUSTERS_SQL = (
    """
WITH kept AS (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda v: floor(v::DOUBLE * 256)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: isfinite(v))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('"""
    + f"{SEED}:' || vec_id)) - 1 AS c, x AS m FROM kept ORDER BY sha256('{SEED}:' || vec_id) LIMIT {CENTROIDS}), "
    + ", ".join(
        _NEAREST.format(to=f"a{n}", of=f"c{n}") + ", " + _MOVED.format(n=n + 1, o=n) for n in range(ROUNDS)
    )
    + ", "
    + _NEAREST.format(to="last", of=f"c{ROUNDS}")
    + f"""
SELECT vec_id, last.c::INT AS cluster, d AS distance,
       sum(d) OVER (PARTITION BY last.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM last JOIN kept USING (i) JOIN c{ROUNDS} z ON z.c = last.c"""
)


@query("op11_bisector_clusters", CLUSTERS_SQL)
def bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return clusters.clusters(vectors, CENTROIDS, ROUNDS, SEED)


@query("op12_wrapper_text")
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth text by the CRC of its id goes on periodically from some word to its end.

    With h the CRC, g = h div 10 and n words, word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + (n - a) div (3 + g % 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.expr("filter(split(text, '[ \\\\x09-\\\\x0D]+'), w -> w <> '')"))
    split = once(docs.select("doc_id", "text"), words=words, g=F.expr("crc32(cast(doc_id AS string)) div 10"))
    placed = once(split, a=F.expr("if(size(words) > 0, cast(g % size(words) AS int), NULL)"))
    placed = once(placed, p=F.expr("cast(1 + (size(words) - a) div (3 + g % 8) AS int)"))
    changed = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[a + (i - a) % p])), ' ')")
    return placed.select("doc_id", F.when(F.size("words") > 0, changed).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def runs_of_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(with_planted_runs(documents(spark, sf_dir))))
