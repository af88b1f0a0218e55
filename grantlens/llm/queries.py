"""The registered queries of this package, ``name -> f(spark, folder)``, and their SQL where there is one."""

import public_tokenizers
from pyspark.sql import functions as F

from grantlens.llm import (
    alignment, graph_search, html_extraction, language, minhash, mixing, packing, pivot_codes, positional_index, rotation_codes,
    token_shards, url_filter, warc,
)
from grantlens.sources.storage import written

QUERIES = {}
ORACLES = {}

BLOCK = [("net", "/"), ("example.com", "/de/")]
ALLOW = [("example.net", "/en/"), ("org", "/fr/")]


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@register
def op5_mixing(spark, folder):
    # The words of each text are counted once; the numbers are read again in its place.
    counted = mixing.word_count(F.col("text")).alias("words")
    documents = written(table(spark, folder, "documents").select("doc_id", "source", counted), "mix-sizes")
    return mixing.mix(documents, size="words").select(
        "doc_id",
        F.col("_mix_size").alias("size"),
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_copies") * F.col("_mix_size")).alias("taken"),
    )


ORACLES["op5_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
ranked AS (
  SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w,
         CAST(sum(s) OVER () AS BIGINT) AS everything, 2 * s AS cap
  FROM totals),
filling AS (
  SELECT *, everything * 150 - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 100 AS remaining,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM ranked WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST)),
capped AS (SELECT *, cap * weights * 100 <= remaining * w AS is_full FROM filling),
shared AS (
  SELECT arg_max(remaining, weights) AS remaining, max(weights) AS weights FROM capped WHERE NOT is_full),
targets AS (
  SELECT c.source, c.s, CASE WHEN is_full THEN CAST(cap AS DOUBLE)
         ELSE CAST(CAST(shared.remaining * w AS BIGINT) AS DOUBLE) / CAST(CAST(shared.weights * 100 AS BIGINT) AS DOUBLE) END AS target,
         CAST(('0x' || substr(md5('17:' || coalesce(c.source, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS shift
  FROM capped c LEFT JOIN shared ON true),
placed AS (
  SELECT z.*, t.s, t.target, t.shift, CASE WHEN t.s > 0 THEN t.target / t.s ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY z.source ORDER BY floor(sqrt(size)),
                            coalesce(((doc_id % 64) + 64) % 64, 0), size, doc_id NULLS FIRST) AS place
  FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, s AS source_size, target,
       CAST(least(floor(rate * place + shift) - floor(rate * (place - 1) + shift), 2) AS BIGINT) * size AS taken
FROM placed
"""


@register
def op6_url_filters(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, BLOCK, ALLOW)
    names = ["host", "path", "rule", "verdict"]
    return judged.select("page_id", *[F.col(f"_url_{n}").alias(n) for n in names])


ORACLES["op6_url_filters"] = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN
           translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(rule_host, rule_path, says) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fitting AS (
  SELECT p.*, rule_host || rule_path AS rule, says,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS n
  FROM parts p LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM fitting WHERE n = 1
"""


@register
def op4_minhash(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"))


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@register
def op3_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), WORD_BPE)


@register
def op8_token_shards(spark, folder):
    place = token_shards.new_folder(spark)
    token_shards.write_shards(table(spark, folder, "documents"), place, WORD_BPE)
    return token_shards.list_shards(spark, place)


@register
def op9_language(spark, folder):
    documents = table(spark, folder, "documents")
    held_out = language.is_held_out(F.col("doc_id"))
    trees = language.learn_trees(documents.filter(~held_out))
    found = language.predict_language(documents.select("doc_id", held_out.alias("held_out"), "text"), trees)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


@register
def op1_rotation_codes(spark, folder):
    return rotation_codes.near_vectors(table(spark, folder, "embeddings"))


@register
def op7_graph_search(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return graph_search.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


@register
def op2_warc(spark, folder):
    place = warc.new_folder(spark)
    warc.write_archives(table(spark, folder, "pages"), place)
    return warc.page_records(warc.read_chunks(spark, place))


@register
def op10_html_extraction(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = html_extraction.extract_text(pages, html_extraction.learn_chain(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.col("main_chars").alias("n_chars"))


@register
def op11_positional_index(spark, folder):
    return positional_index.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

ORACLES["op11_positional_index"] = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, words[i : i + least(10, len(words)) - 1] AS w
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
starts AS (
  SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS i
  FROM docs, (SELECT DISTINCT len(w) AS width FROM windows)),
found AS (
  SELECT doc_id, i, width, item_id FROM (SELECT doc_id, i, width, words[i : i + width - 1] AS w FROM starts) JOIN windows USING (w)),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(range(i, i + width)) AS place FROM (SELECT DISTINCT doc_id, i, width FROM found)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@register
def op12_pivot_codes(spark, folder):
    return pivot_codes.compress(table(spark, folder, "embeddings"))


def _pivot_codes_sql():
    """Every distance in full; part length 4, as the table has vectors of 64."""
    square = " + ".join(f"(v[{i}] - w[{i}]) * (v[{i}] - w[{i}])" for i in range(1, 5))
    mean = ", ".join(f"CAST(floor(sum(v[{i}]) / count(*)) AS BIGINT)" for i in range(1, 5))
    steps = []
    for n in range(3):
        steps.append(f"""near{n} AS (
  SELECT vec_id, label, p, any_value(v) AS v, min(CAST({square} AS BIGINT)) AS d, arg_min(e, CAST({square} AS BIGINT) * 64 + e) AS e
  FROM parts JOIN book{n} USING (p) GROUP BY vec_id, label, p)""")
        if n < 2:
            steps.append(f"""book{n + 1} AS (
  SELECT p, e, coalesce(any_value(m), any_value(w)) AS w FROM book{n}
  LEFT JOIN (SELECT p, e, [{mean}] AS m FROM near{n} GROUP BY p, e) USING (p, e) GROUP BY p, e)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS q FROM embeddings
  WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
parts AS (SELECT vec_id, label, p, q[p * 4 + 1 : p * 4 + 4] AS v FROM kept, range(16) t(p)),
book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v AS w FROM parts
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 64),
{",".join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near2 GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded
"""


ORACLES["op12_pivot_codes"] = _pivot_codes_sql()


@register
def op13_alignment(spark, folder):
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(table(spark, folder, "documents"), *files)
