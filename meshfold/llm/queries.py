"""One thin query per operator: it applies the operator to its whole table and derives
the digest columns from the operator's result."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshfold.llm import (binpacking, ctw, decontaminate, importance, packing, pii, quality, runs, simhash, tokenfiles,
                          tokens, urlfilter, warc, whitening)
from meshfold.llm.common import fold, store, table
from meshfold.llm.registry import query
from meshfold.session import new_folder


@query("op8_token_files")
def token_files(spark, sf_dir):
    folder = new_folder(spark, "token-files")
    tokenfiles.write(table(spark, sf_dir, "documents"), folder, tokens.word_bpe_path())
    return tokenfiles.read(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op1_lexical_packing")
def lexical_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokens.word_bpe_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query("op5_simhash_trie")
def simhash_trie(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION_SQL = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
place AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hit AS (SELECT doc_id, k, i, item FROM place JOIN windows USING (k, g)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op3_decontamination", DECONTAMINATION_SQL)
def decontamination(spark, sf_dir):
    marked = decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                names=("n_words", "hits", "found_items"))
    return marked.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.size("found_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found_items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


@query("op7_positive_unlabelled")
def positive_unlabelled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, weights)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


#: The key of the registered query; a real run sets its own in the session.
PII_KEY = "a key for the registered query"


def pii_key(spark) -> bytes:
    return spark.conf.get("meshfold.pii.key", PII_KEY).encode()


@query("op2_feistel_pseudonyms")
def feistel_pseudonyms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii_key(spark), count="n_values")


@query("op6_hashed_ngram_ratio")
def hashed_ngram_ratio(spark, sf_dir):
    return importance.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Fixed values of the contract, and the names whose hosts are listed.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
LISTED = r"(^|\.)(casino-win|free-bets|cheap-pills|ads-track|spam-farm|adult-x)\."
URL_SQL = rf"""
WITH p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(host, '{LISTED}') THEN 'block' ELSE 'allow' END AS verdict
FROM r"""


@query("op9_bloom_cascade", URL_SQL)
def bloom_cascade(spark, sf_dir):
    url = F.col("url")
    pages = table(spark, sf_dir, "pages").select("page_id", urlfilter.host(url).alias("host"),
                                                 urlfilter.path(url).alias("path"))
    pages = pages.withColumn("key", F.concat("host", "path"))
    listed = pages.where(F.col("host").rlike(LISTED)).select("key")
    rule, verdict = urlfilter.rule_of(F.col("host"), F.col("path"), RULES)
    return urlfilter.is_listed(pages, "key", listed).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)"""


@query("op10_warc_normaliser", WARC_SQL)
def warc_normaliser(spark, sf_dir):
    streams, archives = new_folder(spark, "warc-streams"), new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), streams)
    warc.normalise_all(spark, streams, archives)
    return warc.read(spark, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_context_tree_weighting")
def context_tree_weighting(spark, sf_dir):
    return ctw.score(table(spark, sf_dir, "documents"))


def with_planted_runs(docs):
    """Texts in which, where the crc32 h of the id ends in 0, the words from a = g % n on (g = h // 10) repeat the
    first p = 1 + (n - a) // (3 + g % 8) of them to the end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    cut = docs.select("doc_id", "text", (h % 10 == 0).alias("planted"), F.floor(h / 10).alias("g"),
                      F.when(h % 10 == 0, words).alias("words"))
    cut = cut.withColumn("n", F.size("words")).withColumn("a", F.expr("int(if(n > 0, g % n, 0))"))
    cut = cut.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    repeated = F.expr("array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), "
                      "int(ceil((n - a) / p)))), 1, n - a)), ' ')")
    return cut.select("doc_id", F.when(F.col("planted") & (F.col("n") > 0), repeated).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def periodic_runs(spark, sf_dir):
    marked = runs.mark(with_planted_runs(table(spark, sf_dir, "documents")), names=("n", "runs", "collapsed"))
    # The first of the greatest length / period: the runs are in order, so a later one has to be greater.
    best = F.expr("aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (best, r) -> "
                  "if(best is null or r.length * best.period > best.length * r.period, r, best))")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return marked.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@query("op11_hierarchical_best_fit")
def hierarchical_best_fit(spark, sf_dir):
    pieces = binpacking.pack(table(spark, sf_dir, "documents"), tokens.word_bpe_path())
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query("op12_block_matrix_whitening")
def block_matrix_whitening(spark, sf_dir):
    rows, model = whitening.whiten(table(spark, sf_dir, "embeddings"))
    found = 0 if model is None else len(model.values)
    rows = store(rows, "whitened")
    error = whitening.identity_error(rows, found) if found else 0.0
    shares = F.array(*[F.lit(float(v)) for v in model.explained]) if found else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation", "whitened", F.get(shares, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))
