"""The thin queries of the text operators, over whole tables, and the SQL that some must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relfold.llm import bpe, crosstoken, decontaminate, infill, langid, lm, mixing, quality, secrets, simhash, styletree, substrings, urlfilter
from relfold.llm.common import id_crc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from those whose id's crc32 is no multiple of 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = langid.learn_prototypes(docs.where(id_crc("doc_id", 5) != 0))
    found = langid.identify(docs, prototypes)
    return found.select(F.col("id").alias("doc_id"), (id_crc("id", 5) == 0).alias("held_out"), "lang_pred", "score")


@query
def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds within the error budget."""
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "distance", "start", "end")


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of the sources by weight takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "epochs", "part")


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.scan(table(spark, sf_dir, "documents")).drop("redacted").withColumnRenamed("id", "doc_id")


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return near.select(F.col("id").alias("doc_id"), simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


# Fixed rules of the query: the longest that fits decides.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
# Names whose hosts are listed for blocking.
LISTED_NAMES = ["ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x"]


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: by the longest fitting rule, else by the cascade of listed hosts."""
    urls = table(spark, sf_dir, "pages").select("page_id", urlfilter.host_of(F.col("url")).alias("host"), urlfilter.path_of(F.col("url")).alias("path"))
    hosts = urls.select("host")
    listed = hosts.where(F.arrays_overlap(F.split("host", r"\."), F.array(*[F.lit(n) for n in LISTED_NAMES])))
    marked = urlfilter.mark_listed(urls, "host", urlfilter.cascades(listed, hosts, "host"))
    ruled = marked.withColumn("r", urlfilter.longest_rule(F.col("host"), F.col("path"), URL_RULES))
    verdict = F.coalesce("r.verdict", F.when(F.col("is_listed"), "block").otherwise("allow"))
    return ruled.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"))


@query
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and network log likelihood of every document; learned from those whose id's crc32 modulo 7 is not 2."""
    found = lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"), id_crc("doc_id", 7) != 2)
    return found.select(F.col("id").alias("doc_id"), (id_crc("id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality cascade for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.rule_order(docs))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept")


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = styletree.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are left without the passages of 50 words that an earlier document has."""
    found = substrings.dedup(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut in three and written with its middle last."""
    found = infill.transform(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("restored", infill.restored(F.col("form"), F.col("output")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return found.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", *digests)


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers meet in every document, and how usual their pairs are."""
    found = crosstoken.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text that they decode to."""
    found = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded=True)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    digests = [F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")]
    return found.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), *digests)


# ------------------------------------------------------------------ SQL twins

_SIZE = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT"

ORACLES["op3_source_mix"] = f"""
WITH d AS (SELECT doc_id, source, {_SIZE} AS size, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight FROM d GROUP BY source),
o AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
  coalesce(sum(3 * source_size) OVER w, 0) AS caps, coalesce(sum(weight) OVER w, 0) AS gone, 3 * source_size / weight::DOUBLE AS bound
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(level, gone) AS level FROM (SELECT (total - caps)::DOUBLE / (weights - gone)::DOUBLE AS level, bound, gone FROM o) WHERE level <= bound),
t AS (SELECT source, source_size, CASE WHEN 3 * source_size < weight * level THEN (3 * source_size)::DOUBLE ELSE weight * level END AS target FROM o, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT d.*, source_size, target, epochs, floor(target - epochs * source_size + 0.5)::BIGINT AS rest,
  sum(size) OVER (PARTITION BY d.source ORDER BY place, size ROWS UNBOUNDED PRECEDING) - size AS before FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + least(size, greatest(rest - before, 0)))::BIGINT AS taken, epochs,
  least(size, greatest(rest - before, 0))::BIGINT AS part FROM p"""

_HOST = "translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FITS = lambda host, path: f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"
_RULE = f"""CASE WHEN {_FITS('example.net', '/en/')} THEN 'example.net/en/' WHEN {_FITS('example.com', '/de/')} THEN 'example.com/de/'
  WHEN {_FITS('org', '/fr/')} THEN 'org/fr/' WHEN {_FITS('net', '/')} THEN 'net/' END"""
ORACLES["op6_url_filter"] = rf"""
WITH u AS (SELECT page_id, {_HOST} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages), r AS (SELECT *, {_RULE} AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN list_has_any(string_split(host, '.'), {LISTED_NAMES}) THEN 'block' ELSE 'allow' END AS verdict FROM r"""

ORACLES["op8_quality"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY doc_id),
a AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines FROM w),
b AS (SELECT a.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM a LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words
  OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 7 * n_lines) AS kept FROM f"""

_H = lambda k: f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT"
_PART = lambda a, b: f"coalesce(array_to_string(list_slice(u, {a}, {b}), ''), '')"
ORACLES["op11_fill_in_middle"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, h, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u FROM d),
c AS (SELECT doc_id, t, h, u, len(u)::BIGINT AS n, least({_H(0)} % (len(u) + 1), {_H(1)} % (len(u) + 1)) AS a, greatest({_H(0)} % (len(u) + 1), {_H(1)} % (len(u) + 1)) AS b FROM u),
f AS (SELECT *, CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR {_H(2)} % 100 >= 90 THEN 'plain' WHEN {_H(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
  {_PART('1', 'a')} AS p, {_PART('a + 1', 'b')} AS m, {_PART('b + 1', 'n')} AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256 FROM f"""
