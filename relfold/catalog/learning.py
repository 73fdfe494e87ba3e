"""Model training, scoring and embeddings."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from relfold.catalog.base import query, r
from relfold.catalog.blocks import applicant_block, as_features, ids
from relfold.catalog.rows import scratch
from relfold.catalog.shapes import labelled_docs
from relfold.learn import boost, flow, terms
from relfold.operators import encode
from relfold.plans import blocks
from relfold.plans.matrix import feature_matrix
from relfold.sources import roles
from relfold.sources.tables import driver_table, read_table

SMALL_TREES = {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1, "minInfoGain": 0.0}


def doc_features(spark, sf_dir):
    """Documents with a quality label on some of them and a few numeric features."""
    d = labelled_docs(spark, sf_dir)
    d = encode.count_encode(d, "source")
    wide, cols = encode.one_hot(d.drop("source"), "lang", null_category=False)
    features = ["n_chars", "source_count", *cols]
    return wide.select("doc_id", F.col("quality").alias("label"), *features), features


@query("train_boosted")
def train_boosted(spark, sf_dir):
    df, features = doc_features(spark, sf_dir)
    held = df.withColumn("valid", F.pmod(F.col("doc_id"), F.lit(4)) == 0)
    model = boost.train(held, "label", features, SMALL_TREES, "valid")
    return boost.score(model, held.where("label IS NOT NULL"), features, ["doc_id", "label"]).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("score"))


# Scores and importances of trees have no SQL; these are the facts about them that it can tell.
_SCORES = "count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, 0::BIGINT AS n_bad"


def _score_facts(scores, key):
    bad = F.count(F.when(F.col("score").between(0, 1), None).otherwise(1))
    return [F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_ids"), bad.alias("n_bad")]


@query("score_boosted_facts", f"SELECT {_SCORES}, true AS separates FROM documents")
def score_boosted_facts(spark, sf_dir):
    """Every document scored once, between 0 and 1; a tree sees a label that follows from its features."""
    df, features = doc_features(spark, sf_dir)
    df = df.withColumn("label", F.when(F.col("doc_id") % 3 > 0, (F.col("n_chars") > 1500).cast("int")))
    scores = boost.score(boost.train(df, "label", features, SMALL_TREES), df, features, ["doc_id", "n_chars"])
    means = [F.avg(F.when(c, F.col("score"))) for c in (F.col("n_chars") > 1500, F.col("n_chars") <= 1500)]
    return scores.agg(*_score_facts(scores, "doc_id"), (means[0] - means[1] > 0.3).alias("separates"))


@query("feature_importance_facts", """SELECT 2 + (SELECT count(DISTINCT lang) FROM documents) AS n_features, 1::DOUBLE AS total, 0::BIGINT AS n_negative, 'n_chars' AS highest""")
def feature_importance_facts(spark, sf_dir):
    """Importances add up to 1, none is negative, and the feature that the label follows from leads."""
    df, features = doc_features(spark, sf_dir)
    df = df.withColumn("label", (F.col("n_chars") > 1500).cast("int"))
    found = boost.feature_importance(boost.train(df, "label", features, SMALL_TREES), features, df)
    return found.agg(F.count(F.lit(1)).alias("n_features"), F.sum("importance").alias("total"), F.count(F.when(F.col("importance") < 0, 1)).alias("n_negative"), F.max_by("feature", "importance").alias("highest"))


@query("cross_validated_facts", """SELECT part, count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, 0::BIGINT AS n_bad, CASE WHEN part = 'train' THEN 3 ELSE 0 END::BIGINT AS n_folds
  FROM (SELECT doc_id, CASE WHEN quality IS NULL THEN 'test' ELSE 'train' END AS part FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY part""")
def cross_validated_facts(spark, sf_dir):
    """Every labelled document scored once by the fold that did not see it, every other one by the mean of all folds."""
    df, features = doc_features(spark, sf_dir)
    scores = boost.cross_validate(df, "doc_id", "label", features, 3, 666, SMALL_TREES)
    return scores.groupBy("part").agg(*_score_facts(scores, "doc_id"), F.count_distinct("fold").alias("n_folds"))


@query("score_boosted")
def score_boosted(spark, sf_dir):
    df, features = doc_features(spark, sf_dir)
    return boost.score(boost.train(df, "label", features, SMALL_TREES), df, features, ["doc_id"])


@query("feature_importance")
def feature_importance(spark, sf_dir):
    df, features = doc_features(spark, sf_dir)
    return boost.feature_importance(boost.train(df, "label", features, SMALL_TREES), features, df)


@query("cross_validated_scores")
def cross_validated_scores(spark, sf_dir):
    df, features = doc_features(spark, sf_dir)
    return boost.cross_validate(df, "doc_id", "label", features, 3, 666, SMALL_TREES)


@query("train_and_submit", """WITH f AS (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN CASE WHEN coalesce(n, 0) >= 10 THEN 1 ELSE 0 END END AS label
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey)
  SELECT count(*) AS n_scores, count(*) FILTER (WHERE label IS NULL) AS n_submitted, count(*) AS n_ids, 0::BIGINT AS n_bad, 3::BIGINT AS n_folds,
  count(label) AS n_judged, true AS separates FROM f""")
def train_and_submit(spark, sf_dir):
    """Matrix, folds, scores and score files; customers of ten orders or more are told apart. Facts of the files that SQL can tell."""
    parts = {"applicant": lambda: as_features(applicant_block(spark, sf_dir)), "instalments2": lambda: as_features(blocks.block_instalments_v2(ids(spark, sf_dir), roles.instalment(spark, sf_dir)))}
    matrix = feature_matrix(parts, "entity_id", uuid.uuid4().hex, params=sf_dir)
    orders = driver_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity_id")).agg(F.count(F.lit(1)).alias("n"))
    label = F.when(F.col("entity_id") % 4 != 0, (F.coalesce("n", F.lit(0)) >= 10).cast("int"))
    labelled = matrix.join(orders, "entity_id", "left").withColumn("label", label).drop("n")
    folder = scratch(spark, "scores")
    judged = flow.train_and_submit(labelled, "entity_id", "label", boost.predictors(labelled, "label", ["entity_id"]), folder, 3, 666, SMALL_TREES)
    schema = "entity_id bigint, score double"
    every, sent = read_table(spark, f"{folder}/scores", schema), read_table(spark, f"{folder}/submission", schema)
    bad = F.count(F.when(F.col("score").between(0, 1), None).otherwise(1))
    folds = judged.agg(F.count("fold").alias("n"), F.sum(F.when(F.col("fold").isNotNull(), F.col("rows"))).alias("rows"), F.min("auc").alias("least"))
    return every.agg(F.count(F.lit(1)).alias("n_scores"), F.count_distinct("entity_id").alias("n_ids"), bad.alias("n_bad")).select(
        "*", sent.select(F.count(F.lit(1))).scalar().alias("n_submitted"), folds.select("n").scalar().alias("n_folds"), folds.select("rows").scalar().alias("n_judged"),
        (folds.select("least").scalar() > 0.9).alias("separates"))


@query("term_counts", r"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM documents),
  c AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY 1, 2) SELECT doc_id, term, n FROM c WHERE term IN (SELECT term FROM c GROUP BY 1 HAVING count(*) >= 2)""")
def term_counts(spark, sf_dir):
    return terms.term_counts(driver_table(spark, sf_dir, "documents"), "doc_id", "text")


def purchases(spark, sf_dir):
    """(customer, brand and type) of every order line."""
    li = driver_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = driver_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("entity_id"))
    p = driver_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat_ws(" ", F.translate("p_brand", "#", ""), "p_type").alias("token"))
    return li.join(o, "l_orderkey").join(p, "l_partkey").select("entity_id", "token")


def _corpus(spark, sf_dir):
    return terms.corpus(purchases(spark, sf_dir), "entity_id", "token")[0]


# Counts of terms per customer as SQL; terms of one customer only are left out, the others numbered in alphabetical order.
_COUNTS = r"""t AS (SELECT o_custkey AS id, unnest(regexp_extract_all(lower(concat_ws(' ', replace(p_brand, '#', ''), p_type)), '[\p{L}\p{N}_]+')) AS term
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
  raw AS MATERIALIZED (SELECT id, term, count(*) AS n FROM t GROUP BY 1, 2),
  voc AS MATERIALIZED (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM raw GROUP BY term HAVING count(*) >= 2),
  c AS MATERIALIZED (SELECT id, idx, n::DOUBLE AS n FROM raw JOIN voc USING (term))"""
_K, _ROUNDS, _STEPS = 5, 4, 14
_cols = lambda form, sep=", ": sep.join(form.format(j=j) for j in range(_K))


def _factor_sql() -> str:
    """The multiplicative updates written out, a table for each half step."""
    start = lambda side, key: _cols(f"scale * (0.5 + ('0x' || substr(md5('520:{side}:{{j}}:' || {key}), 1, 13))::BIGINT::DOUBLE / 4503599627370496) AS {'wh'[side]}{{j}}")
    parts = [_COUNTS, f"s AS (SELECT sqrt(sum(n) / (count(DISTINCT id) * count(DISTINCT idx)) / {_K}) AS scale FROM c)",
             f"w0 AS MATERIALIZED (SELECT id, {start(0, 'id')} FROM (SELECT DISTINCT id FROM c), s)", f"h0 AS MATERIALIZED (SELECT idx, {start(1, 'idx')} FROM (SELECT DISTINCT idx FROM c), s)"]
    for i in range(_ROUNDS):
        for own, other, key, w, h in (("w", "h", "id", i, i), ("h", "w", "idx", i + 1, i)):
            pulls = _cols(f"sum(n / greatest({_cols('w{j} * h{j}', ' + ')}, 1e-12) * {other}{{j}}) AS p{{j}}").replace("{j}", "")
            last = f"{own}{i}"
            sums = _cols(f"sum({other}{{j}}) AS s{{j}}")
            grown = _cols(f"{own}{{j}} * p{{j}} / (s{{j}} + 0.05 + 0.05 * {own}{{j}}) AS {own}{{j}}")
            parts.append(f"{own}{i + 1} AS MATERIALIZED (SELECT {key}, {grown} FROM {last} JOIN (SELECT {key}, {pulls} FROM c JOIN w{w} USING (id) JOIN h{h} USING (idx) GROUP BY 1) USING ({key}), (SELECT {sums} FROM {other}{w if other == 'w' else h}))")
    return f"WITH {', '.join(parts)} SELECT id AS entity_id, {', '.join(r(f'w{j}') + f' AS factor_{j}' for j in range(_K))} FROM w{_ROUNDS}"


def _axis_sql() -> str:
    """The leading axis by multiplying with the counts and their transpose again and again."""
    parts = [_COUNTS, "v0 AS MATERIALIZED (SELECT DISTINCT idx, 1::DOUBLE AS v FROM c)"]
    for i in range(_STEPS):
        y = f"(SELECT id, sum(n * v) AS y FROM c JOIN v{i} USING (idx) GROUP BY 1)"
        parts.append(f"z{i} AS MATERIALIZED (SELECT idx, sum(n * y) AS z FROM c JOIN {y} USING (id) GROUP BY 1)")
        parts.append(f"v{i + 1} AS MATERIALIZED (SELECT idx, z / (SELECT sqrt(sum(z * z)) FROM z{i}) AS v FROM z{i})")
    return f"WITH {', '.join(parts)} SELECT id AS entity_id, {r('sum(n * v)', 3)} AS svd_0, true AS ordered FROM c JOIN v{_STEPS} USING (idx) GROUP BY 1"


def _corpus(spark, sf_dir):
    return terms.corpus(purchases(spark, sf_dir), "entity_id", "token")[0]


_KNOWN = f"WITH {_COUNTS} SELECT count(DISTINCT id) AS n_rows, count(DISTINCT id) AS n_ids, 0::BIGINT AS n_bad FROM c"


@query("topic_mixture")
def topic_mixture(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    vectors = terms.to_vectors(c.counts, "entity_id", c.size)
    return terms.topics(vectors, vectors, "entity_id", max_iter=5)


def _mixture_facts(mixed, others=()):
    """Every id once, shares of topics between 0 and 1 that add up to 1, and a value in every other column."""
    shares = [F.col(f"topic_{j}") for j in range(_K)]
    good = F.abs(sum(shares[1:], shares[0]) - 1) < 1e-6
    for x in shares:
        good = good & x.between(0, 1)
    for x in others:
        good = good & F.col(x).isNotNull()
    return mixed.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("entity_id").alias("n_ids"), F.count(F.when(good, None).otherwise(1)).alias("n_bad"))


@query("topic_mixture_facts", _KNOWN)
def topic_mixture_facts(spark, sf_dir):
    return _mixture_facts(topic_mixture(spark, sf_dir))


@query("nonneg_factors", _factor_sql())
def nonneg_factors(spark, sf_dir):
    return terms.nonneg_factors(_corpus(spark, sf_dir), _K, max_iter=_ROUNDS)


@query("svd_factors")
def svd_factors(spark, sf_dir):
    return terms.svd_factors(_corpus(spark, sf_dir))


@query("svd_leading_axis", _axis_sql(), digits=3)
def svd_leading_axis(spark, sf_dir):
    """The coordinate on the leading axis, and whether the axes come in order of their energy."""
    found = terms.singular_vectors(_corpus(spark, sf_dir), 2)
    return found.ids.select("entity_id", "svd_0", F.lit(found.values == sorted(found.values, reverse=True)).alias("ordered"))


@query("entity_embedding_facts", _KNOWN)
def entity_embedding_facts(spark, sf_dir):
    mixed = entity_embedding(spark, sf_dir)
    return _mixture_facts(mixed, [c for c in mixed.columns if c.startswith(("factor_", "svd_"))])


@query("entity_embedding")
def entity_embedding(spark, sf_dir):
    data = purchases(spark, sf_dir)
    return terms.embed(data, data, "entity_id", "token", max_iter=5)
