"""Input columns named as the operators' own, samples that teach, and language filters as plain sets."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from gaugeflow.llm import clusters, language, near_duplicates, packing, periodic_runs, quality, queries, rules
from gaugeflow.llm import secret_scan, wrappers
from gaugeflow.llm.ship import ship_package
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
CLASHES = ["_text", "_runs", "_pieces", "_once", "_new", "spans", "base_spans", "_key", "score", "support"]
CLASHES += ["lang_pred", "row", "key", "node", "h", "n", "runs", "pieces", "new", "words", "host", "x", "odd.name"]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    return rows.withColumns({c: F.xxhash64("doc_id", F.lit(c)) for c in CLASHES})


def values(df, names):
    return {tuple(r) for r in df.select("doc_id", *[F.col(f"`{c}`") for c in names]).collect()}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_leave_all_columns_as_they_are(spark, docs, name, stage):
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns
    kept = values(out, CLASHES)
    assert kept and kept <= values(docs, CLASHES)


def test_packing_stage_with_clashing_columns(spark, docs):
    plain = docs.drop(*[c for c in CLASHES if "." not in c], "odd.name")
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert got.agg(F.sum("length")).first() == packing.pack(
        plain, queries.public_tokenizers.path("word_bpe_49k.json"), plain_special=False
    ).agg(F.sum("length")).first()


def test_secrets_with_clashing_columns(docs):
    model = secret_scan.train(secret_scan.labelled_samples(docs))
    found = secret_scan.find_secrets(docs, model)
    others = [c for c in CLASHES if c not in ("spans", "base_spans")]
    assert values(found, others) == values(docs, others)
    clean = secret_scan.redact(found)
    assert values(clean, others) == values(docs, others)
    assert clean.where("text LIKE '%[SECRET]%'").count() > 0


def test_operators_that_give_their_own_columns(docs):
    assert near_duplicates.near_duplicates(docs).columns == ["doc_id", "node", "class_id"]
    assert rules.apply_rules(docs).count() == docs.count()
    assert quality.with_statistics(docs).columns == ["doc_id", "x"]
    assert periodic_runs.periodic_runs(docs).count() == docs.count()
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.b/").alias("url"), F.col("text").alias("html"),
                        *[F.col(f"`{c}`") for c in CLASHES if c != "host"], F.lit(1).alias("host"))
    assert wrappers.main_text(pages).columns == ["page_id", "url", "text", "n_chars"]
    vectors = docs.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"), F.lit(1).alias("h"))
    assert clusters.clusters(vectors, dims=1).count() == docs.count()


def test_predicted_columns_are_replaced(docs):
    got = language.predict(docs, language.train(docs))
    assert {r["lang_pred"] for r in got.select("lang_pred").distinct().collect()} <= {"en", "de", "fr", "es", "und"}


def test_copies_teach_once_and_small_languages_are_learned_whole(spark, docs):
    copy = spark.createDataFrame([("the very same text again and again", "en")] * 400, "text string, lang string")
    small = spark.createDataFrame([(f"zzyx qqwv {i} xxkj", "zz") for i in range(5)], "text string, lang string")
    rows = docs.select("text", "lang").union(copy).union(small)
    filters = language.train(rows, bound=60)
    assert "zz" in filters.languages
    asked = spark.createDataFrame([(1, "qqwv zzyx xxkj qqwv")], "doc_id long, text string")
    assert language.predict(asked, filters).first()["lang_pred"] == "zz"
    with pytest.raises(ValueError, match="64"):
        many = spark.createDataFrame([("a b", f"l{i}") for i in range(70)], "text string, lang string")
        language.train(many)


def test_filters_agree_with_plain_sets(docs):
    """The same thresholds over sets of n-grams, without hashing or filters, name the same language."""
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect() if r.text and r.lang]
    distinct = list(dict.fromkeys(rows))

    def grams(text):
        shown = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
        return Counter(
            shown[i : i + n] for n in language.SIZES for i in range(len(shown) - n + 1) if shown[i] != " "
        )

    n_docs, seen = Counter(lang for _, lang in distinct), defaultdict(Counter)
    for text, lang in distinct:
        for gram in grams(text):
            seen[gram][lang] += 1
    known = defaultdict(set)
    for gram, langs in seen.items():
        rate = {lang: n / n_docs[lang] for lang, n in langs.items()}
        for lang, share in rate.items():
            if share >= 0.002 and share >= 0.2 * max(rate.values()):
                known[lang].add(gram)
    filters = language.train(docs)
    got = {r.text: r.lang_pred for r in language.predict(docs, filters).select("text", "lang_pred").collect()}
    same = 0
    for text, _ in distinct:
        counts = grams(text)
        hits = {lang: sum(n for g, n in counts.items() if g in known[lang]) for lang in filters.languages}
        best = max(filters.languages, key=hits.__getitem__) if counts else language.UNKNOWN
        same += got[text] == best
    assert same >= 0.99 * len(distinct)


def test_posterior_by_hand(spark):
    """Class covariances by ``numpy.cov``, densities written out."""
    rng = np.random.default_rng(4)
    size = len(quality.STATISTICS)
    x = np.r_[rng.normal(0, 1, (60, size)), rng.normal(0.7, 1.5, (40, size))]
    label = np.r_[np.zeros(60), np.ones(40)].astype(int)
    rows = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))],
                                 "doc_id long, x array<double>, label int")
    model = quality.fit(rows)
    got = {r.doc_id: r.score for r in quality.predict(rows, model).collect()}
    whole = np.diag(np.maximum(x.var(axis=0), 1e-6))
    log = []
    for k in (0, 1):
        own = x[label == k]
        covariance = 0.9 * np.cov(own.T, bias=True) + 0.1 * whole
        away = x - own.mean(axis=0)
        square = np.einsum("ni,ij,nj->n", away, np.linalg.inv(covariance), away)
        density = -0.5 * (np.linalg.slogdet(covariance)[1] + square)
        log.append(density / 3.0 + np.log(np.mean(label == k)))
    want = 1 / (1 + np.exp(log[0] - log[1]))
    assert np.allclose([got[i] for i in range(len(x))], want)


def test_one_label_of_each_id(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    one = labels.first()["doc_id"]
    repeated = docs.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit(one)).otherwise(F.col("doc_id")))
    repeated.write.parquet(str(tmp_path / "documents.parquet"))
    labels.union(labels).write.parquet(str(tmp_path / "labels.parquet"))
    assert queries.QUERIES["op3_quality"](spark, str(tmp_path)).count() == docs.count()
