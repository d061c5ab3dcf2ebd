"""Each operator over its whole table, in the form its contract asks for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from jobtide.llm import align, ann, bagminhash, html, license, mixing, packing, rules, secrets, setjoin, substring, toxicity, variants
from jobtide.llm.text import saved, table, words

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op2_license_scans(spark, sf_dir):
    found = license.recognise(table(spark, sf_dir, "documents"))
    joined = lambda c: F.array_join(c, ",")
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        joined("sentence_ids").alias("sentence_ids"),
        joined("licences").alias("licences"),
        joined("unmatched").alias("unmatched"),
    )


@query
def op3_quality_rules(spark, sf_dir):
    # texts are read once; what is learned and decided is learned and decided on counts
    counted = saved(rules.counts(table(spark, sf_dir, "documents")), "counts")
    out = rules.verdicts(counted, table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@query
def op4_substring_dedup(spark, sf_dir):
    left = substring.removed(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_html_extraction(spark, sf_dir):
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op6_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.size(words(F.col("text"))).alias("size"))
    mixed = mixing.copies(saved(docs, "sizes"), F.col("size"))  # texts are read once
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


@query
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return toxicity.scored(docs.select("doc_id", "text"), model).select("doc_id", held, "score", predicted)


@query
def op8_secret_scans(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE]
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(secrets.joined(of(*base)), 256).alias("base_sha256"),
        secrets.joined(F.col("secrets")).alias("spans"),
    )


@query
def op9_nearest_neighbours(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op10_minhash(spark, sf_dir):
    return bagminhash.classes(table(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark, sf_dir):
    return variants.group(table(spark, sf_dir, "documents"))


@query
def op12_cross_tokenizer_alignment(spark, sf_dir):
    return align.align(table(spark, sf_dir, "documents"))


@query
def op13_ngram_jaccard_join(spark, sf_dir):
    return setjoin.joined(table(spark, sf_dir, "documents"))


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
