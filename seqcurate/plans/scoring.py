"""Queries of scores, features, samples and weights, over whole tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import cascade, features, metrics, quota, sampling, score, select
from ..operators.near import dedup_near
from ..operators.order import kept
from .functions import _scratch
from .standins import FR, fragments, table

BASES = ("eaionrtshlduEAIONRTSHLDU", "ACGTACGTACGTACGTACGTACGT")
DNA = f"translate(text, '{BASES[0]}', '{BASES[1]}')"


def _dna(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.translate("text", *BASES).alias("dna"))


def _logits(spark, sf_dir):
    """embeddings: base logits of three root classes, residuals, branch logits, and truth."""
    part = lambda a, n: F.transform(F.slice("embedding", a, n), lambda x: x.cast("double") * 8)
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", (F.col("label") % 3).cast("int").alias("y"), (800 + F.col("vec_id") * 37 % 5000).alias("length"), (F.col("vec_id") % 23).alias("grp"), part(1, 3).alias("root"), part(4, 3).alias("residual"), part(7, 8).alias("euk"), part(15, 2).alias("prok"), part(17, 2).alias("organelle"), part(19, 5).alias("first"), part(24, 3).alias("second"), F.get("embedding", F.lit(30)).cast("double").alias("e"))


_R = lambda c: F.round(c, 6)


def m02_kmers_two_ks(spark, sf_dir):
    """k-mers of 3 and 4 letters in one scan."""
    return features.kmer_counts(_dna(spark, sf_dir), "doc_id", "dna", [3, 4]).groupBy("k", "code").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("documents"))


def t07_kmer_counts_k7(spark, sf_dir):
    """k-mers of 7 letters, as the current models take them: per document how many kinds, how many, and a sum of codes by counts."""
    return features.kmer_counts(_dna(spark, sf_dir), "doc_id", "dna", 7).groupBy("id").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("kmers"), F.sum(F.col("n") * (F.col("code") + 1)).alias("codes"))


def a11_doc_freq(spark, sf_dir):
    return features.doc_freq(_dna(spark, sf_dir), "dna", [4, 5])


def a12_idf(spark, sf_dir):
    d = _dna(spark, sf_dir)
    return features.idf(features.doc_freq(d, "dna", 5), d.count(), 5).select("code", "df", _R("idf").alias("idf"))


def m01_tfidf_k7(spark, sf_dir):
    """TF-IDF of 7 letters: per document the entries, their sum and the largest."""
    d = _dna(spark, sf_dir)
    rows = features.tfidf(d, "doc_id", "dna", features.idf(features.doc_freq(d, "dna", 7), d.count(), 7))
    return rows.select("id", F.size("codes").cast("long").alias("entries"), F.round(F.aggregate("weights", F.lit(0.0), lambda a, x: a + x), 5).alias("total"), F.round(F.coalesce(F.array_max("weights"), F.lit(0.0)), 5).alias("largest"))


def m03_idf_model(spark, sf_dir):
    """An idf model saved, loaded with its checks, and read."""
    d, path = _dna(spark, sf_dir), _scratch(spark)
    features.save_idf(features.idf(features.doc_freq(d, "dna", [3, 4]), d.count(), [3, 4]), path, 5000, d.count())
    return features.load_idf(spark, path, 4, 5000).select("code", "df")


def m04_biosignals(spark, sf_dir):
    """60 signals of each document; the first three and the stretch of equal letters are what SQL can follow, the others are tested in pytest."""
    d = _dna(spark, sf_dir)
    out = features.biosignals(d.select("doc_id", "dna").repartition(32, "doc_id"), "dna")
    return out.select("doc_id", F.size("signals").alias("n"), *(F.round(F.get("signals", F.lit(i)).cast("double"), 4).alias(name) for i, name in enumerate(("log_length", "gc", "n_share"))))


def _heads(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").where("embedding is not null").withColumn("x", F.transform("embedding", lambda v: v.cast("double"))).withColumn("root", (F.col("label") % 3).cast("double")).withColumn("leaf", F.floor(F.col("label") / 5).cast("double"))
    return e, features.fit_heads(e, "x", {"root": ("root", F.lit(True)), "leaf": ("leaf", F.col("root") == 0)}, steps=20, l2=0.01)


def m05_fit_heads(spark, sf_dir):
    """Two heads fitted, one on its branch, and applied to all rows: what they predict by label. A fit, so no SQL."""
    e, models = _heads(spark, sf_dir)
    out = e.withColumn("_x", array_to_vector("x"))
    for m in models.values():
        out = m.transform(out)
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("root_prediction") == F.col("root"), 1)).alias("root_right"), F.count(F.when(F.col("leaf_prediction") == F.col("leaf"), 1)).alias("leaf_right"))


def m06_grid_search(spark, sf_dir):
    """Three architectures, one of them named twice, fitted on vectors that tell their labels; a fit, so no SQL."""
    e = _heads(spark, sf_dir)[0].select("vec_id", "root", array_to_vector("x").alias("x"))
    return cascade.grid_search(e.where("vec_id % 5 > 0"), e.where("vec_id % 5 = 0"), "root", 3, [{"steps": 20}, {"steps": 20}, {"hidden": (16,), "steps": 30}, {"hidden": (32, 16), "steps": 30}])


def m07_tree_expert(spark, sf_dir):
    """A forest on the signals of documents that tells English from others; a fit, so no SQL."""
    d = kept(features.biosignals(_dna(spark, sf_dir).repartition(32, "doc_id"), "dna").select("doc_id", "lang", "signals", (F.col("lang") == "en").cast("double").alias("y")))
    model = features.fit_tree(d.where("doc_id % 5 > 0"), "signals", "y", trees=20, depth=6)
    return model.transform(d.withColumn("_x", array_to_vector("signals"))).groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.sum("prediction").cast("long").alias("english"))


def m08_cascade(spark, sf_dir):
    """Fragments (vectors) of the same record averaged, then decoded in two stages."""
    e = _logits(spark, sf_dir).select((F.col("vec_id") % 200).alias("record"), scalars.softmax(F.col("first"), 0.5).alias("first"), scalars.softmax(F.col("second"), 0.5).alias("second"))
    one = score.mean_probabilities(e, "record", "first", 5)
    two = score.mean_probabilities(e, "record", "second", 3)
    return one.join(two.select("record", "second"), "record").select("record", "fragments", score.cascade(F.col("first"), F.col("second"), 0.3, 0.4).alias("c")).select("record", "fragments", "c.first", "c.second")


def m08_classify(spark, sf_dir):
    """Documents in place of genomes, their language as the class: both stages fitted on some, saved, loaded, and all classified from their texts; a fit, so no SQL."""
    of = lambda *names: F.element_at(F.create_map(*(F.lit(x) for pair in zip(("en", "de", "fr", "es"), names, strict=True) for x in pair)), F.col("lang"))
    d, path = table(spark, sf_dir, "documents").where("length(text) >= 20"), _scratch(spark)
    pieces = select.chop(d.where("doc_id % 4 > 0").withColumn("_i", F.struct(of("eukarya", "bacteria", "organelle", "archaea").alias("one"), of("unknown", "unknown", "plastid", "mitochondrion").alias("two"))), "_i", "text", 2000)
    for stage, label, classes, k in ((1, "id.one", score.FIRST, 4), (2, "id.two", score.SECOND, 3)):
        cascade.save_stage(cascade.fit_stage(pieces, "fragment", label, classes, k, 2000, (16,), 0.5, 40), f"{path}/{stage}")
    out = cascade.classify(d, "doc_id", "text", *(cascade.load_stage(spark, f"{path}/{stage}") for stage in (1, 2)), min_len=100)
    return out.select(F.col("id").alias("doc_id"), "bp", "fragments", "first", "second", F.round(F.array_max("first_probabilities"), 6).alias("probability"))


def _decoded(df, root="root", **more):
    return score.hier_decode(F.col(root), {h: F.col(h) for h in ("euk", "prok", "organelle")}, {"root": 2.0, "euk": 0.5}, {"root": 0.4, "euk": 0.3, "prok": 0.6}, **more)


def m09_hier_decode(spark, sf_dir):
    return _logits(spark, sf_dir).select("vec_id", _decoded(None).alias("d")).select("vec_id", "d.root", "d.leaf", _R("d.root_probability").alias("root_p"), _R("d.leaf_probability").alias("leaf_p"))


def m10_route(spark, sf_dir):
    e = _logits(spark, sf_dir)
    return e.select("vec_id", scalars.argmax(score.route_by_length(F.col("length"), F.col("root"), F.col("residual"))).alias("place"))


def m11_blend(spark, sf_dir):
    e = _logits(spark, sf_dir).withColumn("root", score.blend(F.col("length"), F.col("root"), F.col("residual"), 0.125))
    return e.select("vec_id", _R(F.get("root", F.lit(0))).alias("a"), scalars.argmax(F.col("root")).alias("place"))


def m12_promote(spark, sf_dir):
    e = _logits(spark, sf_dir)
    p = score.promote(scalars.softmax(F.col("root")), 1 / (1 + F.exp(-20 * F.col("e"))), F.col("length"), 0.6, 0.7, 2.0, 0.1, 0.8, 0.5)
    return e.select("vec_id", p.alias("p")).select("vec_id", _R(F.get("p.probabilities", F.lit(0))).alias("euk"), "p.promoted")


def m13_local_correct(spark, sf_dir):
    e = _logits(spark, sf_dir)
    return e.select("vec_id", score.local_correct(F.col("root"), F.col("prok"), F.slice("residual", 1, 2), 0.5, 1.0).alias("c")).select("vec_id", "c.active", _R(F.get("c.logits", F.lit(0))).alias("a"))


def _candidates(spark, sf_dir):
    """supplier and part as search results: candidates of a stage and k."""
    p = table(spark, sf_dir, "part")
    return p.select(F.when(F.col("p_size") % 2 == 0, "first").otherwise("second").alias("stage"), (F.col("p_size") % 6 + 3).cast("int").alias("k"), F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("candidate"), F.round(F.col("p_retailprice") % 97 / 97, 4).alias("mean_f1"), (F.col("p_partkey") % 5 == 0).alias("collapsed"), (F.col("p_partkey") % 100 / 100).alias("pred_share"), (F.col("p_partkey") % 37 / 2.0).alias("seconds"))


def m14_pick_models(spark, sf_dir):
    c = _candidates(spark, sf_dir)
    models = c.groupBy("stage", "k").agg(F.max("mean_f1").alias("mean_f1"), F.max("candidate").alias("weights"))
    return score.pick_models(models, models.where("k <> 4").select("stage", "k"), {"second": 5})


def a30_summarize(spark, sf_dir):
    e = _logits(spark, sf_dir).withColumn("d", _decoded(None))
    return score.summarize(e.select((F.col("vec_id") % 3).alias("file"), F.col("d.leaf").alias("leaf")), "leaf", ["file"]).select("file", "leaf", "records", _R("share").alias("share"))


def _truth(spark, sf_dir):
    e = _logits(spark, sf_dir).withColumn("d", _decoded(None))
    names = lambda head: F.element_at(F.array(*(F.lit(x) for x in score.HEADS[head])), (F.col("label") % len(score.HEADS[head]) + 1).cast("int"))
    root = F.element_at(F.array(*(F.lit(r) for r in score.ROOT)), F.col("y") + 1)
    return e.select("vec_id", root.alias("root"), F.when(F.col("y") == 0, names("euk")).when(F.col("y") == 1, names("prok")).otherwise(names("organelle")).alias("leaf"), F.col("d.root").alias("pred_root"), F.col("d.leaf").alias("pred_leaf"))


def a19_evaluate_hier(spark, sf_dir):
    out = score.evaluate_hier(_truth(spark, sf_dir))
    return out.select("head", F.col("class").alias("cls"), "support", *(_R(c).alias(c) for c in ("precision", "recall", "f1", "macro_f1", "cascade_accuracy")))


def a17_confusion(spark, sf_dir):
    return metrics.confusion(_truth(spark, sf_dir), "root", "pred_root", ["euk_nuclear", "prok", "organelle", "virus"])


def j23_align(spark, sf_dir):
    t = _truth(spark, sf_dir).select(F.col("vec_id").alias("record_id"), "root").where("record_id % 7 > 0")
    p = _truth(spark, sf_dir).select(F.col("vec_id").alias("record_id"), "pred_root").where("record_id % 5 > 0")
    return score.align(t, p.unionByName(p.where("record_id % 50 = 1")))[1]


def a20_nll(spark, sf_dir):
    return _logits(spark, sf_dir).groupBy("grp").agg(_R(F.avg(scalars.nll(F.col("root"), F.col("y")))).alias("nll"))


def a21_binary_logits(spark, sf_dir):
    b = scalars.binary_logits(F.col("euk"), 2)
    return _logits(spark, sf_dir).select("vec_id", _R(F.get(b, F.lit(0))).alias("rest"), _R(F.get(b, F.lit(1))).alias("positive"))


def a22_best_f1_eligible(spark, sf_dir):
    e = _logits(spark, sf_dir).select((F.round(scalars.softmax(F.col("root"))[0] * 1000) / 1000).alias("p"), (F.col("y") == 0).cast("int").alias("y"), (scalars.argmax(F.col("root")) == 1).alias("eligible"))
    best = metrics.best_f1(e, "p", "y", F.col("eligible")).select("threshold", _R("f1").alias("f1"))
    return best.crossJoin(metrics.auprc(e, "p", "y", F.col("eligible")).select(_R("auprc").alias("auprc")))


def a24_alpha_surface(spark, sf_dir):
    e = _logits(spark, sf_dir).withColumn("cell", scalars.range_bin(F.col("length")))
    return score.alpha_surface(e, (-0.25, 0.0, 0.125, 0.5, 1.0), "root", "residual", "y", 3, ["cell"]).select("cell", "alpha", "n", _R("nll").alias("nll"), _R("macro_f1").alias("macro_f1"))


def a25_compare_losses(spark, sf_dir):
    e = _logits(spark, sf_dir).withColumn("z", F.zip_with("root", "residual", lambda a, b: a + 0.125 * b))
    e = e.select("y", (scalars.argmax(F.col("root")) - 1).alias("a"), (scalars.argmax(F.col("z")) - 1).alias("b"), scalars.nll(F.col("root"), F.col("y")).alias("la"), scalars.nll(F.col("z"), F.col("y")).alias("lb"))
    out = metrics.compare(e, "a", "b", "y", losses=("la", "lb"))
    return out.select("n", "both", "only_a", "only_b", "neither", *(_R(c).alias(c) for c in ("disagreement", "detectable", "oracle_accuracy", "loss_correlation", "std_ratio")))


def a27_temperature(spark, sf_dir):
    """The temperature of the root logits; a minimum found by refinement, so no SQL."""
    t, least = score.fit_temperature(_logits(spark, sf_dir), "root", "y")
    return table(spark, sf_dir, "embeddings").groupBy().agg(F.count(F.lit(1)).alias("rows")).select("rows", F.round(F.lit(t), 2).alias("temperature"), F.round(F.lit(least), 4).alias("nll"))


def a29_fingerprint(spark, sf_dir):
    f = fragments(spark, sf_dir).withColumnRenamed("class", "cls")
    out = metrics.fingerprint(f.unionByName(f.where("doc_id % 10 = 0")), ["split", "cls"], "doc_id", "bp")
    return out.withColumns({c: F.col(c).cast("string") for c in ("ids", "ids2")})


def a29_verify(spark, sf_dir):
    f = fragments(spark, sf_dir).withColumnRenamed("class", "cls")
    one = lambda df: metrics.fingerprint(df, ["split", "cls"], "doc_id", "bp")
    return metrics.verify_fingerprint(one(f.where("not (split = 'test' and cls = 'archaea')")), one(f.where("not (split = 'train' and cls = 'bacteria')").where("doc_id <> 1")), ["split", "cls"])


def a31_hp_rollup(spark, sf_dir):
    return score.hp_rollup(_candidates(spark, sf_dir), ["stage", "k"])


def w28_best_candidate(spark, sf_dir):
    return score.best_candidate(_candidates(spark, sf_dir).withColumn("collapsed", F.col("collapsed") | (F.col("k") == 3)), ["stage", "k"], 0.985)


def w29_gate_models(spark, sf_dir):
    c = _candidates(spark, sf_dir).withColumn("collapsed", F.col("collapsed") | (F.col("k") == 3)).where("k <> 8")
    return score.gate_models(c, _candidates(spark, sf_dir).select("stage", "k"), 0.985, 0.9)


def w30_maximin(spark, sf_dir):
    """Heads' gains by seed (supplier), from lineitem's means."""
    d = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("seed")).agg(*(F.round(F.avg(F.when(F.col("l_linenumber") % 4 == i, F.col("l_discount"))) - 0.04, 6).alias(h) for i, h in enumerate(("root", "euk", "prok", "organelle"))))
    return score.maximin_select(d, ("root", "euk", "prok", "organelle"), gain=0.01, regression=0.0).select("seed", "score", "promoted", "rank")


def w31_run_gates(spark, sf_dir):
    records = fragments(spark, sf_dir).where("class = 'eukarya' and split <> 'test'").withColumnRenamed("doc_id", "record_id")
    evaluation = records.groupBy(F.col("euk_group").alias("class")).agg(F.count(F.lit(1)).alias("support"), F.avg((F.col("record_id") % 3 == 0).cast("double")).alias("recall"))
    return score.run_gates(records, evaluation, ("fungi", "algae", "absent"), ("species_taxid", "split_group_id"), 0.3, 90.0, 89.9)


def w32_oof_router(spark, sf_dir):
    """Rules and strengths chosen on other folds; quantiles and choices over folds, so no SQL."""
    return score.oof_router(_logits(spark, sf_dir), "root", "residual", "y", "grp", 3).select("fold", "alpha", "rule", "rows", _R("base_macro_f1").alias("base_macro_f1"), _R("macro_f1").alias("macro_f1"), "base_only", "hybrid_only")


def w33_pareto_winner(spark, sf_dir):
    return metrics.pareto_winner(table(spark, sf_dir, "part"), "p_partkey", "p_retailprice", "p_size", 30.0).select("p_partkey", "p_size", "p_retailprice")


def j09_dedup_near(spark, sf_dir):
    """Rows of lower splits but those that align with a row of a higher one, in 95 % of the letters over 95 % of both. Alignments are no SQL; tests hold them against all pairs."""
    return dedup_near(fragments(spark, sf_dir), "doc_id", "text", "split", ("test", "validation", "train"), blocks=["class"]).select("doc_id", "split")


def w13_spaced_sample(spark, sf_dir):
    return sampling.spaced_sample(table(spark, sf_dir, "orders"), "o_orderpriority", ["o_orderkey"], 1000).select("o_orderkey", "o_orderpriority")


def w13_equal_sample(spark, sf_dir):
    return sampling.spaced_sample(table(spark, sf_dir, "documents"), "lang", ["doc_id"], 300, "equal").select("doc_id", "lang")


def w15_derive_targets(spark, sf_dir):
    have = fragments(spark, sf_dir).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    parts = [sampling.derive_targets(have, s, ("bacteria", "archaea", "eukarya"), total, 2.5, ratios={"bacteria": 1, "archaea": 1, "eukarya": 5}).withColumn("strategy", F.lit(s)) for s, total in (("preserve", 0), ("original", 700), ("balanced", 0), ("legacy", 0), ("custom", 500))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("class", "cls")


def w16_allocate_rates(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return quota.allocate_rates(counts, 20_000, "sqrt", "l_partkey", floor=5, cap=30).select("l_partkey", "n", F.round("quota", 4).alias("quota"), F.round("rate", 4).alias("rate"))


def w17_allocate_capped(spark, sf_dir):
    caps = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").alias("cap")).withColumn("w", (F.substring("source", 4, 3).cast("int") % 4).cast("double"))
    return quota.allocate_capped(caps, F.lit(1_000_000), "w", "cap", "source").select("source", "cap", "quota")


def w18_bp_plan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("stratum", F.when(F.col("lang") == "en", F.concat(F.lit("eukarya/"), "source")).otherwise(F.col("lang")))
    plan = quota.bp_plan(docs.groupBy("stratum").agg(F.sum("n_chars").alias("bp")), {"eukarya": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}, {f"src{i}": 1 for i in range(20)})
    return plan.select("stratum", "available_bp", "target_bp", _R("rate").alias("rate"))


def w19_balance_splits(spark, sf_dir):
    """Training and validation rows sampled to plans of their own; test rows as they are."""
    f = fragments(spark, sf_dir).select("doc_id", "split", F.when(F.col("class") == "eukarya", F.concat(F.lit("eukarya/g"), (F.col("doc_id") % 4).cast("string"))).otherwise(F.col("class")).alias("stratum"), "bp", "text")
    out = quota.balance_splits(f, ["train", "validation"], {"eukarya": 0.6, "bacteria": 0.3, "archaea": 0.1}, {f"g{i}": 1 for i in range(4)}, "text", "doc_id", min_len=50, how="md5")
    return out.groupBy("split", "stratum").agg(F.count(F.lit(1)).alias("rows"), F.sum("bp").alias("bp"))


def w20_balance_rates(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return quota.balance_rates(counts, "sqrt", total=30_000, min_rows=310).select("l_suppkey", "n", "rate", "expected")


def w21_hash_cap(spark, sf_dir):
    return quota.hash_cap(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_orderkey", 100).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("rows"))


def w23_cap_target(spark, sf_dir):
    df = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("wish", F.when(F.col("source") == "src0", 40.0).otherwise(1.0))
    return sampling.cap_target(df, "n", "wish", 2.0, "source").select("source", "n", _R("effective").alias("effective"))


def w24_donor_caps(spark, sf_dir):
    """Shares of the customers of an order priority, none over a limit; customers are in groups, and these in wider ones."""
    g = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_custkey").agg(F.sum(F.col("o_custkey") % 7 + 1).alias("n"))
    g = g.withColumn("species", F.col("o_custkey") % 40).withColumn("genus", F.col("o_custkey") % 8)
    return sampling.donor_caps(g, "o_orderpriority", ["o_custkey", "species", "genus"], [0.025, 0.04, 0.132]).select("o_orderpriority", "o_custkey", "n", F.round("share", 9).alias("share"))


def w25_row_weights(spark, sf_dir):
    f = fragments(spark, sf_dir).where("class <> 'eukarya' or euk_group not in ('', 'nonsense')").select("doc_id", F.col("class").alias("root"), F.col("euk_group").alias("leaf"))
    return sampling.row_weights(f, "root", "leaf", "eukarya", {"fungi": 3, "plant": 1, "algae": 1, "vertebrate": 1, "metazoa_invertebrate": 1, "alveolata": 1, "stramenopiles": 1, "protist": 1}, 1.5).select("doc_id", F.round("weight", 9).alias("weight"))


def w26_weighted_sample(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 7 + 1).cast("double").alias("w"))
    return sampling.weighted_sample(o, "w", ["o_orderkey"], 20_000)


def w27_donor_index(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return sampling.donor_index(o, ["o_custkey", "o_orderpriority"], "o_orderkey").select("o_orderkey", "o_custkey_code", "o_orderpriority_code")


def a02_estimated_census(spark, sf_dir):
    """Counts from a tenth of the rows by hash of the id, scaled: an estimate, with SQL on the same rows."""
    return metrics.census_sample(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_orderkey", F.col("l_quantity").cast("long"), 0.1, "md5")


QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "ajmtw" and k[1:3].isdigit()}

# windows of k letters: texts are cut to overlapping pieces first, as a substring of a long text costs its length
_KC = lambda k: f"(select doc_id, substr(p, i, {k}) as w from (select doc_id, substr(s, j, {200 + k - 1}) as p from (select doc_id, regexp_replace({DNA}, '[^ACGTacgt]', 'N', 'g') as s from documents), range(1, length(s) + 1, 200) u(j)), range(1, length(p) - {k - 1} + 1) t(i) where not contains(substr(p, i, {k}), 'N'))"
_CODE = lambda k: "(" + " + ".join(f"{4 ** (k - 1 - j)} * (strpos('ACGT', upper(substr(w, {j + 1}, 1))) - 1)" for j in range(k)) + ")::bigint"
_E = """l as (select vec_id, label, (label % 3)::int as y, 800 + vec_id * 37 % 5000 as length, vec_id % 23 as grp, list_transform(embedding[1:3], lambda x: x::double * 8) as root, list_transform(embedding[4:6], lambda x: x::double * 8) as residual,
      list_transform(embedding[7:14], lambda x: x::double * 8) as euk, list_transform(embedding[15:16], lambda x: x::double * 8) as prok, list_transform(embedding[17:18], lambda x: x::double * 8) as organelle,
      list_transform(embedding[19:23], lambda x: x::double * 8) as first, list_transform(embedding[24:26], lambda x: x::double * 8) as second, embedding[31]::double as e from embeddings)"""
_SM = lambda v, t=1.0: f"list_transform({v}, lambda x_: exp((x_ - list_max({v})) / {t}) / list_sum(list_transform({v}, lambda y_: exp((y_ - list_max({v})) / {t}))))"
_LSE = lambda v: f"(list_max({v}) + ln(list_sum(list_transform({v}, lambda y_: exp(y_ - list_max({v}))))))"
_AM = lambda v: f"list_position({v}, list_max({v}))"
_NLL = lambda v: f"({_LSE(v)} - {v}[y + 1])"
_MIX = lambda a, b, k: f"list_transform(list_zip({a}, {b}), lambda q: q[1] + {k} * q[2])"
_D = f"""{_E}, pr as (select *, {_SM('root', 2.0)} as pr, {_SM('euk', 0.5)} as pe, {_SM('prok')} as pp, {_SM('organelle')} as po from l),
    dc as (select *, ['euk_nuclear', 'prok', 'organelle'][{_AM('pr')}] as dr, list_max(pr) as rp, case {_AM('pr')} when 1 then list_max(pe) when 2 then list_max(pp) else list_max(po) end as lp,
      case {_AM('pr')} when 1 then ['fungi', 'land_plant', 'algae', 'metazoa_vertebrate', 'metazoa_invertebrate', 'alveolata', 'stramenopiles', 'other_protist'][{_AM('pe')}] when 2 then ['bacteria', 'archaea'][{_AM('pp')}] else ['mitochondria', 'plastid'][{_AM('po')}] end as lf from pr),
    de as (select *, case when rp < 0.4 or (dr = 'euk_nuclear' and lp < 0.3) or (dr = 'prok' and lp < 0.6) then 'unknown' else lf end as dl from dc),
    tr as (select *, ['euk_nuclear', 'prok', 'organelle'][y + 1] as root_t, case y when 0 then ['fungi', 'land_plant', 'algae', 'metazoa_vertebrate', 'metazoa_invertebrate', 'alveolata', 'stramenopiles', 'other_protist'][label % 8 + 1] when 1 then ['bacteria', 'archaea'][label % 2 + 1] else ['mitochondria', 'plastid'][label % 2 + 1] end as leaf_t from de)"""
_C = """c as (select case when p_size % 2 = 0 then 'first' else 'second' end as stage, (p_size % 6 + 3)::int as k, 'c' || p_partkey as candidate, round(p_retailprice % 97 / 97, 4) as mean_f1, p_partkey % 5 = 0 as collapsed, p_partkey % 100 / 100 as pred_share, p_partkey % 37 / 2.0::double as seconds from part)"""
# water-filling of a goal over c (st, bp, w): by level, rounded half to even, the drift to the roomiest
_FILL = lambda goal: f"""w1 as (select *, case when w > 0 then bp / w end as brk, case when w > 0 then bp else 0 end as live from c), w2 as (select *, coalesce(sum(live) over (order by brk nulls last, st rows between unbounded preceding and 1 preceding), 0) as filled, sum(w) over (order by brk nulls last, st rows between current row and unbounded following) as ws, {goal} as goal from w1),
      w3 as (select *, case when ws > 0 then (goal - filled) / ws end as lev from w2), w4 as (select *, (select arg_min(lev, (brk, st)) filter (brk > lev) from w3) as lv from w3), w5 as (select *, least(bp, round_even(case when w > 0 then least(bp, coalesce(greatest(lv, 0) * w, bp)) else 0 end, 0))::bigint as q from w4),
      w6 as (select *, case when w > 0 then bp - q else 0 end as free, greatest(0, least(goal, sum(live) over ()) - sum(q) over ()) as drift from w5), fill as (select st, bp, (q + greatest(0, least(free, drift - coalesce(sum(free) over (order by free desc, st rows between unbounded preceding and 1 preceding), 0))))::bigint as quota from w6)"""  # noqa: E731
_PLAN = lambda weight: f"""s as (select case when lang = 'en' then 'eukarya/' || source else lang end as st, sum(n_chars)::bigint as bp from documents group by 1), ck as (select split_part(st, '/', 1) as c, sum(bp)::bigint as bp from s group by 1), pr as (select * from (values ('eukarya', 0.4::double), ('de', 0.2::double), ('fr', 0.2::double), ('es', 0.2::double)) v(c, p)),
      tt as (select floor(min(bp / p)) as total from ck join pr using (c)), gg as (select c, bp, round_even(total * p, 0)::bigint as want from ck join pr using (c), tt), c as (select 'eukarya/src' || i as st, coalesce(bp, 0) as bp, ({weight})::double as w from range(20) t(i) left join s on st = 'eukarya/src' || i), {_FILL("(select want from gg where c = 'eukarya')")},
      plan as (select c as stratum, bp as available_bp, want as target_bp from gg where c <> 'eukarya' union all select st, bp, quota from fill)"""  # noqa: E731
_W13 = lambda t, cls, key, take: f"""c as (select {cls} as c, count(*) as n from {t} group by 1), k as (select c, n, {take}::bigint as take from c), w as (select c, round_even(i * (n - 1) / greatest(take - 1, 1)::double, 0)::bigint as at from k, range(0, take) t(i)),
    r as (select {key}, {cls}, row_number() over (partition by {cls} order by {key}) - 1 as at from {t})"""  # noqa: E731

SQL = {
    "m02_kmers_two_ks": f"""with a as (select 3 as k, {_CODE(3)} as code, doc_id, count(*) as n from {_KC(3)} group by all), b as (select 4 as k, {_CODE(4)} as code, doc_id, count(*) as n from {_KC(4)} group by all)
        select k, code, sum(n)::bigint as n, count(*) as documents from (select * from a union all select * from b) group by k, code""",
    "t07_kmer_counts_k7": f"select doc_id as id, count(*) as kinds, sum(n)::bigint as kmers, sum(n * (code + 1))::bigint as codes from (select doc_id, {_CODE(7)} as code, count(*) as n from {_KC(7)} group by all) group by doc_id",
    "a11_doc_freq": f"select 4 as k, {_CODE(4)} as code, count(distinct doc_id) as df from {_KC(4)} group by 2 union all select 5, {_CODE(5)}, count(distinct doc_id) from {_KC(5)} group by 2",
    "a12_idf": f"""with f as (select {_CODE(5)} as code, count(distinct doc_id) as df from {_KC(5)} group by 1) select i as code, coalesce(df, 0) as df, round(ln(((select count(*) from documents) + 1.0::double) / (coalesce(df, 0) + 1)) + 1, 6) as idf from range(1024) t(i) left join f on code = i""",
    "m01_tfidf_k7": f"""with c as (select doc_id, upper(w) as w, count(*) as n from {_KC(7)} group by all), f as (select w, count(*) as df from c group by w), x as (select doc_id, n * (ln(((select count(*) from documents) + 1.0::double) / (df + 1)) + 1) as v from c join f using (w)), y as (select doc_id, v / sqrt(sum(v * v) over (partition by doc_id)) as v from x),
        z as (select doc_id, count(*) as entries, round(sum(v), 5) as total, round(max(v), 5) as largest from y group by doc_id) select d.doc_id as id, coalesce(entries, 0) as entries, coalesce(total, 0) as total, coalesce(largest, 0) as largest from documents d left join z using (doc_id)""",
    "m03_idf_model": f"with f as (select {_CODE(4)} as code, count(distinct doc_id) as df from {_KC(4)} group by 1) select i as code, coalesce(df, 0) as df from range(256) t(i) left join f on code = i",
    "m04_biosignals": f"""with d as (select doc_id, upper(coalesce({DNA}, '')) as s from documents), c as (select doc_id, length(s) as n, length(s) - length(replace(s, 'A', '')) as a, length(s) - length(replace(s, 'C', '')) as c, length(s) - length(replace(s, 'G', '')) as g, length(s) - length(replace(s, 'T', '')) as t, length(s) - length(replace(s, 'N', '')) as nn from d)
        select doc_id, 60 as n, round(ln(1 + n::double)::float::double, 4) as log_length, round(((c + g) / greatest(a + c + g + t, 1))::float::double, 4) as gc, round((nn / greatest(n, 1))::float::double, 4) as n_share from c""",
    "m08_cascade": f"""with {_E}, p as (select vec_id % 200 as record, {_SM('first', 0.5)} as f, {_SM('second', 0.5)} as s from l), m as (select record, count(*) as fragments, [avg(f[1]), avg(f[2]), avg(f[3]), avg(f[4]), avg(f[5])] as f, [avg(s[1]), avg(s[2]), avg(s[3])] as s from p group by record),
        d as (select *, case when list_max(f) > 0.3 then ['organelle', 'bacteria', 'unknown', 'archaea', 'eukarya'][{_AM('f')}] when f[4] + f[2] > 0.3 then 'prokarya' else 'unknown' end as first from m)
        select record, fragments, first, case when first = 'organelle' then case when list_max(s) > 0.4 then ['plastid', 'unknown', 'mitochondrion'][{_AM('s')}] else 'unknown' end end as second from d""",
    "m09_hier_decode": f"with {_D} select vec_id, dr as root, dl as leaf, round(rp, 6) as root_p, round(lp, 6) as leaf_p from de",
    "m10_route": f"with {_E} select vec_id, case when length < 2500 then {_AM('root')} else {_AM('residual')} end as place from l",
    "m11_blend": f"with {_E}, b as (select vec_id, case when length < 2500 then {_MIX('root', 'residual', 0.125)} else root end as z from l) select vec_id, round(z[1], 6) as a, {_AM('z')} as place from b",
    "m12_promote": f"""with {_E}, p as (select *, {_SM('root')} as r, greatest(1e-7::double, least(1 - 1e-7::double, 1 / (1 + exp(-20 * e)))) as x from l), b as (select *, case when r[1] >= 0.1 then least(0.7 * case when length >= 5000 then 0.5 when length >= 2500 then 0.8 else 1 end * greatest(0, ln(x / (1 - x)) - ln(0.6::double / 0.4::double)), 2.0) else 0 end as boost from p),
        g as (select *, [ln(r[1]) + boost, ln(r[2]), ln(r[3])] as g from b), o as (select *, {_SM('g')} as o from g) select vec_id, round(o[1], 6) as euk, r[1] >= 0.1 and {_AM('r')} <> 1 and {_AM('o')} = 1 as promoted from o""",
    "m13_local_correct": f"""with {_E}, a as (select *, {_AM('root')} = 2 and sqrt(residual[1] * residual[1] + residual[2] * residual[2]) >= 1.0 as active from l) select vec_id, active, round(prok[1] + case when active then 0.5 * residual[1] else 0 end, 6) as a from a""",
    "m14_pick_models": f"""with {_C}, m as (select stage, k, max(mean_f1) as mean_f1, max(candidate) as weights from c group by stage, k), r as (select *, row_number() over (partition by stage order by mean_f1 desc, k desc) as i from m where k <> 4 and (stage <> 'second' or k = 5)) select stage, k, mean_f1, weights from r where i = 1""",
    "a30_summarize": f"with {_D} select vec_id % 3 as file, dl as leaf, count(*) as records, round(count(*) / sum(count(*)) over (partition by vec_id % 3), 6) as share from de group by 1, 2",
    "a19_evaluate_hier": f"""with {_D}, f as (select 'root' as head, root_t as t, dr as p from tr union all select case y when 0 then 'euk' when 1 then 'prok' else 'organelle' end, leaf_t, dl from tr),
        k as (select * from (values ('root', 'euk_nuclear'), ('root', 'prok'), ('root', 'organelle'), ('euk', 'fungi'), ('euk', 'land_plant'), ('euk', 'algae'), ('euk', 'metazoa_vertebrate'), ('euk', 'metazoa_invertebrate'), ('euk', 'alveolata'), ('euk', 'stramenopiles'), ('euk', 'other_protist'), ('prok', 'bacteria'), ('prok', 'archaea'), ('organelle', 'mitochondria'), ('organelle', 'plastid')) v(head, cls)),
        m as (select head, cls, (select count(*) from f where f.head = k.head and t = cls) as support, (select count(*) from f where f.head = k.head and p = cls) as predicted, (select count(*) from f where f.head = k.head and t = cls and p = cls) as hit from k), n as (select * from m where head <> 'root' or support > 0)
        select head, cls, support, round(coalesce(hit / nullif(predicted, 0), 0), 6) as precision, round(coalesce(hit / nullif(support, 0), 0), 6) as recall, round(coalesce(2 * hit / nullif(support + predicted, 0), 0), 6) as f1, round(avg(coalesce(2 * hit / nullif(support + predicted, 0), 0)) over (partition by head), 6) as macro_f1,
        round((select avg((root_t = dr and leaf_t = dl)::int) from tr), 6) as cascade_accuracy from n""",
    "a17_confusion": f"""with {_D}, k as (select unnest(['euk_nuclear', 'prok', 'organelle', 'virus']) as x) select a.x as truth, b.x as pred, (select count(*) from tr where root_t = a.x and dr = b.x) as n from k a cross join k b""",
    "j23_align": """with t as (select vec_id from embeddings where vec_id % 7 > 0), p as (select vec_id, case when vec_id % 50 = 1 then 2 else 1 end as c from embeddings where vec_id % 5 > 0) select (select count(*) from t where vec_id in (select vec_id from p)) as records, (select count(*) from t where vec_id not in (select vec_id from p)) as missing, (select count(*) from p where vec_id not in (select vec_id from t)) as extra, (select count(*) from p where c > 1) as duplicates""",
    "a20_nll": f"with {_E} select grp, round(avg({_NLL('root')}), 6) as nll from l group by grp",
    "a21_binary_logits": f"with {_E}, b as (select vec_id, euk, euk[1:2] || euk[4:8] as r from l) select vec_id, round({_LSE('r')}, 6) as rest, round(euk[3], 6) as positive from b",
    "a22_best_f1_eligible": f"""with {_E}, p as (select round({_SM('root')}[1] * 1000) / 1000 as p, (y = 0)::int as y, {_AM('root')} = 1 as el from l), a as (select case when el then p else -1 end as s, count(*) as n, sum(y) as pos from p group by 1), b as (select s, sum(n) over w as rows, sum(pos) over w as tp, sum(pos) over () as ap from a window w as (order by s desc)),
        c as (select case when el then p else 0 end as s, count(*) as n, sum(y) as pos from p group by 1), d as (select s, pos, sum(n) over w as rows, sum(pos) over w as tp, sum(pos) over () as ap from c window w as (order by s desc))
        select s as threshold, round(2 * tp / (rows + ap), 6) as f1, (select round(sum(pos / ap * tp / rows), 6) from d) as auprc from b order by 2 * tp / (rows + ap) desc, s desc limit 1""",
    "a24_alpha_surface": f"""with {_E}, b as (select coalesce((select lo || '-' || (hi - 1) from (values (800, 1000), (1000, 1250), (1250, 1500), (1500, 1750), (1750, 2000), (2000, 2250), (2250, 2500)) t(lo, hi) where length >= lo and length < hi), 'outside') as cell, al as alpha, y, {_MIX('root', 'residual', 'al')} as z from l, (select unnest([-0.25, 0.0, 0.125, 0.5, 1.0]::double[]) as al)),
        p as (select cell, alpha, y, {_AM('z')} - 1 as p, {_NLL('z')} as loss from b), g as (select cell, alpha, count(*) as n, avg(loss) as nll, list_transform([0, 1, 2], lambda c: 0.0) as u, count(*) filter (y = 0 and p = 0) as t0, count(*) filter (y = 1 and p = 1) as t1, count(*) filter (y = 2 and p = 2) as t2,
          count(*) filter (y = 0) + count(*) filter (p = 0) as s0, count(*) filter (y = 1) + count(*) filter (p = 1) as s1, count(*) filter (y = 2) + count(*) filter (p = 2) as s2 from p group by all)
        select cell, alpha, n, round(nll, 6) as nll, round((coalesce(2 * t0 / nullif(s0, 0), 0) + coalesce(2 * t1 / nullif(s1, 0), 0) + coalesce(2 * t2 / nullif(s2, 0), 0)) / 3, 6) as macro_f1 from g""",
    "a25_compare_losses": f"""with {_E}, z as (select *, {_MIX('root', 'residual', 0.125)} as z from l), p as (select y, {_AM('root')} - 1 as a, {_AM('z')} - 1 as b, {_NLL('root')} as la, {_NLL('z')} as lb from z)
        select count(*) as n, count(*) filter (a = y and b = y) as both, count(*) filter (a = y and b <> y) as only_a, count(*) filter (a <> y and b = y) as only_b, count(*) filter (a <> y and b <> y) as neither, round(avg((a <> b)::int), 6) as disagreement, round(2.8 * sqrt(avg((a <> b)::int) / count(*)), 6) as detectable,
        round(count(*) filter (a = y or b = y) / count(*), 6) as oracle_accuracy, round(corr(la, lb), 6) as loss_correlation, round(stddev_pop(la) / stddev_pop(lb), 6) as std_ratio from p""",
    "a29_fingerprint": f"""with u as (select * from {FR} union all select * from {FR} where doc_id % 10 = 0), h as (select split, class as cls, bp, ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint as h from u) select split, cls, count(*) as records, sum(bp)::bigint as bp, sum(h)::varchar as ids, sum((h % 65536) * (h % 65536))::varchar as ids2 from h group by all""",
    "a29_verify": f"""with f as (select split, class as cls, doc_id from {FR}), o as (select distinct split, cls from f where not (split = 'test' and cls = 'archaea')), n as (select distinct split, cls from f where not (split = 'train' and cls = 'bacteria') and doc_id <> 1)
        select coalesce(o.split, n.split) as split, coalesce(o.cls, n.cls) as cls, case when n.cls is null then 'missing' when o.cls is null then 'unexpected' else 'changed' end as problem from o full join n on o.split = n.split and o.cls = n.cls where o.cls is null or n.cls is null or (o.split, o.cls) = (select (split, cls) from f where doc_id = 1)""",
    "a31_hp_rollup": f"""with {_C}, r as (select *, row_number() over (partition by stage, k order by seconds) as i, count(*) over (partition by stage, k) as n from c) select stage, k, count(*) as candidates, sum(seconds) as total_seconds, max(seconds) as slowest, max(case when i = n // 2 + 1 then seconds end) as median, max(mean_f1) as best_f1, arg_min(candidate, (-mean_f1, candidate)) as best from r group by stage, k""",
    "w28_best_candidate": f"""with {_C}, d as (select * replace (collapsed or k = 3 as collapsed) from c), g as (select stage, k, arg_min(candidate, (-mean_f1, candidate)) filter (not collapsed) as candidate, max(mean_f1) filter (not collapsed) as mean_f1, count(*) as candidates, count(*) filter (collapsed) as collapsed from d group by stage, k)
        select *, case when candidate is null then 'all_collapsed' when mean_f1 < 0.985 then 'below_floor' end as problem from g""",
    "w29_gate_models": f"""with {_C}, d as (select * replace (collapsed or k = 3 as collapsed) from c where k <> 8), g as (select stage, k, arg_min(pred_share, (-mean_f1, candidate)) filter (not collapsed) as s, max(mean_f1) filter (not collapsed) as m, count(*) as n from d group by stage, k), w as (select distinct stage, k from c),
        p as (select w.stage, w.k, case when n is null then 'missing' when m is null then 'all_collapsed' when m < 0.985 then 'below_floor' when s > 0.9 then 'single_class' end as problem from w left join g using (stage, k)) select * from p where problem is not null""",
    "w30_maximin": """with d as (select l_suppkey as seed, round(avg(case when l_linenumber % 4 = 0 then l_discount end) - 0.04, 6) as r, round(avg(case when l_linenumber % 4 = 1 then l_discount end) - 0.04, 6) as e, round(avg(case when l_linenumber % 4 = 2 then l_discount end) - 0.04, 6) as p, round(avg(case when l_linenumber % 4 = 3 then l_discount end) - 0.04, 6) as o from lineitem group by 1)
        select seed, least(r, e, p, o) as score, r >= 0.01 and least(e, p, o) >= 0 as promoted, row_number() over (order by least(r, e, p, o) desc, r desc, seed)::int as rank from d""",
    "w31_run_gates": f"""with r as (select doc_id, split, euk_group, species_taxid, split_group_id from {FR} where class = 'eukarya' and split <> 'test'), l as (select unnest(['fungi', 'algae', 'absent']) as g),
        v as (select euk_group as g, count(*) as s, avg((doc_id % 3 = 0)::int) as c from r group by 1), f as (select 'labels_resolved' as gate, (select count(*) from r where euk_group = '') as failures
          union all select 'leaves_in_both_splits', (select count(*) from l, (select unnest(['train', 'validation']) as s) where not exists (select 1 from r where r.split = s and r.euk_group = l.g))
          union all select 'no_leakage', (select count(*) from (select species_taxid from r group by 1 having count(distinct split) > 1)) + (select count(*) from (select split_group_id from r group by 1 having count(distinct split) > 1))
          union all select 'leaf_metrics', (select count(*) from l left join v using (g) where coalesce(s, 0) = 0 or coalesce(c, 0) < 0.3) union all select 'benchmark_not_worse', 0)
        select gate, failures = 0 as passed, failures::bigint as failures from f""",
    "w33_pareto_winner": "select p_partkey, p_size, p_retailprice from part where p_retailprice >= (select max(p_retailprice) from part) - 30 order by p_size desc, p_retailprice desc, p_partkey limit 1",
    "w13_spaced_sample": f"with {_W13('orders', 'o_orderpriority', 'o_orderkey', 'least(n, greatest(1, round_even(n * (1000 / (select count(*) from orders))::double, 0)))')} select o_orderkey, o_orderpriority from r where exists (select 1 from w where w.c = o_orderpriority and w.at = r.at)",
    "w13_equal_sample": f"with {_W13('documents', 'lang', 'doc_id', 'least(n, greatest(1, least(300, (select count(*) from documents)) // (select count(distinct lang) from documents)))')} select doc_id, lang from r where exists (select 1 from w where w.c = lang and w.at = r.at)",
    "w15_derive_targets": f"""with h as (select class as cls, count(*) as n from {FR} group by 1), c as (select x.cls, coalesce(n, 0) as n, x.i from (values ('bacteria', 1), ('archaea', 2), ('eukarya', 3)) x(cls, i) left join h using (cls)),
        w as (select s, t, cls, n, i, case s when 'original' then case cls when 'bacteria' then 439077 when 'archaea' then 179370 else 327639 end when 'balanced' then 1 else case cls when 'eukarya' then 5 else 1 end end as w from c, (values ('original', 700), ('balanced', (select 3 * min(n) from c)), ('custom', 500)) z(s, t)),
        r as (select *, t * w / sum(w) over (partition by s)::double as raw from w), q as (select *, floor(raw)::bigint + (row_number() over (partition by s order by raw - floor(raw) desc, i) <= t - sum(floor(raw)) over (partition by s))::int as q from r),
        a as (select 'preserve' as strategy, cls, n, n as q from c union all select 'legacy', cls, n, case when cls = 'eukarya' then floor(2.5 * (select sum(n) from c where cls <> 'eukarya'))::bigint else n end from c union all select s, cls, n, q from q)
        select strategy, cls, n as available, q::bigint as requested, least(q, n)::bigint as effective, greatest(0, q - n)::bigint as shortage from a""",
    "w16_allocate_rates": """with c as (select l_partkey, count(*) as n from lineitem group by 1), b as (select *, least(n, 30) as cap, least(5, least(n, 30)) as lo, sqrt(n) as w from c), t as (select least(20000, sum(cap))::double as goal, sum(lo) as los from b),
        o as (select b.*, lo * least(1, goal / greatest(1, los)) as low, goal from b, t), p as (select *, (cap - low) / w as brk from o), s as (select *, coalesce(sum(cap - low) over (order by brk, l_partkey rows between unbounded preceding and 1 preceding), 0) as filled, sum(w) over (order by brk, l_partkey rows between current row and unbounded following) as ws, sum(low) over () as lows from p),
        lv as (select *, (goal - lows - filled) / ws as lev from s), f as (select arg_min(lev, (brk, l_partkey)) filter (brk > lev) as lev from lv) select l_partkey, n, round(low + least(cap - low, coalesce(greatest(f.lev, 0) * w, cap - low)), 4) as quota, round(least(1, (low + least(cap - low, coalesce(greatest(f.lev, 0) * w, cap - low))) / n), 4) as rate from lv, f""",
    "w18_bp_plan": f"with {_PLAN('1')} select stratum, available_bp, target_bp, round(target_bp / available_bp, 6) as rate from plan",
    "balanced_corpus": f"""with {_PLAN('1 + i % 3')}, r as (select *, target_bp / available_bp as rate from plan), d as (select doc_id, n_chars, case when lang = 'en' then 'eukarya/' || source else lang end as stratum from documents),
        k as (select stratum, n_chars from d join r using (stratum) where rate >= 1 or (rate > 0 and ('0x' || substr(md5('42:' || doc_id), 1, 8))::bigint < floor(rate * 4294967296)::bigint)), g as (select stratum, sum(n_chars)::bigint as kept_bp, count(*) as kept_records from k group by stratum)
        select stratum, available_bp, target_bp, coalesce(kept_bp, 0) as kept_bp, coalesce(kept_records, 0) as kept_records, case when target_bp > 0 then round(100.0::double * (coalesce(kept_bp, 0) - target_bp) / target_bp, 6) end as error_pct from r left join g using (stratum)""",
    "w17_allocate_capped": f"""with c as (select source as st, sum(n_chars)::bigint as bp, (substr(source, 4)::int % 4)::double as w from documents group by 1), {_FILL('1000000')} select st as source, bp as cap, quota from fill""",
    "w20_balance_rates": """with c as (select l_suppkey, count(*) as n from lineitem group by 1), w as (select *, 30000 * (sqrt(n) / sum(sqrt(n)) over ()) as want from c), r as (select l_suppkey, n, round_even(least(1.0, greatest(want, 310) / n), 6) as rate from w) select *, floor(n * rate)::bigint as expected from r""",
    "w21_hash_cap": "select l_suppkey, count(*) as rows from (select *, count(*) over (partition by l_suppkey) as n from lineitem) where ('0x' || substr(md5('cap:' || l_orderkey), 1, 8))::bigint / 4294967296.0::double < 100.0::double / n group by 1",
    "w23_cap_target": """with a as (select source, count(*) as n, case when source = 'src0' then 40.0::double else 1.0 end as w from documents group by source), p as (select source, n, n / sum(n) over () as p, w / sum(w) over () as q from a), o as (select *, 2.0 * p as cap, 2.0 * p / q as brk from p),
        s as (select *, coalesce(sum(cap) over (order by brk, source rows between unbounded preceding and 1 preceding), 0) as filled, sum(q) over (order by brk, source rows between current row and unbounded following) as qs from o), lv as (select *, (1 - filled) / qs as lev from s), f as (select arg_min(lev, (brk, source)) filter (brk > lev) as lev from lv)
        select source, n, round(least(cap, coalesce(f.lev * q, cap)) / sum(least(cap, coalesce(f.lev * q, cap))) over (), 6) as effective from lv, f""",
    "w24_donor_caps": """with g as (select o_orderpriority as p, o_custkey as c, c % 40 as s, c % 8 as x, sum(o_custkey % 7 + 1)::bigint as n from orders group by 1, 2), w as (select *, n / sum(n) over (partition by p) as w from g),
        a as (select *, 0.025 / w as s0 from w),
        b1 as (select *, (0.04 - coalesce(sum(w * s0) over (partition by p, s order by s0, c rows between unbounded preceding and 1 preceding), 0)) / sum(w) over (partition by p, s order by s0 desc, c desc rows unbounded preceding) as l from a),
        b as (select *, least(s0, coalesce(min(case when s0 >= l then l end) over (partition by p, s), s0)) as s1 from (select * replace (case when s0 >= l and row_number() over (partition by p, s, s0 >= l order by s0, c) = 1 then l end as l) from b1)),
        c1 as (select *, (0.132 - coalesce(sum(w * s1) over (partition by p, x order by s1, c rows between unbounded preceding and 1 preceding), 0)) / sum(w) over (partition by p, x order by s1 desc, c desc rows unbounded preceding) as m from b),
        d as (select *, least(s1, coalesce(min(m) over (partition by p, x), s1)) as s2 from (select * replace (case when s1 >= m and row_number() over (partition by p, x, s1 >= m order by s1, c) = 1 then m end as m) from c1)),
        e1 as (select *, (1 - coalesce(sum(w * s2) over (partition by p order by s2, c rows between unbounded preceding and 1 preceding), 0)) / sum(w) over (partition by p order by s2 desc, c desc rows unbounded preceding) as k from d),
        e as (select *, least(s2, coalesce(min(k) over (partition by p), s2)) as s3 from (select * replace (case when s2 >= k and row_number() over (partition by p, s2 >= k order by s2, c) = 1 then k end as k) from e1))
        select p as o_orderpriority, c as o_custkey, n, round(w * s3, 9) as share from e""",
    "w25_row_weights": f"""with f as (select doc_id, class as root, euk_group as leaf from {FR} where class <> 'eukarya' or euk_group not in ('', 'nonsense')), r as (select root, count(*) as n from f group by root), l as (select leaf, count(*) as m, case when leaf = 'fungi' then 3.0::double else 1.0 end as w from f where root = 'eukarya' group by leaf),
        p as (select leaf, m, m / sum(m) over () as p, w / sum(w) over () as q from l), o as (select *, 1.5 * p as cap, 1.5 * p / q as brk from p), s as (select *, coalesce(sum(cap) over (order by brk, leaf rows between unbounded preceding and 1 preceding), 0) as filled, sum(q) over (order by brk, leaf rows between current row and unbounded following) as qs from o),
        lv as (select *, (1 - filled) / qs as lev from s), g as (select arg_min(lev, (brk, leaf)) filter (brk > lev) as lev from lv), e as (select leaf, m, least(cap, coalesce(g.lev * q, cap)) / sum(least(cap, coalesce(g.lev * q, cap))) over () as e from lv, g)
        select doc_id, round(1.0 / (select count(*) from r) * case when root = 'eukarya' then e / m else 1.0 / n end, 9) as weight from f join r using (root) left join e on root = 'eukarya' and e.leaf = f.leaf""",
    "w26_weighted_sample": """with o as (select o_orderkey, (o_orderkey % 7 + 1)::double as w from orders), u as (select *, sum(w) over (order by o_orderkey) as hi, sum(w) over () as t from o), d as (select ('0x' || substr(md5('42:0:' || i), 1, 13))::bigint / 4503599627370496.0::double as p from range(20000) t(i))
        select o_orderkey, w, count(*) as draws from d asof join (select o_orderkey, w, (hi - w) / t as lo from u) b on d.p >= b.lo group by all""",
    "w27_donor_index": """with c as (select o_custkey, row_number() over (order by min(o_orderkey)) - 1 as o_custkey_code from orders group by 1), p as (select o_orderpriority, row_number() over (order by min(o_orderkey)) - 1 as o_orderpriority_code from orders group by 1) select o_orderkey, o_custkey_code, o_orderpriority_code from orders join c using (o_custkey) join p using (o_orderpriority)""",
    "a02_estimated_census": """select l_returnflag, l_linestatus, (count(*) / 0.1::double)::bigint as records, (sum(l_quantity::bigint) / 0.1::double)::bigint as bp, round(avg(l_quantity::bigint), 6) as mean_bp from lineitem where ('0x' || substr(md5('42:' || l_orderkey), 1, 8))::bigint < 429496729 group by all""",
}
