"""Scores: cascades and hierarchies of classifiers decoded, blended and corrected; truth against predictions; choices and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import argmax, nll, softmax
from . import metrics

# Classes by place in the two stages of the cascade.
FIRST = ("organelle", "bacteria", "unknown", "archaea", "eukarya")
SECOND = ("plastid", "unknown", "mitochondrion")
# The heads of the hierarchy and their classes; the branch that each root class opens.
ROOT = ("euk_nuclear", "prok", "organelle")
HEADS = {"euk": ("fungi", "land_plant", "algae", "metazoa_vertebrate", "metazoa_invertebrate", "alveolata", "stramenopiles", "other_protist"), "prok": ("bacteria", "archaea"), "organelle": ("mitochondria", "plastid")}
BRANCH = {"euk_nuclear": "euk", "prok": "prok", "organelle": "organelle"}


def _pick(names: Sequence[str], place: Column) -> Column:
    return F.element_at(F.array(*(F.lit(n) for n in names)), place)


def mean_probabilities(df: DataFrame, id_: str, probs: str, n: int) -> DataFrame:
    """Per record the mean of its fragments' arrays of n probabilities."""
    return df.groupBy(id_).agg(F.array(*(F.avg(F.get(probs, F.lit(i))) for i in range(n))).alias(probs), F.count(F.lit(1)).alias("fragments"))


def cascade(first: Column, second: Column, cutoff_first: float = 0.65, cutoff_second: float = 0.65) -> Column:
    """struct(first, second) of two arrays of probabilities. First stage: the most likely class if its probability is over the cutoff, else prokarya if archaea and bacteria are together, else
    unknown. Only an organelle has a second stage: the most likely class over the cutoff, else unknown."""
    top = F.array_max(first)
    prok = F.get(first, F.lit(FIRST.index("archaea"))) + F.get(first, F.lit(FIRST.index("bacteria")))
    one = F.when(top > cutoff_first, _pick(FIRST, argmax(first))).when(prok > cutoff_first, "prokarya").otherwise("unknown")
    two = F.when(F.array_max(second) > cutoff_second, _pick(SECOND, argmax(second))).otherwise("unknown")
    return F.struct(one.alias("first"), F.when(one == "organelle", two).alias("second"))


def hier_decode(root: Column, heads: Mapping[str, Column], temperatures: Mapping[str, float] = {}, thresholds: Mapping[str, float] = {}, given: str = "logits", roots: Sequence[str] = ROOT, classes: Mapping[str, Sequence[str]] = HEADS) -> Column:  # noqa: B006
    """struct(root, leaf, root_probability, leaf_probability): the most likely root, and of the branch that it opens the most likely leaf (else the root itself); `unknown` as leaf if either
    is below its threshold. given: `logits`, of which softmax with the head's temperature is taken, or `probabilities`."""
    p = (lambda h, c: softmax(c, temperatures.get(h, 1.0))) if given == "logits" else (lambda h, c: c)
    top = p("root", root)
    name, sure = _pick(roots, argmax(top)), F.array_max(top)
    leaf, leaf_p, low = name, sure, sure < float(thresholds.get("root", 0))
    for r, h in BRANCH.items():
        if r in roots and h in heads:
            own = p(h, heads[h])
            leaf = F.when(name == r, _pick(classes[h], argmax(own))).otherwise(leaf)
            leaf_p = F.when(name == r, F.array_max(own)).otherwise(leaf_p)
            low = low | ((name == r) & (F.array_max(own) < float(thresholds.get(h, 0))))
    return F.struct(name.alias("root"), F.when(low, "unknown").otherwise(leaf).alias("leaf"), sure.alias("root_probability"), leaf_p.alias("leaf_probability"))


def route_by_length(bp: Column, short: Column, long: Column, below: int = 2500) -> Column:
    """The short expert's array for sequences shorter than `below`, the long one's from there on."""
    return F.when(bp < below, short).otherwise(long)


def blend(bp: Column, logits: Column, residual: Column, alpha: float, below: int = 2500) -> Column:
    """logits + alpha * residual for sequences shorter than `below`."""
    return F.when(bp < below, F.zip_with(logits, residual, lambda a, b: a + alpha * b)).otherwise(logits)


def promote(root: Column, expert: Column, bp: Column, tau: float, alpha: float, most: float, least: float, middle: float = 1.0, long: float = 1.0) -> Column:
    """struct(probabilities, promoted): root probabilities after evidence for the first class (eukaryotes). Evidence: the expert's log-odds over tau's, if above; times alpha and a weight by
    length (1 below 2,500, `middle` below 5,000, `long` from there), `most` at most, added to the first log-probability where that is `least` or more; then normalised. promoted: the most
    likely class became the first by that. Nothing is ever demoted."""
    p = F.greatest(F.lit(1e-7), F.least(F.lit(1 - 1e-7), expert))
    weight = F.when(bp >= 5000, long).when(bp >= 2500, middle).otherwise(1.0)
    evidence = F.greatest(F.lit(0.0), F.log(p / (1 - p)) - F.log(F.lit(tau / (1 - tau))))
    eligible = F.get(root, F.lit(0)) >= least
    boost = F.when(eligible, F.least(alpha * weight * evidence, F.lit(most))).otherwise(0.0)
    logs = F.transform(root, lambda x, i: F.log(F.greatest(F.lit(1e-12), F.least(F.lit(1.0), x))) + F.when(i == 0, boost).otherwise(0.0))
    out = softmax(logs)
    return F.struct(out.alias("probabilities"), (eligible & (argmax(root) != 1) & (argmax(out) == 1)).alias("promoted"))


def local_correct(root: Column, logits: Column, residual: Column, alpha: float, threshold: float, on: int = 1) -> Column:
    """struct(logits, active): logits + alpha * residual where the most likely root is at place `on` (from 0) and the residual's length reaches the threshold."""
    size = F.sqrt(F.aggregate(residual, F.lit(0.0), lambda a, x: a + x * x))
    active = (argmax(root) == on + 1) & (size >= threshold)
    return F.struct(F.when(active, F.zip_with(logits, residual, lambda a, b: a + alpha * b)).otherwise(logits).alias("logits"), active.alias("active"))


def pick_models(models: DataFrame, idf: DataFrame, pinned: Mapping[str, int] = {}) -> DataFrame:  # noqa: B006
    """One model for each stage: of those (stage, k, mean_f1, ...) with an idf of their stage and k, the one with the pinned k, else the best mean_f1 (none counts as -1), then the largest k."""
    usable = models.join(idf.select("stage", "k").distinct(), ["stage", "k"], "left_semi")
    for stage, k in pinned.items():
        usable = usable.where((F.col("stage") != stage) | (F.col("k") == k))
    return usable.groupBy("stage").agg(F.max_by(F.struct(*[c for c in models.columns if c != "stage"]), F.struct(F.coalesce("mean_f1", F.lit(-1.0)), "k")).alias("_m")).select("stage", "_m.*")


def summarize(pred: DataFrame, bucket: str, by: Sequence[str] = ()) -> DataFrame:
    """Records of each output bucket, and their share, per file or whatever `by` tells."""
    n = pred.groupBy(*by, bucket).agg(F.count(F.lit(1)).alias("records"))
    return n.withColumn("share", F.col("records") / F.sum("records").over(Window.partitionBy(*(by or [F.lit(0)]))))


def align(truth: DataFrame, pred: DataFrame, record: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """(rows with truth and prediction, counts): counts has records, missing (truth without prediction), extra (prediction without truth) and duplicates (ids more than once, of either)."""
    both = truth.join(pred, record)
    side = truth.select(record, F.lit(1).alias("t"), F.lit(0).alias("p")).unionByName(pred.select(record, F.lit(0).alias("t"), F.lit(1).alias("p")))
    per = side.groupBy(record).agg(F.sum("t").alias("t"), F.sum("p").alias("p"))
    n = lambda test: F.count(F.when(test, 1))
    return both, per.agg(n((F.col("t") > 0) & (F.col("p") > 0)).alias("records"), n(F.col("p") == 0).alias("missing"), n(F.col("t") == 0).alias("extra"), n((F.col("t") > 1) | (F.col("p") > 1)).alias("duplicates"))


def evaluate_hier(df: DataFrame, roots: Sequence[str] = ROOT, classes: Mapping[str, Sequence[str]] = HEADS) -> DataFrame:
    """df: root, leaf (truth), pred_root, pred_leaf. A row for each class of each head, as class_metrics gives, with cascade_accuracy (root and leaf right, of all rows).

    The root head is of all rows, each other head of the rows whose true root opens it. Root classes that never occur are left out."""
    inverse = {h: r for r, h in BRANCH.items()}
    flat = df.select(F.explode(F.array(F.struct(F.lit("root").alias("head"), F.col("root").alias("truth"), F.col("pred_root").alias("pred")), *(F.struct(F.when(F.col("root") == inverse[h], h).alias("head"), F.col("leaf").alias("truth"), F.col("pred_leaf").alias("pred")) for h in classes))).alias("x")).select("x.*").where("head is not null")
    cells = flat.groupBy("head", "truth", "pred").agg(F.count(F.lit(1)).alias("n"))
    known = df.sparkSession.createDataFrame([("root", r) for r in roots] + [(h, c) for h, names in classes.items() for c in names], "head string, class string")
    sides = cells.select("head", F.explode(F.array(F.struct(F.col("truth").alias("class"), F.lit(1).alias("is_truth")), F.struct(F.col("pred").alias("class"), F.lit(0).alias("is_truth")))).alias("x"), "truth", "pred", "n").select("head", "x.*", "truth", "pred", "n")
    per = sides.groupBy("head", "class").agg(F.sum(F.when((F.col("is_truth") == 1) & (F.col("truth") == F.col("pred")), F.col("n")).otherwise(0)).alias("hit"), F.sum(F.col("n") * F.col("is_truth")).alias("support"), F.sum(F.col("n") * (1 - F.col("is_truth"))).alias("predicted"))
    rows = known.join(per, ["head", "class"], "left").na.fill(0, ["hit", "support", "predicted"]).where((F.col("head") != "root") | (F.col("support") > 0))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    rows = rows.select("head", "class", "support", ratio(F.col("hit"), F.col("predicted")).alias("precision"), ratio(F.col("hit"), F.col("support")).alias("recall"), ratio(2 * F.col("hit"), F.col("support") + F.col("predicted")).alias("f1"))
    right = df.agg(F.avg(((F.col("root") == F.col("pred_root")) & (F.col("leaf") == F.col("pred_leaf"))).cast("double")).alias("cascade_accuracy"))
    return rows.withColumn("macro_f1", F.avg("f1").over(Window.partitionBy("head"))).crossJoin(F.broadcast(right))


def alpha_surface(df: DataFrame, alphas: Sequence[float], base: str, residual: str, y: str, classes: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, alpha, n, nll, macro_f1) of base + alpha * residual for each alpha. Rows are scored once for each alpha and counted by cell before any shuffle."""
    grid = F.explode(F.array(*(F.lit(float(a)) for a in alphas))).alias("alpha")
    rows = df.select(*by, F.col(y).alias("y"), base, residual, grid)
    rows = rows.withColumn("z", F.zip_with(base, residual, lambda a, b: a.cast("double") + F.col("alpha") * b.cast("double")))
    cells = rows.groupBy(*by, "alpha", "y", (argmax(F.col("z")) - 1).alias("pred")).agg(F.count(F.lit(1)).alias("n"), F.sum(nll(F.col("z"), F.col("y"))).alias("loss"))
    whole = cells.groupBy(*by, "alpha").agg(F.sum("n").alias("n"), (F.sum("loss") / F.sum("n")).alias("nll"), *(F.sum(F.when((F.col("y") == c) & (F.col("pred") == c), F.col("n")).otherwise(0)).alias(f"_t{c}") for c in range(classes)), *(F.sum(F.when(F.col("y") == c, F.col("n")).otherwise(0) + F.when(F.col("pred") == c, F.col("n")).otherwise(0)).alias(f"_s{c}") for c in range(classes)))
    f1 = sum((F.coalesce(F.try_divide(2.0 * F.col(f"_t{c}"), F.col(f"_s{c}")), F.lit(0.0)) for c in range(classes)), F.lit(0.0)) / classes
    return whole.select(*by, "alpha", "n", "nll", f1.alias("macro_f1"))


def _scaled(logits: str, beta: float) -> Column:
    return F.transform(logits, lambda x: x.cast("double") * F.lit(beta))


def fit_temperature(df: DataFrame, logits: str, y: str, low: float = 0.05, high: float = 10.0, rounds: int = 5, points: int = 24) -> tuple[float, float]:
    """(temperature, mean negative log-likelihood) at the least over logits / temperature, 1 / temperature from low to high: a grid in one pass over the rows, refined around its least, `rounds` times."""
    best = (1.0, float("inf"))
    for _ in range(rounds):
        betas = [low + (high - low) * i / (points - 1) for i in range(points)]
        row = df.agg(*(F.avg(nll(_scaled(logits, b), F.col(y))).alias(f"b{i}") for i, b in enumerate(betas))).first()
        i = min(range(points), key=lambda j: row[j])
        best = (betas[i], row[i])
        low, high = betas[max(0, i - 1)], betas[min(points - 1, i + 1)]
    return 1 / best[0], best[1]


def hp_rollup(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per search: candidates, sum, largest and upper median of their seconds, and the best one's mean_f1 and name."""
    seconds = F.coalesce(F.col("seconds"), F.lit(0.0))
    sorted_ = F.sort_array(F.collect_list(seconds))  # a search has some hundred candidates at most
    return results.groupBy(*by).agg(F.count(F.lit(1)).alias("candidates"), F.sum(seconds).alias("total_seconds"), F.max(seconds).alias("slowest"), F.get(sorted_, F.floor(F.count(F.lit(1)) / 2).cast("int")).alias("median"), F.max("mean_f1").alias("best_f1"), F.min_by("candidate", F.struct(-F.col("mean_f1"), F.col("candidate"))).alias("best"))


def best_candidate(results: DataFrame, by: Sequence[str], floor: float = 0.0) -> DataFrame:
    """Per search the candidate with the best mean_f1 of those that did not collapse (ties: the smaller name), with problem: all_collapsed, below_floor or null."""
    healthy = F.when(~F.col("collapsed"), F.col("mean_f1"))
    top = results.groupBy(*by).agg(F.min_by(F.when(~F.col("collapsed"), F.col("candidate")), F.when(~F.col("collapsed"), F.struct(-F.col("mean_f1"), F.col("candidate")))).alias("candidate"), F.max(healthy).alias("mean_f1"), F.count(F.lit(1)).alias("candidates"), F.count(F.when(F.col("collapsed"), 1)).alias("collapsed"))
    return top.withColumn("problem", F.when(F.col("candidate").isNull(), "all_collapsed").when(F.col("mean_f1") < floor, "below_floor"))


def gate_models(results: DataFrame, wanted: DataFrame, floor: float = 0.0, most_share: float = 1.0) -> DataFrame:
    """Problems of the models that are wanted (stage, k): missing, all_collapsed, below_floor, single_class (the best one's pred_share over most_share). No rows if all pass."""
    top = best_candidate(results, ["stage", "k"], floor)
    share = results.select("stage", "k", F.col("candidate").alias("candidate"), "pred_share")
    joined = wanted.select("stage", "k").distinct().join(top, ["stage", "k"], "left").join(share, ["stage", "k", "candidate"], "left")
    problem = F.when(F.col("candidates").isNull(), "missing").when(F.col("problem").isNotNull(), F.col("problem")).when(F.col("pred_share") > most_share, "single_class")
    return joined.withColumn("problem", problem).where("problem is not null").select("stage", "k", "problem")


def maximin_select(deltas: DataFrame, heads: Sequence[str], root: str = "root", gain: float = 0.05, regression: float = 0.05) -> DataFrame:
    """deltas: (seed, <a column for each head>), in percentage points. Adds score (the least), promoted (the root gains enough, no other head loses too much) and rank: by score, root and smaller seed."""
    leaves = [h for h in heads if h != root]
    score = F.least(*(F.col(h) for h in heads))
    promoted = (F.col(root) >= gain) & (F.least(*(F.col(h) for h in leaves)) >= -regression if len(leaves) > 1 else F.col(leaves[0]) >= -regression)
    df = deltas.withColumn("score", score).withColumn("promoted", promoted)
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), F.desc(root), "seed")))


def run_gates(records: DataFrame, evaluation: DataFrame, leaves: Sequence[str], keys: Sequence[str], least_recall: float = 0.05, baseline: float | None = None, current: float | None = None, most_loss: float = 0.2) -> DataFrame:
    """(gate, passed, failures): labels resolved, every leaf in both splits, no key in two splits nor id twice, every leaf supported and recalled, and, in percent, the benchmark not worse.

    records: record_id, split, euk_group and keys, of eukaryotes; evaluation: class, support, recall."""
    gate = lambda name, n: F.struct(F.lit(name).alias("gate"), (n == 0).alias("passed"), n.cast("long").alias("failures"))
    spark = records.sparkSession
    unresolved = records.agg(gate("labels_resolved", F.count(F.when(F.coalesce("euk_group", F.lit("")) == "", 1))).alias("g"))
    grid = spark.createDataFrame([(s, g) for s in ("train", "validation") for g in leaves], "split string, euk_group string")
    empty = grid.join(records.select("split", "euk_group").distinct(), ["split", "euk_group"], "left_anti").agg(gate("leaves_in_both_splits", F.count(F.lit(1))).alias("g"))
    leaks = metrics.leakage(records, list(keys), "split").agg(F.coalesce(F.sum("leaked"), F.lit(0)).alias("n"))
    twice = records.groupBy("record_id").agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n"))
    leak = leaks.unionByName(twice).agg(gate("no_leakage", F.sum("n")).alias("g"))
    seen = spark.createDataFrame([(g,) for g in leaves], "class string").join(evaluation, "class", "left")
    weak = seen.agg(gate("leaf_metrics", F.count(F.when((F.coalesce("support", F.lit(0)) == 0) | (F.coalesce("recall", F.lit(0.0)) < least_recall), 1))).alias("g"))
    out = unresolved.unionByName(empty).unionByName(leak).unionByName(weak).select("g.*")
    bad = 1 if baseline is None or current is None or current - baseline < -most_loss else 0
    return out.unionByName(spark.createDataFrame([("benchmark_not_worse", bad == 0, bad)], "gate string, passed boolean, failures long"))


def oof_router(df: DataFrame, base: str, residual: str, y: str, group: str, classes: int, alphas: Sequence[float] = (0.0625, 0.125, 0.25, 0.5, 1.0), quantiles: Sequence[float] = (0.5, 0.7, 0.8, 0.9, 0.95), k: int = 5) -> DataFrame:
    """A row for each fold: the rule and alpha chosen on the other folds, and what they do on it (rows, base_macro_f1, macro_f1, base_only, hybrid_only, activation).

    Folds go by group (group * 2654435761 mod k). A rule says where base + alpha * residual is used: everywhere, where the two disagree, or where the base's entropy, or the residual's
    length, is at or above a quantile of the other folds. Chosen is the best macro-F1 less twice the share of rows that it loses net; of equal ones the smaller alpha, then the rule's
    name. Rules are judged in one pass over rows by alphas and folds, by counts."""
    fold = F.pmod(F.col(group).cast("decimal(38,0)") * F.lit(2654435761).cast("decimal(20,0)"), F.lit(k)).cast("int")
    probs = softmax(F.col("b"))
    rows = df.select(fold.alias("fold"), F.col(y).cast("int").alias("y"), F.transform(base, lambda x: x.cast("double")).alias("b"), F.transform(residual, lambda x: x.cast("double")).alias("r"))
    rows = rows.select("fold", "y", "b", "r", (-F.aggregate(F.transform(probs, lambda p: p * F.log(p + 1e-12)), F.lit(0.0), lambda a, x: a + x)).alias("entropy"), F.sqrt(F.aggregate("r", F.lit(0.0), lambda a, x: a + x * x)).alias("resnorm"), (argmax(F.col("b")) != argmax(F.zip_with("b", "r", lambda a, x: a + x))).alias("disagree"))
    apart = rows.select("entropy", "resnorm", F.explode(F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: f != F.col("fold"))).alias("f"))
    qs = F.array(*(F.lit(float(q)) for q in quantiles))
    cuts = {r.f: (r.e, r.n) for r in apart.groupBy("f").agg(F.percentile("entropy", qs).alias("e"), F.percentile("resnorm", qs).alias("n")).collect()}
    table = df.sparkSession.createDataFrame([(f, f"{name}>={q}", float(c[i][j])) for f, c in cuts.items() for i, name in enumerate(("entropy", "resnorm")) for j, q in enumerate(quantiles)] + [(f, name, 0.0) for f in cuts for name in ("all", "disagree")], "f int, rule string, cut double")
    scored = rows.withColumn("alpha", F.explode(F.array(*(F.lit(float(a)) for a in alphas)))).withColumn("hybrid", argmax(F.zip_with("b", "r", lambda a, x: a + F.col("alpha") * x)) - 1).withColumn("plain", argmax(F.col("b")) - 1)
    each = scored.select("fold", "y", "alpha", "hybrid", "plain", "entropy", "resnorm", "disagree").crossJoin(F.broadcast(table))
    rule = F.substring_index("rule", ">", 1)
    on = F.when(rule == "all", True).when(rule == "disagree", F.col("disagree")).when(rule == "entropy", F.col("entropy") >= F.col("cut")).otherwise(F.col("resnorm") >= F.col("cut"))
    each = each.withColumn("on", on).withColumn("final", F.when(on, F.col("hybrid")).otherwise(F.col("plain")))
    cells = each.groupBy("f", (F.col("fold") == F.col("f")).alias("held"), "alpha", "rule", "y", "final", "plain").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("on"), 1)).alias("active"))

    def f1(side: str) -> Column:
        total = F.lit(0.0)
        for c in range(classes):
            hit = F.sum(F.when((F.col("y") == c) & (F.col(side) == c), F.col("n")).otherwise(0))
            seen = F.sum(F.when(F.col("y") == c, F.col("n")).otherwise(0) + F.when(F.col(side) == c, F.col("n")).otherwise(0))
            total += F.coalesce(F.try_divide(2.0 * hit, seen), F.lit(0.0))
        return total / classes

    count = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    right_plain, right_final = F.col("plain") == F.col("y"), F.col("final") == F.col("y")
    per = cells.groupBy("f", "held", "alpha", "rule").agg(F.sum("n").alias("rows"), f1("plain").alias("base_macro_f1"), f1("final").alias("macro_f1"), count(right_plain & ~right_final).alias("base_only"), count(~right_plain & right_final).alias("hybrid_only"), (F.sum("active") / F.sum("n")).alias("activation"))
    loss = 2 * F.greatest(F.lit(0), F.col("base_only") - F.col("hybrid_only")) / F.col("rows")
    chosen = per.where("not held").groupBy("f").agg(F.min_by(F.struct("alpha", "rule"), F.struct(-(F.col("macro_f1") - loss), F.col("alpha"), F.col("rule"))).alias("c")).select("f", "c.*")
    return per.where("held").join(chosen, ["f", "alpha", "rule"]).select(F.col("f").alias("fold"), "alpha", "rule", "rows", "base_macro_f1", "macro_f1", "base_only", "hybrid_only", "activation")

