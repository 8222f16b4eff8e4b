"""Censuses, audits and model metrics, as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import keep_by_id, md5_number
from .order import running


def census(df: DataFrame, by: Sequence[str], bp: str, grid: DataFrame | None = None) -> DataFrame:
    """Records, base pairs and mean length of every group, null values being a group like others. With `grid` (the columns `by`: a known dimension, such as splits
    by classes), its combinations that are absent have 0."""
    got = df.groupBy(*by).agg(F.count(F.lit(1)).alias("records"), F.sum(bp).alias("bp"))
    if grid is not None:
        own = grid.select(*(F.col(c).alias(f"_{c}") for c in by)).distinct()
        test = F.lit(True)
        for c in by:
            test &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        both = got.join(F.broadcast(own), test, "full")
        got = both.select(*(F.coalesce(c, f"_{c}").alias(c) for c in by), "records", "bp")
    return got.na.fill(0, ["records", "bp"]).withColumn("mean_bp", F.coalesce(F.try_divide("bp", "records"), F.lit(0.0)))


def coverage_cells(df: DataFrame, by: Sequence[str], accession: str, bp: str) -> DataFrame:
    """Per cell: fragments, base pairs, accessions, and of the fragments of an accession the largest number, the upper median and the Gini coefficient.

    An accession's number of fragments is all that counts, so the windows are over each cell's different numbers, not over its accessions."""
    per = df.groupBy(*by, accession).agg(F.count(F.lit(1)).alias("n"), F.sum(bp).alias("bp"))
    kinds = per.groupBy(*by, "n").agg(F.count(F.lit(1)).alias("c"), F.sum("bp").alias("bp"))
    cell = Window.partitionBy(*by)
    kinds = kinds.withColumn("upto", F.sum("c").over(cell.orderBy("n").rowsBetween(Window.unboundedPreceding, 0))).withColumn("m", F.sum("c").over(cell))
    # of c accessions that stand last up to place `upto`, the places add up to c * upto - c * (c - 1) / 2
    places = F.col("c") * F.col("upto") - F.col("c") * (F.col("c") - 1) / 2
    gini = 2 * F.sum(places * F.col("n")) / (F.max("m") * F.sum(F.col("n") * F.col("c"))) - (F.max("m") + 1) / F.max("m")
    middle = F.min(F.when(F.col("upto") >= F.floor(F.col("m") / 2) + 1, F.col("n")))
    return kinds.groupBy(*by).agg(F.sum(F.col("n") * F.col("c")).alias("fragments"), F.sum("bp").alias("bp"), F.max("m").alias("accessions"), F.max("n").alias("largest"), middle.alias("median"), gini.alias("gini"))


def leakage(df: DataFrame, keys: Sequence[str], split: str) -> DataFrame:
    """Per key column: values, those in more than one split, and rows without a value."""
    long = df.select(F.col(split).alias("split"), F.explode(F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys))).alias("x")).select("split", "x.key", "x.value")
    per = long.groupBy("key", "value").agg(F.countDistinct("split").alias("splits"), F.count(F.lit(1)).alias("n"))
    return per.groupBy("key").agg(F.count("value").alias("n_values"), F.count(F.when(F.col("value").isNotNull() & (F.col("splits") > 1), 1)).alias("leaked"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("unresolved"))


def confusion(df: DataFrame, truth: str, pred: str, classes: Sequence[str]) -> DataFrame:
    """(truth, pred, n) of all pairs of known classes, 0 where none, and of any other pair that occurs."""
    known = df.sparkSession.createDataFrame([(a, b) for a in classes for b in classes], "truth string, pred string")
    got = df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    return known.join(got, ["truth", "pred"], "full").na.fill(0, ["n"])


def class_metrics(cells: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Per class precision, recall, F1 and support, 0 where undefined, with the mean F1 of the classes and the accuracy over all cells."""
    one = Window.partitionBy(F.lit(0))
    total = cells.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0)).alias("right"))
    sides = cells.select(F.explode(F.array(F.struct(F.col("truth").alias("class"), F.lit(1).alias("is_truth")), F.struct(F.col("pred").alias("class"), F.lit(0).alias("is_truth")))).alias("x"), "truth", "pred", "n").select("x.*", "truth", "pred", "n")
    per = sides.where(F.col("class").isin(*classes)).groupBy("class").agg(F.sum(F.when((F.col("is_truth") == 1) & (F.col("truth") == F.col("pred")), F.col("n")).otherwise(0)).alias("hit"), F.sum(F.col("n") * F.col("is_truth")).alias("support"), F.sum(F.col("n") * (1 - F.col("is_truth"))).alias("predicted"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = per.withColumn("precision", ratio(F.col("hit"), F.col("predicted"))).withColumn("recall", ratio(F.col("hit"), F.col("support"))).withColumn("f1", ratio(2 * F.col("hit"), F.col("support") + F.col("predicted")))
    return out.crossJoin(total).select("class", "precision", "recall", "f1", "support", F.avg("f1").over(one).alias("macro_f1"), ratio(F.col("right"), F.col("total")).alias("accuracy"))


def _cumulative(df: DataFrame, score: str, y: str) -> DataFrame:
    """Per distinct score, falling: rows and positives so far, and all positives."""
    per = df.groupBy(F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("pos"))
    all_pos = df.agg(F.sum(F.col(y).cast("long")).alias("all_pos"))
    return running(per, [F.desc("score")], {"rows": F.col("n"), "tp": F.col("pos")}).crossJoin(F.broadcast(all_pos))


def best_f1(df: DataFrame, score: str, y: str, eligible: Column | None = None) -> DataFrame:
    """The threshold with the highest F1 (the highest such one), and that F1. Rows that are not eligible score -1."""
    if eligible is not None:
        df = df.withColumn(score, F.when(eligible, F.col(score)).otherwise(-1.0))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("rows") + F.col("all_pos")), F.lit(0.0))
    return _cumulative(df, score, y).agg(F.max_by("score", F.struct(f1, F.col("score"))).alias("threshold"), F.max(f1).alias("f1"))


def auprc(df: DataFrame, score: str, y: str, eligible: Column | None = None) -> DataFrame:
    """Average precision: each step in recall times the precision there. Rows that are not eligible score 0."""
    if eligible is not None:
        df = df.withColumn(score, F.when(eligible, F.col(score)).otherwise(0.0))
    return _cumulative(df, score, y).agg(F.sum(F.col("pos") / F.col("all_pos") * F.col("tp") / F.col("rows")).alias("auprc"))


def compare(df: DataFrame, a: str, b: str, y: str, by: Sequence[str] = (), losses: tuple[str, str] | None = None) -> DataFrame:
    """Two models on the same rows: agreement quadrants, disagreement, the accuracy difference that is detectable, and the accuracy of an oracle; with the columns of
    their losses also how these correlate, and the first one's standard deviation over the second's."""
    right_a, right_b = F.col(a) == F.col(y), F.col(b) == F.col(y)
    n, d = F.count(F.lit(1)), F.avg((F.col(a) != F.col(b)).cast("double"))
    count = lambda t: F.count(F.when(t, 1))
    more = [F.corr(*losses).alias("loss_correlation"), (F.stddev_pop(losses[0]) / F.greatest(F.lit(1e-12), F.stddev_pop(losses[1]))).alias("std_ratio")] if losses else []
    return df.groupBy(*by).agg(n.alias("n"), count(right_a & right_b).alias("both"), count(right_a & ~right_b).alias("only_a"), count(~right_a & right_b).alias("only_b"), count(~right_a & ~right_b).alias("neither"), d.alias("disagreement"), (2.8 * F.sqrt(d / n)).alias("detectable"), (count(right_a | right_b) / n).alias("oracle_accuracy"), *more)


def length_hist(df: DataFrame, by: Sequence[str], bp: str) -> DataFrame:
    return df.groupBy(*by, F.col(bp).alias("length")).agg(F.count(F.lit(1)).alias("n"), F.sum(bp).alias("bp"))


def pareto(df: DataFrame, name: str, metric: str, speed: str) -> DataFrame:
    """Rows that no faster row equals or beats in the metric: of each speed the best metric counts, and of these those above all faster ones."""
    best = df.where(F.col(metric).isNotNull() & F.col(speed).isNotNull()).groupBy(speed).agg(F.max(metric).alias("m"), F.min_by(name, F.struct(-F.col(metric), F.col(name))).alias(name))
    faster = running(best, [F.desc(speed)], {"faster": F.col("m")}, largest=True, before=True)
    return df.join(faster.where(F.col("faster").isNull() | (F.col("m") > F.col("faster"))).select(name), name, "left_semi")


def pareto_winner(df: DataFrame, name: str, metric: str, speed: str, max_drop: float) -> DataFrame:
    """The fastest row whose metric is at most max_drop below the best; ties to the better metric, then to the smaller name."""
    best = df.agg(F.max(metric).alias("_best"))
    near = df.crossJoin(F.broadcast(best)).where(F.col(metric) >= F.col("_best") - max_drop).drop("_best")
    return near.orderBy(F.desc(speed), F.desc(metric), name).limit(1)


def fingerprint(df: DataFrame, by: Sequence[str], id_: str, bp: str) -> DataFrame:
    """Per group: records, base pairs and a hash of the ids in any order, which repeated ids change: the sum of their 32-bit md5 numbers and of the squares of the numbers' last 16 bits, as decimals of 38 digits, which any number of rows fits in."""
    h = md5_number(F.col(id_).cast("string"))
    total = lambda x: F.sum(x.cast("decimal(20,0)")).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("records"), F.sum(bp).alias("bp"), total(h).alias("ids"), total((h % 65_536) * (h % 65_536)).alias("ids2"))


def verify_fingerprint(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose fingerprints differ, with the problem: missing, unexpected or changed. Empty if the datasets are the same."""
    same = F.lit(True)
    for c in by:
        same &= F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    fields = ("records", "bp", "ids", "ids2")
    equal = F.lit(True)
    for c in fields:
        equal &= F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    problem = F.when(F.col("n.records").isNull(), "missing").when(F.col("o.records").isNull(), "unexpected").when(~equal, "changed")
    both = old.alias("o").join(new.alias("n"), same, "full").withColumn("problem", problem).where("problem is not null")
    return both.select(*(F.coalesce(f"o.{c}", f"n.{c}").alias(c) for c in by), "problem")


def project(stats: DataFrame, priors: DataFrame, cls: str, n: str, target: int) -> DataFrame:
    """Per class with a prior: its share, the difference from the prior in percentage points, and the rows still missing at `target` rows in all."""
    total = stats.agg(F.sum(n).alias("_total"))
    out = priors.join(stats, cls, "left").na.fill(0, [n]).crossJoin(total)
    share = F.coalesce(F.try_divide(n, "_total"), F.lit(0.0))
    return out.withColumn("share", share).withColumn("delta_pp", 100 * (share - F.col("prior"))).withColumn("missing", F.greatest(F.lit(0), F.bround(F.lit(target) * F.col("prior")).cast("long") - F.col(n))).drop("_total")


def pred_share(df: DataFrame, pred: str) -> DataFrame:
    """The most predicted class (ties: the first) and its share of all predictions."""
    per = df.groupBy(F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.min_by("pred", F.struct(-F.col("n"), F.col("pred"))).alias("pred"), (F.max("n") / F.sum("n")).alias("share"))


def stratum_census(df: DataFrame, stratum: str, how: str, bp: str) -> DataFrame:
    """Per stratum: records, base pairs, and how many records came to it by their class, supergroup, an ambiguous supergroup or the fallback."""
    n = lambda *names: F.count(F.when(F.col(how).isin(*names), 1))
    return df.groupBy(F.col(stratum).alias("stratum")).agg(F.count(F.lit(1)).alias("records"), F.sum(bp).alias("bp"), n("class").alias("by_class"), n("taxid", "group", "supergroup").alias("by_supergroup"), n("ambiguous_sg_collapsed").alias("ambiguous"), n("fallback").alias("fallback"))


def repair_matrix(df: DataFrame, before: str, after: str, classes: Sequence[str]) -> DataFrame:
    """Per class (of `classes`, and unknown): records before and after relabelling, those that moved out and in, and whether it was emptied. A row without a new class is unknown."""
    cells = df.groupBy(F.col(before).alias("f"), F.coalesce(F.col(after), F.lit("unknown")).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select("n", "f", "t", F.explode(F.array(F.struct(F.col("f").alias("class_name"), F.lit("f").alias("side")), F.struct(F.col("t").alias("class_name"), F.lit("t").alias("side")))).alias("x")).select("n", "f", "t", "x.*")
    total = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    moved = F.col("f") != F.col("t")
    per = sides.groupBy("class_name").agg(total(F.col("side") == "f").alias("before"), total(F.col("side") == "t").alias("after"), total((F.col("side") == "f") & moved).alias("moved_out"), total((F.col("side") == "t") & moved).alias("moved_in"))
    known = df.sparkSession.createDataFrame([(c,) for c in [*classes, "unknown"]], "class_name string")
    out = known.join(per, "class_name", "full").na.fill(0)
    return out.withColumn("emptied", (F.col("before") > 0) & (F.col("after") == 0))


def leakage_union(a: DataFrame, b: DataFrame, keys: Sequence[str], split: str, record: str) -> DataFrame:
    """(kind, problems) over both tables together: values of each key that occur in more than one split (empty ones don't count), and rows that repeat a record's id."""
    both = a.select(record, split, *keys).unionByName(b.select(record, split, *keys))
    long = both.select(F.col(split).alias("split"), F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in keys))).alias("x")).select("split", "x.*").where(F.coalesce("value", F.lit("")) != "")
    per = long.groupBy("kind", "value").agg(F.countDistinct("split").alias("c")).groupBy("kind").agg(F.count(F.when(F.col("c") > 1, 1)).alias("problems"))
    ids = both.groupBy(record).agg((F.count(F.lit(1)) - 1).alias("more")).agg(F.lit("record_id").alias("kind"), F.coalesce(F.sum("more"), F.lit(0)).alias("problems"))
    return per.unionByName(ids)


def census_sample(df: DataFrame, by: Sequence[str], id_: str, bp: Column, fraction: float, how: str = "crc32") -> DataFrame:
    """An estimate of census(): records and base pairs of the rows that hash sampling keeps, over the fraction; the mean length is that of the sample."""
    some = df.where(keep_by_id(F.col(id_), fraction, how=how))
    return some.groupBy(*by).agg(F.bround(F.count(F.lit(1)) / fraction).cast("long").alias("records"), F.bround(F.sum(bp) / fraction).cast("long").alias("bp"), F.round(F.avg(bp), 6).alias("mean_bp"))
