"""Quotas and budgets: apportionment, water-filling in closed form, base-pair plans and sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import filter_quality, keep_by_id, md5_fraction
from .order import kept, running, with_totals


def apportion(df: DataFrame, ratio: str, total: int, key: str) -> DataFrame:
    """df with quota: shares of a total in proportion to `ratio`, the rest going to the largest remainders, ties by key."""
    one = Window.partitionBy(F.lit(0))
    raw = F.lit(float(total)) * F.col(ratio) / F.sum(ratio).over(one)
    df = df.withColumn("raw", raw).withColumn("base", F.floor("raw"))
    left = F.lit(total) - F.sum("base").over(one)
    rank = F.row_number().over(one.orderBy(F.desc(F.col("raw") - F.col("base")), key))
    return df.withColumn("quota", (F.col("base") + (rank <= left).cast("int")).cast("long")).drop("raw", "base")


def water_fill(df: DataFrame, total: Column, weight: str, cap: str, key: str, group: Sequence[str] = (), floor: str | None = None, few: bool = False) -> DataFrame:
    """df with level_share: min(cap, floor + level * weight), which add up to min(total, caps) in each group. total is the same in all rows of a group.

    Rows fill up in the order of (cap - floor) / weight. The level is what is left of the total after the caps of the rows before, over the weights
    from here on, at the first row that it does not fill. Rows are sorted over range partitions and their sums run on from partition to partition, so no task holds a group; with `few` (rows that
    are as many as the classes someone named) one window for each group does it."""
    base = F.col(floor) if floor else F.lit(0.0)
    room = F.greatest(F.lit(0.0), F.col(cap).cast("double") - base)
    df = df.withColumn("_goal", total.cast("double")).withColumn("_room", room).withColumn("_at", F.when(F.col(weight) > 0, F.col("_room") / F.col(weight)))
    live = F.when(F.col(weight) > 0, F.col("_room")).otherwise(0.0)
    up = [F.col("_at").asc_nulls_last(), F.col(key)]
    if few:
        by = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
        filled = F.sum(live).over(by.orderBy(*up).rowsBetween(Window.unboundedPreceding, -1))
        weights = F.sum(weight).over(by.orderBy(F.col("_at").desc_nulls_first(), F.desc(key)).rowsBetween(Window.unboundedPreceding, 0))
        df = df.withColumns({"_filled": filled, "_weights": weights, "_base": F.sum(base).over(by)})
    else:
        df = running(df, up, {"_filled": live}, group, before=True, rest={"_weights": F.col(weight).cast("double")})
        df = with_totals(df, {"_base": F.sum(base)}, group)
    df = df.withColumn("_level", F.when(F.col("_weights") > 0, (F.col("_goal") - F.col("_base") - F.coalesce("_filled", F.lit(0.0))) / F.col("_weights")))
    first = F.min(F.when(F.col("_at") > F.col("_level"), F.struct("_at", F.col(key).alias("_key"), "_level")))  # of the first such row in the order
    df = df.withColumn("_first", first.over(by)) if few else with_totals(df, {"_first": first}, group)
    level = F.when(F.col("_first").isNotNull(), F.greatest(F.col("_first._level"), F.lit(0.0)))  # null where all rows are full
    share = F.when(F.col(weight) > 0, base + F.least(F.col("_room"), F.coalesce(level * F.col(weight), F.col("_room")))).otherwise(base)
    return df.withColumn("level_share", share).drop("_goal", "_room", "_at", "_filled", "_weights", "_base", "_level", "_first")


def allocate_rates(counts: DataFrame, target: int, mode: str, key: str, count: str = "n", floor: int = 0, cap: int = 0) -> DataFrame:
    """counts with quota and rate: every key's floor first (scaled down if the target is less), then the rest by water-filling with
    proportional, sqrt or equal weights up to the cap. Keys may be very many."""
    capacity = F.least(F.col(count), F.lit(cap)) if cap else F.col(count)
    df = counts.where(F.col(count) > 0).withColumn("_cap", capacity.cast("double"))
    df = df.withColumn("_low", F.least(F.lit(float(floor)), F.col("_cap")))
    df = with_totals(df, {"_caps": F.sum("_cap"), "_lows": F.sum("_low")})
    goal = F.least(F.lit(float(target)), F.col("_caps"))
    df = df.withColumn("_target", goal).withColumn("_low", F.col("_low") * F.least(F.lit(1.0), goal / F.greatest(F.lit(1.0), F.col("_lows"))))
    weight = {"proportional": F.col(count).cast("double"), "sqrt": F.sqrt(count), "equal": F.lit(1.0)}[mode]
    df = water_fill(df.withColumn("_w", weight), F.col("_target"), "_w", "_cap", key, floor="_low")
    return df.withColumn("quota", F.col("level_share")).withColumn("rate", F.least(F.lit(1.0), F.col("quota") / F.col(count))).drop("_cap", "_caps", "_target", "_low", "_lows", "_w", "level_share")


def allocate_capped(df: DataFrame, total: Column, weight: str, cap: str, key: str, few: bool = False) -> DataFrame:
    """df with quota (long): weighted water-filling, rounded half to even, what rounding leaves going to the rows with most room. few: see water_fill."""
    df = water_fill(df, total, weight, cap, key, few=few)
    most = F.col(cap).cast("long")
    rounded = F.least(most, F.bround("level_share").cast("long"))
    df = df.withColumn("_q", rounded).withColumn("_free", F.when(F.col(weight) > 0, most - F.col("_q")).otherwise(0))
    sums = {"_room": F.sum(F.when(F.col(weight) > 0, most).otherwise(0)), "_given": F.sum("_q")}
    order = [F.desc("_free"), F.col(key)]
    if few:
        one = Window.partitionBy(F.lit(0))
        df = df.withColumns({k: v.over(one) for k, v in sums.items()})
        df = df.withColumn("_before", F.sum("_free").over(one.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)))
    else:
        df = running(with_totals(df, sums), order, {"_before": F.col("_free")}, before=True)
    drift = F.greatest(F.least(total.cast("long"), F.col("_room")) - F.col("_given"), F.lit(0))
    more = F.greatest(F.lit(0), F.least(F.col("_free"), drift - F.coalesce("_before", F.lit(0))))
    return df.withColumn("quota", F.col("_q") + more).drop("_q", "_free", "_room", "_given", "_before", "level_share")


def bp_plan(stats: DataFrame, priors: Mapping[str, float], weights: Mapping[str, float], divided: str = "eukarya", total: int | None = None) -> DataFrame:
    """stats: (stratum, bp). Returns stratum, available_bp, target_bp, rate.

    The total, if not given, is the most that keeps the priors: the least of available / prior. A class's target is its prior's share; that of the divided class
    goes to its clades (strata <class>/<clade>) by weighted water-filling. A target over what a class, or the weighted clades together, have is an error when the plan is read."""
    spark = stats.sparkSession
    whole = sum(priors.values())
    classes = spark.createDataFrame([(k, float(v) / whole) for k, v in priors.items()], "class string, prior double")
    clades = spark.createDataFrame([(f"{divided}/{k}", float(v)) for k, v in weights.items()], "stratum string, weight double")
    top = stats.groupBy(F.substring_index("stratum", "/", 1).alias("class")).agg(F.sum("bp").alias("bp"))
    top = classes.join(top, "class", "left").na.fill(0, ["bp"])
    most = top.where("prior > 0").agg(F.floor(F.min(F.col("bp") / F.col("prior"))).alias("total")) if total is None else spark.createDataFrame([(total,)], "total long")
    wish = F.bround(F.col("total") * F.col("prior")).cast("long")
    fail = lambda text: F.raise_error(F.concat(F.lit(text), F.col("class"))).cast("long")
    target = top.crossJoin(most).select("class", F.col("bp").alias("available_bp"), F.when(wish > F.col("bp"), fail("the total is infeasible for ")).otherwise(wish).alias("target_bp"))
    goal = target.where(F.col("class") == divided).select(F.col("class").alias("class"), F.col("target_bp").alias("goal"))
    split = clades.join(stats.select("stratum", "bp"), "stratum", "left").na.fill(0, ["bp"]).crossJoin(goal)
    split = allocate_capped(split, F.col("goal"), "weight", "bp", "stratum", few=True)
    short = F.sum("quota").over(Window.partitionBy(F.lit(0))) < F.col("goal")
    split = split.select("stratum", F.col("bp").alias("available_bp"), F.when(short, fail("the weighted clades cannot fill the target of ")).otherwise(F.col("quota")).alias("target_bp"))
    out = target.where(F.col("class") != divided).withColumnRenamed("class", "stratum").unionByName(split)
    return out.withColumn("rate", F.when(F.col("available_bp") > 0, F.col("target_bp") / F.col("available_bp")).otherwise(0.0))


def clade_coverage(stats: DataFrame, weights: Mapping[str, float], divided: str = "eukarya") -> DataFrame:
    """(clade, weight, bp, problem, redistributed): the weighted clades, and which have no data, so that their weight goes to the others; redistributed: that weight in all."""
    clades = stats.sparkSession.createDataFrame([(k, f"{divided}/{k}", float(v)) for k, v in weights.items() if v > 0], "clade string, stratum string, weight double")
    out = clades.join(stats.select("stratum", "bp"), "stratum", "left").na.fill(0, ["bp"])
    empty = F.col("bp") <= 0
    lost = F.coalesce(F.sum(F.when(empty, F.col("weight"))).over(Window.partitionBy(F.lit(0))), F.lit(0.0))
    return out.select("clade", "weight", "bp", F.when(empty, "no_data").alias("problem"), lost.alias("redistributed"))


#: Rows of a table of rates that are broadcast; more are joined by a shuffle.
BROADCAST = 1 << 18


def _small(df: DataFrame) -> DataFrame:
    """df, written, and broadcast if it has BROADCAST rows at most; so that a few rates never make the corpus shuffle onto its hot strata."""
    df = kept(df)
    return F.broadcast(df) if df.count() <= BROADCAST else df


def bp_balance(df: DataFrame, plan: DataFrame, id_: str, stratum: str = "stratum", seed: int = 42, how: str = "crc32") -> DataFrame:
    """The rows that hash sampling keeps at their stratum's rate. The plan has a row for each stratum; texts are not shuffled to join it."""
    rates = _small(plan.select(F.col("stratum").alias(stratum), "rate"))
    return df.join(rates, stratum).where(keep_by_id(F.col(id_), F.col("rate"), seed, how)).drop("rate")


def balance_splits(df: DataFrame, splits: Sequence[str], priors: Mapping[str, float], weights: Mapping[str, float], seq: str, id_: str, divided: str = "eukarya", min_len: int = 0, min_purity: float = 0.0, seed: int = 42, how: str = "crc32") -> DataFrame:
    """df (split, stratum, bp and the sequence): each of `splits` sampled to a bp_plan of its own, of its rows of at least min_len letters and min_purity; other splits stay as they are. Only
    train and validation can be balanced: a balanced test split would say nothing of the data as they come."""
    bad = [s for s in splits if s not in ("train", "validation")]
    if bad:
        raise ValueError(f"splits that cannot be balanced: {bad}")
    good = filter_quality(df, seq, min_len, min_purity)
    out = df.where(~F.col("split").isin(*splits))
    for split in splits:
        rows = good.where(F.col("split") == split)
        plan = bp_plan(rows.groupBy("stratum").agg(F.sum("bp").alias("bp")), priors, weights, divided)
        out = out.unionByName(bp_balance(rows, plan, id_, "stratum", seed, how).select(*df.columns))
    return out


def sampling_report(plan: DataFrame, kept: DataFrame, bp: str, stratum: str = "stratum") -> DataFrame:
    """Available, target and kept base pairs of each stratum, with the signed error in percent."""
    got = kept.groupBy(stratum).agg(F.sum(bp).alias("kept_bp"), F.count(F.lit(1)).alias("kept_records"))
    out = plan.join(got.withColumnRenamed(stratum, "stratum"), "stratum", "full").na.fill(0, ["kept_bp", "kept_records", "target_bp", "available_bp"])
    return out.select("stratum", "available_bp", "target_bp", "kept_bp", "kept_records", F.when(F.col("target_bp") > 0, 100.0 * (F.col("kept_bp") - F.col("target_bp")) / F.col("target_bp")).alias("error_pct"))


def balance_rates(counts: DataFrame, mode: str, count: str = "n", total: int | None = None, base_rate: float = 1.0, max_rate: float = 1.0, min_rows: int = 0) -> DataFrame:
    """counts with rate and expected rows: `none` keeps base_rate of each class, `sqrt` and `linear` share the total (all rows times base_rate, if not given) by the root of the count, or equally;
    at least min_rows, at most max_rate. Rates have six decimals. Classes without rows are left out."""
    if mode not in ("none", "sqrt", "linear"):
        raise ValueError(f"unknown mode: {mode}")
    counts = counts.where(F.col(count) > 0)
    if mode == "none":
        rate = F.lit(float(base_rate))
    else:
        weight = F.sqrt(count) if mode == "sqrt" else F.lit(1.0)
        one = Window.partitionBy(F.lit(0))
        goal = F.lit(float(total)) if total is not None else F.floor(F.sum(count).over(one) * base_rate)
        rate = F.bround(F.least(F.lit(float(max_rate)), F.greatest(goal * (weight / F.sum(weight).over(one)), F.lit(float(min_rows))) / F.col(count)), 6)
    return counts.withColumn("rate", rate).withColumn("expected", F.floor(F.col(count) * F.col("rate")).cast("long"))


def class_weights(df: DataFrame, cls: str) -> DataFrame:
    """n / (classes * count) of each class."""
    one = Window.partitionBy(F.lit(0))
    return df.groupBy(cls).agg(F.count(F.lit(1)).alias("n")).withColumn("weight", F.sum("n").over(one) / (F.count(F.lit(1)).over(one) * F.col("n")))


def hash_cap(df: DataFrame, group: str, id_: str, cap: int, salt: str = "cap") -> DataFrame:
    """About `cap` rows of each group: those whose hash fraction is under cap / rows. The counts are joined, no group is gathered."""
    n = _small(df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")))
    return df.join(n, group).where(md5_fraction(F.concat(F.lit(f"{salt}:"), F.col(id_).cast("string"))) < F.lit(float(cap)) / F.col("_n")).drop("_n")


def bp_cap(df: DataFrame, plan: DataFrame, key: str, order: Sequence[str], bp: str) -> DataFrame:
    """Rows of planned keys while the base pairs before them are under the key's target_bp (null: no cap); the last one may go beyond."""
    before = F.coalesce(F.sum(bp).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.join(plan.select(key, "target_bp"), key).withColumn("bp_before", before).where(F.col("target_bp").isNull() | (F.col("bp_before") < F.col("target_bp")))
