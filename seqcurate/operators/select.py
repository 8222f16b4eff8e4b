"""Selection: best per species and genus, round robin, splits of a corpus, deduplication across splits, joins by accession."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import base_accession
from . import features
from .order import kept, placed


def genus_balance(df: DataFrame, order: Sequence[Column], species: str, genus: str, scope: Sequence[str], cap: int) -> DataFrame:
    """df with species_rank, genus_rank and decision: the best row of each species, then at most `cap` species of a genus, within the scope."""
    rank = F.row_number().over(Window.partitionBy(*scope, species).orderBy(*order))
    df = df.withColumn("species_rank", rank)
    winner = F.col("species_rank") == 1
    in_genus = F.row_number().over(Window.partitionBy(*scope, genus, winner).orderBy(*order))
    df = df.withColumn("genus_rank", F.when(winner, in_genus))
    return df.withColumn("decision", F.when(~winner, "duplicate_within_species").when(F.col("genus_rank") <= cap, "selected").otherwise("dropped_by_genus_cap"))


def genus_quota(df: DataFrame, genus: str, species: str | Sequence[str], size: str, gc: str, max_per: int = 4, exponent: float = 0.4, size_ratio: float = 3.0, gc_spread: float = 8.0) -> DataFrame:
    """Genomes that each genus may have: 1, or more by its number of species if its sizes or GC contents spread widely.

    A row's species is the first of the columns `species` that is not empty; a row without any is a species of its own."""
    sizes, gcs = F.when(F.col(size) > 0, F.col(size)), F.when(F.col(gc) >= 0, F.col(gc))
    wide = (F.max(sizes) / F.min(sizes) >= size_ratio) | ((F.count(gcs) >= 2) & (F.max(gcs) - F.min(gcs) >= gc_spread))
    named = F.coalesce(*(F.nullif(F.col(c).cast("string"), F.lit("")) for c in ([species] if isinstance(species, str) else species)))
    kinds = F.countDistinct(named) + F.count_if(named.isNull())
    scaled = F.least(F.lit(max_per), F.ceil(F.pow(kinds, F.lit(exponent))), F.count(F.lit(1)))
    return df.groupBy(genus).agg(F.when(F.lit(max_per > 1) & F.coalesce(wide, F.lit(False)), F.greatest(F.lit(1), scaled)).otherwise(1).cast("long").alias("quota"))


def pick_genus(df: DataFrame, quota: DataFrame, genus: str, order: Sequence[Column], anchor: Column) -> DataFrame:
    """Every anchor, and the best rows of a genus up to its quota, with genus_rank."""
    rank = F.row_number().over(Window.partitionBy(genus).orderBy(F.when(anchor, 0).otherwise(1), *order))
    return df.withColumn("genus_rank", rank).join(quota, genus).where(anchor | (F.col("genus_rank") <= F.col("quota")))


def round_robin(df: DataFrame, family: str, order: Sequence[Column], limit: int, by: Sequence[str] = ()) -> DataFrame:
    """`limit` rows (of each group `by`): the first of every family, then the second; families in the order of their best row. Adds turn and family_no."""
    df = df.withColumn("turn", F.row_number().over(Window.partitionBy(*by, family).orderBy(*order)))
    best = placed(df.where("turn = 1"), order, "family_no", by).select(*by, family, "family_no")
    joined = df.join(best, [*by, family])
    return placed(joined, [F.col("turn"), F.col("family_no")], "place", by, limit).drop("place")


def class_cap(df: DataFrame, cls: str, order: Sequence[Column], cap: int, exempt: Column) -> DataFrame:
    """The best `cap` rows of each class, with class_rank; exempt rows stay, unranked, and do not count."""
    ranked = placed(df.where(~exempt), order, "class_rank", [cls], cap)
    return ranked.unionByName(df.where(exempt), allowMissingColumns=True)


def union_prefer(dfs: Sequence[DataFrame], key: str, prefer: Column, ordinal: str) -> DataFrame:
    """One row for each version-stripped key of several tables: the first preferred row, else the first seen. Tables in turn, rows by `ordinal`.

    Columns that a table lacks are null. Rows without a key are left out."""
    out = None
    for i, df in enumerate(dfs):
        df = df.withColumn("_table", F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    order = F.struct(F.when(prefer, 0).otherwise(1).alias("p"), "_table", ordinal)
    rows = out.where(F.coalesce(F.col(key), F.lit("")) != "")
    columns = [c for c in out.columns if c != "_table"]
    first = rows.groupBy(base_accession(F.col(key)).alias("_base")).agg(F.min_by(F.struct(*columns), order).alias("_row"))
    return first.select("_row.*")


def versioned_join(left: DataFrame, right: DataFrame, key: str, values: Sequence[str], ordinal: str, how: str = "last") -> DataFrame:
    """left with the values of the first row (by `ordinal`) of right that has its key, else of the first that has it without version, and match: exact, base or null."""
    row = F.struct(*values)
    exact = right.groupBy(F.col(key).alias("_x")).agg(F.min_by(row, ordinal).alias("_e"))
    base = right.groupBy(base_accession(F.col(key), how).alias("_b")).agg(F.min_by(row, ordinal).alias("_v"))
    joined = left.join(exact, left[key] == exact["_x"], "left").join(base, base_accession(left[key], how) == base["_b"], "left")
    found = F.coalesce("_e", "_v")
    match = F.when(F.col("_e").isNotNull(), "exact").when(F.col("_v").isNotNull(), "base")
    return joined.select(*[left[c] for c in left.columns], *(found[v].alias(v) for v in values), match.alias("match"))


def dedup_exact(df: DataFrame, content: str, split: str, priority: Sequence[str], block: Sequence[str] = ()) -> DataFrame:
    """Rows of a split whose content no row of a split of higher priority has, in the same block; copies within a split stay.

    Content is compared by digest, and the first split that has one is a pre-aggregated minimum, so copies meet nowhere. Rows without content equal nothing and
    stay; blocks are compared with nulls equal. A split that is not in `priority` is an error.
    A row removed from its split does not count there: what a higher split has lost, one above it has, too."""
    known = F.array(*(F.lit(p) for p in priority))
    place = F.when(F.array_contains(known, F.col(split)), F.array_position(known, F.col(split))).otherwise(F.raise_error(F.concat(F.lit("split without a priority: "), F.coalesce(F.col(split), F.lit("null")))).cast("long")).cast("int")
    df = df.withColumn("_place", place)
    keyed = df.where(F.col(content).isNotNull()).withColumn("_digest", F.sha2(F.to_json(F.struct(*(F.col(c).alias(f"b{i}") for i, c in enumerate(block)), F.sha2(F.col(content).cast("binary"), 256).alias("c"))), 256))
    first = keyed.groupBy("_digest").agg(F.min("_place").alias("_first"))
    rows = keyed.join(first, "_digest").where(F.col("_place") == F.col("_first")).select(*df.columns)
    return rows.unionByName(df.where(F.col(content).isNull())).drop("_place")


def drop_leaky(test: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """Rows of test whose key does not occur in train."""
    return test.join(train.select(key).distinct(), key, "left_anti")


def _accepted(hits: DataFrame, min_id: float, min_cov: float) -> DataFrame:
    enough = lambda c, least: F.col(c) + 1e-12 >= least
    return hits.where((F.col("query") != F.col("target")) & enough("fident", min_id) & enough("qcov", min_cov) & enough("tcov", min_cov))


def accept_hits(hits: DataFrame, min_id: float = 0.95, min_cov: float = 0.95) -> DataFrame:
    """Ids of queries with an accepted hit: not on themselves, with identity and both coverages at the thresholds, up to 1e-12."""
    return _accepted(hits, min_id, min_cov).select("query").distinct()


def hit_report(hits: DataFrame, queries: DataFrame, id_: str, by: Sequence[str], min_id: float = 0.95, min_cov: float = 0.95) -> DataFrame:
    """Per group of the queries searched with: query_count, accepted_hit_rows, removed_count (queries with an accepted hit) and retention, the share of queries left. Hits of other queries don't count."""
    rows = _accepted(hits, min_id, min_cov).groupBy(F.col("query").alias(id_)).agg(F.count(F.lit(1)).alias("_rows"))
    out = queries.select(id_, *by).join(rows, id_, "left").groupBy(*by)
    out = out.agg(F.count(F.lit(1)).alias("query_count"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("accepted_hit_rows"), F.count("_rows").alias("removed_count"))
    return out.withColumn("retention", (F.col("query_count") - F.col("removed_count")) / F.col("query_count"))


def regroup(df: DataFrame, removed: DataFrame, id_: str, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows that were not removed, and per group those in, kept and removed, and the share kept."""
    left = df.join(removed.select(F.col(removed.columns[0]).alias(id_)).distinct(), id_, "left_anti")
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_in")).join(left.groupBy(*by).agg(F.count(F.lit(1)).alias("kept")), list(by), "left").na.fill(0, ["kept"])
    return left, counts.withColumn("removed", F.col("rows_in") - F.col("kept")).withColumn("retention", F.col("kept") / F.col("rows_in"))


def mag_qc(contigs: DataFrame, hits: DataFrame, min_id: float = 0.9, min_cov: float = 0.5, max_foreign: float = 0.05) -> DataFrame:
    """Per genome: base pairs of contigs whose best hit is in its own kingdom, in another, in none; dropped if the foreign share of those assigned reaches max_foreign.

    Hits below the identity or either coverage do not count. Best: identity times coverage, the first (by `ordinal`) of equal ones."""
    good = hits.where((F.col("fident") >= min_id) & (F.col("qcov") >= min_cov) & (F.col("tcov") >= min_cov))
    best = good.groupBy("contig_id").agg(F.max_by("target_kingdom", F.struct(F.col("fident") * F.col("qcov"), -F.col("ordinal"))).alias("kingdom"))
    bp = lambda test: F.sum(F.when(test, F.col("length")).otherwise(0))
    out = contigs.join(best, "contig_id", "left").groupBy("mag_id").agg(bp(F.col("kingdom") == F.col("mag_kingdom")).alias("own_bp"), bp(F.col("kingdom") != F.col("mag_kingdom")).alias("foreign_bp"), bp(F.col("kingdom").isNull()).alias("unassigned_bp"), F.sum("length").alias("bp"))
    share = F.coalesce(F.try_divide("foreign_bp", F.col("own_bp") + F.col("foreign_bp")), F.lit(0.0))
    return out.withColumn("foreign_share", share).withColumn("dropped", share >= max_foreign)


def ancestors(nodes: DataFrame, max_depth: int = 200) -> DataFrame:
    """(id, ancestor, depth) of a table (id, parent), by doubling: paths of 1, 2, 4... steps are joined. A root, its own parent, ends a path; cycles end at max_depth."""
    step = nodes.where("id <> parent").select("id", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    paths, reach = step, 1
    while reach < max_depth:
        far = paths.where(F.col("depth") == reach).select(F.col("id").alias("i"), F.col("ancestor").alias("a"))
        more = far.join(paths, far["a"] == paths["id"]).select(far["i"].alias("id"), "ancestor", (F.col("depth") + reach).alias("depth")).where(F.col("depth") <= max_depth)
        more = kept(more)
        if more.isEmpty():
            break
        paths, reach = paths.unionByName(more), reach * 2
    return paths.groupBy("id", "ancestor").agg(F.min("depth").alias("depth"))


def upward(nodes: DataFrame, asked: DataFrame, max_depth: int = 200) -> DataFrame:
    """The rows of nodes (id, parent, ...) that are asked for (id) or above one that is, each once. Steps go up from the distinct nodes reached last, ever fewer, so the rest of the tree is never joined with
    itself; a cycle ends when it comes round."""
    known = nodes.select("id", "parent").where("id <> parent")
    seen = last = kept(asked.select("id").distinct())
    for _ in range(max_depth):
        last = kept(known.join(last, "id", "left_semi").select(F.col("parent").alias("id")).distinct().join(seen, "id", "left_anti"))
        if last.isEmpty():
            break
        seen = seen.unionByName(last)
    return nodes.join(seen.distinct(), "id", "left_semi")


def latest_status(log: DataFrame, entity: str, status: str, at: str, tie: str) -> DataFrame:
    """The last status of each entity."""
    return log.groupBy(entity).agg(F.max_by(status, F.struct(at, tie)).alias(status), F.max(at).alias(at))


def todo(manifest: DataFrame, status: DataFrame, entity: str, done: Column) -> DataFrame:
    return manifest.join(status.where(done).select(entity), entity, "left_anti")


def split_overlap(df: DataFrame, key: str, split: str, a: str, b: str) -> DataFrame:
    """Keys that occur in both splits."""
    return df.where(F.col(split) == a).select(key).intersect(df.where(F.col(split) == b).select(key))


def chop(df: DataFrame, id_: str, seq: str, n: int) -> DataFrame:
    """Pieces of n letters that do not overlap; a shorter sequence is one piece, and a tail is dropped."""
    pieces = F.greatest(F.lit(1), F.floor(F.length(seq) / n)).cast("int")
    return df.select(F.col(id_).alias("id"), F.posexplode(F.transform(F.sequence(F.lit(0), pieces - 1), lambda i: F.substr(F.col(seq), i * n + 1, F.lit(n)))).alias("piece", "fragment"))


def kmer_counts(df: DataFrame, id_: str, seq: str, k: int) -> DataFrame:
    """(id, kmer, n) of the windows of k letters that hold A, C, G and T of either case only, in upper case (see features.kmer_counts)."""
    return features.kmer_counts(df, id_, seq, k).select("id", features.kmer_text(F.col("code"), k).alias("kmer"), "n")


def diff_index(rows: DataFrame, index: DataFrame, key: str, order: Sequence[str], detailed: bool = False) -> DataFrame:
    """rows with status: duplicate_in_source (but the first row of a key), already_held, other_version (the index has the key with another version) or new.

    detailed: of keys without version, too, the first row alone is not a duplicate (duplicate_in_source_other_version), and other_version is already_held_other_version."""
    base = base_accession(F.col(key), "numeric") if detailed else base_accession(F.col(key))
    place = F.struct(*order)
    first = rows.groupBy(key).agg(F.min(place).alias("_first"))
    first_base = rows.groupBy(base.alias("_base")).agg(F.min(place).alias("_first_base"))
    exact = index.select(key).distinct().withColumn("_held", F.lit(True))
    held = index.select(base.alias("_base")).distinct().withColumn("_other", F.lit(True))
    out = rows.withColumn("_base", base).join(first, key).join(first_base, "_base").join(exact, key, "left").join(held, "_base", "left")
    status = F.when(place > F.col("_first"), "duplicate_in_source")
    if detailed:
        status = status.when(place > F.col("_first_base"), "duplicate_in_source_other_version")
    status = status.when(F.col("_held"), "already_held").when(F.col("_other"), "already_held_other_version" if detailed else "other_version").otherwise("new")
    return out.withColumn("status", status).select(*rows.columns, "status")


def distinct_sequences(df: DataFrame, record: Sequence[str], seq: str) -> DataFrame:
    """Each record's distinct sequences by digest, with their number of copies; pre-aggregated, so copies meet nowhere."""
    return df.groupBy(*record, F.sha2(F.col(seq).cast("binary"), 256).alias("digest")).agg(F.count(F.lit(1)).alias("copies"))
