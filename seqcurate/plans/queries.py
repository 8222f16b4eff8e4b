"""One query for each operator, over the whole of the driver's tables (stand-ins: documents as fragments, part as genomes, lineitem for scale)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import features, metrics, quota, select
from . import curation, functions, scoring

LETTERS, BASES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTAC"
DNA = f"translate(text, '{LETTERS + LETTERS.lower()}', '{BASES + BASES}')"
SPLIT = "case when ('0x' || substr(md5('42:' || {0}), 1, 8))::bigint % 100 < 20 then 'evaluation' else 'train' end"
CLASSES = ("0", "1")


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fragments(spark, sf_dir):
    return _t(spark, sf_dir, "documents").withColumn("dna", F.translate("text", LETTERS + LETTERS.lower(), BASES + BASES))


def _split(col):
    return scalars.hash_split(col, 20)["split"]


def balanced_corpus(spark, sf_dir):
    """Census by language, plan by water-filled quotas, hash sampling at the planned rates, report."""
    docs = _t(spark, sf_dir, "documents").withColumn("stratum", F.when(F.col("lang") == "en", F.concat(F.lit("eukarya/"), "source")).otherwise(F.col("lang")))
    stats = docs.groupBy("stratum").agg(F.sum("n_chars").alias("bp"))
    plan = quota.bp_plan(stats, {"eukarya": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}, {f"src{i}": 1 + i % 3 for i in range(20)})
    kept = quota.bp_balance(docs, plan, "doc_id", how="md5")
    return quota.sampling_report(plan, kept, "n_chars").withColumn("error_pct", F.round("error_pct", 6))


def a01_census(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    grid = docs.select("lang").distinct().crossJoin(docs.select("source").distinct())
    return metrics.census(docs, ["lang", "source"], "n_chars", grid).withColumn("mean_bp", F.round("mean_bp", 6))


def a13_coverage_cells(spark, sf_dir):
    return metrics.coverage_cells(_t(spark, sf_dir, "lineitem").withColumn("bp", F.col("l_quantity").cast("long")), ["l_returnflag", "l_linestatus"], "l_orderkey", "bp").withColumn("gini", F.round("gini", 6))


def a14_leakage(spark, sf_dir):
    return metrics.leakage(_t(spark, sf_dir, "lineitem").withColumn("split", _split(F.col("l_orderkey"))), ["l_partkey", "l_suppkey", "l_orderkey"], "split")


def _predictions(spark, sf_dir):
    labels = _t(spark, sf_dir, "labels")
    score = scalars.md5_number(F.concat(F.lit("s:"), F.col("doc_id").cast("string"))) % 1000
    return labels.select("doc_id", F.col("quality").cast("string").alias("truth"), F.when(score >= 400, "1").otherwise("0").alias("pred"), F.when(score % 7 >= 2, "1").otherwise("0").alias("other"), score.alias("score"), F.col("quality").alias("y"), "toxic")


def a18_class_metrics(spark, sf_dir):
    cells = metrics.confusion(_predictions(spark, sf_dir), "truth", "pred", CLASSES)
    return metrics.class_metrics(cells, CLASSES).select("class", "support", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "macro_f1", "accuracy")))


def a22_best_f1(spark, sf_dir):
    return metrics.best_f1(_predictions(spark, sf_dir), "score", "y").select("threshold", F.round("f1", 6).alias("f1"))


def a23_auprc(spark, sf_dir):
    return metrics.auprc(_predictions(spark, sf_dir), "score", "y").select(F.round("auprc", 6).alias("auprc"))


def a26_compare(spark, sf_dir):
    out = metrics.compare(_predictions(spark, sf_dir), "pred", "other", "truth", ["toxic"])
    return out.select("toxic", "n", "both", "only_a", "only_b", "neither", *(F.round(c, 6).alias(c) for c in ("disagreement", "detectable", "oracle_accuracy")))


def a28_length_hist(spark, sf_dir):
    return metrics.length_hist(_t(spark, sf_dir, "documents"), ["lang"], "n_chars")


def f17_filter_quality(spark, sf_dir):
    return scalars.filter_quality(_fragments(spark, sf_dir), "dna", 100, 0.75, "purity").select("doc_id", F.round("purity", 6).alias("purity"))


def f19_length_bin(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", scalars.length_bin(F.col("n_chars"), tolerance=50).alias("bin"))


def f23_hash_split(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select("o_orderkey", _split(F.col("o_orderkey")).alias("split"))


def f25_keep_by_id(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").where(scalars.keep_by_id(F.col("l_orderkey"), 0.3, how="md5")).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


def j08_dedup_exact(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").withColumn("split", _split(F.col("doc_id")))
    return select.dedup_exact(docs, "text", "split", ["evaluation", "train"]).select("doc_id", "split")


def j14_ancestors(spark, sf_dir):
    node = lambda df, i, p: df.select(F.col(i).alias("id"), p.alias("parent"))
    tag = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    c, n, r = (_t(spark, sf_dir, x) for x in ("customer", "nation", "region"))
    nodes = c.select(tag("c", "c_custkey").alias("id"), tag("n", "c_nationkey").alias("parent")).unionByName(n.select(tag("n", "n_nationkey").alias("id"), tag("r", "n_regionkey").alias("parent"))).unionByName(r.select(tag("r", "r_regionkey").alias("id"), F.lit("root").alias("parent")))
    return select.ancestors(nodes)


def m01_tfidf(spark, sf_dir):
    frags = _fragments(spark, sf_dir)
    table = features.idf(features.doc_freq(frags, "dna", 2), frags.count(), 2)
    rows = features.tfidf(frags, "doc_id", "dna", table).select("id", F.explode(F.arrays_zip("codes", "weights")).alias("x"))
    return rows.select("id", features.kmer_text(F.col("x.codes").cast("long"), 2).alias("kmer"), F.round("x.weights", 6).alias("tfidf"))


def t01_chop(spark, sf_dir):
    return select.chop(_t(spark, sf_dir, "documents"), "doc_id", "text", 500).groupBy("id").agg(F.count(F.lit(1)).alias("pieces"), F.max(F.length("fragment")).cast("long").alias("longest"))


def t07_kmer_counts(spark, sf_dir):
    return select.kmer_counts(_fragments(spark, sf_dir), "doc_id", "dna", 3)


def u03_split_overlap(spark, sf_dir):
    return select.split_overlap(_t(spark, sf_dir, "lineitem").withColumn("split", _split(F.col("l_orderkey"))), "l_suppkey", "split", "train", "evaluation")


def w02_genus_balance(spark, sf_dir):
    out = select.genus_balance(_t(spark, sf_dir, "part"), [F.desc("p_retailprice"), F.col("p_partkey")], "p_type", "p_brand", ["p_size"], 2)
    return out.select("p_partkey", "species_rank", "genus_rank", "decision")


def w12_bp_cap(spark, sf_dir):
    items = _t(spark, sf_dir, "lineitem").withColumn("bp", F.col("l_quantity").cast("long"))
    plan = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderkey") % 3 != 0, 60).cast("long").alias("target_bp"))
    return quota.bp_cap(items, plan, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "bp").select("l_orderkey", "l_linenumber", "bp", "bp_before")


def w14_apportion(spark, sf_dir):
    counts = _t(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")).withColumn("key", F.concat("l_returnflag", "l_linestatus"))
    return quota.apportion(counts, "n", 1000, "key").select("key", "n", "quota")


def w22_class_weights(spark, sf_dir):
    return quota.class_weights(_t(spark, sf_dir, "documents"), "lang").withColumn("weight", F.round("weight", 6))


def w33_pareto(spark, sf_dir):
    return metrics.pareto(_t(spark, sf_dir, "part"), "p_partkey", "p_retailprice", "p_size").select("p_partkey", "p_retailprice", "p_size")


def w34_latest_status(spark, sf_dir):
    return select.latest_status(_t(spark, sf_dir, "events"), "user_id", "event_type", "ts", "event_id").select("user_id", "event_type")


def a03_project(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    priors = spark.createDataFrame([("en", 0.4), ("de", 0.3), ("xx", 0.3)], "lang string, prior double")
    out = metrics.project(docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), priors, "lang", "n", 10_000_000)
    return out.select("lang", "n", "missing", F.round("share", 6).alias("share"), F.round("delta_pp", 6).alias("delta_pp"))


def a32_pred_share(spark, sf_dir):
    return metrics.pred_share(_predictions(spark, sf_dir), "pred").select("pred", F.round("share", 6).alias("share"))


def f22_range_bin(spark, sf_dir):
    return _t(spark, sf_dir, "documents").groupBy(scalars.range_bin(F.col("n_chars")).alias("bin")).agg(F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.count(F.lit(1)).alias("n"))


def j05_diff_index(spark, sf_dir):
    key = lambda c, v: F.concat(c.cast("string"), F.lit("."), v.cast("string")).alias("key")
    items = _t(spark, sf_dir, "lineitem").select(key(F.col("l_partkey"), F.col("l_linenumber")), "l_orderkey", "l_linenumber", "l_suppkey")
    index = _t(spark, sf_dir, "part").where("p_size < 25").select(key(F.col("p_partkey"), F.col("p_size") % 7 + 1))
    return select.diff_index(items, index, "key", ["l_orderkey", "l_linenumber", "l_suppkey"]).groupBy("key", "status").agg(F.count(F.lit(1)).alias("n"))


def j13_drop_leaky(spark, sf_dir):
    items = _t(spark, sf_dir, "lineitem")
    return select.drop_leaky(items.where("l_quantity < 49"), items.where("l_quantity >= 49"), "l_partkey").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))


def u05_distinct_sequences(spark, sf_dir):
    return select.distinct_sequences(_t(spark, sf_dir, "documents").where("text is not null"), ["lang"], "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (balanced_corpus, a01_census, a13_coverage_cells, a14_leakage, a18_class_metrics, a22_best_f1, a23_auprc, a26_compare, a28_length_hist, f17_filter_quality, f19_length_bin, f23_hash_split, f25_keep_by_id, j08_dedup_exact, j14_ancestors, m01_tfidf, t01_chop, t07_kmer_counts, u03_split_overlap, w02_genus_balance, w12_bp_cap, w14_apportion, w22_class_weights, w33_pareto, w34_latest_status, a03_project, a32_pred_share, f22_range_bin, j05_diff_index, j13_drop_leaky, u05_distinct_sequences)
    return {f.__name__: f for f in own} | functions.QUERIES | curation.QUERIES | scoring.QUERIES


_P = """p as (select *, quality::varchar as truth, quality as y, case when score >= 400 then '1' else '0' end as pred, case when score % 7 >= 2 then '1' else '0' end as other
        from (select *, ('0x' || substr(md5('s:' || doc_id), 1, 8))::bigint % 1000 as score from labels))"""
_CUM = f"""with {_P}, s as (select score, count(*) as n, sum(y) as pos from p group by score),
        c as (select score, pos, sum(n) over w as rows, sum(pos) over w as tp, sum(pos) over () as all_pos from s window w as (order by score desc))"""
_KMER = f"""(select doc_id as id, substr(s, i, {{k}}) as kmer, count(*) as n from (select doc_id, {DNA} as s from documents where length(text) >= {{k}}), range(1, length(s) - {{k}} + 2) t(i)
        where regexp_matches(substr(s, i, {{k}}), '^[ACGT]+$') group by all)"""


def oracle_sql() -> dict[str, str]:
    return functions.SQL | curation.SQL | scoring.SQL | {
        "a01_census": """select lang, source, coalesce(records, 0) as records, coalesce(bp, 0)::bigint as bp, round(coalesce(bp / records, 0), 6) as mean_bp
            from (select distinct lang from documents) cross join (select distinct source from documents)
            left join (select lang, source, count(*) as records, sum(n_chars) as bp from documents group by all) using (lang, source)""",
        "a13_coverage_cells": """with a as (select l_returnflag, l_linestatus, l_orderkey, count(*) as n, sum(l_quantity::bigint) as bp from lineitem group by all),
            r as (select *, row_number() over (partition by l_returnflag, l_linestatus order by n, l_orderkey) as i, count(*) over (partition by l_returnflag, l_linestatus) as m from a)
            select l_returnflag, l_linestatus, sum(n)::bigint as fragments, sum(bp)::bigint as bp, max(m) as accessions, max(n) as largest, max(case when i = m // 2 + 1 then n end) as median,
            round(2 * sum(i * n) / (max(m) * sum(n)) - (max(m) + 1) / max(m), 6) as gini from r group by all""",
        "a14_leakage": f"""with s as (select *, {SPLIT.format("l_orderkey")} as split from lineitem),
            l as (select split, 'l_partkey' as key, l_partkey as v from s union all select split, 'l_suppkey', l_suppkey from s union all select split, 'l_orderkey', l_orderkey from s),
            g as (select key, v, count(distinct split) as c, count(*) as n from l group by all)
            select key, count(v) as n_values, count(*) filter (v is not null and c > 1) as leaked, coalesce(sum(n) filter (v is null), 0)::bigint as unresolved from g group by key""",
        "a18_class_metrics": f"""with {_P}, k as (select unnest(['0', '1']) as class),
            c as (select class, (select count(*) from p where truth = class) as support, (select count(*) from p where pred = class) as predicted, (select count(*) from p where truth = class and pred = class) as hit from k)
            select class, support, round(coalesce(hit / nullif(predicted, 0), 0), 6) as precision, round(coalesce(hit / nullif(support, 0), 0), 6) as recall, round(coalesce(2 * hit / nullif(support + predicted, 0), 0), 6) as f1,
            round(avg(coalesce(2 * hit / nullif(support + predicted, 0), 0)) over (), 6) as macro_f1, round((select avg((truth = pred)::int) from p), 6) as accuracy from c""",
        "a22_best_f1": f"{_CUM} select score as threshold, round(2 * tp / (rows + all_pos), 6) as f1 from c order by 2 * tp / (rows + all_pos) desc, score desc limit 1",
        "a23_auprc": f"{_CUM} select round(sum(pos / all_pos * tp / rows), 6) as auprc from c",
        "a26_compare": f"""with {_P} select toxic, count(*) as n, count(*) filter (pred = truth and other = truth) as both, count(*) filter (pred = truth and other <> truth) as only_a, count(*) filter (pred <> truth and other = truth) as only_b,
            count(*) filter (pred <> truth and other <> truth) as neither, round(avg((pred <> other)::int), 6) as disagreement, round(2.8 * sqrt(avg((pred <> other)::int) / count(*)), 6) as detectable,
            round(count(*) filter (pred = truth or other = truth) / count(*), 6) as oracle_accuracy from p group by toxic""",
        "a28_length_hist": "select lang, n_chars as length, count(*) as n, sum(n_chars)::bigint as bp from documents group by all",
        "f17_filter_quality": f"select doc_id, round(length(regexp_replace({DNA}, '[^ACGT]', '', 'g')) / length(text), 6) as purity from documents where length(text) >= 100 and length(regexp_replace({DNA}, '[^ACGT]', '', 'g')) / length(text) >= 0.75",
        "f19_length_bin": "select doc_id, coalesce((select 'L' || l from (select unnest([1000, 2000, 3000, 5000, 10000]) as l) where abs(n_chars - l) <= 50), 'VAR') as bin from documents",
        "f23_hash_split": f"select o_orderkey, {SPLIT.format('o_orderkey')} as split from orders",
        "f25_keep_by_id": "select l_orderkey, count(*) as n from lineitem where ('0x' || substr(md5('42:' || l_orderkey), 1, 8))::bigint < 1288490188 group by all",
        "j08_dedup_exact": f"""with s as (select doc_id, text, {SPLIT.format("doc_id")} as split from documents)
            select doc_id, split from s where split = 'evaluation' or text not in (select text from s where split = 'evaluation')""",
        "j14_ancestors": """with recursive n as (select 'c' || c_custkey as id, 'n' || c_nationkey as parent from customer union all select 'n' || n_nationkey, 'r' || n_regionkey from nation union all select 'r' || r_regionkey, 'root' from region),
            a as (select id, parent as ancestor, 1 as depth from n union all select a.id, n.parent, depth + 1 from a join n on a.ancestor = n.id) select * from a""",
        "m01_tfidf": f"""with c as {_KMER.format(k=2)}, d as (select kmer, count(*) as df from c group by kmer), w as (select id, kmer, n * (ln(((select count(*) from documents) + 1.0) / (df + 1)) + 1) as w from c join d using (kmer))
            select id, kmer, round(w / sqrt(sum(w * w) over (partition by id)), 6) as tfidf from w""",
        "t01_chop": "select doc_id as id, greatest(1, length(text) // 500)::bigint as pieces, least(length(text), 500)::bigint as longest from documents",
        "t07_kmer_counts": f"select * from {_KMER.format(k=3)}",
        "u03_split_overlap": f"with s as (select l_suppkey, {SPLIT.format('l_orderkey')} as split from lineitem) select l_suppkey from s where split = 'train' intersect select l_suppkey from s where split = 'evaluation'",
        "w02_genus_balance": """with s as (select *, row_number() over (partition by p_size, p_type order by p_retailprice desc, p_partkey) as species_rank from part),
            g as (select *, case when species_rank = 1 then row_number() over (partition by p_size, p_brand, species_rank = 1 order by p_retailprice desc, p_partkey) end as genus_rank from s)
            select p_partkey, species_rank::int as species_rank, genus_rank::int as genus_rank, case when species_rank > 1 then 'duplicate_within_species' when genus_rank <= 2 then 'selected' else 'dropped_by_genus_cap' end as decision from g""",
        "w12_bp_cap": """select l_orderkey, l_linenumber, bp, bp_before from (select l_orderkey, l_linenumber, l_quantity::bigint as bp, coalesce(sum(l_quantity::bigint) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice rows between unbounded preceding and 1 preceding), 0)::bigint as bp_before
            from lineitem join orders on o_orderkey = l_orderkey) where l_orderkey % 3 = 0 or bp_before < 60""",
        "w14_apportion": """with c as (select l_returnflag || l_linestatus as key, count(*) as n from lineitem group by all), r as (select *, 1000.0::double * n / sum(n) over () as raw from c)
            select key, n, (floor(raw) + (row_number() over (order by raw - floor(raw) desc, key) <= 1000 - sum(floor(raw)) over ())::int)::bigint as quota from r""",
        "w22_class_weights": "select lang, n, round(sum(n) over () / (count(*) over () * n), 6) as weight from (select lang, count(*) as n from documents group by lang)",
        "w33_pareto": """select p_partkey, p_retailprice, p_size from (select *, max(p_retailprice) over (order by p_size desc, p_retailprice desc, p_partkey rows between unbounded preceding and 1 preceding) as b from part) where b is null or p_retailprice > b""",
        "w34_latest_status": "select user_id, arg_max(event_type, (ts, event_id)) as event_type from events group by user_id",
        "a03_project": """with p as (select * from (values ('en', 0.4::double), ('de', 0.3::double), ('xx', 0.3::double)) t(lang, prior)), c as (select lang, count(*) as n from documents group by lang), t as (select count(*) as total from documents)
            select lang, coalesce(n, 0) as n, greatest(0, round_even(10000000 * prior, 0)::bigint - coalesce(n, 0)) as missing, round(coalesce(n, 0) / total, 6) as share, round(100 * (coalesce(n, 0) / total - prior), 6) as delta_pp from p left join c using (lang), t""",
        "a32_pred_share": f"with {_P}, c as (select pred, count(*) as n from p group by pred) select pred, round(n / (select sum(n) from c), 6) as share from c order by n desc, pred limit 1",
        "j05_diff_index": """with i as (select l_partkey || '.' || l_linenumber as key, l_partkey, row_number() over (partition by l_partkey, l_linenumber order by l_orderkey, l_suppkey) as nth from lineitem),
            x as (select p_partkey, p_partkey || '.' || (p_size % 7 + 1) as key from part where p_size < 25)
            select key, case when nth > 1 then 'duplicate_in_source' when key in (select key from x) then 'already_held' when l_partkey in (select p_partkey from x) then 'other_version' else 'new' end as status, count(*) as n from i group by all""",
        "j13_drop_leaky": "select l_partkey, count(*) as n from lineitem where l_quantity < 49 and l_partkey not in (select l_partkey from lineitem where l_quantity >= 49) group by l_partkey",
        "f22_range_bin": """select bin, min(n_chars) as least, max(n_chars) as most, count(*) as n from (select n_chars, coalesce((select lo || '-' || (hi - 1) from
            (values (800, 1000), (1000, 1250), (1250, 1500), (1500, 1750), (1750, 2000), (2000, 2250), (2250, 2500)) t(lo, hi) where n_chars >= lo and n_chars < hi), 'outside') as bin from documents) group by bin""",
        "u05_distinct_sequences": "select lang, sha256(text) as digest, count(*) as copies from documents where text is not null group by all",
    }
