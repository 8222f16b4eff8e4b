"""Queries of curation, plans, joins and taxonomy, over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import labels, scalars
from ..operators import curate, metrics, plan, quota, select, taxonomy
from .functions import _CLASS, MAG, TECH
from .standins import FR, G, fragments, genomes, table

CLASSES = ("bacteria", "eukarya", "virus")


def _evidence(df):
    text = F.concat_ws(" ", "excluded_from_refseq", "definition")
    return df.withColumn("mag_evidence", scalars.evidence(text, "mag", F.col("is_mag"))).withColumn("non_isolate", scalars.evidence(text, "non_isolate"))


def _reports(spark, sf_dir):
    g = genomes(spark, sf_dir)
    acc = lambda k: g.where(f"n % {k} = 0").select(F.col("assembly_accession").alias("accession"))
    species = g.where("species_taxid <> ''").select("species_taxid").distinct()
    number = F.col("species_taxid").cast("int")
    return {
        "type_mismatch": acc(40),
        "synonym": acc(35),
        "type_strain": acc(12),
        "reference": acc(15),
        "contamination": g.where("n % 20 = 0").select(F.col("assembly_accession").alias("accession"), (F.col("n") % 100 / 1000.0).alias("fraction")),
        "size_range": species.where(number % 3 == 0).select("species_taxid", (number * 100000.0).alias("lo"), (number * 150000.0).alias("hi")),
        "ani_group": species.where(number % 7 == 0).select("species_taxid", F.concat(F.lit("ANIG_"), (number % 5).cast("string")).alias("ani_group")),
    }


VIRUS = {"allowed": ("dsDNA", "ssRNA", "retro"), "min_length": 300}


def f16_apply_qc(spark, sf_dir):
    """Assemblies, organelles and viruses; some N50 and technologies come from a feature table."""
    g = genomes(spark, sf_dir)
    curated = F.when(F.col("n") % 38 == 0, "1").otherwise("0")
    master = g.withColumn("is_refseq_viral", curated).withColumn("virus_genome_id", F.when(F.col("n") % 57 == 0, F.concat(F.lit("VG"), F.col("n").cast("string"))).otherwise(""))
    features = g.where("n % 16 = 0").select(F.col("assembly_accession").alias("accession"), F.lit("").alias("contig_n50"), (F.col("n") * 10).cast("string").alias("scaffold_n50"), F.lit("PromethION").alias("sequencing_technology"))
    out = curate.apply_qc(master, _reports(spark, sf_dir), features=features, virus=VIRUS)
    return out.select("n", "n50_value", "n50_metric", "qc_status", F.round("score", 6).alias("score"), F.array_join("flags", ",").alias("flags"), "split_group_id")


def j06_canonicalize_pairs(spark, sf_dir):
    g = genomes(spark, sf_dir).withColumn("assembly_accession", F.concat(F.when(F.col("n") % 3 == 0, "GCF_").otherwise("GCA_"), F.lpad((F.col("n") - F.when(F.col("n") % 3 == 1, 1).otherwise(0)).cast("string"), 9, "0"), F.lit(".1")))
    g = g.withColumn("paired_accession", F.when(F.col("n") % 3 == 0, F.concat(F.lit("GCA_"), F.lpad(F.col("n").cast("string"), 9, "0"), F.lit(".1"))).otherwise(""))
    return curate.canonicalize_pairs(g).select("n", "assembly_accession")


def _sources(spark, sf_dir):
    """Genomes, some again under the portal's name with other versions, and some twice."""
    g = _evidence(genomes(spark, sf_dir)).withColumn("ordinal", F.col("n")).withColumn("priority", F.when(F.col("source") == "refseq", 0).when(F.col("source") == "genbank", 1).otherwise(2)).withColumn("dataset_role", F.lit("train_candidate"))
    again = g.where("n % 9 = 0 and source <> 'jgi'").withColumn("source", F.lit("jgi")).withColumn("priority", F.lit(2)).withColumn("ordinal", F.col("n") + 1_000_000).withColumn("entity_id", F.concat(F.lit("JGI:"), "entity_id")).withColumn("assembly_accession", F.when(F.col("n") % 18 == 0, F.concat(F.substring_index("assembly_accession", ".", 1), F.lit(".8"))).otherwise(""))
    twice = g.where("n % 10 = 3").withColumn("priority", F.lit(1)).withColumn("ordinal", F.col("n") + 2_000_000)
    return g.unionByName(again).unionByName(twice)


def j07_build_index(spark, sf_dir):
    out = curate.build_index(_sources(spark, sf_dir), F.col("mag_evidence"), "exclude", before="2020/01/12")
    return out.select("ordinal", "entity_id", "source", "status")


def a10_inventory(spark, sf_dir):
    return curate.inventory(curate.build_index(_sources(spark, sf_dir), F.col("mag_evidence"), "exclude", before="2020/01/12"))


def _master(spark, sf_dir):
    return _evidence(genomes(spark, sf_dir)).withColumn("n50_value", F.coalesce(scalars.number(F.nullif("contig_n50", F.lit(""))), scalars.number(F.nullif("scaffold_n50", F.lit(""))))).withColumn("qc_score", F.col("n") % 10 / 1.0).withColumn("dataset_role", F.when(F.col("n") % 25 == 0, "test_only").otherwise("train_candidate"))


def w09_select_species(spark, sf_dir):
    return curate.select_species(_master(spark, sf_dir)).select("n", "partition", "species_key", F.round("selection_score", 6).alias("selection_score"), "rank", "selected", "reason")


def w10_select_viruses(spark, sf_dir):
    s = genomes(spark, sf_dir).select("n", F.concat(F.lit("V"), (F.col("n") % 500).cast("string")).alias("virus_genome_id"), F.concat(F.lit("S"), (F.col("n") % 500 % 80).cast("string")).alias("species_key"), (F.col("n") % 7 / 1.0).alias("qc_score"), (F.col("n") % 11 == 0).alias("is_refseq"), F.when(F.col("n") % 500 % 3 == 0, "human").otherwise("").alias("host"), F.col("virus_reported_genome_length"), "virus_group", F.col("n").alias("segment_no"))
    chosen, audit = curate.select_viruses(s, genomes=40)
    kept = chosen.groupBy("virus_genome_id").agg(F.count(F.lit(1)).alias("kept"))
    return audit.join(kept, "virus_genome_id", "left").select("virus_genome_id", "segments", "curated", "length", F.round("score", 6).alias("score"), "rank", "genome_type", "selected", "reason", F.coalesce("kept", F.lit(0)).alias("kept"))


GATES = {"min_size": 1_000_000, "levels": ("complete genome", "chromosome", "scaffold"), "max_contigs": 800}


def w01_quality_order(spark, sf_dir):
    """The best genome of each genus by the quality order."""
    rank = F.row_number().over(Window.partitionBy("genus_key").orderBy(*scalars.quality_order()))
    return genomes(spark, sf_dir).withColumn("rank", rank).select("n", "genus_key", "rank")


def w03_genus_quota(spark, sf_dir):
    g = genomes(spark, sf_dir).withColumn("size", scalars.number(F.col("genome_size"), 0.0)).withColumn("gc", scalars.number(F.col("gc_percent"), -1.0)).withColumn("genus", F.concat("genus_key", F.lit("/"), (F.col("n") % 40).cast("string")))
    return select.genus_quota(g, "genus", ("species_taxid", "taxid"), "size", "gc")


def w04_pick_genus(spark, sf_dir):
    g = genomes(spark, sf_dir)
    quotas = g.groupBy("genus_key").agg((F.count(F.lit(1)) % 5 + 1).alias("quota"))
    return select.pick_genus(g, quotas, "genus_key", scalars.quality_order(), F.col("n") % 100 == 0).select("n", "genus_key", "genus_rank")


def w05_round_robin(spark, sf_dir):
    return select.round_robin(genomes(spark, sf_dir), "genus_key", [F.desc("n")], 60).select("n", "genus_key", "turn")


def w06_clade_budget(spark, sf_dir):
    clades = genomes(spark, sf_dir).groupBy("clade").agg(F.count(F.lit(1)).cast("double").alias("share"))
    return curate.clade_budget(clades, 40_000_000, 0.3167).select("clade", "fragments", "bp", "capacity")


def _curated(spark, sf_dir):
    g = genomes(spark, sf_dir)
    return g, g.where("n % 50 = 0").select(F.concat(F.substring_index("assembly_accession", ".", 1), F.lit(".77")).alias("accession"))


def w07_select_balanced(spark, sf_dir):
    g, anchors = _curated(spark, sf_dir)
    budget = curate.clade_budget(g.select("clade").distinct().withColumn("share", F.length("clade").cast("double")), 200_000, 0.5)
    return curate.select_balanced(g, budget, GATES, anchors=anchors).select("n", "clade", "genus_rank", "anchor", "target_bp", "target_fragments")


def w07_clade_report(spark, sf_dir):
    g, anchors = _curated(spark, sf_dir)
    budget = curate.clade_budget(g.select("clade").distinct().withColumn("share", F.length("clade").cast("double")), 200_000, 0.5)
    return curate.clade_report(g, curate.select_balanced(g, budget, GATES, anchors=anchors), budget, GATES, anchors=anchors)


def w08_select_breadth(spark, sf_dir):
    g, anchors = _curated(spark, sf_dir)
    return curate.select_breadth(g, GATES, anchors=anchors, clades=("ECONOMY", "SMALL")).select("n", "clade", "genus_rank", "anchor", "target_bp", "target_fragments")


def w11_class_cap(spark, sf_dir):
    out = select.class_cap(table(spark, sf_dir, "orders"), "o_orderpriority", [F.desc("o_totalprice"), F.col("o_orderkey")], 500, F.col("o_orderstatus") == "P")
    return out.select("o_orderkey", "o_orderpriority", "class_rank")


def a09_balance_report(spark, sf_dir):
    g = genomes(spark, sf_dir).withColumn("split", F.when(F.col("n") % 10 < 8, "train").otherwise("validation")).withColumn("species", F.concat(F.lit("s"), (F.col("n") % 300).cast("string")))
    d = select.genus_balance(g, [F.desc("n")], "species", "genus_key", ["split", "klass"], 5).withColumn("unresolved", F.col("species_taxid") == "")
    return curate.balance_report(d, "klass", "split", "species", "genus_key").withColumnRenamed("class", "cls")


def j01_versioned_join(spark, sf_dir):
    g = genomes(spark, sf_dir)
    right = g.where("n % 3 <> 1").select(F.when(F.col("n") % 2 == 0, F.col("assembly_accession")).otherwise(F.concat(F.substring_index("assembly_accession", ".", 1), F.lit(".6"))).alias("assembly_accession"), F.col("n").alias("value"), "n")
    right = right.unionByName(right.withColumn("value", F.col("value") + 10_000).withColumn("n", F.col("n") + 10_000))
    return select.versioned_join(g.select("n", "assembly_accession"), right, "assembly_accession", ["value"], "n").select("n", "value", "match")


def _indexes(spark, sf_dir):
    g = genomes(spark, sf_dir)
    own = g.where("n % 4 <> 3").select(F.col("assembly_accession").alias("accession"), F.col("klass").alias("training_class"), F.col("n").alias("ordinal"), "entity_type")
    other = g.where("n % 5 = 0 or n % 4 = 3").select(F.when(F.col("n") % 2 == 0, F.col("assembly_accession")).otherwise(F.concat(F.substring_index("assembly_accession", ".", 1), F.lit(".6"))).alias("accession"), F.lit("eukarya").alias("training_class"), F.col("n").alias("ordinal"), F.when(F.col("n") % 3 == 0, "new").otherwise("held").alias("status"), F.when(F.col("n") % 7 == 0, "1").otherwise("0").alias("is_anchor"))
    status = g.where("n % 3 <> 0").select(F.concat(F.substring_index("assembly_accession", ".", 1), F.lit(".1")).alias("accession"), F.when(F.col("n") % 5 == 0, "failed").when(F.col("n") % 2 == 0, "OK").otherwise("cached").alias("result"))
    local = g.where("n % 34 = 0").select(F.col("assembly_accession").alias("accession"))
    return own, other, status, local


def j02_merge_indexes(spark, sf_dir):
    return plan.merge_indexes(*_indexes(spark, sf_dir), CLASSES)


def _plans(spark, sf_dir):
    g = genomes(spark, sf_dir)
    manifest = g.where("n % 6 <> 5").select(F.col("assembly_accession").alias("accession"), F.col("n").alias("ordinal"))
    selection = g.where("n % 3 = 0 or n % 6 = 5").select(F.when(F.col("n") % 2 == 0, F.col("assembly_accession")).otherwise(F.concat(F.substring_index("assembly_accession", ".", 1), F.lit(".6"))).alias("accession"), (F.col("n") * 10).alias("target_bp"), F.col("n").alias("ordinal"))
    required = g.where("n % 4 = 0 or n % 6 = 5").select(F.concat(F.substring_index("assembly_accession", ".", 1), F.lit(".7")).alias("accession"), F.when(F.col("n") % 8 == 0, "1").otherwise("0").alias("is_anchor"), F.when(F.col("n") % 5 == 0, "New").otherwise("held").alias("status"), F.col("n").alias("ordinal"))
    return manifest, selection, required


def j03_merge_plans(spark, sf_dir):
    manifest, selection, required = _plans(spark, sf_dir)
    rows, missing = plan.merge_plans(manifest, selection, plan.required_rows(required, ["new"]))
    return rows.select(F.col("manifest_accession").alias("accession"), "plan_source", "target_bp").unionByName(missing.select("accession", F.concat(F.lit("missing:"), "required_by").alias("plan_source"), F.lit(None).cast("long").alias("target_bp")))


def u04_required_rows(spark, sf_dir):
    return plan.required_rows(_plans(spark, sf_dir)[2], [" New "]).select("accession", "is_anchor", "status")


def u02_anchors_missing(spark, sf_dir):
    manifest, _, required = _plans(spark, sf_dir)
    return plan.anchors_missing(required, manifest)


def _subset(spark, sf_dir):
    f = fragments(spark, sf_dir).withColumnRenamed("doc_id", "fragment_id")
    p = f.where("fragment_id % 97 < 60").groupBy(F.substring_index("accession", ".", 1).alias("b")).agg(F.sum("bp").alias("bp"), F.min("ordinal").alias("ordinal")).select(F.concat("b", F.lit(".1")).alias("accession"), F.when(F.col("ordinal") % 5 > 0, F.floor(F.col("bp") / 2) * F.when(F.col("ordinal") % 7 == 1, 4).otherwise(1)).cast("long").alias("target_bp"), "ordinal")
    more = f.sparkSession.range(3).select(F.concat(F.lit("GCA_X"), F.col("id").cast("string")).alias("accession"), F.lit(5).cast("long").alias("target_bp"), (F.col("id") + 5000).alias("ordinal"))
    return plan.subset_by_plan(f, p.unionByName(more), ["eukarya"], ["bacteria", "eukarya", "archaea"], "header")


def j04_subset_by_plan(spark, sf_dir):
    return _subset(spark, sf_dir)[0].select("fragment_id", F.col("final_class").alias("cls"), "match")


def j04_subset_counts(spark, sf_dir):
    return _subset(spark, sf_dir)[2].select("outcome", "match", "mismatch", "fragments", "bp")


def w12_plan_shortfall(spark, sf_dir):
    """Accessions of the plan that the corpus lacks, or has too little of."""
    return _subset(spark, sf_dir)[1].select("plan_accession", "problem", "target_bp", "available_bp", "kept_bp", "deficit_bp")


def u01_flatten_splits(spark, sf_dir):
    return plan.flatten_splits(fragments(spark, sf_dir).select("doc_id", "split", "class"), ["train", "validation"]).groupBy("class").agg(F.count(F.lit(1)).alias("fragments"), F.min("doc_id").alias("first")).withColumnRenamed("class", "cls")


def j05_diff_versions(spark, sf_dir):
    key = lambda c, v: F.concat(c.cast("string"), F.lit("."), v.cast("string")).alias("key")
    items = table(spark, sf_dir, "lineitem").select(key(F.col("l_partkey"), F.col("l_linenumber")), "l_orderkey", "l_linenumber", "l_suppkey")
    index = table(spark, sf_dir, "part").where("p_size < 25").select(key(F.col("p_partkey"), F.col("p_size") % 7 + 1))
    return select.diff_index(items, index, "key", ["l_orderkey", "l_linenumber", "l_suppkey"], detailed=True).groupBy("key", "status").agg(F.count(F.lit(1)).alias("n"))


def _hits(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("query"), F.col("l_suppkey").alias("target"), (0.9 + F.col("l_tax")).alias("fident"), (1 - F.col("l_discount")).alias("qcov"), (0.8 + F.col("l_quantity") / 250).alias("tcov"), "l_orderkey", "l_linenumber")


def j10_accept_hits(spark, sf_dir):
    return select.accept_hits(_hits(spark, sf_dir))


def j10_hit_report(spark, sf_dir):
    return select.hit_report(_hits(spark, sf_dir), table(spark, sf_dir, "part"), "p_partkey", ["p_brand"]).withColumn("retention", F.round("retention", 6))


def j11_regroup(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("split", F.when(F.col("p_partkey") % 10 < 8, "train").otherwise("test"))
    return select.regroup(parts, select.accept_hits(_hits(spark, sf_dir)), "p_partkey", ["split", "p_brand"])[1].withColumn("retention", F.round("retention", 6))


def j12_mag_qc(spark, sf_dir):
    contigs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("contig_id"), F.col("o_custkey").alias("mag_id"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("o_custkey") % 3 + 1).cast("int")).alias("mag_kingdom"), (F.col("o_orderkey") % 5000 + 1000).alias("length"))
    hits = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("contig_id"), (0.85 + F.col("l_discount")).alias("fident"), (0.4 + F.col("l_quantity") / 100).alias("qcov"), (0.45 + F.col("l_tax") * 5).alias("tcov"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("l_suppkey") % 3 + 1).cast("int")).alias("target_kingdom"), (F.col("l_linenumber") * 100_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey")).alias("ordinal"))
    return select.mag_qc(contigs, hits).withColumn("foreign_share", F.round("foreign_share", 6))


def _tree(spark, sf_dir):
    """customer, nation and region as species, genus and family under a root, some taxa without genus or family."""
    c, n, r = (table(spark, sf_dir, x) for x in ("customer", "nation", "region"))
    node = lambda df, i, p, rank, name: df.select(i.cast("long").alias("id"), p.cast("long").alias("parent"), rank.alias("rank"), name.alias("name"))
    rows = node(c, F.col("c_custkey") + 1000, F.when(F.col("c_custkey") % 13 == 0, 5).otherwise(F.col("c_nationkey") + 100), F.when(F.col("c_custkey") % 4 == 0, "strain").otherwise("species"), F.col("c_name"))
    rows = rows.unionByName(node(n, F.col("n_nationkey") + 100, F.col("n_regionkey") + 10, F.lit("genus"), F.col("n_name"))).unionByName(node(r, F.col("r_regionkey") + 10, F.when(F.col("r_regionkey") == 0, 5).otherwise(2), F.when(F.col("r_regionkey") < 3, "family").otherwise("order"), F.col("r_name")))
    top = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("id"), F.lit(p).cast("long").alias("parent"), F.lit("no rank").alias("rank"), F.lit(m).alias("name")) for i, p, m in ((1, 1, "root"), (2, 1, "two"), (5, 1, "five"))))).alias("x")).select("x.*")
    return rows.unionByName(top)


_CLADES = (("clade_a", 11, ()), ("clade_b", 12, ()), ("clade_c", 2, ("two",)), ("clade_d", 5, ()))


def _info(spark, sf_dir):
    tree = _tree(spark, sf_dir)
    taxa = table(spark, sf_dir, "orders").select((F.col("o_custkey") + F.when(F.col("o_custkey") % 50 == 7, 900_000).otherwise(1000)).cast("long").alias("taxid"))
    return taxonomy.taxon_info(taxa, tree.select("id", "parent", "rank"), tree.where("id % 9 <> 0").select("id", "name"), _CLADES)


def j15_taxon_info(spark, sf_dir):
    return _info(spark, sf_dir).select("taxid", "ok", "clade", "species", "genus_key", "genus_name", "family_key", "family_name")


_LINEAGE = "case n % 5 when 0 then 'Eukaryota; Fungi; Ascomycota; Genus' || cast(n as string) when 1 then 'Bacteria;;Proteo ; ' when 2 then '' when 3 then 'Eukaryota; Metazoa; Vertebrata' else 'Unknown thing' end"


def j16_lineage_info(spark, sf_dir):
    return genomes(spark, sf_dir).select("n", taxonomy.lineage_info(F.expr(_LINEAGE), F.col("organism_name")).alias("i")).select("n", "i.*")


def j17_resolve_metadata(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    meta = o.select(F.concat(F.when(F.col("o_orderkey") % 31 == 0, "").otherwise(F.concat(F.lit("A"), F.col("o_custkey").cast("string"))), F.lit("|"), F.col("o_orderkey").cast("string")).alias("record_id"), F.when(F.col("o_orderkey") % 7 == 0, "bacteria").otherwise("eukarya").alias("legacy_class"), F.when(F.col("o_orderkey") % 5 == 0, "fungi").otherwise("").alias("euk_group"), F.lit("").alias("species_taxid"))
    acc = o.where("o_custkey % 11 <> 0").select(F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("accession"), (F.col("o_custkey") + F.when(F.col("o_custkey") % 50 == 7, 900_000).otherwise(1000)).cast("long").alias("taxid"))
    return taxonomy.resolve_metadata(meta, acc, _info(spark, sf_dir), ("clade_a", "clade_b", "fungi"), {"clade_d": "fungi"})


def j18_resolve_group(spark, sf_dir):
    g = genomes(spark, sf_dir).select("n", F.when(F.col("n") % 40 == 0, "algae").otherwise("").alias("manual"), F.when(F.col("n") % 6 == 0, "fungi").when(F.col("n") % 6 == 1, "bacteria").alias("taxdump_clade"), F.expr(_LINEAGE).alias("lineage"), "source_group", "supergroup", F.when(F.col("n") % 3 == 0, "Alga").otherwise("").alias("euk_group"))
    return taxonomy.resolve_group(g, "manual").select("n", "group", "how")


def j19_merge_sources(spark, sf_dir):
    g = genomes(spark, sf_dir).select(F.when(F.col("n") % 100 == 0, "").otherwise((F.col("n") % 400).cast("string")).alias("key"), "n", "species_taxid", F.col("host"), F.col("contig_n50"))
    return taxonomy.merge_sources(g, "key", "n")


def j25_acc2clade(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    acc = o.where("o_custkey % 11 <> 0").select(F.concat(F.lit("A"), F.col("o_custkey").cast("string"), F.lit(".1")).alias("accession"), (F.col("o_custkey") + 1000).cast("long").alias("taxid"))
    tree = _tree(spark, sf_dir)
    info = taxonomy.taxon_info(acc.select("taxid"), tree.select("id", "parent", "rank"), tree.select("id", "name"), _CLADES)
    return taxonomy.acc2clade(o.select("o_orderkey", F.concat(F.lit("A"), F.col("o_custkey").cast("string"), F.lit(".3")).alias("accession")), acc, info).groupBy("clade").agg(F.count(F.lit(1)).alias("headers"))


def _groups(spark, sf_dir):
    f = fragments(spark, sf_dir)
    return taxonomy.resolve_group(f.select("doc_id", "split", "accession", "euk_group"))


def a16_completeness(spark, sf_dir):
    g = _groups(spark, sf_dir)
    records = g.where("not (group = 'algae' and split = 'validation') and coalesce(group, '') <> 'alveolata' and coalesce(group, '') <> 'stramenopiles'").select("split", F.when((F.col("doc_id") % 3 == 0) & (F.col("group") != "fungi"), F.col("group")).alias("current"), F.col("group").alias("resolved"))
    return taxonomy.completeness(records, g.where("group in ('algae', 'fungi')").select("group"), g.where("group in ('alveolata', 'fungi')").select("accession", "group"))


def a16_label_actions(spark, sf_dir):
    g = _groups(spark, sf_dir).select(F.when(F.col("doc_id") % 3 > 0, F.when(F.col("doc_id") % 5 > 0, F.col("group")).otherwise("fungi")).alias("current"), F.col("group").alias("resolved"))
    return taxonomy.label_actions(g).groupBy("action").agg(F.count(F.lit(1)).alias("records"))


def j20_organelle_inventory(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit("."), (F.col("l_linenumber") % 3).cast("string")).alias("accession"), F.col("l_quantity").cast("long").alias("length"), (F.col("l_orderkey") * 100_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("ordinal"))
    items = items.groupBy("ordinal").agg(F.min("accession").alias("accession"), F.min("length").alias("length"))
    meta = table(spark, sf_dir, "part").where("p_size > 5").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit(".9")).alias("accession"), F.when(F.col("p_size") % 4 > 0, F.col("p_brand")).otherwise("").alias("taxid"), F.col("p_name").alias("organism"))
    out = plan.organelle_inventory(items, meta, 10, 20)
    return out.groupBy(F.array_join("reasons", ",").alias("reasons"), "selected", "metadata_matched", "fasta_present").agg(F.count(F.lit(1)).alias("rows"), F.sum("length").alias("bp"))


def j20_organelle_stats(spark, sf_dir):
    """Two groups of organelle sequences; the cap goes by species, where that is known, else by taxon."""
    group = lambda c: F.when(c % 3 == 0, "plastid").otherwise("mito").alias("grp")
    items = table(spark, sf_dir, "lineitem").where("l_partkey % 7 < 5").groupBy("l_partkey", (F.col("l_linenumber") % 3).alias("v"), F.col("l_orderkey")).agg(F.min("l_quantity").cast("long").alias("length"))
    items = items.select(group(F.col("l_partkey")), F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit("."), F.col("v").cast("string")).alias("accession"), "length", (F.col("l_orderkey") * 10 + F.col("v")).alias("ordinal"))
    part = table(spark, sf_dir, "part")
    meta = part.where("p_size > 5").select(group(F.col("p_partkey")), F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit(".9")).alias("accession"), F.when(F.col("p_size") % 4 > 0, F.col("p_brand")).otherwise("").alias("taxid"), F.col("p_name").alias("organism"), F.when(F.col("p_size") % 3 > 0, F.col("p_type")).otherwise("").alias("species_taxid"))
    meta = meta.unionByName(meta.where("length(organism) % 5 = 0"))
    return plan.organelle_stats(plan.organelle_inventory(items, meta, 10, 20, "grp"), "grp", meta)


def j21_organize(spark, sf_dir):
    g = genomes(spark, sf_dir).withColumn("evaluation_collection", F.when(F.col("n") % 2 == 0, "mags").otherwise(""))
    qc = g.select("entity_id", F.when(F.col("n") % 5 == 0, "quarantine").otherwise("accepted").alias("qc_status"))
    split = g.where("n % 7 > 0").select("entity_id", F.when(F.col("n") % 3 == 0, "evaluation").when(F.col("n") % 11 == 0, "other").otherwise("train").alias("split"))
    manifest = g.where("n % 13 > 0").select("entity_id", F.concat("entity_id", F.lit(".fna.gz")).alias("filename"))
    status = g.select("entity_id", F.when(F.col("n") % 4 == 0, "failed").otherwise("cached").alias("result"))
    return plan.organize(g, qc, split, manifest, status)


def a33_verify(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    files = scalars.composition(docs.withColumn("seq", F.translate("text", "aeiou", "ACGTN")).where("doc_id % 5 > 0"), ["doc_id"], "seq", 0.05, 0.7).select(F.col("doc_id").cast("string").alias("path"), "ok")
    return plan.verify(docs.select(F.col("doc_id").alias("entity_id"), F.col("doc_id").cast("string").alias("path")), files)


def j22_relabel(spark, sf_dir):
    f = fragments(spark, sf_dir).where("class = 'eukarya'").select(F.col("doc_id").alias("record_id"), "split")
    curated = fragments(spark, sf_dir).select(F.col("doc_id").alias("record_id"), "split", "euk_group")
    return plan.relabel(f, curated).groupBy("split", "euk_group").agg(F.count(F.lit(1)).alias("records"))


def _delta(spark, sf_dir):
    f = fragments(spark, sf_dir).withColumn("digest", F.md5(F.col("text").cast("binary"))).withColumn("record_id", F.col("doc_id").cast("string"))
    base = f.where("doc_id % 2 = 0 and split <> 'test'").select("record_id", "split", "digest", "species_taxid", "split_group_id", "duplicate_cluster_id")
    cand = f.where("doc_id % 2 = 1 or doc_id % 50 = 0").where("split <> 'test'").select("record_id", "split", F.when(F.col("doc_id") % 19 == 0, "test").otherwise("").alias("meta_split"), "euk_group", "digest", "species_taxid", "split_group_id", "duplicate_cluster_id", "ordinal", (F.col("doc_id") % 23 > 0).alias("has_metadata"))
    required = spark.range(1).select(F.explode(F.array(F.lit("fungi"), F.lit("algae"), F.lit("plant"), F.lit("absent"))).alias("euk_group")).select(F.explode(F.array(F.lit("train"), F.lit("validation"))).alias("split"), "euk_group")
    return plan.admit_delta(base, cand, required)


def j24_admit_delta(spark, sf_dir):
    """What becomes of each candidate; sequential in nature, so its SQL is the set-based reading that the operator documents."""
    return _delta(spark, sf_dir)[0].groupBy("split", F.coalesce("reason", F.lit("admitted")).alias("reason")).agg(F.count(F.lit(1)).alias("candidates"))


def j24_unmet(spark, sf_dir):
    return _delta(spark, sf_dir)[1]


def a04_stratum_census(spark, sf_dir):
    g = genomes(spark, sf_dir).withColumn("cls", F.coalesce(labels.class_from_meta(F.col("label"), F.col("supergroup")), F.lit("none"))).withColumn("bp", F.coalesce(scalars.number(F.col("genome_size")), F.lit(0.0)).cast("long"))
    return metrics.stratum_census(g.withColumn("s", labels.stratum(F.col("cls"), F.col("label"), F.col("supergroup"))).select("s.stratum", "s.how", "bp"), "stratum", "how", "bp")


def a05_clade_coverage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("lang = 'en' and source not in ('src3', 'src5')")
    stats = docs.groupBy(F.concat(F.lit("eukarya/"), "source").alias("stratum")).agg(F.sum("n_chars").alias("bp"))
    return quota.clade_coverage(stats, {f"src{i}": (1 + i % 3) / 10 for i in range(8)}).select("clade", "weight", "bp", "problem", F.round("redistributed", 6).alias("redistributed"))


def a07_audit_labels(spark, sf_dir):
    out = labels.audit_labels(genomes(spark, sf_dir), "klass", "label", "supergroup")
    return out.select("file_class", "records", "mismatched", "unknown", F.round("mismatch_rate", 6).alias("mismatch_rate"), F.size("worst").alias("worst"), (-F.get("worst", F.lit(0))["n"]).alias("most"))


def a08_repair_matrix(spark, sf_dir):
    g = genomes(spark, sf_dir).withColumn("target", labels.class_from_meta(F.col("label"), F.col("supergroup")))
    return metrics.repair_matrix(g, "klass", "target", ("bacteria", "eukarya", "virus", "archaea", "mitochondria", "plastids", "fungi"))


def a15_leakage_union(spark, sf_dir):
    f = fragments(spark, sf_dir).withColumn("record_id", F.col("doc_id"))
    delta = f.where("doc_id % 7 = 0").withColumn("split", F.lit("train")).withColumn("record_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).otherwise(F.col("doc_id") + 1_000_000))
    return metrics.leakage_union(f, delta, ["species_taxid", "split_group_id", "duplicate_cluster_id"], "split", "record_id")


QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "afjuw" and k[1:3].isdigit()}

_SP = "species_taxid"
_PARTS = f"""a as (select *, {MAG} as mag_evidence, {TECH} as tech, coalesce(nullif(contig_n50, ''), nullif(scaffold_n50, ''))::double as n50, case when {_SP} <> '' then 'SP:' || {_SP} when taxid <> '' then 'TX:' || taxid else 'NAME:' || lower(organism_name) end as species_key,
      case when contains(lower(excluded_from_refseq || ' ' || definition), 'derived from metagenome') then 'derived from metagenome' when contains(lower(excluded_from_refseq || ' ' || definition), 'single-cell') then 'single-cell' end as non_isolate from {G})"""
_ORDER = """case refseq_category when 'reference genome' then 0 when 'representative genome' then 1 else 2 end, case assembly_level when 'Complete Genome' then 0 when 'Chromosome' then 1 when 'Scaffold' then 2 else 3 end, (genome_rep = 'Partial')::int, (excluded_from_refseq <> '')::int,
      case when busco_complete <> '' then -busco_complete::double else 0 end, contig_count::double, case when seq_rel_date = '' then 0 else -replace(seq_rel_date, '/', '')::bigint end, assembly_accession"""
_SRC = f"""s0 as (select *, {MAG} as mag, n as ordinal, case source when 'refseq' then 0 when 'genbank' then 1 else 2 end as priority from {G}),
    s as (select entity_id, source, group_name, entity_type, assembly_accession, paired_accession, source_native_id, ftp_path, version_status, genome_rep, seq_rel_date, species_taxid, mag, ordinal, priority from s0
      union all select 'JGI:' || entity_id, 'jgi', group_name, entity_type, case when n % 18 = 0 then split_part(assembly_accession, '.', 1) || '.8' else '' end, paired_accession, source_native_id, ftp_path, version_status, genome_rep, seq_rel_date, species_taxid, mag, n + 1000000, 2 from s0 where n % 9 = 0 and source <> 'jgi'
      union all select entity_id, source, group_name, entity_type, assembly_accession, paired_accession, source_native_id, ftp_path, version_status, genome_rep, seq_rel_date, species_taxid, mag, n + 2000000, 1 from s0 where n % 10 = 3),
    p as (select *, entity_type <> 'assembly' or case when source = 'jgi' then source_native_id <> '' or assembly_accession <> '' else ftp_path not in ('', 'na') and version_status in ('', 'latest') and lower(genome_rep) in ('', 'full') and (seq_rel_date = '' or seq_rel_date < '2020/01/12') end as ok,
      case when source = 'jgi' and assembly_accession <> '' then assembly_accession else entity_id end as k, nullif(split_part(assembly_accession, '.', 1), '') as b from s),
    q as (select *, mag is null and ok as live from p),
    r as (select *, row_number() over (partition by k, live order by priority, ordinal) as nth, min(case when source = 'jgi' then priority * 1000000000 + ordinal end) over (partition by b, live) as jfirst, count(*) filter (source <> 'jgi') over (partition by b, live) as held from q),
    st as (select *, case when mag is not null then 'mag_excluded' when not ok then 'hard_filtered' when nth > 1 or (source = 'jgi' and ((b is not null and (held > 0 or priority * 1000000000 + ordinal > jfirst)) or paired_accession in (select entity_id from q where live and source <> 'jgi'))) then 'duplicate' else 'kept' end as status from r)"""
_GATED = f"""ga as (select *, n % 50 = 0 as anchor0 from {G}), gb as (select *, split_part(assembly_accession, '.', 1) in (select split_part(assembly_accession, '.', 1) from ga where anchor0) as anchor, coalesce(try_cast(genome_size as double), 0) as size from ga),
    gc as (select *, (size <> 0 and size < 1000000) or assembly_level = 'Contig' or genome_rep = 'Partial' or contig_count::int > 800 or excluded_from_refseq <> '' or version_status = 'replaced' as bad from gb),
    ge as (select * from gc where anchor or not bad),
    gq as (select genus_key, case when (max(case when size > 0 then size end) / min(case when size > 0 then size end) >= 3) or (count(try_cast(gc_percent as double)) >= 2 and max(try_cast(gc_percent as double)) - min(try_cast(gc_percent as double)) >= 8) then greatest(1, least(4, ceil(pow(count(distinct coalesce(nullif(species_taxid, ''), nullif(taxid, ''))) + count(*) filter (species_taxid = '' and taxid = ''), 0.4)), count(*))) else 1 end as quota from ge group by genus_key),
    gr as (select ge.*, quota, row_number() over (partition by ge.genus_key order by (not anchor), {_ORDER})::int as genus_rank from ge join gq using (genus_key)), gp as (select * from gr where anchor or genus_rank <= quota)"""
_SUB = f"""f as (select doc_id as fragment_id, accession, class, class_hint, bp, ordinal, split_part(accession, '.', 1) as b from {FR}),
    pl as (select b || '.1' as pa, b, case when min(ordinal) % 5 > 0 then (sum(bp) // 2) * case when min(ordinal) % 7 = 1 then 4 else 1 end end::bigint as target_bp from f where fragment_id % 97 < 60 group by b),
    fm as (select f.*, pl.pa, pl.target_bp, case when pl.pa = f.accession then 'exact' when pl.pa is not null then 'base' end as match, class_hint <> 'bundle' and class <> class_hint as mismatch from f left join pl using (b)),
    fb as (select *, coalesce(sum(case when class = 'eukarya' and match is not null then bp end) over (partition by pa order by ordinal rows between unbounded preceding and 1 preceding), 0) as before from fm),
    fo as (select *, case when class <> 'eukarya' then 'passthrough' when match is null then 'not_in_plan' when target_bp is not null and before >= target_bp then 'over_budget' else 'kept' end as outcome from fb)"""
_TREE = """tn as (select c_custkey + 1000 as id, case when c_custkey % 13 = 0 then 5 else c_nationkey + 100 end as parent, case when c_custkey % 4 = 0 then 'strain' else 'species' end as rank, c_name as name from customer
      union all select n_nationkey + 100, n_regionkey + 10, 'genus', n_name from nation union all select r_regionkey + 10, case when r_regionkey = 0 then 5 else 2 end, case when r_regionkey < 3 then 'family' else 'order' end, r_name from region
      union all select * from (values (1, 1, 'no rank', 'root'), (2, 1, 'no rank', 'two'), (5, 1, 'no rank', 'five')))"""
_INFO = f"""{_TREE}, tx as (select distinct o_custkey + case when o_custkey % 50 = 7 then 900000 else 1000 end as taxid from orders),
    ch as (select id as taxid, id as node, parent, rank, 0 as d from tn union all select ch.taxid, tn.id, tn.parent, tn.rank, d + 1 from ch join tn on tn.id = ch.parent where ch.node <> ch.parent),
    ti as (select taxid, min(case node when 11 then 0 when 12 then 1 when 2 then 2 when 5 then 3 end) as c, max(case when rank = 'species' then node end) as species, max(case when rank = 'genus' then node end) as genus, max(case when rank = 'family' then node end) as family from ch group by taxid),
    nm as (select id, name from tn where id % 9 <> 0),
    info as (select tx.taxid, ti.taxid is not null as ok, coalesce(['clade_a', 'clade_b', 'clade_c', 'clade_d'][c + 1], 'unknown') as clade, species, case when ti.taxid is null then null when genus is not null then 't' || genus else 'n' || tx.taxid end as genus_key,
      case when ti.taxid is null then null when genus is not null then coalesce(g.name, 'taxid:' || genus) else coalesce(o.name, 'taxid:' || tx.taxid) end as genus_name, family, f.name as fname
      from tx left join ti using (taxid) left join nm g on g.id = genus left join nm f on f.id = family left join nm o on o.id = tx.taxid)"""
_NG = """(case euk_group when 'fungi' then 'fungi' when 'plant' then 'land_plant' when 'algae' then 'algae' when 'vertebrate' then 'metazoa_vertebrate' when 'metazoa_invertebrate' then 'metazoa_invertebrate' when 'alveolata' then 'alveolata' when 'stramenopiles' then 'stramenopiles' when 'protist' then 'other_protist' end)"""

_BALANCED = f"""with {_GATED}, cl as (select distinct clade from {G}), cs as (select clade, 200000.0::double * 0.5::double * length(clade) / sum(length(clade)) over () as f from cl), bu as (select clade, floor(f * 4200)::bigint as bp, case when floor(f * 4200) > 0 then greatest(1, floor(floor(f * 4200) / 5000000)) else 0 end as capacity from cs),
        pk as (select gp.*, bp, capacity, count(*) over (partition by gp.clade) as m, count(*) filter (anchor) over (partition by gp.clade) as anchors from gp join bu using (clade)),
        ot as (select *, row_number() over (partition by clade, family order by genus_rank, {_ORDER}) as turn from pk where capacity > 0 and m > capacity and not anchor),
        fam as (select clade, family, row_number() over (partition by clade order by genus_rank, {_ORDER}) as fno from ot where turn = 1),
        pl as (select ot.*, row_number() over (partition by clade order by turn, fno) as place from ot join fam using (clade, family)),
        al as (select n, clade, genus_rank, anchor, bp, size from pk where not (capacity > 0 and m > capacity) or anchor union all select n, clade, genus_rank, anchor, bp, size from pl where place <= greatest(0, capacity - anchors)),
        am as (select *, greatest(5000000.0, least(bp / count(*) over (partition by clade), 50000000.0)) as sh from al), an as (select *, floor(case when size > 0 then least(sh, size * 0.8) else sh end)::bigint as target_bp from am)"""

SQL = {
    "f16_apply_qc": f"""with a0 as (select * replace (case when scaffold_n50 = '' and n % 16 = 0 then (n * 10)::varchar else scaffold_n50 end as scaffold_n50, case when sequencing_technology = '' and n % 16 = 0 then 'PromethION' else sequencing_technology end as sequencing_technology) from {G}),
        a as (select *, case when regexp_matches(lower(sequencing_technology), 'pacbio|pac bio|smrt|hifi|sequel|revio|nanopore|promethion|minion|gridion') then 1 end as tech,
          case when virus_group like 'dsDNA%' then 'dsDNA' when virus_group like 'ssRNA%' then 'ssRNA' when virus_group like 'ds-RNA%' then 'dsRNA' when virus_group like 'Retro%' then 'retro' when virus_group = 'ssDNA' then 'ssDNA' else 'unknown' end as vt from a0),
        b as (select *, case when contig_n50 not in ('', '0') then contig_n50::bigint when scaffold_n50 not in ('', '0') then scaffold_n50::bigint end as v, n % 100 / 1000.0 as frac, n % 20 = 0 as has_frac, try_cast(species_taxid as int) as sp,
          nullif(try_cast(case when genome_size_ungapped <> '' then genome_size_ungapped else genome_size end as double), 0) as size from a),
        c as (select *, case when v is null then 'missing' when contig_n50 not in ('', '0') then 'contig_n50' else 'scaffold_n50' end as n50_metric, array_to_string(list_filter([case when n % 40 = 0 then 'TYPE_NOT_MATCHING' end, case when n % 35 = 0 then 'SUSPECT_SYNONYM' end, case when has_frac and frac >= 0.05 then 'CONTAMINATION' end,
          case when sp % 3 = 0 and size < sp * 100000 * 0.5 then 'SIZE_BELOW_RANGE' end, case when sp % 3 = 0 and size >= sp * 100000 * 0.5 and size > sp * 150000 * 2 then 'SIZE_ABOVE_RANGE' end], lambda x: x is not null), ',') as flags from b),
        d as (select *, array_to_string(list_filter([case when sequence_accession = 'bad acc' then 'INVALID_ACCESSION' end, case when taxid = '' then 'MISSING_TAXID' end, case when download_url = '' then 'MISSING_DOWNLOAD_URL' end,
            case when vt not in ('dsDNA', 'ssRNA', 'retro') then 'GENOME_TYPE_' || vt end, case when virus_reported_genome_length::double between 1 and 299 then 'REPORTED_GENOME_TOO_SHORT' end], lambda x: x is not null), ',') as vflags,
          case when v is null then 0 else least(log10(v + 1), 8) end + case when source = 'refseq' then 2 else 0 end + case when tech is not null then 2 else 0 end + case assembly_level when 'Complete Genome' then 3 when 'Chromosome' then 3 when 'Scaffold' then -1 else -2 end
          + case when refseq_category <> 'na' then 3 else 0 end + case when n % 15 = 0 then 3 else 0 end + case when n % 12 = 0 or n % 53 = 0 then 2 else 0 end - case when has_frac then least(frac * 10, 3) else 0 end - case when excluded_from_refseq <> '' then 1 else 0 end as points from c)
        select n, v as n50_value, n50_metric,
          case entity_type when 'organelle' then 'accepted' when 'virus_sequence' then case when vflags = '' then 'accepted' else 'rejected' end else case when flags = '' then 'accepted' else 'quarantine' end end as qc_status,
          round(case entity_type when 'organelle' then 5 when 'virus_sequence' then 5 + case when n % 38 = 0 then 4 else 0 end + case when host <> '' then 1 else 0 end + case when vt <> 'unknown' then 1 else 0 end else points end, 6)::double as score,
          case entity_type when 'organelle' then '' when 'virus_sequence' then vflags else flags end as flags,
          case entity_type when 'organelle' then coalesce(nullif(species_taxid, ''), entity_id) when 'virus_sequence' then case when n % 57 = 0 then 'VG' || n else coalesce(nullif(species_taxid, ''), entity_id) end
            else case when sp % 7 = 0 then 'ANIG_' || (sp % 5) when sp is not null then 'SP_' || species_taxid else entity_id end end as split_group_id from d""",
    "j06_canonicalize_pairs": f"""with a as (select n, entity_type, paired_comparison, case when n % 3 = 0 then 'GCF_' else 'GCA_' end || lpad((n - case when n % 3 = 1 then 1 else 0 end)::varchar, 9, '0') || '.1' as assembly_accession from {G})
        select n, assembly_accession from a where entity_type <> 'assembly' or not (n % 3 = 1 and exists (select 1 from a x where x.n = a.n - 1 and x.paired_comparison = 'identical'))""",
    "j07_build_index": f"with {_SRC} select ordinal, entity_id, source, status from st",
    "a10_inventory": f"""with {_SRC} select source, group_name, count(*) as parsed, count(*) filter (status in ('hard_filtered', 'mag_excluded')) as hard_filtered, count(*) filter (status = 'duplicate') as duplicates, count(*) filter (status = 'kept') as kept, count(mag) as mag,
        count(*) - count(mag) as non_mag, count(*) filter (status = 'mag_excluded') as mag_excluded, count(distinct nullif(species_taxid, '')) as species from st group by all""",
    "w09_select_species": f"""with {_PARTS}, b as (select *, coalesce(n50, 0) as v, (source = 'refseq' or starts_with(assembly_accession, 'GCF_'))::int as rs, (tech is not null)::int as th, case assembly_level when 'Complete Genome' then 4 when 'Chromosome' then 3 when 'Scaffold' then 2 else 1 end as lv,
          case when entity_type = 'virus_sequence' then 'virus_sequence' when entity_type <> 'assembly' then case when n % 25 = 0 then 'passthrough_evaluation' else 'passthrough_train' end when klass = 'virus' then 'virus_assembly_test' when mag_evidence is not null then 'mag_evaluation'
            when n % 25 = 0 then 'passthrough_evaluation' when non_isolate is not null then 'excluded_non_isolate' else 'train_isolate' end as part from a),
        c as (select *, 12.0 * case when v > 0 then log10(v + 1) else 0 end + 8 * rs + 6 * th + 4 * (refseq_category <> 'na')::int + 2 * (n % 53 = 0)::int + 2 * lv + n % 10 as score from b),
        d as (select *, case when part in ('train_isolate', 'mag_evaluation', 'virus_assembly_test') then row_number() over (partition by part, species_key order by score desc, v desc, rs desc, th desc, assembly_accession desc, entity_id) end as r from c)
        select n, part as partition, species_key, round(score, 6)::double as selection_score, r::int as rank, case when r is null then part <> 'excluded_non_isolate' else r = 1 end as selected,
          case when r is not null then case when r = 1 then 'SELECTED_BEST_PER_SPECIES' else 'LOWER_RANK_SAME_SPECIES' end || case when v = 0 then ';MISSING_N50' else '' end || case when sequencing_technology = '' then ';UNKNOWN_TECH' else '' end
            when part = 'excluded_non_isolate' then 'NON_ISOLATE_EVIDENCE:' || non_isolate else 'PASSTHROUGH' end as reason from d""",
    "w10_select_viruses": f"""with s as (select n, 'V' || (n % 500) as v, 'S' || (n % 500 % 80) as sp, n % 7 as q, n % 11 = 0 as rs, n % 500 % 3 = 0 as host, virus_reported_genome_length::double as len, virus_group from {G}),
        g as (select v, arg_min(sp, n) as sp, arg_min(virus_group, n) as vg, count(*) as segments, count(*) filter (rs) as curated, max(len)::bigint as length, max(q) + case when count(*) filter (rs) > 0 then 4 else 0 end + max(host::int) + least(log10(max(len) + 1), 7) as score from s group by v),
        r as (select *, row_number() over (partition by sp order by score desc, curated desc, length desc, v desc) as rank, case when vg like 'dsDNA%' then 'dsDNA' when vg like 'ssRNA%' then 'ssRNA' when vg like 'ds-RNA%' then 'dsRNA' when vg like 'Retro%' then 'retro' when vg = 'ssDNA' then 'ssDNA' else 'unknown' end as genome_type from g),
        t as (select *, row_number() over (partition by rank = 1 order by score desc, curated desc, length desc, v desc) as top from r)
        select v as virus_genome_id, segments, curated, length, round(score, 6)::double as score, rank::int as rank, genome_type, rank = 1 and top <= 40 as selected,
          case when rank > 1 then 'LOWER_RANK_SAME_SPECIES' when top > 40 then 'GLOBAL_GENOME_CAP' else 'SELECTED_BEST_PER_SPECIES' end as reason, case when rank = 1 and top <= 40 then segments else 0 end as kept from t""",
    "w01_quality_order": f"select n, genus_key, row_number() over (partition by genus_key order by {_ORDER})::int as rank from {G}",
    "w03_genus_quota": f"""with a as (select genus_key || '/' || (n % 40) as genus, coalesce(nullif(species_taxid, ''), nullif(taxid, '')) as sp, coalesce(try_cast(genome_size as double), 0) as s, coalesce(try_cast(gc_percent as double), -1) as gc from {G})
        select genus, case when coalesce(max(case when s > 0 then s end) / min(case when s > 0 then s end) >= 3, false) or (count(*) filter (gc >= 0) >= 2 and max(case when gc >= 0 then gc end) - min(case when gc >= 0 then gc end) >= 8)
          then greatest(1, least(4, ceil(pow(count(distinct sp) + count(*) - count(sp), 0.4)), count(*))) else 1 end::bigint as quota from a group by genus""",
    "w04_pick_genus": f"""with a as (select *, count(*) over (partition by genus_key) % 5 + 1 as q, row_number() over (partition by genus_key order by (n % 100 <> 0), {_ORDER})::int as genus_rank from {G}) select n, genus_key, genus_rank from a where n % 100 = 0 or genus_rank <= q""",
    "w05_round_robin": f"""with a as (select n, genus_key, row_number() over (partition by genus_key order by n desc)::int as turn, max(n) over (partition by genus_key) as best from {G}) select n, genus_key, turn from a order by turn, best desc limit 60""",
    "w06_clade_budget": f"""with a as (select clade, count(*) as share from {G} group by clade), b as (select clade, 40000000.0::double * 0.3167::double * share / sum(share) over () as f from a)
        select clade, floor(f)::bigint as fragments, floor(f * 4200)::bigint as bp, greatest(1, floor(floor(f * 4200) / 5000000))::bigint as capacity from b""",
    "w07_select_balanced": f"""{_BALANCED}
        select n, clade, genus_rank, anchor, target_bp, floor(target_bp / 4200)::bigint as target_fragments from an""",
    "w07_clade_report": f"""{_BALANCED}, el as (select clade, count(distinct genus_key) as genera, count(*) as eligible from ge group by clade), pn as (select clade, count(*) as picked from gp group by clade),
        se as (select clade, count(*) as m, sum(target_bp)::bigint as planned, count(*) filter (anchor) as anchors from an group by clade)
        select clade, genera as genera_available, eligible as genomes_eligible, coalesce(m, 0) as genomes_selected, picked - coalesce(m, 0) as genomes_dropped_for_depth, floor(f)::bigint as budget_fragments, bp as budget_bp,
          case when m > 0 then floor(greatest(5000000.0, least(bp / m, 50000000.0))) else 0 end::bigint as bp_per_genome, coalesce(planned, 0) as planned_bp, coalesce(anchors, 0) as anchors
        from el join pn using (clade) left join se using (clade) join bu using (clade) join cs using (clade)""",
    "w08_select_breadth": f"""with {_GATED}, a as (select *, floor(case when size > 0 then least(50000000.0, size * 0.8) else 50000000.0 end)::bigint as target_bp from gp where clade in ('ECONOMY', 'SMALL')) select n, clade, genus_rank, anchor, target_bp, floor(target_bp / 4200)::bigint as target_fragments from a""",
    "w11_class_cap": """with a as (select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as r from orders where o_orderstatus <> 'P') select o_orderkey, o_orderpriority, r as class_rank from a where r <= 500 union all select o_orderkey, o_orderpriority, null from orders where o_orderstatus = 'P'""",
    "a09_balance_report": f"""with a as (select *, case when n % 10 < 8 then 'train' else 'validation' end as split, 's' || (n % 300) as species from {G}), s as (select *, row_number() over (partition by split, klass, species order by n desc) as sr from a),
        g as (select *, row_number() over (partition by split, klass, genus_key, sr = 1 order by n desc) as gr from s), d as (select *, case when sr > 1 then 'dup' when gr <= 5 then 'sel' else 'drop' end as d from g)
        select klass as cls, split, case when grouping(split) = 1 then 'class' else 'split_class' end as level, count(*) as inputs, count(distinct species) as species, count(distinct genus_key) as genera, count(*) filter (d = 'dup') as duplicates, count(*) filter (d = 'drop') as dropped, count(*) filter (d = 'sel') as selected, count(*) filter (species_taxid = '') as unresolved
        from d group by grouping sets ((klass), (klass, split))""",
    "j01_versioned_join": f"""select n, case when n % 3 <> 1 then n end as value, case when n % 3 = 1 then null when n % 2 = 0 then 'exact' else 'base' end as match from {G}""",
    "j02_merge_indexes": f"""with g as (select *, split_part(assembly_accession, '.', 1) as b from {G}), o as (select *, n % 3 <> 0 and n % 5 <> 0 as good, n % 34 = 0 as loc from g where n % 4 <> 3), t as (select n, b, case when n % 2 = 0 then assembly_accession else b || '.6' end as acc, case when n % 3 = 0 then 'new' else 'held' end as st, case when n % 7 = 0 then '1' else '0' end as an from g where n % 5 = 0 or n % 4 = 3),
        m as (select o.assembly_accession as accession, klass as training_class, good or loc as available, case when loc then 'organelle_store' when good then 'download_status_ok' else 'not_downloaded' end as availability_reason, case when t.acc is null then 'own' else 'own+other' end as index_source,
          case when t.acc is null then 'own_only' when t.acc = o.assembly_accession then 'exact' else 'other_version' end as accession_match, t.acc as other_accession, t.st as other_status, t.an as other_anchor from o left join t using (b)),
        u as (select * from m union all select acc, 'eukarya', false, 'other_download_deferred', 'other', 'other_only', acc, st, an from t where b not in (select b from o))
        select *, case when available and training_class in ('bacteria', 'eukarya', 'virus') then 'current' when index_source <> 'own' or not available then 'deferred' end as output from u""",
    "j03_merge_plans": f"""with g as (select *, split_part(assembly_accession, '.', 1) as b from {G}), s as (select * from g where n % 3 = 0 or n % 6 = 5), r as (select * from g where (n % 4 = 0 or n % 6 = 5) and (n % 8 = 0 or n % 5 = 0)), one as (select * from s where n % 6 <> 5)
        select assembly_accession as accession, case when n % 2 = 0 then 'selected' else 'selected_other_version' end as plan_source, n * 10 as target_bp from one
        union all select assembly_accession, 'required', null from r where n % 6 <> 5 and n not in (select n from one)
        union all select case when n % 2 = 0 then assembly_accession else b || '.6' end, 'missing:selected', null from s where n % 6 = 5
        union all select b || '.7', case when n % 8 = 0 then 'missing:required_anchor' else 'missing:required' end, null from r where n % 6 = 5""",
    "u04_required_rows": f"""select split_part(assembly_accession, '.', 1) || '.7' as accession, case when n % 8 = 0 then '1' else '0' end as is_anchor, case when n % 5 = 0 then 'New' else 'held' end as status from {G} where (n % 4 = 0 or n % 6 = 5) and (n % 8 = 0 or n % 5 = 0)""",
    "u02_anchors_missing": f"select split_part(assembly_accession, '.', 1) || '.7' as accession from {G} where n % 6 = 5",
    "j04_subset_by_plan": f"with {_SUB} select fragment_id, class as cls, match from fo where outcome in ('kept', 'passthrough')",
    "j04_subset_counts": f"with {_SUB} select outcome, coalesce(match, 'none') as match, mismatch, count(*) as fragments, sum(bp)::bigint as bp from fo group by all",
    "w12_plan_shortfall": f"""with {_SUB}, k as (select pa, sum(case when outcome = 'kept' then bp else 0 end)::bigint as kept_bp, sum(bp)::bigint as available_bp, count(*) filter (outcome = 'kept') as n from fo where class = 'eukarya' and pa is not null group by pa),
        e as (select pa, target_bp from pl union all select 'GCA_X' || i, 5 from range(3) t(i)), j as (select e.pa as plan_accession, target_bp, coalesce(available_bp, 0) as available_bp, coalesce(kept_bp, 0) as kept_bp, coalesce(n, 0) as n from e left join k using (pa)),
        p as (select *, case when n = 0 then 'absent_from_source_corpus' when target_bp > 0 and kept_bp < target_bp then 'shortfall' end as problem from j)
        select plan_accession, problem, target_bp, available_bp, kept_bp, case when problem = 'shortfall' then target_bp - kept_bp end as deficit_bp from p where problem is not null""",
    "u01_flatten_splits": f"select class as cls, count(*) as fragments, min(doc_id) as first from {FR} where split <> 'test' group by class",
    "j05_diff_versions": """with i as (select l_partkey || '.' || l_linenumber as key, l_partkey, row_number() over (partition by l_partkey, l_linenumber order by l_orderkey, l_suppkey) as nth, rank() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey) as bth from lineitem),
        x as (select p_partkey, p_partkey || '.' || (p_size % 7 + 1) as key from part where p_size < 25)
        select key, case when nth > 1 then 'duplicate_in_source' when bth > 1 then 'duplicate_in_source_other_version' when key in (select key from x) then 'already_held' when l_partkey in (select p_partkey from x) then 'already_held_other_version' else 'new' end as status, count(*) as n from i group by all""",
    "j10_accept_hits": "select distinct l_partkey as query from lineitem where l_partkey <> l_suppkey and 0.9::double + l_tax + 1e-12 >= 0.95 and 1 - l_discount + 1e-12 >= 0.95 and 0.8::double + l_quantity / 250 + 1e-12 >= 0.95",
    "j10_hit_report": """with h as (select l_partkey as p_partkey, count(*) as m from lineitem where l_partkey <> l_suppkey and 0.9::double + l_tax + 1e-12 >= 0.95 and 1 - l_discount + 1e-12 >= 0.95 and 0.8::double + l_quantity / 250 + 1e-12 >= 0.95 group by 1)
        select p_brand, count(*) as query_count, coalesce(sum(m), 0)::bigint as accepted_hit_rows, count(m) as removed_count, round((count(*) - count(m)) / count(*), 6) as retention from part left join h using (p_partkey) group by p_brand""",
    "j11_regroup": """with r as (select distinct l_partkey from lineitem where l_partkey <> l_suppkey and 0.9::double + l_tax + 1e-12 >= 0.95 and 1 - l_discount + 1e-12 >= 0.95 and 0.8::double + l_quantity / 250 + 1e-12 >= 0.95), p as (select case when p_partkey % 10 < 8 then 'train' else 'test' end as split, p_brand, p_partkey in (select * from r) as gone from part)
        select split, p_brand, count(*) as rows_in, count(*) filter (not gone) as kept, count(*) filter (gone) as removed, round(count(*) filter (not gone) / count(*), 6) as retention from p group by all""",
    "j12_mag_qc": """with h as (select l_orderkey, arg_max(['a', 'b', 'c'][l_suppkey % 3 + 1], ((0.85::double + l_discount) * (0.4::double + l_quantity / 100), -(l_linenumber * 100000000 + l_partkey * 10000 + l_suppkey))) as k from lineitem where 0.85::double + l_discount >= 0.9 and 0.4::double + l_quantity / 100 >= 0.5 and 0.45::double + l_tax * 5 >= 0.5 group by l_orderkey),
        c as (select o_custkey as mag_id, ['a', 'b', 'c'][o_custkey % 3 + 1] as own, o_orderkey % 5000 + 1000 as len, k from orders left join h on l_orderkey = o_orderkey),
        s as (select mag_id, sum(case when k = own then len else 0 end)::bigint as own_bp, sum(case when k <> own then len else 0 end)::bigint as foreign_bp, sum(case when k is null then len else 0 end)::bigint as unassigned_bp, sum(len)::bigint as bp from c group by mag_id)
        select *, round(coalesce(foreign_bp / nullif(own_bp + foreign_bp, 0), 0), 6) as foreign_share, coalesce(foreign_bp / nullif(own_bp + foreign_bp, 0), 0) >= 0.05 as dropped from s""",
    "j15_taxon_info": f"""with recursive {_INFO} select taxid::bigint as taxid, ok, clade, species::bigint as species, genus_key, genus_name, case when not ok then null when family is not null then 't' || family else genus_key end as family_key, case when not ok then null when family is not null then coalesce(fname, 'taxid:' || family) else genus_name end as family_name from info""",
    "j16_lineage_info": f"""with a as (select n, n % 5 as c, split_part(organism_name, ' ', 1) as o from {G}), b as (select *, case c when 0 then 'Genus' || n when 1 then 'Proteo' when 3 then 'Vertebrata' when 4 then 'Unknown thing' else o end as genus_name, case c when 0 then 'Ascomycota' when 1 then 'Bacteria' when 3 then 'Metazoa' when 4 then 'Unknown thing' else o end as family_name from a)
        select n, c <> 2 as ok, case c when 0 then 'fungi' when 1 then 'bacteria' when 3 then 'metazoa_vertebrate' else 'unknown' end as clade, 's' || lower(genus_name) as genus_key, genus_name, 's' || lower(family_name) as family_key, family_name from b""",
    "j17_resolve_metadata": f"""with recursive {_INFO}, m as (select o_orderkey as k, o_custkey as c, o_orderkey % 31 = 0 as noacc, o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0 as open_, o_custkey + case when o_custkey % 50 = 7 then 900000 else 1000 end as t from orders),
        j as (select m.*, i.ok, case i.clade when 'clade_d' then 'fungi' else i.clade end as cl, i.species from m left join info i on open_ and not noacc and c % 11 <> 0 and i.taxid = t), g as (select *, open_ and not noacc and c % 11 <> 0 and ok and cl in ('clade_a', 'clade_b', 'fungi') as good from j)
        select case when noacc then '' else 'A' || c end || '|' || k as record_id, case when k % 7 = 0 then 'bacteria' else 'eukarya' end as legacy_class, case when good then coalesce(species, t)::varchar else '' end as species_taxid, case when good then cl when k % 5 = 0 then 'fungi' else '' end as euk_group,
        case when not open_ then null when noacc then 'unresolved_no_accession' when c % 11 = 0 then 'unresolved_no_taxid' when not ok then 'unresolved_taxdump' when good then 'resolved_taxdump' else 'unresolved_clade:' || cl end as label_status from g""",
    "j18_resolve_group": f"""with a as (select *, n % 5 as c, case source_group when 'fungi' then 'fungi' when 'plant' then 'land_plant' when 'protozoa' then 'other_protist' when 'invertebrate' then 'metazoa_invertebrate' when 'vertebrate_mammalian' then 'metazoa_vertebrate' end as sg, case lower(supergroup) when 'host-mammalia' then 'metazoa_vertebrate' when 'sar-alveolata' then 'alveolata' when 'opisthokonta-fungi' then 'fungi' end as su from {G})
        select n, case when n % 40 = 0 then 'algae' when n % 6 = 0 then 'fungi' when c = 0 then 'fungi' when c = 3 then 'metazoa_vertebrate' when sg is not null then sg when su is not null then su when n % 3 = 0 then 'algae' end as group,
        case when n % 40 = 0 then 'manual_override' when n % 6 = 0 then 'taxdump' when c in (0, 3) then 'lineage' when sg is not null then 'source_group' when su is not null then 'supergroup' when n % 3 = 0 then 'existing_label' else 'unresolved' end as how from a""",
    "j19_merge_sources": f"""select (n % 400)::varchar as key, arg_min(species_taxid, n) filter (species_taxid <> '') as species_taxid, arg_min(host, n) filter (host <> '') as host, arg_min(contig_n50, n) filter (contig_n50 <> '') as contig_n50, count(*) - 1 as duplicates from {G} where n % 100 <> 0 group by 1""",
    "j25_acc2clade": f"""with recursive {_TREE}, ch as (select id as taxid, id as node, parent from tn union all select ch.taxid, tn.id, tn.parent from ch join tn on tn.id = ch.parent where ch.node <> ch.parent), ti as (select taxid, ['clade_a', 'clade_b', 'clade_c', 'clade_d'][min(case node when 11 then 0 when 12 then 1 when 2 then 2 when 5 then 3 end) + 1] as clade from ch group by taxid)
        select clade, count(*) as headers from orders left join ti on o_custkey % 11 <> 0 and taxid = o_custkey + 1000 group by clade""",
    "a16_completeness": f"""with g as (select *, {_NG} as g from {FR}), r as (select split, g, case when doc_id % 3 = 0 and g <> 'fungi' then g end as c from g where not (g = 'algae' and split = 'validation') and g not in ('alveolata', 'stramenopiles')),
        d as (select unnest(['fungi', 'land_plant', 'algae', 'metazoa_vertebrate', 'metazoa_invertebrate', 'alveolata', 'stramenopiles', 'other_protist']) as e),
        n as (select e as euk_group, (select count(*) from r where c = e) as base_before, (select count(*) from r where g = e) as base_after, (select count(*) from r where g = e and split = 'train') as base_train, (select count(*) from r where g = e and split = 'validation') as base_validation,
          (select count(*) from g where g = e and e in ('algae', 'fungi')) as existing_pool_fragments, (select count(distinct accession) from g where g = e and e in ('alveolata', 'fungi')) as source_genomes from d)
        select *, case when base_train > 0 and base_validation > 0 then case when base_before = 0 then 'label_error_recovered' else 'complete' end when existing_pool_fragments > 0 then 'bp_balance_not_selected' when source_genomes > 0 then 'source_fragments_missing' else 'source_missing' end as diagnosis, base_train = 0 as needs_delta_train, base_validation = 0 as needs_delta_validation from n""",
    "a16_label_actions": f"""with g as (select doc_id, coalesce({_NG}, '') as r from {FR}), c as (select r, case when doc_id % 3 > 0 then case when doc_id % 5 > 0 then r else 'fungi' end else '' end as c from g) select case when r = '' then 'unresolved' when c = '' then 'label_error_missing' when c <> r then 'label_error_wrong' else 'unchanged' end as action, count(*) as records from c group by 1""",
    "j20_organelle_inventory": """with i as (select l_orderkey * 100000000 + l_partkey * 10000 + l_suppkey * 10 + l_linenumber as o, min('P' || l_partkey || '.' || (l_linenumber % 3)) as a, min(l_quantity::bigint) as len from lineitem group by 1), f as (select *, split_part(a, '.', 1) as b, row_number() over (partition by a order by o) as nth from i),
        m as (select 'P' || p_partkey as b, case when p_size % 4 > 0 then p_brand end as t from part where p_size > 5), j as (select f.o, f.a, f.len, f.nth, coalesce(f.b, m.b) as b, m.b is not null as mm, t, f.o is not null as fp from f full join m using (b)),
        k as (select *, coalesce(fp and nth = 1 and len >= 10, false) as ok, coalesce(t, 'ACC:' || coalesce(a, b)) as sp from j), l as (select *, ok and row_number() over (partition by sp, ok order by o) > 20 as ov from k)
        select array_to_string(list_filter([case when nth > 1 then 'DUPLICATE_FASTA_ACCESSION' end, case when len < 10 then 'BELOW_MIN_LENGTH' end, case when ov then 'SPECIES_CAP' end, case when not fp then 'FASTA_NOT_FOUND' end], lambda x: x is not null), ',') as reasons, ok and not ov as selected, mm as metadata_matched, fp as fasta_present, count(*) as rows, sum(len)::bigint as bp from l group by all""",
    "j20_organelle_stats": """with f as (select case when l_partkey % 3 = 0 then 'plastid' else 'mito' end as grp, 'P' || l_partkey as b, 'P' || l_partkey || '.' || (l_linenumber % 3) as a, l_orderkey * 10 + l_linenumber % 3 as o, min(l_quantity)::bigint as len from lineitem where l_partkey % 7 < 5 group by l_partkey, l_orderkey, l_linenumber % 3),
        g as (select *, row_number() over (partition by grp, a order by o) as nth from f), r as (select case when p_partkey % 3 = 0 then 'plastid' else 'mito' end as grp, 'P' || p_partkey as b, case when p_size % 4 > 0 then p_brand end as taxid, case when p_size % 3 > 0 then p_type end as sp, p_name from part where p_size > 5),
        ms as (select grp, count(*) + count(*) filter (length(p_name) % 5 = 0) as gbff_records, count(*) filter (length(p_name) % 5 = 0) as duplicate_gbff_accessions from r group by grp),
        j as (select g.*, r.b is not null as mm, taxid, coalesce(sp, taxid, 'ACC:' || a) as q, nth = 1 and len >= 10 as ok from g left join r using (grp, b)), k as (select *, ok and row_number() over (partition by grp, q, ok order by o) > 20 as ov from j)
        select grp, gbff_records, duplicate_gbff_accessions, count(*) as fasta_records, count(*) filter (nth > 1) as duplicate_fasta_accessions, count(*) filter (mm) as metadata_matched, count(*) filter (not mm) as missing_metadata, count(*) filter (taxid is null) as missing_taxid,
          count(*) filter (len < 10) as below_min_len, count(*) filter (ov) as species_cap_filtered, count(*) filter (ok and not ov) as kept_records, count(distinct taxid) as distinct_taxids from k join ms using (grp) group by all""",
    "j21_organize": f"""with a as (select *, case when n % 3 = 0 then 'evaluation' when n % 11 = 0 then 'other' else 'train' end as split, entity_type = 'organelle' as o from {G} where n % 5 > 0 and n % 7 > 0), b as (select *, o or n % 4 > 0 as done from a where split <> 'other' and (o or n % 13 > 0))
        select entity_id, split, case when done then case when split = 'evaluation' then 'evaluation/' || case when n % 2 = 0 then 'mags' else group_name end else 'raw/' || group_name || '/' || split end || '/' || entity_id || '.fna.gz' end as destination, case when not done then 'missing' end as problem from b""",
    "a33_verify": """with a as (select doc_id, upper(translate(coalesce(text, ''), 'aeiou', 'ACGTN')) as s from documents), b as (select doc_id, length(s) > 0 and length(regexp_replace(s, '[^N]', '', 'g')) / nullif(length(s), 0) <= 0.05 and length(regexp_replace(s, '[ACGTN]', '', 'g')) / nullif(length(s), 0) <= 0.7 as ok from a)
        select doc_id as entity_id, case when doc_id % 5 = 0 then 'missing' else 'fasta_bad' end as problem from b where doc_id % 5 = 0 or not coalesce(ok, false)""",
    "j22_relabel": f"select split, euk_group, count(*) as records from {FR} where class = 'eukarya' group by all",
    "a04_stratum_census": f"""with s as (select *, coalesce({_CLASS}, 'none') as cls, coalesce(try_cast(genome_size as double), 0)::bigint as bp, case lower(supergroup) when 'host-mammalia' then 'metazoa_vertebrate' when 'sar-alveolata' then 'alveolata' when 'opisthokonta-fungi' then 'fungi' end as bs,
          case lower(supergroup) when 'archaeplastida' then 'algae' when 'opisthokonta-metazoa' then 'metazoa_invertebrate' end as am from {G})
        select case when cls = 'eukarya' then 'eukarya/' || coalesce(bs, am, 'eukarya_other') else cls end as stratum, count(*) as records, sum(bp)::bigint as bp, count(*) filter (cls <> 'eukarya') as by_class, count(*) filter (cls = 'eukarya' and bs is not null) as by_supergroup, count(*) filter (cls = 'eukarya' and bs is null and am is not null) as ambiguous, count(*) filter (cls = 'eukarya' and bs is null and am is null) as fallback
        from s group by 1""",
    "a05_clade_coverage": """with w as (select 'src' || i as clade, (1 + i % 3) / 10.0::double as weight from range(8) t(i)), s as (select source as clade, sum(n_chars)::bigint as bp from documents where lang = 'en' and source not in ('src3', 'src5') group by source),
        j as (select clade, weight, coalesce(bp, 0) as bp from w left join s using (clade)) select clade, weight, bp, case when bp = 0 then 'no_data' end as problem, round((select coalesce(sum(weight), 0) from j where bp = 0), 6) as redistributed from j""",
    "a07_audit_labels": f"""with a as (select klass, label, supergroup, {_CLASS} as d from {G}), p as (select klass, label, supergroup, d, count(*) as c from a group by all), w as (select klass, count(*) as k, max(c) as m from p where d is distinct from klass group by klass)
        select a.klass as file_class, count(*) as records, count(*) filter (d is distinct from a.klass) as mismatched, count(*) filter (d is null) as unknown, round(count(*) filter (d is distinct from a.klass) / count(*), 6) as mismatch_rate, least(5, max(k))::int as worst, max(m) as most from a join w on w.klass = a.klass group by a.klass""",
    "a08_repair_matrix": f"""with a as (select klass as f, coalesce({_CLASS}, 'unknown') as t from {G}), c as (select unnest(['bacteria', 'eukarya', 'virus', 'archaea', 'mitochondria', 'plastids', 'fungi', 'unknown']) as x)
        select x as class_name, (select count(*) from a where f = x) as before, (select count(*) from a where t = x) as after, (select count(*) from a where f = x and t <> x) as moved_out, (select count(*) from a where t = x and f <> x) as moved_in, (select count(*) from a where f = x) > 0 and (select count(*) from a where t = x) = 0 as emptied from c""",
    "a15_leakage_union": f"""with f as (select doc_id as record_id, split, species_taxid, split_group_id, duplicate_cluster_id from {FR}), u as (select * from f union all select case when record_id % 2 = 0 then record_id else record_id + 1000000 end, 'train', species_taxid, split_group_id, duplicate_cluster_id from f where record_id % 7 = 0),
        k as (select split, unnest([{{'k': 'species_taxid', 'v': species_taxid}}, {{'k': 'split_group_id', 'v': split_group_id}}, {{'k': 'duplicate_cluster_id', 'v': duplicate_cluster_id}}]) as x from u), p as (select x.k as key, x.v as v, count(distinct split) as c from k where x.v <> '' group by all)
        select key as kind, count(*) filter (c > 1) as problems from p group by key union all select 'record_id', (select count(*) - count(distinct record_id) from u)""",
}
