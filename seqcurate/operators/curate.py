"""Curation of a genome index: merge of sources, quality scores, best of a species, quotas of a genus, budgets of a clade."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import base_accession, clean
from ..functions.scalars import LEVEL_RANK, evidence, number, passes_hard_filter, quality_gates, quality_order, virus_genome_type, virus_qc
from .order import placed
from .select import genus_quota, pick_genus

# Weights of a genome's score.
WEIGHTS = {"log10_n50": 12.0, "refseq": 8.0, "third_generation": 6.0, "reference_category": 4.0, "type_material": 2.0, "assembly_level": 2.0, "qc_score": 1.0}
# Categories of curated genomes.
CURATED = ("reference genome", "representative genome")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def explode_segments(df: DataFrame, segments: str = "segments", taxid: str = "taxid", organism: str = "organism", ordinal: str = "ordinal") -> DataFrame:
    """One row for each segment (separated by ;) of a virus: df's columns, segment_name, sequence_accession, virus_genome_id (of taxid, organism and all segments), is_refseq.

    Of a segment's accessions one with an underscore is taken, else the first; segments without one are left out, and an accession counts once, in the first row that has it."""
    form = r"([A-Z]{1,4}_?[0-9]{4,}(?:\.[0-9]+)?)"
    genome = F.concat(F.lit("VGENOME:"), F.substr(F.sha1(F.concat_ws("\t", _text(taxid), _text(organism), F.col(segments)).cast("binary")), F.lit(1), F.lit(20)))
    rows = df.where(~_text(segments).isin("", "-")).select("*", genome.alias("virus_genome_id"), F.posexplode(F.split(F.trim(segments), r"\s*;\s*")).alias("segment_no", "_token"))
    found = F.regexp_extract_all("_token", F.lit(form), F.lit(1))
    accession = F.coalesce(F.get(F.filter(found, lambda a: F.contains(a, F.lit("_"))), F.lit(0)), F.get(found, F.lit(0)))
    name = F.when(F.contains("_token", F.lit(":")), F.trim(F.substring_index("_token", ":", 1))).otherwise("")
    rows = rows.select("*", accession.alias("sequence_accession"), name.alias("segment_name")).where("sequence_accession is not null").drop("_token")
    first = rows.groupBy("sequence_accession").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "sequence_accession"]), F.struct(ordinal, "segment_no")).alias("_row"))
    out = first.select("sequence_accession", "_row.*")
    return out.withColumn("is_refseq", F.col("sequence_accession").rlike("^N[CG]_"))


def canonicalize_pairs(df: DataFrame, accession: str = "assembly_accession", paired: str = "paired_accession", comparison: str = "paired_comparison", entity: str = "entity_type") -> DataFrame:
    """df without the GCA side of a pair that is marked identical, if both sides are there. Other entities stay, whatever their accession."""
    have = df.where(_text(accession) != "").select(F.col(accession).alias("_have")).distinct()
    pairs = df.where((F.col(comparison) == "identical") & (_text(paired) != "") & (_text(accession) != "")).select(F.col(accession).alias("_a"), F.col(paired).alias("_b"))
    both = pairs.join(have, F.col("_b") == F.col("_have"), "left_semi")
    lost = both.select(F.when(F.startswith("_a", F.lit("GCA_")), F.col("_a")).otherwise(F.col("_b")).alias(accession)).distinct()
    stays = _text(entity) != "assembly"
    return df.where(~stays).join(lost, accession, "left_anti").select(*df.columns).unionByName(df.where(stays))


def build_index(sources: DataFrame, mag: Column, mag_policy: str = "test_only", before: str | None = None, after: str | None = None) -> DataFrame:
    """sources: rows of all tables with `priority` (of the source) and `ordinal`. Adds mag_evidence, dataset_role and status of each row: mag_excluded, hard_filtered, duplicate or kept.

    Of rows that pass, one counts per entity_id, the first by priority and ordinal; of portal rows (source jgi) none counts whose accession, in any version, or whose paired
    accession an earlier kept row has. With mag_policy test_only, rows with MAG evidence are for tests only; with exclude they are left out."""
    order = F.struct("priority", "ordinal")
    df = sources.withColumn("mag_evidence", mag)
    ok = passes_hard_filter(F.col("mag_evidence"), before, after, exclude_mag=mag_policy == "exclude")
    status = F.when(F.col("mag_evidence").isNotNull() & (mag_policy == "exclude"), "mag_excluded").when(~ok, "hard_filtered")
    df = df.withColumn("_status", status)
    if mag_policy == "test_only":
        df = df.withColumn("dataset_role", F.when(F.col("mag_evidence").isNotNull(), "test_only").otherwise(F.col("dataset_role")))
    portal = F.col("source") == "jgi"
    key = F.when(portal & (_text("assembly_accession") != ""), F.col("assembly_accession")).otherwise(F.col("entity_id"))
    passing = df.where("_status is null").withColumn("_key", key)
    first = passing.groupBy("_key").agg(F.min(order).alias("_first"))
    base = F.when(_text("assembly_accession") != "", base_accession(F.col("assembly_accession"), "last"))
    held = passing.withColumn("_base", base).where(~portal)
    bases = held.where("_base is not null").select(F.col("_base")).distinct().withColumn("_held", F.lit(True))
    ids = held.select(F.col("entity_id").alias("_paired")).distinct().withColumn("_has_pair", F.lit(True))
    portal_first = passing.where(portal).withColumn("_base", base).where("_base is not null").groupBy("_base").agg(F.min(order).alias("_portal_first"))
    judged = passing.withColumn("_base", base).join(first, "_key").join(bases, "_base", "left").join(portal_first, "_base", "left").join(ids, F.col("paired_accession") == F.col("_paired"), "left")
    twice = (order > F.col("_first")) | (portal & (F.coalesce("_held", F.lit(False)) | F.coalesce("_has_pair", F.lit(False)) | F.coalesce(order > F.col("_portal_first"), F.lit(False))))
    columns = [c for c in df.columns if c != "_status"]
    out = judged.select(*columns, F.when(twice, "duplicate").otherwise("kept").alias("status"))
    return out.unionByName(df.where("_status is not null").select(*columns, F.col("_status").alias("status")))


def inventory(judged: DataFrame) -> DataFrame:
    """judged: rows of build_index(). Per source and group: rows parsed, filtered, duplicate, kept, with MAG evidence and without, and distinct species.

    Rows left out for their MAG evidence are filtered rows, too, so mag_excluded is a part of hard_filtered."""
    n = lambda test: F.count(F.when(test, 1))
    status, mag = F.col("status"), F.col("mag_evidence").isNotNull()
    species = F.when(_text("species_taxid") != "", F.col("species_taxid"))
    return judged.groupBy("source", "group_name").agg(F.count(F.lit(1)).alias("parsed"), n(status.isin("hard_filtered", "mag_excluded")).alias("hard_filtered"), n(status == "duplicate").alias("duplicates"), n(status == "kept").alias("kept"), n(mag).alias("mag"), n(~mag).alias("non_mag"), n(status == "mag_excluded").alias("mag_excluded"), F.countDistinct(species).alias("species"))


def _optional(df: DataFrame, name: str) -> Column:
    """The text of a column, empty where it is null or df lacks it."""
    return _text(name) if name in df.columns else F.lit("")


def _with_reports(df: DataFrame, reports: Mapping[str, DataFrame]) -> DataFrame:
    """df with a column for each value of the reports (see apply_qc), null where a report lacks the row or is not given."""
    for name in ("type_mismatch", "synonym", "type_strain", "reference"):
        if name in reports:
            seen = reports[name].select(F.col("accession").alias("assembly_accession")).distinct().withColumn(f"_{name}", F.lit(True))
            df = df.join(seen, "assembly_accession", "left")
        else:
            df = df.withColumn(f"_{name}", F.lit(None).cast("boolean"))
    tables = {
        "contamination": ("accession", "assembly_accession", {"fraction": "double"}),
        "size_range": ("species_taxid", "species_taxid", {"lo": "double", "hi": "double"}),
        "ani_group": ("species_taxid", "species_taxid", {"ani_group": "string"}),
    }
    for name, (theirs, ours, values) in tables.items():
        if name in reports:
            one = reports[name].groupBy(F.col(theirs).alias(ours)).agg(F.max(F.struct(*values)).alias("_v"))
            df = df.join(one.select(ours, *(F.col(f"_v.{v}").alias(f"_{v}") for v in values)), ours, "left")
        else:
            df = df.withColumns({f"_{v}": F.lit(None).cast(kind) for v, kind in values.items()})
    return df


def _filled(df: DataFrame, features: DataFrame | None) -> DataFrame:
    """df with contig_n50, scaffold_n50 and sequencing_technology of the features (accession, and these) where its own are empty."""
    names = ("contig_n50", "scaffold_n50", "sequencing_technology")
    if features is None:
        return df
    one = features.groupBy(F.col("accession").alias("assembly_accession")).agg(F.max(F.struct(*(F.col(c).cast("string").alias(c) for c in names))).alias("_f"))
    filled = {c: F.when(_optional(df, c) != "", _optional(df, c)).otherwise(F.coalesce(f"_f.{c}", F.lit(""))) for c in names}
    return df.join(one, "assembly_accession", "left").withColumns(filled).drop("_f")


def apply_qc(master: DataFrame, reports: Mapping[str, DataFrame], max_contamination: float = 0.05, low_ratio: float = 0.5, high_ratio: float = 2.0, features: DataFrame | None = None, virus: Mapping = {}) -> DataFrame:  # noqa: B006
    """master with n50_value, n50_metric, qc_status (accepted, quarantine or rejected), score, flags and split_group_id, by entity_type.

    reports, each optional: type_mismatch, synonym, type_strain, reference (accession); contamination (accession, fraction); size_range (species_taxid, lo, hi); ani_group (species_taxid,
    ani_group). They are made unique by key, and joined. features (accession, contig_n50, scaffold_n50, sequencing_technology) fill what master lacks. N50: of contigs, else of scaffolds, else missing.

    Assemblies: log10(N50 + 1), 8 at most; 2 for the curated source and 2 for third-generation reads; 3 for a complete genome or chromosome, -1 and -2 for scaffolds and contigs; 3 for a
    curated category, 3 for a reference, 2 for type material; less ten times the contamination, 3 at most; less 1 if excluded. Any flag puts them in quarantine. The size is the ungapped one if that
    is given at all. The split group is the species' ANI group, else the species, else the entity.
    Organelles are accepted with a score of 5. Virus sequences (virus_sequence) are rejected if their metadata fail (see virus_qc; virus has its parameters), and score 5, 4 more if curated (is_refseq_viral),
    1 for a host and 1 for a known genome type. Their groups are the virus genome, else the species, else the entity, those of organelles the species, else the entity."""
    columns = [*master.columns, *(c for c in ("contig_n50", "scaffold_n50", "sequencing_technology") if features is not None and c not in master.columns)]
    df = _with_reports(_filled(master, features), reports)
    contig, scaffold = number(_optional(df, "contig_n50"), 0.0), number(_optional(df, "scaffold_n50"), 0.0)
    n50 = F.when(contig > 0, contig).when(scaffold > 0, scaffold)
    metric = F.when(contig > 0, "contig_n50").when(scaffold > 0, "scaffold_n50").otherwise("missing")
    given = F.when(_optional(df, "genome_size_ungapped") != "", _optional(df, "genome_size_ungapped")).otherwise(_optional(df, "genome_size"))
    size = F.nullif(number(given, 0.0), F.lit(0.0))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    tests = [
        (yes("_type_mismatch"), "TYPE_NOT_MATCHING"),
        (yes("_synonym"), "SUSPECT_SYNONYM"),
        (F.col("_fraction") >= max_contamination, "CONTAMINATION"),
        (size < F.col("_lo") * low_ratio, "SIZE_BELOW_RANGE"),
        ((size >= F.col("_lo") * low_ratio) & (size > F.col("_hi") * high_ratio), "SIZE_ABOVE_RANGE"),
    ]
    flags = F.filter(F.array(*(F.when(F.coalesce(t, F.lit(False)), n) for t, n in tests)), lambda x: x.isNotNull())
    points = lambda test, n: F.when(F.coalesce(test, F.lit(False)), float(n)).otherwise(0.0)
    level, species = F.lower(_optional(df, "assembly_level")), _optional(df, "species_taxid")
    score = F.when(n50.isNotNull(), F.least(F.log10(n50 + 1), F.lit(8.0))).otherwise(0.0)
    score += points(F.col("source") == "refseq", 2)
    score += points(evidence(_optional(df, "sequencing_technology"), "third_generation").isNotNull(), 2)
    score += F.when(level.isin("complete genome", "chromosome"), 3.0).when(level == "scaffold", -1.0).when(level == "contig", -2.0).otherwise(0.0)
    score += points(_optional(df, "refseq_category").isin(*CURATED), 3) + points(yes("_reference"), 3)
    score += points(yes("_type_strain") | (_optional(df, "relation_to_type_material") != ""), 2)
    score -= F.when(F.col("_fraction").isNotNull(), F.least(F.col("_fraction") * 10, F.lit(3.0))).otherwise(0.0)
    score -= points(_optional(df, "excluded_from_refseq") != "", 1)
    entity, own = _optional(df, "entity_type"), F.when(species != "", species)
    organelle, is_virus = entity == "organelle", entity == "virus_sequence"
    names = ("sequence_accession", "taxid", "download_url", "virus_group", "virus_reported_genome_length")
    checked = virus_qc(*(_optional(df, c) for c in names), **virus)
    virus_score = F.lit(5.0) + points(F.lower(_optional(df, "is_refseq_viral")).isin("1", "true"), 4) + points(_optional(df, "host") != "", 1) + points(checked["genome_type"] != "unknown", 1)
    group = F.coalesce("_ani_group", F.concat(F.lit("SP_"), own), "entity_id")
    genome = F.when(_optional(df, "virus_genome_id") != "", _optional(df, "virus_genome_id"))
    by_kind = lambda of_organelle, of_virus, other: F.when(organelle, of_organelle).when(is_virus, of_virus).otherwise(other)
    found = {
        "n50_value": F.floor(n50).cast("long"),
        "n50_metric": metric,
        "qc_status": by_kind(F.lit("accepted"), F.when(F.size(checked["flags"]) > 0, "rejected").otherwise("accepted"), F.when(F.size(flags) > 0, "quarantine").otherwise("accepted")),
        "score": by_kind(F.lit(5.0), virus_score, score),
        "flags": by_kind(F.array().cast("array<string>"), checked["flags"], flags),
        "split_group_id": by_kind(F.coalesce(own, "entity_id"), F.coalesce(genome, own, "entity_id"), group),
    }
    return df.select(*columns, *(v.alias(k) for k, v in found.items()))


def species_key() -> Column:
    """Of species, else taxon, else name, else entity."""
    name = F.lower(F.trim(_text("organism_name")))
    return F.when(_text("species_taxid") != "", F.concat(F.lit("SP:"), "species_taxid")).when(_text("taxid") != "", F.concat(F.lit("TX:"), "taxid")).when(name != "", F.concat(F.lit("NAME:"), name)).otherwise(F.concat(F.lit("ENTITY:"), "entity_id"))


def select_species(df: DataFrame, weights: Mapping[str, float] = WEIGHTS, best: int = 1) -> DataFrame:
    """df (with n50_value, score as qc_score, mag_evidence, non_isolate, dataset_role, klass, entity_type) with partition, species_key, selection_score, rank, selected and reason.

    Partitions: isolates to train, MAGs and virus assemblies to test: of each species the `best` rows by score, N50, source, reads and accession. Rows for tests only and rows that are no
    assemblies pass; those with evidence of no isolate are excluded."""
    n50 = F.coalesce(F.col("n50_value").cast("double"), F.lit(0.0))
    refseq = ((F.col("source") == "refseq") | F.startswith(_text("assembly_accession"), F.lit("GCF_"))).cast("int")
    third = evidence(F.col("sequencing_technology"), "third_generation").isNotNull().cast("int")
    category = F.coalesce(F.col("refseq_category").isin(*CURATED), F.lit(False)).cast("int")
    material = (_text("relation_to_type_material") != "").cast("int")
    level = F.coalesce(4 - F.element_at(F.create_map(*(F.lit(x) for kv in LEVEL_RANK.items() for x in kv)), F.lower(_text("assembly_level"))), F.lit(0))
    parts = {"log10_n50": F.when(n50 > 0, F.log10(n50 + 1)).otherwise(0.0), "refseq": refseq, "third_generation": third, "reference_category": category, "type_material": material, "assembly_level": level, "qc_score": F.coalesce(F.col("qc_score"), F.lit(0.0))}
    total = sum((F.lit(weights[k]) * v for k, v in parts.items()), F.lit(0.0))
    assembly = _text("entity_type") == "assembly"
    partition = F.when(_text("entity_type") == "virus_sequence", "virus_sequence").when(~assembly, F.when(F.col("dataset_role") == "test_only", "passthrough_evaluation").otherwise("passthrough_train")).when(F.col("klass") == "virus", "virus_assembly_test")
    partition = partition.when(F.col("mag_evidence").isNotNull(), "mag_evaluation").when(F.col("dataset_role") == "test_only", "passthrough_evaluation").when(F.col("non_isolate").isNotNull(), "excluded_non_isolate").otherwise("train_isolate")
    df = df.withColumns({"partition": partition, "species_key": species_key(), "selection_score": total, "_third": third, "_refseq": refseq, "_n50": n50})
    ranked = F.col("partition").isin("train_isolate", "mag_evaluation", "virus_assembly_test")
    order = [F.desc("selection_score"), F.desc("_n50"), F.desc("_refseq"), F.desc("_third"), F.desc(F.coalesce(clean(F.col("assembly_accession")), F.col("entity_id"))), F.col("entity_id")]
    rank = F.row_number().over(Window.partitionBy("partition", "species_key").orderBy(*order))
    chosen = df.where(ranked).withColumn("rank", rank)
    keep = F.col("rank") <= best
    reason = F.concat(F.when(keep, "SELECTED_BEST_PER_SPECIES").otherwise("LOWER_RANK_SAME_SPECIES"), F.when(F.col("_n50") == 0, ";MISSING_N50").otherwise(""), F.when(_text("sequencing_technology") == "", ";UNKNOWN_TECH").otherwise(""))
    chosen = chosen.withColumns({"selected": keep, "reason": reason})
    passed = df.where(~ranked).withColumns({"rank": F.lit(None).cast("int"), "selected": F.col("partition") != "excluded_non_isolate", "reason": F.when(F.col("partition") == "excluded_non_isolate", F.concat(F.lit("NON_ISOLATE_EVIDENCE:"), "non_isolate")).otherwise("PASSTHROUGH")})
    return chosen.unionByName(passed).drop("_third", "_refseq", "_n50")


def select_viruses(segments: DataFrame, genomes: int = 0, one_per_species: bool = True) -> tuple[DataFrame, DataFrame]:
    """segments: virus_genome_id, species_key, qc_score, is_refseq boolean, host, virus_reported_genome_length, virus_group, segment_no. Returns (segments of the chosen genomes, audit).

    Segments are added up to genomes; a genome's score is its best segment's, 4 more if any is curated, 1 for a host and log10(length + 1), 7 at most. The best genome of a species is chosen;
    of the chosen ones, with `genomes`, so many at most. A chosen genome keeps all its segments."""
    length = F.max(number(F.col("virus_reported_genome_length"), 0.0))
    curated, host = F.count(F.when(F.col("is_refseq"), 1)), F.max((_text("host") != "").cast("int"))
    first = lambda c: F.min_by(c, "segment_no").alias(c)
    score = F.max("qc_score") + F.when(curated > 0, 4.0).otherwise(0.0) + host + F.least(F.log10(length + 1), F.lit(7.0))
    per = segments.groupBy("virus_genome_id").agg(first("species_key"), first("virus_group"), F.count(F.lit(1)).alias("segments"), curated.alias("curated"), host.alias("host_known"), F.floor(length).cast("long").alias("length"), score.alias("score"))
    order = [F.desc("score"), F.desc("curated"), F.desc("length"), F.desc("virus_genome_id")]
    audit = per.withColumn("rank", F.row_number().over(Window.partitionBy("species_key").orderBy(*order))).withColumn("genome_type", virus_genome_type(F.col("virus_group")))
    audit = audit.withColumn("selected", (F.col("rank") == 1) | F.lit(not one_per_species))
    audit = audit.withColumn("reason", F.when(F.col("selected"), "SELECTED_BEST_PER_SPECIES").otherwise("LOWER_RANK_SAME_SPECIES"))
    if genomes:
        top = audit.where("selected").orderBy(*order).limit(genomes).select("virus_genome_id", F.lit(True).alias("_top"))
        audit = audit.join(top, "virus_genome_id", "left").withColumn("reason", F.when(F.col("selected") & F.col("_top").isNull(), "GLOBAL_GENOME_CAP").otherwise(F.col("reason")))
        audit = audit.withColumn("selected", F.col("selected") & F.col("_top").isNotNull()).drop("_top")
    return segments.join(audit.where("selected").select("virus_genome_id"), "virus_genome_id", "left_semi"), audit


def clade_budget(clades: DataFrame, total_fragments: int, class_share: float, mean_bp: float = 4200.0, min_bp: float = 5_000_000.0) -> DataFrame:
    """clades: (clade, share). Adds fragments, bp and capacity: the class's part of all fragments divided by share, in base pairs, and how many genomes that pays for at least (one if
    there is any)."""
    whole = F.coalesce(F.nullif(F.sum("share").over(Window.partitionBy(F.lit(0))), F.lit(0.0)), F.lit(1.0))
    fragments = F.lit(float(total_fragments) * class_share) * F.col("share") / whole
    bp = F.floor(fragments * mean_bp).cast("long")
    capacity = F.when((bp > 0) & (F.lit(min_bp) > 0), F.greatest(F.lit(1), F.floor(bp / min_bp))).otherwise(0).cast("long")
    return clades.select("clade", "share", F.floor(fragments).cast("long").alias("fragments"), bp.alias("bp"), capacity.alias("capacity"))


def bp_per_genome(clade_bp: Column, genomes: Column, size: Column, min_bp: float = 5_000_000.0, max_bp: float = 50_000_000.0, fraction: float = 0.8) -> Column:
    """A genome's base pairs: the clade's over its genomes, between min_bp and max_bp, at most a fraction of the genome's size, if that is known."""
    share = F.greatest(F.lit(min_bp), F.least(clade_bp / genomes, F.lit(max_bp)))
    return F.floor(F.when(size > 0, F.least(share, size * fraction)).otherwise(share)).cast("long")


def gated(df: DataFrame, gates: Mapping, anchors: DataFrame | None = None, accession: str = "assembly_accession") -> DataFrame:
    """df with reasons (why the quality gates fail a row; see quality_gates), anchor and eligible. anchors: (accession); matched without version, and eligible in any case."""
    df = df.withColumn("reasons", quality_gates(**gates))
    if anchors is None:
        return df.withColumn("anchor", F.lit(False)).withColumn("eligible", F.size("reasons") == 0)
    asked = anchors.select(F.substring_index("accession", ".", 1).alias("_anchor")).distinct()
    joined = df.join(F.broadcast(asked), F.substring_index(accession, ".", 1) == F.col("_anchor"), "left")
    return joined.withColumn("anchor", F.col("_anchor").isNotNull()).drop("_anchor").withColumn("eligible", (F.size("reasons") == 0) | F.col("anchor"))


def _picked(df: DataFrame, quota: Mapping) -> DataFrame:
    good = df.where("eligible")
    measured = good.select("genus_key", "species_taxid", "taxid", number(F.col("genome_size"), 0.0).alias("size"), number(F.col("gc_percent"), -1.0).alias("gc"))
    return pick_genus(good, genus_quota(measured, "genus_key", ("species_taxid", "taxid"), "size", "gc", **quota), "genus_key", quality_order(), F.col("anchor"))


def select_balanced(df: DataFrame, budget: DataFrame, gates: Mapping, quota: Mapping = {}, anchors: DataFrame | None = None, mean_bp: float = 4200.0) -> DataFrame:  # noqa: B006
    """The genomes of a budgeted selection with target_bp and target_fragments. df: genomes with clade, genus_key, family and the columns of the gates and of quality_order;
    budget: see clade_budget.

    Gates, anchors passing; of each genus the best up to its quota; of a clade that has more genomes than its capacity, the anchors and a round robin over families of the
    others, best genus ranks first; base pairs of each genome by the clade's budget."""
    picked = _picked(gated(df, gates, anchors), quota).join(F.broadcast(budget.select("clade", "bp", "capacity")), "clade", "left").na.fill(0, ["bp", "capacity"])
    clade = Window.partitionBy("clade")
    picked = picked.withColumn("_n", F.count(F.lit(1)).over(clade)).withColumn("_anchors", F.count(F.when(F.col("anchor"), 1)).over(clade))
    crowded = (F.col("capacity") > 0) & (F.col("_n") > F.col("capacity"))
    order = [F.col("genus_rank"), *quality_order()]
    others = picked.where(crowded & ~F.col("anchor"))
    others = others.withColumn("_turn", F.row_number().over(Window.partitionBy("clade", "family").orderBy(*order)))
    best = placed(others.where("_turn = 1"), order, "_family_no", ["clade"]).select("clade", "family", "_family_no")
    taken = placed(others.join(best, ["clade", "family"]), [F.col("_turn"), F.col("_family_no")], "_place", ["clade"]).where(F.col("_place") <= F.greatest(F.lit(0), F.col("capacity") - F.col("_anchors")))
    out = picked.where(~crowded | F.col("anchor")).unionByName(taken.select(*picked.columns))
    out = out.withColumn("_n", F.count(F.lit(1)).over(clade))
    target = bp_per_genome(F.col("bp"), F.col("_n"), number(F.col("genome_size"), 0.0))
    return out.withColumn("target_bp", target).withColumn("target_fragments", F.floor(F.col("target_bp") / mean_bp).cast("long")).drop("_n", "_anchors", "bp", "capacity", "reasons", "eligible")


def clade_report(df: DataFrame, selected: DataFrame, budget: DataFrame, gates: Mapping, quota: Mapping = {}, anchors: DataFrame | None = None) -> DataFrame:  # noqa: B006
    """A row for each clade that has an eligible genome: genera_available, genomes_eligible, genomes_selected, genomes_dropped_for_depth (picked, but over the clade's capacity), budget_fragments, budget_bp, bp_per_genome (by the
    budget alone), planned_bp and anchors. The first and the last three parameters are those of select_balanced, `selected` is what it returned."""
    judged = gated(df, gates, anchors)
    have = judged.where("eligible").groupBy("clade").agg(F.countDistinct("genus_key").alias("genera_available"), F.count(F.lit(1)).alias("genomes_eligible"))
    picked = _picked(judged, quota).groupBy("clade").agg(F.count(F.lit(1)).alias("_picked"))
    sums = selected.groupBy("clade").agg(F.count(F.lit(1)).alias("genomes_selected"), F.sum("target_bp").alias("planned_bp"), F.count_if("anchor").alias("anchors"))
    limits = F.broadcast(budget.select("clade", F.col("fragments").alias("budget_fragments"), F.col("bp").alias("budget_bp")))
    out = have.join(picked, "clade").join(sums, "clade", "left").join(limits, "clade", "left")
    out = out.na.fill(0, ["genomes_selected", "planned_bp", "anchors", "budget_fragments", "budget_bp"])
    each = F.when(F.col("genomes_selected") > 0, bp_per_genome(F.col("budget_bp"), F.col("genomes_selected"), F.lit(0.0))).otherwise(0)
    dropped = (F.col("_picked") - F.col("genomes_selected")).alias("genomes_dropped_for_depth")
    return out.select("clade", "genera_available", "genomes_eligible", "genomes_selected", dropped, "budget_fragments", "budget_bp", each.alias("bp_per_genome"), "planned_bp", "anchors")


def select_breadth(df: DataFrame, gates: Mapping, quota: Mapping = {}, anchors: DataFrame | None = None, clades: Sequence[str] | None = None, max_bp: float = 50_000_000.0, fraction: float = 0.8, mean_bp: float = 4200.0) -> DataFrame:  # noqa: B006
    """The genomes of a selection in which every genus counts, without a budget: up to its quota, each with at most max_bp (0: none) and a fraction of its size."""
    picked = _picked(gated(df, gates, anchors), quota)
    if clades:
        picked = picked.where(F.col("clade").isin(*clades))
    size = number(F.col("genome_size"), 0.0)
    bp = F.lit(max_bp) if max_bp > 0 else size * fraction
    target = F.floor(F.when(size > 0, F.least(bp, size * fraction)).otherwise(bp)).cast("long")
    return picked.withColumn("target_bp", target).withColumn("target_fragments", F.floor(F.col("target_bp") / mean_bp).cast("long")).drop("reasons", "eligible")


def balance_report(decisions: DataFrame, cls: str = "class", split: str = "split", species: str = "species", genus: str = "genus", unresolved: str = "unresolved") -> DataFrame:
    """Per class, and per split and class: rows, distinct species and genera, duplicates, rows over the cap, selected, unresolved. level: class or split_class."""
    n = lambda test: F.count(F.when(test, 1))
    d = F.col("decision")
    out = decisions.select(F.col(cls).alias("class"), F.col(split).alias("split"), species, genus, unresolved, "decision").groupingSets([["class"], ["class", "split"]], "class", "split")
    return out.agg(F.when(F.grouping("split") == 1, "class").otherwise("split_class").alias("level"), F.count(F.lit(1)).alias("inputs"), F.countDistinct(species).alias("species"), F.countDistinct(genus).alias("genera"), n(d == "duplicate_within_species").alias("duplicates"), n(d == "dropped_by_genus_cap").alias("dropped"), n(d == "selected").alias("selected"), n(F.col(unresolved)).alias("unresolved"))

