"""Plans: merged indexes and plans, subsets of a corpus by plan, downloads, placement, metadata joins with reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import base_accession
from ..functions.scalars import number
from .order import kept as made_once
from .select import versioned_join

# Results of a download that count as done.
DONE = ("ok", "cached", "cached_no_md5")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def merge_indexes(own: DataFrame, other: DataFrame, status: DataFrame, local_organelles: DataFrame, classes: Sequence[str]) -> DataFrame:
    """The union of two indexes. own, other: accession, training_class, ordinal and more (own: entity_type; other: status, is_anchor); status: accession, result;
    local_organelles: accession.

    Adds index_source (own, other or own+other), accession_match, available, availability_reason, other_accession and output: current (available, of a known
    class), deferred (not available, or known from the other index) or neither. Own rows are available if a download of theirs, in any version, is done, organelles also if they are there;
    a row of the other index upgrades the own row with its accession, else the first of another version; those that match none are appended, deferred."""
    good = status.where(F.lower(_text("result")).isin(*DONE)).select(base_accession(F.col("accession"), "last").alias("_base")).distinct().withColumn("_good", F.lit(True))
    there = local_organelles.select("accession").distinct().withColumn("_there", F.lit(True))
    rows = own.where(_text("accession") != "").withColumn("_base", base_accession(F.col("accession"), "last")).join(good, "_base", "left").join(there, "accession", "left")
    organelle = (F.lower(_text("entity_type")) == "organelle") & F.coalesce("_there", F.lit(False))
    done = F.coalesce("_good", F.lit(False))
    rows = rows.withColumn("available", organelle | done).withColumn("availability_reason", F.when(organelle, "organelle_store").when(done, "download_status_ok").otherwise("not_downloaded"))
    theirs = other.where(_text("accession") != "").select(F.col("accession").alias("other_accession"), F.col("status").alias("other_status"), F.col("is_anchor").alias("other_anchor"), F.col("training_class").alias("other_class"), F.col("ordinal").alias("other_ordinal"))
    exact = own.groupBy("accession").agg(F.min("ordinal").alias("_e"))
    base = own.groupBy(base_accession(F.col("accession"), "last").alias("_b")).agg(F.min_by("accession", "ordinal").alias("_of_base"))
    theirs = theirs.join(exact, theirs["other_accession"] == exact["accession"], "left").join(base, base_accession(F.col("other_accession"), "last") == F.col("_b"), "left")
    theirs = theirs.withColumn("_hit", F.when(F.col("_e").isNotNull(), F.col("other_accession")).otherwise(F.col("_of_base"))).withColumn("_how", F.when(F.col("_e").isNotNull(), "exact").when(F.col("_of_base").isNotNull(), "other_version"))
    last = theirs.where("_hit is not null").groupBy("_hit").agg(F.max_by(F.struct("other_accession", "other_status", "other_anchor", "_how"), "other_ordinal").alias("_t"))
    hit = rows.join(last, rows["accession"] == last["_hit"], "left")
    mine = hit.select("accession", "training_class", "available", "availability_reason", F.when(F.col("_t").isNull(), "own").otherwise("own+other").alias("index_source"), F.coalesce("_t._how", F.lit("own_only")).alias("accession_match"), F.col("_t.other_accession").alias("other_accession"), F.col("_t.other_status").alias("other_status"), F.col("_t.other_anchor").alias("other_anchor"))
    first = theirs.where("_hit is null").groupBy("other_accession").agg(F.min_by(F.struct("other_status", "other_anchor", "other_class"), "other_ordinal").alias("_t"))
    new = first.select(F.col("other_accession").alias("accession"), F.col("_t.other_class").alias("training_class"), F.lit(False).alias("available"), F.lit("other_download_deferred").alias("availability_reason"), F.lit("other").alias("index_source"), F.lit("other_only").alias("accession_match"), "other_accession", F.col("_t.other_status").alias("other_status"), F.col("_t.other_anchor").alias("other_anchor"))
    out = mine.unionByName(new)
    current = F.col("available") & F.col("training_class").isin(*classes)
    return out.withColumn("output", F.when(current, "current").when((F.col("index_source") != "own") | ~F.col("available"), "deferred"))


def required_rows(df: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Rows that are anchors, or of a status in the list."""
    return df.where((F.trim(_text("is_anchor")) == "1") | F.lower(F.trim(_text("status"))).isin(*(s.strip().lower() for s in statuses if s.strip())))


def anchors_missing(anchors: DataFrame, chosen: DataFrame) -> DataFrame:
    """Anchors (accession) of which no version is among the chosen accessions."""
    have = chosen.select(base_accession(F.col("accession")).alias("_base")).distinct()
    return anchors.select("accession").distinct().withColumn("_base", base_accession(F.col("accession"))).join(have, "_base", "left_anti").select("accession")


def merge_plans(manifest: DataFrame, selection: DataFrame, required: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(plan, missing). manifest: accession, ordinal, ...; selection: accession, target_bp, ordinal; required: accession, is_anchor, status, ordinal.

    The selection comes first: a row of the plan for each of its rows that the manifest has, with the accession or else another version (plan_source selected or
    selected_other_version). Then the required rows of which the plan has no version yet, each manifest row once (required). missing: accession, required_by, reason."""
    values = [F.col("accession").alias("_m"), F.col("ordinal").alias("_o")]
    listed = manifest.where(_text("accession") != "").select("accession", *values)
    find = lambda df: versioned_join(df, listed.select("accession", "_m", "_o"), "accession", ["_m", "_o"], "_o", "first")
    chosen = find(selection.where(_text("accession") != "").select("accession", "target_bp"))
    one = chosen.where("match is not null").select(F.col("_m").alias("manifest_accession"), F.col("_o").alias("manifest_ordinal"), "target_bp", F.when(F.col("match") == "exact", "selected").otherwise("selected_other_version").alias("plan_source"), F.lit(None).cast("string").alias("status"))
    have = one.select(base_accession(F.col("manifest_accession")).alias("_base")).distinct()
    wanted = required.where(_text("accession") != "").withColumn("_base", base_accession(F.col("accession"))).join(have, "_base", "left_anti")
    first = wanted.groupBy("_base").agg(F.min_by(F.struct("accession", "is_anchor", "status"), "ordinal").alias("_r"))
    asked = find(first.select("_r.*"))
    two = asked.where("match is not null").select(F.col("_m").alias("manifest_accession"), F.col("_o").alias("manifest_ordinal"), F.lit(None).cast("long").alias("target_bp"), F.lit("required").alias("plan_source"), "status")
    gone = find(wanted.select("accession", "is_anchor")).where("match is null").select("accession", F.when(F.trim(_text("is_anchor")) == "1", "required_anchor").otherwise("required").alias("required_by"))
    missing = chosen.where("match is null").select("accession", F.lit("selected").alias("required_by")).unionByName(gone).withColumn("reason", F.lit("NOT_IN_DOWNLOAD_MANIFEST"))
    return one.unionByName(two), missing


def subset_by_plan(frags: DataFrame, plan: DataFrame, planned: Sequence[str], known: Sequence[str], policy: str = "header", capped: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, missing, counts). frags: fragment_id, accession, class_hint (of its file), class (of its header), bp, ordinal; plan: accession, target_bp, ordinal.

    A fragment's class is its header's; where a known file class differs, policy `header` takes the header's, `hint` the file's and `fail` is an error; no class is an error. Of planned
    classes only fragments of planned accessions (in any version) are kept, while the base pairs before them, of the same plan row, are under its target; others pass.
    missing: plan rows with problem absent_from_source_corpus or shortfall (deficit_bp); counts: fragments by what became of them."""
    mismatch = F.col("class_hint").isin(*known) & (F.col("class") != F.col("class_hint"))
    cls = F.col("class")
    if policy == "hint":
        cls = F.when(mismatch, F.col("class_hint")).otherwise(cls)
    elif policy == "fail":
        cls = F.when(mismatch, F.raise_error(F.concat(F.lit("class mismatch: "), F.col("fragment_id").cast("string"))).cast("string")).otherwise(cls)
    elif policy != "header":
        raise ValueError(f"unknown policy: {policy}")
    cls = F.when(F.col("class").isNull(), F.raise_error(F.concat(F.lit("no class: "), F.col("fragment_id").cast("string"))).cast("string")).otherwise(cls)
    rows = frags.withColumn("mismatch", F.coalesce(mismatch, F.lit(False))).withColumn("final_class", cls)
    entries = plan.where(_text("accession") != "").select("accession", F.col("accession").alias("plan_accession"), "target_bp", "ordinal")
    rows = versioned_join(rows, entries.withColumnRenamed("ordinal", "_po"), "accession", ["plan_accession", "target_bp"], "_po")
    is_planned = F.col("final_class").isin(*planned)
    # of planned accessions only: what lies before a fragment is summed up within its plan row
    matched = rows.where(is_planned & F.col("match").isNotNull())
    before = F.coalesce(F.sum("bp").over(Window.partitionBy("plan_accession").orderBy("ordinal", "fragment_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    over = F.col("target_bp").isNotNull() & (before >= F.col("target_bp")) if capped else F.lit(False)
    matched = matched.withColumn("outcome", F.when(over, "over_budget").otherwise("kept"))
    others = rows.where(~is_planned).withColumn("outcome", F.lit("passthrough")).unionByName(rows.where(is_planned & F.col("match").isNull()).withColumn("outcome", F.lit("not_in_plan")))
    judged = matched.unionByName(others)
    per = matched.groupBy("plan_accession").agg(F.sum(F.when(F.col("outcome") == "kept", F.col("bp")).otherwise(0)).alias("kept_bp"), F.sum("bp").alias("available_bp"), F.count(F.when(F.col("outcome") == "kept", 1)).alias("fragments"))
    ends = entries.groupBy("plan_accession").agg(F.max_by("target_bp", "ordinal").alias("target_bp")).join(per, "plan_accession", "left").na.fill(0, ["kept_bp", "available_bp", "fragments"])
    problem = F.when(F.col("fragments") == 0, "absent_from_source_corpus").when((F.col("target_bp") > 0) & (F.col("kept_bp") < F.col("target_bp")), "shortfall")
    missing = ends.withColumn("problem", problem).where("problem is not null").withColumn("deficit_bp", F.when(F.col("problem") == "shortfall", F.col("target_bp") - F.col("kept_bp")))
    counts = judged.groupBy("outcome", F.coalesce("match", F.lit("none")).alias("match"), "mismatch").agg(F.count(F.lit(1)).alias("fragments"), F.sum("bp").alias("bp"))
    return judged.where(F.col("outcome").isin("kept", "passthrough")).drop("outcome"), missing, counts


def flatten_splits(df: DataFrame, splits: Sequence[str], cls: str = "class", split: str = "split") -> DataFrame:
    """The rows of some splits as one corpus per class."""
    return df.where(F.col(split).isin(*splits)).drop(split)


def plan_downloads(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(manifest, pending): entity_id, klass, file_type, url, backup_url, md5_url, local_dir, filename, fna_stem, size_hint; portal rows without a direct sequence file are pending.

    df: entity_id, entity_type, source, klass, ftp_path, download_url, source_filename, source_native_id, sequence_accession, genome_size, genome_size_ungapped, source_file_size."""
    url, name = _text("download_url"), _text("source_filename")
    portal = F.col("source").isin("jgi", "jgi_gold") & (F.col("entity_type") == "assembly")
    virus = F.col("entity_type") == "virus_sequence"
    file = F.when(name != "", name).when(virus, F.concat(_text("sequence_accession"), F.lit(".fna"))).otherwise(F.regexp_extract(F.substring_index(url, "?", 1), "[^/]*$", 0))
    direct = (url != "") & file.rlike(r"\.fna(\.gz)?$")
    ftp = F.regexp_replace(_text("ftp_path"), "/+$", "")
    folder = F.regexp_extract(ftp, "[^/]*$", 0)
    https = F.when(F.startswith(ftp, F.lit("http")), ftp).otherwise(F.concat(F.lit("https:"), F.regexp_replace(ftp, "^[^:]*:", "")))
    native = F.regexp_replace(F.when(_text("source_native_id") != "", F.col("source_native_id")).otherwise(F.regexp_replace("entity_id", ":", "_")), "[^A-Za-z0-9_.-]", "_")
    first = lambda *cs: F.coalesce(*(F.nullif(number(F.col(c), 0.0), F.lit(0.0)) for c in cs), F.lit(0.0)).cast("long")
    own = df.where(virus & (url != "") | portal & direct | (F.col("entity_type") == "assembly") & ~portal & (ftp != ""))
    pick = lambda v, p, a: F.when(virus, v).when(portal, p).otherwise(a)
    end = lambda s: F.concat(folder, F.lit(s))
    none = F.lit("")
    filename = pick(file, file, end("_genomic.fna.gz"))
    manifest = own.select(
        "entity_id",
        pick(F.lit("virus"), F.col("klass"), F.col("klass")).alias("klass"),
        F.when(virus, "viral_segment_fna").otherwise("genomic_fna").alias("file_type"),
        pick(url, url, F.concat(https, F.lit("/"), end("_genomic.fna.gz"))).alias("url"),
        pick(none, none, F.concat(F.regexp_replace(ftp, "^https?://", "ftp://"), F.lit("/"), end("_genomic.fna.gz"))).alias("backup_url"),
        pick(none, none, F.concat(https, F.lit("/md5checksums.txt"))).alias("md5_url"),
        pick(F.concat(F.lit("sequence/virus/"), _text("sequence_accession")), F.concat(F.lit("jgi/"), native), F.concat(F.lit("assembly/"), folder)).alias("local_dir"),
        filename.alias("filename"),
        F.regexp_replace(filename, r"(_genomic)?\.fna(\.gz)?$", "").alias("fna_stem"),
        pick(F.lit(0).cast("long"), first("source_file_size", "genome_size_ungapped", "genome_size"), first("genome_size_ungapped", "genome_size", "source_file_size")).alias("size_hint"),
    )
    pending = df.where(portal & ~direct).select("entity_id", "source_native_id", F.lit("MISSING_DIRECT_FASTA_URL_OR_FILENAME").alias("reason"), "download_url", "source_filename")
    return manifest, pending


def organize(master: DataFrame, qc: DataFrame, split: DataFrame, manifest: DataFrame, status: DataFrame) -> DataFrame:
    """Where each accepted entity of a split goes: entity_id, destination (raw/<group>/<split>/<file>, or evaluation/<collection>/<file>), problem (missing if its download is not done).

    Entities that are not accepted, without split or (but for organelles) not in the manifest are left out. master: entity_id, entity_type, klass, group_name, evaluation_collection."""
    rows = master.join(qc.where(F.col("qc_status") == "accepted").select("entity_id"), "entity_id", "left_semi")
    rows = rows.join(split.where(F.col("split").isin("train", "test", "evaluation")).select("entity_id", "split"), "entity_id")
    rows = rows.join(manifest.select("entity_id", "filename"), "entity_id", "left").join(status.select("entity_id", "result"), "entity_id", "left")
    organelle = F.col("entity_type") == "organelle"
    rows = rows.where(organelle | F.col("filename").isNotNull())
    done = organelle | F.coalesce(F.col("result").isin(*DONE), F.lit(False))
    group = F.when(_text("group_name") != "", F.col("group_name")).otherwise(F.col("klass"))
    file = F.when(organelle, F.concat("entity_id", F.lit(".fna.gz"))).otherwise(F.col("filename"))
    collection = F.when(_text("evaluation_collection") != "", F.col("evaluation_collection")).otherwise(group)
    place = F.when(F.col("split") == "evaluation", F.concat_ws("/", F.lit("evaluation"), collection, file)).otherwise(F.concat_ws("/", F.lit("raw"), group, "split", file))
    return rows.select("entity_id", "split", F.when(done, place).alias("destination"), F.when(~done, "missing").alias("problem"))


def organelle_inventory(fasta: DataFrame, meta: DataFrame, min_len: int = 0, per_species: int = 0, group: str | None = None) -> DataFrame:
    """Sequences (accession, length, ordinal) and metadata (accession, taxid, organism, and species_taxid if there is such a column) side by side: accession, accession_base, taxid, species_taxid, length,
    metadata_matched, fasta_present, selected, reasons: DUPLICATE_FASTA_ACCESSION, BELOW_MIN_LENGTH, SPECIES_CAP, FASTA_NOT_FOUND. group: a column of both tables, within which they are matched, and which the result has, too.

    Versions don't count between the two. A species is that of species_taxid, else of taxid; of its sequences that are neither short nor repeated the first per_species are selected; without
    either each is a species of its own."""
    own, base = [group] if group else [], lambda c: base_accession(F.col(c))
    of_species = F.col("species_taxid") if "species_taxid" in meta.columns else F.lit("")
    info = meta.withColumn("_species", of_species).groupBy(*own, base("accession").alias("accession_base")).agg(F.min_by(F.struct("accession", "taxid", "_species"), "accession").alias("_m"))
    rows = fasta.withColumn("accession_base", base("accession")).withColumn("_nth", F.row_number().over(Window.partitionBy(*own, "accession").orderBy("ordinal")))
    both = rows.join(info, [*own, "accession_base"], "full")
    present = F.col("ordinal").isNotNull()
    twice, short = F.col("_nth") > 1, F.col("length") < min_len
    filled = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    both = both.withColumn("taxid", filled("_m.taxid")).withColumn("species_taxid", F.coalesce(filled("_m._species"), filled("_m.taxid")))
    both = both.withColumn("_ok", present & ~F.coalesce(twice, F.lit(False)) & ~F.coalesce(short, F.lit(False)))
    key = F.coalesce("species_taxid", F.concat(F.lit("ACC:"), F.coalesce("accession", "accession_base")))
    nth = F.row_number().over(Window.partitionBy(*own, key, "_ok").orderBy("ordinal"))
    over = F.col("_ok") & (nth > per_species) if per_species else F.lit(False)
    both = both.withColumn("_over", over)
    tests = [(twice, "DUPLICATE_FASTA_ACCESSION"), (short, "BELOW_MIN_LENGTH"), (F.col("_over"), "SPECIES_CAP"), (~present, "FASTA_NOT_FOUND")]
    reasons = F.filter(F.array(*(F.when(F.coalesce(t, F.lit(False)), n) for t, n in tests)), lambda x: x.isNotNull())
    found = [F.col("_m").isNotNull().alias("metadata_matched"), present.alias("fasta_present"), (F.col("_ok") & ~F.col("_over")).alias("selected"), reasons.alias("reasons")]
    return both.select(*own, F.coalesce("accession", "_m.accession").alias("accession"), "accession_base", "taxid", "species_taxid", "length", *found)


def organelle_stats(inventory: DataFrame, group: str, meta: DataFrame) -> DataFrame:
    """Per group of an inventory (see organelle_inventory; meta: its metadata): metadata records and repeated ones, sequences and repeated ones, with metadata and without, without a taxid, short ones,
    those over a species' cap, those kept, and distinct taxids of sequences."""
    n, has = F.count_if, lambda reason: F.array_contains("reasons", reason)
    there = F.col("fasta_present")
    sums = inventory.groupBy(group).agg(
        n(there).alias("fasta_records"),
        n(has("DUPLICATE_FASTA_ACCESSION")).alias("duplicate_fasta_accessions"),
        n(there & F.col("metadata_matched")).alias("metadata_matched"),
        n(there & ~F.col("metadata_matched")).alias("missing_metadata"),
        n(there & F.col("taxid").isNull()).alias("missing_taxid"),
        n(has("BELOW_MIN_LENGTH")).alias("below_min_len"),
        n(has("SPECIES_CAP")).alias("species_cap_filtered"),
        n(F.col("selected")).alias("kept_records"),
        F.countDistinct(F.when(there, F.col("taxid"))).alias("distinct_taxids"),
    )
    records = meta.groupBy(group).agg(F.count(F.lit(1)).alias("gbff_records"), (F.count(F.lit(1)) - F.countDistinct(base_accession(F.col("accession")))).alias("duplicate_gbff_accessions"))
    return records.join(sums, group, "full").na.fill(0)


def verify(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Entities of the manifest (entity_id, path) with a problem: missing, or fasta_bad, if their file (path, ok) is not there or not in order."""
    joined = manifest.select("entity_id", "path").join(files.select("path", "ok"), "path", "left")
    problem = F.when(F.col("ok").isNull(), "missing").when(~F.col("ok"), "fasta_bad")
    return joined.withColumn("problem", problem).where("problem is not null").select("entity_id", "problem")


def relabel(df: DataFrame, labels: DataFrame, record: str = "record_id", split: str = "split") -> DataFrame:
    """df with euk_group of the curated labels (record_id, split, euk_group); a row without one, or of another split, is an error when it is read."""
    own = labels.select(F.col(record), F.col(split).alias("_split"), "euk_group")
    joined = df.drop("euk_group").join(own, record, "left")
    bad = F.col("_split").isNull() | (F.col("_split") != F.col(split))
    fail = F.raise_error(F.concat(F.lit("curated metadata missing or of another split: "), F.col(record).cast("string"))).cast("string")
    return joined.withColumn("euk_group", F.when(bad, fail).otherwise(F.col("euk_group"))).drop("_split")


def admit_delta(base: DataFrame, candidates: DataFrame, required: DataFrame, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """(judged, unmet). base: record_id, split, digest, species_taxid, split_group_id, duplicate_cluster_id; candidates: record_id, split, meta_split, euk_group, species_taxid, ...,
    digest, ordinal, has_metadata; required: (split, euk_group).

    Each candidate's reason, the first that holds: missing_metadata, unresolved_euk_group, not_required_for_split, metadata_split_mismatch, missing_species_taxid,
    duplicate_record_id_to_base, duplicate_sequence_to_base_or_delta, cross_split_group_overlap; null if admitted. Training candidates come first: validation ones also must not
    share a key, id or sequence with admitted ones. Of equal sequences or ids of a split the first passing one counts. A rejected candidate claims no key (where a sequential reading
    would leave some claims behind). unmet: split, euk_group, missing rows up to `least`."""
    keys = ("species_taxid", "split_group_id", "duplicate_cluster_id")
    need = required.select("split", "euk_group").distinct().withColumn("_needed", F.lit(True))

    def claims(df):
        return df.select(F.col("split").alias("_claimed"), F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), _text(k).alias("value")) for k in keys))).alias("x")).select("_claimed", "x.*").where("value <> ''").distinct()

    def judge(rows, known):
        ids = known.select("record_id").distinct().withColumn("_id", F.lit(True))
        digests = known.select("digest").distinct().withColumn("_seq", F.lit(True))
        own = rows.select("record_id", "ordinal", "split", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), _text(k).alias("value")) for k in keys))).alias("x")).select("record_id", "ordinal", "split", "x.*")
        cross = own.join(claims(known), ["kind", "value"]).where("split <> _claimed").select("record_id", "ordinal").distinct().withColumn("_cross", F.lit(True))
        joined = rows.join(need, ["split", "euk_group"], "left").join(ids, "record_id", "left").join(digests, "digest", "left").join(cross, ["record_id", "ordinal"], "left")
        reason = F.when(~F.col("has_metadata"), "missing_metadata").when(_text("euk_group") == "", "unresolved_euk_group").when(F.col("_needed").isNull(), "not_required_for_split")
        reason = reason.when((_text("meta_split") != "") & (F.col("meta_split") != F.col("split")), "metadata_split_mismatch").when(_text("species_taxid") == "", "missing_species_taxid")
        reason = reason.when(F.col("_id"), "duplicate_record_id_to_base").when(F.col("_seq"), "duplicate_sequence_to_base_or_delta").when(F.col("_cross"), "cross_split_group_overlap")
        out = joined.withColumn("reason", reason).select(*rows.columns, "reason")
        for key, name in (("record_id", "duplicate_record_id_to_base"), ("digest", "duplicate_sequence_to_base_or_delta")):
            first = out.where("reason is null").groupBy(key).agg(F.min("ordinal").alias("_first"))
            out = out.join(first, key, "left").withColumn("reason", F.when(F.col("reason").isNull() & (F.col("ordinal") > F.col("_first")), name).otherwise(F.col("reason"))).select(*rows.columns, "reason")
        return out

    train = made_once(judge(candidates.where("split = 'train'"), base))
    kept = train.where("reason is null").select(*base.columns)
    validation = judge(candidates.where("split = 'validation'"), base.unionByName(kept))
    judged = train.unionByName(validation)
    counts = judged.where("reason is null").groupBy("split", "euk_group").agg(F.count(F.lit(1)).alias("n"))
    unmet = need.drop("_needed").join(counts, ["split", "euk_group"], "left").na.fill(0, ["n"]).where(F.col("n") < least).select("split", "euk_group", (F.lit(least) - F.col("n")).alias("missing"))
    return judged, unmet
