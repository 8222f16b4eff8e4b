"""Taxonomy: ranks and clades of taxa, lineages as text, and the resolution of records' groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import base_accession
from ..functions.labels import CLADE_OF_SUPERGROUP, lookup, word
from .order import kept
from .select import ancestors, upward

# Clades in the order in which they are tried, with the taxon of their root and their names in lineages.
CLADES = (
    ("metazoa_vertebrate", 7742, ("Vertebrata", "Craniata")),
    ("metazoa_invertebrate", 33208, ("Metazoa",)),
    ("land_plant", 3193, ("Embryophyta", "Tracheophyta", "Streptophyta")),
    ("fungi", 4751, ("Fungi",)),
    ("alveolata", 33630, ("Alveolata", "Apicomplexa", "Ciliophora")),
    ("stramenopiles", 33634, ("Stramenopiles", "Bacillariophyta", "Phaeophyceae", "Eustigmatophyceae")),
    ("algae", 3041, ("Chlorophyta",)),
    ("algae", 2763, ("Rhodophyta", "Bangiophyceae")),
    ("other_protist", 2611352, ("Discoba", "Euglenozoa", "Kinetoplastida")),
    ("other_protist", 554915, ("Amoebozoa", "Evosea")),
    ("other_protist", 543769, ("Rhizaria", "Cercozoa")),
    ("other_protist", 2683617, ("Haptista", "Haptophyta")),
    ("other_protist", 2686027, ("Cryptista", "Cryptophyceae")),
    ("eukarya_other", 2759, ("Eukaryota",)),
    ("bacteria", 2, ("Bacteria",)),
    ("archaea", 2157, ("Archaea",)),
)
# The eight groups of eukaryotes that records resolve to.
GROUPS = ("fungi", "land_plant", "algae", "metazoa_vertebrate", "metazoa_invertebrate", "alveolata", "stramenopiles", "other_protist")
# Group of a source group.
GROUP_OF_SOURCE = {"fungi": "fungi", "plant": "land_plant", "protozoa": "other_protist", "invertebrate": "metazoa_invertebrate", "vertebrate_other": "metazoa_vertebrate", "vertebrate_mammalian": "metazoa_vertebrate"}
# Other names of a group.
GROUP_ALIASES = {
    "fungi": "fungi",
    "opisthokonta-fungi": "fungi",
    "land_plant": "land_plant",
    "plant": "land_plant",
    "embryophyta": "land_plant",
    "algae": "algae",
    "alga": "algae",
    "metazoa_vertebrate": "metazoa_vertebrate",
    "vertebrate": "metazoa_vertebrate",
    "host-mammalia": "metazoa_vertebrate",
    "metazoa_invertebrate": "metazoa_invertebrate",
    "invertebrate": "metazoa_invertebrate",
    "alveolata": "alveolata",
    "stramenopiles": "stramenopiles",
    "other_protist": "other_protist",
    "protist": "other_protist",
}
Clades = Sequence[tuple[str, object, Sequence[str]]]


def taxon_info(taxa: DataFrame, nodes: DataFrame, names: DataFrame, clades: Clades = CLADES) -> DataFrame:
    """taxa: (taxid). nodes: (id, parent, rank); names: (id, name). Returns taxid, ok, clade, species, genus_key, genus_name, family_key, family_name.

    A taxon's ancestors are itself and those above it; the nearest of a rank counts. clade: of the first of `clades` whose root is among them, else `unknown`. Without a genus a taxon
    is a genus of its own (n<taxid>), so unrelated ones never merge; without a family the family is the genus. A taxon that the nodes lack is not ok and has no keys."""
    asked = taxa.select("taxid").distinct()
    nodes = kept(upward(nodes, asked.select(F.col("taxid").alias("id"))))  # what is above the taxa; the closure of the whole tree would be some forty times its size
    chain = ancestors(nodes.select("id", "parent")).select(F.col("id").alias("taxid"), F.col("ancestor").alias("node"), "depth")
    chain = nodes.select(F.col("id").alias("taxid"), F.col("id").alias("node"), F.lit(0).alias("depth")).unionByName(chain).join(asked, "taxid", "left_semi")
    place = F.create_map(*(x for i, (_, root, _) in enumerate(clades) for x in (F.lit(root), F.lit(i))))
    name_of = F.element_at(F.array(*(F.lit(c) for c, _, _ in clades)), F.col("_first") + 1)
    rank_of = lambda r: F.min_by(F.when(F.col("rank") == r, F.col("node")), F.when(F.col("rank") == r, F.col("depth")))
    rows = chain.join(nodes.select(F.col("id").alias("node"), "rank"), "node")
    per = rows.groupBy("taxid").agg(F.min(F.element_at(place, F.col("node"))).alias("_first"), rank_of("species").alias("species"), rank_of("genus").alias("_genus"), rank_of("family").alias("_family"))
    named = per.join(names.select(F.col("id").alias("taxid"), F.col("name").alias("_own")), "taxid", "left")
    for c in ("_genus", "_family"):
        named = named.join(names.select(F.col("id").alias(c), F.col("name").alias(c + "_name")), c, "left")
    text = lambda c: F.col(c).cast("string")
    label = lambda c, node: F.coalesce(F.col(c), F.concat(F.lit("taxid:"), text(node)))
    genus_key = F.when(F.col("_genus").isNotNull(), F.concat(F.lit("t"), text("_genus"))).otherwise(F.concat(F.lit("n"), text("taxid")))
    genus_name = F.when(F.col("_genus").isNotNull(), label("_genus_name", "_genus")).otherwise(label("_own", "taxid"))
    out = named.select("taxid", F.lit(True).alias("ok"), F.coalesce(name_of, F.lit("unknown")).alias("clade"), "species", genus_key.alias("genus_key"), genus_name.alias("genus_name"), F.when(F.col("_family").isNotNull(), F.concat(F.lit("t"), text("_family"))).otherwise(genus_key).alias("family_key"), F.when(F.col("_family").isNotNull(), label("_family_name", "_family")).otherwise(genus_name).alias("family_name"))
    return asked.join(out, "taxid", "left").withColumn("ok", F.coalesce("ok", F.lit(False))).withColumn("clade", F.coalesce("clade", F.lit("unknown")))


def lineage_info(lineage: Column, organism: Column, clades: Clades = CLADES) -> Column:
    """struct(ok, clade, genus_key, genus_name, family_key, family_name) of a lineage as text (separated by ;): the clade of the deepest name known, the last name as genus, the one before as
    family. Without a lineage the organism's first word is genus and family, and ok is false."""
    alias = {n.lower(): c for c, _, names in reversed(clades) for n in names}
    parts = F.filter(F.transform(F.split(F.coalesce(lineage, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    some, n = F.size(parts) > 0, F.size(parts)
    hit = F.get(F.filter(F.transform(F.reverse(parts), lambda x: lookup(F.lower(x), alias)), lambda x: x.isNotNull()), F.lit(0))
    first = F.get(F.filter(F.split(F.coalesce(organism, F.lit("")), r"\s+"), lambda x: x != ""), F.lit(0))
    genus = F.when(some, F.get(parts, n - 1)).otherwise(first)
    family = F.when(n > 1, F.get(parts, n - 2)).otherwise(genus)
    key = lambda c: F.concat(F.lit("s"), F.lower(c))
    return F.struct(some.alias("ok"), F.coalesce(hit, F.lit("unknown")).alias("clade"), key(genus).alias("genus_key"), genus.alias("genus_name"), key(family).alias("family_key"), family.alias("family_name"))


def resolve_metadata(meta: DataFrame, acc2tax: DataFrame, info: DataFrame, groups: Sequence[str] = GROUPS, remap: Mapping[str, str] = {}) -> DataFrame:  # noqa: B006
    """meta (record_id, legacy_class, euk_group, species_taxid) with the eukaryotes that lack a group resolved by accession, taxid and clade, and label_status: null if nothing was to be done,
    resolved_taxdump, unresolved_no_accession, unresolved_no_taxid, unresolved_taxdump or unresolved_clade:<clade>. info: see taxon_info; acc2tax: (accession, taxid), the least of several."""
    accession = F.trim(F.substring_index("record_id", "|", 1))
    one = acc2tax.groupBy(F.col("accession").alias("_acc")).agg(F.min("taxid").alias("_taxid"))
    own = info.select(F.col("taxid").alias("_taxid"), "ok", "clade", "species")
    open_ = (F.col("legacy_class") == "eukarya") & (F.coalesce("euk_group", F.lit("")) == "")
    joined = meta.withColumn("_acc", F.when(open_, accession)).join(one, "_acc", "left").join(own, "_taxid", "left")
    clade = F.coalesce(lookup(F.col("clade"), dict(remap)), F.col("clade")) if remap else F.col("clade")
    good = open_ & F.coalesce(F.col("ok"), F.lit(False)) & F.coalesce(clade.isin(*groups), F.lit(False))
    status = F.when(~open_, F.lit(None)).when(F.coalesce("_acc", F.lit("")) == "", "unresolved_no_accession").when(F.col("_taxid").isNull(), "unresolved_no_taxid")
    status = status.when(~F.coalesce(F.col("ok"), F.lit(False)), "unresolved_taxdump").when(good, "resolved_taxdump").otherwise(F.concat(F.lit("unresolved_clade:"), clade))
    species = F.when(good, F.coalesce("species", "_taxid").cast("string")).otherwise(F.col("species_taxid").cast("string"))
    kept = [c for c in meta.columns if c not in ("euk_group", "species_taxid", "label_status")]
    return joined.select(*kept, species.alias("species_taxid"), F.when(good, clade).otherwise(F.col("euk_group")).alias("euk_group"), status.alias("label_status"))


def resolve_group(df: DataFrame, override: str | None = None, groups: Sequence[str] = GROUPS) -> DataFrame:
    """df with group and how: the first of a manual override, the clade by taxid (taxdump_clade), by lineage (lineage), the source group, the supergroup and the label that is there (euk_group)
    that is one of the groups; `unresolved` without any. Columns that df lacks are passed over."""
    has = lambda c: c is not None and c in df.columns
    among = lambda c: F.when(c.isin(*groups), c)
    found: list[tuple[Column, str]] = []
    if has(override):
        found.append((F.nullif(F.col(override), F.lit("")), "manual_override"))
    if has("taxdump_clade"):
        found.append((among(F.col("taxdump_clade")), "taxdump"))
    if has("lineage"):
        found.append((among(lineage_info(F.col("lineage"), F.lit(None).cast("string"))["clade"]), "lineage"))
    if has("source_group"):
        found.append((lookup(word(F.col("source_group")), GROUP_OF_SOURCE), "source_group"))
    if has("supergroup"):
        found.append((lookup(word(F.col("supergroup")), CLADE_OF_SUPERGROUP), "supergroup"))
    if has("euk_group"):
        found.append((lookup(word(F.col("euk_group")), GROUP_ALIASES), "existing_label"))
    pair = F.coalesce(*(F.when(c.isNotNull(), F.struct(c.alias("group"), F.lit(how).alias("how"))) for c, how in found), F.struct(F.lit(None).cast("string").alias("group"), F.lit("unresolved").alias("how")))
    return df.withColumn("_pair", pair).select(*df.columns, F.col("_pair.group").alias("group"), F.col("_pair.how").alias("how"))


def merge_sources(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """One row for each key: of every other column the first value, by ordinal, that is not empty; duplicates: the rows besides the first."""
    others = [c for c in df.columns if c not in (key, ordinal)]
    full = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    rows = df.where(full(key))
    return rows.groupBy(key).agg(*(F.min_by(F.when(full(c), F.col(c)), F.when(full(c), F.col(ordinal))).alias(c) for c in others), (F.count(F.lit(1)) - 1).alias("duplicates"))


def acc2clade(headers: DataFrame, acc2tax: DataFrame, info: DataFrame, accession: str = "accession") -> DataFrame:
    """headers with the clade of their accession (in any version), null if it, its taxon or a clade is not known."""
    one = acc2tax.groupBy(base_accession(F.col("accession"), "last").alias("_base")).agg(F.min("taxid").alias("taxid"))
    known = one.join(info.where(F.col("ok") & (F.col("clade") != "unknown")).select("taxid", "clade"), "taxid").select("_base", "clade")
    return headers.withColumn("_base", base_accession(F.col(accession), "last")).join(known, "_base", "left").drop("_base")


def completeness(records: DataFrame, pool: DataFrame, sources: DataFrame, groups: Sequence[str] = GROUPS) -> DataFrame:
    """Per group: base_before, base_after, base_train, base_validation, existing_pool_fragments, source_genomes, diagnosis, needs_delta_train, needs_delta_validation.

    records: split, current, resolved (groups or null); pool: group; sources: accession, group. diagnosis: complete, label_error_recovered (there only once resolved), bp_balance_not_selected (only in
    the pool), source_fragments_missing (only genomes) or source_missing."""
    n = lambda test: F.count(F.when(test, 1))
    both = F.explode(F.array(F.struct(F.col("current").alias("euk_group"), F.lit("before").alias("side")), F.struct(F.col("resolved").alias("euk_group"), F.lit("after").alias("side")))).alias("x")
    per = records.select("split", both).select("split", "x.*").groupBy("euk_group").agg(n(F.col("side") == "before").alias("base_before"), n(F.col("side") == "after").alias("base_after"), n((F.col("side") == "after") & (F.col("split") == "train")).alias("base_train"), n((F.col("side") == "after") & (F.col("split") == "validation")).alias("base_validation"))
    pooled = pool.groupBy(F.col("group").alias("euk_group")).agg(F.count(F.lit(1)).alias("existing_pool_fragments"))
    genomes = sources.groupBy(F.col("group").alias("euk_group")).agg(F.countDistinct("accession").alias("source_genomes"))
    numbers = ["base_before", "base_after", "base_train", "base_validation", "existing_pool_fragments", "source_genomes"]
    dimension = records.sparkSession.createDataFrame([(g,) for g in groups], "euk_group string")
    out = dimension.join(per, "euk_group", "left").join(pooled, "euk_group", "left").join(genomes, "euk_group", "left").na.fill(0, numbers)
    there = (F.col("base_train") > 0) & (F.col("base_validation") > 0)
    diagnosis = F.when(there & (F.col("base_before") == 0), "label_error_recovered").when(there, "complete").when(F.col("existing_pool_fragments") > 0, "bp_balance_not_selected").when(F.col("source_genomes") > 0, "source_fragments_missing").otherwise("source_missing")
    return out.select("euk_group", *numbers, diagnosis.alias("diagnosis"), (F.col("base_train") == 0).alias("needs_delta_train"), (F.col("base_validation") == 0).alias("needs_delta_validation"))


def label_actions(records: DataFrame) -> DataFrame:
    """records (current, resolved) with action: unresolved, label_error_missing, label_error_wrong or unchanged."""
    current, resolved = F.coalesce("current", F.lit("")), F.coalesce("resolved", F.lit(""))
    return records.withColumn("action", F.when(resolved == "", "unresolved").when(current == "", "label_error_missing").when(current != resolved, "label_error_wrong").otherwise("unchanged"))
