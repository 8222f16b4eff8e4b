"""Classes, clades and strata of records, from their metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The words that metadata use for each class. They are compared whole, never as parts of a name.
LABEL_WORDS = {
    "mitochondria": ("mito", "mitochondria", "mitochondrion"),
    "plastids": ("chloroplast", "plast", "plastid", "plastids"),
    "eukarya": ("euk", "euk_nuclear", "eukarya", "eukaryota", "eukaryote"),
    "bacteria": ("bac", "bacteria", "bacterium"),
    "archaea": ("arc", "arch", "archaea", "archaeon", "archea"),
    "virus": ("vir", "viral", "virion", "virus", "viruses"),
    "prokaryote": ("prok", "prokaryota", "prokaryote"),
}
GROUP_WORDS = {
    "mitochondria": ("mitochondria", "mitochondrion", "organelle-mito", "organelle-mitochondrion"),
    "plastids": ("chloroplast", "organelle-chloroplast", "organelle-plastid", "plastid", "plastids"),
    "bacteria": ("bacteria", "bacterium", "eubacteria"),
    "archaea": ("archaea", "archaeon", "archea"),
    "virus": ("adnaviria", "duplodnaviria", "monodnaviria", "riboviria", "ribozyviria", "varidnaviria", "viral", "virus", "viruses"),
}
ORGANELLE_PREFIX = "organelle-"
COMPARTMENTS = {
    "mitochondria": ("mito", "mitochondria", "mitochondrial", "mitochondrion", "mt"),
    "plastids": ("apicoplast", "chloroplast", "cp", "plast", "plastid", "plastids"),
}
# Label and supergroup that a source group stands for.
GROUP_META = {
    "archaea": ("prok", "Archaea"),
    "bacteria": ("prok", "Bacteria"),
    "chloroplast": ("organelle", "Organelle-Plastid"),
    "fungi": ("euk", "Opisthokonta-Fungi"),
    "invertebrate": ("euk", "Opisthokonta-Metazoa"),
    "mito": ("organelle", "Organelle-Mito"),
    "mitochondria": ("organelle", "Organelle-Mito"),
    "mitochondrion": ("organelle", "Organelle-Mito"),
    "plant": ("euk", "Archaeplastida"),
    "plastid": ("organelle", "Organelle-Plastid"),
    "plastids": ("organelle", "Organelle-Plastid"),
    "protozoa": ("euk", "Protist(SAR/Excavata/Amoebozoa)"),
    "vertebrate_mammalian": ("euk", "Host-Mammalia"),
    "vertebrate_other": ("euk", "Opisthokonta-Metazoa"),
    "viral": ("virus", "Virus"),
    "virus": ("virus", "Virus"),
    "viruses": ("virus", "Virus"),
}
# Fine class to first-stage class.
STAGE1 = {"archaea": "archaea", "bacteria": "bacteria", "eukarya": "eukarya", "mitochondria": "other", "plastids": "other", "virus": "other"}
# Clade of a source group, of a supergroup, and what an ambiguous supergroup collapses to.
CLADE_OF_GROUP = {
    "fungi": "fungi",
    "invertebrate": "metazoa_invertebrate",
    "plant": "land_plant",
    "protozoa": "other_protist",
    "vertebrate_mammalian": "metazoa_vertebrate",
    "vertebrate_other": "metazoa_vertebrate",
}
CLADE_OF_SUPERGROUP = {
    "archaeplastida-alga": "algae",
    "archaeplastida-landplant": "land_plant",
    "host-mammalia": "metazoa_vertebrate",
    "opisthokonta-fungi": "fungi",
    "opisthokonta-metazoa-invertebrate": "metazoa_invertebrate",
    "opisthokonta-metazoa-vertebrate": "metazoa_vertebrate",
    "sar-alveolata": "alveolata",
    "sar-stramenopiles": "stramenopiles",
}
AMBIGUOUS_SUPERGROUP = {
    "archaeplastida": "algae",
    "opisthokonta-metazoa": "metazoa_invertebrate",
    "protist(sar/excavata/amoebozoa)": "other_protist",
}
OTHER_CLADE = "eukarya_other"
# Class of an external row's genome type, and of its domain.
GENOME_TYPE_CLASS = {"mitochondrion": "mitochondria", "plastid": "plastids", "eukarya nuclear": "eukarya"}
DOMAIN_CLASS = {"archaea": "archaea", "bacteria": "bacteria", "eukarya": "eukarya"}
# Clade and source group of a taxonomy's names.
TAXONOMY_CLADE = {
    "fungi": ("fungi", "fungi"),
    "ascomycota": ("fungi", "fungi"),
    "basidiomycota": ("fungi", "fungi"),
    "microsporidia": ("fungi", "fungi"),
    "alveolata": ("alveolata", "protozoa"),
    "apicomplexa": ("alveolata", "protozoa"),
    "ciliophora": ("alveolata", "protozoa"),
    "stramenopiles": ("stramenopiles", "protozoa"),
    "bacillariophyta": ("stramenopiles", "protozoa"),
    "oomycota": ("stramenopiles", "protozoa"),
    "euglenozoa": ("other_protist", "protozoa"),
    "kinetoplastida": ("other_protist", "protozoa"),
    "discoba": ("other_protist", "protozoa"),
    "evosea": ("other_protist", "protozoa"),
    "amoebozoa": ("other_protist", "protozoa"),
    "rhizaria": ("other_protist", "protozoa"),
    "chlorophyta": ("algae", "plant"),
    "rhodophyta": ("algae", "plant"),
    "bangiophyceae": ("algae", "plant"),
    "glaucocystophyceae": ("algae", "plant"),
    "streptophyta": ("land_plant", "plant"),
    "embryophyta": ("land_plant", "plant"),
    "viridiplantae": ("land_plant", "plant"),
    "metazoa": ("metazoa_invertebrate", "invertebrate"),
    "arthropoda": ("metazoa_invertebrate", "invertebrate"),
    "nematoda": ("metazoa_invertebrate", "invertebrate"),
    "chordata": ("metazoa_vertebrate", "vertebrate_other"),
    "vertebrata": ("metazoa_vertebrate", "vertebrate_other"),
    "mammalia": ("metazoa_vertebrate", "vertebrate_mammalian"),
}
# Source group of a class.
GROUP_OF_CLASS = {"bacteria": "bacteria", "archaea": "archaea", "mitochondria": "mitochondrion", "plastids": "plastid", "virus": "viral"}
# Keyword in free text, group and class; the first that occurs counts.
TEXT_RULES = (
    ("mitochond", "mitochondrion", "mitochondria"),
    ("plastid", "plastid", "plastid"),
    ("chloroplast", "plastid", "plastid"),
    ("bacteria", "bacteria", "bacteria"),
    ("archaea", "archaea", "archaea"),
    ("fung", "fungi", "nuclear_euk"),
    ("plant", "plant", "nuclear_euk"),
    ("viridiplant", "plant", "nuclear_euk"),
    ("euk", "jgi_eukaryota", "nuclear_euk"),
)
# Short names of outputs and the classes they stand for.
OUTPUTS = {"mit": "mitochondrion", "pla": "plastid", "bac": "bacteria", "arc": "archaea", "euk": "eukarya", "unk": "unknown", "pro": "prokarya", "org": "organelle"}


def word(col: Column) -> Column:
    return F.lower(F.trim(F.coalesce(col, F.lit(""))))


def lookup(col: Column, values: Mapping[str, str]) -> Column:
    """The value of a small map, null for other keys."""
    return F.element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), col)


def _compartment(sg: Column) -> Column:
    rest = F.when(F.startswith(sg, F.lit(ORGANELLE_PREFIX)), F.substr(sg, F.lit(len(ORGANELLE_PREFIX) + 1)))
    out = F.lit(None).cast("string")
    for name, words in COMPARTMENTS.items():
        out = F.when(sg.isin(*GROUP_WORDS[name]) | F.coalesce(rest.isin(*words), F.lit(False)), name).otherwise(out)
    return out


def class_from_meta(label: Column, supergroup: Column) -> Column:
    """Class of a record: the compartment that its supergroup names, then virus, then organelle, domain and generic labels.

    A supergroup that begins like an organelle but is unknown gives null, whatever the label."""
    lab, sg = word(label), word(supergroup)
    compartment = _compartment(sg)
    out = F.when(compartment.isNotNull(), compartment).when(F.startswith(sg, F.lit(ORGANELLE_PREFIX)), F.lit(None))
    out = out.when(lab.isin(*LABEL_WORDS["virus"]) | sg.isin(*GROUP_WORDS["virus"]), "virus")
    for name in ("mitochondria", "plastids", "eukarya", "bacteria", "archaea"):
        out = out.when(lab.isin(*LABEL_WORDS[name]), name)
    generic = lab.isin(*LABEL_WORDS["prokaryote"])
    return out.when(generic & sg.isin(*GROUP_WORDS["bacteria"]), "bacteria").when(generic & sg.isin(*GROUP_WORDS["archaea"]), "archaea")


def class_from_group(group: Column, meta: Mapping[str, tuple[str, str]] = GROUP_META) -> Column:
    """Class of a source group, by the label and supergroup it stands for."""
    name = word(group)
    return class_from_meta(lookup(name, {k: v[0] for k, v in meta.items()}), lookup(name, {k: v[1] for k, v in meta.items()}))


def stage1_of(cls: Column) -> Column:
    return lookup(cls, STAGE1)


def euk_subclass(label: Column, supergroup: Column, group: Column | None = None, clade: Column | None = None) -> Column:
    """struct(clade, how) of a eukaryote: by its taxid's clade (given, or null), its group, its supergroup; `ambiguous` has no clade."""
    sg, none = word(supergroup), F.lit(None).cast("string")
    by_group = lookup(word(group), CLADE_OF_GROUP) if group is not None else none
    by_taxid = clade if clade is not None else none
    pair = lambda value, how: F.struct(value.alias("clade"), F.lit(how).alias("how"))
    by_name = lookup(sg, CLADE_OF_SUPERGROUP)
    out = F.when(F.coalesce(class_from_meta(label, supergroup), F.lit("")) != "eukarya", pair(none, "not_eukaryotic"))
    out = out.when(F.coalesce(by_taxid, F.lit("")) != "", pair(by_taxid, "taxid")).when(by_group.isNotNull(), pair(by_group, "group")).when(by_name.isNotNull(), pair(by_name, "supergroup"))
    return out.when(sg.isin(*AMBIGUOUS_SUPERGROUP), pair(none, "ambiguous")).otherwise(pair(F.lit(OTHER_CLADE), "fallback"))


def stratum(cls: Column, label: Column, supergroup: Column, group: Column | None = None, clade: Column | None = None) -> Column:
    """struct(stratum, how): the class, or eukarya/<clade>, an ambiguous supergroup collapsing to a default clade."""
    found = euk_subclass(label, supergroup, group, clade)
    given = F.coalesce(clade, F.lit("")) if clade is not None else F.lit("")
    collapsed = lookup(word(supergroup), AMBIGUOUS_SUPERGROUP)
    name = F.when(given != "", given).otherwise(F.coalesce(found["clade"], collapsed, F.lit(OTHER_CLADE)))
    how = F.when(given != "", "taxid").when(found["clade"].isNotNull(), found["how"]).when(collapsed.isNotNull(), "ambiguous_sg_collapsed").otherwise("fallback")
    own = cls == "eukarya"
    return F.struct(F.when(own, F.concat(F.lit("eukarya/"), name)).otherwise(cls).alias("stratum"), F.when(own, how).otherwise("class").alias("how"))


def hier_labels(cls: Column, group: Column, policy: str = "other", other: str = "other_eukaryote") -> Column:
    """struct(root, euk, prok, organelle): heads that don't apply are null. group: the eukaryote's clade, if known; without one the
    policy is `other`, `skip` (a null struct) or `error`."""
    root = F.when(cls == "eukarya", "eukarya").when(cls.isin("bacteria", "archaea"), "prokarya").when(cls.isin("mitochondria", "plastids"), "organelle").when(cls == "virus", "virus")
    missing = (cls == "eukarya") & (F.coalesce(group, F.lit("")) == "")
    euk = F.when(cls == "eukarya", F.when(~missing, group).otherwise(F.raise_error(F.lit("a eukaryote without a group")).cast("string") if policy == "error" else F.lit(other)))
    out = F.struct(root.alias("root"), euk.alias("euk"), F.when(root == "prokarya", cls).alias("prok"), F.when(root == "organelle", cls).alias("organelle"))
    return F.when(~missing, out) if policy == "skip" else out


def classify_external(genome_type: Column, domain: Column, taxonomy: Column) -> Column:
    """struct(class, stage1, clade, how, group): class by genome type, else by domain (null if neither is known); of a eukaryote clade and group by the most
    specific name of its taxonomy that is known, else the fallback."""
    cls = F.coalesce(lookup(word(genome_type), GENOME_TYPE_CLASS), lookup(word(domain), DOMAIN_CLASS))
    names = F.filter(F.transform(F.split(F.lower(F.coalesce(taxonomy, F.lit(""))), "[;,/|>]+"), lambda x: F.trim(x)), lambda x: x != "")
    known = F.create_map(*(x for k, (clade, group) in TAXONOMY_CLADE.items() for x in (F.lit(k), F.struct(F.lit(clade).alias("clade"), F.lit(group).alias("group")))))
    hit = F.get(F.filter(F.transform(F.reverse(names), lambda x: F.element_at(known, x)), lambda x: x.isNotNull()), F.lit(0))
    euk = cls == "eukarya"
    clade = F.when(euk, F.coalesce(hit["clade"], F.lit(OTHER_CLADE)))
    how = F.when(cls.isNull(), "unmapped").when(euk, F.when(hit.isNotNull(), "taxonomy_string").otherwise("fallback"))
    group = F.when(euk, F.coalesce(hit["group"], F.lit("protozoa"))).otherwise(lookup(cls, GROUP_OF_CLASS))
    return F.struct(cls.alias("class"), stage1_of(cls).alias("stage1"), clade.alias("clade"), how.alias("how"), group.alias("group"))


def bucket(first: Column, second: Column) -> Column:
    """Name of the output of a cascade: of an organelle the second stage's class, if it has one."""
    return F.when((first == "organelle") & second.isNotNull(), second).otherwise(first)


def wanted_outputs(names: Sequence[str]) -> list[str]:
    """Classes of a list of short or full output names, each once; with `all`, every class."""
    low = [n.strip().lower() for n in names if n and n.strip()]
    found = [OUTPUTS.get(n, n) for n in low if n != "all"]
    unknown = [n for n in found if n not in OUTPUTS.values()]
    if unknown:
        raise ValueError(f"unknown outputs: {unknown}")
    return list(OUTPUTS.values()) if "all" in low else list(dict.fromkeys(found))


def group_and_class(text: Column, rules: Sequence[tuple[str, str, str]] = TEXT_RULES) -> Column:
    """struct(group, class) of the first rule (keyword, group, class) whose keyword the text contains; both empty if none does."""
    low = word(text)
    out = F.struct(F.lit("").alias("group"), F.lit("").alias("class"))
    for key, group, cls in reversed(list(rules)):
        out = F.when(F.contains(low, F.lit(key)), F.struct(F.lit(group).alias("group"), F.lit(cls).alias("class"))).otherwise(out)
    return out


def audit_labels(df: DataFrame, file_class: str, label: str, supergroup: str, top: int = 5) -> DataFrame:
    """Per class of a file: records, those whose metadata say otherwise or nothing, and the `top` pairs of supergroup and label among them."""
    derived = class_from_meta(F.col(label), F.col(supergroup))
    rows = df.groupBy(F.col(file_class).alias("file_class"), F.col(label).alias("label"), F.col(supergroup).alias("supergroup"), derived.alias("derived")).agg(F.count(F.lit(1)).alias("n"))
    wrong = ~F.col("derived").eqNullSafe(F.col("file_class"))
    n = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    out = rows.groupBy("file_class").agg(F.sum("n").alias("records"), n(wrong).alias("mismatched"), n(F.col("derived").isNull()).alias("unknown"))
    # tasks keep their own first few before any class is sorted
    place = F.row_number().over(Window.partitionBy("file_class").orderBy(F.desc("n"), "supergroup", "label"))
    first = rows.where(wrong).withColumn("place", place).where(F.col("place") <= top)
    worst = first.groupBy(F.col("file_class").alias("_class")).agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "supergroup", "label"))).alias("worst"))
    none = F.array().cast(worst.schema["worst"].dataType)
    out = out.join(worst, F.col("file_class").eqNullSafe(F.col("_class")), "left").drop("_class").withColumn("worst", F.coalesce("worst", none))
    return out.select("file_class", "records", "mismatched", "unknown", "worst", (F.col("mismatched") / F.col("records")).alias("mismatch_rate"))
