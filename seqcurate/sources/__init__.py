"""Scans and sinks: FASTA, tables with # headers or unknown separators, JSON lines, taxonomy dumps, flat files; FASTA, class tables and predictions written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import parse_header
from .corpus import CLASS_ALIASES, corpus_files, fasta_lines, infer, read_chunks, read_corpus, split_records, write_corpus

__all__ = ["CLASS_ALIASES", "corpus_files", "fasta_lines", "infer", "read_chunks", "read_corpus", "split_records", "write_corpus"]

def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(fragment_id, header, sequence, bp, path) of FASTA files; blanks in sequences are dropped. Files that aren't compressed are split between tasks."""
    raw = spark.read.text(paths, lineSep="\n>").select("value", F.col("_metadata.file_path").alias("path"))
    return split_records(raw, "path")


def read_hash_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A table whose header is the last line that begins with #, before its rows; short rows are filled with empty strings, longer ones cut."""
    lines = spark.read.text(path)
    top = [r.value for r in lines.limit(1000).collect() if r.value.startswith("#") and not r.value.startswith("##")]
    if not top:
        raise ValueError(f"{path} has no header")
    names = [n.strip() for n in top[-1].lstrip("#").split("\t")]
    fields = F.split("value", "\t", -1)
    rows = lines.where(~F.startswith("value", F.lit("#")) & (F.trim("value") != ""))
    return rows.select(*(F.coalesce(F.get(fields, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)))


def read_delimited(spark: SparkSession, path: str, sep: str = "auto") -> DataFrame:
    """A table with a header, all columns text; the separator, if not given, is that of tab, comma and semicolon which the header has most of. Compressed files too."""
    if sep == "auto":
        head = spark.read.text(path).limit(1).first()
        sep = max("\t,;", key=(head.value if head else "").count)
    return spark.read.csv(path, header=True, sep=sep, inferSchema=False)


def _flat(column: Column, kind: T.DataType, name: str, out: dict) -> None:
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            _flat(column[f.name], f.dataType, f"{name}.{f.name}" if name else f.name, out)
    elif isinstance(kind, T.ArrayType):
        text = F.transform(column, lambda x: F.to_json(x) if isinstance(kind.elementType, (T.StructType, T.ArrayType)) else x.cast("string"))
        out[name] = F.concat_ws(";", F.filter(text, lambda x: x.isNotNull() & (x != "")))
    else:
        out[name] = column.cast("string")


def flatten(df: DataFrame) -> DataFrame:
    """Nested columns as text, their names joined with dots; lists joined with ;."""
    out: dict[str, Column] = {}
    for f in df.schema.fields:
        _flat(F.col(f"`{f.name}`"), f.dataType, f.name, out)
    return df.select(*(c.alias(n) for n, c in out.items()))


def pick_features(flat: DataFrame, accession: Sequence[str], features: Mapping[str, Sequence[str]]) -> DataFrame:
    """(accession, <feature>...) of a flat table: of each feature the first of its names that has a value, names compared by letters and digits only; rows without a versioned assembly accession
    are left out, and of several rows of one the last counts, by their text."""
    bare = lambda n: "".join(c for c in n.lower() if c.isalnum())
    have = {bare(c): c for c in flat.columns}

    def pick(names: Sequence[str]) -> Column:
        found = [F.col(f"`{have[bare(n)]}`") for n in names if bare(n) in have]
        value = [F.when(~F.coalesce(F.trim(c), F.lit("")).isin("", "na", "NA"), F.trim(c)) for c in found]
        return F.coalesce(*value) if value else F.lit(None).cast("string")

    rows = flat.select(pick(accession).alias("accession"), *(pick(n).alias(k) for k, n in features.items())).where(F.col("accession").rlike(r"^GC[AF]_[0-9]+\.[0-9]+$"))
    return rows.groupBy("accession").agg(F.max(F.struct(*features)).alias("f")).select("accession", "f.*")


# The names under which an assembly's features stand in feature tables.
FEATURES = {
    "contig_n50": ("contig_n50", "assemblyStats.contigN50", "assmstats-contig-n50"),
    "scaffold_n50": ("scaffold_n50", "assemblyStats.scaffoldN50", "assmstats-scaffold-n50"),
    "sequencing_technology": ("sequencing_technology", "sequencing_tech", "assemblyInfo.sequencingTech", "assminfo-sequencing-tech"),
}
ACCESSIONS = ("assembly_accession", "accession", "current_accession", "assemblyInfo.accession")


def read_feature_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(accession, contig_n50, scaffold_n50, sequencing_technology) of JSON lines."""
    return pick_features(flatten(spark.read.json(path)), ACCESSIONS, FEATURES)


def read_taxdump(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """nodes (id, parent, rank) and scientific names (id, name)."""
    fields = F.transform(F.split(F.regexp_replace("value", r"\t?\|$", ""), r"\|"), lambda x: F.trim(x))
    clean = lambda name: spark.read.text(f"{folder}/{name}.dmp").select(F.transform(fields, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")).alias("f"))
    number = lambda i: F.get("f", F.lit(i)).try_cast("long")
    nodes = clean("nodes").where(F.size("f") >= 3).select(number(0).alias("id"), number(1).alias("parent"), F.get("f", F.lit(2)).alias("rank")).where("id is not null and parent is not null")
    names = clean("names").where((F.size("f") >= 4) & (F.get("f", F.lit(3)) == "scientific name")).select(number(0).alias("id"), F.get("f", F.lit(1)).alias("name")).where("id is not null")
    return nodes, names


def read_gbff(spark: SparkSession, paths: str | list[str], default_type: str = "") -> DataFrame:
    """(accession, accession_base, taxid, organism, organelle_type, definition, length, source_file) of each record of GenBank flat files that has a version."""
    raw = spark.read.text(paths, lineSep="//\n").select("value", F.col("_metadata.file_name").alias("source_file"))
    first = lambda p: F.regexp_extract("value", p, 1)
    organelle = F.lower(first('/organelle="([^"]+)"'))
    kind = F.when(F.contains(organelle, F.lit("mitochond")), "mitochondrion").when(F.contains(organelle, F.lit("plastid")) | F.contains(organelle, F.lit("chloroplast")), "plastid").otherwise(default_type)
    out = raw.select(first(r"(?m)^VERSION\s+(\S+)").alias("accession"), first(r'/db_xref="taxon:([0-9]+)').alias("taxid"), F.trim(first(r"(?m)^  ORGANISM(.*)$")).alias("organism"), kind.alias("organelle_type"), F.trim(first(r"(?m)^DEFINITION(.*)$")).alias("definition"), first(r"(?m)^LOCUS.*?\s([0-9]+)\s+bp").alias("length"), "source_file").where("accession <> ''")
    return out.withColumn("accession_base", F.substring_index("accession", ".", 1))


def init_metadata(fragments: DataFrame, resolved: Column | None = None) -> DataFrame:
    """fragments: (fragment_id, header, split, class). Returns record_id, split, legacy_class, species_taxid, split_group_id, euk_group, label_status of each: what its header tells, empty if nothing;
    euk_group by `resolved` if given. A eukaryote without a group is unresolved_euk."""
    tag = lambda *names: F.coalesce(*(F.nullif(F.element_at("_m", n), F.lit("")) for n in names), F.lit(""))
    df = fragments.withColumn("_m", F.transform_keys(parse_header(F.col("header")), lambda k, v: F.lower(k)))
    group = F.coalesce(resolved, F.lit("")) if resolved is not None else tag("euk_group")
    out = df.withColumn("euk_group", group).select(F.col("fragment_id").alias("record_id"), "split", F.col("class").alias("legacy_class"), tag("species_taxid", "taxid").alias("species_taxid"), tag("split_group_id").alias("split_group_id"), "euk_group")
    return out.withColumn("label_status", F.when((F.col("legacy_class") == "eukarya") & (F.col("euk_group") == ""), "unresolved_euk").otherwise("resolved"))


def export_by_class(df: DataFrame, chosen: DataFrame, path: str, cls: str = "klass", entity: str = "entity_id") -> None:
    """Tables of all rows and of the chosen ones, and the ids of the chosen ones, a folder for each class."""
    df.write.partitionBy(cls).mode("overwrite").csv(f"{path}/classes", sep="\t", header=True)
    chosen.write.partitionBy(cls).mode("overwrite").csv(f"{path}/selected", sep="\t", header=True)
    chosen.select(cls, F.col(entity).cast("string").alias("value")).write.partitionBy(cls).mode("overwrite").text(f"{path}/accessions")


def prediction_table(df: DataFrame, ids: Sequence[str], probabilities: Mapping[str, Column] = {}) -> DataFrame:  # noqa: B006
    """The ids, and probabilities as text with six decimals, empty where there are none."""
    return df.select(*ids, *(F.when(c.isNull(), "").otherwise(F.format_string("%.6f", c.cast("double"))).alias(n) for n, c in probabilities.items()))


def write_predictions(df: DataFrame, path: str, ids: Sequence[str], probabilities: Mapping[str, Column] = {}, compression: str = "gzip") -> None:  # noqa: B006
    prediction_table(df, ids, probabilities).write.mode("overwrite").csv(path, sep="\t", header=True, compression=compression)

