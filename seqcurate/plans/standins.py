"""Stand-ins of the given tables for genomes, fragments, hits and scores: expressions that Spark and DuckDB read alike, so that a query and its SQL begin with the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: part as a table of genomes.
GENOME = {
    "n": "p_partkey",
    "entity_id": "'E' || cast(p_partkey as string)",
    "assembly_accession": "'GC' || case when p_partkey % 3 = 0 then 'F' else 'A' end || '_' || lpad(cast(p_partkey as string), 9, '0') || '.' || cast(p_size % 3 + 1 as string)",
    "paired_accession": "case when p_partkey % 3 = 0 then 'GCA_' || lpad(cast(p_partkey + 1 as string), 9, '0') || '.' || cast(p_size % 3 + 1 as string) else '' end",
    "paired_comparison": "case when p_partkey % 2 = 0 then 'identical' else 'different' end",
    "entity_type": "case when p_partkey % 17 = 0 then 'organelle' when p_partkey % 19 = 0 then 'virus_sequence' else 'assembly' end",
    "source": "case when p_size % 5 = 0 then 'jgi' when p_size % 2 = 0 then 'refseq' else 'genbank' end",
    "source_native_id": "case when p_size % 10 = 0 then '' else 'N:' || cast(p_partkey as string) end",
    "group_name": "lower(p_type)",
    "klass": "case when p_type = 'SMALL' then 'virus' when p_type = 'ECONOMY' then 'bacteria' else 'eukarya' end",
    "species_taxid": "case when p_partkey % 11 = 0 then '' else cast(p_partkey % 300 as string) end",
    "taxid": "case when p_partkey % 22 = 0 then '' else cast(p_partkey % 600 as string) end",
    "organism_name": "p_name",
    "genus_key": "p_brand",
    "family": "'F' || cast(p_partkey % 5 as string)",
    "clade": "p_type",
    "ftp_path": "case when p_partkey % 23 = 0 then 'na' else 'https://ftp.org/genomes/' || cast(p_partkey as string) || '_asm/' end",
    "version_status": "case p_partkey % 13 when 0 then 'replaced' when 1 then '' else 'latest' end",
    "genome_rep": "case p_partkey % 7 when 0 then 'Partial' when 1 then '' else 'Full' end",
    "seq_rel_date": "case when p_size = 7 then '' else '20' || lpad(cast(p_size % 25 as string), 2, '0') || '/0' || cast(p_size % 9 + 1 as string) || '/1' || cast(p_size % 10 as string) end",
    "excluded_from_refseq": "case when p_partkey % 29 = 0 then 'derived from metagenome' when p_partkey % 31 = 0 then 'many frameshifts' else '' end",
    "definition": "p_name || case when p_partkey % 37 = 0 then ' MAG bin' when p_partkey % 41 = 0 then ' magnet' when p_partkey % 47 = 0 then ' single-cell' else '' end",
    "is_mag": "case when p_partkey % 43 = 0 then 'Yes' else '' end",
    "refseq_category": "case p_size % 9 when 0 then 'reference genome' when 1 then 'representative genome' else 'na' end",
    "assembly_level": "case p_size % 4 when 0 then 'Complete Genome' when 1 then 'Chromosome' when 2 then 'Scaffold' else 'Contig' end",
    "contig_n50": "case when p_partkey % 4 = 0 then '' else cast(p_partkey * 1000 as string) end",
    "scaffold_n50": "case when p_partkey % 8 = 0 then '' else cast(p_partkey * 2000 as string) end",
    "sequencing_technology": "case p_size % 6 when 0 then 'PacBio RSII' when 1 then 'Oxford Nanopore; Illumina' when 2 then '' else 'Illumina' end",
    "genome_size": "case when p_partkey % 59 = 0 then '' else cast((p_partkey % 1000 + 1) * 40000 as string) end",
    "genome_size_ungapped": "case when p_partkey % 2 = 0 then '' else cast((p_partkey % 1000 + 1) * 39000 as string) end",
    "source_file_size": "cast(p_partkey * 50000 as string)",
    "gc_percent": "case when p_partkey % 61 = 0 then '' else cast(30 + p_size % 40 as string) end",
    "contig_count": "cast(p_partkey % 900 as string)",
    "busco_complete": "case when p_partkey % 6 = 0 then cast(p_size as string) else '' end",
    "relation_to_type_material": "case when p_partkey % 53 = 0 then 'assembly from type material' else '' end",
    "label": "case p_partkey % 9 when 0 then 'euk' when 1 then 'prok' when 2 then 'Bacteria ' when 3 then 'archaea' when 4 then 'organelle' when 5 then 'virus' when 6 then '' when 7 then 'plastid' else 'euk_nuclear' end",
    "supergroup": "case p_size % 13 when 0 then 'Archaeplastida' when 1 then 'Organelle-Mito' when 2 then 'organelle-cp' when 3 then 'organelle-xyz' when 4 then 'Host-Mammalia' when 5 then 'SAR-Alveolata' when 6 then 'Bacteria' when 7 then 'Archaea' when 8 then 'Riboviria' when 9 then 'Opisthokonta-Metazoa' when 10 then 'Kinetoplastida' when 11 then '' else 'Opisthokonta-Fungi' end",
    "source_group": "case p_partkey % 8 when 0 then 'fungi' when 1 then 'plant' when 2 then 'protozoa' when 3 then 'invertebrate' when 4 then 'vertebrate_mammalian' when 5 then 'mito' when 6 then 'viral' else 'other' end",
    "download_url": "case when p_partkey % 5 = 0 then '' else 'https://portal.org/f/' || cast(p_partkey as string) || '.fna.gz?x=1' end",
    "source_filename": "case when p_partkey % 7 = 0 then 'g' || cast(p_partkey as string) || '.fna' else '' end",
    "sequence_accession": "case when p_partkey % 10 = 0 then 'bad acc' else 'NC_' || lpad(cast(p_partkey as string), 6, '0') || '.1' end",
    "virus_group": "case p_size % 7 when 0 then 'dsDNA viruses, no RNA stage' when 1 then 'ssRNA viruses' when 2 then 'ds-RNA viruses' when 3 then 'Retro-transcribing' when 4 then 'ssDNA' else '' end",
    "virus_reported_genome_length": "cast(p_size * 100 as string)",
    "host": "case when p_size % 3 = 0 then 'human' else '' end",
}
#: documents as fragments: accession, class of the file, class and strata.
FRAGMENT = {
    "doc_id": "doc_id",
    "ordinal": "doc_id",
    "accession": "'GCA_' || lpad(cast(doc_id % 97 as string), 6, '0') || '.' || cast(doc_id % 3 + 1 as string)",
    "split": "case when doc_id % 10 < 7 then 'train' when doc_id % 10 < 9 then 'validation' else 'test' end",
    "class_hint": "case when doc_id % 21 = 0 then 'bundle' when doc_id % 5 = 0 then 'bacteria' else 'eukarya' end",
    "class": "case when doc_id % 33 = 0 then 'archaea' when doc_id % 5 = 0 then 'bacteria' else 'eukarya' end",
    "euk_group": "case doc_id % 11 when 0 then 'fungi' when 1 then 'plant' when 2 then 'algae' when 3 then 'vertebrate' when 4 then 'metazoa_invertebrate' when 5 then 'alveolata' when 6 then 'stramenopiles' when 7 then 'protist' when 8 then '' else 'nonsense' end",
    "species_taxid": "case when doc_id % 14 = 0 then '' else cast(doc_id % 211 as string) end",
    "split_group_id": "'SP_' || cast(doc_id % 401 as string)",
    "duplicate_cluster_id": "case when doc_id % 6 = 0 then '' else 'D' || cast(doc_id % 503 as string) end",
    "bp": "n_chars",
    "text": "text",
}
#: embeddings as logits of three classes, a residual, their truth, and the rest a row of a score table has.
LOGITS = {
    "vec_id": "vec_id",
    "y": "label % 3",
    "length": "800 + (vec_id * 37) % 5000",
    "grp": "vec_id % 23",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def of(spark: SparkSession, sf_dir: str, name: str, expressions: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(*(f"{e} as {n}" for n, e in expressions.items()))


def sql(name: str, expressions: dict[str, str]) -> str:
    return "(select " + ", ".join(f"{e} as {n}" for n, e in expressions.items()) + f" from {name})"


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of(spark, sf_dir, "part", GENOME)


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of(spark, sf_dir, "documents", FRAGMENT)


G, FR = sql("part", GENOME), sql("documents", FRAGMENT)
