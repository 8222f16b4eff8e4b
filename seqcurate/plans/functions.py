"""Queries of the scalar functions and sources, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import sources
from ..functions import ids, labels, scalars
from ..operators import curate, plan, sampling, select
from ..operators.order import shared_folder
from ..streaming import score_stream, scored
from .standins import FR, G, fragments, genomes, table


def _scratch(spark) -> str:
    return f"{shared_folder(spark)}/written-{uuid.uuid4().hex}"


def f01_base_accession(spark, sf_dir):
    return genomes(spark, sf_dir).select("n", *(ids.base_accession(F.concat("assembly_accession", F.lit(".x.2")), how).alias(how) for how in ("first", "last", "numeric")))


_F02 = "'see ' || assembly_accession || '; nc_00' || cast(n as string) || '.1, xAB' || cast(100000 + n as string) || ' ' || sequence_accession || ' ' || assembly_accession"


def f02_extract_accessions(spark, sf_dir):
    return genomes(spark, sf_dir).select("n", F.array_join(ids.extract_accessions(F.expr(_F02)), ",").alias("found"))


def f03_accession_of(spark, sf_dir):
    g = genomes(spark, sf_dir)
    return g.select("n", ids.accession_of(F.concat("assembly_accession", F.lit("|7"))).alias("of_id"), ids.accession_of(F.concat(F.lit("/data/"), "assembly_accession", F.lit("_asm/x.fna"))).alias("of_path"))


def f04_class_from_meta(spark, sf_dir):
    return genomes(spark, sf_dir).select("n", labels.class_from_meta(F.col("label"), F.col("supergroup")).alias("class"))


def f05_class_from_group(spark, sf_dir):
    return genomes(spark, sf_dir).select("n", labels.class_from_group(F.col("source_group")).alias("class"))


def f06_stage1(spark, sf_dir):
    g = genomes(spark, sf_dir).select("n", labels.class_from_group(F.col("source_group")).alias("class"))
    return g.groupBy(labels.stage1_of(F.col("class")).alias("stage1")).agg(F.count(F.lit(1)).alias("genomes"))


def f07_euk_subclass(spark, sf_dir):
    pair = labels.euk_subclass(F.col("label"), F.col("supergroup"), F.when(F.col("n") % 4 == 0, F.col("source_group")))
    return genomes(spark, sf_dir).select("n", pair.alias("p")).select("n", "p.clade", "p.how")


def f08_stratum(spark, sf_dir):
    g = genomes(spark, sf_dir).withColumn("cls", F.coalesce(labels.class_from_meta(F.col("label"), F.col("supergroup")), F.lit("none")))
    g = g.withColumn("s", labels.stratum(F.col("cls"), F.col("label"), F.col("supergroup"), F.when(F.col("n") % 4 == 0, F.col("source_group"))))
    return g.groupBy("s.stratum", "s.how").agg(F.count(F.lit(1)).alias("genomes"))


def f09_hier_labels(spark, sf_dir):
    g = genomes(spark, sf_dir).withColumn("cls", labels.class_from_meta(F.col("label"), F.col("supergroup"))).where("cls is not null")
    return g.withColumn("h", labels.hier_labels(F.col("cls"), F.when(F.col("n") % 5 != 0, F.col("source_group")), "skip")).select("n", "h.root", "h.euk", "h.prok", "h.organelle")


_F10 = {"genome_type": "case n % 4 when 0 then 'Mitochondrion' when 1 then 'eukarya nuclear' when 2 then 'prokaryotic chromosome' else 'x' end", "domain": "case n % 5 when 0 then 'Bacteria' when 1 then 'Archaea' when 2 then 'Eukarya' else '' end", "taxonomy": "case n % 6 when 0 then 'Eukaryota; Fungi > Ascomycota, sp' when 1 then 'Metazoa|Chordata/Mammalia' when 2 then 'Viridiplantae; Chlorophyta ;' when 3 then 'nothing' when 4 then '' else 'Rhizaria;x;y' end"}


def f10_classify_external(spark, sf_dir):
    c = labels.classify_external(*(F.expr(_F10[k]) for k in ("genome_type", "domain", "taxonomy")))
    return genomes(spark, sf_dir).select("n", c.alias("c")).select("n", "c.*").withColumnRenamed("class", "cls")


def _mag():
    return scalars.evidence(F.concat_ws(" ", "excluded_from_refseq", "definition"), "mag", F.col("is_mag"))


def f11_evidence(spark, sf_dir):
    text = F.concat_ws(" ", "excluded_from_refseq", "definition")
    return genomes(spark, sf_dir).select("n", _mag().alias("mag"), scalars.evidence(text, "non_isolate").alias("non_isolate"), scalars.evidence(F.col("sequencing_technology"), "third_generation").alias("technology"))


_F12 = "case n % 7 when 0 then 'Mitochondrial genome' when 1 then 'a fungal plant' when 2 then 'CHLOROPLAST' when 3 then 'Archaea bacteria' when 4 then 'eukaryote' when 5 then 'viridiplantae' else 'x' end"


def f12_group_and_class(spark, sf_dir):
    return genomes(spark, sf_dir).select("n", labels.group_and_class(F.expr(_F12)).alias("g")).select("n", F.col("g.group").alias("grp"), F.col("g.class").alias("cls"))


def f13_hard_filter(spark, sf_dir):
    return scalars.hard_filter(genomes(spark, sf_dir), _mag(), before="2020/01/12", after="2005/01/01", exclude_mag=True).select("n")


def f14_quality_gates(spark, sf_dir):
    reasons = scalars.quality_gates(min_size=1_000_000, max_size=30_000_000, levels=("Complete Genome", "chromosome", "scaffold"), max_contigs=500)
    return genomes(spark, sf_dir).select("n", F.array_join(reasons, ",").alias("reasons"))


def f15_virus_qc(spark, sf_dir):
    v = scalars.virus_qc(F.col("sequence_accession"), F.col("taxid"), F.col("download_url"), F.col("virus_group"), F.col("virus_reported_genome_length"), ("dsDNA", "ssRNA", "dsRNA", "ssDNA"), 1000)
    return genomes(spark, sf_dir).select("n", v.alias("v")).select("n", "v.genome_type", F.array_join("v.flags", ",").alias("flags"))


def f18_composition(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("seq", F.translate(F.regexp_replace("text", "[^ -~]", "N"), "aeiouvwxyz", "ACGTNNNACG"))
    return scalars.composition(docs, ["lang"], "seq", 0.05, 0.65).select("lang", "bp", F.round("n_fraction", 6).alias("n_fraction"), F.round("other_fraction", 6).alias("other_fraction"), "ok")


def f20_candidate_bins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("bin", scalars.length_bin(F.col("n_chars"), tolerance=20, single=False))
    return docs.select("doc_id", F.array_join(scalars.candidate_bins(F.col("bin")), ",").alias("bins"), scalars.can_match(F.col("n_chars"), F.lit(2000)).alias("fits"))


def f21_dedup_params(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("bin", scalars.length_bin(F.col("n_chars"), tolerance=50))
    return docs.groupBy("bin").agg(F.count(F.lit(1)).alias("rows")).select("bin", "rows", scalars.dedup_params(F.col("bin"), var_cov=0.9).alias("p")).select("bin", "rows", "p.min_id", "p.cov", "p.cov_mode")


def f24_val_split(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(scalars.val_split(F.col("o_custkey"), 0.1).alias("held")).agg(F.count(F.lit(1)).alias("orders"), F.countDistinct("o_custkey").alias("customers"))


def f26_keep_by_content(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("dna", F.translate("text", "aeioumnrst", "ACGTACGTAC"))
    return docs.where(scalars.keep_by_content(F.col("dna"), 0.4, 42, 200, 0.5)).select("doc_id")


def f27_resolve_rate(spark, sf_dir):
    rate = scalars.resolve_rate(F.col("lang"), {"english": 0.25, "de": 0.5}, 0.75, {"en": "english"})
    return table(spark, sf_dir, "documents").groupBy("lang", rate.alias("rate")).agg(F.count(F.lit(1)).alias("rows"))


def f28_size_class(spark, sf_dir):
    return genomes(spark, sf_dir).select("n", scalars.size_class(F.when(F.col("n") % 9 > 0, F.col("source_file_size")), F.when(F.col("n") % 7 == 0, "viral_segment_fna").otherwise("genomic_fna")).alias("size_class"))


def f29_bucket(spark, sf_dir):
    g = genomes(spark, sf_dir)
    first = F.when(F.col("n") % 3 == 0, "organelle").otherwise(F.col("klass"))
    return g.groupBy(labels.bucket(first, F.when(F.col("n") % 2 == 0, "plastid")).alias("bucket")).agg(F.count(F.lit(1)).alias("records"))


def _corpus(spark, sf_dir):
    """documents written as a corpus of FASTA by split and class."""
    root = _scratch(spark)
    docs = fragments(spark, sf_dir).where("text is not null").withColumn("header", F.concat(F.col("doc_id").cast("string"), F.lit(" sg=x")))
    sources.write_corpus(docs.withColumn("sequence", F.regexp_replace("text", r"[^A-Za-z]", "N")), root, width=60)
    return root


def s01_fasta(spark, sf_dir):
    """documents written as FASTA by split and class, and read back."""
    back = sources.read_fasta(spark, [f"{_corpus(spark, sf_dir)}/*/*.fasta"])
    parts = F.regexp_extract("path", r"/([^/]*)/([^/]*)\.fasta/", 1).alias("split"), F.regexp_extract("path", r"/([^/]*)/([^/]*)\.fasta/", 2).alias("cls")
    return back.select(F.col("fragment_id").cast("long").alias("doc_id"), "bp", F.md5(F.col("sequence").cast("binary")).alias("digest"), *parts)


def s02_read_corpus(spark, sf_dir):
    """Two classes of one split of the corpus that s13 writes; other files are not read."""
    back = sources.read_corpus(spark, _corpus(spark, sf_dir), ["validation"], ["eukarya", "archaea"])
    return back.select(F.col("fragment_id").cast("long").alias("doc_id"), "split", F.col("class").alias("cls"), "bp", F.md5(F.col("sequence").cast("binary")).alias("digest"))


def s02_read_chunks(spark, sf_dir):
    """The whole corpus in chunks of 1,000 letters, put together again."""
    rows = sources.read_chunks(spark, f"{_corpus(spark, sf_dir)}/*/*.fasta", 1000)
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "sequence"))), lambda x: x["sequence"]), "")
    out = rows.groupBy("fragment_id", "header").agg(whole.alias("s"), F.max(F.col("start") + F.length("sequence")).alias("bp"), F.max(F.length("sequence")).alias("most"))
    return out.select(F.col("fragment_id").cast("long").alias("doc_id"), "header", "bp", (F.col("most") < 1060).alias("short"), F.md5(F.col("s").cast("binary")).alias("digest"))


def s13_write_corpus(spark, sf_dir):
    """What the corpus has of each split and class, after bacteria were written again without half of them."""
    root = _corpus(spark, sf_dir)
    half = fragments(spark, sf_dir).where("text is not null and class = 'bacteria' and doc_id % 2 = 0").withColumn("header", F.col("doc_id").cast("string"))
    sources.write_corpus(half.withColumnRenamed("text", "sequence"), root)
    back = sources.read_fasta(spark, [f"{root}/*/*.fasta"])
    back = back.select(F.regexp_extract("path", r"/([^/]*)/([^/]*)\.fasta/", 1).alias("split"), F.regexp_extract("path", r"/([^/]*)/([^/]*)\.fasta/", 2).alias("cls"), F.col("fragment_id").cast("long").alias("i"))
    return back.groupBy("split", "cls").agg(F.count(F.lit(1)).alias("records"), F.sum("i").alias("ids"))


def m15_infer_files(spark, sf_dir):
    """The corpus scored in one job, its files named twice; counts of each split and class, and in all."""
    root = _corpus(spark, sf_dir)
    gc = F.round(F.length(F.regexp_replace("sequence", "[^GCgc]", "")) / F.col("bp"), 6)
    out, counts = sources.infer(spark, [root, f"{root}/train/*.fasta"], lambda df: df.withColumn("gc", gc), f"{root}-scored", 100)
    at = lambda i: F.regexp_extract("path", r"/([^/]*)/([^/]*)\.fasta/", i)
    per_file = counts.groupBy(at(1).alias("split"), at(2).alias("cls")).agg(F.sum("records").alias("records"))
    sums = out.groupBy(at(1).alias("split"), at(2).alias("cls")).agg(F.round(F.sum("gc"), 4).alias("gc"))
    return per_file.join(sums, (per_file["split"].eqNullSafe(sums["split"])) & (per_file["cls"].eqNullSafe(sums["cls"])), "left").select(per_file["split"], per_file["cls"], "records", "gc")


def p01_score_stream(spark, sf_dir):
    """Documents that land in two drops are scored as they come; the stream is started three times, the second time before its batch was marked as done."""
    folder = _scratch(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gc = lambda df: df.select("doc_id", F.length("text").alias("n"), F.length(F.regexp_replace("text", "[^GCgc]", "")).alias("gc"))
    run = lambda: score_stream(spark, f"{folder}/in", "doc_id long, text string", gc, f"{folder}/out", f"{folder}/mark").awaitTermination()
    for k in range(2):
        docs.where(F.col("doc_id") % 2 == k).write.mode("append").parquet(f"{folder}/in")
        run()
    at, system = sources.corpus._path(spark, f"{folder}/mark/commits/1")
    system.delete(at, True)
    run()
    return scored(spark, f"{folder}/out")


def s03_hash_tsv(spark, sf_dir):
    """part written as a table with a # header and comments, and read back; its last column is missing in some rows."""
    path = _scratch(spark)
    line = F.when(F.col("p_partkey") % 5 == 0, F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name")).otherwise(F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", "p_type"))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("i"), line.alias("value"))
    head = rows.groupBy().agg(F.concat(F.lit("##  "), F.count(F.lit(1)).cast("string"), F.lit(" rows\n# key\tname\tkind")).alias("value"))
    head.coalesce(1).write.text(f"{path}/head")
    rows.select("value").write.text(f"{path}/rows")
    lines = spark.read.text(f"{path}/head").unionByName(spark.read.text(f"{path}/rows"))
    lines.coalesce(1).write.text(f"{path}/all")
    return sources.read_hash_tsv(spark, f"{path}/all").select(F.col("key").cast("long").alias("key"), "name", "kind")


def s04_delimited(spark, sf_dir):
    path = _scratch(spark)
    table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand").write.csv(path, sep=";", header=True, compression="gzip")
    return sources.read_delimited(spark, path).select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", "p_brand")


def s05_union_prefer(spark, sf_dir):
    g = genomes(spark, sf_dir).select("assembly_accession", "source", "n")
    other = g.where("n % 4 = 0").select(F.concat(F.substring_index("assembly_accession", ".", 1), F.lit(".9")).alias("assembly_accession"), F.when(F.col("n") % 8 == 0, "refseq").otherwise("genbank").alias("source"), "n", F.lit("second").alias("extra"))
    return select.union_prefer([g, other], "assembly_accession", F.col("source") == "refseq", "n").select("assembly_accession", "source", "extra")


def s06_aliases(spark, sf_dir):
    g = genomes(spark, sf_dir).select("n", F.col("species_taxid").alias("#Species_Taxid"), F.col("taxid").alias("TaxID"), F.col("host").alias("x"))
    return ids.resolve_aliases(g, {"species": ["species_taxid", "taxid"], "nothing": ["absent"]}).select("n", "species", "nothing")


def s07_feature_jsonl(spark, sf_dir):
    path = _scratch(spark)
    g = genomes(spark, sf_dir)
    nested = g.select("assembly_accession", F.struct(F.col("contig_n50").alias("contigN50"), F.struct(F.col("scaffold_n50").alias("deep")).alias("more")).alias("assemblyStats"), F.struct(F.array("sequencing_technology", F.lit("x")).alias("sequencingTech")).alias("assemblyInfo"))
    nested.write.json(path)
    return sources.read_feature_jsonl(spark, path)


def s08_taxdump(spark, sf_dir):
    """nation and region as a taxonomy dump, written and read back, with names."""
    path = _scratch(spark)
    n = table(spark, sf_dir, "nation")
    dump = lambda *cs: F.concat(F.concat_ws("\t|\t", *cs), F.lit("\t|")).alias("value")
    n.select(dump((F.col("n_nationkey") + 100).cast("string"), F.col("n_regionkey").cast("string"), F.lit("species"))).coalesce(1).write.text(f"{path}/nodes.dmp")
    n.select(dump((F.col("n_nationkey") + 100).cast("string"), "n_name", F.lit(""), F.when(F.col("n_nationkey") % 2 == 0, "scientific name").otherwise("synonym"))).coalesce(1).write.text(f"{path}/names.dmp")
    nodes, names = sources.read_taxdump(spark, path)
    return nodes.join(names, "id", "left").select("id", "parent", "rank", "name")


def s09_gbff(spark, sf_dir):
    path = _scratch(spark)
    g = genomes(spark, sf_dir).select(F.concat(F.lit("LOCUS       X"), F.col("n").cast("string"), F.lit("   "), F.col("contig_count"), F.lit(" bp  DNA\nDEFINITION  "), F.col("definition"), F.lit(".\nVERSION     NC_"), F.col("n").cast("string"), F.lit(".1\n  ORGANISM  "), F.col("organism_name"), F.lit('\n                     /organelle="'), F.when(F.col("n") % 3 == 0, "mitochondrion").when(F.col("n") % 3 == 1, "plastid:chloroplast").otherwise("x"), F.lit('"\n                     /db_xref="taxon:'), F.col("n").cast("string"), F.lit('"\n//')).alias("value"))
    g.write.text(path)
    return sources.read_gbff(spark, path, "none").select("accession", "accession_base", "taxid", "organism", "organelle_type", "definition", "length")


_HEADER = "'>' || assembly_accession || '|3 sg=' || supergroup || ' label=' || trim(label) || case when n % 3 = 0 then ' taxid=' || cast(n as string) else '' end || ' label=last'"


def s10_parse_header(spark, sf_dir):
    m = ids.parse_header(F.expr(_HEADER))
    return genomes(spark, sf_dir).select("n", m.alias("m")).select("n", F.element_at("m", "sg").alias("sg"), F.element_at("m", "label").alias("label"), F.element_at("m", "epoch").alias("epoch"), F.try_element_at("m", F.lit("taxid")).alias("taxid"))


_SEGMENTS = "'L:NC_00' || lpad(cast(n as string), 4, '0') || '.1/AB' || cast(100000 + n as string) || ' ; M:KX' || cast(200000 + n % 700 as string) || case when n % 6 = 0 then ';-' else '' end"


def s11_explode_segments(spark, sf_dir):
    g = genomes(spark, sf_dir).select("taxid", F.col("organism_name").alias("organism"), F.expr(_SEGMENTS).alias("segments"), F.col("n").alias("ordinal"))
    return curate.explode_segments(g).select("ordinal", "segment_no", "segment_name", "sequence_accession", "virus_genome_id", "is_refseq")


def s12_init_metadata(spark, sf_dir):
    g = genomes(spark, sf_dir).select(F.concat("assembly_accession", F.lit("|3")).alias("fragment_id"), F.expr(_HEADER).alias("header"), F.lit("train").alias("split"), F.col("klass").alias("class"), "n", "source_group")
    return sources.init_metadata(g, F.when(F.col("n") % 2 == 0, F.col("source_group"))).select("record_id", "split", "legacy_class", "species_taxid", "euk_group", "label_status")


def s14_export_by_class(spark, sf_dir):
    path, g = _scratch(spark), genomes(spark, sf_dir).select("entity_id", "klass", "organism_name", "n")
    sources.export_by_class(g, g.where("n % 3 = 0"), path)
    part = lambda name, reader: reader.groupBy("klass").agg(F.count(F.lit(1)).alias("rows")).withColumn("which", F.lit(name))
    csv = lambda name: spark.read.csv(f"{path}/{name}", sep="\t", header=True)
    return part("classes", csv("classes")).unionByName(part("selected", csv("selected"))).unionByName(part("accessions", spark.read.text(f"{path}/accessions")))


def s15_predictions(spark, sf_dir):
    path = _scratch(spark)
    e = table(spark, sf_dir, "labels")
    sources.write_predictions(e.withColumn("cls", F.when(F.col("quality") == 1, "good").otherwise("bad")), path, ["doc_id", "cls"], {"p": F.col("doc_id") / 7.0, "q": F.when(F.col("toxic") == 1, F.col("quality") / 3.0)})
    back = spark.read.csv(path, sep="\t", header=True)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "cls", F.col("p").cast("double").alias("p"), F.coalesce("q", F.lit("")).alias("q"))


def s16_plan_downloads(spark, sf_dir):
    manifest, pending = plan.plan_downloads(genomes(spark, sf_dir))
    return manifest.withColumn("reason", F.lit("")).unionByName(pending.select("entity_id", "reason"), allowMissingColumns=True)


def t02_chop_fixed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("dna", F.translate("text", "eaionrtshlduEAIONRTSHLDUè .,\n", "ACGTACGTACGTACGTACGTACGTACGTA"))
    return sampling.chop_fixed(docs, "doc_id", "dna", 100, overlap=20).groupBy("id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("start").cast("long").alias("starts"))


_LETTERS = ("eaionrtshlduEAIONRTSHLDUè .,\n", "ACGTACGTACGTACGTACGTACGTACGTA")


def _pieces(df):
    """What pieces of a record are: how many, their letters, places and first letters."""
    return df.groupBy("id").agg(F.count(F.lit(1)).alias("pieces"), F.sum(F.length("fragment")).alias("bp"), F.sum("start").cast("long").alias("starts"), F.min(F.substring("fragment", 1, 20)).alias("least"))


def t03_chop_varlen(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("dna", F.translate("text", *_LETTERS))
    return _pieces(sampling.chop_varlen(docs, "doc_id", "dna", 100, 400, 1.5))


def t04_chop_discrete(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("dna", F.translate("text", *_LETTERS))
    return _pieces(sampling.chop_discrete(docs, "doc_id", "dna", (50, 100, 250), (1, 2, 1), 0.2, 20))


def t05_presets(spark, sf_dir):
    """Pieces of three of the presets, one of each kind."""
    docs = table(spark, sf_dir, "documents").withColumn("dna", F.translate(F.repeat("text", 3), *_LETTERS))
    parts = [_pieces(sampling.chop_preset(docs, "doc_id", "dna", name)).withColumn("preset", F.lit(name)) for name in ("T2-fixed5k-3phase", "T5-v2b-logU3-15-cov2", "T6-v2c-equal-v3ov")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def t06_crop(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sampling.crop(F.col("doc_id").cast("string"), F.col("text")).alias("c")).where("c is not null").select("doc_id", "c.start", "c.length", "c.focused")


def t08_encode_bases(spark, sf_dir):
    tokens = sampling.encode_bases(F.col("text"), 5000)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(tokens, lambda x: x.cast("string")), "").alias("tokens"))


def t09_number_fragments(spark, sf_dir):
    return sampling.number_fragments(fragments(spark, sf_dir).select("accession", "doc_id"), "accession", ["doc_id"])


QUERIES = {k: v for k, v in list(globals().items()) if k[:1] in "fmpst" and k[1:3].isdigit()}

_EUK = "('euk', 'euk_nuclear', 'eukarya', 'eukaryota', 'eukaryote')"
_CLASS = f"""(case when lower(trim(supergroup)) in ('organelle-mito') then 'mitochondria' when lower(trim(supergroup)) = 'organelle-cp' then 'plastids' when lower(supergroup) like 'organelle-%' then null
    when lower(trim(label)) = 'virus' or lower(supergroup) = 'riboviria' then 'virus' when lower(trim(label)) = 'plastid' then 'plastids' when lower(trim(label)) in {_EUK} then 'eukarya'
    when lower(trim(label)) = 'bacteria' then 'bacteria' when lower(trim(label)) = 'archaea' then 'archaea' when lower(trim(label)) = 'prok' and lower(supergroup) = 'bacteria' then 'bacteria'
    when lower(trim(label)) = 'prok' and lower(supergroup) = 'archaea' then 'archaea' end)"""
_BY_GROUP = "(case source_group when 'fungi' then 'eukarya' when 'plant' then 'eukarya' when 'protozoa' then 'eukarya' when 'invertebrate' then 'eukarya' when 'vertebrate_mammalian' then 'eukarya' when 'mito' then 'mitochondria' when 'viral' then 'virus' end)"
_SUB_G = "(case when n % 4 = 0 then case source_group when 'fungi' then 'fungi' when 'plant' then 'land_plant' when 'protozoa' then 'other_protist' when 'invertebrate' then 'metazoa_invertebrate' when 'vertebrate_mammalian' then 'metazoa_vertebrate' end end)"
_SUB_S = "(case lower(supergroup) when 'host-mammalia' then 'metazoa_vertebrate' when 'sar-alveolata' then 'alveolata' when 'opisthokonta-fungi' then 'fungi' end)"
_AMB = "(case lower(supergroup) when 'archaeplastida' then 'algae' when 'opisthokonta-metazoa' then 'metazoa_invertebrate' end)"
_SUBS = f"""s as (select * exclude (clade), {_CLASS} as cls, {_SUB_G} as bg, {_SUB_S} as bs, {_AMB} as am from {G}),
    e as (select *, case when coalesce(cls, '') <> 'eukarya' then null when bg is not null then bg when bs is not null then bs when am is not null then null else 'eukarya_other' end as clade,
        case when coalesce(cls, '') <> 'eukarya' then 'not_eukaryotic' when bg is not null then 'group' when bs is not null then 'supergroup' when am is not null then 'ambiguous' else 'fallback' end as how from s)"""
_TEXT = "lower(excluded_from_refseq || ' ' || definition)"
MAG = f"""(case when lower(is_mag) = 'yes' then 'explicit_is_mag' when contains({_TEXT}, 'derived from metagenome') then 'derived from metagenome' when regexp_matches({_TEXT}, '(^|[^a-z])mag([^a-z]|$)') then 'MAG' end)"""
TECH = "(case when contains(lower(sequencing_technology), 'pacbio') then 'pacbio' when contains(lower(sequencing_technology), 'nanopore') then 'nanopore' end)"
_DNA2 = "translate(text, 'eaionrtshlduEAIONRTSHLDUè .,\n', 'ACGTACGTACGTACGTACGTACGTACGTA')"
_FRACTION = lambda what: f"('0x' || substr(md5('42:' || doc_id || ':{what}:' || i), 1, 8))::bigint / 4294967296.0::double"
_PIECES = "select doc_id as id, count(*) as pieces, sum(length(f))::bigint as bp, sum(st)::bigint as starts, min(substr(f, 1, 20)) as least from k group by doc_id"
_CLEAN = "k as (select doc_id, i, st, f from p where regexp_full_match(f, '[ACGT]+') qualify row_number() over (partition by doc_id, f order by i) = 1)"


def _FIXED(text, length, passes):
    return f"""with d as (select doc_id, {_DNA2.replace('text', text)} as s, length({text}) as n from documents),
        b as (select *, (('0x' || substr(md5('42:' || doc_id || ':' || j), 1, 8))::bigint % (least({length - 1}, n - {length}) + 1))::bigint as b from d, range({passes}) t(j) where n >= {length}),
        q as (select distinct doc_id, s, b + {length} * x as st from b, range(n // {length} + 1) u(x) where b + {length} * x + {length} <= n), p as (select doc_id, st as i, st, substr(s, st + 1, {length}) as f from q), {_CLEAN} """


def _VARLEN(text, low, high, coverage, log):
    size = f"floor(exp(ln({low}::double) + u1 * (ln(most::double) - ln({low}::double))))" if log else f"{low} + floor(u1 * (most - {low} + 1))"
    return f"""with d as (select doc_id, {_DNA2.replace('text', text)} as s, length({text}) as n from documents), e as (select *, least({high}, n) as most, floor(n * {coverage}::double)::bigint as want from d where n >= {low}),
        t as (select *, {_FRACTION('length')} as u1, {_FRACTION('start')} as u2 from e, range(4 * ceil(want / {low})::bigint + 64) r(i)), l as (select *, least(most, greatest({low}, {size}))::bigint as m from t),
        g as (select *, floor(u2 * (n - m + 1))::bigint as st from l), p as (select doc_id, i, st, want, substr(s, st + 1, m) as f from g where regexp_full_match(substr(s, st + 1, m), '[ACGT]+') qualify row_number() over (partition by doc_id, substr(s, st + 1, m) order by i) = 1),
        k as (select * from (select *, coalesce(sum(length(f)) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as before from p) where before < want) """


def _DISCRETE(text, lengths, weights, overlap, tail):
    total, at, cases = sum(weights), 0.0, ""
    for m, w in list(zip(lengths, weights, strict=True))[:-1]:
        at += w / total
        cases += f" when u < {at!r}::double then {m}"
    steps = " ".join(f"when {m} then {max(1, int(m * (1 - overlap)))}" for m in lengths)
    return f"""with d as (select doc_id, {_DNA2.replace('text', text)} as s, length({text}) as n from documents),
        t as (select *, {_FRACTION('length')} as u from d, range(n // {max(1, int(min(lengths) * (1 - overlap)))} + 1) r(i) where n > 0), c as (select *, case{cases} else {lengths[-1]} end as m from t), w as (select *, coalesce(sum(case m {steps} end) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0)::bigint as st from c),
        v as (select *, bool_or(least(m, n - st) < {tail}) over (partition by doc_id order by i rows unbounded preceding) as over from w), p as (select doc_id, i, st, substr(s, st + 1, m) as f from v where not over), {_CLEAN} """



SQL = {
    "f01_base_accession": f"select n, split_part(assembly_accession, '.', 1) as first, regexp_replace(assembly_accession || '.x.2', '\\.[^.]*$', '') as last, upper(assembly_accession || '.x') as numeric from {G}",
    "f02_extract_accessions": f"""with a as (select n, assembly_accession as x, 'NC_00' || n || '.1' as y, case when n % 10 = 0 then null else sequence_accession end as z from {G})
        select n, x || ',' || y || ',XAB' || (100000 + n) || case when z is null or z = y then '' else ',' || z end as found from a""",
    "f03_accession_of": f"select n, assembly_accession as of_id, assembly_accession as of_path from {G}",
    "f04_class_from_meta": f"select n, {_CLASS} as class from {G}",
    "f05_class_from_group": f"select n, {_BY_GROUP} as class from {G}",
    "f06_stage1": f"select case {_BY_GROUP} when 'eukarya' then 'eukarya' when 'mitochondria' then 'other' when 'virus' then 'other' end as stage1, count(*) as genomes from {G} group by 1",
    "f07_euk_subclass": f"with {_SUBS} select n, clade, how from e",
    "f08_stratum": f"""with {_SUBS} select case when cls = 'eukarya' then 'eukarya/' || coalesce(clade, am, 'eukarya_other') else coalesce(cls, 'none') end as stratum,
        case when cls = 'eukarya' then case when clade is not null then how when am is not null then 'ambiguous_sg_collapsed' else 'fallback' end else 'class' end as how, count(*) as genomes from e group by 1, 2""",
    "f09_hier_labels": f"""with s as (select *, {_CLASS} as cls from {G}), k as (select *, cls = 'eukarya' and n % 5 = 0 as gone from s where cls is not null)
        select n, case when gone then null when cls = 'eukarya' then 'eukarya' when cls in ('bacteria', 'archaea') then 'prokarya' when cls in ('mitochondria', 'plastids') then 'organelle' else 'virus' end as root,
        case when cls = 'eukarya' and not gone then source_group end as euk, case when cls in ('bacteria', 'archaea') then cls end as prok, case when cls in ('mitochondria', 'plastids') then cls end as organelle from k""",
    "f10_classify_external": f"""with a as (select n, {_F10['genome_type']} as gt, {_F10['domain']} as dm, n % 6 as t from {G}),
        c as (select *, coalesce(case gt when 'Mitochondrion' then 'mitochondria' when 'eukarya nuclear' then 'eukarya' end, case dm when 'Bacteria' then 'bacteria' when 'Archaea' then 'archaea' when 'Eukarya' then 'eukarya' end) as cls from a),
        k as (select *, case t when 0 then 'fungi' when 1 then 'metazoa_vertebrate' when 2 then 'algae' when 5 then 'other_protist' end as clade0, case t when 0 then 'fungi' when 1 then 'vertebrate_mammalian' when 2 then 'plant' when 5 then 'protozoa' end as group0 from c)
        select n, cls, case cls when 'eukarya' then 'eukarya' when 'bacteria' then 'bacteria' when 'archaea' then 'archaea' when 'mitochondria' then 'other' end as stage1, case when cls = 'eukarya' then coalesce(clade0, 'eukarya_other') end as clade,
        case when cls is null then 'unmapped' when cls = 'eukarya' then case when clade0 is null then 'fallback' else 'taxonomy_string' end end as how,
        case when cls = 'eukarya' then coalesce(group0, 'protozoa') else case cls when 'bacteria' then 'bacteria' when 'archaea' then 'archaea' when 'mitochondria' then 'mitochondrion' end end as group from k""",
    "f11_evidence": f"""select n, {MAG} as mag, case when contains({_TEXT}, 'derived from metagenome') then 'derived from metagenome' when contains({_TEXT}, 'single-cell') then 'single-cell' end as non_isolate, {TECH} as technology from {G}""",
    "f12_group_and_class": f"""select n, case n % 7 when 0 then 'mitochondrion' when 1 then 'fungi' when 2 then 'plastid' when 3 then 'bacteria' when 4 then 'jgi_eukaryota' when 5 then 'plant' else '' end as grp,
        case n % 7 when 0 then 'mitochondria' when 1 then 'nuclear_euk' when 2 then 'plastid' when 3 then 'bacteria' when 4 then 'nuclear_euk' when 5 then 'nuclear_euk' else '' end as cls from {G}""",
    "f13_hard_filter": f"""select n from {G} where entity_type <> 'assembly' or ({MAG} is null and case when source = 'jgi' then true else ftp_path not in ('', 'na') and version_status in ('', 'latest') and lower(genome_rep) in ('', 'full')
        and (seq_rel_date = '' or (seq_rel_date < '2020/01/12' and seq_rel_date >= '2005/01/01')) end)""",
    "f14_quality_gates": f"""with a as (select *, coalesce(try_cast(genome_size as double), 0) as s, lower(assembly_level) as l from {G})
        select n, array_to_string(list_filter([case when s <> 0 and s < 1000000 then 'genome_too_small' end, case when s > 30000000 then 'genome_too_large' end, case when l = 'contig' then 'assembly_level' end,
        case when genome_rep = 'Partial' then 'partial_genome_rep' end, case when contig_count::int > 500 then 'too_many_contigs' end, case when excluded_from_refseq <> '' then 'excluded_from_refseq' end,
        case when version_status = 'replaced' then 'version_status' end], lambda x: x is not null), ',') as reasons from a""",
    "f15_virus_qc": f"""with a as (select *, case p when 0 then 'dsDNA' when 1 then 'ssRNA' when 2 then 'dsRNA' when 3 then 'retro' when 4 then 'ssDNA' else 'unknown' end as genome_type from (select *, (virus_reported_genome_length::int // 100) % 7 as p from {G}))
        select n, genome_type, array_to_string(list_filter([case when n % 10 = 0 then 'INVALID_ACCESSION' end, case when taxid = '' then 'MISSING_TAXID' end, case when download_url = '' then 'MISSING_DOWNLOAD_URL' end,
        case when genome_type in ('retro', 'unknown') then 'GENOME_TYPE_' || genome_type end, case when virus_reported_genome_length::int < 1000 then 'REPORTED_GENOME_TOO_SHORT' end], lambda x: x is not null), ',') as flags from a""",
    "f18_composition": """with a as (select lang, upper(translate(regexp_replace(coalesce(text, ''), '[^ -~]', 'N', 'g'), 'aeiouvwxyz', 'ACGTNNNACG')) as s from documents), b as (select lang, sum(length(s))::bigint as bp, sum(length(regexp_replace(s, '[^N]', '', 'g'))) as x, sum(length(regexp_replace(s, '[ACGTN]', '', 'g'))) as y from a group by lang)
        select lang, bp, round(x / bp, 6) as n_fraction, round(y / bp, 6) as other_fraction, x / bp <= 0.05 and y / bp <= 0.65 as ok from b""",
    "f20_candidate_bins": """with a as (select doc_id, n_chars, (select 'L' || l from (select unnest([1000, 2000, 3000, 5000, 10000]) as l) where abs(n_chars - l) <= 20) as b, floor(ln(greatest(n_chars, 1)) / ln(1 / 0.95::double))::int as g from documents)
        select doc_id, coalesce(b, 'G' || (g - 1) || ',G' || g || ',G' || (g + 1)) as bins, least(n_chars, 2000) / greatest(n_chars, 2000) >= 0.95 as fits from a""",
    "f21_dedup_params": """with a as (select coalesce((select 'L' || l from (select unnest([1000, 2000, 3000, 5000, 10000]) as l) where abs(n_chars - l) <= 50), 'VAR') as bin from documents)
        select bin, count(*) as rows, 0.95::double as min_id, case when bin = 'VAR' then 0.9 else 0.95 end::double as cov, case when bin = 'VAR' then 5 else 0 end::int as cov_mode from a group by bin""",
    "f24_val_split": "select ('0x' || substr(md5('42:' || o_custkey), 1, 8))::bigint / 4294967296.0 < 0.1 as held, count(*) as orders, count(distinct o_custkey) as customers from orders group by 1",
    "f27_resolve_rate": "select lang, case lang when 'en' then 0.25 when 'de' then 0.5 else 0.75 end::double as rate, count(*) as rows from documents group by 1, 2",
    "f28_size_class": f"""select n, case when n % 7 = 0 then 'small' when n % 9 = 0 or n = 0 then 'medium' when n * 50000 <= 20 * 1048576 then 'small' when n * 50000 <= 200 * 1048576 then 'medium' else 'large' end as size_class from {G}""",
    "f29_bucket": f"select case when n % 6 = 0 then 'plastid' when n % 3 = 0 then 'organelle' else klass end as bucket, count(*) as records from {G} group by 1",
    "s01_fasta": f"select doc_id, length(text)::bigint as bp, md5(regexp_replace(text, '[^A-Za-z]', 'N', 'g')) as digest, split, class as cls from {FR} where text is not null",
    "s02_read_corpus": f"select doc_id, split, class as cls, length(text)::bigint as bp, md5(regexp_replace(text, '[^A-Za-z]', 'N', 'g')) as digest from {FR} where text is not null and split = 'validation' and class in ('eukarya', 'archaea')",
    "s02_read_chunks": f"select doc_id, doc_id || ' sg=x' as header, length(text)::bigint as bp, true as short, md5(regexp_replace(text, '[^A-Za-z]', 'N', 'g')) as digest from {FR} where text is not null",
    "s13_write_corpus": f"select split, class as cls, count(*) as records, sum(doc_id)::bigint as ids from {FR} where text is not null and (class <> 'bacteria' or doc_id % 2 = 0) group by all",
    "m15_infer_files": f"""with a as (select split, class as cls, length(regexp_replace(text, '[^GCgc]', '', 'g')) as g, length(text) as n from {FR} where text is not null), b as (select split, cls, count(*) filter (n >= 100) as records, sum(round(g / n, 6)) filter (n >= 100) as gc from a group by all)
        select split, cls, records::bigint as records, round(gc, 4) as gc from b union all select null, null, sum(records)::bigint, null from b""",
    "p01_score_stream": "select doc_id, length(text)::int as n, length(regexp_replace(text, '[^GCgc]', '', 'g'))::int as gc from documents",
    "s03_hash_tsv": "select p_partkey as key, p_name as name, case when p_partkey % 5 = 0 then '' else p_type end as kind from part",
    "s04_delimited": "select p_partkey, p_name, p_brand from part",
    "s05_union_prefer": f"""with u as (select assembly_accession, source, n, null as extra, 0 as t from {G} union all select split_part(assembly_accession, '.', 1) || '.9', case when n % 8 = 0 then 'refseq' else 'genbank' end, n, 'second', 1 from {G} where n % 4 = 0),
        r as (select *, row_number() over (partition by split_part(assembly_accession, '.', 1) order by source <> 'refseq', t, n) as i from u) select assembly_accession, source, extra from r where i = 1""",
    "s06_aliases": f"select n, coalesce(nullif(species_taxid, ''), nullif(taxid, '')) as species, null::varchar as nothing from {G}",
    "s07_feature_jsonl": f"select assembly_accession as accession, nullif(contig_n50, '') as contig_n50, null::varchar as scaffold_n50, case when sequencing_technology = '' then 'x' else sequencing_technology || ';x' end as sequencing_technology from {G}",
    "s08_taxdump": "select n_nationkey::bigint + 100 as id, n_regionkey::bigint as parent, 'species' as rank, case when n_nationkey % 2 = 0 then n_name end as name from nation",
    "s09_gbff": f"select 'NC_' || n || '.1' as accession, 'NC_' || n as accession_base, n::varchar as taxid, organism_name as organism, case n % 3 when 0 then 'mitochondrion' when 1 then 'plastid' else 'none' end as organelle_type, definition || '.' as definition, contig_count as length from {G}",
    "s10_parse_header": f"select n, supergroup as sg, 'last' as label, '' as epoch, case when n % 3 = 0 then n::varchar end as taxid from {G}",
    "s11_explode_segments": f"""with a as (select n, 'VGENOME:' || substr(sha1(taxid || chr(9) || organism_name || chr(9) || ({_SEGMENTS})), 1, 20) as g from {G}),
        s as (select n as ordinal, 0 as segment_no, 'L' as segment_name, 'NC_00' || lpad(n::varchar, 4, '0') || '.1' as sequence_accession, g from a union all select n, 1, 'M', 'KX' || (200000 + n % 700), g from a),
        r as (select *, row_number() over (partition by sequence_accession order by ordinal, segment_no) as i from s)
        select ordinal, segment_no, segment_name, sequence_accession, g as virus_genome_id, starts_with(sequence_accession, 'NC_') as is_refseq from r where i = 1""",
    "s12_init_metadata": f"""select assembly_accession || '|3' as record_id, 'train' as split, klass as legacy_class, case when n % 3 = 0 then n::varchar else '' end as species_taxid, case when n % 2 = 0 then source_group else '' end as euk_group,
        case when klass = 'eukarya' and n % 2 = 1 then 'unresolved_euk' else 'resolved' end as label_status from {G}""",
    "s14_export_by_class": f"""select klass, count(*) as rows, 'classes' as which from {G} group by klass union all select klass, count(*), 'selected' from {G} where n % 3 = 0 group by klass union all select klass, count(*), 'accessions' from {G} where n % 3 = 0 group by klass""",
    "s15_predictions": "select doc_id, case when quality = 1 then 'good' else 'bad' end as cls, round(doc_id / 7.0::double, 6) as p, case when toxic = 1 then printf('%.6f', quality / 3.0::double) else '' end as q from labels",
    "s16_plan_downloads": f"""with a as (select *, regexp_extract(rtrim(ftp_path, '/'), '[^/]*$') as d, source = 'jgi' and entity_type = 'assembly' as portal, entity_type = 'virus_sequence' as virus from {G}),
        f as (select *, case when source_filename <> '' then source_filename when virus then sequence_accession || '.fna' else regexp_extract(split_part(download_url, '?', 1), '[^/]*$') end as file,
          regexp_replace(case when source_native_id <> '' then source_native_id else 'E' || n end, '[^A-Za-z0-9_.-]', '_', 'g') as native from a),
        k as (select *, download_url <> '' and regexp_matches(file, '\\.fna(\\.gz)?$') as direct from f)
        select entity_id, case when virus then 'virus' else klass end as klass, case when virus then 'viral_segment_fna' else 'genomic_fna' end as file_type,
          case when virus or portal then download_url else regexp_replace(case when starts_with(ftp_path, 'http') then rtrim(ftp_path, '/') else 'https:' || ftp_path end, '/+$', '') || '/' || d || '_genomic.fna.gz' end as url,
          case when virus or portal then '' else regexp_replace(rtrim(ftp_path, '/'), '^https?://', 'ftp://') || '/' || d || '_genomic.fna.gz' end as backup_url,
          case when virus or portal then '' else case when starts_with(ftp_path, 'http') then rtrim(ftp_path, '/') else 'https:' || ftp_path end || '/md5checksums.txt' end as md5_url,
          case when virus then 'sequence/virus/' || sequence_accession when portal then 'jgi/' || native else 'assembly/' || d end as local_dir,
          case when virus or portal then file else d || '_genomic.fna.gz' end as filename, case when virus or portal then regexp_replace(file, '(_genomic)?\\.fna(\\.gz)?$', '') else d end as fna_stem,
          case when virus then 0 when portal then coalesce(nullif(source_file_size::bigint, 0), try_cast(genome_size_ungapped as bigint), try_cast(genome_size as bigint), 0)
            else coalesce(try_cast(genome_size_ungapped as bigint), try_cast(genome_size as bigint), source_file_size::bigint, 0) end::bigint as size_hint, '' as reason
        from k where (virus and download_url <> '') or (portal and direct) or (entity_type = 'assembly' and not portal)
        union all select entity_id, null, null, null, null, null, null, null, null, null, 'MISSING_DIRECT_FASTA_URL_OR_FILENAME' from k where portal and not direct""",
    "t02_chop_fixed": f"""with d as (select doc_id, {_DNA2} as s from documents), p as (select doc_id, i, substr(s, i::int + 1, 100) as f from d, range(0, length(s) - 99, 80) t(i)),
        k as (select doc_id, f, min(i) as start from p where regexp_matches(f, '^[ACGT]+$') group by all) select doc_id as id, count(*) as pieces, sum(start)::bigint as starts from k group by doc_id""",
    "t06_crop": """with d as (select doc_id, length(text)::int as n, least(2499, length(text))::int as most, ('0x' || substr(sha256('42|' || doc_id), 1, 16))::ubigint as t from documents),
        f as (select *, most >= 1250 and t % 1000000 < 500000 as focused from d where most >= 800), b as (select *, case when focused then 1250 else 800 end as low, least(most, case when focused then 1750 else 2499 end) as high from f),
        l as (select *, (low + (t >> 20) % (high - low + 1)::ubigint)::int as length from b) select doc_id, case when n = length then 0 else ((t >> 40) % (n - length + 1)::ubigint)::int end::int as start, length, focused from l""",
    "t08_encode_bases": """select doc_id, rpad(translate(regexp_replace(substr(coalesce(text, ''), 1, 5000), '[^ACGTUacgtu]', '4', 'g'), 'ACGTUacgtu', '0123301233'), 5000, '4') as tokens from documents""",
    "t03_chop_varlen": _VARLEN("text", 100, 400, 1.5, False) + _PIECES,
    "t04_chop_discrete": _DISCRETE("text", (50, 100, 250), (1, 2, 1), 0.2, 20) + _PIECES,
    "t05_presets": " union all ".join(f"select *, '{name}' as preset from ({sql} {_PIECES})" for name, sql in {
        "T2-fixed5k-3phase": _FIXED("repeat(text, 3)", 5000, 3),
        "T5-v2b-logU3-15-cov2": _VARLEN("repeat(text, 3)", 3000, 15000, 2.0, True),
        "T6-v2c-equal-v3ov": _DISCRETE("repeat(text, 3)", (1000, 2000, 3000, 5000, 10000), (1, 1, 1, 1, 1), 0.2, 500),
    }.items()),
    "t09_number_fragments": f"select accession, doc_id, accession || '|' || (row_number() over (partition by accession order by doc_id) - 1) as fragment_id from {FR}",
}
