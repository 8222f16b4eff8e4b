"""Scalar expressions: composition, length bins, hashes and sampling, evidence and quality flags, scores on arrays."""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ids import clean
from .labels import lookup

# Terms that show a metagenome-assembled genome, a non-isolate source, and a third-generation technology; the first that occurs is told.
MAG_PHRASES = ("derived from metagenome", "metagenome-derived", "metagenome derived", "metagenome-assembled", "metagenome assembled genome")
NON_ISOLATE = ("derived from metagenome", "metagenome-assembled", "metagenome assembled", "metagenomic", "environmental sample", "single-cell", "single cell genome")
THIRD_GENERATION = ("pacbio", "pac bio", "smrt", "hifi", "sequel", "revio", "nanopore", "oxford nanopore", "promethion", "minion", "gridion")
TRUTHY = ("1", "true", "yes", "y", "mag")
# The kinds of a virus's genome, by what its group's name holds when only letters and digits are left.
VIRUS_GENOMES = {"dsdna": "dsDNA", "ssdna": "ssDNA", "dsrna": "dsRNA", "ssrna": "ssRNA", "retro": "retro"}
# Rank of an assembly's category and level.
CATEGORY_RANK = {"reference genome": 0, "representative genome": 1}
LEVEL_RANK = {"complete genome": 0, "chromosome": 1, "scaffold": 2, "contig": 3}


def number(col: Column, default: float | None = None) -> Column:
    """A double; the default for text that is none, and for NaN."""
    value = F.try_cast(F.trim(col.cast("string")), "double") if hasattr(F, "try_cast") else F.trim(col.cast("string")).try_cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(default).cast("double"))


def acgt_purity(seq: Column) -> Column:
    """Share of A, C, G and T of either case; 0 for an empty or null sequence."""
    n = F.length(seq)
    return F.when(n > 0, (n - F.length(F.translate(seq, "ACGTacgt", ""))) / n).otherwise(0.0)


def filter_quality(df: DataFrame, seq: str, min_len: int, min_purity: float, purity: str | None = None) -> DataFrame:
    """Rows of at least min_len letters and min_purity; `purity` names a column for it, so that it is computed once."""
    name = purity or "__purity"
    out = df.where(F.length(seq) >= min_len).withColumn(name, acgt_purity(F.col(seq))).where(F.col(name) >= min_purity)
    return out if purity else out.drop(name)


def composition(df: DataFrame, group: Sequence[str], seq: str, max_n: float, max_other: float) -> DataFrame:
    """Per group: bp, share of N, share of letters other than ACGTN, and whether both are within their limits."""
    up = F.upper(F.coalesce(F.col(seq), F.lit("")))
    parts = df.groupBy(*group).agg(F.sum(F.length(up)).alias("bp"), F.sum(F.length(F.regexp_replace(up, "[^N]", ""))).alias("n"), F.sum(F.length(F.regexp_replace(up, "[ACGTN]", ""))).alias("other"))
    n, other = (F.coalesce(F.try_divide(F.col(c), F.col("bp")), F.lit(0.0)) for c in ("n", "other"))
    return parts.select(*group, "bp", n.alias("n_fraction"), other.alias("other_fraction"), ((F.col("bp") > 0) & (n <= max_n) & (other <= max_other)).alias("ok"))


def length_bin(bp: Column, lengths: Sequence[int] = (1000, 2000, 3000, 5000, 10000), tolerance: int = 0, single: bool = True, min_cov: float = 0.95) -> Column:
    """L<n> within the tolerance of a fixed length; else VAR, or with single=False the geometric bin G<i> of ratio 1 / min_cov."""
    geometric = F.concat(F.lit("G"), F.floor(F.log(F.greatest(bp, F.lit(1))) / F.log(F.lit(1.0 / min_cov))).cast("string"))
    out = F.lit("VAR") if single else geometric
    for n in reversed(list(lengths)):
        out = F.when(F.abs(bp - n) <= tolerance, f"L{n}").otherwise(out)
    return out


def candidate_bins(bin_: Column) -> Column:
    """The bins to search for partners of a bin: its neighbours too, if it is geometric."""
    i = F.try_cast(F.substr(bin_, F.lit(2)), "int") if hasattr(F, "try_cast") else F.substr(bin_, F.lit(2)).try_cast("int")
    return F.when(F.startswith(bin_, F.lit("G")), F.transform(F.array(i - 1, i, i + 1), lambda x: F.concat(F.lit("G"), x.cast("string")))).otherwise(F.array(bin_))


def can_match(a: Column, b: Column, min_cov: float = 0.95) -> Column:
    """Whether two lengths allow a match that covers min_cov of both."""
    return (F.greatest(a, b) > 0) & (F.coalesce(F.try_divide(F.least(a, b), F.greatest(a, b)), F.lit(0.0)) >= min_cov)


def dedup_params(bin_: Column, min_id: float = 0.95, cov: float = 0.95, var_id: float = 0.95, var_cov: float = 0.95) -> Column:
    """struct(min_id, cov, cov_mode): mode 0 (both sides) for fixed bins, 5 (the shorter side) for VAR."""
    params = lambda i, c, m: F.struct(F.lit(i).alias("min_id"), F.lit(c).alias("cov"), F.lit(m).alias("cov_mode"))
    return F.when(bin_ == "VAR", params(var_id, var_cov, 5)).otherwise(params(min_id, cov, 0))


def range_bin(bp: Column, edges: Sequence[int] = (800, 1000, 1250, 1500, 1750, 2000, 2250, 2500)) -> Column:
    """<from>-<to> of the inclusive range that holds a length; `outside` if none does."""
    out = F.lit("outside")
    for lo, hi in zip(edges, edges[1:], strict=False):
        out = F.when(bp.between(lo, hi - 1), f"{lo}-{hi - 1}").otherwise(out)
    return out


def md5_number(col: Column) -> Column:
    """The first 32 bits of the md5 of a string, as a long."""
    return F.conv(F.substr(F.md5(col.cast("binary")), F.lit(1), F.lit(8)), 16, 10).cast("long")


def md5_fraction(col: Column) -> Column:
    return md5_number(col) / F.lit(float(1 << 32))


def hash_split(group: Column, pct: int, seed: int | str = 42, test_only: Column | None = None) -> Column:
    """struct(split, method): evaluation for pct of 100 hash values of "seed:group", else train; rows only for tests are forced."""
    held = md5_number(F.concat(F.lit(f"{seed}:"), group.cast("string"))) % 100 < pct
    by_hash = F.struct(F.when(held, "evaluation").otherwise("train").alias("split"), F.lit("hash_group").alias("method"))
    if test_only is None:
        return by_hash
    return F.when(test_only, F.struct(F.lit("evaluation").alias("split"), F.lit("forced_test_only").alias("method"))).otherwise(by_hash)


def val_split(key: Column, fraction: float, seed: int | str = 42) -> Column:
    """Whether a key falls into the validation share."""
    return md5_fraction(F.concat(F.lit(f"{seed}:"), key.cast("string"))) < fraction


def keep_by_id(id_: Column, rate: Column | float, seed: int | str = 42, how: str = "crc32") -> Column:
    """Deterministic sampling by the hash of "seed:id"; no row at a rate of 0 or less, all at 1 or more."""
    rate = rate if isinstance(rate, Column) else F.lit(float(rate))
    token = F.concat(F.lit(f"{seed}:"), id_.cast("string"))
    value = F.crc32(token.cast("binary")) if how == "crc32" else md5_number(token)
    return F.when(rate >= 1, True).when(rate <= 0, False).otherwise(value < (rate * float(1 << 32)).cast("long"))


def _prefix_of_crc(seed: int) -> bytes:
    """Four bytes whose CRC is the seed, so that the CRC of them and a text is the text's with that start value."""
    table = [zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)]
    top = {x >> 24: i for i, x in enumerate(table)}
    want, path = (seed & 0xFFFFFFFF) ^ 0xFFFFFFFF, []
    for _ in range(4):
        i = top[want >> 24]
        path.append(i)
        want = ((want ^ table[i]) << 8) & 0xFFFFFFFF
    state, out = 0xFFFFFFFF, bytearray()
    for i in reversed(path):
        out.append((state ^ i) & 0xFF)
        state = (state >> 8) ^ table[i]
    return bytes(out)


def keep_by_content(seq: Column, rate: Column | float, seed: int = 42, min_len: int = 0, min_purity: float = 0.0) -> Column:
    """Sampling by the CRC of the upper-case sequence, started with the seed, in millionths; shorter or impurer ones never."""
    rate = rate if isinstance(rate, Column) else F.lit(float(rate))
    token = F.concat(F.lit(bytearray(_prefix_of_crc(seed))), F.upper(seq).cast("binary"))
    gates = (F.length(seq) >= min_len) & (acgt_purity(seq) >= min_purity)
    return gates & ((rate >= 1) | ((rate > 0) & (F.crc32(token) % 1_000_000 < (rate * 1_000_000).cast("long"))))


def resolve_rate(cls: Column, rates: Mapping[str, float], uniform: float = 1.0, aliases: Mapping[str, str] | None = None) -> Column:
    """Rate of a class: its own, else the uniform one; the class's name may be an alias."""
    name = F.coalesce(lookup(F.lower(cls), dict(aliases)), F.lower(cls)) if aliases else F.lower(cls)
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for k, v in rates.items() for x in (k, float(v)))), name), F.lit(float(uniform))) if rates else F.lit(float(uniform))


def first_term(text: Column, terms: Sequence[str]) -> Column:
    """The first of the terms that a text contains, null if none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(*(F.when(F.contains(low, F.lit(t)), t) for t in terms))


def evidence(text: Column, kind: str, flag: Column | None = None) -> Column:
    """Evidence in free text, the first term found, null if none: `mag` (an explicit flag, a phrase, or the bare word), `non_isolate` or `third_generation`."""
    if kind == "third_generation":
        return first_term(text, THIRD_GENERATION)
    if kind == "non_isolate":
        return first_term(text, NON_ISOLATE)
    if kind != "mag":
        raise ValueError(f"unknown kind of evidence: {kind}")
    bare = F.when(F.lower(F.coalesce(text, F.lit(""))).rlike("(^|[^a-z])mag([^a-z]|$)"), "MAG")
    explicit = F.when(F.lower(F.trim(F.coalesce(flag.cast("string"), F.lit("")))).isin(*TRUTHY), "explicit_is_mag") if flag is not None else F.lit(None).cast("string")
    return F.coalesce(explicit, first_term(text, MAG_PHRASES), bare)


def reasons(*tests: tuple[Column, str | Column]) -> Column:
    """Array of the names of the tests that hold."""
    return F.filter(F.array(*(F.when(F.coalesce(test, F.lit(False)), name) for test, name in tests)), lambda x: x.isNotNull())


def passes_hard_filter(mag: Column, before: str | None = None, after: str | None = None, latest: bool = True, full: bool = True, exclude_mag: bool = False) -> Column:
    """Whether a row (entity_type, source, source_native_id, assembly_accession, ftp_path, version_status, genome_rep, seq_rel_date) passes; never null.

    Rows that are no assemblies pass. Of assemblies, those with MAG evidence fail if these are excluded; those of the genome portal pass if they have any id; the others
    need a versioned accession, a path, the latest version and full representation (rows that don't tell pass), and a date, if told, from `after` to the day before `before`
    (YYYY/MM/DD, compared as text)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    date = text("seq_rel_date")
    ncbi = text("assembly_accession").rlike(r"^GC[AF]_[0-9]+\.[0-9]+$") & ~text("ftp_path").isin("", "na")
    if latest:
        ncbi &= text("version_status").isin("", "latest")
    if full:
        ncbi &= F.lower(text("genome_rep")).isin("", "full")
    if before:
        ncbi &= (date == "") | (date < before)
    if after:
        ncbi &= (date == "") | (date >= after)
    portal = (text("source_native_id") != "") | (text("assembly_accession") != "")
    assembly = F.when(text("source").isin("jgi", "jgi_gold"), portal).otherwise(ncbi)
    if exclude_mag:
        assembly = mag.isNull() & assembly
    return F.when(text("entity_type") != "assembly", True).otherwise(assembly)


def hard_filter(df: DataFrame, mag: Column, before: str | None = None, after: str | None = None, latest: bool = True, full: bool = True, exclude_mag: bool = False) -> DataFrame:
    return df.where(passes_hard_filter(mag, before, after, latest, full, exclude_mag))


def quality_gates(min_size: float = 0, max_size: float = 0, levels: Sequence[str] = (), full: bool = True, max_contigs: float = 0, exclude_flagged: bool = True) -> Column:
    """Array of the reasons for which a genome fails; limits of 0 and an empty list are off, and a row without a size passes the minimum."""
    size, contigs, level = number(F.col("genome_size"), 0.0), number(F.col("contig_count"), 0.0), F.lower(clean(F.col("assembly_level")))
    tests = []
    if min_size:
        tests.append(((size != 0) & (size < min_size), "genome_too_small"))
    if max_size > 0:
        tests.append((size > max_size, "genome_too_large"))
    if levels:
        tests.append((level.isNotNull() & ~level.isin(*(x.lower() for x in levels)), "assembly_level"))
    if full:
        tests.append((F.lower(clean(F.col("genome_rep"))) != "full", "partial_genome_rep"))
    if max_contigs:
        tests.append((contigs > max_contigs, "too_many_contigs"))
    if exclude_flagged:
        tests.append((clean(F.col("excluded_from_refseq")).isNotNull(), "excluded_from_refseq"))
    tests.append((F.lower(clean(F.col("version_status"))).isin("replaced", "suppressed"), "version_status"))
    return reasons(*tests)


def virus_genome_type(group: Column) -> Column:
    bare = F.regexp_replace(F.lower(F.coalesce(group, F.lit(""))), "[^a-z0-9]+", "")
    return F.coalesce(*(F.when(F.contains(bare, F.lit(k)), v) for k, v in VIRUS_GENOMES.items()), F.lit("unknown"))


def virus_qc(accession: Column, taxid: Column, url: Column, group: Column, reported: Column, allowed: Sequence[str] = (), min_length: float = 0, require_taxid: bool = True) -> Column:
    """struct(genome_type, flags) of a virus sequence: its type, and the reasons for which its metadata fail."""
    kind, empty = virus_genome_type(group), lambda c: F.coalesce(c.cast("string"), F.lit("")) == ""
    length = number(reported, 0.0)
    tests = [(~F.coalesce(accession, F.lit("")).rlike(r"^[A-Z][A-Z0-9_]*[0-9]+(\.[0-9]+)?$"), F.lit("INVALID_ACCESSION"))]
    if require_taxid:
        tests.append((empty(taxid), F.lit("MISSING_TAXID")))
    tests.append((empty(url), F.lit("MISSING_DOWNLOAD_URL")))
    if allowed:
        tests.append((~kind.isin(*allowed), F.concat(F.lit("GENOME_TYPE_"), kind)))
    if min_length:
        tests.append(((length != 0) & (length < min_length), F.lit("REPORTED_GENOME_TOO_SHORT")))
    return F.struct(kind.alias("genome_type"), reasons(*tests).alias("flags"))


def size_class(hint: Column, kind: Column, small_mb: int = 20, medium_mb: int = 200) -> Column:
    """Download class: a virus segment is small; others go by size in bytes, medium if it is not known."""
    size, mb = number(hint, 0.0), 1024 * 1024
    by_size = F.when(size <= 0, "medium").when(size <= small_mb * mb, "small").when(size <= medium_mb * mb, "medium").otherwise("large")
    return F.when(kind == "viral_segment_fna", "small").otherwise(by_size)


def quality_order(anchor: Column | None = None, accession: str = "assembly_accession") -> list[Column]:
    """Sort columns, best genome first: anchors, category, level, full, not excluded, completeness falling, few contigs, newest, accession."""
    busco = number(F.col("busco_complete"), -1.0)
    date = F.try_cast(F.substr(F.regexp_replace(F.coalesce(F.col("seq_rel_date"), F.lit("")), "[^0-9]", ""), F.lit(1), F.lit(8)), "long") if hasattr(F, "try_cast") else F.substr(F.regexp_replace(F.coalesce(F.col("seq_rel_date"), F.lit("")), "[^0-9]", ""), F.lit(1), F.lit(8)).try_cast("long")
    order = [
        F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in CATEGORY_RANK.items() for x in kv)), F.lower(clean(F.col("refseq_category")))), F.lit(2)),
        F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in LEVEL_RANK.items() for x in kv)), F.lower(clean(F.col("assembly_level")))), F.lit(4)),
        (F.coalesce(F.lower(clean(F.col("genome_rep"))), F.lit("full")) != "full").cast("int"),
        clean(F.col("excluded_from_refseq")).isNotNull().cast("int"),
        F.when(F.coalesce(F.col("busco_complete").cast("string"), F.lit("")) != "", -busco).otherwise(0.0),
        number(F.col("contig_count"), 1e9),
        -F.coalesce(date, F.lit(0)),
        F.col(accession),
    ]
    return ([F.when(anchor, 0).otherwise(1)] if anchor is not None else []) + order


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Probabilities of an array of logits divided by the temperature."""
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp((x - top) / float(temperature)))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def log_sum_exp(logits: Column) -> Column:
    top = F.array_max(logits)
    return top + F.log(F.aggregate(F.transform(logits, lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x))


def argmax(values: Column) -> Column:
    """Place of the largest value, from 1; the first of equal ones."""
    return F.array_position(values, F.array_max(values)).cast("int")


def nll(logits: Column, y: Column) -> Column:
    """Negative log-likelihood of the class at place y (from 0)."""
    return log_sum_exp(logits) - F.element_at(logits, y + 1)


def binary_logits(logits: Column, positive: int) -> Column:
    """Two logits of many: log-sum-exp of the rest, and the positive class."""
    rest = F.filter(logits, lambda x, i: i != positive)
    return F.array(log_sum_exp(rest), F.element_at(logits, positive + 1))
