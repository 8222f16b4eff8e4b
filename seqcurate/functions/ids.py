"""Identifiers: accessions, header metadata and alias columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The forms of accessions, with or without a version: of assemblies, of curated sequences, of others.
ASSEMBLY = r"GC[AF]_[0-9]+(?:\.[0-9]+)?"
CURATED = r"(?:NC|NW|NZ|NT|NG|NM|NR|XM|XR|NP|YP|WP)_[0-9]+(?:\.[0-9]+)?"
OTHER = r"[A-Z]{1,4}[0-9]{5,}(?:\.[0-9]+)?"


def base_accession(col: Column, how: str = "first") -> Column:
    """An accession without its version: up to the `first` or the `last` dot, or, `numeric`, without a final number, in upper case."""
    if how == "first":
        return F.substring_index(col, ".", 1)
    if how == "last":
        return F.regexp_replace(col, r"\.[^.]*$", "")
    if how == "numeric":
        return F.upper(F.regexp_replace(F.trim(col), r"\.[0-9]+$", ""))
    raise ValueError(f"unknown way to cut a version: {how}")


def extract_accessions(col: Column) -> Column:
    """All accessions in free text, distinct, in the order in which they stand, in upper case; a text that begins with a portal's name is one id if it holds none."""
    text = F.upper(F.trim(F.coalesce(col, F.lit(""))))
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?<![A-Z0-9])({ASSEMBLY}|{CURATED}|{OTHER})(?![A-Z0-9])"), F.lit(1)))
    portal = (F.size(found) == 0) & (F.startswith(text, F.lit("JGI:")) | F.startswith(text, F.lit("IMG:")))
    return F.when(portal, F.array(text)).otherwise(found)


def accession_of(col: Column) -> Column:
    """The accession that a fragment id or a file path carries: the part of an id before its first bar, or what a path holds of that form."""
    found = F.regexp_extract(col, ASSEMBLY, 0)
    return F.when(F.contains(col, F.lit("/")) & (found != ""), found).otherwise(F.substring_index(col, "|", 1))


def clean(col: Column) -> Column:
    """A trimmed string; null for the markers of a missing value."""
    text = F.trim(col.cast("string"))
    return F.when(~F.lower(text).isin("", "na", "n/a"), text)


def parse_header(col: Column) -> Column:
    """The key=value words of a FASTA header as a map; sg, label and epoch are empty if absent, and of a repeated key the last counts."""
    pairs = F.filter(F.split(F.regexp_replace(col, "^>", ""), r"\s+"), lambda x: F.contains(x, F.lit("=")))
    keys = F.transform(pairs, lambda x: F.substring_index(x, "=", 1))
    last = F.filter(pairs, lambda x, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), F.substring_index(x, "=", 1)))
    own = F.map_from_entries(F.transform(last, lambda x: F.struct(F.substring_index(x, "=", 1).alias("key"), F.regexp_replace(x, "^[^=]*=", "").alias("value"))))
    absent = F.filter(F.array(F.lit("sg"), F.lit("label"), F.lit("epoch")), lambda k: ~F.array_contains(keys, k))
    return F.map_concat(own, F.map_from_entries(F.transform(absent, lambda k: F.struct(k.alias("key"), F.lit("").alias("value")))))


def resolve_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """df with a column for each canonical name: the first of its aliases' columns that is not empty, null if there is none.

    Column names are compared without case, a leading # and surrounding space; other columns stay."""
    have = {c.strip().lstrip("#").strip().lower(): c for c in reversed(df.columns)}
    new = {}
    for name, others in aliases.items():
        found = [have[x.lower()] for x in others if x.lower() in have]
        new[name] = F.coalesce(*(F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in found)) if found else F.lit(None).cast("string")
    return df.withColumns(new)
