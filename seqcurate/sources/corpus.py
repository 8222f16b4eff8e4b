"""A corpus of FASTA by split and class, <root>/<split>/<class>.fasta: written so that it is whole or not there, read in one scan of the files asked for, long records in chunks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Class directories' other names.
CLASS_ALIASES = {"archea": "archaea", "plastid": "plastids", "mitochondrion": "mitochondria", "chloroplast": "plastids"}
_FORMS = "fasta,fa,fna"


def _path(spark: SparkSession, path: str):
    """A path of any file system that Spark knows, and that file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def found(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern matches, sorted."""
    at, system = _path(spark, pattern)
    return sorted(x.getPath().toString() for x in system.globStatus(at) or [])


def corpus_files(spark: SparkSession, root: str, splits: Sequence[str], classes: Sequence[str]) -> list[tuple[str, str, str]]:
    """(split, class, path) of <root>/<split>/<class>.fasta (or .fa, .fna, each also .gz), a file or a folder of parts, under a class's other names, too. A class that a split lacks is an error."""
    out = []
    for split in splits:
        have = found(spark, f"{root}/{split}/*.{{{_FORMS}}}*")
        for cls in classes:
            names = [cls, *(a for a, c in CLASS_ALIASES.items() if c == cls)]
            forms = [f"/{n}.{form}{gz}" for n in names for gz in ("", ".gz") for form in _FORMS.split(",")]
            path = next((p for form in forms for p in have if p.endswith(form)), None)
            if path is None:
                raise FileNotFoundError(f"{root}/{split} has no {cls}")
            out.append((split, cls, path))
    return out


def split_records(raw: DataFrame, *more: str | Column) -> DataFrame:
    """raw: value, a record each as lineSep="\\n>" leaves it. Returns fragment_id, header, sequence, bp and `more`."""
    text = F.regexp_replace("value", "^>", "")
    top = F.substring_index(text, "\n", 1)
    body = F.regexp_replace(F.substr(text, F.length(top) + 1), r"\s+", "")
    rows = raw.where(F.trim("value") != "").select(F.trim(top).alias("header"), body.alias("sequence"), *more)
    rest = [c for c in rows.columns if c not in ("header", "sequence")]
    return rows.select(F.regexp_extract("header", r"^\S*", 0).alias("fragment_id"), "header", "sequence", F.length("sequence").cast("long").alias("bp"), *rest)


def _placed(rows: DataFrame, files: list[tuple[str, str, str]]) -> DataFrame:
    """rows (path) with split and class, by the folder that the path lies in; a corpus has a few files, so this is an expression and no join."""
    split, cls = F.lit(None).cast("string"), F.lit(None).cast("string")
    for s, c, path in reversed(files):
        mine = F.contains("path", F.lit("/" + "/".join(path.split("/")[-2:])))
        split, cls = F.when(mine, s).otherwise(split), F.when(mine, c).otherwise(cls)
    return rows.withColumns({"split": split, "class": cls}).drop("path")


def read_corpus(spark: SparkSession, root: str, splits: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """(fragment_id, header, sequence, bp, split, class): one scan of the files of these splits and classes (see corpus_files), no others. Files that aren't compressed are split between tasks."""
    files = corpus_files(spark, root, splits, classes)
    raw = spark.read.option("recursiveFileLookup", True).text([p for _, _, p in files], lineSep="\n>").select("value", F.col("_metadata.file_path").alias("path"))
    return _placed(split_records(raw, "path"), files)


def _blocks(chunk: int, ends: bool):
    """Lines (value, path, block) of stretches of files, in order. Returns chunks (path, block, header, start, sequence): of each record the letters of about `chunk` at a time, start counted within
    the block; the header is null until the block's first one. With `ends` instead a row for each block: its last header, and the letters after it."""

    def row(path: str, block: int, header: str | None, start: int, parts: list[str]) -> tuple:
        return path, block, header, start, "".join("".join(parts).split())

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, header, start, parts, held = None, None, 0, [], 0
        for batch in batches:
            for value, path, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (path, block) != key:
                    if key:
                        yield row(*key, header, start, parts)
                    key, header, start, parts, held = (path, block), None, 0, [], 0
                if value.startswith(">"):
                    if header is not None or held:
                        yield row(*key, header, start, parts)
                    header, start, parts, held = value[1:].strip(), 0, [], 0
                else:
                    parts.append(value)
                    held += len(value)
                    if held >= chunk:
                        made = row(*key, header, start, parts)
                        yield made
                        start, parts, held = start + len(made[4]), [], 0
        if key:
            yield row(*key, header, start, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        names, some, size, last = ["path", "block", "header", "start", "sequence"], [], 0, None
        for made in chunks(batches):
            if ends:  # the last chunk of a block tells its end
                if last and last[:2] != made[:2]:
                    some.append(last)
                last = (*made[:3], made[3] + len(made[4]), "")
                continue
            some.append(made)
            size += len(made[4])
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names=names)
                some, size = [], 0
        some += [last] if last else []
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names=names)

    return run


def read_chunks(spark: SparkSession, paths: str | list[str], chunk: int = 1 << 20) -> DataFrame:
    """(fragment_id, header, start, sequence, path) of FASTA files: records in chunks of about `chunk` letters, `start` being the place of the first one in the record, from 0. A chromosome is never
    one row, nor one task's, if its file is not compressed. A record without letters has one empty chunk. Lines before the first header of a file are left out.

    Tasks read stretches of files, blocks. Where a block begins inside a record, the record's header and the letters so far are those of the blocks before; for this a first scan tells each block's
    last header and the letters after it, which the driver (a row for each block) runs through in order. The second scan gets them by broadcast."""
    lines = lambda: spark.read.option("recursiveFileLookup", True).text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    schema = "path string, block long, header string, start long, sequence string"
    told = sorted(lines().mapInArrow(_blocks(chunk, True), schema).drop("sequence").collect(), key=lambda r: (r["path"], r["block"]))
    carried, path, header, letters = [], None, None, 0
    for block in told:
        if block["path"] != path:
            path, header, letters = block["path"], None, 0
        carried.append((path, block["block"], header, letters))
        header, letters = (block["header"], block["start"]) if block["header"] is not None else (header, letters + block["start"])
    known = F.broadcast(spark.createDataFrame(carried, "path string, block long, _header string, _letters long"))
    rows = lines().mapInArrow(_blocks(chunk, False), schema).join(known, ["path", "block"])
    inside = F.col("header").isNull()
    rows = rows.where(~inside | (F.col("_header").isNotNull() & (F.col("sequence") != "")))
    head = F.coalesce("header", "_header")
    return rows.select(F.regexp_extract(head, r"^\S*", 0).alias("fragment_id"), head.alias("header"), (F.col("start") + F.when(inside, F.col("_letters")).otherwise(0)).alias("start"), "sequence", "path")


def fasta_lines(header: str = "header", seq: str = "sequence", width: int = 0) -> Column:
    """A record's text: > header, and the sequence, in lines of `width` letters if given."""
    body = F.rtrim(F.regexp_replace(F.col(seq), f"(.{{{width}}})", "$1\n")) if width else F.col(seq)
    return F.concat(F.lit(">"), F.col(header), F.lit("\n"), body)


def write_corpus(df: DataFrame, root: str, header: str = "header", seq: str = "sequence", width: int = 0) -> list[str]:
    """Writes <root>/<split>/<class>.fasta, each a folder of parts, and returns these paths; splits and classes without rows get none. What read_corpus reads, and any reader of FASTA that takes a folder's files.

    All parts are written beside the corpus first, in <root>/_writing-<id>, by the committer of Spark's writers, and only then moved, one rename for each split and class, so that a run that is broken off
    leaves the corpus as it was. A class that is written replaces the one there; others stay. Null headers and sequences are left out."""
    spark, draft = df.sparkSession, f"{root}/_writing-{uuid.uuid4().hex}"
    rows = df.where(F.col(header).isNotNull() & F.col(seq).isNotNull())
    rows.select("split", "class", fasta_lines(header, seq, width).alias("value")).write.partitionBy("split", "class").text(draft)
    out = []
    for path in found(spark, f"{draft}/split=*/class=*"):
        at, system = _path(spark, path)
        split, cls = (part.partition("=")[2] for part in path.split("/")[-2:])
        target, _ = _path(spark, f"{root}/{split}/{cls}.fasta")
        system.mkdirs(target.getParent())
        if system.exists(target):
            system.delete(target, True)
        if not system.rename(at, target):
            raise OSError(f"{path} could not be moved to {target.toString()}")
        out.append(target.toString())
    at, system = _path(spark, draft)
    system.delete(at, True)
    return out


def infer(spark: SparkSession, paths: Sequence[str], score: Callable[[DataFrame], DataFrame], sink: str, least: int = 0) -> tuple[DataFrame, DataFrame]:
    """(predictions, counts) of FASTA files, which are read once: score(df) adds columns to the records of at least `least` letters, written to `sink` as Parquet with their path; counts: records of each file, and in all (path null).

    paths: files, folders and patterns; a file that several of them name counts once, one without records has a count of 0. The counts are of the path column of what was written, not of another scan of the files."""
    files = sorted({p for path in paths for p in _files(spark, path)})
    if not files:
        raise FileNotFoundError(", ".join(paths))
    raw = spark.read.text(files, lineSep="\n>").select("value", F.col("_metadata.file_path").alias("path"))
    score(split_records(raw, "path").where(F.col("bp") >= least)).drop("sequence").write.parquet(sink)
    out = spark.read.parquet(sink)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    every = spark.createDataFrame([(f,) for f in files], "path string").select(plain(F.col("path")).alias("path"))
    counts = every.join(out.groupBy(plain(F.col("path")).alias("path")).agg(F.count(F.lit(1)).alias("records")), "path", "left").na.fill(0, ["records"])
    return out, counts.unionByName(counts.agg(F.lit(None).cast("string").alias("path"), F.sum("records").alias("records")))


def _files(spark: SparkSession, path: str) -> list[str]:
    """The files of a path: itself, or those below a folder, hidden ones aside."""
    out = []
    for name in found(spark, path):
        at, system = _path(spark, name)
        if system.getFileStatus(at).isDirectory():
            out += [f for f in _files(spark, f"{name}/*") if not f.rpartition("/")[2].startswith(("_", "."))]
        else:
            out.append(name)
    return out
