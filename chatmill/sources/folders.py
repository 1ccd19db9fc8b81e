"""Samples kept as files: paired documents and one folder per sample."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.operators.pairing import pair_folders
from chatmill.sources.files import hadoop, path_exists
from chatmill.sources.hidden import hidden_files
from chatmill.sources.small_files import known_folders, small_files

# Language folders, and the mark of files that only describe a sample.
LANGUAGES = ("de", "en")
METADATA_MARK = "_metadata"


# A file system's name at the start of a path.
_SYSTEM = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _decoded(part: Column) -> Column:
    """A part of a file path as the file system has it: Spark gives %xx for some characters, and a plus sign as it is."""
    return F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))


def _files(spark: SparkSession, paths: list[str], suffix: str, depth_below: bool) -> DataFrame:
    """(`path`, `file`, `text`) of the files with a suffix; one row per file. Line ends are read as in text mode: all become \\n."""
    reader = spark.read.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", depth_below)
    return reader.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"),
        _decoded(F.col("_metadata.file_name")).alias("file"),
        F.regexp_replace("value", "\r\n?", "\n").alias("text"),
    )


def _qualified(spark: SparkSession, path: str) -> str:
    """The path from the root of its file system, whatever form it is given in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target)
    return re.sub(_SYSTEM, "", whole.toString())


def _any(spark: SparkSession, patterns: list[str]) -> bool:
    """Whether there is a path of one of the patterns."""
    for pattern in patterns:
        fs, target = hadoop(spark, pattern)
        if fs.globStatus(target):
            return True
    return False


def read_documents(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(documents, Q&A texts) of a flat folder as (`stem`, `content`) and (`stem`, `qa_text`).

    Names are listed and files read by tasks. Where pyarrow does not know the file system Spark's reader lists them on the driver; files whose names
    begin with _ or a point, which it passes over, are then read by a source of their own where there are any.
    """
    known = known_folders(spark, folder)

    def side(suffix: str, name: str) -> DataFrame:
        stem = F.substring("file", F.lit(1), F.length("file") - len(suffix))
        if known is not None:
            files = small_files(spark, dict.fromkeys(known, ""), suffix)
            return files.select(stem.alias("stem"), F.col("text").alias(name))
        files = _files(spark, [folder], suffix, False)
        if _any(spark, [f"{folder.rstrip('/')}/[_.]*{suffix}"]):
            files = files.unionByName(hidden_files(spark, [folder], suffix))
        return files.select(stem.alias("stem"), F.col("text").alias(name))

    return side(".md", "content"), side(".txt", "qa_text")


def read_sample_folders(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, rejects) of a tree with one folder per sample, keyed by (`lang`, `sample`).

    If the root holds language folders only those are read and name the `lang`; else the root's own
    sub-folders are the samples and `lang` is ''. Files at other depths are left alone. Names that begin with _ or a point count as others do.
    """
    root = root.rstrip("/")
    langs = [lang for lang in LANGUAGES if path_exists(spark, f"{root}/{lang}")]
    below = F.split("path", "/")
    lang = F.element_at(below, -3) if langs else F.lit("")
    base = [f"{root}/{lang}" for lang in langs] or [root]
    depth = len([p for p in _qualified(spark, base[0]).split("/") if p]) + 2
    known = [known_folders(spark, b) for b in base]

    def side(suffix: str, name: str) -> DataFrame:
        if None not in known:
            folders = {path: label for label, paths in zip(langs or [""], known, strict=True) for path in paths}
            files = small_files(spark, folders, suffix, inside=True, without=METADATA_MARK if suffix == ".json" else None)
            return files.select(F.col("label").alias("lang"), "sample", "file", F.col("text").alias(name))
        tail = F.size(F.filter(F.split(F.regexp_replace("path", _SYSTEM, ""), "/"), lambda p: p != ""))
        named = [lang.alias("lang"), _decoded(F.element_at(below, -2)).alias("sample"), "file", F.col("text").alias(name)]
        files = _files(spark, base, suffix, True).filter(tail == depth).select(*named)
        if _any(spark, [f"{b}/{p}{suffix}" for b in base for p in ("[_.]*/*", "*/[_.]*")]):
            # The names of this source are those of the file system, not parts of an address.
            plain = [lang.alias("lang"), F.element_at(below, -2).alias("sample"), "file", F.col("text").alias(name)]
            files = files.unionByName(hidden_files(spark, base, suffix, depth=1).select(*plain))
        return files.filter(~F.col("file").contains(METADATA_MARK) | F.lit(suffix != ".json"))

    return pair_folders(side(".md", "cv_text"), side(".json", "json_text"), ["lang", "sample"])
