"""Very many small files, whole: tasks list the folders and read the files, the driver sees neither names nor texts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.deploy import ship
from chatmill.sources.files import file_system, hadoop

# Names, files, and bytes of files that are handed on at a time.
NAMES, FILES, BYTES = 10_000, 1000, 8 << 20

HIDDEN = ("_", ".")


def listed(system, folder: str) -> Iterator[tuple[str, bool, bool]]:
    """(name, is a file, is a folder) of what is in a folder, one after the other where the file system can be walked so."""
    from pyarrow import fs

    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for entry in found:
                yield entry.name, entry.is_file(), entry.is_dir()
    else:
        for info in system.get_file_info(fs.FileSelector(folder)):
            yield info.base_name, info.type == fs.FileType.File, info.type == fs.FileType.Directory


def whole_text(system, path: str) -> str:
    """The text of a file; line ends as in text mode."""
    with system.open_input_stream(path) as stream:
        return stream.read().decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")


def known_folders(spark: SparkSession, folder: str) -> list[str] | None:
    """The folder, or the folders of a pattern, as tasks open them; None if pyarrow does not know the file system. No folder is an error."""
    fs, target = hadoop(spark, folder)
    found = [target] if fs.exists(target) else [s.getPath() for s in fs.globStatus(target) or []]
    if not found:
        raise FileNotFoundError(folder)
    whole = [fs.makeQualified(p).toString() for p in found]
    # Without its scheme a local path is taken as it is; in an address, %xx would be a character.
    whole = [p.removeprefix("file:") if p.startswith("file:/") else p for p in whole]
    try:
        for path in whole:
            file_system(path)
    except (OSError, ValueError, NotImplementedError):
        return None
    return whole


def _names(spark: SparkSession, folders: list[str], wanted: Callable[[str, bool, bool], bool]) -> DataFrame:
    """(`at`, `name`) of what is wanted (by name, is a file, is a folder) of that in the folders, `at` being the folder's number: a task lists a folder, and the names are dealt to all tasks."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                system, base = file_system(folders[at])
                held: list[str] = []
                for name, is_file, is_folder in listed(system, base):
                    if wanted(name, is_file, is_folder):
                        held.append(name)
                    if len(held) == NAMES:
                        yield pa.RecordBatch.from_arrays([pa.array([at] * len(held), pa.int64()), pa.array(held, pa.string())], ["at", "name"])
                        held = []
                yield pa.RecordBatch.from_arrays([pa.array([at] * len(held), pa.int64()), pa.array(held, pa.string())], ["at", "name"])

    numbers = spark.range(0, len(folders), 1, len(folders)).mapInArrow(names, "at long, name string")
    # The number of tasks is given, since names are too short to tell how much work they stand for.
    return numbers.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("at"), F.col("name"))


def small_files(spark: SparkSession, folders: dict[str, str], suffix: str, inside: bool = False, without: str | None = None) -> DataFrame:
    """(`label`, `sample`, `file`, `text`) of the files that end in `suffix` and lie in one of the `folders` (address: label), or, `inside`, in a folder in one of them; files with `without` in their name are left alone.

    `sample` is the name of that inner folder. Names that begin with _ or a point count as others do; of the files without a text only they give a row, as
    Spark's reader passes over empty files. A task lists a folder of `folders` and hands on names; these are dealt to all tasks, which list inner folders and read files.
    """
    ship(spark)
    places = list(folders.items())

    def wanted(file: str) -> bool:
        return file.endswith(suffix) and (without is None or without not in file)

    def found(system, base: str, name: str) -> Iterator[tuple[str, str]]:
        if not inside:
            yield "", name
            return
        for file, is_file, _ in listed(system, f"{base}/{name}"):
            if is_file and wanted(file):
                yield name, file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, str, str, str]] = []
        size = 0

        def out() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["label", "sample", "file", "text"])

        opened = [file_system(path) for path, _ in places]
        for batch in batches:
            for at, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, base = opened[at][0], opened[at][1].rstrip("/")
                for sample, file in found(system, base, name):
                    text = whole_text(system, f"{base}/{sample}/{file}" if inside else f"{base}/{file}")
                    if not text and not file.startswith(HIDDEN) and not sample.startswith(HIDDEN):
                        continue
                    rows.append((places[at][1], sample, file, text))
                    size += len(text)
                    if len(rows) == FILES or size >= BYTES:
                        yield out()
                        rows, size = [], 0
        yield out()

    dealt = _names(spark, [path for path, _ in places], lambda name, is_file, is_folder: is_folder if inside else is_file and wanted(name))
    return dealt.mapInArrow(read, "label string, sample string, file string, text string")


def empty_files(spark: SparkSession, folders: list[str]) -> None:
    """Empty the files that lie in a folder in one of the `folders` (addresses that pyarrow knows), in tasks: what they hold is freed, names and folders stay.

    Files that were removed instead would slow down the next ones to be made: a file system without a journal looks past all that went in the last minutes, for each.
    """
    ship(spark)

    def empty(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = [file_system(path) for path in folders]
        for batch in batches:
            for at, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, base = opened[at][0], opened[at][1].rstrip("/")
                for file, is_file, _ in listed(system, f"{base}/{name}"):
                    if is_file:
                        system.open_output_stream(f"{base}/{name}/{file}").close()
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int32())], ["n"])

    _names(spark, folders, lambda name, is_file, is_folder: is_folder).mapInArrow(empty, "n int").write.format("noop").mode("overwrite").save()
