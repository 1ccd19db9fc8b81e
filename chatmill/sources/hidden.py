"""Files whose names, or whose folder's names, begin with _ or a point: Spark's own file readers pass over them, this source reads them."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from chatmill.sources.files import file_system

# Bytes of files that a task reads one after the other, and files at most.
TASK_BYTES, TASK_FILES = 32 << 20, 1000

SCHEMA = "path string, file string, text string"


@dataclass
class FileGroup(InputPartition):
    paths: tuple[str, ...]


class HiddenFilesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.roots = json.loads(options["roots"])
        self.suffix, self.depth = options["suffix"], int(options.get("depth", "0"))

    def _found(self) -> Iterator[tuple[str, int]]:
        """Paths and sizes, from listing the folders; no file is opened."""
        from pyarrow import fs

        for root in self.roots:
            system, base = file_system(root)
            for info in system.get_file_info(fs.FileSelector(base, recursive=self.depth > 0, allow_not_found=True)):
                below = info.path[len(base.rstrip("/")) + 1 :].split("/")
                hidden = any(part[:1] in ("_", ".") for part in below)
                if info.type == fs.FileType.File and hidden and len(below) == self.depth + 1 and below[-1].endswith(self.suffix):
                    yield f"{root.rstrip('/')}/{'/'.join(below)}", info.size

    def partitions(self) -> list[InputPartition]:
        groups: list[list[str]] = [[]]
        held = 0
        for path, size in sorted(self._found()):
            if groups[-1] and (held + size > TASK_BYTES or len(groups[-1]) >= TASK_FILES):
                groups.append([])
                held = 0
            groups[-1].append(path)
            held += size
        return [FileGroup(tuple(g)) for g in groups]

    def read(self, partition: FileGroup) -> Iterator[tuple[str, str, str]]:
        for path in partition.paths:
            system, inside = file_system(path)
            with system.open_input_stream(inside) as stream:
                text = stream.read().decode("utf-8", "replace")
            yield path, path.rpartition("/")[2], text.replace("\r\n", "\n").replace("\r", "\n")


class HiddenFiles(DataSource):
    """Whole text files below `roots` (a JSON list), `depth` folders down, that end in `suffix` and have a hidden part in their path below the root."""

    @classmethod
    def name(cls) -> str:
        return "hidden_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return HiddenFilesReader(self.options)


def hidden_files(spark: SparkSession, roots: list[str], suffix: str, depth: int = 0) -> DataFrame:
    """(`path`, `file`, `text`) of the hidden files; line ends as in text mode. The file systems are those that pyarrow knows."""
    from chatmill.deploy import ship

    ship(spark).dataSource.register(HiddenFiles)
    return spark.read.format("hidden_files").options(roots=json.dumps(roots), suffix=suffix, depth=str(depth)).load()
