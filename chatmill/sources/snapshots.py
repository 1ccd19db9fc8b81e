"""Tables kept in versions: readers find a whole table at any time, also while the next version is being written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatmill.sources.files import names_in, put_new, remove, text_of

POINTERS = "_current"


def _numbers(names: list[str], prefix: str = "") -> list[int]:
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit())


def current_version(spark: SparkSession, folder: str) -> int | None:
    """Number of the newest whole version; None before the first."""
    return max(_numbers(names_in(spark, f"{folder.rstrip('/')}/{POINTERS}")), default=None)


def note_of(spark: SparkSession, folder: str) -> str | None:
    """The note that came with the current version; None before the first."""
    number = current_version(spark, folder)
    return None if number is None else text_of(spark, f"{folder.rstrip('/')}/{POINTERS}/{number}")


def point(spark: SparkSession, folder: str, note: str, keep: int = 3) -> int:
    """A version that is a note alone, such as up to where a growing table counts; returns its number."""
    folder = folder.rstrip("/")
    numbers = _numbers(names_in(spark, f"{folder}/{POINTERS}"))
    number = max(numbers, default=0) + 1
    if not put_new(spark, f"{folder}/{POINTERS}/{number}", note):
        raise RuntimeError(f"another writer made version {number} of {folder}")
    for old in numbers[: max(0, len(numbers) - keep + 1)]:
        remove(spark, f"{folder}/{POINTERS}/{old}")
    return number


def publish(df: DataFrame, folder: str, keep: int = 3) -> int:
    """Write `df` as the next version of the table in `folder`, make it the current one, and return its number.

    A version is a folder `v=<n>`; it counts from the moment its pointer, a small file named by the number, is there, which is one step.
    A writer that dies leaves a version without a pointer, which nobody reads. Of two writers of the same number one fails. The last `keep` whole
    versions stay, so a reader may take as long as `keep - 1` later versions need.
    """
    if keep < 2:
        raise ValueError("keep at least 2 versions, one for the readers of the last")
    spark, folder = df.sparkSession, folder.rstrip("/")
    whole = _numbers(names_in(spark, f"{folder}/{POINTERS}"))
    begun = _numbers(names_in(spark, folder), "v=")
    number = max([*whole, *begun], default=0) + 1
    df.write.parquet(f"{folder}/v={number}")
    if not put_new(spark, f"{folder}/{POINTERS}/{number}", ""):
        raise RuntimeError(f"another writer made version {number} of {folder}")
    stay = {*whole[max(0, len(whole) - keep + 1) :], number}
    for old in whole:
        if old not in stay:
            remove(spark, f"{folder}/{POINTERS}/{old}")  # first the pointer: what has one is whole
    for old in begun:
        if old not in stay and old < min(stay):
            remove(spark, f"{folder}/v={old}")
    return number


def read_current(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The newest whole version, or the one asked for; an error if there is none."""
    number = current_version(spark, folder) if version is None else version
    if number is None:
        raise FileNotFoundError(f"no version of {folder}")
    return spark.read.parquet(f"{folder.rstrip('/')}/v={number}")
