"""Words, tables, and scratch files shared by the operators."""

from __future__ import annotations

import uuid

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from icelens.session import shared_folder

#: The separators between words; a word is a longest run of other characters.
SPACES = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """All words of ``text`` in order; no word, no element."""
    return F.array_remove(F.split(text, SPACES), "")


def with_outputs(df: DataFrame, **outputs: Column) -> DataFrame:
    """``df`` with these columns added at its end; they replace columns of the same name."""
    taken = {name.lower() for name in outputs}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken],
                     *[column.alias(name) for name, column in outputs.items()])


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key's text, modulo ``divisor``; a null key counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")) % divisor


def text_key(text: Column) -> Column:
    """A 20-byte digest; equal texts have equal results in every operator that looks at texts alone."""
    return F.unhex(F.sha1(F.encode(text, "UTF-8")))


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that no other run writes, below the one that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def opened(address: str, mode: str):
    """A stream over a file in a shared folder: a local path or any address that pyarrow knows."""
    if "://" in address or address.startswith("file:"):
        system, path = pyarrow.fs.FileSystem.from_uri(address)
    else:
        system, path = pyarrow.fs.LocalFileSystem(), address
    if mode == "r":
        return system.open_input_stream(path)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)
