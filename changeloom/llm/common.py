"""Helpers the operators share: normal forms of text, folds, and tables written to the shared folder."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

# Words are runs of characters other than these.
WORD_GAPS = " \t\n\v\f\r"


def text_of(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, all other characters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fold(count: int, name: str = "doc_id") -> Column:
    """crc32 of the identifier as text, modulo ``count``; a null identifier counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(count))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as lower-cased bytes: ``bytes`` methods change and split ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def slices(found: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, so that what is made of whole texts is held for few rows at a time."""
    for batch in found:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class _Tables:
    """Paths of tables written inside one ``temporary`` block."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def kept(self, df: DataFrame, label: str) -> DataFrame:
        """Write the table that outlives the block."""
        found = stored(df, label)
        self.paths.pop()
        return found


_open_scopes: list[_Tables] = []


@contextmanager
def temporary() -> Iterator[_Tables]:
    """Tables that are stored inside the block are removed at its end, but for those that ``kept`` writes.

    Where the shared folder is in a store that the driver's Python cannot reach, they stay until that folder is cleared.
    """
    tables = _Tables()
    _open_scopes.append(tables)
    try:
        yield tables
    finally:
        _open_scopes.remove(tables)
        for path in tables.paths:
            try:
                store, folder = fs.FileSystem.from_uri(path)
                store.delete_dir(folder)
            except (OSError, pa.ArrowInvalid):
                pass


def stored(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write a table to the shared folder and read it back; ``codec`` is the compression of its files.

    This cuts the lineage: the loss of an executor after this point costs a read, not the
    work before it, and rows that depend on the order of a shuffle are fixed.
    """
    path = scratch_path(df.sparkSession, f"llm-{label}")
    if _open_scopes:
        _open_scopes[-1].paths.append(path)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
