"""What the operators of this folder share: word rule, hashes of words, and tables written between steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftline.session import fresh_path, text_batches  # noqa: F401

# A word is a run of anything but space and the five ASCII line and tab characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


def split_remainder(divisor: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


class Scratch:
    """Tables in the shared folder that are deleted as soon as no later step reads them.

    Every table is written in full before it is read, so a lost executor costs a re-read.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.paths.pop(name, None)
            if path is not None:
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash (in place on a uint64 array)."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_COEFFICIENTS = mixed(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _coefficients(at: np.ndarray) -> np.ndarray:
    if at.size == 0 or at.max() < len(_COEFFICIENTS):
        return _COEFFICIENTS[at]
    return mixed((at.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _piece_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and start of every word of ``data``."""
    raw = np.frombuffer(data, dtype=np.uint8)
    at = np.flatnonzero(~_IS_SPACE[raw])
    if at.size == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.empty(at.size, dtype=bool)
    first[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=first[1:])
    heads = np.flatnonzero(first)
    within = at - np.repeat(at[heads], np.diff(np.append(heads, at.size)))
    sums = np.add.reduceat((raw[at].astype(np.uint64) + np.uint64(1)) * _coefficients(within), heads)
    return mixed(sums), at[heads]


PIECE = 1 << 18


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` cut at spaces into parts of about ``PIECE`` bytes, so that a very long text needs little memory."""
    start = 0
    while len(text) - start > PIECE:
        cut = max(text.rfind(bytes([s]), start, start + PIECE) for s in SPACES)
        if cut <= start:  # one word longer than a piece
            later = [p for p in (text.find(bytes([s]), start + PIECE) for s in SPACES) if p >= 0]
            cut = min(later, default=len(text))
        yield text[start:cut]
        start = cut
    yield text[start:]


def word_hashes(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For every text in order the 64-bit hashes of its words, computed for many short texts at once."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        if group and size + len(text) > PIECE:
            yield from _group_hashes(group)
            group, size = [], 0
        if len(text) > PIECE:
            yield np.concatenate([_piece_hashes(p)[0] for p in _pieces(text)])
        else:
            group.append(text)
            size += len(text) + 1
    if group:
        yield from _group_hashes(group)


def _group_hashes(group: list[bytes]) -> Iterator[np.ndarray]:
    hashes, starts = _piece_hashes(b"\n".join(group))
    ends = np.cumsum([len(t) + 1 for t in group])
    cuts = np.searchsorted(starts, ends)
    for low, high in zip(np.append(0, cuts[:-1]), cuts, strict=True):
        yield hashes[low:high]
