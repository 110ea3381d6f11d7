"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path  # noqa: F401 - re-exported for the operators

#: Fixed value: a word is a run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text (null text: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def hash_share(key: Column, share: float) -> Column:
    """True for a deterministic ``share`` of all keys, whatever their order or number."""
    steps = 1 << 30
    return F.pmod(F.xxhash64(F.lit(77), key), F.lit(steps)) < int(share * steps)


class Memo(dict):
    """A dictionary that computes missing values; it starts over at ``limit`` entries, so its memory is bounded."""

    def __init__(self, compute, limit: int = 400_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def letter_runs(data: bytes, table: bytes, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """The runs of kept bytes of a text after ``bytes.translate(table)``, which writes a blank for every other byte;
    long texts come in pieces of about ``piece`` bytes, cut at blanks, so memory is bounded but for one unbroken run."""
    at = 0
    while at < len(data):
        end = at + piece
        part = data[at:end].translate(table)
        step = 4096
        while end < len(data) and not part.endswith(b" "):  # go on to the end of the run
            more = data[end:end + step].translate(table)
            cut = more.find(b" ")
            part += more if cut < 0 else more[:cut + 1]
            end += len(more) if cut < 0 else cut + 1
            step = len(part)
        yield part.split()
        at = end
