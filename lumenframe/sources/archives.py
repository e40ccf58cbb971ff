"""Zip archives: their members as rows, and the bytes of chosen members.

Archives come from ``spark.read.format("binaryFile")``; a task holds one archive at a time.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

ENTRY = StructType().add("name", StringType()).add("size", LongType()).add("csize", LongType()).add("method", IntegerType()).add("offset", LongType())


@F.pandas_udf(StructType().add("entries", ArrayType(ENTRY)).add("problem", StringType()))
def _directory(contents: pd.Series) -> pd.DataFrame:
    rows = []
    for data in contents:
        try:
            with zipfile.ZipFile(io.BytesIO(data or b"")) as z:
                found = [i for i in z.infolist() if not i.is_dir() and "__MACOSX/" not in i.filename]
            entries = [
                {"name": i.filename, "size": i.file_size, "csize": i.compress_size, "method": i.compress_type, "offset": i.header_offset}
                for i in found
            ]
            rows.append((entries, None))
        except (zipfile.BadZipFile, OSError, ValueError) as e:
            rows.append(([], str(e)))
    return pd.DataFrame(rows, columns=["entries", "problem"])


def zip_members(files: DataFrame) -> DataFrame:
    """One row per member of each archive of ``files`` (path, content): ``archive``, ``name``, sizes,
    method and offset; folders and resource forks are left out. An archive that cannot be read, null
    and empty ones included, is one row with ``problem`` and no name; an empty archive is one row
    without either."""
    listed = files.select(F.col("path").alias("archive"), _directory("content").alias("d"))
    rows = listed.select("archive", F.col("d.problem").alias("problem"), F.explode_outer("d.entries").alias("e"))
    return rows.select("archive", "e.*", "problem")


def expand_zips(listing: DataFrame, files: DataFrame) -> DataFrame:
    """A listing (path, size) with the members of its archives behind it, as ``archive/member``.

    ``files`` has the archives' (path, content); the reference point for names is the listing's path.
    """
    zips = listing.filter(F.lower("path").endswith(".zip")).select("path").join(files.select("path", "content"), "path")
    inner = zip_members(zips).filter("name IS NOT NULL")
    members = inner.select(F.concat_ws("/", "archive", "name").alias("path"), "size", F.lit(True).alias("in_zip"))
    return listing.select("path", "size", F.lit(False).alias("in_zip")).unionByName(members)


def read_members(files: DataFrame, wanted: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``archive, name, data, complete, problem`` of the members ``wanted`` (archive, name) names.

    With ``max_bytes`` only that many first bytes are read; ``complete`` says whether that was all.
    Missing members and unknown compression are rows with a ``problem``.
    """
    names = wanted.groupBy("archive").agg(F.array_sort(F.collect_set("name")).alias("names"))
    pairs = files.select(F.col("path").alias("archive"), "content").join(names, "archive")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                for name in row.names:
                    data, complete, problem = None, False, None
                    try:
                        with zipfile.ZipFile(io.BytesIO(row.content or b"")) as z, z.open(name) as member:
                            data = member.read(-1 if max_bytes is None else max_bytes)
                            complete = len(data) == z.getinfo(name).file_size
                    except (zipfile.BadZipFile, KeyError, NotImplementedError, OSError, RuntimeError) as e:
                        problem = f"{type(e).__name__}: {e}"
                    yield pd.DataFrame([(row.archive, name, data, complete, problem)], columns=["archive", "name", "data", "complete", "problem"])

    return pairs.mapInPandas(read, "archive string, name string, data binary, complete boolean, problem string")
