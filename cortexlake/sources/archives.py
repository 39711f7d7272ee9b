"""Series archives (zip of per-slice files) -> one row per member.

A ``mapInPandas`` job over ``binaryFile`` rows (or any ``(object_key,
content)`` DataFrame) opens each archive with the standard ``zipfile``
module in the task that read it and emits its members in small batches.
An empty or unreadable archive yields one status row instead of failing
the job.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ARCHIVE_MEMBERS

#: Damaged, encrypted or unsupported members are reported, one by one.
BAD_ARCHIVE = (zipfile.BadZipFile, zlib.error, EOFError, OSError, ValueError, RuntimeError,
               NotImplementedError)
MEMBER_COLUMNS = [f.name for f in ARCHIVE_MEMBERS.fields]


def _members(key: str, content: bytes, suffix: str | None, batch: int) -> Iterator[pd.DataFrame]:
    try:
        zf = zipfile.ZipFile(io.BytesIO(content))
        infos = [i for i in zf.infolist() if not i.is_dir()
                 and (suffix is None or i.filename.lower().endswith(suffix))]
    except BAD_ARCHIVE as e:
        yield pd.DataFrame({"object_key": [key], "member": [None], "content": [None],
                            "status": ["error: " + str(e)]}, columns=MEMBER_COLUMNS)
        return
    if not infos:
        yield pd.DataFrame({"object_key": [key], "member": [None], "content": [None],
                            "status": ["empty"]}, columns=MEMBER_COLUMNS)
        return
    for s in range(0, len(infos), batch):
        rows = []
        for info in infos[s:s + batch]:
            try:
                rows.append((key, info.filename, zf.read(info), "ok"))
            except BAD_ARCHIVE as e:
                rows.append((key, info.filename, None, "error: " + str(e)))
        yield pd.DataFrame(rows, columns=MEMBER_COLUMNS)


def explode_archives(archives: DataFrame, key_col: str = "object_key",
                     content_col: str = "content", suffix: str | None = None,
                     batch: int = 64) -> DataFrame:
    """Every member (directories skipped; nested paths kept) of every
    archive, with a per-row status."""
    src = archives.select(F.col(key_col).cast("string").alias("object_key"),
                          F.col(content_col).alias("content"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, content in zip(pdf["object_key"], pdf["content"]):
                yield from _members(str(key), bytes(content) if content is not None else b"",
                                    suffix, batch)
    return src.mapInPandas(run, ARCHIVE_MEMBERS)


def read_archives(spark, path: str, glob: str = "*.zip") -> DataFrame:
    """``binaryFile`` listing of archives; the path is the object key."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .select(F.col("path").alias("object_key"), "content"))
