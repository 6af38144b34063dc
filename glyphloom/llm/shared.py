"""Tables in the shared folder that Python tasks read by themselves, a part at a time."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from glyphloom.session import forget_later


def keep(df: DataFrame, path: str, part: str) -> None:
    """Writes df to path, a folder for each value of the column ``part``; it stays as written() tables do."""
    forget_later(df.sparkSession, path)
    df.write.partitionBy(part).parquet(path)


def read_rows(path: str, columns: list[str]) -> list[tuple]:
    """The rows of one part, on whatever file system that is; none if there is no such part."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(path if "://" in path else f"file://{os.path.abspath(path)}")
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    names = sorted(f.path for f in found if f.base_name.endswith(".parquet"))
    return [row for name in names for row in zip(*(c.to_pylist() for c in pq.read_table(name, columns=columns, filesystem=files, partitioning=None).columns))]
