"""One location type for every path, and table identifiers (SRC-2, SRC-3, SNK-2, SNK-4, SNK-5).

Readers, sinks and jobs all build their paths here, so a bucket that is given
by its bare name means the same place everywhere.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import SparkSession

BUCKET_SCHEME = "s3"


class Location(str):
    """A folder or object: text that Spark takes as a path.

    A URI and an absolute path stand for themselves; any other text names a
    bucket. ``place / "a/b"`` is what lies below; blank segments don't count.
    """

    def __new__(cls, text: str) -> Location:
        text = text.strip()
        if not text:
            raise ValueError("a location can't be empty")
        if not re.match(r"[A-Za-z][\w+.-]*:/|/", text):
            text = f"{BUCKET_SCHEME}://{text}"
        return super().__new__(cls, text.rstrip("/") or "/")

    def __truediv__(self, below: str) -> Location:
        return Location("/".join([self.rstrip("/"), *filter(None, below.split("/"))]))

    def on(self, day: date | str) -> Location:
        """The raw zone's folder of one day, zero-padded (a bad date raises)."""
        d = date.fromisoformat(day) if isinstance(day, str) else day
        return self / f"year={d.year:04}/month={d.month:02}/day={d.day:02}"


def identifier(*parts: str) -> str:
    """A dotted table name whose parts may hold any character."""
    return ".".join("`{}`".format(p.replace("`", "``")) for p in parts)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and holds anything."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.exists(place) and len(store.listStatus(place)) > 0


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Hadoop spells it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")


def filesystem(uri: str):
    """The file system of a qualified path and the path on it, for tasks that
    handle files by themselves."""
    from pyarrow import fs

    head, _, rest = uri.partition(":/")
    if head == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if head in ('s3a', 's3n') else head}:/{rest}")


def reachable(uri: str) -> bool:
    """Whether ``filesystem`` knows the path's scheme."""
    import pyarrow as pa

    try:
        filesystem(uri)
    except (pa.ArrowException, OSError):
        return False
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making and what lies below it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
