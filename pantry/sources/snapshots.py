"""A Parquet table of parts under a log of commits.

A part (a bucket of keys, a day) is a folder that never changes; a commit is a small
file that names the parts of one version with their rows.  Writers prepare folders
of the parts they touch and then claim the next version's name; who comes second
looks at what the other changed and tries again.  Readers take the newest commit and
so see the table before a change or after it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Parts = dict[str, dict]  # part: {"path": folder, "rows": count}
UNDATED = "undated"


class Conflict(Exception):
    """Another writer has taken the version."""


class SnapshotTable:
    """``root``: a folder that driver and executors share.  ``part``: the column that
    tells a row's part; it isn't stored."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, part: Column):
        self.spark, self.root, self.schema, self.part = spark, root.rstrip("/"), schema, part
        jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._copy = jvm.org.apache.commons.io.IOUtils
        self._fs.mkdirs(self._path(f"{self.root}/commits"))

    # commits

    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.root}/commits"))]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def parts(self, version: int | None = None) -> Parts:
        version = self.version() if version is None else version
        if version == 0:
            return {}
        stream = self._fs.open(self._path(f"{self.root}/commits/{version:020d}.json"))
        try:
            return json.loads(self._copy.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, base: int, changes: dict[str, dict | None]) -> int:
        """Version base + 1: the parts of ``base`` with ``changes`` (None: dropped).
        The name is taken by a rename that doesn't replace; Conflict if it is gone."""
        parts = self.parts(base) | changes
        text = json.dumps({k: v for k, v in sorted(parts.items()) if v})
        draft, name = self._path(f"{self.root}/commits/{uuid.uuid4().hex}.draft"), self._path(f"{self.root}/commits/{base + 1:020d}.json")
        stream = self._fs.create(draft, False)
        self._copy.write(text, stream, "UTF-8")
        stream.close()
        try:
            self._files.rename(draft, name, self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:
            self._fs.delete(draft, False)
            if self._fs.exists(name):
                raise Conflict(f"version {base + 1} of {self.root} is taken") from e
            raise
        return base + 1

    # rows

    def read(self, only: list[str] | None = None, version: int | None = None) -> DataFrame:
        parts = self.parts(version)
        paths = [p["path"] for k, p in parts.items() if only is None or k in only]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame) -> Parts:
        """``rows`` written to folders of their parts, not committed."""
        base = f"{self.root}/data/{uuid.uuid4().hex}"
        named = rows.select(*self.schema.names, self.part.cast("string").alias("__part"))
        named.hint("rebalance", "__part").write.partitionBy("__part").parquet(base)  # a large part is dealt over more files
        back = self.spark.read.schema(StructType(list(self.schema.fields)).add("__part", "string")).parquet(base)
        counts = back.groupBy(F.col("__part").alias("part")).count().collect()  # a row for each part
        return {r["part"]: {"path": f"{base}/__part={r['part']}", "rows": r["count"]} for r in counts}

    def append_new(self, rows: DataFrame) -> int:
        """The first version of a table."""
        return self.commit(0, self.write(rows))

    def change(self, touched: Callable[[Parts], list[str]], change: Callable[[DataFrame], DataFrame], tries: int = 20) -> int:
        """Rewrite the parts that ``touched`` names to what ``change`` makes of their
        rows.  If another writer commits meanwhile, the work counts if that one left
        our parts as they were; otherwise it is done again."""
        base = self.version()
        for _ in range(tries):
            before = self.parts(base)
            own = touched(before)
            made = self.write(change(self.read(own, base)))
            changes = {k: made.get(k) for k in {*own, *made}}
            while True:
                try:
                    return self.commit(base, changes)
                except Conflict:
                    base = self.version()
                    now = self.parts(base)
                    if any(now.get(k) != before.get(k) for k in changes):
                        break
        raise Conflict(f"{tries} tries on {self.root}")


def by_bucket(key: str, n: int) -> Column:
    """Parts of equal size by a key's hash."""
    return F.pmod(F.xxhash64(key), F.lit(n))


def by_day(ts: str) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(UNDATED))


def drop_before(table: SnapshotTable, ts: str, cutoff: str) -> int:
    """Drop the rows of a table by day that are older than ``cutoff`` (a UTC time as
    text, year first); their number.  Whole days go by the commit alone; the day of the cutoff is rewritten,
    and no other is read.  Rows without a time stay."""
    day = cutoff[:10]
    while True:
        base = table.version()
        parts = table.parts(base)
        changes: dict[str, dict | None] = {k: None for k in parts if k != UNDATED and k < day}
        gone = sum(parts[k]["rows"] for k in changes)
        if day in parts:
            kept = table.write(table.read([day], base).where(F.col(ts) >= F.lit(cutoff).cast("timestamp"))).get(day)
            lost = parts[day]["rows"] - (kept["rows"] if kept else 0)
            if lost:
                changes[day] = kept
                gone += lost
        if not changes:
            return 0
        try:
            table.commit(base, changes)
            return gone
        except Conflict:
            continue
