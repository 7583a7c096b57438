"""Copy-on-write tables in hash buckets, with a manifest for each version.

A table's rows lie in buckets by a hash of their key. A version is a manifest: for
each bucket, the folder that holds it, and its rows. An upsert stages the new
rows, reads the buckets that they fall into, writes those anew beside the old ones
and commits a manifest that names the new folders and, for all other buckets,
the old ones. So history that a run doesn't touch is neither read nor written, a
failed write leaves the table as it was, and a reader of an older version keeps
its files until they have been out of use for `retention` seconds.

The commit is one file, created only if there is none of its number: of two writers
the second fails with CommitConflict and may start over. The number of buckets
doubles when they pass ROWS_PER_BUCKET rows on average; that upsert rewrites all.

    table/data/<write>/_bucket=<n>/    rows
    table/manifests/<write>.json       a version
    table/commits/<number>             the <write> of that version and a line feed
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"
FEWEST, ROWS_PER_BUCKET = 16, 4_000_000
RETENTION = 3600.0

RULES = {
    "replace": lambda old, new: new,
    "keep_old": lambda old, new: old,
    "coalesce": lambda old, new: F.coalesce(new, old),
    "least": F.least,
    "greatest": F.greatest,
    "filled_array": lambda old, new: F.when(F.size(new) > 0, new).otherwise(old),
}


class CommitConflict(RuntimeError):
    """Another writer has committed this version's number."""


def merged(old: DataFrame, new: DataFrame, key: list[str], rules: dict[str, str] | None = None) -> DataFrame:
    """old with new's rows: inserted, or combined with the row of their key by each column's rule (replace unless given)."""
    rules = rules or {}
    columns = [c for c in new.columns if c not in key]
    left = old.select(*key, F.struct(*columns).alias("_old"))
    right = new.select(*key, F.struct(*columns).alias("_new"))
    both = left.join(right, key, "full_outer")

    def pick(c: str) -> Column:
        a, b = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        return F.when(F.col("_new").isNull(), a).when(F.col("_old").isNull(), b).otherwise(RULES[rules.get(c, "replace")](a, b)).alias(c)

    return both.select(*key, *(pick(c) for c in columns))


def key_hash(key: list[str]) -> Column:
    """32 bits of the MD5 of the key's texts."""
    text = F.concat_ws("\u001f", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


@dataclass
class Manifest:
    number: int
    write: str
    at: float
    schema: str  # as JSON
    key: list[str]
    buckets: int
    folders: dict[str, str] = field(default_factory=dict)  # bucket -> folder under data
    rows: dict[str, int] = field(default_factory=dict)

    def written(self) -> list[str]:
        """The buckets that this version itself has written."""
        return [b for b, folder in self.folders.items() if folder.startswith(f"{self.write}/")]


class Files:
    """The few calls of Spark's file systems that tables need."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self.path_of = self._jvm.org.apache.hadoop.fs.Path
        self.system = self.path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[tuple[str, float]]:
        """(name, time of change in seconds) of what is in a folder."""
        at = self.path_of(folder)
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in self.system.listStatus(at)] if self.system.exists(at) else []

    def read(self, path: str) -> str:
        opened = self.system.open(self.path_of(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        finally:
            opened.close()

    def create(self, path: str, text: str) -> bool:
        """False if the file is there already."""
        try:
            out = self.system.create(self.path_of(path), False)
        except Exception:
            if self.system.exists(self.path_of(path)):
                return False
            raise
        try:
            out.write(text.encode())
        finally:
            out.close()
        return True

    def delete(self, path: str) -> None:
        self.system.delete(self.path_of(path), True)

    def move(self, a: str, b: str) -> None:
        if not self.system.rename(self.path_of(a), self.path_of(b)):
            raise OSError(f"{a} can't be moved to {b}")


class Table:
    def __init__(self, spark: SparkSession, path: str, retention: float = RETENTION, rows_per_bucket: int = ROWS_PER_BUCKET, fewest: int = FEWEST) -> None:
        self.spark, self.path, self.files = spark, path, Files(spark, path)
        self.retention, self.rows_per_bucket, self.fewest = retention, rows_per_bucket, fewest

    def _commits(self) -> list[tuple[int, float]]:
        return sorted((int(n), at) for n, at in self.files.names(f"{self.path}/commits") if n.isdigit())

    def manifest(self, number: int | None = None) -> Manifest | None:
        """The version of that number, or the last one that is whole."""
        numbers = [number] if number is not None else [n for n, _ in reversed(self._commits())]
        for n in numbers:
            name = self.files.read(f"{self.path}/commits/{n:012d}")
            if name.endswith("\n"):  # else its writer has not got further
                return Manifest(**json.loads(self.files.read(f"{self.path}/manifests/{name.strip()}.json")))
        return None

    def read(self, number: int | None = None, buckets: list[str] | None = None) -> DataFrame | None:
        """A version's rows, the current one's if no number is given, or those of some of its buckets."""
        found = self.manifest(number)
        return None if found is None else self._rows(found, buckets)

    def _rows(self, found: Manifest, buckets: list[str] | None = None) -> DataFrame:
        folders = sorted({f for b, f in found.folders.items() if buckets is None or b in buckets})
        schema = StructType.fromJson(json.loads(found.schema))
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{f}" for f in folders))

    def _commit(self, old: Manifest | None, new: Manifest) -> None:
        numbers = [n for n, _ in self._commits()]
        if old is not None and numbers and self.manifest().number != old.number:
            raise CommitConflict(f"{self.path}: version {old.number} is not the last any more")
        new.number = max(numbers, default=0) + 1
        self.files.create(f"{self.path}/manifests/{new.write}.json", json.dumps(asdict(new)))
        if not self.files.create(f"{self.path}/commits/{new.number:012d}", new.write + "\n"):
            raise CommitConflict(f"{self.path}: version {new.number} is there already")

    def replace(self, df: DataFrame) -> int:
        """A version that holds df alone, in one bucket. Returns its rows."""
        old, write, seen = self.manifest(), uuid.uuid4().hex, Observation()
        df.observe(seen, F.count("*").alias("n")).write.parquet(f"{self.path}/data/{write}/{BUCKET}=0")
        n = seen.get["n"]
        self._commit(old, Manifest(0, write, time.time(), df.schema.json(), [], 1, {"0": f"{write}/{BUCKET}=0"}, {"0": n}))
        self.vacuum()
        return n

    def upsert(self, new: DataFrame, key: list[str], rules: dict[str, str] | None = None) -> int:
        """new has a row for each key. Returns how many rows it had, counted as they are staged."""
        old, write, seen = self.manifest(), uuid.uuid4().hex, Observation()
        staged_path = f"{self.path}/staged/{write}"
        try:
            new.withColumn(BUCKET, key_hash(key)).observe(seen, F.count("*").alias("n")).write.parquet(staged_path)
            n = seen.get["n"]
            staged = self.spark.read.schema(new.withColumn(BUCKET, F.lit(0).cast("long")).schema).parquet(staged_path)
            buckets = self._buckets(old, n)
            fresh = old is None or old.buckets != buckets or old.key != key
            staged = staged.withColumn(BUCKET, (F.col(BUCKET) % buckets).cast("int"))
            touched = None if fresh else [str(r[0]) for r in staged.select(BUCKET).distinct().collect()]  # a row a bucket at most
            rows = staged.drop(BUCKET)
            if old is not None:
                rows = merged(self._rows(old, touched), rows, key, rules)
            rows = rows.withColumn(BUCKET, (key_hash(key) % buckets).cast("int"))
            rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{write}")
            found = self.spark.read.schema(f"{BUCKET} int").parquet(f"{self.path}/data/{write}").groupBy(BUCKET).count() if n or old else None
            counts = {str(b): c for b, c in found.collect()} if found is not None else {}  # from the files' ends
        finally:
            self.files.delete(staged_path)
        kept = Manifest(0, write, time.time(), new.schema.json(), key, buckets)
        if not fresh:
            kept.folders, kept.rows = dict(old.folders), dict(old.rows)
        kept.folders |= {b: f"{write}/{BUCKET}={b}" for b in counts}
        kept.rows |= counts
        self._commit(old, kept)
        self.vacuum()
        return n

    def _buckets(self, old: Manifest | None, more: int) -> int:
        buckets, rows = (old.buckets, sum(old.rows.values())) if old else (self.fewest, 0)
        buckets = max(buckets, self.fewest)
        while rows + more > buckets * self.rows_per_bucket:
            buckets *= 2
        return buckets

    def history(self) -> list[Manifest]:
        """The versions that are still whole, oldest first."""
        found = []
        for n, _ in self._commits():
            m = self.manifest(n)
            if m is not None:
                found.append(m)
        return found

    def vacuum(self, retention: float | None = None) -> None:
        """Erase versions that were replaced more than `retention` seconds ago, and what no version left names."""
        limit = time.time() - (self.retention if retention is None else retention)
        commits = self._commits()
        # a version is out of use since the next one was committed
        gone = [n for (n, _), (_, replaced) in zip(commits, commits[1:]) if replaced < limit]
        if not gone:
            return
        kept = [m for m in self.history() if m.number not in gone]
        used = {f for m in kept for f in m.folders.values()}
        for write, at in self.files.names(f"{self.path}/data"):
            theirs = self.files.names(f"{self.path}/data/{write}")
            if not any(f.startswith(f"{write}/") for f in used):
                if at < limit:  # else it may be of a write under way
                    self.files.delete(f"{self.path}/data/{write}")
                continue
            for name, _ in theirs:
                if name.startswith(f"{BUCKET}=") and f"{write}/{name}" not in used:
                    self.files.delete(f"{self.path}/data/{write}/{name}")
        for n in gone:
            self.files.delete(f"{self.path}/commits/{n:012d}")
        named = {f"{m.write}.json" for m in kept}
        for name, at in self.files.names(f"{self.path}/manifests"):
            if name not in named and at < limit:
                self.files.delete(f"{self.path}/manifests/{name}")
