"""Stored tables: versioned Parquet folders; posts, comments and rejects are partitioned by load (`batch_id`).

A table's rows lie in `<root>/<name>/v<k>`; the largest number in `<root>/<name>/_versions` says which version counts. A
rewrite goes to a new folder and becomes visible by one new marker file, so a stop in between changes nothing.

Loads commit optimistically. A load writes its rows under `<root>/<name>/_pending/<token>` (a random token, so no two
loads share a folder), then claims the next slot of the commit log `<root>/_commits`. A claim is an exclusive create,
which exactly one writer wins (O_EXCL on a local disk, create-if-absent on a shared file system). Before each try the
load drops the keys of loads committed since it read; the slot it wins makes it visible, and its folder is then moved
to `batch_id=<load>` of the version that counts. A rewrite carries over load partitions committed while it ran.
"""

from __future__ import annotations

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadlens.schemas import DEFAULTS, SCHEMAS, empty_table

LOADED = ("posts", "comments", "rejects")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet scan; one that comes in fewer splits than there are cores is spread over them.

    Row-local text work would otherwise run in as many tasks as a small file has row groups. Large inputs have more
    splits than cores and are left alone.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


class Tables:
    """Tables under one root folder, which all executors must be able to reach.

    Loads may run beside each other and beside rewrites: numbers and commit slots are claimed exclusively, and a
    rewrite keeps the loads committed meanwhile. Two rewrites of one table at once: one of them raises.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _listed(self, path: str) -> list[str]:
        fs, target = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def _numbers(self, path: str) -> list[int]:
        return sorted(int(n) for n in self._listed(path) if n.isdigit())

    def _claim(self, folder: str, number: int, content: str = "") -> bool:
        """Creates `folder/number` holding `content` if nobody did; exactly one of racing writers gets True."""
        fs, target = self._fs(f"{folder}/{number}")
        target = fs.makeQualified(target)
        try:
            if target.toUri().getScheme() == "file":
                jvm = self.spark._jvm
                local = jvm.java.nio.file.Paths.get(target.toUri())
                no_attributes = self.spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
                jvm.java.nio.file.Files.createDirectories(local.getParent(), no_attributes)
                jvm.java.nio.file.Files.createFile(local, no_attributes)  # O_EXCL: atomic
                out = fs.create(target, True)  # the file is ours now
            else:
                out = fs.create(target, False)  # create-if-absent on the shared file system
        except Py4JJavaError:
            return False
        out.write(bytearray(content.encode()))
        out.close()
        return True

    def _content(self, path: str) -> str:
        fs, target = self._fs(path)
        stream = fs.open(target)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _rename(self, source: str, target: str) -> bool:
        fs, src = self._fs(source)
        dst = self.spark._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(dst.getParent())
        return bool(fs.rename(src, dst))

    def _remove(self, path: str) -> None:
        fs, target = self._fs(path)
        fs.delete(target, True)

    def version(self, name: str) -> int:
        """Number of the version that counts, 0 for a table that was never written."""
        return max(self._numbers(f"{self.root}/{name}/_versions"), default=0)

    def path(self, name: str, version: int | None = None) -> str:
        return f"{self.root}/{name}/v{self.version(name) if version is None else version}"

    def exists(self, name: str) -> bool:
        return self.version(name) > 0

    def read(self, name: str) -> DataFrame:
        """Stored rows in schema order; a table never written is empty, one whose rows are lost raises.

        Files written before a column existed read as NULL there, which becomes the column default.
        """
        if not self.exists(name):
            return empty_table(self.spark, name)
        path = self.path(name)
        fs, target = self._fs(path)
        if not fs.exists(target):
            raise FileNotFoundError(f"table {name} was written to {path}, which is gone")
        stored = self.spark.read.schema(SCHEMAS[name]).parquet(path)
        filled = {c: F.coalesce(c, F.lit(v)) for c, v in DEFAULTS.get(name, {}).items()}
        return stored.select(*[filled.get(c, F.col(c)).alias(c) for c in SCHEMAS[name].names])

    def new_load(self, source: str) -> int:
        """The load number of a source: the one it has, if it came before, else a number that nobody else has."""
        own = f"{self.root}/_loads/{hashlib.sha1(source.encode()).hexdigest()}"
        known = self._numbers(own)
        if known:
            return known[0]
        stored = [n.partition("=")[2] for t in LOADED for n in self._listed(self.path(t)) if n.startswith("batch_id=")]
        number = max([*self._numbers(f"{self.root}/_loads/all"), *[int(n) for n in stored if n.isdigit()], 0]) + 1
        while not self._claim(f"{self.root}/_loads/all", number, source):
            number += 1
        self._claim(own, number)
        return number

    # ---- optimistic commit of loads ----

    def pending(self, name: str) -> str:
        """A fresh folder of uncommitted rows of table `name`."""
        return f"{self.root}/{name}/_pending/{uuid.uuid4().hex}"

    def commits(self, after: int = 0) -> list[tuple[int, int, str]]:
        """(slot, load, staged folders as `name=path;...`) of the commit log past slot `after`."""
        log = f"{self.root}/_commits"
        found = []
        for slot in self._numbers(log):
            if slot > after:
                load, _, where = self._content(f"{log}/{slot}").partition("|")
                found.append((slot, int(load), where))
        return found

    def committed_rows(self, name: str, entry: tuple[int, int, str]) -> DataFrame:
        """Rows of table `name` that a committed load added, wherever they lie now."""
        _, load, where = entry
        staged = dict(part.split("=", 1) for part in where.split(";") if part)
        for path in (f"{self.path(name)}/batch_id={load}", staged.get(name)):
            if path and self._fs(path)[0].exists(self._fs(path)[1]):
                return self.spark.read.schema(SCHEMAS[name]).parquet(path).withColumn("batch_id", F.lit(load))
        return empty_table(self.spark, name)

    def try_commit(self, slot: int, load: int, staged: dict[str, str]) -> bool:
        return self._claim(f"{self.root}/_commits", slot, f"{load}|" + ";".join(f"{n}={p}" for n, p in staged.items()))

    def publish(self, name: str, staged: str, load: int) -> None:
        """Moves a committed load's rows into the version that counts, also when a rewrite replaced it meanwhile."""
        version = self.version(name) or 1
        target = f"{self.path(name, version)}/batch_id={load}"
        self._remove(target)  # rows of an earlier try of the same load
        if not self._rename(staged, target):
            raise OSError(f"cannot move {staged} to {target}")
        if not self.version(name):
            self._claim(f"{self.root}/{name}/_versions", 1)
        self._carry(name, version)

    def _carry(self, name: str, since: int) -> None:
        """Load partitions of older versions that the version that counts lacks move into it."""
        now = self.version(name)
        for old in range(since, now):
            held = set(self._listed(self.path(name, now)))
            for part in self._listed(self.path(name, old)):
                if part.startswith("batch_id=") and part not in held:
                    self._rename(f"{self.path(name, old)}/{part}", f"{self.path(name, now)}/{part}")

    def forget_loads(self) -> None:
        """Load numbers and the commit log start again; for a root whose loads are all cleared."""
        self._remove(f"{self.root}/_loads")
        self._remove(f"{self.root}/_commits")

    def write_batch(self, name: str, df: DataFrame, batch_id: int) -> None:
        """Writes one load, in place of an earlier try of the same load, also of rows when `df` has none."""
        version = self.version(name)
        df.drop("batch_id").write.mode("overwrite").parquet(f"{self.path(name, version or 1)}/batch_id={batch_id}")
        if not version:
            self._claim(f"{self.root}/{name}/_versions", 1)

    def overwrite(self, name: str, df: DataFrame) -> None:
        """Replaces a table, which `df` may read; the version before it stays for readers that have begun.

        Loads committed while the rows were written keep theirs: their partitions move over, before and after the
        new version counts (a load that lands in the old version after that moves itself, see `publish`).
        """
        version = self.version(name) + 1
        before = set(self._listed(self.path(name, version - 1)))
        writer = df.write.mode("overwrite")
        (writer.partitionBy("batch_id") if name in LOADED else writer).parquet(self.path(name, version))
        if name in LOADED:
            self._carry_new(name, version - 1, version, before)
        if not self._claim(f"{self.root}/{name}/_versions", version):
            raise OSError(f"table {name} was replaced by another writer")
        if name in LOADED:
            self._carry_new(name, version - 1, version, before)
        for old in self._numbers(f"{self.root}/{name}/_versions"):
            if old < version - 1:
                self._remove(self.path(name, old))

    def _carry_new(self, name: str, old: int, new: int, seen: set[str]) -> None:
        for part in self._listed(self.path(name, old)):
            if part.startswith("batch_id=") and part not in seen:
                self._rename(f"{self.path(name, old)}/{part}", f"{self.path(name, new)}/{part}")

    def clear(self, *names: str) -> None:
        """Empties tables but keeps their schema; metadata only when named."""
        for name in names or ("qa_pairs", "comments", "posts", "rejects"):
            self.overwrite(name, empty_table(self.spark, name))

    def drop(self, *names: str) -> None:
        for name in names or ("qa_pairs", "comments", "posts"):
            self._remove(f"{self.root}/{name}")
