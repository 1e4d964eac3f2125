"""A state table in key buckets with versions, and a ledger of the files it was built from.

A change writes the buckets it touches to a folder of its own and then one manifest, which names the
folder of every bucket. The manifest is swapped in last and whole, so a change that is killed leaves
the version before it as it was, and a reader sees one version, whatever is written meanwhile.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mergelens.sources.hadoop import Folder

Fold = Callable[[DataFrame], DataFrame]
LEDGER = "path string, length long, modified timestamp"
_BUCKET = "_bucket"


class VersionConflict(RuntimeError):
    """Another writer has swapped in the next version; run the change again."""


@dataclass(frozen=True)
class Manifest:
    """One version: where each bucket lies, the last batch of each source, the parts of the ledger."""

    version: int = 0
    buckets: dict[str, str] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)
    ledger: tuple[str, ...] = ()
    schema: str | None = None
    size: int | None = None

    def text(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def of(text: str) -> Manifest:
        held = json.loads(text)
        return Manifest(**held | {"ledger": tuple(held["ledger"])})


class StateTable:
    """State rows, one per key, below ``root``.

    ``fold`` unites rows of equal keys. It must not depend on order or grouping and must leave its
    own result as it is, as ``fold_state`` and ``fold_merge`` do; then a batch that comes twice
    changes nothing. ``buckets`` is fixed with the first version: a change reads and writes only the
    buckets its keys fall into. Keys are spread by hash, so a repository of any size fills all.
    """

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], fold: Fold, buckets: int = 64):
        self.spark, self.root, self.key, self.fold, self.buckets = spark, root.rstrip("/"), list(key), fold, buckets
        self.folder = Folder(spark, root)

    # Reading

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.folder.names("manifest") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest version, or the one asked for; version 0 is the empty table."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        elif version and version not in known:
            raise ValueError(f"no version {version}")
        return Manifest.of(self.folder.read(_manifest_name(version))) if version else Manifest()

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of one version."""
        manifest = self.manifest(version)
        if manifest.schema is None:
            raise ValueError("the table has no version yet")
        return self._buckets(manifest, manifest.buckets)

    def ledger(self, version: int | None = None) -> DataFrame:
        """Path, length and time of modification of the files read so far."""
        parts = self.manifest(version).ledger
        if not parts:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(*(f"{self.root}/{p}" for p in parts))

    def _buckets(self, manifest: Manifest, chosen: Sequence[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(manifest.schema))
        paths = [f"{self.root}/{manifest.buckets[b]}" for b in chosen if b in manifest.buckets]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # Writing

    def upsert(
        self, rows: DataFrame, source: str | None = None, batch: int = 0, ledger: DataFrame | None = None
    ) -> int:
        """Fold ``rows`` into the newest version; returns the version that holds them.

        A ``batch`` of a ``source`` that is not newer than the last one is left out. ``ledger`` is
        added with the same swap. The rows are computed once, folded and written; then the touched
        buckets, at most ``buckets`` numbers, are known, and only those are read and written anew.
        """
        before = self.manifest()
        if source is not None and before.sources.get(source, -1) >= batch:
            return before.version
        size = before.size or self.buckets
        attempt = f"data/{before.version + 1:012d}-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(size)).cast("int").alias(_BUCKET)
        new = self.fold(rows)
        schema = before.schema or new.schema.json()
        new.select("*", bucket).write.parquet(f"{self.root}/{attempt}/new")
        new = self.spark.read.parquet(f"{self.root}/{attempt}/new")
        touched = sorted(str(r[0]) for r in new.select(_BUCKET).distinct().collect())
        where = dict(before.buckets)
        if touched:
            both = new.drop(_BUCKET)
            if before.schema:
                both = self._buckets(before, touched).unionByName(both)
            (
                self.fold(both)
                .select("*", bucket)
                .hint("rebalance", _BUCKET)
                .write.partitionBy(_BUCKET)
                .parquet(f"{self.root}/{attempt}/state")
            )
            where |= {b: f"{attempt}/state/{_BUCKET}={b}" for b in touched}
        parts = before.ledger
        if ledger is not None:
            ledger.write.parquet(f"{self.root}/{attempt}/ledger")
            parts = (*parts, f"{attempt}/ledger")
        sources = before.sources | ({source: batch} if source is not None else {})
        after = Manifest(before.version + 1, where, sources, parts, schema, size)
        if not self.folder.create(_manifest_name(after.version), after.text()):
            raise VersionConflict(f"version {after.version} is there already")
        return after.version

    def upsert_stream(self, stream: DataFrame, checkpoint: str, transform: Fold = lambda rows: rows):
        """Fold every micro-batch once; a batch that is delivered again after a failure is left out."""

        def write(rows: DataFrame, batch: int) -> None:
            self.upsert(transform(rows), checkpoint, batch)

        return (
            stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def new_files(self, path: str, glob: str = "*") -> DataFrame:
        """Files below ``path`` that the ledger lacks, or has with another length or time."""
        found = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob)
            .load(path)
            .select("path", "length", F.col("modificationTime").alias("modified"))
        )
        return found.join(self.ledger(), ["path", "length", "modified"], "left_anti")

    def ingest_files(
        self, path: str, read: Callable[[list[str]], DataFrame], glob: str = "*", group: int = 1_000
    ) -> int:
        """Read new and replaced files, ``group`` at a time, and fold them in; returns how many.

        ``read`` makes state rows of a list of paths. Rows and ledger of a group are swapped in
        together, so after a failure the next run goes on with the groups that are missing. A
        replaced file is read once more; rows that only its earlier form had stay.
        """
        files = 0
        for some in batched(self._listed(path, glob), group):
            rows = read([re.sub(r"([\[\]{}*?\\])", r"\\\1", r["path"]) for r in some])
            self.upsert(rows, ledger=self.spark.createDataFrame(some, LEDGER).coalesce(1))
            files += len(some)
        return files

    def _listed(self, path: str, glob: str) -> Iterator:
        listed = f"{self.root}/listing-{uuid.uuid4().hex}"
        self.new_files(path, glob).write.parquet(listed)
        # Written first: the ledger grows while the groups are read.
        yield from self.spark.read.parquet(listed).orderBy("path").toLocalIterator()
        self.folder.delete(listed.rpartition("/")[2])

    def expire(self, keep: int = 10) -> None:
        """Forget all but the last ``keep`` versions and what only they or no version name.

        Not while a change is being written: its files are in no manifest yet.
        """
        known = self.versions()
        for version in known[:-keep]:
            self.folder.delete(_manifest_name(version))
        held = set()
        for version in known[-keep:]:
            manifest = self.manifest(version)
            held |= {p.split("/")[1] for p in (*manifest.buckets.values(), *manifest.ledger)}
        for attempt in self.folder.names("data"):
            if attempt not in held:
                self.folder.delete(f"data/{attempt}")


def _manifest_name(version: int) -> str:
    return f"manifest/{version:012d}.json"
