"""A merge state that lies in buckets of its key, so that a merge does not move it.

Each version is a bucketed table of its own. New rows are dealt to the same buckets and joined to the
state where it lies; the plan of a merge has one exchange, of the new rows. The next version is
swapped in by its manifest, as in ``state_table``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from mergelens.operators.merge_state import Merge, fold_merge, merge_pair
from mergelens.sources.hadoop import Folder
from mergelens.sources.state_table import VersionConflict

#: Rows of a bucket, which one task folds, sorts and joins.
BUCKET_ROWS = 250_000


class BucketedState:
    """State rows of a merge, one per key, below ``root``, in ``buckets`` of the key at first.

    When rows could exceed BUCKET_ROWS a bucket, the next version has twice as many buckets, or more:
    that merge moves the state once. All others find it in place.

    A merge reads and writes every bucket, in place: for many changes. ``StateTable`` moves the
    buckets it touches, and only those: for few.
    """

    def __init__(self, spark: SparkSession, root: str, merge: Merge, buckets: int = 64):
        self.spark, self.root, self.held, self.buckets = spark, root.rstrip("/"), merge, buckets
        self.folder = Folder(spark, root)
        self._name = f"state_{uuid.uuid4().hex}"

    def version(self) -> int:
        names = [n for n in self.folder.names("manifest") if n.endswith(".json")]
        return int(names[-1].removesuffix(".json")) if names else 0

    def _manifest(self, version: int) -> dict:
        return json.loads(self.folder.read(f"manifest/{version:012d}.json"))

    def read(self, version: int | None = None) -> DataFrame:
        """One version as a table that knows its buckets; it is entered in the session's catalog."""
        version = self.version() if version is None else version
        if not version:
            raise ValueError("the state has no version yet")
        name = f"{self._name}_{version}"
        if not self.spark.catalog.tableExists(name):
            manifest = self._manifest(version)
            columns = StructType.fromJson(json.loads(manifest["schema"]))
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
            keys = ", ".join(self.held.key)
            self.spark.sql(
                f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                f"INTO {manifest['buckets']} BUCKETS LOCATION '{self.root}/{manifest['data']}'"
            )
        return self.spark.table(name)

    def merged(self, rows: DataFrame, buckets: int | None = None) -> DataFrame:
        """The newest version with ``rows`` (states of ``merge_state``) merged in, not yet written.

        The rows are dealt to the state's buckets, or to ``buckets``, before they are folded, so that
        both the fold and the join find them in place.
        """
        version = self.version()
        size = buckets or (self._manifest(version)["buckets"] if version else self.buckets)
        new = fold_merge(rows.repartition(size, *self.held.key), self.held)
        return merge_pair(self.read(version), new, self.held) if version else new

    def merge(self, rows: DataFrame, source: str | None = None, batch: int = 0) -> int:
        """Write the next version; a ``batch`` of a ``source`` that is not newer than its last is left out."""
        version = self.version()
        before = self._manifest(version) if version else {"buckets": self.buckets, "sources": {}}
        if source is not None and before["sources"].get(source, -1) >= batch:
            return version
        data = f"data/{version + 1:012d}-{uuid.uuid4().hex}"
        buckets, keys = before["buckets"], list(self.held.key)
        most = (self.read(version).count() if version else 0) + rows.count()
        while most > buckets * BUCKET_ROWS:
            buckets *= 2
        merged = self.merged(rows, buckets)
        if version and buckets != before["buckets"]:
            merged = merged.repartition(buckets, *keys)
        name = f"{self._name}_w{uuid.uuid4().hex}"
        (
            merged.write.format("parquet")
            .bucketBy(buckets, keys[0], *keys[1:])
            .sortBy(keys[0], *keys[1:])
            .option("path", f"{self.root}/{data}")
            .saveAsTable(name)
        )
        self.spark.sql(f"DROP TABLE {name}")
        after = {
            "data": data,
            "buckets": buckets,
            "schema": merged.schema.json(),
            "sources": before["sources"] | ({source: batch} if source is not None else {}),
        }
        if not self.folder.create(f"manifest/{version + 1:012d}.json", json.dumps(after)):
            raise VersionConflict(f"version {version + 1} is there already")
        return version + 1
