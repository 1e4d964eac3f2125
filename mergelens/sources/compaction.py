"""A set of Parquet files that grows by saves, and its planned compaction.

A manifest names the live files. Compaction packs small files of one repository into bins of about a
target size, rewrites only those, and swaps in a manifest with the new files in their place; all
others stay where they are, under their names.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from mergelens.sources.hadoop import Folder
from mergelens.sources.state_table import VersionConflict

FILES = "path string, owner string, bytes long"


def _file(path: Column) -> Column:
    """A path of a listing, with one slash after the scheme of local files."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _row_file() -> Column:
    """The same path of a row's file, which Spark gives URL-encoded."""
    return _file(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


class FileSet:
    """Records below ``root``, one repository (column ``by``) per file."""

    def __init__(self, spark: SparkSession, root: str, by: str = "repository_name"):
        self.spark, self.root, self.by = spark, root.rstrip("/"), by
        self.folder = Folder(spark, root)

    def version(self) -> int:
        names = [n for n in self.folder.names("manifest") if n.endswith(".json")]
        return int(names[-1].removesuffix(".json")) if names else 0

    def _manifest(self, version: int) -> dict:
        return json.loads(self.folder.read(f"manifest/{version:012d}.json"))

    def files(self, version: int | None = None) -> DataFrame:
        """path, owner (the repository) and bytes of the live files."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(f"{self.root}/{self._manifest(version)['files']}")

    def read(self, version: int | None = None) -> DataFrame:
        """All records of one version. Spark holds the paths of the files it reads on the driver."""
        version = self.version() if version is None else version
        if not version:
            raise ValueError("the set has no version yet")
        schema = StructType.fromJson(json.loads(self._manifest(version)["schema"]))
        return self._records([r["path"] for r in self.files(version).select("path").collect()], schema)

    def _records(self, paths: list[str], schema: StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths))

    def _written(self, rows: DataFrame, group: Column) -> DataFrame:
        """Write rows below a new folder, a folder for each group; the files with owner and size."""
        data = f"data/{uuid.uuid4().hex}"
        grouped = rows.withColumn("_group", group).drop("_bin").hint("rebalance", "_group")
        grouped.write.partitionBy("_group").parquet(f"{self.root}/{data}")
        listed = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(f"{self.root}/{data}")
            .select("path", F.col("length").alias("bytes"))
        )
        # The owner is in every row of a file; any row tells it.
        owners = (
            self.spark.read.schema(StructType([rows.schema[self.by]]))
            .option("recursiveFileLookup", True)
            .parquet(f"{self.root}/{data}")
            .groupBy(_row_file().alias("_key"))
            .agg(F.first(self.by).cast("string").alias("owner"))
        )
        return listed.withColumn("_key", _file(F.col("path"))).join(owners, "_key").select("path", "owner", "bytes")

    def _swap(self, before: int, files: DataFrame, schema: str) -> int:
        held = f"lists/{before + 1:012d}-{uuid.uuid4().hex}"
        files.select("path", "owner", "bytes").write.parquet(f"{self.root}/{held}")
        text = json.dumps({"files": held, "schema": schema})
        if not self.folder.create(f"manifest/{before + 1:012d}.json", text):
            raise VersionConflict(f"version {before + 1} is there already")
        return before + 1

    def add(self, records: DataFrame) -> int:
        """Append a save; one without rows adds no file."""
        before = self.version()
        schema = self._manifest(before)["schema"] if before else records.schema.json()
        columns = StructType.fromJson(json.loads(schema)).names
        new = self._written(records.select(*columns), F.coalesce(F.col(self.by), F.lit("")))
        return self._swap(before, self.files(before).unionByName(new), schema)

    def plan(self, target: int) -> DataFrame:
        """path, owner, bytes and bin of files to rewrite.

        Files below half of ``target`` bytes are small; those of a repository are packed in the order
        of their paths, so that a bin has at most one and a half times ``target``. A bin of one file
        is left as it is.
        """
        order = Window.partitionBy("owner").orderBy("path")
        before = F.coalesce(F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        binned = self.files().filter(F.col("bytes") * 2 < target).withColumn("bin", (before / target).cast("long"))
        members = F.count(F.lit(1)).over(Window.partitionBy("owner", "bin"))
        return binned.withColumn("_members", members).filter(F.col("_members") > 1).drop("_members")

    def compact(self, target: int = 128 << 20) -> int:
        """Rewrite the planned files; returns the version, the same one if there is nothing to do."""
        before = self.version()
        planned = self.plan(target).collect()
        if not planned:
            return before
        schema = self._manifest(before)["schema"]
        # The paths are on the driver to be read; their bins go along.
        bins = self.spark.createDataFrame([(r["path"], f"{r['owner']}/{r['bin']}") for r in planned], "_path string, _bin string")
        rows = self._records([r["path"] for r in planned], StructType.fromJson(json.loads(schema)))
        columns = rows.columns
        joined = rows.withColumn("_key", _row_file()).join(bins.withColumn("_key", _file(F.col("_path"))), "_key")
        new = self._written(joined.select(*columns, "_bin"), F.col("_bin"))
        rest = self.files(before).join(self.spark.createDataFrame([(r["path"],) for r in planned], "path string"), "path", "left_anti")
        return self._swap(before, rest.unionByName(new), schema)
