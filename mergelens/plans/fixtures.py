"""Code-review tables derived from the test tables (see FIXTURES.md).

Every table covers all rows of its sources. Children are ordered by ``seq``, a struct of source
columns, so no table needs a window over a possibly huge group.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergelens.functions.arrays import each
from mergelens.functions.text import pull_request_id, truncate_patch

# Fixed values of the fixtures.
TITLES = (
    "Fix crash in ",
    "Add new option for ",
    "Update README and docs of ",
    "Bump ",
    "Hotfix: memory leak in ",
    "Implement and enable ",
    "Address review comments on ",
    "Refactor ",
    "Closes #12, resolve broken ",
    "Docker image for ",
    "Changelog entry, tutorial sample: ",
    "Latest snapshot ",
)
MESSAGES = (
    "fix #12 in parser",
    "add unittest",
    "docs: guide",
    "urgent: issue 7 resolved",
    "cleanup and refactor",
    "prefix rename",
    "improve integration test",
    "wip",
)
PRIORITY_LABELS = {"1-URGENT": "Bugfix", "2-HIGH": "enhancement", "3-MEDIUM": "Documentation",
                   "4-NOT SPECIFIED": "triage"}
ISO_DAY = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# Result files: number, modification time, first and last creation day of what they hold.
SNAPSHOTS = (
    (1, 100, "1995-01-01", "1998-01-01"),
    (2, 200, "1997-01-01", "2000-01-01"),
    (3, 300, "1999-01-01", "2001-01-01"),
    (4, 400, "2001-01-01", "2100-01-01"),
)
#: The last file is what a refresh has not seen yet; all files together hold every pull request.
LAST_SNAPSHOT = SNAPSHOTS[-1][0]
PR = ("pr_number",)


def _choose(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def _case(column: str, values: dict[str, str], otherwise: str | None = None) -> Column:
    first, *rest = values.items()
    result = F.when(F.col(column) == first[0], F.lit(first[1]))
    for key, value in rest:
        result = result.when(F.col(column) == key, F.lit(value))
    return result if otherwise is None else result.otherwise(F.lit(otherwise))


class Fixtures:
    """The derived tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str, *key: str) -> DataFrame:
        """A table for heavy per-row work, dealt over all cores by ``key``.

        The tables may be a single small file. ``key`` should be unique, so that a value that
        repeats often does not fill one task.
        """
        tasks = max(
            self.spark.sparkContext.defaultParallelism,
            int(self.spark.conf.get("spark.sql.shuffle.partitions")),
        )
        return self.table(name).repartition(tasks, *key)

    def _lines(self) -> DataFrame:
        return self.spread("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

    def _rows(self, name: str) -> Column:
        return self.table(name).agg(F.count(F.lit(1))).scalar()

    @cached_property
    def repositories(self) -> DataFrame:
        key = F.col("n_nationkey")
        languages = F.array_compact(
            F.array(
                _choose(key, ("TypeScript", "Python", "C++", "Go")),
                F.when(key % 5 == 0, None)
                .when(key % 3 == 0, F.lit("Shell"))
                .otherwise(F.lit("HTML")),
            )
        )
        day = F.expr("timestamp_ntz'2015-01-01 00:00:00' + make_dt_interval(n_nationkey * 37)")
        full_name = F.concat(F.lower("r_name"), F.lit("/"), F.col("n_name"))
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                key.alias("repo_key"),
                F.col("n_name").alias("name"),
                full_name.alias("full_name"),
                F.concat(F.lit("https://example.org/"), full_name).alias("url"),
                languages.alias("languages"),
                (key * 997 % 23000).cast("bigint").alias("stars"),
                (key * 131 % 7000).cast("bigint").alias("forks"),
                F.when(key % 6 != 0, F.concat(F.lit("Code of "), "n_name")).alias("description"),
                (key * 40009 % 1200000).cast("bigint").alias("size_kb"),
                (key % 11 == 0).alias("is_fork"),
                (key % 13 == 0).alias("is_archived"),
                F.date_format(day, ISO_DAY).alias("created_at"),
                F.date_format(day + F.expr("interval 100 days"), ISO_DAY).alias("updated_at"),
            )
        )

    def pull_requests(self, body: bool = True) -> DataFrame:
        """Pull requests with a label list; without ``body`` the text table is not read."""
        number = F.col("o_orderkey")
        day = F.col("o_orderdate")
        labels = F.array_compact(
            F.array(
                _case("o_orderpriority", PRIORITY_LABELS),
                F.when(number % 4 == 0, F.lit("area-api")),
                F.when(number % 8 == 0, F.lit("area-api")),
            )
        )
        updated = F.when(number % 2 == 0, day + F.expr("interval 3 days")).otherwise(day)
        prs = (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(
                self.repositories.select(
                    "repo_key",
                    F.col("name").alias("repository_name"),
                    F.col("full_name").alias("repository_full_name"),
                ),
                F.col("c_nationkey") == F.col("repo_key"),
            )
            .select(
                pull_request_id(F.col("repository_full_name"), number).alias("id"),
                "repository_name",
                "repository_full_name",
                number.alias("pr_number"),
                F.concat(_choose(number, TITLES), F.lower("c_mktsegment")).alias("title"),
                F.when(F.col("o_orderstatus") == "O", F.lit("open"))
                .otherwise(F.lit("closed"))
                .alias("pr_state"),
                F.date_format(day, ISO_DAY).alias("created_at"),
                F.date_format(updated, ISO_DAY).alias("updated_at"),
                F.when(F.col("o_orderstatus") == "F", F.date_format(day, ISO_DAY)).alias(
                    "merged_at"
                ),
                F.col("c_name").alias("author"),
                (number % 10 == 0).alias("draft"),
                F.when(number % 17 == 0, F.lit("dirty"))
                .otherwise(F.lit("clean"))
                .alias("mergeable_state"),
                (number * 31 % 97).alias("popularity"),
                labels.alias("labels"),
            )
        )
        if not body:
            return prs
        # Texts are the large side at scale: always a shuffled join.
        texts = self.table("documents").select("doc_id", "text").hint("merge")
        return (
            prs.withColumn("_doc", F.col("pr_number") % self._rows("documents"))
            .join(texts, F.col("_doc") == F.col("doc_id"), "left")
            .withColumn(
                "body",
                F.when(F.col("pr_number") % 7 == 1, F.lit("")).when(
                    F.col("pr_number") % 7 != 0, F.col("text")
                ),
            )
            .drop("_doc", "doc_id", "text")
        )

    @staticmethod
    def _line_order() -> Column:
        return F.struct(
            "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"
        ).alias("seq")

    @cached_property
    def commits(self) -> DataFrame:
        text = F.concat_ws("-", F.col("l_orderkey").cast("string"), "l_linenumber")
        return (
            self._lines()
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                F.col("l_orderkey").alias("pr_number"),
                self._line_order(),
                F.md5(text).alias("sha"),
                _choose(F.col("l_partkey"), MESSAGES).alias("message"),
                F.col("s_name").alias("author"),
                F.date_format("l_shipdate", ISO_DAY).alias("date"),
            )
        )

    def files(
        self, patch: bool = True, patch_limit: int | None = None, owners: DataFrame | None = None
    ) -> DataFrame:
        """Files; texts are cut to ``patch_limit`` before they are joined to the lines.

        ``owners`` are joined by their number before the texts, which do not move by it then.
        """
        deletions = F.round(F.col("l_tax") * 100).cast("bigint")
        files = (
            self._lines()
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("l_orderkey").alias("pr_number"),
                self._line_order(),
                F.concat(
                    F.lower("p_type"), F.lit("/"), "p_name", F.col("l_linenumber").cast("string")
                ).alias("filename"),
                _case("l_returnflag", {"A": "added", "R": "removed"}, "modified").alias("status"),
                F.col("l_quantity").cast("bigint").alias("additions"),
                deletions.alias("deletions"),
                (F.col("l_quantity").cast("bigint") + deletions).alias("changes"),
                "l_partkey",
                "l_linenumber",
            )
        )
        if owners is not None:
            files = files.join(owners, "pr_number")
        if not patch:
            return files.drop("l_partkey", "l_linenumber")
        text = F.col("text")
        if patch_limit is not None:
            text = truncate_patch(text, patch_limit)
        texts = self.table("documents").select("doc_id", text.alias("patch")).hint("merge")
        document = F.when(
            F.col("l_linenumber") != 7, F.col("l_partkey") % self._rows("documents")
        )
        return (
            files.withColumn("_doc", document)
            .join(texts, F.col("_doc") == F.col("doc_id"), "left")
            .drop("l_partkey", "l_linenumber", "_doc", "doc_id")
        )

    @cached_property
    def comments(self) -> DataFrame:
        prs = F.floor(self._rows("orders") / F.lit(20)).cast("bigint")
        review = F.col("event_type").isin("view", "purchase")
        missing = (F.col("event_type") == "view") & (F.col("event_id") % 9 == 0)
        return self.table("events").select(
            (F.col("event_id") % prs).alias("pr_number"),
            F.struct("ts", "event_id").alias("seq"),
            F.col("event_id").cast("string").alias("id"),
            F.col("props").alias("body"),
            F.when(~missing, F.concat(F.lit("user_"), F.col("user_id").cast("string"))).alias(
                "author"
            ),
            F.date_format("ts", ISO_MICROS).alias("date"),
            F.when(review, F.lit("review")).otherwise(F.lit("issue")).alias("type"),
            F.when(review, F.col("event_id") % 50).alias("position"),
        )

    @cached_property
    def snapshots(self) -> DataFrame:
        """Prior result files, one row per (file, pull request), all read in one scan."""
        created = F.col("created_at")
        held = F.array_compact(
            F.array(
                *[
                    F.when(
                        (created >= first) & (created < last),
                        F.struct(F.lit(number).alias("snap"), F.lit(time).alias("mtime")),
                    )
                    for number, time, first, last in SNAPSHOTS
                ]
            )
        )
        columns = ["id", "repository_name", "repository_full_name", "pr_number", "author"]
        rows = each(self.pull_requests(body=False), columns, held, "_s")
        snap = F.col("_s.snap")
        return rows.select(
            snap.alias("snap"),
            F.col("_s.mtime").alias("mtime"),
            F.concat(F.lit("snapshot_"), snap.cast("string")).alias("file"),
            F.col("pr_number").alias("pos"),
            F.col("_s.mtime").cast("string").alias("timestamp"),
            "id",
            "repository_name",
            "repository_full_name",
            "pr_number",
            "author",
            (snap != 2).alias("has_commits"),
            ((snap >= 2) & (F.col("pr_number") % 5 != 0)).alias("has_comments"),
            (snap == 3).alias("has_files"),
        )

    @property
    def prior_snapshots(self) -> DataFrame:
        """The snapshots without the last file, as a refresh finds them."""
        return self.snapshots.filter(F.col("snap") < LAST_SNAPSHOT)

    def snapshot_components(self) -> DataFrame:
        """Snapshots with components as lists that name the snapshot they came from."""

        def source(flag: str, name: str) -> Column:
            return (
                F.when(F.col(flag), F.array("snap"))
                .otherwise(F.array().cast("array<int>"))
                .alias(name)
            )

        return self.snapshots.select(
            "repository_name",
            "id",
            "mtime",
            "snap",
            source("has_commits", "commits"),
            source("has_comments", "pr_comments"),
            source("has_files", "files"),
            F.when(F.col("snap") != 2, F.concat(F.lit("type_"), F.col("snap"))).alias(
                "change_type"
            ),
        )
