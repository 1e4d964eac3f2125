"""The registered queries: every operator over the fixtures of a test-table folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergelens.config import ExtractionConfig
from mergelens.functions import text as X
from mergelens.functions.arrays import each, each_at, each_entry
from mergelens.functions.rules import DEFAULT_RULES
from mergelens.operators import apply as A
from mergelens.operators import children as C
from mergelens.operators import classify, select, sketches, snapshots, stats
from mergelens.operators import similarity as N
from mergelens.operators.assemble import assemble, join_repositories
from mergelens.operators.merge_state import Merge, fold_merge, merge_state, merged_records
from mergelens.operators.normalize import POSITION, reject_summary, with_timestamps
from mergelens.operators.rule_index import rule_matches
from mergelens.plans import extraction, landing
from mergelens.plans.fixtures import LAST_SNAPSHOT, PR, SNAPSHOTS, Fixtures
from mergelens.plans.reports import coverage_report, write_report
from mergelens.session import Cut, freed_shuffles, in_slices, new_dir, slices, stored_in_slices, whole
from mergelens.sources import documents, envelopes, pages, writers
from mergelens.sources.bucketed_state import BucketedState
from mergelens.sources.compaction import FileSet
from mergelens.sources.json_scan import read_documents
from mergelens.sources.state_table import StateTable
from mergelens.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries; the SQL counterparts use the same ones.
CHILD_CAP = 3
COMMENT_CAP = 10
PER_REPOSITORY = 50
MIN_STARS = 1000
SIZE_RANGE = (10, 1_000_000)
INCLUDE_NAMES = ("NATION_3", "NATION_7", "asia/NATION_8", "europe/NATION_19", "no/such")
INCLUDE_LANGUAGES = ("Python", "Go")
EXCLUDE_LANGUAGES = ("Shell",)
MIN_FILES = 3
BATCH = 300
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on",
    "or", "that", "the", "this", "to", "was", "with",
)
MAX_TERMS = 1000
EXTRACTED_REPOSITORIES = 10
SMALL_FILES = 32 << 20
#: Lines of a slice where they move with their texts, and where they move without.
WIDE_LINES, NARROW_LINES = 4_000_000, 20_000_000


def query(function: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    """Register a query under the name of its function."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(Fixtures(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


# Shared frames


def _nested(fx: Fixtures, cut: Cut = whole) -> DataFrame:
    return assemble(
        cut(fx.pull_requests()), fx.repositories, cut(fx.commits), cut(fx.comments),
        cut(fx.files(patch_limit=X.PATCH_LIMIT)), key=PR,
    )


def _listed(fx: Fixtures) -> DataFrame:
    """The pull requests of ``_nested``, a row each, without texts and children."""
    return join_repositories(fx.pull_requests(body=False), fx.repositories)


def _measured(fx: Fixtures) -> DataFrame:
    """Pull requests with measures, nothing nested."""
    counts = C.count_children(fx.commits, fx.comments, fx.files(patch=False), PR)
    return stats.join_measures(fx.pull_requests(body=False), counts, PR)


def _flat(fx: Fixtures, cut: Cut = whole) -> DataFrame:
    """Classified records with measures, built from the child tables without nesting them."""
    body = F.coalesce("body", F.lit(""))
    prs = cut(fx.pull_requests()).withColumns(
        {
            "description": X.cut(body, X.DESCRIPTION_LIMIT, X.DESCRIPTION_SUFFIX),
            "tags": X.tags(F.col("labels"), F.col("draft"), F.col("mergeable_state")),
        }
    )
    scored = classify.score_pull_requests(prs, cut(fx.commits), PR)
    counts = [C.count_comments(cut(fx.comments), PR), C.count_files(cut(fx.files(patch=False)), PR)]
    return stats.join_measures(join_repositories(scored, fx.repositories), counts, PR)


def _scored(fx: Fixtures) -> DataFrame:
    return classify.score_pull_requests(fx.pull_requests(), fx.commits, PR)


def _slices(fx: Fixtures, lines: int) -> int:
    """How many slices of the pull requests have about so many lines each."""
    return max(1, -(-fx.table("lineitem").count() // lines))


def _sliced(fx: Fixtures, lines: int, made: Callable[[Cut], DataFrame]) -> DataFrame:
    return stored_in_slices(fx.spark, PR, _slices(fx, lines), made)


def _latest(fx: Fixtures) -> DataFrame:
    return snapshots.latest_records(fx.snapshots)


def _prior(fx: Fixtures) -> DataFrame:
    return snapshots.latest_records(fx.prior_snapshots)


# Repositories


@query
def repo_select(fx: Fixtures) -> DataFrame:
    top = select.select_repositories(
        fx.repositories, min_stars=MIN_STARS, min_size_kb=SIZE_RANGE[0], max_size_kb=SIZE_RANGE[1]
    )
    return top.select(
        F.col("full_name").alias("repository_full_name"),
        F.col("stars").alias("repository_stars"),
    )


@query
def repo_include(fx: Fixtures) -> DataFrame:
    kept = select.include_repositories(fx.repositories, INCLUDE_NAMES)
    return kept.select(F.col("full_name").alias("repository_full_name"))


@query
def repo_language_filter(fx: Fixtures) -> DataFrame:
    kept = select.filter_languages(fx.repositories, INCLUDE_LANGUAGES, EXCLUDE_LANGUAGES)
    return kept.select(
        F.col("full_name").alias("repository_full_name"),
        X.join_with("|", F.col("languages")).alias("languages"),
    )


@query
def repo_languages(fx: Fixtures) -> DataFrame:
    return pages.languages_from_pages(landing.language_pages(fx)).select(
        F.col("full_name").alias("repository_full_name"),
        X.join_with("|", F.array_sort("languages")).alias("languages"),
    )


@query
def norm_repo(fx: Fixtures) -> DataFrame:
    return pages.repositories_from_pages(landing.repository_pages(fx)).drop("languages")


# Children and pull requests from landed pages


@query
def norm_commit(fx: Fixtures) -> DataFrame:
    landed = landing.commit_pages(fx.commits, PR)
    return pages.commits_from_pages(landed, PR).drop(POSITION)


@query
def norm_comment(fx: Fixtures) -> DataFrame:
    issue = landing.comment_pages(fx.comments, "issue", PR)
    review = landing.comment_pages(fx.comments, "review", PR)
    return pages.comments_from_pages(issue, review, PR).drop(POSITION)


@query
def norm_file(fx: Fixtures) -> DataFrame:
    return pages.files_from_pages(landing.file_pages(fx.files(), PR), PR).select(
        "pr_number", "filename", "status", "additions", "deletions", "changes",
        F.length("patch").alias("patch_length"),
        F.md5("patch").alias("patch_md5"),
    )


@query
def norm_pull_request(fx: Fixtures) -> DataFrame:
    return pages.pull_requests_from_pages(landing.pull_request_pages(fx)).select(
        "id", "pr_number", "title", "pr_state", "created_at", "updated_at", "merged_at",
        "author", "draft", "popularity",
        F.length("body").alias("body_length"),
        X.join_with("|", F.col("labels")).alias("labels"),
    )


@query
def reject_split(fx: Fixtures) -> DataFrame:
    broken = fx.pull_requests(body=False).withColumn(
        "author", F.when(F.col("pr_number") % 19 != 0, F.col("author"))
    )
    return reject_summary(broken)


@query
def pr_key(fx: Fixtures) -> DataFrame:
    prs = fx.pull_requests(body=False)
    return prs.select(
        "pr_number",
        X.pull_request_id(F.col("repository_full_name"), F.col("pr_number")).alias("id"),
    )


@query
def surrogate_key(fx: Fixtures) -> DataFrame:
    return fx.pull_requests(body=False).select(
        "pr_number",
        X.pull_request_data_key(F.col("repository_full_name"), F.col("pr_number")).alias("key"),
        X.repository_languages_key(F.col("repository_full_name")).alias("languages_key"),
    )


@query
def pr_select(fx: Fixtures) -> DataFrame:
    return select.select_pull_requests(
        fx.pull_requests(body=False), max_per_repository=PER_REPOSITORY
    ).select("repository_full_name", "id", F.col("rank").cast("bigint").alias("rank"))


# Caps, nesting, texts


def _ranked(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("pr_number", F.col("rank").cast("bigint").alias("rank"), *columns)


@query
def commits_capped(fx: Fixtures) -> DataFrame:
    return _ranked(C.cap_commits(fx.commits, PR, CHILD_CAP), "sha")


@query
def files_capped(fx: Fixtures) -> DataFrame:
    return _ranked(C.cap_files(fx.files(patch=False), PR, CHILD_CAP), "filename")


@query
def comments_capped(fx: Fixtures) -> DataFrame:
    return _ranked(C.cap_comments(fx.comments, PR, COMMENT_CAP), "type", "id")


@query
def commit_map(fx: Fixtures) -> DataFrame:
    nested = C.nest_commits(fx.commits, PR)
    return each_entry(nested, ["pr_number"], F.col("commits"), "sha", "_c").select(
        "pr_number", "sha", "_c.*"
    )


@query
def comment_array(fx: Fixtures) -> DataFrame:
    nested = C.nest_comments(fx.comments, PR)
    return each_at(nested, ["pr_number"], F.col("pr_comments"), "pos", "_c").select(
        "pr_number", "pos", "_c.id", "_c.body", "_c.author", "_c.date", "_c.type",
        F.col("_c.position").alias("position"),
    )


@query
def file_array(fx: Fixtures) -> DataFrame:
    def held(cut: Cut) -> DataFrame:
        nested = C.nest_files(cut(fx.files(patch_limit=X.PATCH_LIMIT)), PR)
        return each_at(nested, ["pr_number"], F.col("files"), "pos", "_f").select(
            "pr_number", "pos", "_f.filename", "_f.status", "_f.additions", "_f.deletions",
            "_f.changes",
            F.length("_f.patch").alias("patch_length"),
            F.md5("_f.patch").alias("patch_md5"),
        )

    return _sliced(fx, WIDE_LINES, held)


@query
def patch_truncate(fx: Fixtures) -> DataFrame:
    cut = X.truncate_patch(F.col("patch"))
    return fx.files().select(
        "pr_number", "filename", F.length(cut).alias("patch_length"), F.md5(cut).alias("patch_md5")
    )


@query
def tags(fx: Fixtures) -> DataFrame:
    names = X.tags(F.col("labels"), F.col("draft"), F.col("mergeable_state"))
    return fx.pull_requests(body=False).select("id", X.join_with("|", names).alias("tags"))


@query
def assemble_pr(fx: Fixtures) -> DataFrame:
    def summary(cut: Cut) -> DataFrame:
        return _nested(fx, cut).select(
            "id", "repository_url", "repository_name", "repository_stars", "repository_forks",
            "title", "change_type", "change_type_confidence", "pr_number", "pr_state",
            "created_at", "updated_at", "merged_at", "author", "draft",
            F.length("description").alias("description_length"),
            X.join_with("|", F.col("repository_language")).alias("repository_language"),
            X.join_with("|", F.col("tags")).alias("tags"),
            F.size("change_type_reasons").alias("reasons"),
            F.size("commits").alias("commits"),
            F.size("pr_comments").alias("comments"),
            F.size("files").alias("files"),
            F.col("components_updated.files").alias("files_updated"),
        )

    return _sliced(fx, WIDE_LINES, summary)


@query
def flatten_csv(fx: Fixtures) -> DataFrame:
    return _sliced(fx, NARROW_LINES, lambda cut: stats.flatten(_flat(fx, cut)))


@query
def min_changed_files(fx: Fixtures) -> DataFrame:
    counts = C.count_files(fx.files(patch=False), PR)
    counted = fx.pull_requests(body=False).join(counts, "pr_number")
    return select.with_min_changed_files(counted, MIN_FILES).select("id", "files_count")


# Classification


@query
def rule_hits(fx: Fixtures) -> DataFrame:
    return classify.count_rule_hits(fx.pull_requests(), fx.commits, PR)


@query
def rule_index(fx: Fixtures) -> DataFrame:
    """Every longer word of the benchmark as a substring rule over all documents."""
    words = fx.table("benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{5,})"), 1)).alias("pattern")
    ).distinct()
    texts = fx.spread("documents", "doc_id").select("doc_id", F.lower("text").alias("text"))
    found = rule_matches(texts, "doc_id", "text", words.select(F.col("pattern").alias("rule"), "pattern"))
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rules"), F.sum(F.length("rule")).alias("letters"), F.min("rule").alias("first")
    )


@query
def change_type(fx: Fixtures) -> DataFrame:
    return _scored(fx).select(
        "id", "points_fix", "points_feature", "points_doc", "change_type",
        F.col("change_type_confidence").alias("confidence"), "reason_count",
    )


@query
def change_reasons(fx: Fixtures) -> DataFrame:
    """How often each reason is given to a pull request."""

    def counted(cut: Cut) -> DataFrame:
        messages = C.commit_messages(cut(fx.commits), PR)
        # The body is searched and dropped before the join, so that texts do not move by the number.
        searched = classify.own_text(cut(fx.pull_requests()), DEFAULT_RULES).drop("body")
        nested = classify.classify_nested(
            searched.join(messages, "pr_number", "left"), commit_profile=True
        )
        return (
            each(nested, ["id"], F.col("change_type_reasons"), "reason")
            .groupBy("id", "reason")
            .agg(F.count(F.lit(1)).alias("times"))
        )

    parts = _slices(fx, NARROW_LINES)
    found = stored_in_slices(fx.spark, PR, parts, counted)
    if parts == 1:
        return found
    # An id has its number in it; those without one may be of several numbers and are added up.
    unnamed = found.where("id IS NULL").groupBy("id", "reason").agg(F.sum("times").alias("times"))
    return found.where("id IS NOT NULL").unionByName(unnamed)


@query
def change_type_basic(fx: Fixtures) -> DataFrame:
    return classify.classify_basic(fx.pull_requests()).select(
        "id", "change_type", "change_type_confidence"
    )


@query
def commit_profile(fx: Fixtures) -> DataFrame:
    return classify.profile_commits(fx.commits, PR)


def _similarity(fx: Fixtures) -> DataFrame:
    messages = C.commit_messages(fx.commits, PR)
    model = N.Prototypes(fx.spark, stop_words=STOP_WORDS)
    return N.pull_request_similarity(fx.pull_requests(), messages, PR, model)


@query
def similarity(fx: Fixtures) -> DataFrame:
    return _similarity(fx).select(
        "pr_number",
        *[
            F.round(f"similarity_{name}", 6).alias(f"similarity_{name}")
            for name in N.PROTOTYPES
        ],
    )


@query
def change_type_full(fx: Fixtures) -> DataFrame:
    """Classification with the similarity term and the commit profile."""
    scored = classify.score_pull_requests(
        fx.pull_requests(), fx.commits, PR, commit_profile=True, similarity=_similarity(fx)
    )
    return scored.select(
        "id", "points_fix", "points_feature", "points_doc", "change_type",
        F.round("change_type_confidence", 6).alias("confidence"), "reason_count",
    )


@query
def tokens(fx: Fixtures) -> DataFrame:
    """Words of every document without stop words, counted."""
    words = N.tokens(F.col("text"), STOP_WORDS)
    return (
        fx.spread("documents", "doc_id")
        .transform(each, [], words, "token")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("count"))
    )


@query
def tokens_stemmed(fx: Fixtures) -> DataFrame:
    """Stems of every document's words, counted; each distinct word is stemmed once."""
    counted = tokens(fx)
    stem = F.element_at(N.stem_words(F.array("token")), 1)
    return counted.groupBy(stem.alias("stem")).agg(F.sum("count").alias("count"))


@query
def tfidf(fx: Fixtures) -> DataFrame:
    docs = fx.spread("documents", "doc_id").select("doc_id", "text")
    vocabulary = N.fit_text_vocabulary(docs, "text", STOP_WORDS, max_features=MAX_TERMS)
    known = [row["term"] for row in vocabulary.select("term").collect()]
    terms = N.with_terms(docs, "text", STOP_WORDS, known=known)
    return N.tfidf_weights(terms, vocabulary, ["doc_id"]).select(
        "doc_id", "term", F.round("weight", 6).alias("weight")
    )


@query
def document_similarity(fx: Fixtures) -> DataFrame:
    """Cosine of every document with the three prototypes."""
    scored = N.text_similarity(
        fx.spread("documents", "doc_id").select("doc_id", "text"), ["doc_id"],
        prototypes=N.Prototypes(fx.spark, stop_words=STOP_WORDS),
    )
    return scored.select(
        "doc_id",
        *[
            F.round(f"similarity_{name}", 6).alias(f"similarity_{name}")
            for name in N.PROTOTYPES
        ],
    )


# Statistics


@query
def repo_distribution(fx: Fixtures) -> DataFrame:
    return stats.distribution(fx.pull_requests(body=False), "repository_name")


@query
def language_distribution(fx: Fixtures) -> DataFrame:
    return stats.languages_of_repositories(fx.pull_requests(body=False), fx.repositories)


@query
def change_type_distribution(fx: Fixtures) -> DataFrame:
    return stats.distribution(_scored(fx), "change_type")


@query
def change_type_confidence(fx: Fixtures) -> DataFrame:
    return stats.change_type_confidence(_scored(fx))


@query
def top_authors(fx: Fixtures) -> DataFrame:
    return stats.top_authors(fx.pull_requests(body=False))


@query
def top_authors5(fx: Fixtures) -> DataFrame:
    return stats.top_values(fx.snapshots, "author", 5)


@query
def top_repos(fx: Fixtures) -> DataFrame:
    return stats.top_values(fx.snapshots, "repository_full_name", 5)


@query
def repo_summary(fx: Fixtures) -> DataFrame:
    return stats.repository_summary(fx.pull_requests(body=False))


@query
def totals(fx: Fixtures) -> DataFrame:
    return stats.totals(_measured(fx))


@query
def averages(fx: Fixtures) -> DataFrame:
    return stats.averages(_measured(fx))


@query
def statistics(fx: Fixtures) -> DataFrame:
    counted = ["repository_name", "repository_language", "change_type", "author", *stats.MEASURES]
    return stats.statistics(_sliced(fx, NARROW_LINES, lambda cut: _flat(fx, cut).select(*counted)))


@query
def coverage(fx: Fixtures) -> DataFrame:
    return stats.coverage(fx.snapshots)


@query
def coverage_pct(fx: Fixtures) -> DataFrame:
    return stats.coverage_percentages(fx.snapshots)


@query
def distinct_per_repo(fx: Fixtures) -> DataFrame:
    return stats.distinct_per_repository(fx.snapshots)


@query
def distinct_sketches(fx: Fixtures) -> DataFrame:
    """Distinct ids per repository from sketches kept per file, beside the exact count."""
    kept = new_dir(fx.spark, "sketches")
    sketches.distinct_sketches(fx.snapshots, ["file", "repository_name"]).write.parquet(kept)
    found = sketches.distinct_counts(fx.spark.read.parquet(kept), ["repository_name"])
    near = F.abs(F.col("distinct") - F.col("unique_prs")) <= 0.05 * F.col("unique_prs")
    return found.join(distinct_per_repo(fx), "repository_name").select(
        "repository_name", "rows", "unique_prs", near.alias("near")
    )


@query
def top_authors_sketched(fx: Fixtures) -> DataFrame:
    """The top authors from sketches kept per repository, counted exactly in a second pass."""
    records, kept = fx.pull_requests(body=False), new_dir(fx.spark, "frequent")
    sketches.frequent_sketches(records, ["repository_name"]).write.parquet(kept)
    return sketches.top_of_sketches(fx.spark.read.parquet(kept), records, 10)


@query
def distinct_totals(fx: Fixtures) -> DataFrame:
    return stats.distinct_totals(fx.snapshots)


# Snapshots


def _snapshot_columns(df: DataFrame) -> DataFrame:
    return df.select("repository_name", "id", "snap", *snapshots.FLAGS)


@query
def latest_snapshot(fx: Fixtures) -> DataFrame:
    return _snapshot_columns(_latest(fx))


@query
def component_status(fx: Fixtures) -> DataFrame:
    """State by field presence: comments are absent from the first file, files from the second."""
    parts = fx.snapshot_components().withColumns(
        {
            "pr_comments": F.when(F.col("snap") != 1, F.col("pr_comments")),
            "files": F.when(F.col("snap") != 2, F.col("files")),
            "timestamp": F.col("mtime").cast("string"),
        }
    )
    flagged = stats.with_presence(parts, "key")
    return snapshots.component_status(flagged, snapshots.newest_first("mtime", None, None))


@query
def state_summary(fx: Fixtures) -> DataFrame:
    return snapshots.state_summary(_latest(fx))


@query
def state_per_repository(fx: Fixtures) -> DataFrame:
    return snapshots.state_per_repository(_latest(fx))


@query
def needs_refresh(fx: Fixtures) -> DataFrame:
    kept = snapshots.needs_refresh(fx.pull_requests(body=False), _prior(fx))
    return kept.select("id", "is_new", "need_commits", "need_comments", "need_files")


@query
def new_only(fx: Fixtures) -> DataFrame:
    return snapshots.new_only(fx.pull_requests(body=False), _prior(fx)).select("id")


@query
def refresh_plan(fx: Fixtures) -> DataFrame:
    return snapshots.refresh_plan(fx.pull_requests(body=False), _prior(fx))


def _merged_columns(df: DataFrame) -> DataFrame:
    def source(name: str) -> Column:
        return F.try_element_at(F.col(name), F.lit(1)).alias(f"{name}_from")

    return df.select(
        "repository_name", "id", "snap", source("commits"), source("pr_comments"),
        source("files"), "change_type",
    )


@query
def snapshot_merge(fx: Fixtures) -> DataFrame:
    """Every file merged into the merge of those before it."""
    parts = fx.snapshot_components()
    first, *later = [parts.filter(F.col("snap") == number) for number, *_ in SNAPSHOTS]
    for new in later:
        first = snapshots.merge_snapshots(first, new, kept={"change_type": ()})
    return _merged_columns(first)


@query
def snapshot_history(fx: Fixtures) -> DataFrame:
    """The same merge over all files in one aggregation."""
    return _merged_columns(
        snapshots.merge_history(
            fx.snapshot_components(), F.struct("mtime", "snap"), kept={"change_type": ()}
        )
    )


@query
def state_update(fx: Fixtures) -> DataFrame:
    """State of the prior files, updated by the last."""
    first = snapshots.fold_state(fx.prior_snapshots)
    return snapshots.update_state(first, fx.snapshots.filter(F.col("snap") == LAST_SNAPSHOT))


@query
def compact(fx: Fixtures) -> DataFrame:
    target = new_dir(fx.spark, "compact")
    snapshots.compact(fx.snapshots, target)
    return _snapshot_columns(fx.spark.read.parquet(target))


@query
def compact_planned(fx: Fixtures) -> DataFrame:
    """Every file added as a save, then small files packed; the rows, and whether others kept their names."""
    held = FileSet(fx.spark, new_dir(fx.spark, "file-set"))
    for number, *_ in SNAPSHOTS:
        held.add(fx.snapshots.filter(F.col("snap") == number))
    stay = held.files().join(held.plan(SMALL_FILES).select("path"), "path", "left_anti").select("path")
    version = held.version()
    held.compact(SMALL_FILES)
    lost = stay.join(held.files().select("path"), "path", "left_anti").count()
    fewer = held.files().count() < held.files(version).count()
    return _snapshot_columns(held.read()).withColumns({"lost": F.lit(lost), "fewer": F.lit(fewer)})


@query
def merge_bucketed(fx: Fixtures) -> DataFrame:
    """Every file merged into a state that stays in its buckets."""
    merge, parts = Merge(kept={"change_type": ()}), fx.snapshot_components()
    state = BucketedState(fx.spark, new_dir(fx.spark, "bucketed"), merge, buckets=8)
    for number, *_ in SNAPSHOTS:
        new = parts.filter(F.col("snap") == number)
        state.merge(merge_state(new, F.struct("mtime", "snap"), merge))
    return _merged_columns(merged_records(state.read(), parts.columns, merge))


@query
def batch_assign(fx: Fixtures) -> DataFrame:
    batched = snapshots.assign_batches(
        fx.pull_requests(body=False).select("repository_name", "id"), BATCH, [F.col("id").asc()]
    )
    return batched.select(
        "repository_name", "id", "batch", "batches",
        snapshots.batch_name(F.col("repository_name"), F.col("batch"), F.col("batches")).alias(
            "batch_name"
        ),
    )


@query
def batch_metadata(fx: Fixtures) -> DataFrame:
    flagged = snapshots.mark_needs(fx.pull_requests(body=False), _prior(fx)).withColumn(
        "components_updated",
        F.struct(
            F.col("need_commits").alias("commits"),
            F.col("need_comments").alias("comments"),
            F.col("need_files").alias("files"),
        ),
    )
    row = writers.batch_metadata(flagged, ExtractionConfig(), final=True)
    return row.select(
        "total_prs", "is_incremental_save", "is_final_save", "batch_name",
        "component_updates.commits", "component_updates.comments", "component_updates.files",
        "configuration.organization", "configuration.top_n_repositories",
        "configuration.max_prs_per_repo", "configuration.batch_size",
    )


# The whole job


@query
def extraction_run(fx: Fixtures) -> DataFrame:
    """Pages landed, extracted twice: commits and comments first, then the missing files.

    The second run keeps what the first one stored.
    """
    landed, output = new_dir(fx.spark, "pages"), new_dir(fx.spark, "extraction")
    landing.land_all(fx, landed)
    config = ExtractionConfig(top_n_repositories=EXTRACTED_REPOSITORIES)
    first = replace(config, include_file_diffs=False)
    extraction.run_extraction(fx.spark, landed, output, "run1", first)
    extraction.run_extraction(fx.spark, landed, output, "run2", config)
    final = extraction.stored_records(fx.spark, output)
    return stats.with_measures(final).groupBy("repository_name", "change_type").agg(
        F.count(F.lit(1)).alias("prs"),
        *[F.sum(name).alias(name) for name in stats.MEASURES],
    )


@query
def extraction_rejects(fx: Fixtures) -> DataFrame:
    """Pages landed with faults: numbers missing, commit pages cut in half, files without name.

    What the job rejects, by listing and reason, and what it keeps.
    """
    landed, output = new_dir(fx.spark, "faulty"), new_dir(fx.spark, "faulty-extraction")

    def faulty(name: str, frame: DataFrame) -> DataFrame:
        number, body = F.col("page" if name == "pull_requests" else "pr_number"), F.col("body")
        if name == "pull_requests":
            named = F.concat(F.lit('"number":'), number.cast("string"), F.lit(","))
            body = F.when(number % 11 == 0, F.replace(body, named, F.lit(""))).otherwise(body)
        elif name == "commits":
            half = F.left(body, (F.length(body) / 2).cast("int"))
            body = F.when(number % 13 == 0, half).otherwise(body)
        elif name == "files":
            unnamed = F.replace(body, F.lit('"filename":'), F.lit('"name":'))
            body = F.when(number % 17 == 0, unnamed).otherwise(body)
        return frame.withColumn("body", body)

    landing.land_all(fx, landed, faulty)
    config = ExtractionConfig(
        top_n_repositories=1_000, exclude_forks=False, exclude_archived=False, pr_state="all"
    )
    target = extraction.run_extraction(fx.spark, landed, output, "run1", config)
    rejects = fx.spark.read.json(f"{output}/rejects").groupBy("listing", "reject_reason").agg(
        F.count(F.lit(1)).alias("count")
    )
    kept = fx.spark.read.parquet(target).agg(F.count(F.lit(1)).alias("count")).select(
        F.lit("records").alias("listing"), F.lit("kept").alias("reject_reason"), "count"
    )
    return rejects.unionByName(kept)


# Sources and sinks


def _stored_summary(records: DataFrame) -> DataFrame:
    flat = stats.with_measures(records)
    return flat.groupBy("repository_name").agg(
        F.count(F.lit(1)).alias("prs"),
        F.count_distinct("id").alias("ids"),
        *[F.sum(name).alias(name) for name in stats.MEASURES],
    )


@query
def scan_envelope(fx: Fixtures) -> DataFrame:
    """Records written as envelopes of 300 and read back."""
    target = new_dir(fx.spark, "envelopes")
    writers.write_envelopes(_nested(fx), target, BATCH, placed=PR, listed=_listed(fx))
    files = envelopes.read_envelopes(fx.spark, target, "*.json")
    return _stored_summary(envelopes.records(files))


@query
def sink_json(fx: Fixtures) -> DataFrame:
    target = new_dir(fx.spark, "records")
    in_slices(
        fx.spark, PR, _slices(fx, WIDE_LINES),
        lambda cut: writers.write_records(_nested(fx, cut), target, "json", "append"),
    )
    return _stored_summary(envelopes.read_records(fx.spark, target, "json"))


def _contents(records: DataFrame) -> DataFrame:
    """Every field of a record that is no component; long texts as digests."""
    return stats.with_measures(records).select(
        "id", "repository_url", "repository_name", "repository_full_name", "repository_stars",
        "repository_forks", "title", "change_type", "change_type_confidence", "pr_number",
        "pr_state", "created_at", "updated_at", "merged_at", "author", "draft", *stats.MEASURES,
        F.md5("description").alias("description_md5"),
        X.join_with("|", F.col("repository_language")).alias("repository_language"),
        X.join_with("|", F.col("tags")).alias("tags"),
        F.size("change_type_reasons").alias("reasons"),
        F.col("components_updated.files").alias("files_updated"),
    )


@query
def scan_any_layout(fx: Fixtures) -> DataFrame:
    """Documents on one line or indented, a file each, read record by record in splits."""
    target = new_dir(fx.spark, "layouts")
    plain, pretty = ({"ignoreNullFields": "false"} | more for more in ({}, {"pretty": "true"}))
    document = F.struct("metadata", "data")
    one_line = F.xxhash64("metadata.batch_name") % 2 == 0
    layouts = writers.to_envelopes(_nested(fx), BATCH, placed=PR, listed=_listed(fx)).select(
        F.col("metadata.batch_name").alias("save"),
        F.when(one_line, F.to_json(document, plain)).otherwise(F.to_json(document, pretty)).alias("value"),
    )
    with freed_shuffles(fx.spark):
        layouts.write.partitionBy("save").text(target)
    records, rejects = read_documents(fx.spark, target, "part-*")
    return _contents(records).withColumn("rejected", F.lit(rejects.count()))


def _saved(fx: Fixtures, final: bool) -> str:
    """Documents of all records, from a stored table of the saves; the folder they are in.

    Records get their saves where they are nested, so that they move once more only, to their file.
    """
    stored, target = new_dir(fx.spark, "stored"), new_dir(fx.spark, "documents")
    records, near = _nested(fx), {"placed": PR, "listed": _listed(fx)}
    saves = documents.final_saves(records, **near) if final else documents.batch_saves(records, BATCH, **near)
    with freed_shuffles(fx.spark):
        saves.write.option("compression", "zstd").parquet(stored)
    documents.write_documents(fx.spark.read.parquet(stored), target, incremental=not final, final=final)
    return target


@query
def document_records(fx: Fixtures) -> DataFrame:
    """Saves of 300 records written as documents; every record read back."""
    return _contents(read_documents(fx.spark, _saved(fx, final=False), "part-*")[0])


@query
def document_children(fx: Fixtures) -> DataFrame:
    """Every commit, comment and file of final documents read back; texts as digests."""
    back = read_documents(fx.spark, _saved(fx, final=True), "part-*")[0]

    def texts(*columns: str) -> Column:
        return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]))

    commits = each_entry(back, ["pr_number"], F.col("commits"), "key", "_c").select(
        "pr_number", F.lit("commit").alias("part"), "key",
        texts("_c.commit_message", "_c.author", "_c.date").alias("content"),
    )
    comments = each_at(back, ["pr_number"], F.col("pr_comments"), "pos", "_c").select(
        "pr_number", F.lit("comment").alias("part"), F.col("pos").cast("string").alias("key"),
        texts("_c.id", "_c.body", "_c.author", "_c.date", "_c.type", "_c.position").alias("content"),
    )
    files = each_at(back, ["pr_number"], F.col("files"), "pos", "_f").select(
        "pr_number", F.lit("file").alias("part"), F.col("pos").cast("string").alias("key"),
        texts(
            "_f.filename", "_f.status", "_f.additions", "_f.deletions", "_f.changes", "_f.patch"
        ).alias("content"),
    )
    return commits.unionByName(comments).unionByName(files)


@query
def document_statistics(fx: Fixtures) -> DataFrame:
    """The statistics inside the final documents, one row per value."""
    lines = fx.spark.read.text(_saved(fx, final=True)).filter(F.col("value").startswith('{"metadata"'))
    counts = "MAP<STRING, DOUBLE>"
    names = (
        "repository_distribution", "language_distribution", "change_type_distribution",
        "top_authors", "aggregate_stats",
    )
    inner = ", ".join(f"{name}: {counts}" for name in names)
    parsed = lines.select(
        "save",
        F.from_json(
            F.concat("value", F.lit("]}")),
            f"metadata STRUCT<total_prs: BIGINT, is_final_save: BOOLEAN, statistics: STRUCT<{inner}>>",
        )["metadata"].alias("meta"),
    )
    metrics = F.create_map(*[x for n in names for x in (F.lit(n), F.col("meta.statistics")[n])])
    return (
        parsed.select(
            F.regexp_extract("save", "^(.*)_final_", 1).alias("repository_name"),
            F.col("meta.total_prs").alias("total_prs"),
            F.col("meta.is_final_save").alias("is_final_save"),
            F.explode(metrics).alias("metric", "held"),
        )
        .select("repository_name", "total_prs", "is_final_save", "metric", F.explode("held").alias("key", "value"))
    )


@query
def sink_csv(fx: Fixtures) -> DataFrame:
    """The flat form written as CSV and read back."""
    target = new_dir(fx.spark, "csv")
    in_slices(
        fx.spark, PR, _slices(fx, NARROW_LINES),
        lambda cut: writers.write_csv(stats.flatten(_flat(fx, cut)), target, "append"),
    )
    back = (
        fx.spark.read.schema(stats.flatten(_flat(fx)).schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(target)
    )
    return back.select(
        "id", "repository_language", "title", "tags", "commits_count", "comments_count",
        "files_count", "additions", "pr_number", "author", "draft",
    )


@query
def csv_side_outputs(fx: Fixtures) -> DataFrame:
    """What a CSV save writes beside the flat form: metadata and statistics, read back."""
    target = new_dir(fx.spark, "csv-save")
    config = ExtractionConfig(output_format="csv", batch_size=BATCH)
    writers.write_save(
        _nested(fx), target, config, final=True, name="all",
        listed=_listed(fx), slices=(_nested(fx, cut) for cut in slices(PR, _slices(fx, WIDE_LINES))),
    )
    held = fx.spark.read.schema("metric STRING, key STRING, value DOUBLE").json(f"{target}/statistics")
    meta = fx.spark.read.schema(
        "total_prs BIGINT, is_final_save BOOLEAN, batch_name STRING, configuration STRUCT<batch_size: BIGINT>"
    ).json(f"{target}/metadata")
    counted = fx.spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(
        f"{target}/csv"
    ).agg(F.count("id").cast("double").alias("value"))
    return (
        held.unionByName(
            meta.filter("is_final_save AND batch_name = 'all'").select(
                F.lit("metadata").alias("metric"),
                F.explode(
                    F.create_map(
                        F.lit("total_prs"), F.col("total_prs").cast("double"),
                        F.lit("batch_size"), F.col("configuration.batch_size").cast("double"),
                    )
                ).alias("key", "value"),
            )
        ).unionByName(counted.select(F.lit("csv").alias("metric"), F.lit("rows").alias("key"), "value"))
    )


@query
def report_files(fx: Fixtures) -> DataFrame:
    """The coverage report written as JSON and read back, one row per value."""
    target = new_dir(fx.spark, "report")
    held = {
        "commits": "has_commits", "pr_comments": "has_comments", "files": "has_files",
    }
    lists = {
        name: F.when(F.col(flag), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
        for name, flag in held.items()
    }
    write_report(coverage_report(fx.snapshots.withColumns(lists).drop(*snapshots.FLAGS)), target)
    one = fx.spark.read.json(f"{target}/coverage")
    counts = one.select(F.explode(F.map_from_arrays(
        F.array(*map(F.lit, one.columns)), F.array(*[F.col(c).cast("double") for c in one.columns])
    )).alias("key", "value")).select(F.lit("coverage").alias("report"), "key", "value")
    for name, key in (("top_repositories", "repository_full_name"), ("top_authors", "author")):
        rows = fx.spark.read.json(f"{target}/{name}")
        counts = counts.unionByName(
            rows.select(F.lit(name).alias("report"), F.col(key).alias("key"), F.col("count").cast("double").alias("value"))
        )
    return counts


@query
def timestamps(fx: Fixtures) -> DataFrame:
    """Text dates as typed times; every third one is unreadable and becomes null."""
    prs = fx.pull_requests(body=False).withColumn(
        "created_at", F.when(F.col("pr_number") % 3 == 0, F.concat(F.lit("x"), "created_at")).otherwise(F.col("created_at"))
    )
    typed = with_timestamps(prs.select("id", "created_at", "merged_at"), "created_at", "merged_at")
    return typed.select(
        "id", F.unix_seconds("created_at_ts").alias("created"), F.unix_seconds("merged_at_ts").alias("merged")
    )


@query
def scan_quarantine(fx: Fixtures) -> DataFrame:
    """Half of the result documents are cut in half: they are quarantined, the others read."""
    target = new_dir(fx.spark, "quarantine")
    document = F.to_json(
        F.struct(
            F.struct(F.col("mtime").cast("string").alias("extraction_timestamp")).alias("metadata"),
            F.array(F.struct("id", "repository_name", "pr_number")).alias("data"),
        )
    )
    broken = F.col("pr_number") % 2 == 1
    text = F.when(broken, F.left(document, (F.length(document) / 2).cast("int"))).otherwise(
        document
    )
    fx.snapshots.select(text.alias("value")).write.text(target)
    lines = envelopes.read_document_lines(fx.spark, target)
    good = envelopes.records(lines).agg(F.count(F.lit(1)).alias("count")).select(
        F.lit("record").alias("kind"), "count"
    )
    bad = envelopes.quarantined(lines).groupBy(F.col("reason").alias("kind")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return good.unionByName(bad)


@query
def decode_contents(fx: Fixtures) -> DataFrame:
    """Every third document comes with an unknown encoding and decodes to nothing."""
    content = F.base64(F.encode("text", "UTF-8"))
    contents = fx.spread("documents", "doc_id").select(
        "doc_id",
        content.alias("content"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("none")).otherwise(F.lit("base64")).alias(
            "encoding"
        ),
    )
    return pages.decode_contents(contents, "doc_id").select(
        "doc_id", F.length("text").alias("length"), F.md5("text").alias("md5")
    )


def _describe(row: dict[str, Any], prefix: str) -> list[dict[str, Any]]:
    """A caller's function: one row per language, a failure for archived repositories."""
    if row["is_archived"]:
        raise ValueError("archived")
    return [{"label": f"{prefix}{language}"} for language in row["languages"]]


@query
def per_repo_apply(fx: Fixtures) -> DataFrame:
    applied = A.apply_per_repository(
        fx.repositories.select("full_name", "is_archived", "languages"),
        _describe, "label string", prefix="lang:",
    )
    return applied.select("full_name", "label", "error")


# Streaming


def _landed_stream(fx: Fixtures, frame: DataFrame) -> DataFrame:
    """Snapshots as files, read by a stream."""
    landed = new_dir(fx.spark, "landed")
    frame.write.parquet(landed)
    return ingest.read_result_stream(fx.spark, landed, frame.schema, files_per_trigger=4)


def _streamed_latest(fx: Fixtures) -> DataFrame:
    target, checkpoint = new_dir(fx.spark, "ingest"), new_dir(fx.spark, "ingest-checkpoint")
    ingest.run_to_end(
        ingest.start_ingest(_landed_stream(fx, fx.snapshots), target, checkpoint)
    )
    return ingest.current_records(fx.spark, target)


@query
def stream_ingest(fx: Fixtures) -> DataFrame:
    return _snapshot_columns(_streamed_latest(fx))


@query
def stream_upsert(fx: Fixtures) -> DataFrame:
    target, checkpoint = new_dir(fx.spark, "upsert"), new_dir(fx.spark, "upsert-checkpoint")
    stream = _landed_stream(fx, fx.snapshot_components())
    ingest.run_to_end(ingest.start_append(stream, target, checkpoint))
    merged = ingest.current_merge(
        fx.spark, target, F.struct("mtime", "snap"), kept={"change_type": ()}
    )
    return _merged_columns(merged)


def _versions(fx: Fixtures) -> tuple[StateTable, Callable[[DataFrame], DataFrame], Merge]:
    merge = Merge(kept={"change_type": ()})
    table = StateTable(
        fx.spark, new_dir(fx.spark, "versions"), merge.key, partial(fold_merge, merge=merge), buckets=16
    )
    return table, lambda rows: merge_state(rows, F.struct("mtime", "snap"), merge), merge


@query
def stream_versions(fx: Fixtures) -> DataFrame:
    """Snapshots folded batch by batch into a versioned table; its newest version."""
    table, state, merge = _versions(fx)
    parts = fx.snapshot_components()
    checkpoint = new_dir(fx.spark, "versions-checkpoint")
    ingest.run_to_end(table.upsert_stream(_landed_stream(fx, parts), checkpoint, state))
    return _merged_columns(merged_records(table.read(), parts.columns, merge))


@query
def file_ledger(fx: Fixtures) -> DataFrame:
    """Result files ingested as they come, newest first; a further run opens none."""
    table, state, merge = _versions(fx)
    landed, parts = new_dir(fx.spark, "files"), fx.snapshot_components()

    def run() -> int:
        read = fx.spark.read.schema(parts.schema)
        return table.ingest_files(landed, lambda paths: state(read.parquet(*paths)), "*.parquet")

    for number, *_ in reversed(SNAPSHOTS):
        parts.filter(F.col("snap") == number).write.parquet(f"{landed}/{number}")
        run()
    merged = _merged_columns(merged_records(table.read(), parts.columns, merge))
    return merged.withColumn("opened_again", F.lit(run()))


@query
def stream_distinct(fx: Fixtures) -> DataFrame:
    """Comments delivered twice, the second time a slice later; each is kept once.

    Memory of ids is bounded by the time a repeat may be late, here two of six slices.
    """
    landed, target = new_dir(fx.spark, "deliveries"), new_dir(fx.spark, "distinct")
    events = fx.table("events").select(
        F.col("event_id").cast("string").alias("id"), "event_type", F.col("ts").cast("timestamp").alias("ts")
    )
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    width = (high - low).total_seconds() / 6 + 1
    slot = F.floor((F.unix_micros("ts") - F.unix_micros(F.lit(low))) / (width * 1e6))
    placed = events.withColumn("slot", slot)
    for number in range(7):
        both = placed.filter(F.col("slot").isin(number, number - 1)).drop("slot")
        both.write.parquet(f"{landed}/{number}")
    stream = ingest.read_result_stream(fx.spark, landed, events.schema, files_per_trigger=8)
    once = ingest.without_repeats(stream, ["id"], "ts", f"{int(2 * width) + 1} seconds")
    ingest.run_to_end(ingest.start_append(once, target, new_dir(fx.spark, "distinct-checkpoint")))
    return ingest.read_batches(fx.spark, target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("deliveries"), F.count_distinct("id").alias("ids")
    )


@query
def stream_state(fx: Fixtures) -> DataFrame:
    target, checkpoint = new_dir(fx.spark, "state"), new_dir(fx.spark, "state-checkpoint")
    stream = _landed_stream(
        fx, fx.snapshots.select("repository_name", "id", *snapshots.FLAGS, "timestamp")
    )
    ingest.run_to_end(ingest.start_state(stream, target, checkpoint))
    return ingest.current_state(fx.spark, target)


@query
def stream_equals_batch(fx: Fixtures) -> DataFrame:
    """Rows of both results and the number of rows only one of them has."""
    streamed = _snapshot_columns(_streamed_latest(fx)).withColumn("_side", F.lit(1))
    batch = _snapshot_columns(_latest(fx)).withColumn("_side", F.lit(-1))
    columns = [c for c in batch.columns if c != "_side"]
    sides = streamed.unionByName(batch).groupBy(*columns).agg(
        F.sum("_side").alias("_balance"),
        F.count_if(F.col("_side") == 1).alias("_streamed"),
        F.count_if(F.col("_side") == -1).alias("_batch"),
    )
    return sides.agg(
        F.sum("_streamed").alias("streamed"),
        F.sum("_batch").alias("batch"),
        F.count_if(F.col("_balance") != 0).alias("different"),
    )
