"""Schemas of landed pages, nested pull-request records and envelopes, as DDL text."""

REPOSITORY_ITEM = (
    "name STRING, full_name STRING, html_url STRING, languages_url STRING, "
    "stargazers_count BIGINT, forks_count BIGINT, description STRING, size BIGINT, "
    "fork BOOLEAN, archived BOOLEAN, created_at STRING, updated_at STRING, pulls_url STRING"
)
REPOSITORY_PAGE = f"STRUCT<items: ARRAY<STRUCT<{REPOSITORY_ITEM}>>>"

LANGUAGES = "MAP<STRING, BIGINT>"

PULL_REQUEST_ITEM = (
    "number BIGINT, title STRING, body STRING, state STRING, created_at STRING, "
    "updated_at STRING, merged_at STRING, user STRUCT<login: STRING>, draft BOOLEAN, "
    "mergeable_state STRING, comments BIGINT, labels ARRAY<STRUCT<name: STRING>>"
)
PULL_REQUEST_PAGE = f"ARRAY<STRUCT<{PULL_REQUEST_ITEM}>>"

COMMIT_ITEM = (
    "sha STRING, commit STRUCT<message: STRING, author: STRUCT<name: STRING, date: STRING>>"
)
COMMIT_PAGE = f"ARRAY<STRUCT<{COMMIT_ITEM}>>"

COMMENT_ITEM = (
    "id BIGINT, body STRING, user STRUCT<login: STRING>, created_at STRING, position BIGINT"
)
COMMENT_PAGE = f"ARRAY<STRUCT<{COMMENT_ITEM}>>"

# A map per file, so that an absent field and a null one can be told apart.
FILE_PAGE = "ARRAY<MAP<STRING, STRING>>"

FILE_CONTENT = "STRUCT<content: STRING, encoding: STRING>"

COMMIT_VALUE = "STRUCT<commit_message: STRING, author: STRING, date: STRING>"
COMMENT_VALUE = (
    "STRUCT<id: STRING, body: STRING, author: STRING, date: STRING, type: STRING, "
    "position: BIGINT>"
)
FILE_VALUE = (
    "STRUCT<filename: STRING, status: STRING, additions: BIGINT, deletions: BIGINT, "
    "changes: BIGINT, patch: STRING>"
)

# The 24 fields of a pull-request record, in output order (fixed format).
PULL_REQUEST_FIELDS = {
    "id": "STRING",
    "repository_url": "STRING",
    "repository_language": "ARRAY<STRING>",
    "repository_name": "STRING",
    "repository_full_name": "STRING",
    "repository_stars": "BIGINT",
    "repository_forks": "BIGINT",
    "title": "STRING",
    "description": "STRING",
    "change_type": "STRING",
    "change_type_confidence": "DOUBLE",
    "change_type_reasons": "ARRAY<STRING>",
    "commits": f"MAP<STRING, {COMMIT_VALUE}>",
    "pr_comments": f"ARRAY<{COMMENT_VALUE}>",
    "files": f"ARRAY<{FILE_VALUE}>",
    "tags": "ARRAY<STRING>",
    "pr_number": "BIGINT",
    "pr_state": "STRING",
    "created_at": "STRING",
    "updated_at": "STRING",
    "merged_at": "STRING",
    "author": "STRING",
    "draft": "BOOLEAN",
    "components_updated": "STRUCT<commits: BOOLEAN, comments: BOOLEAN, files: BOOLEAN>",
}
PULL_REQUEST = ", ".join(f"{name} {kind}" for name, kind in PULL_REQUEST_FIELDS.items())
_PULL_REQUEST_STRUCT = ", ".join(f"{name}: {kind}" for name, kind in PULL_REQUEST_FIELDS.items())

METADATA = (
    "STRUCT<extraction_timestamp: STRING, total_prs: BIGINT, is_incremental_save: BOOLEAN, "
    "is_final_save: BOOLEAN, batch_name: STRING>"
)
ENVELOPE = (
    f"metadata {METADATA}, data ARRAY<STRUCT<{_PULL_REQUEST_STRUCT}>>, _corrupt_record STRING"
)

# Columns of the CSV form, in order (fixed format).
CSV_COLUMNS = (
    "id", "repository_url", "repository_language", "repository_name", "repository_stars",
    "repository_forks", "title", "description", "change_type", "change_type_confidence",
    "commits_count", "comments_count", "files_count", "additions", "deletions", "changes",
    "tags", "pr_number", "pr_state", "created_at", "updated_at", "merged_at", "author", "draft",
)
