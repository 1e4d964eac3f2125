"""The registered queries as SQL over the test tables (DuckDB dialect), for comparison only.

Each text is built from named subqueries; the ones a query uses are put in front of it.
"""

from __future__ import annotations

import re

from mergelens.functions import rules as R
from mergelens.functions import text as X
from mergelens.operators import similarity as S
from mergelens.operators import stats as ST
from mergelens.plans import fixtures as FX
from mergelens.plans import queries as Q


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_quoted(v) for v in values) + ")"


def _array(values) -> str:
    return "[" + ", ".join(_quoted(v) for v in values) + "]"


def _choose(index: str, values) -> str:
    cases = " ".join(f"WHEN {i} THEN {_quoted(v)}" for i, v in enumerate(values))
    return f"CASE ({index}) % {len(values)} {cases} END"


_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"
_DAY = "'%Y-%m-%dT%H:%M:%SZ'"
_MICROS = "'%Y-%m-%dT%H:%M:%S.%fZ'"

PARTS: dict[str, str] = {}

PARTS["fx_repo"] = f"""
SELECT n_nationkey AS repo_key, n_name AS name, lower(r_name) || '/' || n_name AS full_name,
  'https://example.org/' || lower(r_name) || '/' || n_name AS url,
  CAST(n_nationkey * 997 % 23000 AS BIGINT) AS stars,
  CAST(n_nationkey * 131 % 7000 AS BIGINT) AS forks,
  CASE WHEN n_nationkey % 6 <> 0 THEN 'Code of ' || n_name END AS description,
  CAST(n_nationkey * 40009 % 1200000 AS BIGINT) AS size_kb,
  n_nationkey % 11 = 0 AS is_fork, n_nationkey % 13 = 0 AS is_archived,
  strftime(TIMESTAMP '2015-01-01' + to_days(CAST(n_nationkey * 37 AS INTEGER)), {_DAY})
    AS created_at,
  strftime(TIMESTAMP '2015-01-01' + to_days(CAST(n_nationkey * 37 + 100 AS INTEGER)), {_DAY})
    AS updated_at
FROM nation JOIN region ON n_regionkey = r_regionkey"""

PARTS["fx_repo_language"] = """
SELECT * FROM (
  SELECT repo_key, 0 AS pos, CASE repo_key % 4 WHEN 0 THEN 'TypeScript' WHEN 1 THEN 'Python'
    WHEN 2 THEN 'C++' ELSE 'Go' END AS language FROM fx_repo
  UNION ALL
  SELECT repo_key, 1, CASE WHEN repo_key % 5 = 0 THEN NULL WHEN repo_key % 3 = 0 THEN 'Shell'
    ELSE 'HTML' END FROM fx_repo)
WHERE language IS NOT NULL"""

PARTS["fx_languages"] = """
SELECT repo_key, string_agg(language, '|' ORDER BY pos) AS languages,
  string_agg(language, '|' ORDER BY language) AS sorted_languages
FROM fx_repo_language GROUP BY repo_key"""

PARTS["fx_head"] = f"""
SELECT r.full_name || '_' || CAST(o_orderkey AS VARCHAR) AS id, r.repo_key,
  r.name AS repository_name, r.full_name AS repository_full_name, o_orderkey AS pr_number,
  {_choose("o_orderkey", FX.TITLES)} || lower(c_mktsegment) AS title,
  CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END AS pr_state,
  strftime(o_orderdate, {_DAY}) AS created_at,
  strftime(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL '3' DAY
    ELSE o_orderdate END, {_DAY}) AS updated_at,
  CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, {_DAY}) END AS merged_at,
  c_name AS author, o_orderkey % 10 = 0 AS draft,
  CASE WHEN o_orderkey % 17 = 0 THEN 'dirty' ELSE 'clean' END AS mergeable_state
FROM orders JOIN customer ON o_custkey = c_custkey JOIN fx_repo r ON c_nationkey = r.repo_key"""

PARTS["fx_pr"] = """
SELECT h.*, CASE WHEN pr_number % 7 = 0 THEN NULL WHEN pr_number % 7 = 1 THEN '' ELSE d.text END
  AS body
FROM fx_head h LEFT JOIN documents d ON d.doc_id = pr_number % (SELECT count(*) FROM documents)"""

PARTS["fx_label"] = f"""
SELECT * FROM (
  SELECT o_orderkey AS pr_number, 0 AS pos, CASE o_orderpriority
    {" ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in FX.PRIORITY_LABELS.items())}
    END AS name FROM orders
  UNION ALL SELECT o_orderkey, 1, CASE WHEN o_orderkey % 4 = 0 THEN 'area-api' END FROM orders
  UNION ALL SELECT o_orderkey, 2, CASE WHEN o_orderkey % 8 = 0 THEN 'area-api' END FROM orders)
WHERE name IS NOT NULL"""

PARTS["fx_commit"] = f"""
SELECT l_orderkey AS pr_number,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS pos,
  md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)) AS sha,
  {_choose("l_partkey", FX.MESSAGES)} AS message, s_name AS author,
  strftime(l_shipdate, {_DAY}) AS date
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""

PARTS["fx_capped_commit"] = "SELECT * FROM fx_commit WHERE pos <= 100"

PARTS["fx_last_commit"] = """
SELECT * FROM fx_commit WHERE pos <= 100
QUALIFY row_number() OVER (PARTITION BY pr_number, sha ORDER BY pos DESC) = 1"""

PARTS["fx_file"] = f"""
SELECT l_orderkey AS pr_number,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS pos,
  lower(p_type) || '/' || p_name || CAST(l_linenumber AS VARCHAR) AS filename,
  CASE l_returnflag WHEN 'A' THEN 'added' WHEN 'R' THEN 'removed' ELSE 'modified' END AS status,
  CAST(l_quantity AS BIGINT) AS additions, CAST(round(l_tax * 100) AS BIGINT) AS deletions,
  CAST(l_quantity AS BIGINT) + CAST(round(l_tax * 100) AS BIGINT) AS changes, d.text AS patch
FROM lineitem JOIN part ON l_partkey = p_partkey
LEFT JOIN documents d
  ON d.doc_id = l_partkey % (SELECT count(*) FROM documents) AND l_linenumber <> 7"""

PARTS["fx_file_kept"] = """
SELECT *, row_number() OVER (PARTITION BY pr_number ORDER BY pos) AS rank FROM (
  SELECT * FROM fx_file
  QUALIFY row_number() OVER (PARTITION BY pr_number, filename ORDER BY pos) = 1)
QUALIFY rank <= 100"""

PARTS["fx_comment"] = f"""
SELECT event_id % CAST(floor((SELECT count(*) FROM orders) / 20) AS BIGINT) AS pr_number,
  event_id, ts, CAST(event_id AS VARCHAR) AS id,
  CASE WHEN event_type IN ('view', 'purchase') THEN 'review' ELSE 'issue' END AS type,
  props AS body, CASE WHEN event_type = 'view' AND event_id % 9 = 0 THEN NULL
    ELSE 'user_' || CAST(user_id AS VARCHAR) END AS author,
  strftime(ts, {_MICROS}) AS date,
  CASE WHEN event_type IN ('view', 'purchase') THEN event_id % 50 END AS position
FROM events"""

PARTS["fx_comment_ranked"] = """
SELECT *, row_number() OVER (PARTITION BY pr_number
  ORDER BY CASE type WHEN 'issue' THEN 0 ELSE 1 END, ts, event_id) AS rank FROM fx_comment"""

PARTS["fx_snapshot"] = f"""
SELECT s.snap, s.mtime, CAST(s.mtime AS VARCHAR) AS timestamp, p.id, p.repository_name,
  p.repository_full_name, p.pr_number, p.author, s.snap <> 2 AS has_commits,
  s.snap >= 2 AND p.pr_number % 5 <> 0 AS has_comments, s.snap = 3 AS has_files
FROM fx_head p JOIN (VALUES
  {", ".join(f"({n}, {t}, {_quoted(a)}, {_quoted(b)})" for n, t, a, b in FX.SNAPSHOTS)}
) s(snap, mtime, lo, hi) ON p.created_at >= s.lo AND p.created_at < s.hi"""

PARTS["fx_latest"] = """
SELECT * FROM fx_snapshot
QUALIFY row_number() OVER (PARTITION BY repository_name, id ORDER BY mtime DESC) = 1"""

PARTS["fx_prior"] = f"""
SELECT * FROM fx_snapshot WHERE snap < {FX.LAST_SNAPSHOT}
QUALIFY row_number() OVER (PARTITION BY repository_name, id ORDER BY mtime DESC) = 1"""

PARTS["fx_merged"] = """
SELECT repository_name, id, max(snap) AS snap,
  max(CASE WHEN has_commits THEN snap END) AS commits_from,
  max(CASE WHEN has_comments THEN snap END) AS pr_comments_from,
  max(CASE WHEN has_files THEN snap END) AS files_from,
  arg_min('type_' || snap, CASE WHEN snap <> 2 THEN snap END) AS change_type
FROM fx_snapshot GROUP BY repository_name, id"""

PARTS["fx_state"] = """
SELECT repository_name, id, bool_or(has_commits) AS has_commits,
  bool_or(has_comments) AS has_comments, bool_or(has_files) AS has_files,
  max(timestamp) AS timestamp
FROM fx_snapshot GROUP BY repository_name, id"""

PARTS["fx_needs"] = """
SELECT p.id, s.id IS NULL AS is_new, NOT coalesce(s.has_commits, false) AS need_commits,
  NOT coalesce(s.has_comments, false) AS need_comments,
  NOT coalesce(s.has_files, false) AS need_files
FROM fx_head p LEFT JOIN fx_prior s ON p.repository_name = s.repository_name AND p.id = s.id"""

# Classification as a join of texts with the rule table.

PARTS["rules"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({_quoted(r.change_type)}, {_quoted(r.source)}, {_quoted(r.pattern)})"
    for r in R.DEFAULT_RULES.flat()
) + ") r(change_type, source, pattern)"

PARTS["rule_matches"] = f"""
SELECT pr_number, change_type, source, pattern, {R.LABEL_POINTS} AS points,
  'Label ''' || lower(name) || ''' matches ' || change_type AS reason
FROM fx_label JOIN rules ON source = 'label' AND contains(lower(name), pattern)
UNION ALL
SELECT pr_number, change_type, source, pattern,
  CASE WHEN contains(lower(title), pattern) THEN {R.TITLE_KEYWORD_POINTS}
    ELSE {R.BODY_KEYWORD_POINTS} END,
  'Keyword ''' || pattern || ''' found in '
    || CASE WHEN contains(lower(title), pattern) THEN 'title' ELSE 'body' END
FROM (SELECT pr_number, title, lower(title) || ' ' || lower(coalesce(body, '')) AS combined
  FROM fx_pr) JOIN rules ON source = 'keyword' AND contains(combined, pattern)
UNION ALL
SELECT pr_number, change_type, source, pattern, {R.COMMIT_POINTS},
  'Commit pattern ''' || pattern || ''' matches ' || change_type
FROM fx_capped_commit JOIN rules
  ON source = 'commit' AND regexp_matches(lower(message), pattern)"""


def _any(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {_quoted(w)})" for w in words) + ")"


def _words(text: str) -> str:
    return f"len(list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: w <> ''))"


PARTS["metadata_matches"] = f"""
SELECT pr_number, 'fix' AS change_type, {R.SHORT_TITLE_POINTS} AS points,
  {_quoted(R.REASON_SHORT_TITLE)} AS reason
FROM fx_pr WHERE {_words("title")} <= {R.SHORT_TITLE_WORDS}
  AND {_any("lower(title)", R.SHORT_TITLE_FIX_WORDS)}
UNION ALL
SELECT pr_number, 'feature', {R.LONG_BODY_POINTS}, {_quoted(R.REASON_LONG_BODY)}
FROM fx_pr WHERE body IS NOT NULL AND {_words("body")} > {R.LONG_BODY_WORDS}
UNION ALL
SELECT pr_number, 'doc', {R.DOC_WORD_POINTS}, {_quoted(R.REASON_DOC_WORDS)}
FROM fx_pr WHERE {_any("lower(title) || ' ' || lower(coalesce(body, ''))", R.DOC_WORDS)}"""


def _profile_of(source: str) -> str:
    def counted(words) -> str:
        return f"count(*) FILTER (WHERE {_any('lower(message)', words)})"

    return f"""
SELECT pr_number, {counted(R.URGENT_WORDS)} AS urgent_commits,
  {counted(R.REFACTOR_WORDS)} AS refactor_commits, {counted(R.TEST_WORDS)} AS test_commits,
  count(*) AS total_commits, sum(length(message)) / count(*) AS avg_commit_length
FROM {source} GROUP BY pr_number"""


PARTS["profile"] = _profile_of("fx_capped_commit")

PARTS["profile_matches"] = f"""
SELECT pr_number, 'fix' AS change_type, {R.URGENT_POINTS} AS points,
  {_quoted(R.REASON_URGENT)} AS reason FROM profile WHERE urgent_commits > 0
UNION ALL
SELECT pr_number, 'feature', {R.TEST_POINTS}, {_quoted(R.REASON_TEST)} FROM profile
WHERE test_commits * 2 > total_commits
UNION ALL
SELECT pr_number, 'feature', {R.REFACTOR_POINTS}, {_quoted(R.REASON_REFACTOR)} FROM profile
WHERE refactor_commits > 0"""


def _points_of(*sources: str) -> str:
    def points(name: str) -> str:
        return (
            f"CAST(coalesce(sum(points) FILTER (WHERE change_type = '{name}'), 0) AS BIGINT)"
            f" AS points_{name}"
        )

    union = " UNION ALL ".join(f"SELECT pr_number, change_type, points FROM {s}" for s in sources)
    return f"""
SELECT p.id, p.pr_number, coalesce(s.points_fix, 0) AS points_fix,
  coalesce(s.points_feature, 0) AS points_feature, coalesce(s.points_doc, 0) AS points_doc,
  coalesce(s.n, 0) AS n
FROM fx_head p LEFT JOIN (
  SELECT pr_number, {points("fix")}, {points("feature")}, {points("doc")}, count(*) AS n
  FROM ({union}) GROUP BY pr_number) s ON p.pr_number = s.pr_number"""


PARTS["points"] = _points_of("rule_matches", "metadata_matches")
PARTS["points_profile"] = _points_of("rule_matches", "metadata_matches", "profile_matches")

PARTS["scored"] = """
SELECT *, greatest(points_fix, points_feature, points_doc) AS top,
  CASE WHEN greatest(points_fix, points_feature, points_doc) < 60 THEN 'feature'
    WHEN points_fix = greatest(points_fix, points_feature, points_doc) THEN 'fix'
    WHEN points_feature = greatest(points_fix, points_feature, points_doc) THEN 'feature'
    ELSE 'doc' END AS change_type
FROM points"""

# Terms, vocabulary and cosine.


def _terms_of(source: str, key: str) -> str:
    """(key, term) rows with one row per occurrence, unigrams and bigrams."""
    return f"""
SELECT {key}, unnest(list_concat(w, CASE WHEN len(w) >= 2 THEN
  list_transform(list_zip(w[1:len(w) - 1], w[2:len(w)]), lambda p: p[1] || ' ' || p[2])
  ELSE [] END)) AS term
FROM (SELECT {key}, list_filter(
    regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'),
    lambda t: length(t) >= 2 AND NOT list_contains({_array(Q.STOP_WORDS)}, t)) AS w
  FROM {source})"""


PARTS["training"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {_quoted(t)})" for i, t in enumerate(S.TRAINING_SENTENCES)
) + ") t(doc, text)"
PARTS["training_terms"] = _terms_of("training", "doc")
PARTS["vocabulary"] = f"""
SELECT term, ln((1 + {len(S.TRAINING_SENTENCES)}) / (1 + count(DISTINCT doc))) + 1 AS idf
FROM training_terms GROUP BY term"""
PARTS["prototypes"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({_quoted(n)}, {_quoted(t)})" for n, t in S.PROTOTYPES.items()
) + ") t(name, text)"
PARTS["prototype_terms"] = _terms_of("prototypes", "name")
PARTS["prototype_weights"] = """
SELECT name, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY name)) AS weight FROM (
  SELECT name, term, count(*) * any_value(idf) AS raw
  FROM prototype_terms JOIN vocabulary USING (term) GROUP BY name, term)"""


def _cosine_of(terms: str, key: str) -> str:
    def cosine(name: str) -> str:
        return (
            f"sum(raw * (SELECT weight FROM prototype_weights w WHERE w.name = '{name}' "
            f"AND w.term = v.term)) / sqrt(sum(raw * raw)) AS similarity_{name}"
        )

    return f"""
SELECT {key}, {", ".join(cosine(n) for n in S.PROTOTYPES)} FROM (
  SELECT {key}, term, count(*) * any_value(idf) AS raw
  FROM {terms} JOIN vocabulary USING (term) GROUP BY {key}, term) v
GROUP BY {key}"""


PARTS["pr_text"] = """
SELECT p.pr_number, title || ' ' || coalesce(body, '') || ' ' || coalesce(m.messages, '') AS text
FROM fx_pr p LEFT JOIN (
  SELECT pr_number, string_agg(message, ' ' ORDER BY pos) AS messages FROM fx_capped_commit
  GROUP BY pr_number) m ON p.pr_number = m.pr_number"""
PARTS["pr_terms"] = _terms_of("pr_text", "pr_number")
PARTS["pr_cosine"] = _cosine_of("pr_terms", "pr_number")
PARTS["document_terms"] = _terms_of("documents", "doc_id")
PARTS["document_cosine"] = _cosine_of("document_terms", "doc_id")

PARTS["scored_full"] = f"""
SELECT *, greatest(s_fix, s_feature, s_doc) AS top FROM (
  SELECT p.*, points_fix / 100 + coalesce(similarity_fix, 0) * {R.SIMILARITY_WEIGHT} AS s_fix,
    points_feature / 100 + coalesce(similarity_feature, 0) * {R.SIMILARITY_WEIGHT} AS s_feature,
    points_doc / 100 + coalesce(similarity_doc, 0) * {R.SIMILARITY_WEIGHT} AS s_doc
  FROM points_profile p LEFT JOIN pr_cosine c ON p.pr_number = c.pr_number)"""

# Measures per pull request, and everything the nested record shows.

PARTS["commit_counts"] = (
    "SELECT pr_number, count(*) AS n FROM fx_last_commit GROUP BY pr_number"
)
PARTS["comment_counts"] = (
    "SELECT pr_number, count(*) AS n FROM fx_comment_ranked WHERE rank <= 100 GROUP BY pr_number"
)
PARTS["file_counts"] = """
SELECT pr_number, count(*) AS n, CAST(sum(additions) AS BIGINT) AS additions,
  CAST(sum(deletions) AS BIGINT) AS deletions, CAST(sum(changes) AS BIGINT) AS changes
FROM fx_file_kept GROUP BY pr_number"""
PARTS["measured"] = """
SELECT p.*, r.url AS repository_url, r.stars AS repository_stars, r.forks AS repository_forks,
  l.languages AS repository_language,
  coalesce(c.n, 0) AS commits_count, coalesce(m.n, 0) AS comments_count,
  coalesce(f.n, 0) AS files_count, coalesce(f.additions, 0) AS additions,
  coalesce(f.deletions, 0) AS deletions, coalesce(f.changes, 0) AS changes
FROM fx_head p JOIN fx_repo r ON p.repo_key = r.repo_key
LEFT JOIN fx_languages l ON p.repo_key = l.repo_key
LEFT JOIN commit_counts c ON p.pr_number = c.pr_number
LEFT JOIN comment_counts m ON p.pr_number = m.pr_number
LEFT JOIN file_counts f ON p.pr_number = f.pr_number"""
PARTS["tag_names"] = f"""
SELECT id, string_agg(DISTINCT name, '|' ORDER BY name) AS tags FROM (
  SELECT id, name FROM fx_head JOIN fx_label USING (pr_number)
  UNION ALL SELECT id, CASE WHEN draft THEN {_quoted(X.TAG_DRAFT)} END FROM fx_head
  UNION ALL SELECT id, CASE WHEN mergeable_state = 'dirty' THEN {_quoted(X.TAG_CONFLICT)} END
    FROM fx_head)
WHERE name IS NOT NULL GROUP BY id"""
PARTS["nested"] = """
SELECT m.*, s.change_type, s.top / 100 AS change_type_confidence,
  s.n + CASE WHEN s.top < 60 THEN 1 ELSE 0 END AS reasons, coalesce(t.tags, '') AS tags,
  coalesce(b.body, '') AS description
FROM measured m JOIN scored s ON m.id = s.id JOIN fx_pr b ON m.id = b.id
LEFT JOIN tag_names t ON m.id = t.id"""

PARTS["save_counts"] = f"""
SELECT repository_name, count(*) AS total_prs,
  {", ".join(f"CAST(sum({m}) AS DOUBLE) AS s_{n}" for m, n in zip(ST.MEASURES, ST.MEASURE_NAMES))}
FROM nested GROUP BY repository_name"""
PARTS["save_values"] = f"""
SELECT repository_name, 'repository_distribution' AS metric, repository_name AS key,
  CAST(total_prs AS DOUBLE) AS value FROM save_counts
UNION ALL SELECT repository_name, 'change_type_distribution', change_type, count(*) FROM nested
  GROUP BY repository_name, change_type
UNION ALL SELECT repository_name, 'language_distribution', language, count(*)
  FROM nested JOIN fx_repo_language USING (repo_key) GROUP BY repository_name, language
UNION ALL SELECT repository_name, 'top_authors', author, n FROM (
  SELECT repository_name, author, count(*) AS n FROM nested GROUP BY repository_name, author
  QUALIFY row_number() OVER (PARTITION BY repository_name ORDER BY count(*) DESC, author) <= 10)
{" ".join(
    f"UNION ALL SELECT repository_name, 'aggregate_stats', 'total_{n}', s_{n} FROM save_counts "
    f"UNION ALL SELECT repository_name, 'aggregate_stats', 'avg_{n}_per_pr', s_{n} / total_prs "
    "FROM save_counts" for n in ST.MEASURE_NAMES)}"""


def with_parts(body: str) -> str:
    """The query text with every subquery it needs in front, in definition order."""
    needed: set[str] = set()
    queue = [body]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in PARTS.keys() & words - needed:
            needed.add(name)
            queue.append(PARTS[name])
    ordered = [f"{name} AS ({text})" for name, text in PARTS.items() if name in needed]
    return (f"WITH {', '.join(ordered)} " if ordered else "") + body.strip()


_cut_patch = (
    f"CASE WHEN length(patch) > {X.PATCH_LIMIT} THEN substring(patch, 1, {X.PATCH_LIMIT}) || "
    f"{_quoted(X.PATCH_SUFFIX)} ELSE patch END"
)


def _distribution(source: str, column: str) -> str:
    return f"SELECT {column}, count(*) AS count FROM {source} GROUP BY {column}"


def _top(source: str, column: str, n: int) -> str:
    return f"{_distribution(source, column)} ORDER BY count(*) DESC, {column} LIMIT {n}"


_MEASURES = ("commits_count", "comments_count", "files_count", "additions", "deletions", "changes")
_NAMES = ("commits", "comments", "files", "additions", "deletions", "changes")
_COVERAGE = """count(*) AS total_prs, count(DISTINCT id) AS unique_prs,
  count(*) FILTER (WHERE has_files) AS prs_with_files,
  count(*) FILTER (WHERE has_comments) AS prs_with_comments,
  count(*) FILTER (WHERE has_commits) AS prs_with_commits,
  count(*) FILTER (WHERE has_files AND has_comments AND has_commits)
    AS prs_with_all_components"""
_ROUNDED = ", ".join(
    f"round(coalesce(similarity_{n}, 0), 6) AS similarity_{n}" for n in S.PROTOTYPES
)
_STORED = "SELECT repository_name, count(*) AS prs, count(DISTINCT id) AS ids, " + ", ".join(
    f"CAST(sum({m}) AS BIGINT) AS {m}" for m in _MEASURES
) + " FROM measured GROUP BY repository_name"
_LATEST = """SELECT repository_name, id, snap, has_commits, has_comments, has_files
FROM fx_latest"""
_STATE = "SELECT * FROM fx_state"
_MERGED = "SELECT * FROM fx_merged"

_CONTENTS = f"""
SELECT id, repository_url, repository_name, repository_full_name, repository_stars,
  repository_forks, title, change_type, change_type_confidence, pr_number, pr_state, created_at,
  updated_at, merged_at, author, draft, {", ".join(_MEASURES)}, md5(description) AS description_md5,
  repository_language, tags, reasons, true AS files_updated"""


def _digest(*columns: str) -> str:
    joined = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"md5({joined}) AS content"


_BODIES: dict[str, str] = {
    "repo_select": f"""
SELECT full_name AS repository_full_name, stars AS repository_stars FROM fx_repo
WHERE NOT is_fork AND NOT is_archived AND stars >= {Q.MIN_STARS}
  AND size_kb BETWEEN {Q.SIZE_RANGE[0]} AND {Q.SIZE_RANGE[1]}
ORDER BY stars DESC, full_name LIMIT 10""",
    "repo_include": f"""
SELECT full_name AS repository_full_name FROM fx_repo
WHERE full_name IN {_list(Q.INCLUDE_NAMES)} OR name IN {_list(Q.INCLUDE_NAMES)}""",
    "repo_language_filter": f"""
SELECT full_name AS repository_full_name, languages
FROM fx_repo r JOIN fx_languages l ON r.repo_key = l.repo_key
WHERE EXISTS (SELECT 1 FROM fx_repo_language x WHERE x.repo_key = r.repo_key
    AND language IN {_list(Q.INCLUDE_LANGUAGES)})
  AND NOT EXISTS (SELECT 1 FROM fx_repo_language x WHERE x.repo_key = r.repo_key
    AND language IN {_list(Q.EXCLUDE_LANGUAGES)})""",
    "repo_languages": """
SELECT full_name AS repository_full_name, sorted_languages AS languages
FROM fx_repo r JOIN fx_languages l ON r.repo_key = l.repo_key""",
    "norm_repo": """
SELECT name, full_name, url, stars, forks, coalesce(description, '') AS description, size_kb,
  is_fork, is_archived, created_at, updated_at,
  'https://example.org/repos/' || full_name || '/pulls' AS pulls_url FROM fx_repo""",
    "norm_commit": "SELECT pr_number, sha, message, author, date FROM fx_commit",
    "norm_comment": """
SELECT pr_number, id, body, coalesce(author, '') AS author, date, type, position
FROM fx_comment""",
    "norm_file": """
SELECT pr_number, filename, status, additions, deletions, changes,
  length(coalesce(patch, '')) AS patch_length, md5(coalesce(patch, '')) AS patch_md5
FROM fx_file""",
    "norm_pull_request": """
SELECT p.id, p.pr_number, p.title, p.pr_state, p.created_at, p.updated_at, p.merged_at, p.author,
  p.draft, p.pr_number * 31 % 97 AS popularity, length(p.body) AS body_length, coalesce(l.labels, '') AS labels
FROM fx_pr p LEFT JOIN (SELECT pr_number, string_agg(name, '|' ORDER BY pos) AS labels
  FROM fx_label GROUP BY pr_number) l ON p.pr_number = l.pr_number""",
    "reject_split": """
SELECT CASE WHEN pr_number % 19 = 0 THEN 'rejected' ELSE 'valid' END AS status,
  CASE WHEN pr_number % 19 = 0 THEN 'missing author' ELSE '' END AS reason, count(*) AS count
FROM fx_head GROUP BY 1, 2""",
    "pr_key": "SELECT pr_number, id FROM fx_head",
    "surrogate_key": """
SELECT pr_number, md5('pr_data|' || repository_full_name || '|' || pr_number) AS key,
  md5('repo_languages|' || repository_full_name) AS languages_key FROM fx_head""",
    "pr_select": f"""
SELECT repository_full_name, id,
  row_number() OVER (PARTITION BY repository_full_name ORDER BY updated_at DESC, id) AS rank
FROM fx_head WHERE pr_state = 'closed' QUALIFY rank <= {Q.PER_REPOSITORY}""",
    "commits_capped": f"""
SELECT pr_number, pos AS rank, sha FROM fx_commit WHERE pos <= {Q.CHILD_CAP}""",
    "files_capped": f"""
SELECT pr_number, rank, filename FROM fx_file_kept WHERE rank <= {Q.CHILD_CAP}""",
    "comments_capped": f"""
SELECT pr_number, rank, type, id FROM fx_comment_ranked WHERE rank <= {Q.COMMENT_CAP}""",
    "commit_map": """
SELECT pr_number, sha, message AS commit_message, author, date FROM fx_last_commit""",
    "comment_array": """
SELECT pr_number, CAST(rank - 1 AS INTEGER) AS pos, id, body, author, date, type, position
FROM fx_comment_ranked WHERE rank <= 100""",
    "file_array": f"""
SELECT pr_number, CAST(rank - 1 AS INTEGER) AS pos, filename, status, additions, deletions,
  changes, length({_cut_patch}) AS patch_length, md5({_cut_patch}) AS patch_md5
FROM fx_file_kept""",
    "patch_truncate": f"""
SELECT pr_number, filename, length({_cut_patch}) AS patch_length, md5({_cut_patch}) AS patch_md5
FROM fx_file""",
    "tags": """
SELECT h.id, coalesce(tags, '') AS tags FROM fx_head h LEFT JOIN tag_names t ON h.id = t.id""",
    "assemble_pr": """
SELECT id, repository_url, repository_name, repository_stars, repository_forks, title,
  change_type, change_type_confidence, pr_number, pr_state, created_at, updated_at, merged_at,
  author, draft, length(description) AS description_length, repository_language, tags, reasons,
  commits_count AS commits, comments_count AS comments, files_count AS files,
  true AS files_updated FROM nested""",
    "flatten_csv": f"""
SELECT id, repository_url, repository_language, repository_name, repository_stars,
  repository_forks, title, CASE WHEN length(description) > {X.DESCRIPTION_LIMIT}
    THEN substring(description, 1, {X.DESCRIPTION_LIMIT}) || '...' ELSE description END
    AS description,
  change_type, change_type_confidence, commits_count, comments_count, files_count, additions,
  deletions, changes, tags, pr_number, pr_state, created_at, updated_at, merged_at, author, draft
FROM nested""",
    "min_changed_files": f"""
SELECT id, files_count FROM measured WHERE files_count >= {Q.MIN_FILES}""",
    "rule_hits": """
SELECT change_type, source, pattern, count(*) AS hits, CAST(sum(points) AS BIGINT) AS points
FROM rule_matches GROUP BY change_type, source, pattern""",
    "rule_index": """
SELECT doc_id, count(*) AS rules, CAST(sum(length(word)) AS BIGINT) AS letters, min(word) AS first
FROM documents JOIN (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS word FROM benchmark)
ON contains(lower(text), word) GROUP BY doc_id""",
    "change_type": """
SELECT id, points_fix, points_feature, points_doc, change_type, top / 100 AS confidence,
  n + CASE WHEN top < 60 THEN 1 ELSE 0 END AS reason_count FROM scored""",
    "change_reasons": f"""
SELECT h.id, m.reason, count(*) AS times FROM (
  SELECT pr_number, reason FROM rule_matches
  UNION ALL SELECT pr_number, reason FROM metadata_matches
  UNION ALL SELECT pr_number, reason FROM profile_matches
  UNION ALL SELECT pr_number, {_quoted(R.REASON_DEFAULT)} FROM points_profile
    WHERE greatest(points_fix, points_feature, points_doc) < 60) m
JOIN fx_head h ON h.pr_number = m.pr_number GROUP BY h.id, m.reason""",
    "change_type_basic": f"""
SELECT id, CASE
  WHEN {_any("lower(title)", R.BASIC_FIX_WORDS)}
    OR {_any("lower(coalesce(body, ''))", R.BASIC_FIX_WORDS)} THEN 'fix'
  WHEN {_any("lower(title)", R.BASIC_DOC_WORDS)}
    OR {_any("lower(coalesce(body, ''))", R.BASIC_DOC_WORDS)} THEN 'doc'
  ELSE 'feature' END AS change_type, CAST({R.BASIC_CONFIDENCE} AS DOUBLE)
  AS change_type_confidence FROM fx_pr""",
    "commit_profile": _profile_of("fx_capped_commit"),
    "similarity": f"""
SELECT p.pr_number, {_ROUNDED} FROM fx_head p LEFT JOIN pr_cosine c ON p.pr_number = c.pr_number
""",
    "change_type_full": f"""
SELECT id, points_fix, points_feature, points_doc,
  CASE WHEN top < {R.CONFIDENCE_THRESHOLD} THEN 'feature' WHEN s_fix = top THEN 'fix'
    WHEN s_feature = top THEN 'feature' ELSE 'doc' END AS change_type,
  round(top, 6) AS confidence,
  n + 3 + CASE WHEN top < {R.CONFIDENCE_THRESHOLD} THEN 1 ELSE 0 END AS reason_count
FROM scored_full""",
    "tokens": f"""
SELECT token, count(*) AS count FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS token FROM documents)
WHERE token NOT IN {_list(Q.STOP_WORDS)} GROUP BY token""",
    "tfidf": f"""
SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight
FROM (SELECT t.doc_id, t.term, count(*) * any_value(v.idf) AS raw
  FROM document_terms t JOIN (
    SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(DISTINCT doc_id))) + 1
      AS idf FROM document_terms GROUP BY term ORDER BY count(*) DESC, term
    LIMIT {Q.MAX_TERMS}) v ON t.term = v.term
  GROUP BY t.doc_id, t.term)""",
    "document_similarity": f"""
SELECT d.doc_id, {_ROUNDED} FROM documents d LEFT JOIN document_cosine c ON d.doc_id = c.doc_id
""",
    "repo_distribution": _distribution("fx_head", "repository_name"),
    "language_distribution": """
SELECT language, count(*) AS count FROM fx_head JOIN fx_repo_language USING (repo_key)
GROUP BY language""",
    "change_type_distribution": _distribution("scored", "change_type"),
    "change_type_confidence": """
SELECT change_type, count(*) AS count, sum(top) / 100 / count(*) AS avg_confidence FROM scored
GROUP BY change_type""",
    "top_authors": _top("fx_head", "author", 10),
    "top_authors_sketched": _top("fx_head", "author", 10),
    "top_authors5": _top("fx_snapshot", "author", 5),
    "top_repos": _top("fx_snapshot", "repository_full_name", 5),
    "repo_summary": _distribution("fx_head", "repository_name"),
    "totals": "SELECT " + ", ".join(
        f"CAST(sum({m}) AS BIGINT) AS total_{n}" for m, n in zip(_MEASURES, _NAMES, strict=True)
    ) + " FROM measured",
    "averages": "SELECT " + ", ".join(
        f"sum({m}) / count(*) AS avg_{n}_per_pr" for m, n in zip(_MEASURES, _NAMES, strict=True)
    ) + " FROM measured",
    "statistics": f"""
SELECT 'repository_distribution' AS metric, repository_name AS key, CAST(count(*) AS DOUBLE)
  AS value FROM fx_head GROUP BY repository_name
UNION ALL SELECT 'language_distribution', language, count(*)
  FROM fx_head JOIN fx_repo_language USING (repo_key) GROUP BY language
UNION ALL SELECT 'change_type_distribution', change_type, count(*) FROM scored
  GROUP BY change_type
UNION ALL SELECT 'top_authors', author, count FROM ({_top("fx_head", "author", 10)})
""" + "".join(
        f"UNION ALL SELECT 'aggregate_stats', 'total_{n}', sum({m}) FROM measured\n"
        f"UNION ALL SELECT 'aggregate_stats', 'avg_{n}_per_pr', sum({m}) / count(*) FROM measured\n"
        for m, n in zip(_MEASURES, _NAMES, strict=True)
    ),
    "coverage": f"SELECT {_COVERAGE} FROM fx_snapshot",
    "coverage_pct": "SELECT *, " + ", ".join(
        f"round(100.0 * prs_with_{n} / total_prs, 2) AS prs_with_{n}_pct"
        for n in ("files", "comments", "commits", "all_components")
    ) + f" FROM (SELECT {_COVERAGE} FROM fx_snapshot)",
    "distinct_per_repo": """
SELECT repository_name, count(DISTINCT id) AS unique_prs FROM fx_snapshot
GROUP BY repository_name""",
    "distinct_sketches": """
SELECT repository_name, count(*) AS rows, count(DISTINCT id) AS unique_prs, true AS near
FROM fx_snapshot GROUP BY repository_name""",
    "distinct_totals": """
SELECT count(*) AS total_repositories, CAST(sum(n) AS BIGINT) AS total_prs FROM (
  SELECT repository_name, count(DISTINCT id) AS n FROM fx_snapshot GROUP BY repository_name)""",
    "latest_snapshot": _LATEST,
    "component_status": """
SELECT repository_name, id, true AS has_commits, snap <> 1 AS has_comments, snap <> 2 AS has_files,
  timestamp FROM fx_latest""",
    "state_summary": """
SELECT count(*) AS prs, count(DISTINCT repository_name) AS repositories,
  count(*) FILTER (WHERE has_commits) AS with_commits,
  count(*) FILTER (WHERE has_comments) AS with_comments,
  count(*) FILTER (WHERE has_files) AS with_files FROM fx_latest""",
    "state_per_repository": """
SELECT repository_name, count(*) AS prs FROM fx_latest GROUP BY repository_name""",
    "needs_refresh": """
SELECT * FROM fx_needs WHERE is_new OR need_commits OR need_comments OR need_files""",
    "new_only": "SELECT id FROM fx_needs WHERE is_new",
    "refresh_plan": """
SELECT count(*) FILTER (WHERE is_new) AS new_prs,
  count(*) FILTER (WHERE NOT is_new AND NOT (need_commits OR need_comments OR need_files))
    AS skipped,
  count(*) FILTER (WHERE NOT is_new AND need_commits) AS update_commits,
  count(*) FILTER (WHERE NOT is_new AND need_comments) AS update_comments,
  count(*) FILTER (WHERE NOT is_new AND need_files) AS update_files FROM fx_needs""",
    "snapshot_merge": _MERGED,
    "snapshot_history": _MERGED,
    "state_update": _STATE,
    "merge_bucketed": _MERGED,
    "compact_planned": """
SELECT repository_name, id, snap, has_commits, has_comments, has_files, 0 AS lost, true AS fewer
FROM fx_snapshot""",
    "compact": _LATEST,
    "batch_assign": f"""
SELECT repository_name, id, batch, batches,
  repository_name || '_batch_' || batch || '_of_' || batches AS batch_name FROM (
  SELECT repository_name, id,
    (row_number() OVER (PARTITION BY repository_name ORDER BY id) - 1) // {Q.BATCH} + 1 AS batch,
    CAST(ceil(count(*) OVER (PARTITION BY repository_name) / {Q.BATCH}) AS BIGINT) AS batches
  FROM fx_head)""",
    "batch_metadata": """
SELECT count(*) AS total_prs, false AS is_incremental_save, true AS is_final_save,
  CAST(NULL AS VARCHAR) AS batch_name, count(*) FILTER (WHERE need_commits) AS commits,
  count(*) FILTER (WHERE need_comments) AS comments, count(*) FILTER (WHERE need_files) AS files,
  'example' AS organization, 10 AS top_n_repositories, 100000 AS max_prs_per_repo,
  300 AS batch_size FROM fx_needs""",
    "extraction_run": "SELECT repository_name, change_type, count(*) AS prs, " + ", ".join(
        f"CAST(sum({m}) AS BIGINT) AS {m}" for m in _MEASURES
    ) + f""" FROM nested WHERE pr_state = 'closed' AND repo_key IN (
  SELECT repo_key FROM fx_repo WHERE NOT is_fork AND NOT is_archived
  ORDER BY stars DESC, full_name LIMIT {Q.EXTRACTED_REPOSITORIES})
GROUP BY repository_name, change_type""",
    "extraction_rejects": """
SELECT 'pull_requests' AS listing, 'missing number' AS reject_reason, count(*) AS count
FROM fx_head WHERE pr_number % 11 = 0
UNION ALL SELECT 'commits', 'unreadable page', count(*)
FROM fx_commit JOIN fx_head USING (pr_number) WHERE pr_number % 13 = 0
UNION ALL SELECT 'files', 'missing filename', count(*)
FROM fx_file JOIN fx_head USING (pr_number) WHERE pr_number % 17 = 0
UNION ALL SELECT 'records', 'kept', count(*) FROM fx_head WHERE pr_number % 11 <> 0""",
    "scan_envelope": _STORED,
    "sink_json": _STORED,
    "scan_any_layout": f"{_CONTENTS}, 0 AS rejected FROM nested",
    "document_records": f"{_CONTENTS} FROM nested",
    "document_children": f"""
SELECT pr_number, 'commit' AS part, sha AS key, {_digest("message", "author", "date")}
FROM fx_last_commit
UNION ALL
SELECT pr_number, 'comment', CAST(rank - 1 AS VARCHAR),
  {_digest("id", "body", "author", "date", "type", "position")}
FROM fx_comment_ranked WHERE rank <= 100 AND pr_number IN (SELECT pr_number FROM fx_head)
UNION ALL
SELECT pr_number, 'file', CAST(rank - 1 AS VARCHAR),
  {_digest("filename", "status", "additions", "deletions", "changes", _cut_patch)}
FROM fx_file_kept""",
    "document_statistics": """
SELECT repository_name, total_prs, true AS is_final_save, metric, key, value
FROM save_values JOIN save_counts USING (repository_name)""",
    "sink_csv": """
SELECT id, repository_language, title, nullif(tags, '') AS tags, commits_count, comments_count,
  files_count, additions, pr_number, author, draft FROM nested""",
    "timestamps": """
SELECT id, CASE WHEN pr_number % 3 <> 0 THEN CAST(epoch(CAST(created_at AS TIMESTAMP)) AS BIGINT) END AS created,
  CAST(epoch(CAST(merged_at AS TIMESTAMP)) AS BIGINT) AS merged FROM fx_head""",
    "scan_quarantine": """
SELECT CASE WHEN pr_number % 2 = 1 THEN 'unreadable' ELSE 'record' END AS kind, count(*) AS count
FROM fx_snapshot GROUP BY 1""",
    "decode_contents": """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE length(text) END AS length,
  md5(CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END) AS md5 FROM documents""",
    "per_repo_apply": """
SELECT full_name, 'lang:' || language AS label, CAST(NULL AS VARCHAR) AS error
FROM fx_repo JOIN fx_repo_language USING (repo_key) WHERE NOT is_archived
UNION ALL SELECT full_name, NULL, 'ValueError: archived' FROM fx_repo WHERE is_archived""",
    "stream_ingest": _LATEST,
    "stream_upsert": _MERGED,
    "stream_versions": _MERGED,
    "stream_distinct": """
SELECT event_type, count(*) AS deliveries, count(DISTINCT event_id) AS ids FROM events
GROUP BY event_type""",
    "file_ledger": "SELECT *, 0 AS opened_again FROM fx_merged",
    "stream_state": _STATE,
    "stream_equals_batch": """
SELECT count(*) AS streamed, count(*) AS batch, 0 AS different FROM fx_latest""",
}

_BODIES["csv_side_outputs"] = f"""
SELECT metric, key, value FROM ({_BODIES["statistics"]})
UNION ALL SELECT 'metadata', 'total_prs', CAST(count(*) AS DOUBLE) FROM fx_head
UNION ALL SELECT 'metadata', 'batch_size', {Q.BATCH}
UNION ALL SELECT 'csv', 'rows', count(*) FROM fx_head"""
_BODIES["report_files"] = f"""
SELECT 'coverage' AS report, key, CAST(value AS DOUBLE) AS value FROM (
  UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM ({_BODIES["coverage_pct"]}))
  ON COLUMNS(*) INTO NAME key VALUE value)
UNION ALL SELECT 'top_repositories', repository_full_name, count FROM ({_BODIES["top_repos"]})
UNION ALL SELECT 'top_authors', author, count FROM ({_BODIES["top_authors5"]})"""

ORACLES: dict[str, str] = {name: with_parts(body) for name, body in _BODIES.items()}
