"""The weighted rule table of the change-type classifier.

The word lists, patterns, weights and reason texts are fixed values: results depend on them
and on their order. A ``RuleSet`` can be replaced by the caller.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple


class Rule(NamedTuple):
    change_type: str
    source: str
    pattern: str


@dataclass(frozen=True)
class TypeRules:
    """Rules of one change type."""

    labels: tuple[str, ...]
    keywords: tuple[str, ...]
    commit_patterns: tuple[str, ...]


# Fixed values.
FIX = TypeRules(
    labels=(
        "bug", "bugfix", "fix", "hotfix", "patch", "security", "critical", "regression",
        "memory-leak", "crash", "error",
    ),
    keywords=(
        "fix", "bug", "patch", "hotfix", "resolve", "close", "closes", "fixes", "repair",
        "correct", "issue", "problem", "error", "crash", "failure", "broken", "regression",
        "security", "vulnerability", "memory leak",
    ),
    commit_patterns=(
        r"\bfix\b", r"\bbug\b", r"\bpatch\b", r"\bhotfix\b", r"\bresolve[sd]?\b",
        r"\bclose[sd]?\b", r"\bissue\s*#?\d+", r"\bfixes?\s*#?\d+",
    ),
)
FEATURE = TypeRules(
    labels=(
        "feature", "enhancement", "new-feature", "improvement", "api", "new", "addition",
        "capability", "functionality",
    ),
    keywords=(
        "add", "feature", "implement", "new", "create", "introduce", "support", "enable",
        "enhance", "improvement", "upgrade", "extend", "expand", "capability", "functionality",
        "option", "api", "endpoint",
    ),
    commit_patterns=(
        r"\badd\b", r"\bfeature\b", r"\bimplement\b", r"\bnew\b", r"\bcreate\b",
        r"\bintroduce\b", r"\benhance\b", r"\bimprove\b",
    ),
)
DOC = TypeRules(
    labels=(
        "documentation", "docs", "readme", "wiki", "guide", "tutorial", "example", "changelog",
        "license",
    ),
    keywords=(
        "doc", "documentation", "readme", "comment", "comments", "guide", "tutorial", "example",
        "sample", "markdown", "wiki", "manual", "specification", "spec", "changelog", "license",
    ),
    commit_patterns=(
        r"\bdoc\b", r"\bdocumentation\b", r"\breadme\b", r"\bcomment\b", r"\bguide\b",
        r"\btutorial\b", r"\bexample\b",
    ),
)

# Points are hundredths of a score.
LABEL_POINTS = 40
TITLE_KEYWORD_POINTS = 30
BODY_KEYWORD_POINTS = 10
COMMIT_POINTS = 20
SHORT_TITLE_POINTS = 10
LONG_BODY_POINTS = 5
DOC_WORD_POINTS = 20
URGENT_POINTS = 20
TEST_POINTS = 10
REFACTOR_POINTS = 15
SIMILARITY_WEIGHT = 0.3
SHORT_TITLE_WORDS = 5
LONG_BODY_WORDS = 50
CONFIDENCE_THRESHOLD = 0.6

# Word lists of the commit profile, the title bonus, the doc bonus, the basic form.
URGENT_WORDS = ("hotfix", "critical", "urgent", "emergency", "asap")
REFACTOR_WORDS = ("refactor", "restructure", "reorganize", "cleanup")
TEST_WORDS = ("test", "testing", "spec", "unittest", "integration")
SHORT_TITLE_FIX_WORDS = ("fix", "patch", "hotfix")
DOC_WORDS = ("readme", "doc")
BASIC_FIX_WORDS = ("fix", "bug", "patch")
BASIC_DOC_WORDS = ("doc", "readme", "documentation")
BASIC_CONFIDENCE = 0.5
DEFAULT_TYPE = "feature"

# Reason texts.
REASON_LABEL = "Label '{label}' matches {type}"
REASON_KEYWORD = "Keyword '{keyword}' found in {place}"
REASON_COMMIT = "Commit pattern '{pattern}' matches {type}"
REASON_SIMILARITY = "NLP semantic similarity to {type} patterns: {value}"
REASON_URGENT = "Urgent commit indicators detected"
REASON_TEST = "High test commit ratio indicates feature development"
REASON_REFACTOR = "Refactoring commits detected"
REASON_SHORT_TITLE = "Short fix-type title detected"
REASON_LONG_BODY = "Detailed description suggests feature implementation"
REASON_DOC_WORDS = "Documentation keywords detected"
REASON_DEFAULT = "Confidence below threshold, defaulting to feature"
REASON_BASIC = "Basic detection used"
REASON_REUSED = "Reused from cached data"


@dataclass(frozen=True)
class RuleSet:
    """Rules per change type; the order of types decides ties."""

    types: dict[str, TypeRules] = field(
        default_factory=lambda: {"fix": FIX, "feature": FEATURE, "doc": DOC}
    )

    def flat(self) -> list[Rule]:
        """All rules as rows, in evaluation order per source."""
        rows: list[Rule] = []
        for source in ("label", "keyword", "commit"):
            for name, rules in self.types.items():
                patterns = {
                    "label": rules.labels,
                    "keyword": rules.keywords,
                    "commit": rules.commit_patterns,
                }[source]
                rows.extend(Rule(name, source, pattern) for pattern in patterns)
        return rows


DEFAULT_RULES = RuleSet()
