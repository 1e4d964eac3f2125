"""Secrets in texts: fixed patterns, and a character network over every other candidate."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergelens.llm.charnet import CharNet, NetSettings, codes
from mergelens.llm.findings import Finding, labelled_findings
from mergelens.llm.samples import hash_share

#: The base kinds in the order in which spans of one start are listed (fixed values).
KINDS = ("assign", "access", "hex", "model")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: What the network looks at: runs of the signs of values, from 16 signs on.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
LEAST = 16
#: Signs before, in (first and last half) and after a candidate that the network sees.
BEFORE, HALF, AFTER = 24, 24, 24


@dataclass(frozen=True)
class Span:
    start: int
    kind: int
    end: int


@dataclass(frozen=True)
class SecretModel:
    net: CharNet
    threshold: float


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, in code points, by start and kind; leftmost, per kind."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        spans += [
            Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6
        ]
    spans += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s.start, s.kind))


def candidates(text: str, base: list[Span], parts: bool = True) -> list[Span]:
    """Runs of value signs for the network; of a run that base spans touch, the parts they leave.

    ``parts`` False leaves such runs out.
    """
    out, at = [], 0
    stretches: list[list[int]] = []
    for s in base:
        if stretches and s.start <= stretches[-1][1]:
            stretches[-1][1] = max(stretches[-1][1], s.end)
        else:
            stretches.append([s.start, s.end])
    for m in CANDIDATE.finditer(text):
        while at < len(stretches) and stretches[at][1] <= m.start():
            at += 1
        start, k = m.start(), at
        while k < len(stretches) and stretches[k][0] < m.end():
            out.append((start, stretches[k][0], True))
            start, k = stretches[k][1], k + 1
        out.append((start, m.end(), k > at))
    return [Span(i, 3, j) for i, j, part in out if j - i >= LEAST and (parts or not part)]


def views(texts: list[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """What the network sees of (before, value, after): context, head and tail of the value."""
    width = BEFORE + 2 * HALF + AFTER
    shown, inside = [], np.zeros((len(texts), width), bool)
    for row, (before, value, after) in enumerate(texts):
        middle = value if len(value) <= 2 * HALF else value[:HALF] + value[-HALF:]
        shown.append(before[-BEFORE:].rjust(BEFORE) + middle.ljust(2 * HALF) + after[:AFTER])
        inside[row, BEFORE : BEFORE + len(middle)] = True
    return codes(shown, width), inside


def fit_secrets(
    weak: list[Finding] = (), recall: float = 0.95, settings: NetSettings = NetSettings()
) -> SecretModel:
    """The network on labelled findings; a fifth is kept to set the threshold.

    The threshold is the largest at which the kept secrets reach ``recall``. ``weak``: findings
    of the corpus that rules have labelled, used for training only.
    """
    listed = labelled_findings()
    kept = [f for i, f in enumerate(listed) if i % 5 == 4]
    seen = [f for i, f in enumerate(listed) if i % 5 != 4] + list(weak)
    net = CharNet(settings)
    net.train(*views([(f.before, f.value, f.after) for f in seen]), _labels(seen))
    scores = net.score(*views([(f.before, f.value, f.after) for f in kept]))
    secrets = np.sort(scores[_labels(kept) == 1])
    return SecretModel(net, float(secrets[int((1 - recall) * len(secrets))]))


def _labels(findings: list[Finding]) -> np.ndarray:
    return np.array([float(f.secret) for f in findings])


def weak_findings(docs: DataFrame, sample: int = 1_000, each: int = 2) -> list[Finding]:
    """Labelled findings of the corpus: base spans are secrets, other candidates are not.

    They come from about ``20 * sample`` documents, chosen by a hash of id and text; at most
    ``sample`` of them with any findings count (the smallest hashes), and ``each`` findings of either
    label from one. This bounds what training sees, not what is scanned.
    """
    place = F.xxhash64("doc_id", "text")
    rows = (
        hash_share(docs, place, docs.count(), 5 * sample)
        .select(place.alias("place"), "text")
        .mapInArrow(
            lambda batches: _weak_batches(batches, each),
            "place long, rank int, before string, value string, after string, secret boolean",
        )
        .orderBy("place", "rank")
        .limit(sample * 2 * each)
        .collect()
    )
    return [Finding(r.before, r.value, r.after, r.secret) for r in rows]


def _weak_batches(batches: Iterator[pa.RecordBatch], each: int) -> Iterator[pa.RecordBatch]:
    names = ["place", "rank", "before", "value", "after", "secret"]
    types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_()]
    for batch in batches:
        out = []
        for place, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            base = base_spans(text or "")
            picked = base[:each] + candidates(text or "", base, parts=False)[:each] if text else []
            for rank, s in enumerate(picked):
                around = text[max(0, s.start - BEFORE) : s.start], text[s.end : s.end + AFTER]
                out.append((place, rank, around[0], text[s.start : s.end], around[1], s.kind < 3))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=names
        )


def find_secrets(texts: list[str], model: SecretModel) -> list[list[Span]]:
    """All spans of each text, by start and kind; candidates of all texts are scored together."""
    base = [base_spans(t) for t in texts]
    asked = [(i, s) for i, t in enumerate(texts) for s in candidates(t, base[i])]
    shown = [
        (
            texts[i][max(0, s.start - BEFORE) : s.start],
            texts[i][s.start : s.end],
            texts[i][s.end : s.end + AFTER],
        )
        for i, s in asked
    ]
    out = [list(b) for b in base]
    for start in range(0, len(asked), 512):
        scores = model.net.score(*views(shown[start : start + 512]))
        for (i, span), score in zip(asked[start : start + 512], scores, strict=True):
            if score >= model.threshold:
                out[i].append(span)
    return [sorted(spans, key=lambda s: (s.start, s.kind)) for spans in out]


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def redact(text: str, spans: list[Span], sign: str = "[SECRET]") -> str:
    """The text with every stretch of overlapping spans replaced by one ``sign``."""
    parts, at = [], 0
    stretch: list[int] = []
    for s in [*spans, None]:
        if stretch and (s is None or s.start > stretch[1]):
            parts += [text[at : stretch[0]], sign]
            at, stretch = stretch[1], []
        if s is not None:
            stretch = [stretch[0], max(stretch[1], s.end)] if stretch else [s.start, s.end]
    return "".join([*parts, text[at:]])


def scan_secrets(docs: DataFrame, model: SecretModel, keep: list[str]) -> DataFrame:
    """``keep`` columns, n_assign, n_access, n_hex, base_sha256, spans and redacted.

    Whole texts are scanned; a null text counts as empty and is redacted to null. Rows are scanned
    one by one: repeated rows get equal results, an empty table none. Other columns are not read.
    The model has a fixed size and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "redacted"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                raw = part.column(len(keep)).to_pylist()
                found = find_secrets([t or "" for t in raw], own)
                base = [[s for s in spans if s.kind < 3] for spans in found]
                counts = [[sum(s.kind == k for s in b) for b in base] for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(len(keep))),
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array([sha256(written(b).encode()).hexdigest() for b in base], pa.string()),
                        pa.array([written(f) for f in found], pa.string()),
                        pa.array(
                            [t and redact(t, f) for t, f in zip(raw, found, strict=True)], pa.string()
                        ),
                    ],
                    names=[*keep, *made],
                )

    schema = docs.select(*keep).schema
    for name in made:
        schema = schema.add(name, "long" if name.startswith("n_") else "string")
    return docs.select(*keep, "text").mapInArrow(scan, schema)
