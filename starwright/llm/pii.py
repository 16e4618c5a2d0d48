"""Personal data by weak supervision.

Patterns propose candidate spans.  Five labelers vote on each: its pattern's rule, a
gazetteer, the words before it, its surroundings, and its characters; a vote is for, against
or an abstention.  No labeler is trusted in advance: expectation-maximisation estimates, per
kind and from the votes of the whole corpus, how often each is right.  Its posteriors train the
final classifier, a logistic regression over votes and shape, which decides on the spans that
the strict base patterns do not have.

Votes and shapes take few values, so the corpus is reduced to counts of their combinations
(at most ``PATTERN_BOUND`` rows, whatever its size) and both models are fitted to the counts.
Texts are read twice, once to count and once to decide, and never shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.llm.common import keyed_text
from starwright.llm.words import batches_of, texts_of

BATCH_ROWS, BATCH_BYTES = 2048, 8 << 20

#: Kinds in the order of reports: those of the base patterns, then those the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "name")

LABELERS = 5
LENGTHS, SHARES, SIDES = 4, 3, 3
PATTERN_BOUND = len(KINDS) * 3**LABELERS * LENGTHS * SHARES * SIDES * SIDES
CONTEXT = 32
MIN_PROBABILITY = 0.9

# The base patterns, written so that each text is read in linear time.
_LOCAL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?=@)")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# Looser patterns of candidates.
_SPELLED_AT = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{2,63})+", re.I,
)
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}")
_NAME = re.compile(r"[A-Z][a-z]++\.? [A-Z][a-z]++")

# Gazetteers and words of context.
_ENDINGS = frozenset("com org net edu gov info io eu de fr es uk it nl ch at us".split())
_CALLING = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "4", "5", "6", "7", "8", "9")
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5|4[4-9])|35")
_RESERVED_IP = re.compile(r"0\.|10\.|127\.|169\.254\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.|2[2-5]\d\.")
_KEY_STARTS = ("AKIA", "ghp_", "sk-", "xox", "eyJ", "AIza")
_GIVEN = frozenset(
    "James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia"
    " Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Hans Peter Klaus Anna Maria"
    " Jean Pierre Marie Luc Carlos Juan Carmen Ana".split()
)
_TITLES = frozenset("Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Sr Sra".split())
_WORDS_BEFORE = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write to|correo|courriel)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|adresse|dirección)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|credit|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|fax|mobile|telefon|téléphone|teléfono)\b", re.I),
    "secret": re.compile(r"\b(?:token|secret|password|passwd|key|apikey|auth)\b", re.I),
    "name": re.compile(r"\b(?:name|dear|by|contact|author|herr|frau|señor|madame)\b", re.I),
}
_WORDS_AGAINST = re.compile(r"\b(?:version|license|page|chapter|isbn|section|sha1|md5)\W*$", re.I)


class Span(NamedTuple):
    start: int
    kind: int
    end: int


class Candidate(NamedTuple):
    span: Span
    base: bool
    votes: tuple[int, ...]
    shape: tuple[int, int, int, int]


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _part_fits(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: a run of local characters, cut where the last match ended."""
    last = 0
    for run in _LOCAL.finditer(text):
        start = max(last, run.start())
        domain = _DOMAIN.match(text, run.end() + 1) if start < run.end() else None
        if domain:
            last = domain.end()
            yield start, last


def _matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """Start, kind, end of all matches of the base patterns, and whether they pass."""
    if "@" in text:
        for start, end in _emails(text):
            yield start, 0, end, True
    for found in _IP.finditer(text):
        yield found.start(), 1, found.end(), all(map(_part_fits, found[0].split(".")))
    for found in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", found[0])
        yield found.start(), 2, found.end(), 12 <= len(digits) <= 19 and _luhn(digits)
    if "+" in text:
        for found in _PHONE.finditer(text):
            digits = len(_NOT_DIGIT.sub("", found[0]))
            yield found.start(), 3, found.end(), 9 <= digits <= 15


def base_spans(text: str) -> list[Span]:
    return sorted(Span(a, kind, b) for a, kind, b, passes in _matches(text) if passes)


def _loose(text: str) -> Iterator[tuple[int, int, int]]:
    lowered = text.lower()
    if "at)" in lowered or "at]" in lowered:
        for found in _SPELLED_AT.finditer(text):
            yield found.start(), 0, found.end()
    for found in _LOCAL_PHONE.finditer(text):
        yield found.start(), 3, found.end()
    for found in _SECRET.finditer(text):
        run = found[0]
        if not run.isalpha() and not run.isdigit() and any(map(str.isalpha, run)):
            if any(map(str.isdigit, run)):
                yield found.start(), 4, found.end()
    for found in _NAME.finditer(text):
        first = found[0].split()[0].rstrip(".")
        if first in _GIVEN or first in _TITLES:
            yield found.start(), 5, found.end()


def _gazetteer(kind: str, body: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[\W_]+", body.lower())[-1] in _ENDINGS else 0
    if kind == "ip":
        return -1 if _RESERVED_IP.match(body) else 1
    if kind == "card":
        return 1 if _ISSUERS.match(body) else -1
    if kind == "phone":
        return 0 if body[0] != "+" else 1 if body[1:].startswith(_CALLING) else -1
    if kind == "secret":
        return 1 if body.startswith(_KEY_STARTS) else 0
    return 1 if body.split()[0] in _GIVEN else 0


def _characters(kind: str, body: str) -> int:
    """Whether the characters vary as those of real data do."""
    letters = set(body.lower())
    if kind == "secret":
        return 1 if len(letters) >= 10 else -1
    if kind in ("card", "phone"):
        return -1 if len(letters & set("0123456789")) <= 2 else 1
    return 0


def _rule(kind: str, body: str, passes: bool | None) -> int:
    """The pattern's own rule; an abstention where only a looser pattern matched."""
    if kind == "secret":
        return 1 if re.fullmatch(r"[0-9a-fA-F]{32,}", body) else 0
    return 0 if passes is None else 1 if passes else -1


def _side(character: str) -> int:
    return 2 if character.isalnum() else 1 if character and not character.isspace() else 0


def candidates(text: str) -> list[Candidate]:
    """All proposed spans of a text with their votes and shapes; the base spans are among them."""
    proposed: dict[Span, bool | None] = {}
    for start, kind, end, passes in _matches(text):
        # Short numbers are everywhere; only long ones may be an account of some kind.
        if passes or kind != 2 or end - start >= 9:
            proposed[Span(start, kind, end)] = passes
    for start, kind, end in _loose(text):
        proposed.setdefault(Span(start, kind, end), None)
    found = []
    for span, passes in proposed.items():
        kind, body = KINDS[span.kind], text[span.start : span.end]
        before = text[max(0, span.start - CONTEXT) : span.start]
        left, right = _side(before[-1:]), _side(text[span.end : span.end + 1])
        context = -1 if _WORDS_AGAINST.search(before) else int(
            bool(_WORDS_BEFORE[kind].search(before))
        )
        votes = (
            _rule(kind, body, passes),
            _gazetteer(kind, body),
            context,
            -1 if 2 in (left, right) else 1,
            _characters(kind, body),
        )
        digits = sum(map(str.isdigit, body)) / len(body)
        shape = (
            min(LENGTHS - 1, len(body) // 12),
            0 if digits < 0.2 else 1 if digits < 0.7 else 2,
            left, right,
        )
        found.append(Candidate(span, bool(passes), votes, shape))
    return found


def _inputs(kinds: np.ndarray, votes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """One column for each value that a kind, a vote or a shape can take, and a constant."""
    columns = [np.ones(len(kinds))]
    columns += [kinds == k for k in range(len(KINDS))]
    columns += [votes[:, j] == v for j in range(LABELERS) for v in (-1, 1)]
    for j, size in enumerate((LENGTHS, SHARES, SIDES, SIDES)):
        columns += [shapes[:, j] == v for v in range(size)]
    return np.stack(columns, axis=1).astype(np.float64)


@dataclass
class Model:
    """What the labelers' votes are worth, per kind, and the classifier's weights."""

    prior: np.ndarray
    reliability: np.ndarray  # kind, class, labeler, vote + 1
    weights: np.ndarray

    def probability(self, found: list[Candidate]) -> np.ndarray:
        if not found:
            return np.zeros(0)
        inputs = _inputs(
            np.array([c.span.kind for c in found]),
            np.array([c.votes for c in found]),
            np.array([c.shape for c in found]),
        )
        return 1 / (1 + np.exp(-np.clip(inputs @ self.weights, -50, 50)))


def _posterior(kinds, votes, prior, reliability) -> np.ndarray:
    """Probability that a candidate is personal data, given its votes."""
    logs = np.stack([np.log(1 - prior[kinds]), np.log(prior[kinds])], axis=1)
    for j in range(LABELERS):
        logs += np.log(reliability[kinds, :, j, votes[:, j] + 1])
    odds = np.clip(logs[:, 0] - logs[:, 1], -700, 700)
    return 1 / (1 + np.exp(odds))


def fit_counts(patterns: list[tuple[tuple, int]], rounds: int = 100) -> Model:
    """Expectation-maximisation over counted patterns, then the classifier.

    Voters start as right more often than wrong, which also tells the classes apart.  Every
    estimate is smoothed by one candidate of each kind that votes in the starting manner.
    """
    start = np.array([[[0.6, 0.3, 0.1]] * LABELERS, [[0.1, 0.3, 0.6]] * LABELERS])
    reliability = np.repeat(start[None], len(KINDS), axis=0)
    prior = np.full(len(KINDS), 0.5)
    if not patterns:
        return Model(prior, reliability, np.zeros(_inputs(*_empty()).shape[1]))
    kinds = np.array([p[0] for p, _ in patterns])
    votes = np.array([p[1 : 1 + LABELERS] for p, _ in patterns])
    shapes = np.array([p[1 + LABELERS :] for p, _ in patterns])
    counts = np.array([n for _, n in patterns], np.float64)
    for _ in range(rounds):
        yes = _posterior(kinds, votes, prior, reliability)
        old = prior
        weight = np.stack([counts * (1 - yes), counts * yes])
        totals = np.stack([np.bincount(kinds, w, len(KINDS)) for w in weight])
        prior = (totals[1] + 0.5) / (totals.sum(axis=0) + 1)
        reliability = np.repeat(start[None], len(KINDS), axis=0)
        for c in range(2):
            for j in range(LABELERS):
                np.add.at(reliability, (kinds, c, j, votes[:, j] + 1), weight[c])
        reliability /= reliability.sum(axis=3, keepdims=True)
        if np.abs(prior - old).max() < 1e-9:
            break
    yes = _posterior(kinds, votes, prior, reliability)
    return Model(prior, reliability, _logistic(_inputs(kinds, votes, shapes), yes, counts))


def _empty() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.zeros(0, int), np.zeros((0, LABELERS), int), np.zeros((0, 4), int)


def _logistic(inputs: np.ndarray, target: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights by Newton's method on soft targets, with a small ridge."""
    weights, ridge = np.zeros(inputs.shape[1]), 1e-2 * np.eye(inputs.shape[1])
    # Counts beyond a million of one pattern change nothing but the conditioning.
    share = counts / max(1.0, counts.max() / 1e6)
    for _ in range(50):
        guess = 1 / (1 + np.exp(-np.clip(inputs @ weights, -50, 50)))
        slope = inputs.T @ (share * (target - guess)) - ridge @ weights
        curve = (inputs * (share * np.maximum(guess * (1 - guess), 1e-6))[:, None]).T @ inputs
        step = np.linalg.solve(curve + ridge, slope)
        weights += step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Count the patterns of all candidates in the corpus and fit both models to them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch.column(0)):
                for c in candidates(text.as_py()):
                    seen[(c.span.kind, *c.votes, *c.shape)] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([list(key) for key in seen], pa.list_(pa.int32())),
                pa.array(list(seen.values()), pa.int64()),
            ],
            names=["pattern", "n"],
        )

    rows = (
        docs.select(F.col(text_col).alias("text"))
        .mapInArrow(count, "pattern array<int>, n long")
        .groupBy("pattern").agg(F.sum("n").alias("n"))
        .collect()
    )
    return fit_counts(sorted((tuple(row.pattern), row.n) for row in rows))


def spans_of(text: str, model: Model, least: float = MIN_PROBABILITY) -> tuple[list, list]:
    """Base spans, and all spans: the base ones and likely candidates that overlap none before.

    Likelier candidates come first, then earlier ones.
    """
    found = candidates(text)
    base = sorted(c.span for c in found if c.base)
    taken: list[tuple[int, int]] = []
    for span in base:
        if taken and span.start < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(span.end, taken[-1][1]))
        else:
            taken.append((span.start, span.end))
    odds = model.probability(found)
    rest = sorted((-p, c.span) for p, c in zip(odds, found) if not c.base and p >= least)
    chosen = list(base)
    for _, span in rest:
        i = bisect(taken, (span.start, span.end))
        after_last = not i or taken[i - 1][1] <= span.start
        if after_last and (i == len(taken) or span.end <= taken[i][0]):
            taken.insert(i, (span.start, span.end))
            chosen.append(span)
    return base, sorted(chosen)


def _written(spans: list[Span]) -> list[str]:
    return [f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans]


def find(
    docs: DataFrame, model: Model, least: float = MIN_PROBABILITY,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base, spans``.

    The counts are of base spans; ``base`` and ``spans`` are arrays of ``kind:start:end`` by
    start, then kind, in code points with the end excluded.  Null and empty texts have none.
    Repeated rows and null ids stay rows of their own.  Other columns of ``docs`` are left out.
    """
    frame = keyed_text(docs, id_col, text_col)
    schema = T.StructType([
        T.StructField("doc_id", frame.schema["doc_id"].dataType),
        *(T.StructField(f"n_{kind}", T.LongType()) for kind in BASE_KINDS),
        T.StructField("base", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StringType())),
    ])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, BATCH_ROWS, BATCH_BYTES):
            found = [spans_of(text.as_py(), model, least) for text in texts_of(batch.column(1))]
            counts = np.array(
                [np.bincount([s.kind for s in base], minlength=len(KINDS)) for base, _ in found]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(counts[:, k], pa.int64()) for k in range(len(BASE_KINDS))),
                    pa.array([_written(base) for base, _ in found], pa.list_(pa.string())),
                    pa.array([_written(spans) for _, spans in found], pa.list_(pa.string())),
                ],
                names=schema.names,
            )

    return frame.mapInArrow(look, schema)


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans by that of the first."""
    parts, at = [], 0
    for span in spans:
        if span.start >= at:
            parts += [text[at : span.start], f"<{KINDS[span.kind].upper()}>"]
        at = max(at, span.end)
    return "".join([*parts, text[at:]])


def masker(model: Model, least: float = MIN_PROBABILITY) -> Column:
    """A column function that masks the spans of a text; null stays null."""
    @F.arrow_udf("string")
    def masked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(
                [
                    None if text is None else mask(text, spans_of(text, model, least)[1])
                    for text in batch.to_pylist()
                ],
                pa.string(),
            )

    return masked
