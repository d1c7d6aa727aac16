"""Personal data: fixed patterns, and candidate spans judged by labelers whose reliability is learnt without labels."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]

# Fixed patterns -----------------------------------------------------------------------------------
# Each finds what its regular expression finds, leftmost first and without overlaps, in time linear in the text.

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        begin = free + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        if m.group().count(".") >= 3:
            parts, at = m.group().split("."), m.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k:k + 4]
                size = sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                    yield at, at + size
                at += size + 1


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    return {k: list(f(text)) for k, f in zip(BASE, (_emails, _ips, _cards, _phones))}


# Candidates and labelers ------------------------------------------------------------------------

_CANDIDATES = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)|@) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]{1,63}){1,4}")),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7})(?![0-9A-Fa-f:])")),
    ("card", re.compile(r"(?<![0-9A-Za-z])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|[0-9]{13,19}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])")),
    ("phone", re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])|(?<![0-9.])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")),
)

#: Fixed lists of the gazetteer: top-level domains, card issuers' first digits, country codes, first letters of known keys.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "ca", "us", "au", "jp", "in", "br")
ISSUERS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "6011", "62", "64", "65")
COUNTRIES = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91")
KEYS = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "pk_", "xox", "eyJ", "AIza")
CUES = {
    "email": re.compile(r"(?i)e-?mail|contact|correo|courriel|write to|reach"),
    "ip": re.compile(r"(?i)\bip\b|address|host|server|login from"),
    "card": re.compile(r"(?i)card|visa|master|credit|karte|tarjeta|carte|pay"),
    "phone": re.compile(r"(?i)phone|tel\b|tel[.:]|call|fax|mobile|telefon|móvil"),
    "secret": re.compile(r"(?i)password|passwd|pwd|token|secret|api[_ -]?key|key|credential"),
}
LABELERS = ("pattern", "check", "gazetteer", "context", "shape")


def _votes(kind: str, text: str, begin: int, end: int) -> tuple[int, ...]:
    """What each labeler says of a candidate: 1 personal, 0 not, 2 nothing."""
    span, digits = text[begin:end], _digits(text[begin:end])
    cue = CUES[kind].search(text, max(0, begin - 40), begin)
    other = any(c.search(text, max(0, begin - 20), begin) for k, c in CUES.items() if k != kind)
    context = 1 if cue else 0 if other else 2
    if kind == "email":
        return 1 if "@" in span else 2, 1 if _DOMAIN.search(span) else 0, 1 if re.split(r"[.\])] ?", span)[-1].lower() in DOMAINS else 0, context, 1 if " " not in span else 0
    if kind == "ip":
        parts = span.split(".")
        good = len(parts) == 4 and all(int(p) <= 255 for p in parts)
        v6 = span.count(":") >= 3
        return 1 if len(parts) == 4 or v6 else 0, 1 if good or span.count(":") == 7 else 0, 0 if good and parts[0] in ("0", "255") else 2, context, 0 if good and all(len(p) == 1 for p in parts) else 2
    if kind == "card":
        return 1 if len(digits) == 16 else 2, 1 if luhn(digits) else 0, 1 if digits.startswith(ISSUERS) else 0, context, 0 if len(set(digits)) < 4 else 1 if len(digits) >= 15 else 2
    if kind == "phone":
        return 1 if span[0] == "+" else 2, 1 if 8 <= len(digits) <= 15 else 0, 1 if span[0] == "+" and digits.startswith(COUNTRIES) else 2, context, 1 if re.search(r"[ .-][0-9]{3}[ .-][0-9]{4}$", span) else 2
    letters, signs = sum(c.isalpha() for c in span), len(set(span))
    mixed = len(digits) >= 3 and letters >= 3
    return 1 if re.fullmatch(r"[0-9a-f]{16,}|[A-Z0-9]{16,}", span) and mixed else 2, 1 if mixed and signs >= 8 else 0, 1 if span.startswith(KEYS) else 2, context, 0 if not digits or not letters else 1 if signs >= 10 else 2


def _features(text: str, begin: int, end: int) -> tuple[int, int]:
    """Length class and the class of the characters around."""
    before, after = text[begin - 1:begin], text[end:end + 1]
    edge = 2 * (before.isspace() or not before) + (after.isspace() or not after or after in ".,;")
    return min(3, (end - begin) // 12), edge


def candidates(text: str, base: dict[str, list[tuple[int, int]]]) -> list[tuple[str, int, int, tuple[int, ...]]]:
    """Spans outside the base spans that may be personal data: kind, begin, end, votes and features. Earlier kinds win overlaps."""
    taken = sorted(s for spans in base.values() for s in spans)
    out = []
    for kind, pattern in _CANDIDATES:
        if kind == "email" and not ("[at]" in text or "(at)" in text or "@" in text):
            continue
        for m in pattern.finditer(text):
            begin, end = m.span()
            if kind == "secret" and not re.search("[0-9]", m.group()):
                continue
            if not any(begin < b and a < end for a, b in taken):
                out.append((kind, begin, end, _votes(kind, text, begin, end) + _features(text, begin, end)))
        taken = sorted(taken + [x[1:3] for x in out if x[0] == kind])
    return out



def _spans_of(text: str | None) -> tuple[dict[str, list[tuple[int, int]]], list]:
    if not text or ("@" not in text and "[at]" not in text and "(at)" not in text and not re.search("[0-9]|::", text)):
        return {k: [] for k in BASE}, []
    base = base_spans(text)
    return base, candidates(text, base)


# Learning --------------------------------------------------------------------------------------


def vote_table(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(pattern, n)``: how many candidates of all documents have each pattern (kind, votes, features).

    There are at most 5 * 3^5 * 16 patterns, whatever the size of the corpus."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                met.update(f"{KINDS.index(kind)}:" + "".join(map(str, seen)) for kind, _, _, seen in _spans_of(text)[1])
        yield pa.record_batch([pa.array(met.keys(), pa.string()), pa.array(met.values(), pa.int64())], names=["pattern", "n"])

    return arrow_map(docs.select(F.col(text_col).alias("text")), of, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over one kind's vote patterns.

    Returns the probability of the positive class of each pattern, ``p(vote | class)`` for each labeler as
    (labeler, class, vote), and the share of the positive class. Starts from the majority of votes."""
    n = votes.shape[1]
    positive = (1 + (votes == 1).sum(1)) / (2 + (votes != 2).sum(1))
    table, share = np.zeros((n, 2, 3)), 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - positive) * counts, positive * counts])
        share = float((weight[1].sum() + 1) / (counts.sum() + 2))
        for j in range(n):
            for v in range(3):
                table[j, :, v] = weight[:, votes[:, j] == v].sum(1) + 0.5
        # labelers are taken to be better than chance: a vote for a class is not rarer in it
        table /= table.sum(2, keepdims=True)
        swap = (table[:, 1, 1] * (table[:, 0, 0] + table[:, 0, 1])) < (table[:, 0, 1] * (table[:, 1, 0] + table[:, 1, 1]))
        table[swap, 0, :2] = table[swap, 1, :2] = table[swap][:, :, :2].mean(1)
        like = np.log([1 - share, share])[:, None] + sum(np.log(table[j][:, votes[:, j]]) for j in range(n))
        positive = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
    return positive, table, share


def _design(patterns: list[str]) -> np.ndarray:
    """One-hot features of patterns: kind with each vote, length class and edges."""
    rows = np.zeros((len(patterns), 5 * (1 + 3 * 5) + 4 + 4))
    for r, p in enumerate(patterns):
        kind, marks = int(p[0]), [*map(int, p[2:])]
        rows[r, kind * 16] = 1
        for j, v in enumerate(marks[:5]):
            rows[r, kind * 16 + 1 + 3 * j + v] = 1
        rows[r, 80 + marks[5]] = rows[r, 84 + marks[6]] = 1
    return rows


def train(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Probability of each pattern under the final span classifier: logistic regression on the aggregated labels."""
    found = sorted((r["pattern"], r["n"]) for r in vote_table(docs, text_col).collect())  # a bounded table
    if not found:
        return {}
    patterns, counts = [p for p, _ in found], np.array([float(n) for _, n in found])
    label = np.zeros(len(found))
    for kind in range(len(KINDS)):
        own = [k for k, p in enumerate(patterns) if p[0] == str(kind)]
        if own:
            votes = np.array([[int(c) for c in patterns[k][2:7]] for k in own])
            label[own] = reliabilities(votes, counts[own])[0]
    x, weight = _design(patterns), np.log1p(counts)
    theta = np.zeros(x.shape[1])
    for _ in range(400):
        p = 1 / (1 + np.exp(-x @ theta))
        theta -= 2.0 * (x.T @ (weight * (p - label)) / weight.sum() + 1e-4 * theta)
    return dict(zip(patterns, (1 / (1 + np.exp(-x @ theta))).tolist()))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``(id, base, added)`` per row: arrays of ``struct<kind, first, past>`` in code points, sorted by kind, then start.

    ``base`` holds what the fixed patterns find in the whole text. ``added`` holds the candidates beside it
    whose probability is ``least`` or more: labelers (pattern, checksum, gazetteer, context, shape) vote
    on every candidate of the corpus, expectation-maximisation estimates their reliability from the vote
    counts, and a classifier trained on the resulting labels judges each span. A NULL or empty text has
    no spans. Repeated rows give repeated results; other columns play no part; an empty table gives an empty one."""
    model = train(docs, text_col)
    span = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()), ("past", pa.int64())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, adds = [], []
            for text in batch.column(1).to_pylist():
                base, more = _spans_of(text)
                bases.append([{"kind": k, "first": a, "past": b} for k in BASE for a, b in base[k]])
                good = sorted((KINDS.index(k), a, b) for k, a, b, seen in more if model.get(f"{KINDS.index(k)}:" + "".join(map(str, seen)), 0) >= least)
                adds.append([{"kind": KINDS[k], "first": a, "past": b} for k, a, b in good])
            yield pa.record_batch([batch.column(0), pa.array(bases, span), pa.array(adds, span)], names=["id", "base", "added"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = "array<struct<kind: string, first: bigint, past: bigint>>"
    return arrow_map(slim, of, f"id {slim.schema['id'].dataType.simpleString()}, base {kind}, added {kind}")


def mask_pii(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind in brackets; NULL stays NULL."""
    model = train(docs, text_col)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str | None] = []
            for text in batch.column(1).to_pylist():
                base, more = _spans_of(text)
                spans = [(a, b, k) for k in BASE for a, b in base[k]]
                spans += [(a, b, k) for k, a, b, seen in more if model.get(f"{KINDS.index(k)}:" + "".join(map(str, seen)), 0) >= least]
                parts, at = [], 0
                for a, b, k in sorted(spans):
                    if a >= at:
                        parts += [text[at:a], f"[{k}]"]
                    at = max(at, b)
                out.append(text if text is None else "".join([*parts, text[at:]]))
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], names=["row", "text"])

    kept = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    done = arrow_map(kept, of, f"row {docs.schema.simpleString()}, text string")
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
