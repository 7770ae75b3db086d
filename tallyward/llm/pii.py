"""Personal data by a semi-Markov conditional random field over whole spans.

Candidate segments are all stretches of at most 64 characters between the boundaries of tokens: from any group of digits to
any later one that usual separators link to it, and from any part of the name of a written or spelled-out email address to
any part of its host. Each candidate has features of the whole span (its shape, length, digits, checksum, separators, the
signs and words around it) and a score per kind. A dynamic programme of bounded
segment length chooses the set of non-overlapping segments, with their kinds, of the greatest total score; what no
segment covers scores zero. The weights are learned here, by the gradient of the segment model's likelihood (forward and
backward sums over the candidates) on sentences that are generated from a fixed seed with spans of known kinds.

Base spans (the four fixed patterns) always stay. The text is cut at them before candidates are made, so the field can add
spans beside them; it cannot take one away.

Defined results: a null text is an empty text and has no spans; repeated rows are each searched; an empty table gives no
rows; further columns are not read. Places are code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyward.llm.common import CACHE_ENTRIES, id_and_text, per_batch

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# -- base spans: patterns that are fixed values ----------------------------

EMAIL_END = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def byte_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def emails(text: str) -> list[Span]:
    """The leftmost matches of local part and domain, found from each `@`: no local part is read twice."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := EMAIL_END.match(text, at)):
            end = domain.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and place."""
    found = emails(text) if "@" in text else []
    found += [("ip", *m.span()) for m in IP.finditer(text) if byte_parts(m[0])]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return found


# -- candidates and features ------------------------------------------------

#: No segment is longer: the bound of the dynamic programme.
LONGEST = 64
GROUP = re.compile(r"[0-9]+")
#: What may stand between two groups of digits of one number.
LINK = re.compile(r"[\x20().\-/]{1,2}|\x20?[\[(]?\.[\])]?\x20?")
AT = re.compile(r"\x20?(?:@|[\[({](?:@|at)[\])}])\x20?|\x20at\x20")
LABEL = re.compile(r"[A-Za-z0-9-]+")
NEXT_LABEL = re.compile(r"\x20?[\[({]?(?:\.|\bdot\b)[\])}]?\x20?(?P<label>[A-Za-z0-9-]{2,})")
SPELLED_LABEL = re.compile(r"\x20dot\x20(?P<label>[A-Za-z0-9-]{2,})")
DIGIT = re.compile("[0-9]")
CUES = {
    "email": {"email", "mail", "e", "contact", "write", "courriel", "correo"},
    "ip": {"ip", "host", "address", "server", "from"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "karte", "tarjeta", "carte"},
    "phone": {"tel", "phone", "call", "mobile", "fax", "telephone", "telefon", "teléfono", "téléphone"},
}
SIGNS = set(" +(.-/")
WORDS_BEFORE = re.compile(r"[^\W\d_]+")


def _free(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The stretches of a text between the taken ones."""
    low = 0
    for start, end in sorted(taken):
        if start > low:
            yield low, start
        low = max(low, end)
    if low < len(text):
        yield low, len(text)


def _numbers(text: str, low: int, high: int) -> Iterator[tuple[int, list[int]]]:
    """Ends of groups of digits, each with the starts of the groups linked to it; a `(`, `+` or `+(` may belong to a start."""
    starts, before = [], None
    for m in GROUP.finditer(text, low, high):
        start, end = m.span()
        if before is None or not LINK.fullmatch(text, before, start):
            starts = []
        signs = text[max(low, start - 2) : start]
        more = [start - 2] * (signs == "+(") + [start - 1] * (signs[-1:] in ("+", "(")) + [start]
        before, starts = end, [s for s in starts + more if end - s <= LONGEST]
        if starts:
            yield end, starts


def _addresses(text: str, low: int, high: int) -> list[tuple[int, list[int]]]:
    """Ends of the parts of the hosts of written email addresses, each with the starts of the parts of the names."""
    found = defaultdict(set)
    for m in AT.finditer(text, low, high):
        begin, far = m.start(), min(high, m.end() + LONGEST)
        while begin > max(low, m.start() - LONGEST) and text[begin - 1] in LOCAL:
            begin -= 1
        starts = [s for s in range(begin, m.start()) if s == begin or text[s - 1] in "._%+-"]
        label, following = LABEL.match(text, m.end(), far), SPELLED_LABEL if m[0] == " at " else NEXT_LABEL
        while starts and label and (label := following.match(text, label.end(), far)):
            for end in range(label.start("label") + 1, label.end() + 1):
                if text[end - 1] != "-" and (end == label.end() or text[end] == "-"):
                    found[end].update(s for s in starts if end - s <= LONGEST)
    return sorted((end, sorted(starts)) for end, starts in found.items() if starts)


def by_end(text: str, taken: list[tuple[int, int]] = ()) -> Iterator[tuple[int, list[int]]]:
    """Segments that touch nothing taken: each end, in order, with its starts."""
    digits = DIGIT.search(text)
    written = "@" in text or "at)" in text or "at]" in text or "at}" in text or " dot " in text
    for low, high in _free(text, taken) if digits or written else ():
        numbers = _numbers(text, low, high) if digits else ()
        yield from heapq.merge(numbers, _addresses(text, low, high)) if written else numbers


def candidates(text: str, taken: list[tuple[int, int]] = ()) -> list[tuple[int, int]]:
    """Segments the field may choose, by end."""
    return [(start, end) for end, starts in by_end(text, taken) for start in starts]


def inside(span: str) -> list[str]:
    """What is true of the whole span, wherever it stands."""
    digits = NOT_DIGIT.sub("", span)
    letters = sum(c.isalpha() for c in span)
    parts = span.replace(" ", "").split(".")
    groups = GROUP.findall(span)
    seen = [
        "bias", f"digits{min(len(digits), 20)}", f"dots{min(span.count('.'), 4)}", f"groups{min(len(groups), 6)}",
        "letters" if letters > 3 else "few letters" if letters else "no letters", "at" if "@" in span else "spelled at" if re.search(r"\bat\b", span) else "no at",
        "lengths " + "".join(str(min(len(g), 9)) for g in groups[:6]),
    ]
    seen += ["plus"] * span.startswith("+") + ["parentheses"] * ("(" in span) + ["dash"] * ("-" in span) + ["slash"] * ("/" in span) + ["spelled dot"] * bool(re.search(r"\bdot\b", span))
    if 13 <= len(digits) <= 19:
        seen.append("luhn" if luhn(digits) else "no luhn")
    seen += ["byte parts"] * (len(parts) == 4 and all(p.isascii() and p.isdigit() and int(p) <= 255 for p in parts))
    seen.append("look " + re.sub("9+", "9", re.sub("[0-9]", "9", re.sub(r"[^\W\d_]+", "a", span)))[:24])
    return seen


def before(text: str, start: int) -> list[str]:
    """What stands before a span."""
    words = {w.lower() for w in WORDS_BEFORE.findall(text[max(0, start - 24) : start])[-3:]}
    sign = text[start - 1 : start] if start else ""
    return [f"after {sign if sign in SIGNS else 'other'}"] + [f"cue {kind}" for kind, cues in CUES.items() if words & cues]


def behind(text: str, end: int) -> list[str]:
    """What stands behind a span."""
    sign = text[end : end + 1]
    return [f"ahead of {sign if sign in SIGNS else 'other'}"] + ["ahead of a label"] * bool(NEXT_LABEL.match(text, end, end + 16))


def features(text: str, start: int, end: int) -> list[str]:
    """What is true of a span; the same for every kind, which has its own weights."""
    return inside(text[start:end]) + before(text, start) + behind(text, end)


def _log_sum(values: list[float]) -> float:
    most = max(values)
    return most if most == -math.inf else most + math.log(sum(math.exp(v - most) for v in values))


class Field:
    """Weights of features by kind."""

    def __init__(self) -> None:
        self.weights: dict[tuple[str, str], float] = defaultdict(float)

    def _sums(self, seen: list[str]) -> list[float]:
        return [sum(self.weights.get((k, f), 0.0) for f in seen) for k in KINDS]

    def scores(self, text: str, segments: list[tuple[int, int]]) -> list[dict[str, float]]:
        return [dict(zip(KINDS, self._sums(features(text, *s)), strict=True)) for s in segments]

    def best(self, text: str, taken: list[tuple[int, int]] = (), known: dict[str, list[float]] | None = None) -> list[Span]:
        """The segmentation of the greatest score beside what is taken; ties go to fewer and earlier segments.

        `known` keeps the sums of spans seen in other texts.
        """
        known = {} if known is None else known
        total, last, ends = [0.0], [None], []
        ahead: dict[int, list[float]] = {}
        for end, starts in by_end(text, taken):
            most, chosen = total[-1], None
            after = self._sums(behind(text, end))
            if len(ahead) > 4 * LONGEST:
                ahead = {s: v for s, v in ahead.items() if s >= end - LONGEST}
            for start in starts:
                if (own := known.get(span := text[start:end])) is None:
                    if len(known) >= CACHE_ENTRIES // 4:
                        known.clear()
                    own = known[span] = self._sums(inside(span))
                if (first := ahead.get(start)) is None:
                    first = ahead[start] = self._sums(before(text, start))
                scores = [a + b + c for a, b, c in zip(own, first, after, strict=True)]
                score = max(scores)
                done = bisect_right(ends, start)
                if total[done] + score > most:
                    most, chosen = total[done] + score, (KINDS[scores.index(score)], start, end, done)
            total.append(most)
            last.append(chosen)
            ends.append(end)
        found, at = [], len(ends)
        while at:
            if last[at] is None:
                at -= 1
            else:
                *span, at = last[at]
                found.append(tuple(span))
        return found[::-1]

    def learn(self, text: str, truth: set[Span], rate: float, segments: list[tuple[int, int]] | None = None, seen: list[list[str]] | None = None) -> None:
        """A step up the log likelihood of the true segmentation; `segments` and their features may be given."""
        segments = candidates(text) if segments is None else segments
        seen = [features(text, *s) for s in segments] if seen is None else seen
        scores = [self._sums(own) for own in seen]
        ends = [end for _, end in segments]
        done = [bisect_right(ends, start, 0, i) for i, (start, _) in enumerate(segments)]
        ahead = [0.0]  # log sum over segmentations of the first i candidates
        for i, own in enumerate(scores):
            ahead.append(_log_sum([ahead[i], *(ahead[done[i]] + s for s in own)]))
        back = [-math.inf] * len(segments) + [0.0]  # of the rest, from the state after i candidates
        for i in range(len(segments) - 1, -1, -1):
            back[i] = _log_sum([back[i], back[i + 1]])
            back[done[i]] = _log_sum([back[done[i]], back[i + 1] + _log_sum(scores[i])])
        for i, (segment, own) in enumerate(zip(segments, scores, strict=True)):
            for k, s in zip(KINDS, own, strict=True):
                change = float((k, *segment) in truth) - math.exp(min(0.0, ahead[done[i]] + s + back[i + 1] - ahead[-1]))
                for f in seen[i]:
                    self.weights[k, f] += rate * (change - 0.001 * self.weights[k, f])


# -- training sentences -----------------------------------------------------


def _card(rng: random.Random) -> str:
    digits = [rng.randint(0, 9) for _ in range(15)]
    last = next(d for d in range(10) if luhn("".join(map(str, [*digits, d]))))
    text = "".join(map(str, [*digits, last]))
    joint = rng.choice(["", "", " ", "-", "."])
    return joint.join(text[i : i + 4] for i in range(0, 16, 4))


def _phone(rng: random.Random) -> str:
    number = lambda n: "".join(str(rng.randint(0, 9)) for _ in range(n))
    a, b, c = str(rng.randint(2, 9)) + number(2), number(3), number(4)
    area = a[: rng.randint(2, 3)]
    return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+49 {area} {b}{c}", f"0049 {area} {b}{c}", f"0{area}/{b}{c}"])


def _email(rng: random.Random) -> str:
    word = lambda: "".join(rng.choice("abcdefghiklmnorstuw") for _ in range(rng.randint(3, 8)))
    name, host, top = word() + rng.choice(["", f".{word()}", f".{rng.randint(1, 99)}"]), word(), rng.choice(["com", "org", "net", "de", "example.com"])
    spelled = rng.choice([top.split(".")[-1], "co dot uk", "example dot org"])
    return rng.choice([f"{name}@{host}.{top}", f"{name} at {host} dot {spelled}", f"{name}(at){host}.{top}", f"{name} [at] {host} [dot] {top.split('.')[-1]}", f"{name} @ {host}.{top}"])


def _ip(rng: random.Random) -> str:
    parts = [str(rng.randint(0, 255)) for _ in range(4)]
    return rng.choice([".", ".", "[.]", " . "]).join(parts)


def _other(rng: random.Random) -> str:
    """What looks alike and is no personal data."""
    n = rng.randint
    return rng.choice([
        f"{n(1, 31)}.{n(1, 12)}.{n(1900, 2030)}", f"{n(1900, 2030)}-{n(10, 12)}-{n(10, 28)}", f"{n(1, 9)}.{n(0, 20)}.{n(256, 999)}.{n(300, 999)}", str(n(10**6, 10**9)), str(n(10**12, 10**18)),
        f"{n(1, 99)} {n(100, 999)} {n(100, 999)}", f"{n(1, 999)},{n(100, 999)}.{n(10, 99)}", f"{n(10, 23)}.{n(10, 59)}", "look at this dot here", "all at once. Then", "was at home. They", f"{n(1, 9)}-{n(10, 99)}",
        f"{n(1000, 9999)} {n(1000, 9999)} {n(1000, 9999)} {n(1000, 9999)} {n(10, 99)} {n(10, 99)}", f"at {n(100, 999)}.{n(10, 99)}.", f"{n(10, 99)}/{n(10, 99)}/{n(1000, 9999)}",
        str(n(1, 999)), str(n(1900, 2030)), f"{n(10, 12)}/{n(20, 30)}",
    ])


def training_sentences(count: int, seed: int) -> list[tuple[str, set[Span]]]:
    """Sentences with spans of known kinds, some behind a cue word or another span, and with look-alikes."""
    rng = random.Random(seed)
    makers = {"email": _email, "ip": _ip, "card": _card, "phone": _phone}
    out = []
    for _ in range(count):
        text, truth = "", set()
        for _ in range(rng.randint(1, 4)):
            if not text or rng.random() < 0.7:  # otherwise it stands right behind the one before
                text += " ".join("".join(rng.choice("aeinorstdhl") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 8))) + " "
            if rng.random() < 0.5:
                if rng.random() < 0.2:
                    text += rng.choice(sorted(CUES[rng.choice(KINDS)])) + " "
                text += _other(rng)
            else:
                kind = rng.choice(KINDS)
                if rng.random() < 0.4:
                    text += rng.choice(sorted(CUES[kind])) + rng.choice([" ", ": "])
                made = makers[kind](rng)
                truth.add((kind, len(text), len(text) + len(made)))
                text += made
            text += rng.choice([" ", ". ", ", ", "\n"])
        out.append((text, truth))
    return out


@lru_cache(maxsize=1)
def field(sentences: int = 1500, passes: int = 3, seed: int = 11) -> Field:
    """The trained field."""
    learned, rows = Field(), training_sentences(sentences, seed)
    cut = [candidates(text) for text, _ in rows]
    seen = [[features(text, *s) for s in own] for (text, _), own in zip(rows, cut, strict=True)]
    for n in range(passes):
        for (text, truth), segments, own in zip(rows, cut, seen, strict=True):
            learned.learn(text, truth, 0.3 / (1 + n), segments, own)
    return learned


# -- the operator -----------------------------------------------------------


def all_spans(text: str, learned: Field, base: list[Span] | None = None, known: dict[str, list[float]] | None = None) -> list[Span]:
    """Base spans, and the field's spans beside them, by kind and place."""
    base = base_spans(text) if base is None else base
    added = learned.best(text, [(start, end) for _, start, end in base], known)
    return sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document the number of base spans of each kind, their digest, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(dict(field().weights))  # some hundred numbers

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        learned = Field()
        learned.weights = shared.value
        counts, digests, spans, known = [], [], [], {}
        for body in batch.column(1).to_pylist():
            base = base_spans(body)
            counts.append([sum(s[0] == kind for s in base) for kind in KINDS])
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(all_spans(body, learned, base, known)))
        columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return id_and_text(docs, doc_id, text).mapInArrow(per_batch(make), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
