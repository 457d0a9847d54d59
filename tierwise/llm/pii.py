"""Personal data by plain patterns and a semi-Markov conditional random field.

Patterns find what they can see from its form alone (``base_spans``).  Where numbers stand side by
side, a greedy pattern runs over the border of two of them and is lost; forms without a fixed mark
have no pattern at all.  There the field decides: it scores whole candidate spans of a zone by
their features (digits, groups, marks, check digits, neighbours), and a dynamic programme over the
zone's tokens jointly chooses the borders and the kinds of its entities, each of ``MAX_TOKENS``
tokens at most.

The field's weights are trained on the driver, by stochastic gradient ascent on the conditional
likelihood (forward and backward sums over all segmentations) of ``TRAINING_LINES`` generated
lines with known spans.  The corpus plays no part in it, so that the model is the same for any
input; training takes a second or two.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import SLICE_ROWS, id_and_text, map_arrow, map_slices

Span = tuple[str, int, int]

KINDS = ("email", "ip", "card", "phone")
#: Tokens and characters of an entity, and of a stretch beside an @, at most.
MAX_TOKENS, MAX_CHARS = 16, 80
TRAINING_LINES, EPOCHS, SEED = 700, 12, 11

# The plain patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match never begins inside a run of digits, so it need not be tried there.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")

TRIGGER = re.compile("[0-9@]")
NUMBERS = re.compile(r"[+(]{0,2}[0-9](?:[\x20().\-/]{0,3}[0-9])*")
ADDRESS_AFTER = re.compile(rf"\x20?[A-Za-z0-9.-]{{1,{MAX_CHARS}}}")
ADDRESS_BEFORE = re.compile(r"[A-Za-z0-9._%+-]*\x20?$")
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|\s+|.", re.DOTALL)
CUT = re.compile("[./-][A-Za-z0-9]")
PHONE_GROUPS = frozenset([(3, 3, 4), (1, 3, 3, 4), (1, 3, 3, 2, 2), (3, 4, 4), (2, 4, 4), (4, 3, 3), (2, 2, 2, 2, 2)])


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """From each @ outwards: a search from every possible beginning takes the square of a long
    word's length."""
    done, at = 0, text.find("@")
    while at >= 0:
        match = DOMAIN.match(text, at + 1)
        start = at
        while match and start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            done = match.end()
            yield "email", start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Valid matches, leftmost and not overlapping within a kind, by kind and start; what fails its
    check is dropped whole."""
    if not TRIGGER.search(text):
        return []
    found = list(emails(text))
    for m in IP.finditer(text):
        parts = m[0].split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches that can hold an entity: runs of numbers with short gaps, and what is beside an @."""
    found = [m.span() for m in NUMBERS.finditer(text)]
    at = text.find("@")
    while at >= 0:
        low = max(0, at - MAX_CHARS)
        before, after = ADDRESS_BEFORE.search(text[low:at]), ADDRESS_AFTER.match(text, at + 1)
        if after:
            found.append((low + before.start(), after.end()))
        at = text.find("@", at + 1)
    found.sort()
    merged: list[tuple[int, int]] = []
    for start, end in found:
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


FEATURES = (
    "bias", "plus_first", "plus_inside", "paren", "paren_odd", "slash", "at", "at_many", "at_spaced", "domain", "domain_bad",
    "local_bad", "dots3", "octets", "octets_bad", "luhn", "luhn_bad", "digits<7", "digits7-8", "digits9-11", "digits12",
    "digits13-15", "digits16", "digits17-19", "digits>19", "one_group", "phone_groups", "four_groups", "other_groups",
    "mixed_marks", "dot_marks", "letters", "wide_gap", "touches_before", "touches_after", "mark_before", "cut_after", "ends_odd",
)
INDEX = {name: i for i, name in enumerate(FEATURES)}


def span_features(text: str, start: int, end: int) -> list[int]:
    """The features of one whole span; the same for every kind, which has its own weights for them."""
    span = text[start:end]
    groups = NOT_DIGIT.sub(" ", span).split()
    digits = "".join(groups)
    n, sizes = len(digits), tuple(map(len, groups))
    marks = set(span) & set(" .-/")
    on = {"bias"}
    on |= {"plus_first"} if span[0] == "+" else {"plus_inside"} if "+" in span else set()
    if "(" in span or ")" in span:
        on.add("paren" if span.count("(") == span.count(")") == 1 and span.find("(") < span.find(")") else "paren_odd")
    on |= {"slash"} if "/" in span else set()
    if "@" in span:
        local, _, domain = span.partition("@")
        on.add("at")
        on |= {"at_many"} if "@" in domain else set()
        on |= {"at_spaced"} if local.endswith(" ") or domain.startswith(" ") else set()
        on.add("domain" if re.fullmatch(r" ?[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", domain) else "domain_bad")
        on |= set() if re.fullmatch(r"[A-Za-z0-9._%+-]+ ?", local) else {"local_bad"}
    else:
        size = "<7" if n < 7 else "7-8" if n < 9 else "9-11" if n < 12 else "12" if n < 13 else "13-15" if n < 16 else "16" if n == 16 else "17-19" if n < 20 else ">19"
        on.add(f"digits{size}")
        on.add(
            "one_group" if len(groups) == 1 else "phone_groups" if sizes in PHONE_GROUPS
            else "four_groups" if set(sizes) == {4} else "other_groups"
        )
        if re.fullmatch(r"\d+\.\d+\.\d+\.\d+", span):
            on |= {"dots3", "octets" if all(len(g) <= 3 and int(g) <= 255 for g in groups) else "octets_bad"}
        if 13 <= n <= 19:
            on.add("luhn" if luhn(digits) else "luhn_bad")
        on |= {"mixed_marks"} if len(marks - {" "}) > 1 else set()
        on |= {"dot_marks"} if "." in marks else set()
        on |= {"letters"} if re.search("[A-Za-z]", span) else set()
        on |= {"wide_gap"} if re.search(r"[\s./-]{2}", span) else set()
    before, after = text[start - 1 : start], text[end : end + 1]
    on |= {"touches_before"} if before.isalnum() or before == "+" else set()
    on |= {"touches_after"} if after.isalnum() else set()
    on |= {"mark_before"} if before in ("-", ".", "/") and before else set()
    on |= {"cut_after"} if CUT.match(text, end) else set()
    on |= {"ends_odd"} if not span[-1].isalnum() else set()
    return [INDEX[f] for f in on]


class Lattice:
    """The candidate segments of one zone: (first token, token after the last), with features."""

    def __init__(self, text: str, zone: tuple[int, int]):
        cells = [m.span() for m in TOKEN.finditer(text, *zone)]
        self.n = len(cells)
        digit = [text[a].isdigit() and text[a].isascii() for a, _ in cells]
        sums = np.concatenate([[0], np.cumsum([b - a if d else 0 for (a, b), d in zip(cells, digit, strict=True)])])
        ats = np.concatenate([[0], np.cumsum([text[a] == "@" for a, _ in cells])])
        self.segments: list[tuple[int, int]] = []
        self.spans: list[tuple[int, int]] = []
        self.features: list[list[int]] = []
        for i, (start, _) in enumerate(cells):
            if not (text[start].isalnum() or text[start] in "+("):
                continue
            for j in range(i + 1, min(self.n, i + MAX_TOKENS) + 1):
                end = cells[j - 1][1]
                if not text[end - 1].isalnum() or end - start > MAX_CHARS:
                    continue
                if ats[j] > ats[i] or 7 <= sums[j] - sums[i] <= 19 or 6 <= j - i <= 7 and sums[j] - sums[i] >= 4:
                    self.segments.append((i, j))
                    self.spans.append((start, end))
                    self.features.append(span_features(text, start, end))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.array([weights[:, f].sum(axis=1) for f in self.features]).reshape(len(self.features), len(KINDS))

    def by_end(self) -> dict[int, list[int]]:
        found: dict[int, list[int]] = {}
        for k, (_, j) in enumerate(self.segments):
            found.setdefault(j, []).append(k)
        return found

    def best(self, weights: np.ndarray) -> list[Span]:
        """The segmentation of the highest score; a token outside entities scores nothing."""
        if not self.segments:
            return []
        scores = self.scores(weights)
        kind, top, by_end = scores.argmax(axis=1), scores.max(axis=1), self.by_end()
        value, choice = [0.0] * (self.n + 1), [-1] * (self.n + 1)
        for j in range(1, self.n + 1):
            value[j] = value[j - 1]
            for k in by_end.get(j, ()):
                if (v := value[self.segments[k][0]] + top[k]) > value[j]:
                    value[j], choice[j] = v, k
        found, j = [], self.n
        while j:
            k = choice[j]
            if k >= 0:
                found.append((KINDS[kind[k]], *self.spans[k]))
            j = self.segments[k][0] if k >= 0 else j - 1
        return found[::-1]

    def expected(self, weights: np.ndarray) -> np.ndarray:
        """The probability of each segment and kind, by forward and backward sums."""
        scores = self.scores(weights)
        total, by_end = np.logaddexp.reduce(scores, axis=1), self.by_end()
        forward, backward = [0.0] * (self.n + 1), [0.0] * (self.n + 1)
        for j in range(1, self.n + 1):
            forward[j] = forward[j - 1]
            for k in by_end.get(j, ()):
                forward[j] = np.logaddexp(forward[j], forward[self.segments[k][0]] + total[k])
        by_start: dict[int, list[int]] = {}
        for k, (i, _) in enumerate(self.segments):
            by_start.setdefault(i, []).append(k)
        for i in range(self.n - 1, -1, -1):
            backward[i] = backward[i + 1]
            for k in by_start.get(i, ()):
                backward[i] = np.logaddexp(backward[i], total[k] + backward[self.segments[k][1]])
        outside = np.array([forward[i] + backward[j] for i, j in self.segments]) - forward[self.n]
        return np.exp(scores + outside[:, None])


def training_line(rng: random.Random) -> tuple[str, list[Span]]:
    """A line of words, entities and numbers that are none, with the entities' spans."""

    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def word() -> str:
        return "".join(rng.choice("abcdefghilmnoprstuvw") for _ in range(rng.randint(2, 8)))

    def email() -> str:
        local = rng.choice([word(), f"{word()}.{word()}", f"{word()}{digits(2)}", digits(2), f"{word()}+{word()}", f"{word()}_{word()}"])
        host = rng.choice([word(), f"{word()}{digits(1)}.{word()}", f"{word()}-{word()}"])
        return local + rng.choice(["@", "@", "@", " @ "]) + f"{host}.{rng.choice(['com', 'org', 'net', 'de', 'io'])}"

    def ip() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    def card(valid: bool = True) -> str:
        body = rng.choice("3456") + digits(rng.choice([14, 14, 14, 12, 13]))
        check = next(c for c in "0123456789" if luhn(body + c))
        number = body + (check if valid else str((int(check) + rng.randint(1, 9)) % 10))
        mark = rng.choice(["", "", " ", "-"])
        return mark.join(number[i : i + 4] for i in range(0, len(number), 4)) if mark else number

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice(
            [f"+1 ({a}) {b}-{c}", f"+{digits(2)} {a} {b}{c}", f"+{digits(2)} {digits(2)} {c} {digits(4)}", f"({a}) {b}-{c}", f"{a}-{b}-{c}",
             f"{a}.{b}.{c}", f"+{digits(11)}", f"1-{a}-{b}-{c}", f"+1-{a}-{b}-{c}", f"+{digits(1)} ({a}) {b} {digits(2)} {digits(2)}"]
        )

    def other() -> str:
        return rng.choice(
            [f"20{digits(2)}-{digits(2)}-{digits(2)}", f"{digits(2)}.{digits(2)}.20{digits(2)}", digits(rng.randint(1, 6)), digits(rng.randint(7, 12)),
             digits(16), digits(rng.randint(20, 24)), f"{digits(1)}.{digits(1)}.{digits(2)}", f"{digits(3)}.{digits(2)}", f"{digits(2)}:{digits(2)}",
             f"{digits(1)},{digits(3)}", f"{word()}{digits(8)}", f"@{word()}", f"{word()} @ {word()}", card(valid=False), f"999.{digits(3)}.{digits(3)}.{digits(3)}",
             " ".join(digits(rng.randint(1, 3)) for _ in range(rng.randint(3, 9))), f"{digits(4)}/{digits(4)}/{digits(3)}", f"{digits(2)}-{digits(7)}"]
        )

    makers: dict[str, Callable[[], str]] = {"email": email, "ip": ip, "card": card, "phone": phone, "": other, "word": word}
    line, spans, previous = "", [], ""
    for _ in range(rng.randint(2, 6)):
        kind = rng.choice([*KINDS, "phone", "card", "", "", "", "word", "word", "word"])
        if kind == "" and previous in KINDS:
            kind = "word"  # else the border of an entity is not given by the line
        if kind == "email" and line:
            line += f"{word()} "
        text = makers[kind]()
        if kind in KINDS:
            spans.append((kind, len(line), len(line) + len(text)))
        line, previous = line + text + rng.choice([" ", " ", ", " if kind == "word" else " "]), kind
    return line, spans


@functools.cache
def trained(lines: int = TRAINING_LINES, epochs: int = EPOCHS, seed: int = SEED) -> np.ndarray:
    """The weights, (kind, feature); the same for the same parameters."""
    rng = random.Random(seed)
    examples = []
    for _ in range(lines):
        text, spans = training_line(rng)
        kind_of = {(a, b): KINDS.index(k) for k, a, b in spans}
        for zone in zones(text):
            lattice = Lattice(text, zone)
            if lattice.segments:
                gold = np.zeros((len(lattice.segments), len(KINDS)))
                for k, span in enumerate(lattice.spans):
                    if span in kind_of:
                        gold[k, kind_of[span]] = 1
                examples.append((lattice, gold))
    weights, squares = np.zeros((len(KINDS), len(FEATURES))), np.full((len(KINDS), len(FEATURES)), 1e-6)
    for _ in range(epochs):
        rng.shuffle(examples)
        for lattice, gold in examples:
            change = gold - lattice.expected(weights)
            gradient = -1e-4 * weights
            for delta, features in zip(change, lattice.features, strict=True):
                gradient[:, features] += delta[:, None]
            squares += gradient**2
            weights += 0.5 * gradient / np.sqrt(squares)
    return weights


def all_spans(text: str, weights: np.ndarray) -> list[tuple[str, int, int, bool]]:
    """Base spans and those that the field adds where no base span is; by kind and start."""
    base = base_spans(text)
    found = [(*span, True) for span in base]
    for zone in zones(text) if TRIGGER.search(text) else ():
        covered = [(a, b) for _, a, b in base if a < zone[1] and zone[0] < b]
        if any(a <= zone[0] and zone[1] <= b for a, b in covered):
            continue
        for kind, start, end in Lattice(text, zone).best(weights):
            if not any(a < end and start < b for a, b in covered):
                found.append((kind, start, end, False))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def find(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """(doc_id, spans) of each row's whole text, spans in code points, end exclusive.

    Base spans are kept as they are, overlaps between kinds too; added ones overlap nothing.  A null
    text is the empty one; repeated rows give repeated rows; other columns are not read.
    """
    model = trained() if weights is None else weights

    def handle(rows: dict[str, list]) -> dict[str, list]:
        spans = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in all_spans(t, model)] for t in rows["text"]]
        return {"doc_id": rows["doc_id"], "spans": spans}

    return map_slices(id_and_text(docs), lambda: handle, f"doc_id long, spans {SPANS}")


def digests(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
    )


def masked(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """``text`` with each span as its kind in brackets; spans that overlap are one, named by the first."""
    parts, done = [], 0
    merged: list[list] = []
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(end, merged[-1][2])
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        parts += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join(parts) + text[done:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` masked, all other columns as they are.

    ``length_col``, if given, gets the new number of code points.  Null texts stay null.
    """
    model, names = trained(), docs.columns
    at, length_at = names.index(text_col), names.index(length_col) if length_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                texts = [t if t is None else masked(t, all_spans(t, model)) for t in part.column(at).to_pylist()]
                columns = list(part.columns)
                columns[at] = pa.array(texts, type=part.schema.field(at).type)
                if length_at is not None:
                    lengths = [None if t is None else len(t) for t in texts]
                    columns[length_at] = pa.array(lengths, type=part.schema.field(length_at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return map_arrow(docs, run, docs.schema)
