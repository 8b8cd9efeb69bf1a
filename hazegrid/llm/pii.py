"""Personal data: patterns give a sure base, a semi-Markov random field adds what they miss.

The patterns match left to right and give up on what they took too much of: two card numbers
in a row, a phone number with an address after it. Around what they leave, every plausible
span is scored as a whole (digits, groups, check digit, separators, neighbours) and dynamic
programming chooses the best sequence of segments, boundaries and types together. A segment
has at most ``PIECES`` pieces, so the work is linear in the text. The field is fitted here,
on a bounded sample of places where the patterns are sure, and on recombinations of them.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.common import by_value, extended

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)
#: Most pieces (runs of digits or letters, single other characters) of one segment.
PIECES = 24
#: Characters of context around a place that may hold a span.
CONTEXT = 24
#: Bounds of the fit: documents looked at (about), places taken, recombined examples.
SAMPLE_DOCS, SAMPLE_PLACES, RECOMBINED = 20_000, 2_000, 1_500
#: Log-odds an added span must have over none.
CAUTION = 1.0

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_PIECE = re.compile(r"[0-9]+|[^\W\d_]+|.", re.DOTALL)
#: Digits that stand close together.
_NUMBER = re.compile(r"[0-9](?:[ ().+-]{0,3}[0-9])*+")
_AT = re.compile(r" ?(?:@|[(\[] ?at ?[)\]]) ?", re.IGNORECASE)
_DOMAIN_LIKE = re.compile(r"[A-Za-z0-9-]{1,63}+(?:(?:\.| ?[(\[] ?dot ?[)\]] ?)[A-Za-z0-9-]{1,63}+)+",
                          re.IGNORECASE)
_LABEL = re.compile(r"\.| ?[(\[] ?dot ?[)\]] ?", re.IGNORECASE)

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit of a digit string fits."""
    values = [int(c) for c in reversed(digits)]
    doubled = (2 * v - 9 * (v > 4) for v in values[1::2])
    return (sum(values[0::2]) + sum(doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[Span]:
    # a local part ends at its sign and cannot hold one, so each stretch is looked at once
    floor, at = 0, text.find("@")
    while at >= 0:
        ahead = text[floor:at]
        size = len(ahead) - len(ahead.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if size else None
        if domain:
            yield EMAIL, at - size, domain.end()
        floor = domain.end() if domain else at + 1
        at = text.find("@", max(floor, at + 1))


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans (kind, start, end) of the patterns, and matches given up as too long."""
    spans, overlong = list(_emails(text)), []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                spans.append((IP, *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _digits(m.group())
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append((CARD, *m.span()))
                elif len(digits) > 19:
                    overlong.append((CARD, *m.span()))
        for m in _PHONE.finditer(text):
            n = len(_DIGIT.findall(m.group()))
            if 8 <= n <= 15:
                spans.append((PHONE, *m.span()))
            elif n > 15:
                overlong.append((PHONE, *m.span()))
    return spans, overlong


def places(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Stretches outside the taken spans that may hold further ones, with context."""
    blocked = sorted((a, b) for _, a, b in taken)
    ends = np.maximum.accumulate([b for _, b in blocked]).tolist() if blocked else []
    starts = [a for a, _ in blocked]

    def free(a: int, b: int) -> tuple[int, int]:
        """The free part of a stretch around its seed, [a - CONTEXT, b + CONTEXT)."""
        i = bisect_right(starts, a)
        low = ends[i - 1] if i else 0
        high = starts[i] if i < len(starts) else len(text)
        return max(low, a - CONTEXT), min(high, b + CONTEXT)

    seeds = []
    for m in _NUMBER.finditer(text) if _DIGIT.search(text) else ():
        if m.end() - m.start() < 7:
            continue
        a = m.start()
        # what lies between taken spans is a seed of its own
        for i in range(bisect_right(ends, a), len(blocked) + 1):
            b = min(m.end(), starts[i]) if i < len(blocked) else m.end()
            if b - a >= 7 and len(_DIGIT.findall(text, a, b)) >= 7:
                seeds.append(free(a, b))
            if i == len(blocked) or ends[i] >= m.end():
                break
            a = max(a, ends[i])
    if "@" in text or "(" in text or "[" in text:
        for m in _AT.finditer(text):
            i = bisect_right(starts, m.start())
            if not i or ends[i - 1] < m.end():
                low, high = free(m.start(), m.end())
                left = max(low, m.start() - 64)
                seeds.append((max(ends[i - 1] if i else 0, left), min(
                    starts[i] if i < len(starts) else len(text), m.end() + 255)))
    out = []
    for a, b in sorted(seeds):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _numbers_from(pieces: list[tuple[int, int]], text: str, i: int) -> Iterator[tuple[int, int]]:
    """(kind, last piece) of the plausible numbers that start at piece ``i``."""
    head = text[pieces[i][0]]
    digits, groups, signs, dots, longest = 0, 0, set(), 0, 0
    for j in range(i, min(i + PIECES, len(pieces))):
        a, b = pieces[j]
        c = text[a]
        if "0" <= c <= "9":
            digits, groups, longest = digits + b - a, groups + 1, max(longest, b - a)
            if digits > 19 or groups > 8:
                return
            if groups == 4 and dots == 3 and signs == {"."} and longest <= 3:
                yield IP, j
            if 16 <= digits and signs <= {" ", "-"} and head != "+":
                yield CARD, j
            if 7 <= digits <= 15 and ("(" in signs) == (")" in signs):
                yield PHONE, j
        elif c in " ().-" or (c == "+" and j == i):
            if c != "+":
                signs.add(c)
                dots += c == "."
        else:
            return


def candidates(text: str, low: int, high: int) -> tuple[list[tuple[int, int]], list[Span]]:
    """Pieces of a stretch, and candidate segments (kind, first piece, last piece)."""
    pieces = [m.span() for m in _PIECE.finditer(text, low, high)]
    out = []
    for i, (a, _) in enumerate(pieces):
        c = text[a]
        if "0" <= c <= "9" or c in "+(":
            out += [(kind, i, j) for kind, j in _numbers_from(pieces, text, i)]
    starts = {a: i for i, (a, _) in enumerate(pieces)}
    ends = {b: i for i, (_, b) in enumerate(pieces)}
    for m in _AT.finditer(text, low, high):
        domain = _DOMAIN_LIKE.match(text, m.end(), high)
        ahead = text[low:m.start()]
        size = len(ahead) - len(ahead.rstrip(_LOCAL))
        if not domain or not size:
            continue
        # a domain may end after each label from the second on
        stops = [x.start() for x in _LABEL.finditer(text, m.end(), domain.end())][1:]
        firsts = [starts[a] for a in range(m.start() - size, m.start()) if a in starts
                  and text[a].isalnum()]
        for last in [ends[b] for b in (*stops, domain.end()) if b in ends]:
            out += [(EMAIL, i, last) for i in firsts if last - i < PIECES]
    return pieces, out


def _class(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "none"
    c = text[at]
    if "0" <= c <= "9":
        return "digit"
    return "letter" if c.isalpha() else "space" if c.isspace() else c if ord(c) < 128 else "sign"


def span_features(text: str, kind: int, a: int, b: int) -> list[str]:
    """What is true of a span as a whole."""
    s, digits = text[a:b], _digits(text[a:b])
    n = len(digits)
    groups = [len(g) for g in re.findall(r"[0-9]+", s)]
    out = ["any", f"n{min(n, 20)}", f"left {_class(text, a - 1)}", f"right {_class(text, b)}",
           f"right2 {_class(text, b)} {_class(text, b + 1)}",
           f"left2 {_class(text, a - 2)} {_class(text, a - 1)}", f"first {_class(text, a)}"]
    if kind == EMAIL:
        local, _, domain = s.rpartition("@")
        out += ["sign" if local else "written", f"labels {min(s.count('.'), 4)}",
                f"spaces {min(s.count(' '), 2)}", f"end {min(len(_LABEL.split(domain)[-1]), 5)}"]
        return [f"{KINDS[kind]} {x}" for x in out]
    out += [f"groups {'-'.join(map(str, groups[:6]))}",
            f"signs {''.join(sorted(set(re.sub('[0-9]', '', s))))}"]
    if kind == CARD:
        out.append(f"check {luhn(digits)}")
        out.append(f"check {luhn(digits)} {n}")
    if kind == IP:
        out.append(f"parts {all(int(g) <= 255 for g in s.split('.'))}")
    if kind == PHONE:
        out.append(f"plus {s[0] == '+'} {'(' in s} {n}")
        out.append(f"check {n > 12 and luhn(digits)}")
    return [f"{KINDS[kind]} {x}" for x in out]


def piece_features(text: str, a: int, b: int) -> list[str]:
    """What is true of a piece that belongs to no span."""
    kind = _class(text, a)
    return [f"out {kind}", f"out {kind} {min(b - a, 20) if kind == 'digit' else ''}"]


@dataclass
class Lattice:
    """A stretch as a graph: segments (type, from, to) with feature numbers."""

    size: int
    segments: list[Span]
    features: list[list[int]]


class Field:
    """Semi-Markov conditional random field over the types and ``OUT``."""

    OUT = len(KINDS)

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.names, self.weights, self.moves = names, weights, moves

    def lattice(self, text: str, pieces: list, spans: list[Span]) -> Lattice:
        known = self.names
        segments = [(self.OUT, i, i + 1) for i in range(len(pieces))]
        named = [piece_features(text, a, b) for a, b in pieces]
        for kind, i, j in spans:
            segments.append((kind, i, j + 1))
            named.append(span_features(text, kind, pieces[i][0], pieces[j][1]))
        return Lattice(len(pieces), segments,
                       [[known[x] for x in f if x in known] for f in named])

    def best(self, lattice: Lattice, caution: float = CAUTION) -> list[Span]:
        """The segments of types in the best path, by dynamic programming over positions."""
        states = self.OUT + 1
        w = self.weights
        ending = [[] for _ in range(lattice.size + 1)]
        for (kind, i, j), f in zip(lattice.segments, lattice.features, strict=True):
            ending[j].append((kind, i, float(w[f].sum()) - (caution if kind < self.OUT else 0.0)))
        moves = self.moves.tolist()
        # the path starts as if something outside had gone ahead
        score = [[-np.inf] * states for _ in range(lattice.size + 1)]
        score[0][self.OUT] = 0.0
        back = [[None] * states for _ in range(lattice.size + 1)]
        for j in range(1, lattice.size + 1):
            for kind, i, s in ending[j]:
                for before in range(states):
                    x = score[i][before] + moves[before][kind] + s
                    if x > score[j][kind]:
                        score[j][kind], back[j][kind] = x, (i, before)
        out = []
        j, kind = lattice.size, max(range(states), key=lambda k: score[lattice.size][k])
        while j:
            i, before = back[j][kind]
            if kind < self.OUT:
                out.append((kind, i, j))
            j, kind = i, before
        return out[::-1]

    def added(self, text: str, taken: list[Span]) -> list[Span]:
        """Spans of the field outside the taken ones."""
        out = []
        for low, high in places(text, taken):
            pieces, spans = candidates(text, low, high)
            if spans:
                for kind, i, j in self.best(self.lattice(text, pieces, spans)):
                    out.append((kind, pieces[i][0], pieces[j - 1][1]))
        return out


class Lattices:
    """Many lattices with their gold segments, as arrays; they advance together."""

    def __init__(self, lattices: list[Lattice], gold: list[list[Span]]):
        self.size = np.array([x.size for x in lattices])
        rows = [(w, *s) for w, x in enumerate(lattices) for s in x.segments]
        self.which, self.kind, self.start, self.stop = np.array(rows).T
        counts = [len(f) for x in lattices for f in x.features]
        self.feature = np.array([i for x in lattices for f in x.features for i in f], np.int64)
        self.owner = np.repeat(np.arange(len(rows)), counts)
        top = range(int(self.size.max()) + 1)
        self.by_stop = [np.flatnonzero(self.stop == j) for j in top]
        self.by_start = [np.flatnonzero(self.start == j) for j in top]
        self.chosen = np.zeros(len(rows))
        self.moved = np.zeros((len(KINDS) + 1, len(KINDS) + 1))
        at = {row: i for i, row in enumerate(rows)}
        for w, spans in enumerate(gold):
            j, before = 0, Field.OUT
            inside = {i: (k, i, e) for k, i, e in spans}
            while j < lattices[w].size:
                k, i, e = inside.get(j, (Field.OUT, j, j + 1))
                self.chosen[at[w, k, i, e]] = 1.0
                self.moved[before, k] += 1
                before, j = k, e


def log_likelihood(x: Lattices, weights: np.ndarray, moves: np.ndarray
                   ) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of the gold segments and its derivative by weights and moves."""
    n, top, types = len(x.size), len(x.by_stop) - 1, len(moves)
    score = np.bincount(x.owner, weights[x.feature], len(x.kind))
    forward = np.full((n, top + 1, types), -np.inf)
    forward[:, 0, Field.OUT] = 0.0
    for j in range(1, top + 1):
        s = x.by_stop[j]
        into = _log_sum(forward[x.which[s], x.start[s]] + moves[:, x.kind[s]].T) + score[s]
        np.logaddexp.at(forward[:, j], (x.which[s], x.kind[s]), into)
    each = np.arange(n)
    total = _log_sum(forward[each, x.size])
    backward = np.full((n, top + 1, types), -np.inf)
    backward[each, x.size] = 0.0
    step = np.zeros((len(x.kind), types))
    for j in range(top - 1, -1, -1):
        s = x.by_start[j]
        w = x.which[s]
        after = (score[s] + backward[w, x.stop[s], x.kind[s]])[:, None] + moves[:, x.kind[s]].T
        step[s] = np.exp(forward[w, x.start[s]] + after - total[w, None])
        np.logaddexp.at(backward[:, j], w, after)
    value = float((x.chosen * score).sum() + (x.moved * moves).sum() - total.sum())
    expected = np.stack([step[x.kind == k].sum(axis=0) for k in range(types)], axis=1)
    rest = (x.chosen - step.sum(axis=1))[x.owner]
    return value, np.bincount(x.feature, rest, len(weights)), x.moved - expected


def _log_sum(x: np.ndarray) -> np.ndarray:
    m = x.max(axis=1, keepdims=True)
    m = np.where(np.isfinite(m), m, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - m).sum(axis=1)) + m[:, 0]


def fit(examples: list[tuple[str, list[Span]]], rounds: int = 80, penalty: float = 0.5,
        least: int = 2) -> Field:
    """A field fitted to texts with their spans by regularised likelihood."""
    prepared, seen = [], Counter()
    for text, gold in examples:
        pieces, spans = candidates(text, 0, len(text))
        starts = {a: i for i, (a, _) in enumerate(pieces)}
        ends = {b: i for i, (_, b) in enumerate(pieces)}
        wanted = [(k, starts.get(a, -1), ends.get(b, -1)) for k, a, b in gold]
        if pieces and spans and len(pieces) <= 200 and set(wanted) <= set(spans):
            prepared.append((text, pieces, spans, [(k, i, j + 1) for k, i, j in wanted]))
            for k, i, j in spans:
                seen.update(span_features(text, k, pieces[i][0], pieces[j][1]))
            for a, b in pieces:
                seen.update(piece_features(text, a, b))
    names = {x: i for i, x in enumerate(sorted(x for x, c in seen.items() if c >= least))}
    types = len(KINDS) + 1
    field = Field(names, np.zeros(len(names)), np.zeros((types, types)))
    if not any(g for *_, g in prepared):
        # nothing to learn from: no span is ever better than none
        field.moves[:, :Field.OUT] = -np.inf
        return field
    lattices = [field.lattice(text, pieces, spans) for text, pieces, spans, _ in prepared]
    known = Lattices(lattices, [g for *_, g in prepared])
    theta = np.zeros(len(names) + types * types)
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        w, moves = theta[:len(names)], theta[len(names):].reshape(types, types)
        _, dw, dm = log_likelihood(known, w, moves)
        slope = np.r_[dw, dm.ravel()] - penalty * theta
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope * slope
        theta = theta + 0.2 * (mean / (1 - 0.9 ** t)) / (
            np.sqrt(spread / (1 - 0.99 ** t)) + 1e-8)
    field.weights, field.moves = theta[:len(names)], theta[len(names):].reshape(types, types)
    return field


def sure_places(text: str) -> list[tuple[str, list[Span]]]:
    """Stretches whose spans the patterns know for sure, with those spans.

    Each lies around a pattern's span or a number that is none; stretches that touch a match
    given up as too long are left out, as nobody knows what it holds.
    """
    spans, overlong = base_spans(text)
    seeds = [(a, b) for _, a, b in spans] + [
        m.span() for m in _NUMBER.finditer(text) if len(_digits(m.group())) >= 7]
    out, until = [], -1
    for a, b in sorted(set(seeds)):
        low, high = max(0, a - CONTEXT), min(len(text), b + CONTEXT)
        cut = any(x < low < y or x < high < y for _, x, y in spans)
        vague = any(x < high and low < y for _, x, y in overlong)
        inside = sorted((s for s in spans if low <= s[1] and s[2] <= high), key=lambda s: s[1])
        apart = all(p[2] <= q[1] for p, q in zip(inside, inside[1:], strict=False))
        if low > until and not cut and not vague and apart:
            out.append((text[low:high], [(k, x - low, y - low) for k, x, y in inside]))
            until = high
    return out


def recombined(examples: list[tuple[str, list[Span]]], n: int = RECOMBINED, seed: int = 5
               ) -> list[tuple[str, list[Span]]]:
    """Neighbouring spans, other spellings and near misses, made from sure examples."""
    rng = random.Random(seed)
    words = [w for text, _ in examples for w in re.findall(r"[^\W\d_]{2,}", text)] or ["and"]
    by_kind = [[text[a:b] for text, spans in examples for k, a, b in spans if k == kind]
               for kind in range(len(KINDS))]
    kinds = [k for k in range(len(KINDS)) if by_kind[k]]

    def entity() -> tuple[int | None, str]:
        k = rng.choice(kinds)
        s = rng.choice(by_kind[k])
        r = rng.random()
        if k == PHONE and r < 0.25:
            bare = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", s)
            return (k, bare) if len(_digits(bare)) >= 9 and "(" in bare else (k, s)
        if k == EMAIL and r < 0.25:
            local, _, domain = s.partition("@")
            at, dot = rng.choice([(" (at) ", "."), (" [at] ", " [dot] "), ("(at)", "(dot)"),
                                  (" @ ", ".")])
            return k, local + at + domain.replace(".", dot)
        if k == CARD and r < 0.4:
            digits = _digits(s)
            if r < 0.2:
                return k, rng.choice(" -").join(digits[i:i + 4] for i in range(0, len(digits), 4))
            i = rng.randrange(len(digits))
            return None, digits[:i] + str((int(digits[i]) + rng.randint(1, 9)) % 10) + digits[i + 1:]
        if k == IP and r < 0.25:
            parts = s.split(".")
            parts[rng.randrange(4)] = str(rng.randint(256, 999))
            return None, ".".join(parts)
        return k, s

    def other() -> tuple[None, str]:
        d, t = rng.randint(1, 28), rng.randint(0, 59)
        return None, rng.choice([
            f"20{d:02}-{rng.randint(1, 12):02}-{d:02}",
            f"20{d:02}-0{rng.randint(1, 9)}-{d:02} 1{t % 10}:{t:02}",
            f"{rng.randint(0, 10 ** 9):010}", f"{rng.randint(1, 99)}.{t}.{d}", f"{rng.random():.9f}",
            f"{rng.randint(1, 999)},{t:03},{d:03}", f"{rng.getrandbits(160):040x}",
            f"97{rng.choice('89')}-{rng.randint(0, 9)}-{d}-{rng.randint(10 ** 5, 10 ** 6)}-{t % 10}",
            " ".join(str(rng.randint(0, 9999)) for _ in range(rng.randint(3, 7)))])

    out = []
    for _ in range(n if kinds else 0):
        text, spans = f"{rng.choice(words)} ", []
        for _ in range(rng.choice([1, 2, 2, 2, 3])):
            k, s = entity() if rng.random() < 0.75 else other()
            if k is not None:
                spans.append((k, len(text), len(text) + len(s)))
            text += s + rng.choice([" ", " ", ", ", "; ", " / ", f" {rng.choice(words)} ", ".\n"])
        out.append((text + rng.choice(words), spans))
    return out


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_places: int = SAMPLE_PLACES
          ) -> Field:
    """The field of a corpus, from a sample by hash: about ``sample_docs`` documents and at
    most ``sample_places`` places of them, whatever the size of the corpus."""
    rows = docs.select("doc_id", "text").filter("text is not null")
    n = rows.count()
    h = F.xxhash64("doc_id", "text")
    share = min(1.0, sample_docs / max(n, 1))
    some = rows.filter(h <= F.lit(int((share - 0.5) * 2 * ((1 << 63) - 1025)))) if share < 1 else rows

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for x in batch.column("text"):
                for text, gold in sure_places(x.as_py()):
                    texts.append(text)
                    spans.append([v for s in gold for v in s])
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.int64()))], ["text", "spans"])

    found = some.select("text").mapInArrow(look, "text string, spans array<long>")
    # places with spans first, then by hash
    rows = found.distinct().orderBy(F.size("spans") == 0, F.xxhash64("text", "spans")).limit(
        sample_places).collect()
    examples = [(r["text"], [tuple(r["spans"][i:i + 3]) for i in range(0, len(r["spans"]), 3)])
                for r in rows]
    return fit(examples + recombined(examples))


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """(doc_id, spans) of every row's whole text, spans by kind, then start.

    A span is (kind, start, end, base): code points, the end exclusive; ``base`` marks those of
    the patterns, the others are added by the field and overlap none of them. A null or empty
    text has no spans. Repeated rows and null doc_ids are treated like others, an empty table
    gives an empty result, and other columns are not read. A corpus without any span of the
    patterns gives a field that adds nothing.
    """
    field = docs.sparkSession.sparkContext.broadcast(field or train(docs))

    def make():
        def spans(texts: list) -> tuple:
            out = []
            for text in texts:
                base, _ = base_spans(text)
                added = field.value.added(text, base) if text else []
                every = sorted([(*s, 1) for s in base] + [(*s, 0) for s in added])
                out.append([v for s in every for v in s])
            return (out,)

        return spans

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    flat = extended(rows, ["text"], {"flat": "array<long>"}, make)
    names = F.array(*[F.lit(k) for k in KINDS])
    at = F.filter(F.sequence(F.lit(0), F.size("flat")), lambda i: (i % 4 == 0) & (i < F.size("flat")))
    return flat.select("doc_id", F.transform(at, lambda i: F.struct(
        F.get(names, F.get("flat", i).cast("int")).alias("kind"), F.get("flat", i + 1).alias("start"),
        F.get("flat", i + 2).alias("end"), (F.get("flat", i + 3) == 1).alias("base"))).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _differs(kind: str):
    return lambda x: x != kind


def digest(found: DataFrame) -> DataFrame:
    """Counts and checksum of the patterns' spans, and all spans as one string."""
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(base) - F.size(F.filter(kinds, _differs(k)))).cast("long").alias(f"n_{k}")
              for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


by_value(__name__)
