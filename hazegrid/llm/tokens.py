"""Exact token counts; huge documents go through overlapping chunks that are spliced.

A huge document is cut into chunks that overlap. Each chunk is encoded with offsets, and
two neighbours are spliced where both put a token boundary at one and the same place that
is proven stable. Where the tokenizer's definition splits texts into words first, such places
follow from two neighbouring characters (white space, digits, a letter beside a sign), and an
overlap is widened up to the next of them before anything is encoded. For other tokenizers both
encodings must agree on a run of tokens; where they do not, that pair is encoded again with a
wider overlap, up to the whole of both chunks.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazegrid.llm.common import by_value, extended

#: Characters of a chunk and of the overlap of two chunks. Longer texts count as huge.
CHUNK, OVERLAP = 32_768, 256
#: Equal tokens needed on either side of a splice that no white space proves.
AGREEING = 16
#: Distinct pieces whose counts a worker remembers, and the longest of them.
_CACHED, _LONG = 1 << 20, 64

#: Fixed value: a split pattern whose matches hold no white space, as published with the
#: word-level vocabulary.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: White space that separates tokens for sure (a subset of what the tokenizer's \s matches).
_SPACE = " \n\t\r"
#: Letters and signs that normalisation maps to letters and signs, one by one.
_LETTER, _SIGN = "A-Za-z\u4e00-\u9fa5", r"!-&(-/:-@\[-`{-~\u3001-\u3003\u3008-\u3011\uff01-\uff06\uff08-\uff0f\uff1a-\uff20"
#: Places between two matches of ``WORD_SPLIT`` whatever lies around: beside white space and
#: digits, and between a letter and a sign. A letter may follow an apostrophe in one match.
_PLACE = re.compile(f"(?<=[{_SPACE}0-9])|(?=[{_SPACE}0-9])|(?<=[{_LETTER}])(?=[{_SIGN}'])"
                    f"|(?<=[{_SIGN}])(?=[{_LETTER}])")


def splits_at_space(definition: str) -> bool:
    """Whether a tokenizer's definition keeps every token inside one white-space-free piece.

    True where the text is first split into matches of ``WORD_SPLIT``, all else dropped, the
    normalisation looks at no more than white space and single characters or their
    combining marks, and no added token holds white space or takes any along.
    """
    d = json.loads(definition)
    pre, norm = d.get("pre_tokenizer") or {}, d.get("normalizer") or {}
    steps = pre.get("pretokenizers", [pre])
    first = steps[0] if steps else {}
    dropped = (first.get("type") == "Split" and first.get("behavior") == "Removed"
               and first.get("invert") is True
               and first.get("pattern", {}).get("Regex") == WORD_SPLIT)
    later = all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") for s in steps[1:])
    norms = norm.get("normalizers", [norm] if norm else [])
    plain = all(n.get("type") in ("NFC", "Lowercase") or
                (n.get("type") == "Replace" and n.get("pattern", {}).get("Regex") == r"\s+"
                 and n.get("content") == " ") for n in norms)
    added = all(not (a.get("lstrip") or a.get("rstrip") or a.get("single_word")
                     or any(c.isspace() for c in a["content"]))
                for a in d.get("added_tokens") or [])
    return dropped and later and plain and added


class Counter:
    """Token counts of one tokenizer, by the library."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.space = splits_at_space(definition)
        self.added = [a["content"] for a in json.loads(definition).get("added_tokens") or []]
        self.known: dict[str, int] = {}

    def encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def lengths(self, texts: list[str]) -> list[int]:
        """Token counts of texts, each encoded whole.

        Where white space is a proven boundary, pieces between white space are encoded once
        and remembered.
        """
        if not self.space:
            return [len(e.ids) for e in self.tokenizer.encode_batch_fast(
                texts, add_special_tokens=False)]
        known = self.known
        if len(known) > _CACHED:
            known.clear()
        pieces = [_pieces(t) for t in texts]
        new = list({p for ps in pieces for p in ps if p not in known})
        long = {}
        for i in range(0, len(new), 10_000):
            part = new[i:i + 10_000]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(
                    part, add_special_tokens=False), strict=True):
                (known if len(p) <= _LONG else long)[p] = len(e.ids)
        if not long:
            return [sum(map(known.__getitem__, ps)) for ps in pieces]
        return [sum(known[p] if p in known else long[p] for p in ps) for ps in pieces]

    def place(self, text: str, start: int) -> int:
        """The first proven boundary of a text's tokens at or after a place; else its end.

        No place inside a token that was added to the vocabulary counts.
        """
        while start < len(text):
            m = _PLACE.search(text, start)
            if not m:
                break
            p = m.start()
            inside = [i + len(c) for c in self.added for i in
                      [text.find(c, max(0, p - len(c) + 1), p + len(c) - 1)] if 0 <= i < p < i + len(c)]
            if p and not inside:
                return p
            start = max(inside, default=p + 1)
        return len(text)


def _pieces(text: str) -> list[str]:
    for c in _SPACE[1:]:
        text = text.replace(c, " ")
    return [p for p in text.split(" ") if p]


def chunk_starts(n: int, chunk: int, overlap: int) -> list[int]:
    """Starts of chunks over ``n`` characters; each chunk reaches ``overlap`` into the next."""
    return list(range(0, max(1, n - overlap), chunk))


def _boundaries(encoding, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Token starts and ends in the text, from character ``at`` on."""
    spans = np.array(encoding.offsets, np.int64).reshape(-1, 2) + at
    return spans[:, 0], spans[:, 1]


def splice(left, left_at: int, right, right_at: int) -> tuple[int, int] | None:
    """(tokens of ``left`` to keep, first token of ``right`` to keep), or None.

    Both must agree on a run of tokens; the one nearest the middle of the overlap wins, farthest
    from both cut ends.
    """
    (ls, le), (rs, re_) = _boundaries(left, left_at), _boundaries(right, right_at)
    end = int(le.max()) if len(le) else right_at
    middle = (right_at + end) / 2
    best = None
    pos = {(int(s), int(e)): j for j, (s, e) in enumerate(zip(rs, re_, strict=True))}
    run = 0
    runs = []
    for i in range(int(np.searchsorted(ls, right_at, "left")), len(ls)):
        j = pos.get((int(ls[i]), int(le[i])))
        ok = j is not None and left.ids[i] == right.ids[j]
        run = run + 1 if ok and (not run or j == runs[-1][1] + 1) else int(ok)
        if ok:
            runs.append((i, j))
        if run >= 2 * AGREEING:
            k = len(runs) - AGREEING
            found = runs[k]
            if best is None or abs(ls[found[0]] - middle) < abs(ls[best[0]] - middle):
                best = found
    return (best[0], best[1]) if best else None


def splice_at(place: int, left, left_at: int, right, right_at: int) -> tuple[int, int]:
    """(tokens of ``left`` to keep, first token of ``right`` to keep) at a proven boundary."""
    (_, ends), (starts, _) = _boundaries(left, left_at), _boundaries(right, right_at)
    return int(np.searchsorted(ends, place, "right")), int(np.searchsorted(starts, place, "left"))


def _count_words(counter: Counter, text: str, chunk: int, overlap: int) -> int:
    """``count_huge`` where boundaries are known from the text: each is looked for once, so no
    character is encoded more than twice and memory is a chunk, or a word if that is longer."""
    total, skip, at = 0, 0, 0
    place = counter.place(text, chunk)
    current = counter.encode([text[:place + overlap]])[0]
    while place < len(text):
        start = max(at + 1, place - overlap)
        following_place = counter.place(text, place + chunk)
        following = counter.encode([text[start:following_place + overlap]])[0]
        kept, first = splice_at(place, current, at, following, start)
        total += kept - skip
        skip, current, at, place = first, following, start, following_place
    return total + len(current.ids) - skip


def count_huge(counter: Counter, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one huge text, chunk by chunk.

    Memory is bounded by two chunks wherever a stable place is found in them.
    """
    if counter.space:
        return _count_words(counter, text, chunk, overlap)
    starts = chunk_starts(len(text), chunk, overlap)
    total, skip = 0, 0
    i, at = 0, starts[0]
    current = counter.encode([text[at:at + chunk + overlap]])[0]
    while i + 1 < len(starts):
        nxt, wide = starts[i + 1], overlap
        following = counter.encode([text[nxt:nxt + chunk + overlap]])[0]
        cut = splice(current, at, following, nxt)
        while cut is None and wide < chunk:
            # neither end is trusted: reach farther from both sides of the overlap
            wide = min(chunk, wide * 4)
            current_wide = counter.encode([text[at:nxt + wide + overlap]])[0]
            cut = splice(current_wide, at, following, nxt)
            current = current_wide
        if cut is None:
            # no stable place in a whole chunk: both chunks become one
            stop = starts[i + 2] + overlap if i + 2 < len(starts) else len(text)
            current = counter.encode([text[at:stop]])[0]
            i += 1
            continue
        total += cut[0] - skip
        skip, current, at, i = cut[1], following, nxt, i + 1
    return total + len(current.ids) - skip


def count_tokens(docs: DataFrame, definition_path: str, limit: int = 2048, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's whole text.

    A null text counts as empty. Repeated rows and null doc_ids are counted like others; an
    empty table gives an empty result; other columns are not read. The definition (a
    tokenizer.json) is read on the driver and sent to the executors; it is a vocabulary of
    fixed size.
    """
    spark: SparkSession = docs.sparkSession
    with open(definition_path, encoding="utf-8") as f:
        definition = f.read()
    # a worker keeps a broadcast's value from task to task, so what it has counted stays known
    shared = spark.sparkContext.broadcast({"definition": definition})

    def make():
        counter = shared.value.get("counter")
        if counter is None:
            counter = shared.value["counter"] = Counter(shared.value["definition"])

        def count(texts: list) -> tuple:
            small = [t for t in texts if len(t) <= chunk + overlap]
            lengths = iter(counter.lengths(small))
            return ([next(lengths) if len(t) <= chunk + overlap
                     else count_huge(counter, t, chunk, overlap) for t in texts],)

        return count

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    out = extended(rows, ["text"], {"n_tokens": "long"}, make)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


by_value(__name__)
