"""Personal data: patterns against literal ones, the field against enumeration."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from hazegrid.llm import pii

DOCS = "doc_id long, text string, spans string, kind int"


def literal(text):
    """The base as its definition reads, kind by kind."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((pii.EMAIL, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((pii.IP, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        total = sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append((pii.CARD, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((pii.PHONE, *m.span()))
    return out


@pytest.fixture(scope="module")
def examples(data):
    import pyarrow.parquet as pq
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    return sorted({(t, tuple(g)) for x in texts for t, g in pii.sure_places(x or "")})


@pytest.fixture(scope="module")
def field(examples):
    known = [(t, list(g)) for t, g in examples]
    return pii.fit(known + pii.recombined(known))


def spans_of(field, text):
    base, _ = pii.base_spans(text)
    return {(pii.KINDS[k], text[a:b]) for k, a, b in field.added(text, base)}


def test_patterns_equal_their_definition():
    rng = random.Random(1)
    parts = ["a", "b.", "@", "x@y.z", "1", "23", "255", "256", ".", "-", " ", "+", "(", ")", "é",
             "4417744280351547", "+1 (017) 555-7713", "1.2.3.4", "%", "\n", "_", "٣"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert sorted(pii.base_spans(text)[0]) == sorted(literal(text)), text


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "@a" * 100_000, "1 " * 100_000, "+1" * 50_000,
                 "1.2." * 50_000, "a@" + "b." * 100_000, "(at)" * 50_000):
        base, _ = pii.base_spans(text)
        assert pii.places(text, base) is not None


def test_best_path_and_likelihood_equal_enumeration():
    rng = np.random.default_rng(3)
    segments = [(4, i, i + 1) for i in range(5)] + [(0, 0, 2), (1, 1, 4), (2, 2, 3), (3, 2, 5), (0, 4, 5)]
    names = {str(i): i for i in range(len(segments))}
    lattice = pii.Lattice(5, segments, [[i] for i in range(len(segments))])
    weights, moves = rng.normal(size=len(segments)), rng.normal(size=(5, 5))

    def paths(at):
        if at == 5:
            yield ()
        for s in segments:
            if s[1] == at:
                for rest in paths(s[2]):
                    yield (s, *rest)

    def score(path):
        before, total = 4, 0.0
        for s in path:
            total += moves[before, s[0]] + weights[segments.index(s)]
            before = s[0]
        return total

    every = list(paths(0))
    best = max(every, key=score)
    field = pii.Field(names, weights, moves)
    assert field.best(lattice, caution=0.0) == [s for s in best if s[0] != 4]
    z = np.log(sum(np.exp(score(p)) for p in every))
    for path in every[:4]:
        gold = [s for s in path if s[0] != 4]
        known = pii.Lattices([lattice, lattice], [gold, gold])
        value, slope, by_move = pii.log_likelihood(known, weights, moves)
        assert np.isclose(value, 2 * (score(path) - z))
        for i in range(len(weights)):
            moved = weights.copy()
            moved[i] += 1e-6
            assert np.isclose((pii.log_likelihood(known, moved, moves)[0] - value) / 1e-6, slope[i],
                              atol=1e-4)
        for i, j in itertools.product(range(5), repeat=2):
            moved = moves.copy()
            moved[i, j] += 1e-6
            assert np.isclose((pii.log_likelihood(known, weights, moved)[0] - value) / 1e-6,
                              by_move[i, j], atol=1e-4)


def test_field_finds_what_patterns_give_up_on(field):
    assert spans_of(field, "x 4417744280351547 4845168114407329 y") == {
        ("card", "4417744280351547"), ("card", "4845168114407329")}
    assert spans_of(field, "des +1 (826) 555-4081 190.137.223.204 du") == {("phone", "+1 (826) 555-4081")}
    assert spans_of(field, "call (017) 555-7713 now") == {("phone", "(017) 555-7713")}
    assert spans_of(field, "to und.34 (at) mail7 (dot) example (dot) com ok") == {
        ("email", "und.34 (at) mail7 (dot) example (dot) com")}


def test_field_leaves_other_numbers_alone(field):
    for text in ("order 9807915762804490 of", "2021-03-04 12:30:45", "version 3.14.15.926",
                 "ISBN 978-3-16-148410-0", "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"",
                 "0.123456789", "tel 555-7713", "ids 12345678 and 87654321", "@handle (at) home",
                 "1 2 3 4 5 6 7 8 9 10 11 12 13 14"):
        assert spans_of(field, text) == set(), text


def test_held_out_places(examples):
    """Fitted on half of the sure places, the field alone finds the spans of the other half."""
    known = [(t, list(g)) for t, g in examples]
    field = pii.fit(known[::2] + pii.recombined(known[::2]))
    hits = misses = wrong = 0
    for text, gold in known[1::2]:
        pieces, spans = pii.candidates(text, 0, len(text))
        got = {(k, pieces[i][0], pieces[j - 1][1])
               for k, i, j in field.best(field.lattice(text, pieces, spans))} if spans else set()
        plain = {s for s in gold if s[0] != pii.EMAIL or spans}
        hits += len(got & plain)
        misses += len(plain - got)
        wrong += len(got - plain)
    assert hits > 20 and misses <= 0.05 * hits and wrong <= 0.05 * hits


def test_whole_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = pii.digest(pii.find(docs)).collect()
    assert len(got) == len(texts)
    for r in got:
        want = sorted(literal(texts[r["doc_id"]]))
        said = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in want]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == i for s in want) for i in range(4)]
        assert set(said) <= set(r["spans"].split(",")) | {""}


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "a@b.cd"), (None, "a@b.cd"), (2, "é 1.2.3.4 " + "x" * 300_000),
            (3, "4417744280351547 4845168114407329"), (4, "+1 (017) 555-7713")]
    df = spark.createDataFrame([(i, t, "own", 1) for i, t in rows], DOCS)
    got = pii.find(df)
    assert got.count() == len(rows)
    found = {r["doc_id"]: r["spans"] for r in pii.digest(got).collect()}
    assert found[None] == "email:0:6" and found[1] == "" and found[2].startswith("ip:2:9")
    assert found[4] == "phone:0:17"
    assert pii.find(df.filter("false")).count() == 0
    assert pii.digest(pii.find(df.filter("doc_id = 1"))).first()["spans"] == ""
