"""Operators on documents against plain Python on small fixtures."""

import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazegrid.llm import common, mixing, neardup, packing, quality, rules, sharding, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows; a column with a clashing name."""
    long = " ".join(f"word{i % 997} und{i % 31}" for i in range(12_000))
    near = " ".join(f"copy{i}" for i in range(300))
    return [
        (None, "text without an id", "en", "a", 5, "x"), (1, None, None, None, None, None),
        (2, "", "en", "a", 0, "x"), (3, "  \n\t ", "en", "a", 5, "x"), (4, long, "en", "a", len(long), "x"),
        (5, "one", "en", "b", 3, "x"), (6, "One", "en", "b", 3, "x"), (7, near, "de", "b", 9, "x"),
        (8, near.upper(), "de", "b", 9, "x"), (9, near + " more words", "de", None, 9, "x"),
        (9, near + " more words", "de", None, 9, "x"), (10, "a b c a b c a b c " * 9, "en", "c", 1, "x"),
        (11, "line one\nline one\n\nline two\n \nline one", "en", "c", 1, "x"),
        (12, "a|b # $5 100% <x> & *", "en", "c", 1, "x"), (13, "ünï cödé     text", "fr", "c", 1, "x")]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_rows(), SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark, data):
    return spark.read.parquet(f"{data}/labels.parquet")


@pytest.fixture(scope="module")
def many(spark):
    """Enough labelled documents to learn from."""
    folder = "/root/testdata/sf0.1"
    return [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")]


def none(spark):
    return spark.createDataFrame([], SCHEMA)


# near duplicates

def shingles(text, n):
    words = (text or "").encode().lower().split()
    k = min(n, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def linked(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_components_match_all_pairs(docs, size):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = linked(rows, size, 80)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in neardup.duplicate_components(docs, size).collect()}
    assert got == want


def test_components_of_odd_rows(odd, spark):
    out = neardup.duplicate_components(odd, 2).collect()
    assert len(out) == len(odd_rows())
    got = {r["doc_id"]: r for r in out}
    assert [got[i]["component_id"] for i in (1, 2, 3, 5, 6, 7, 8, 9)] == [1, 2, 3, 5, 5, 7, 7, 7]
    assert got[1]["n_shingles"] == got[2]["n_shingles"] == got[3]["n_shingles"] == 0
    assert got[5]["n_shingles"] == 1 and got[None]["kept"] and not got[6]["kept"]
    assert neardup.duplicate_components(none(spark), 2).count() == 0
    ids = sorted(r["doc_id"] or 0 for r in neardup.without_duplicates(odd, 2).collect())
    assert ids == [0, 1, 2, 3, 4, 5, 7, 10, 11, 12, 13]


def test_whole_sets_are_made_where_their_node_is_known(spark):
    """No join above the making of sets, whose bytes exceed the texts'; ids with several rows keep theirs."""
    docs = common.written(spark.createDataFrame(
        [(1, "a b c d"), (2, "A b c e"), (3, "x y"), (3, "y z w"), (3, "y z w"), (None, "a b c d"), (4, "")],
        "doc_id long, text string"), "docs")
    known = docs.filter("doc_id is not null and text <> ''").distinct()
    held = common.written(neardup.shingle_sets(known, 2).select(
        "doc_id", "set_hi", "set_lo", F.xxhash64("set_hi", "set_lo").alias("node")), "held")
    several = spark.createDataFrame([(3,)], "doc_id long")
    got = neardup._held_sets(docs, held, several, 2).collect()
    want = neardup.shingle_sets(known, 2).select(F.xxhash64("set_hi", "set_lo").alias("node"), "shingles")
    assert sorted((r[0], sorted(r[1])) for r in got) == sorted((r[0], sorted(r[1])) for r in want.collect())
    assert len(got) == 4
    plan = neardup._held_sets(docs, held, None, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and plan.index("MapInArrow") < plan.index("Join")


@pytest.mark.parametrize("most", [1 << 28, 1 << 15])
def test_sieved_rows_are_those_a_join_may_want(spark, monkeypatch, most):
    """Every wanted row is inside, also where the map is too small; rows without a key are nowhere."""
    monkeypatch.setattr(common, "_MOST_BITS", most)
    rows = spark.range(20_000).selectExpr("if(id = 7, null, id - 10000) as id", "id as x")
    keys = spark.range(0, 20_000, 5).selectExpr("id - 10000 as k").unionByName(
        spark.createDataFrame([(None,)], "k long"))
    inside = {r["id"] for r in common.sieved(rows, "id", keys).collect()}
    outside = {r["id"] for r in common.sieved(rows, "id", keys, inside=False).collect()}
    assert set(range(-10_000, 10_000, 5)) <= inside and not inside & outside
    assert inside | outside == set(range(-10_000, 10_000)) - {-9_993}
    assert len(outside) > (14_000 if most > 1 << 20 else 10_000)
    assert common.sieved(rows, "id", keys.filter("k > 1000000")).isEmpty()


def test_rows_of_kept_documents_are_not_shuffled(spark):
    """Only rows that the sieve cannot tell from left-out documents meet a join; sets go by their roles."""
    near = " ".join(f"copy{i}" for i in range(300))
    docs = common.written(spark.createDataFrame(
        [(i, f"text {i} about thing{i} and thing{i + 1} only") for i in range(50)] +
        [(i, f"{near} end{i}") for i in range(50, 60)] + [(None, near)], "doc_id long, text string"), "docs")
    out = neardup.without_duplicates(docs, 2)
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in out.collect()) == [-1, *range(51)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "LeftAnti" in plan
    pairs = spark.createDataFrame([(2, 1), (3, 1), (3, 2)], "a long, b long")
    roles = {r["node"]: (sorted(x["b"] for x in r["pivots"] or []), r["copies"])
             for r in neardup._roles(pairs).collect()}
    assert roles == {1: ([], 1), 2: ([1], 1), 3: ([1, 2], None)}


def test_chain_of_near_copies_inside_one_bucket(spark):
    """Ends of a chain are unlike each other but linked through its middle."""
    base = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(f"v{j}" if j < 9 * k else base[j] for j in range(400))) for k in range(40)]
    rows += [(100 + k, " ".join(base[:220] + [f"z{k}-{j}" for j in range(180)])) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in neardup.duplicate_components(df, 2).collect()}
    assert got == linked(rows, 2, 80)


def test_packed_bits_estimate_similarity(spark):
    words = neardup._Words()
    a, b = neardup._multipliers()
    sets = [neardup.shingle_hashes(" ".join(f"x{i}" for i in range(k, k + 600)), 1, words)
            for k in (0, 60, 200, 5000)]
    rows = [(neardup.packed_bits(neardup.minima(s, a, b)).tolist(),) for s in sets]
    df = spark.createDataFrame([(rows[0][0], r[0]) for r in rows], "p array<long>, q array<long>")
    est = [r[0] for r in df.select(neardup.estimated_similarity(F.col("p"), F.col("q"))).collect()]
    for e, overlap in zip(est, (600, 540, 400, 0), strict=True):
        assert abs(e - overlap / (1200 - overlap)) < 0.12


# weak supervision

def plain_stats(text):
    text = text or ""
    w = WORDS.findall(text)
    threes = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if threes[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)),
            "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def test_rule_counts(docs, odd):
    for df in (docs, odd):
        want = defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            want[r["doc_id"]].append(plain_stats(r["text"]))
        for r in rules.weak_quality(df).collect():
            s = want[r["doc_id"]][0]
            assert {k: r[k] for k in s} == s, r["doc_id"]
            failed = s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]
            assert r["base_failed"] == failed and not (failed and r["kept"])


def test_posteriors_match_the_model(docs, spark):
    out = rules.weak_quality(docs).collect()
    model = rules.fit(Counter(r["votes"] for r in out), len(rules.rules()))
    assert all(math.isclose(r["p_quality"], rules.posterior(model, r["votes"]), rel_tol=1e-9)
               for r in out)
    assert rules.weak_quality(none(spark)).count() == 0


def test_repetitive_texts_of_any_length_are_rejected(spark):
    """The vote on distinct words does not depend on which side of a page a text ends."""
    place = [r.name for r in rules.rules()].index("n_distinct")
    rows = [(n, " ".join(f"w{i % 12}" for i in range(n)), "en", "s", 0) for n in (60, 1999, 2000, 30_000)]
    rows += [(-n, " ".join(f"w{i * 7 % max(n // 2, 900)}" for i in range(n)), "en", "s", 0)
             for n in (60, 1999, 2000, 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for r in rules.weak_quality(df).collect():
        assert r["votes"][place] == (rules.REJECT if r["doc_id"] > 0 else rules.ACCEPT)


def test_em_finds_accuracies():
    rng = np.random.default_rng(5)
    good = rng.random(20_000) < 0.8
    accept, reject = [0.97, 0.9, 0.95, 0.92], [0.8, 0.6, 0.7, 0.5]
    letters = []
    for a, r in zip(accept, reject, strict=True):
        u = rng.random(len(good))
        yes = np.where(good, u < a, u >= r)
        letters.append(np.where(rng.random(len(good)) < 0.2, "-", np.where(yes, "a", "r")))
    model = rules.fit(Counter(map("".join, zip(*letters, strict=True))), 4)
    assert abs(model.prior - 0.8) < 0.05
    assert np.allclose(model.accepts_good, accept, atol=0.04)
    assert np.allclose(model.rejects_bad, reject, atol=0.12)


# packing

def padding(lengths, ends):
    return sum(min(e for e in ends if e >= x) - x for x in lengths)


def test_boundaries_are_optimal():
    from itertools import combinations
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = rng.integers(1, 40, 30)
        tops, counts = np.unique(lengths, return_counts=True)
        ends = packing.optimal_boundaries(tops.astype(float), counts, tops * counts, 4)
        best = min(padding(lengths, [*c, tops[-1]]) for k in range(4)
                   for c in combinations(tops[:-1], k))
        assert padding(lengths, ends) == best and len(ends) <= 4


def test_batches(docs, odd, spark):
    for df, budget in ((docs, 4000), (odd, 100)):
        out = packing.pack(df, buckets=5, budget=budget).toPandas()
        assert len(out) == df.count()
        assert [len(WORDS.findall(t or "")) for t in out["text"]] == out["n_tokens"].tolist()
        assert (out["n_tokens"] <= out["padded_to"]).all()
        tops = out.groupby("bucket")["padded_to"].max().tolist()
        assert tops == sorted(set(tops))
        for (bucket, batch), rows in out.groupby(["bucket", "batch"]):
            per = max(1, budget // max(1, rows["padded_to"].iloc[0]))
            assert sorted(rows["slot"]) == list(range(len(rows))) and len(rows) <= per
            last = out[out["bucket"] == bucket]["batch"].max()
            assert len(rows) == per or batch == last
    assert packing.pack(none(spark)).count() == 0


def test_equal_rows_are_dealt_to_many_ranges(spark, monkeypatch):
    """A third of all rows equal in every column: no range that a task numbers holds them all."""
    hot = spark.range(6_000).select(F.lit(None).cast("long").alias("doc_id"),
                                    F.lit(None).cast("string").alias("text"))
    others = spark.range(12_000).select("id", F.concat(F.lit("word "), F.col("id")).alias("text"))
    seen = []

    def few_rows(key, rows):
        return common.hash_chunk(key, rows, 500)

    def watched(df, group, order, slot, chunk):
        seen.append(df.groupBy(*group, chunk.alias("c")).count().agg(F.max("count")).first()[0])
        return common.numbered(df, group, order, slot, chunk)

    monkeypatch.setattr(packing, "hash_chunk", few_rows)
    monkeypatch.setattr(packing, "numbered", watched)
    out = packing.pack(hot.union(others), budget=512).toPandas()
    assert seen[0] < 1_000 and len(out) == 18_000
    assert not out.duplicated(["bucket", "batch", "slot"]).any()


def test_bins_are_exact_where_short_and_fine_where_long(spark):
    n = [0, 1, 255, 256, 257, 511, 512, 513, 1 << 20, (1 << 20) + 1, 123_456_789]
    df = spark.createDataFrame([(x,) for x in n], "n long")
    bins = [r[0] for r in df.select(packing.length_bin(F.col("n"))).collect()]
    assert bins[:6] == n[:6]
    assert all(x <= b <= x * (1 + 1 / 200) + 1 for x, b in zip(n, bins, strict=True))


# mixing

def test_mixture_meets_targets(docs, odd, spark):
    for df, options in ((docs, {"budget": 1.0, "entropy": 0.9, "passes": 4.0}),
                        (docs, {"budget": 20_000}), (odd, {"budget": 500, "passes": 3.0}),
                        (docs, {"passes": 2.0}), (odd, {"passes": 2.0})):
        base = df.select("doc_id", "source", "text").toPandas()
        base["n"] = [len(WORDS.findall(t or "")) for t in base["text"]]
        out = mixing.mix(df, **options).toPandas()
        assert (out["n_tokens"] == [len(WORDS.findall(t or "")) for t in out["text"]]).all()
        keyed = mixing.source_plan(df.select("source", mixing.word_count(F.col("text")).alias(
            "n_tokens")), options.get("budget"), options.get("entropy"), options.get("passes"))
        plan = keyed.toPandas()
        assert math.isclose(plan["weight"].sum(), 1)
        if options.get("budget") is None:
            assert set(base["doc_id"].dropna()) == set(out["doc_id"].dropna())
            assert (plan["target"] / plan["tokens"]).max() <= 2.01
        for r in plan.itertuples():
            own = (out["source"] == r.source) if isinstance(r.source, str) else out["source"].isna()
            ours = (base["source"] == r.source) if isinstance(r.source, str) else base["source"].isna()
            got, longest = out[own]["n_tokens"].sum(), base[ours].groupby(["doc_id", "text"], dropna=False)["n"].sum().max()
            assert r.target <= got <= r.target + longest, r
            whole = out[own].groupby("epoch")["n_tokens"].sum()
            assert (whole[whole.index < r.epochs] == r.tokens).all()
    assert mixing.mix(none(spark)).count() == 0


def test_blocks_hold_sources_by_weight(many):
    """Every block but the last has about its size, and each source its weight of the block."""
    df = many[0].select("doc_id", "source", "text")
    out = mixing.mix(df, budget=1.5, entropy=0.9, block=100_000).toPandas()
    weight = out.groupby("source")["n_tokens"].sum() / out["n_tokens"].sum()
    blocks = out.pivot_table(index="block", columns="source", values="n_tokens", aggfunc="sum", fill_value=0)
    assert len(blocks) > 10 and list(blocks.index) == list(range(len(blocks)))
    size = blocks.sum(axis=1)
    assert (abs(size.iloc[:-1] - 100_000) < 40_000).all()
    # what a random order leaves: six deviations, and the longest document
    per = out.groupby("source")["n_tokens"]
    left = 6 * (per.apply(lambda n: (n ** 2).sum()) / len(blocks)) ** 0.5 + per.max()
    assert (abs(blocks.iloc[:-1] - 100_000 * weight).max() < left).all()
    order = out.sort_values(["block", "place"])["source"].tolist()
    changes = sum(a != b for a, b in zip(order, order[1:], strict=False))
    assert changes > 0.5 * len(order) * (1 - (weight ** 2).sum())
    passes = out.groupby(["source", "epoch"])["block"].agg(["min", "max"])
    for _, r in passes.groupby(level=0):
        assert (r["min"].iloc[1:].to_numpy() >= r["max"].iloc[:-1].to_numpy()).all()


def test_exponent_is_the_bisected_one(spark):
    tokens_ = np.array([9000, 500, 300, 100, 100])
    share = tokens_ / tokens_.sum()
    df = spark.createDataFrame([(int(t), float(s)) for t, s in zip(tokens_, share, strict=True)],
                               "tokens long, share double")

    def entropy(a):
        p = share ** a / (share ** a).sum()
        return -(p * np.log(p)).sum() / np.log(len(p))

    a = mixing.exponent(df, 10_000, 0.9, None)
    assert entropy(a) >= 0.9 > entropy(a + 1e-6)
    a = mixing.exponent(df, 10_000, None, 3.0)
    passes = [(10_000 * share ** x / (share ** x).sum() / tokens_).max() for x in (a, a - 1e-6)]
    assert passes[0] <= 3 < passes[1]


# sharding

def test_shards(docs, odd, spark):
    for df in (docs, odd):
        out = sharding.shard(df, 8).toPandas()
        assert len(out) == df.count()
        sizes = [len((t or "").encode()) + 1 for t in out["text"]]
        assert sizes == out["size"].tolist()
        per = out.groupby("shard")["size"].sum().reindex(range(8), fill_value=0)
        assert per.max() - per.min() <= max(2 * max(sizes), 0.01 * sum(sizes) / 8 + max(sizes))
        for _, rows in out.groupby("shard"):
            assert sorted(rows["slot"]) == list(range(len(rows)))
        order = out.fillna({"doc_id": -1}).sort_values(["shard", "slot"])["doc_id"].tolist()
        assert order == sorted(order)
    assert sharding.shard(none(spark), 8).count() == 0


def test_a_hot_key_is_split(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 150)
    df = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"),
                                  F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    per = sharding.shard(df, 8).groupBy("shard").agg(F.sum("size").alias("b")).toPandas()["b"]
    assert len(per) == 8 and per.max() - per.min() <= 100


# token counts

@pytest.fixture(scope="module")
def definition():
    import public_tokenizers
    return public_tokenizers.path


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts_match_the_library(docs, odd, spark, definition, name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(definition(name))
    for df in (docs, odd):
        want = Counter((r["doc_id"], len((r["text"] or "").encode()),
                        len(t.encode(r["text"] or "", add_special_tokens=False).ids))
                       for r in df.select("doc_id", "text").collect())
        got = tokens.count_tokens(df, definition(name), chunk=700, overlap=60).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert tokens.count_tokens(none(spark), definition(name)).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_splices_of_hostile_texts(definition, name):
    from pathlib import Path
    counter = tokens.Counter(Path(definition(name)).read_text())
    rng = np.random.default_rng(1)
    alphabet = list("abé ÉﬁΣ́  \n\t  '.,<|>0123漢字😀") + ["<|endoftext|>", "'s", " the "]
    texts = ["".join(rng.choice(alphabet, 3000)) for _ in range(12)]
    texts += ["x" * 2500, "ab" * 1500, " " * 2000, "a " * 1500, "<|startoftext|>" * 200,
              "the cat " * 400 + "y" * 900 + " dog" * 300]
    for text in texts:
        whole = len(counter.encode([text])[0].ids)
        assert counter.lengths([text]) == [whole]
        for chunk, overlap in ((500, 40), (233, 17), (1000, 300)):
            assert tokens.count_huge(counter, text, chunk, overlap) == whole, text[:40]


# toxicity and quality

def test_toxicity(many, odd, spark):
    docs, labels = many
    out = toxicity.score(docs, labels, carry=["doc_id"]).toPandas()
    truth = labels.toPandas().set_index("doc_id")["toxic"]
    held = [i for i in out["doc_id"] if zlib.crc32(str(i).encode()) % 4 == 2 and i in truth.index]
    p = out.set_index("doc_id").loc[held]
    assert ((p["predicted"] == truth[held]).mean()) > 0.9
    assert out["score"].between(0, 1).all() and len(out) == docs.count()
    assert toxicity.score(odd, labels, carry=["doc_id", "n_words"]).count() == len(odd_rows())
    assert toxicity.score(none(spark), labels).count() == 0
    rate = toxicity.score(odd, labels.filter("false")).toPandas()["score"]
    assert rate.nunique() == 1 and rate.iloc[0] < 0.5


def test_held_out_labels_are_not_learnt(many):
    """Turning every held-out label around changes no score."""
    docs, labels = many
    turned = labels.withColumn("toxic", F.when(toxicity.in_training(), F.col("toxic")).otherwise(
        1 - F.col("toxic")))
    a, b = (toxicity.score(docs, x).orderBy("doc_id").toPandas()["score"] for x in (labels, turned))
    assert (a == b).all()


def test_counterfactual_penalty_frees_identity_terms():
    """A term that only toxic examples name gets no weight of its own."""
    known = toxicity.Features()
    texts = [f"the foreigners are moron {i}x" for i in range(40)] + [f"the sky is blue {i}x" for i in range(80)]
    texts += [f"what a moron he is y{i}" for i in range(20)]
    y = np.array([1.0] * 40 + [0.0] * 80 + [1.0] * 20)
    rows = toxicity.Rows([known.of(t) for t in texts])

    def score(pairs, text):
        w, b = toxicity.fit_logistic(rows, y, pairs=pairs, ridge=0.3)
        return toxicity.sigmoid(sum(w[i] for i in known.of(text)) + b)

    plain = score([], "the foreigners is here")
    fair = score(toxicity.swaps(rows, ["foreigners", "women", "muslims"]), "the foreigners is here")
    assert fair < plain / 2
    assert score(toxicity.swaps(rows, ["foreigners", "women"]), "the sky moron") > 0.6


def test_quality(many, odd, spark):
    docs, labels = many
    out = quality.score(docs, labels).toPandas()
    truth = labels.toPandas().set_index("doc_id")["quality"]
    got = out.set_index("doc_id").reindex(truth.index)["kept"].astype(int)
    assert (got == truth).mean() > 0.85
    assert len(out) == docs.count() and out["score"].between(0, 1).all()
    assert quality.score(odd, labels, carry=["doc_id", "text", "n_words"]).count() == len(odd_rows())
    assert quality.score(none(spark), labels).count() == 0
    assert quality.score(odd, labels.filter("false")).toPandas()["score"].nunique() == 1


def test_co_training_learns_from_the_other_view():
    """One view alone cannot tell some documents apart; the other one teaches it."""
    rng = np.random.default_rng(9)
    y = (rng.random(2400) < 0.6).astype(float)

    def view(k):
        return [[int(10 + 10 * t + rng.integers(0, 13)) + 1000 * k for _ in range(3)] for t in y]

    a, b = view(1), view(2)
    few, pool, test = range(150), range(150, 1400), range(1400, 2400)

    def part(rows, at):
        return [rows[i] for i in at]

    views, mix = quality.co_train((part(a, few), part(b, few)), y[:150], (part(a, pool), part(b, pool)))
    alone = quality.View(part(a, few), y[:150])
    both = sum(m * v.calibrated(part(r, test)) for m, v, r in zip(mix, views, (a, b))) + mix[2]
    accuracy = ((both > 0) == (y[1400:] > 0)).mean()
    assert accuracy >= ((alone.logits(part(a, test)) > 0) == (y[1400:] > 0)).mean()
    assert len(views[0].labels) > 120 and accuracy > 0.9


@pytest.mark.parametrize("text", [
    "abcdef!" * 60, "!abcdef" * 60, "a!", "ab_cd__ef" * 9, "é漢字 ٣²½ \u00a0\x1c…—“”\u0301😀" * 5, ""])
def test_signs_are_counted_in_the_whole_text(text):
    signs = sum(not (c.isalnum() or c.isspace()) for c in text)
    want = quality.feature_id(f"m:p{quality._level(signs / max(1, len(text)))}")
    assert want in quality.metadata_features("a", "en", 1.0, text)


def test_shapes_are_of_whole_tokens():
    """What follows the first 64 characters counts; long tokens are not remembered."""
    shapes = quality.Shapes()
    assert shapes["a" * 64 + "#$" * 500] == "a" + "#$" * 500 and not shapes
    assert shapes["漢" * 5000 + "9" * 5000 + "!" * 5000] == "a0!!" and shapes["don't"] == "a'a"
    assert list(shapes) == ["don't"]
    clean, junk, ended = (set(quality.content_features("a" * 64 + x, shapes))
                          for x in ("", "#$%" * 400, "b" * 900 + "."))
    odd, end = (quality.feature_id(f"c:{k}{quality._level(1)}") for k in "oe")
    assert odd in junk and odd not in clean and end in ended and end not in clean


def linked_by_all_pairs(rows, size=2, percent=80):
    """component_id by doc_id, comparing every two texts of documents with an id."""
    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    of = {i: i for i, _ in sets}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if i == j or (x and y and 100 * len(x & y) >= percent * len(x | y)):
                a, b = sorted((root(i), root(j)))
                of[b] = a
    return {i: root(i) for i in of}


def components_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {}
    for r in neardup.duplicate_components(df, 2).collect():
        out.setdefault(r["doc_id"], set()).add(r["component_id"])
    return out


def test_documents_with_several_texts_link_by_each(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "x y z w"), (3, "x y z w"), (4, "x y z w v"),
            (5, None), (5, "q r s t"), (6, "q r s t"), (7, ""), (7, "x y z w"), (8, "lone text"),
            (8, "lone text"), (8, None), (9, ""), (None, "lone text"), (None, "none other")]
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(60)]
    for k in range(60):
        words = list(base)
        for i in rng.integers(0, 60, rng.integers(0, 5)):
            words[i] = f"n{k}"
        rows.append((100 + k % 40, " ".join(words)))
    got = components_of(spark, rows)
    want = linked_by_all_pairs(rows)
    assert got.pop(None) == {8, None}
    assert got == {i: {c} for i, c in want.items()}


def test_short_hashes_that_collide_lose_no_link(spark, monkeypatch):
    """Blocks compare sets by 10-bit hashes: many shingles collide, the components stay exact."""
    monkeypatch.setattr(neardup, "SHORT", 10)
    monkeypatch.setattr(neardup, "BLOCK", 20)
    monkeypatch.setattr(neardup, "PIVOT_PAIRS", 5)
    rng = np.random.default_rng(8)
    base, rows = [f"w{i}" for i in range(150)], []
    for k in range(90):
        words = list(base)
        for i in rng.choice(150, int(rng.integers(0, 22)), replace=False):
            words[i] = f"n{k}x{i}"
        rows.append((k, " ".join(words)))
    got = components_of(spark, rows)
    assert got == {i: {c} for i, c in linked_by_all_pairs(rows).items()}


def bytes_of(rows):
    return [np.asarray(sorted(x), np.int32).tobytes() for x in rows]


def two_views(n):
    rng = np.random.default_rng(9)
    y = (rng.random(n) < 0.6).astype(float)
    return y, *([sorted({int(10 + 10 * t + rng.integers(0, 13)) + 1000 * k for _ in range(3)})
                 for t in y] for k in (1, 2))


def test_all_unlabelled_documents_are_candidates(spark):
    """A table teaches what the same pool in memory does, in any order of its rows."""
    y, a, b = two_views(9000)
    labelled, pool = (a[:150], b[:150]), (a[150:], b[150:])
    free = spark.createDataFrame(list(zip(bytes_of(pool[0]), bytes_of(pool[1]), range(8850))),
                                 "features binary, more binary, draw int").withColumn(
        "draw", F.pmod(F.xxhash64("draw"), F.lit(quality._DRAWS)).cast("int"))
    want, mix = quality.co_train(labelled, y[:150], pool)
    got, mixed = quality.co_train_table(labelled, y[:150], free)
    again, _ = quality.co_train_table(labelled, y[:150], free.orderBy("draw").repartition(7))
    for rows, w, g, h in zip((a, b), want, got, again, strict=True):
        p, q = (quality.sigmoid(v.logits(rows)) for v in (w, g))
        assert np.abs(p - q).mean() < 0.02 and ((p > 0.5) == (q > 0.5)).mean() > 0.99
        assert np.allclose(g.weights, h.weights, atol=1e-6)


def test_a_rare_kind_is_learnt_from_all_unlabelled_documents(spark, monkeypatch):
    """4 of 9,000 unlabelled pages are of a kind no label shows; the other view teaches it."""
    y, a, b = two_views(1200)
    labelled = [(k, x, z, int(t)) for k, (x, z, t) in enumerate(zip(a, b, y))][:300]
    common = [(1000 + k, a[k % 1200], b[k % 1200], None) for k in range(9000)]
    # content is plainly bad, the metadata of a kind of its own
    rare = [(20_000 + k, [1010, 1011, 1012], [7777], None) for k in range(4)]
    table = spark.createDataFrame(
        [(i, *bytes_of([x, z]), t, i * 7919 % quality._DRAWS) for i, x, z, t in labelled + common + rare],
        "doc_id long, features binary, more binary, label int, draw int")
    monkeypatch.setattr(quality, "SHARE", 0.5)
    views, _ = quality._fit(table)
    assert views[1].weights[7777] < -0.1


def test_labels_without_a_document_use_up_no_bound(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))

    def features():
        return lambda texts: ([[1]] * len(texts), [[]] * len(texts))

    got = toxicity.sampled_rows(docs, labels, "toxic", {1: 30, 0: 15}, features)
    assert got.to_pandas()["label"].value_counts().to_dict() == {1: 20, 0: 15}


class Spied:
    """A counter that adds up what it encodes."""

    def __init__(self, counter):
        self.counter, self.read = counter, 0
        self.space, self.place = counter.space, counter.place

    def encode(self, texts):
        self.read += sum(map(len, texts))
        return self.counter.encode(texts)


@pytest.mark.parametrize("text", [
    "漢字文書" * 40_000, "漢字，文書。" * 25_000, "QUJDRA+/x9" * 15_000, "longword" * 20_000,
    "a" * 70_000 + " " + "don't we'll 5's !'s x's" * 4_000, "word " * 30_000,
    "x<|endoftext|>y, " * 9_000, "<|endoftext|>" * 9_000, "é́≠İ!" * 20_000, "!?#" * 40_000,
    "a'" * 40_000, "1é" * 40_000, "ǅ。ǅ，" * 20_000, "'s't're'" * 15_000], ids=range(14))
def test_huge_texts_are_read_at_most_thrice(definition, text):
    counter = tokens.Counter(Path(definition("word_bpe_49k.json")).read_text())
    want = len(counter.encode([text])[0].ids)
    for chunk, overlap in ((4096, 64), (1000, 7)):
        spied = Spied(counter)
        assert tokens.count_huge(spied, text, chunk, overlap) == want
        assert spied.read < 3 * len(text)
