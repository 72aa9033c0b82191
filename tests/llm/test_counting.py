"""Collocations, source mixing and source divergence against brute force, and the defined corner cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kairos.llm import collocations, divergence, mixing, words

LOWER = {c: c + 32 for c in range(65, 91)}


def lower(t):
    return (t or "").translate(LOWER)


@pytest.fixture(scope="module")
def rows():
    """Documents of some languages and sources: nulls, blanks, ties, copies, one long text, odd characters."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["ünï", "çöde", "Straße", "日本", "A\xa0B", "x\x1fy"]
    langs, sources = ["en", "de", None, "", "xx"], ["a", "b", "B", "é", None, ""]
    out = [(0, None, "en", "a"), (1, "", "en", "a"), (2, " \t\n.", None, None), (3, "one", "zz", "alone"), (4, None, None, "none")]
    for i in range(5, 160):
        n = rng.choice([1, 2, 3, 10, 60])
        text = "".join(rng.choice(vocabulary[: rng.choice([8, 66])]) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r", "-"]) for _ in range(n))
        out.append((i, text, rng.choice(langs[:4] if i % 2 else langs[:1]), rng.choice(sources if i % 3 else sources[:1])))
    out += [(200 + i, "copy of the same text, copy of the same text", "en", "a") for i in range(12)]
    out += [(300, " ".join(rng.choice(vocabulary) for _ in range(20_000)), "de", "b"), (5, out[5][1], out[5][2], out[5][3])]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With further columns whose names the operators use inside."""
    named = [(i, t, la, s, "x", "y", 7, 1.5) for i, t, la, s in rows]
    return spark.createDataFrame(named, "doc_id long, text string, lang string, source string, phrase string, term string, n long, size double").repartition(5)


# ---------------------------------------------------------------- collocations
def brute_collocations(rows, min_count, share, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in (1, 2, 3):
                counts[lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, c in counts.items():
        found = []
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        for p, a in cand.items():
            if len(p) == 2 and any(100 * b >= share * a for q, b in cand.items() if len(q) == 3 and p in (q[:2], q[1:])):
                continue
            score, _, le, r = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), le, r))
        for rank, (s, a, p, le, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, le, r, total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("min_count,top", [(10, 2000), (2, 25), (300, 5)])
def test_collocations_equal_brute_force(docs, rows, min_count, top):
    got = collocations.mine(docs, min_count=min_count, top=top)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, min_count, 50, top)


def test_collocations_taken_in_many_parts(docs, rows, monkeypatch):
    """Bounds of a task that are reached often, and long texts in small blocks, change nothing."""
    monkeypatch.setattr(collocations, "MAX_GRAMS", 50)
    counter = collocations.GramCounter(3)
    got = Counter()

    def keep():
        vocabulary, grams, _ = counter.take()
        spelt = list(vocabulary)
        for (_, n), (keys, counts) in grams.items():
            for k, c in zip(keys.tolist(), counts.tolist()):
                got[tuple(spelt[(k >> (21 * j)) & (2**21 - 1)].decode() for j in reversed(range(n)))] += c

    monkeypatch.setattr(collocations, "token_blocks", lambda data, table: words.token_blocks(data, table, 16))
    want = Counter()
    for _, text, _, _ in rows:
        for _ in counter.add(b"en", (text or "").encode()):
            keep()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                want.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    keep()
    assert got == want


def test_merged_summaries_keep_every_frequent_gram():
    """With a capacity above mass / threshold no frequent one is lost, in any order of merging."""
    rng = np.random.default_rng(1)
    for seed in range(20):
        stream = rng.zipf(1.3, 4000).astype(np.uint64) % np.uint64(3000)
        parts = [np.unique(p, return_counts=True) for p in np.array_split(stream, 9)]
        exact = Counter(stream.tolist())
        capacity = len(stream) // 10 + 1
        packed = [(collocations._pack(k).tobytes(), np.minimum(c, 10).astype(np.uint8).tobytes()) for k, c in parts]
        clipped = Counter()
        for k, c in parts:
            clipped.update(dict(zip(k.tolist(), np.minimum(c, 10).tolist())))
        rng.shuffle(packed)
        for cap in (capacity, 40):
            keys, counts, taken = collocations.merge_summaries(packed, cap)
            held = dict(zip(keys.tolist(), counts.tolist()))
            assert len(held) <= cap and all(held.get(k, 0) <= n <= held.get(k, 0) + taken for k, n in clipped.items())
            if cap == capacity:
                assert taken < 10 and {k for k, n in exact.items() if n >= 10} <= {k for k, n in held.items() if n + taken >= 10}


def test_grams_that_look_alike_are_counted_by_their_text(spark):
    """Without the summaries' bitmap (all bits set) the exact pass still tells n-grams apart."""
    docs = spark.createDataFrame([(1, "a b c, a b", "en"), (2, "a b", "en")], "doc_id long, text string, lang string")
    every = collocations.GramFilter([{"part": p, "flags": b"\xff" * 8} for p in range(2)], 1)
    src = docs.select("lang", F.col("text").cast("binary").alias("text"))
    got = {(r["n"], r["phrase"]): r["f"] for r in collocations.exact_counts(src, every, 1, 3).collect()}
    assert got == {(0, ""): 7, (1, "a"): 3, (1, "b"): 3, (1, "c"): 1, (2, "a b"): 3, (2, "b c"): 1, (3, "a b c"): 1}


# ---------------------------------------------------------------- mixing
def size_of(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def brute_targets(sizes, weights, cap):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        now = full | {s for s in order if s not in full and cap * sizes[s] * w <= weight[s] * left}
        if now == full:
            return {s: float(cap * sizes[s]) if s in full else weight[s] * left / w for s in order}
        full = now


def test_mix_targets_and_copies(docs, rows):
    got = mixing.mix(docs).collect()
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += size_of(t)
    want = brute_targets(sizes, (5, 2, 1), 3)
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, *_ in rows)
    source = {i: s for i, _, _, s in rows}
    taken = Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size_of(next(t for i, t, _, _ in rows if i == r["doc_id"])) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s]) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        if r["source_size"]:
            assert r["copies"] in (int(r["target"] // r["source_size"]), int(r["target"] // r["source_size"]) + 1)
        taken[s] += r["taken"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    again = mixing.mix(docs.repartition(3, "source")).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_mix_comes_near_its_targets(spark):
    """Within 2 % although sizes differ 4,000-fold, and every document has its chance over seeds."""
    rng = random.Random(4)
    data = [(i, " ".join(["w"] * max(1, int(min(4000, 5 * rng.paretovariate(0.8))))), "abc"[i % 3] if i % 2 else "a") for i in range(1500)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    near, chosen = [], Counter()
    for seed in range(6):
        got = mixing.mix(docs, seed=seed)
        by = got.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
        near += [abs(r["taken"] / r["target"] - 1) for r in by]
        chosen.update(r["doc_id"] for r in got.where("copies > floor(target / source_size)").collect())
    assert max(near) < 0.02
    assert 0.5 < len(chosen) / 1500


def test_pareto_sampling_follows_unequal_odds(spark):
    """A document of three times the weight is taken about three times as often; none beyond the cap."""
    docs = spark.range(3000).selectExpr("id as doc_id", "'w w w w' as text", "if(id % 2 = 0, 'a', 'b') as source", "if(id % 3 = 0, 3.0D, 1.0D) as odds")
    got = mixing.mix(docs, weight_col="odds", weights=(1, 3), share=0.5).join(docs, "doc_id")
    by = {(r["source"], r["odds"]): (r["copies"], r["n"]) for r in got.groupBy("source", "odds").agg(F.sum("copies").alias("copies"), F.count("*").alias("n")).collect()}
    heavy, light = by["a", 3.0], by["a", 1.0]  # a's target is 375 documents of 1,500
    assert heavy[0] / heavy[1] == pytest.approx(3 * light[0] / light[1], rel=0.25)
    assert heavy[0] + light[0] == pytest.approx(375, abs=1)
    assert sum(by["b", w][0] for w in (1.0, 3.0)) == pytest.approx(1125, abs=1)
    assert by["b", 3.0][0] > 1.9 * by["b", 3.0][1] / 2


def test_global_order_numbers_all_rows(spark):
    rows = spark.range(1000).selectExpr("cast(nullif(id % 300, 7) as string) as s", "id").distinct()
    got = mixing.global_order(rows, F.col("s").isNull(), F.col("s"), F.col("id")).orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1000))
    keys = [(r["s"] is None, (r["s"] or "").encode(), r["id"]) for r in got]
    assert keys == sorted(keys)


# ---------------------------------------------------------------- divergence
def brute_audit(rows, min_docs, top):
    f = lambda p, q: (p - q) * (p - q) // q
    counts, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in langs.items():
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        c = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        n = {s: sum(c[s].values()) for s in sources}
        p = {s: {t: 1 + 10**9 * (c[s][t] + 1) // (n[s] + len(kept)) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (sum(c[s][t] for s in sources) + 1) // (sum(n.values()) + len(kept)) for t in kept}
        for s in sources:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            term = [(-f(p[s][t], q[t]), t.encode()) for t in kept if c[s][t] > 0 and p[s][t] > q[t]]
            out += [(lang, s, "pair", i.decode(), -v, k) for k, (v, i) in enumerate(sorted(pair), 1)]
            out += [(lang, s, "term", i.decode(), -v, k) for k, (v, i) in enumerate(sorted(term)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("min_docs,top,nodes", [(3, 200, 200_000), (1, 7, 5), (60, 3, 200_000)])
def test_divergence_equals_brute_force(docs, rows, min_docs, top, nodes, monkeypatch):
    monkeypatch.setattr(divergence, "MAX_NODES", nodes)
    got = sorted(tuple(r) for r in divergence.audit(docs, min_docs=min_docs, top=top).collect())
    assert got == brute_audit(rows, min_docs, top)


def test_tree_corrections_are_exact_for_extreme_values():
    """Shared prefixes, multiplicities and values near 10^9: equal to whole-number arithmetic."""
    rng = random.Random(6)
    tree, want = divergence.PatternTree(), Counter()
    f = lambda p, q: (p - q) * (p - q) // q
    base = [1, 2, 900_000_000, 5, 1_000_000_001]
    for _ in range(300):
        path = [(s, rng.choice([1, 7, 10**9 + 1, 10**9 // 3]), base[s]) for s in sorted(rng.sample(range(5), rng.randrange(1, 6)))]
        m = rng.choice([1, 3, 50_000])
        tree.insert(*zip(*path), m)
        for s, p, b in path:
            for t, q, d in path:
                if s != t:
                    want[s, t] += m * (f(p, q) - f(p, d) - f(b, q) + f(b, d))
    assert {k: v for k, v in tree.corrections().items() if v} == {k: v for k, v in want.items() if v}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert collocations.mine(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert divergence.audit(none).count() == 0
