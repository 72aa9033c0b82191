"""Operators for texts against brute force, round trips, and the defined corner cases."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kairos.llm import (chat_tree, common, decontaminate, langid, license_scan, line_dedup, ngram_join, quality_gam, queries,
                        spiece, token_counts, winnow)

SF = "/root/testdata/sf0.001"
PIECES, WORDS = queries.tokenizer_file("piece_bpe_32k.model"), queries.tokenizer_file("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, score string, n string, hits string, n_lines string, h string, id string"


def docs_of(spark, texts, **extra):
    rows = [(i, t, "en", "own", "own", "own", "own", "own", "own") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Texts with nulls, blanks, ties, copies, near copies, shared passages and one long text."""
    rng = random.Random(5)
    texts = [None, "", " \t\n ", "one", "one", "One two", "one two", "a b c", "ünï çöde", "x" * 5000]
    base = [prose(rng, rng.randrange(5, 160)) for _ in range(40)]
    texts += base + base[:6]
    passage = prose(rng, 60)
    for b in base[:12]:
        words = b.split()
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        texts.append(" ".join(words))
        texts.append(b + "\n" + passage)
    texts.append(prose(rng, 30_000))
    hub = prose(rng, 100).split()
    for i in range(30):  # a group of near copies
        w = list(hub)
        w[i * 3] = f"q{i}"
        texts.append("\n".join([" ".join(w[:50]), " ".join(w[50:])]))
    return texts


def jaccard_groups(texts, k, num, den):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if a and den * c >= num * (len(a) + len(sets[j]) - c):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 4, 5)])
def test_jaccard_join_equals_brute_force(spark, corpus, k, num, den):
    got = ngram_join.jaccard_components(docs_of(spark, corpus), k=k, num=num, den=den).collect()
    expected = jaccard_groups(corpus, k, num, den)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == dict(enumerate(expected))
    assert len({c for _, c in expected}) < len(corpus) - 30


def test_jaccard_join_opens_clusters(spark):
    """A chain whose ends link only through members, not through the leader."""
    words = [f"v{i}" for i in range(104)]
    texts = []
    for shift in range(0, 60, 3):
        w = list(words)
        for j in range(shift):
            w[j] = f"s{j}"
        texts.append(" ".join(w))
    got = ngram_join.jaccard_components(docs_of(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == dict(enumerate(jaccard_groups(texts, 4, 85, 100)))


def test_jaccard_join_salted_tokens(spark, corpus, monkeypatch):
    monkeypatch.setattr(ngram_join, "SALT_EVERY", 1)
    got = ngram_join.jaccard_components(docs_of(spark, corpus)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == dict(enumerate(jaccard_groups(corpus, 4, 85, 100)))


def test_jaccard_join_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (1, "other words stand in here"), (2, "a b c d e"), (3, None)],
                               "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()), key=str)
    assert got == sorted([(None, 2, None), (1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)], key=str)


def test_components(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(70)]
    star = [(500, i) for i in range(501, 700)]
    ring = [(1000 + i, 1000 + (i + 1) % 9) for i in range(9)]
    edges = path + star + ring + [(3, 3), (None, 4)]
    rng.shuffle(edges)
    got = {r.id: r.component for r in common.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(71)} | {i: 500 for i in range(500, 700)} | {i: 1000 for i in range(1000, 1009)}
    assert common.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def removed_lines(texts, min_words=1, num=4, den=5):
    seen, gone = [], set()
    for i, t in enumerate(texts):
        for j, line in enumerate(t.split("\n") if t is not None else []):
            w = set(line.replace("\t", " ").replace("\r", " ").split(" ")) - {""}
            if len(w) < min_words:
                continue
            if any(den * len(w & v) >= num * len(w | v) for v in seen):
                gone.add((i, j))
            seen.append(w)
    return gone


def test_line_dedup_equals_brute_force(spark, corpus):
    texts = corpus + [corpus[10] + "\n" + corpus[11], "\n".join(["same line of six plain words"] * 4), "six plain words of same\tline\r\nshort one",
                      "one  short\nshort one two\nfour words are here\nare here words four and\nhere words four", "日本語の長い行\n日本語の長い行"]
    got = line_dedup.dedup_lines(docs_of(spark, texts))
    assert got.columns == ["doc_id", "text", "lang", "score", "n", "hits", "h", "id", "n_lines", "n_removed"]
    gone = removed_lines(texts)
    for r in got.collect():
        t = texts[r.doc_id]
        lines = t.split("\n") if t is not None else []
        assert r.text == (None if t is None else "\n".join(x for j, x in enumerate(lines) if (r.doc_id, j) not in gone))
        assert (r.n_lines, r.n_removed) == (len(lines), sum(i == r.doc_id for i, _ in gone))
    left = {r.doc_id for r in line_dedup.drop_emptied(got).collect()}
    assert 0 in left and 1 in left and len(left) < len(texts)


def test_line_dedup_repeated_and_null_ids(spark):
    a, b = "one two three four five six", "ten eleven twelve thirteen fourteen"
    df = spark.createDataFrame([(1, a), (1, a), (1, b + "\n" + a), (None, a), (2, a + "\n" + "kept short")], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect()), key=str)
    assert got == sorted([(1, a), (1, a), (1, b), (None, a), (2, "kept short")], key=str)


def test_line_dedup_with_frequent_words_in_pairs(spark, monkeypatch):
    """Lines of words that nearly all lines have: keys are pairs of them, lists of every length."""
    rng = random.Random(12)
    common = [f"c{i}" for i in range(10)]
    texts = ["\n".join(" ".join(rng.sample(common, rng.randrange(1, 10)) + [f"r{rng.randrange(40)}"] * rng.randrange(2)) for _ in range(6)) for _ in range(120)]
    for frequent, short, num, den in ((2, 48, 4, 5), (4, 3, 4, 5), (2048, 5, 4, 5), (2, 4, 1, 2)):
        gone = removed_lines(texts, num=num, den=den)
        monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
        monkeypatch.setattr(line_dedup, "SHORT", short)
        got = line_dedup.dedup_lines(docs_of(spark, texts), num=num, den=den).collect()
        assert {r.doc_id: r.n_removed for r in got} == {i: sum(d == i for d, _ in gone) for i in range(len(texts))} and len(gone) > 50
        for r in got:
            assert r.text == "\n".join(x for j, x in enumerate(texts[r.doc_id].split("\n")) if (r.doc_id, j) not in gone)


def test_line_dedup_small_bitmap(spark, corpus, monkeypatch):
    """Unique lines that share a bit with a repeated key still meet their near copies, on either side."""
    monkeypatch.setattr(line_dedup, "BITS", 64)
    texts = corpus + ["\n".join(f"r{i} repeats in two rows here" for i in range(200))] * 2
    gone = removed_lines(texts)
    got = line_dedup.dedup_lines(docs_of(spark, texts)).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: sum(d == i for d, _ in gone) for i in range(len(texts))}
    for r in got:
        assert r.text is None or r.text == "\n".join(x for j, x in enumerate(texts[r.doc_id].split("\n")) if (r.doc_id, j) not in gone)


def test_line_dedup_makes_a_pair_once(spark, monkeypatch):
    """Unlike copies of one line share many long keys; each pair of them is made at the first."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    lines = [" ".join(w if rng.random() < 0.91 else f"{w}x{rng.randrange(40)}" for w in base) for _ in range(120)]
    keys = [(k, i) for i, line in enumerate(lines) for k, w in enumerate(line.split()[:16]) if w == base[k]]
    index = spark.createDataFrame([(base[k], k, i) for k, i in keys], "w string, pos int, id long").selectExpr(
        "xxhash64(w) as tok", "id", "0 as line_no", "60 as n", "60 - pos as reach", "0L as s", "id as c0")
    rows = line_dedup.once_per_pair(index.unionByName(index.where("id < 5"))).select("id", "tok", "reach", "seen")
    assert {r.id: r.n for r in rows.groupBy("id").agg(F.count("*").alias("n")).collect()} == {i: sum(j == i for _, j in keys) for i in range(120)}
    pairs = rows.alias("a").join(rows.alias("b"), F.expr("a.tok = b.tok and a.id < b.id"))
    made = sorted((r[0], r[1]) for r in pairs.where("not arrays_overlap(a.seen, b.seen)").select("a.id", "b.id").collect())
    assert made == sorted((r[0], r[1]) for r in pairs.select("a.id", "b.id").distinct().collect()) and pairs.count() > 4 * len(made)

    monkeypatch.setattr(line_dedup, "SHORT", 3)
    monkeypatch.setattr(line_dedup, "MANY", 8)
    texts = ["\n".join(lines[i:i + 4]) for i in range(0, 120, 4)]
    gone, before = removed_lines(texts), len(common.LAYERS)
    got = line_dedup.dedup_lines(docs_of(spark, texts))
    assert len(common.LAYERS) == before + 1  # what the operator worked with is deleted
    for r in got.collect():
        assert r.text == "\n".join(x for j, x in enumerate(texts[r.doc_id].split("\n")) if (r.doc_id, j) not in gone)
    assert 10 < len(gone) < 120


def test_tables_without_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert ngram_join.jaccard_components(docs).count() == 0
    assert line_dedup.dedup_lines(docs).count() == 0
    assert quality_gam.classify(docs, labels).count() == 0
    assert langid.identify(docs, langid.train(docs)).count() == 0
    assert decontaminate.overlaps(docs, bench).count() == 0
    assert token_counts.report(docs, WORDS).count() == 0
    assert spiece.encode(docs, PIECES).count() == 0
    assert license_scan.scan(docs).count() == 0
    assert winnow.edit_report(docs).count() == 0
    assert chat_tree.pack(chat_tree.gather(spark.createDataFrame([], "conv_id bigint, turn int, role string, text string"))).count() == 0


ODD = ["", " ", "   ", "▁", " ▁ x", "a\x00b", "<s> x </s>", "<|endoftext|>a<|startoftext|>", "ΑΣ Σ", "İstanbul", "ﬁ é é", "中文 字", "😀😀 !?",
       "it's we'll 12²½ªº", "\x1c\x85\xa0", "tab\tnew\nline\r", "don't", "A" * 3000, "<0x0A>", "﻿x", " ".join(["ab"] * 3000)]


def mixed(n=600):
    rng = random.Random(8)
    bits = [*ODD[:20], " ", "\n", "the", "Of", "ch", "É"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 8))) for _ in range(n)]


def test_sentencepiece_equals_library(spark, corpus, monkeypatch):
    sp = spiece.load(PIECES)
    texts = corpus + ODD + mixed()
    got = {r.doc_id: r for r in spiece.encode(docs_of(spark, texts), PIECES).collect()}
    back = {r.doc_id: r.decoded for r in spiece.decode(spiece.encode(docs_of(spark, texts), PIECES).select("doc_id", "packed_ids"), PIECES).collect()}
    for i, t in enumerate(texts):
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        assert np.frombuffer(got[i].packed_ids, "<u4").tolist() == ids
        assert got[i].decoded == sp.decode(ids) == back[i]
    assert got[0].score == "own"
    monkeypatch.setattr(spiece, "TABLE_MAX", 50)  # a table that starts anew gives the same ids
    small = spiece.ChunkTable(PIECES)
    for lo in range(0, len(texts), 16):
        for t, p in zip(texts[lo:lo + 16], small(texts[lo:lo + 16])[0]):
            assert np.frombuffer(p, "<u4").tolist() == sp.encode(t or "", add_bos=True, add_eos=True)


def test_sentencepiece_refuses_crossing_pieces(monkeypatch):
    class Crossing:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"
    monkeypatch.setitem(spiece._LOADED, "crossing", Crossing())
    assert spiece.chunks_are_independent(PIECES)
    assert not spiece.chunks_are_independent("crossing")


def test_token_counts_equal_library(spark, corpus):
    tok = token_counts.load(WORDS)
    texts = corpus + ODD + mixed()
    for r in token_counts.report(docs_of(spark, texts), WORDS, limit=20).collect():
        t = texts[r.doc_id] or ""
        n = len(tok.encode(t, add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(t.encode()), n > 20)


def test_whole_tokens_are_proved():
    tok, whole = token_counts.load(WORDS), token_counts.whole_tokens(WORDS)
    assert len(whole) > 20_000
    for w in random.Random(1).sample(sorted(whole), 300):
        assert len(tok.encode(w, add_special_tokens=False).ids) == 1


def test_quality_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_gam.classify(docs, labels).join(labels, "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_quality_classifier_corner_cases(spark, corpus):
    docs = docs_of(spark, corpus)
    one = spark.createDataFrame([(5, 1), (7, 1), (8, None)], "doc_id bigint, quality int")
    got = quality_gam.classify(docs, one)
    rows = got.collect()
    assert len(rows) == len(corpus) and {r.predicted for r in rows} == {1}
    assert {r.doc_id for r in rows if r.held_out} == {i for i in range(len(corpus)) if zlib.crc32(str(i).encode()) % 3 == 1}
    none = quality_gam.classify(docs, one.where("false")).collect()
    assert {r.score for r in none} == {0.5}


def test_gam_learns_a_pair():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no feature helps alone
    gam = quality_gam.fit(x, y, bins=8)
    assert (0, 1) in gam.pairs and np.mean((gam.score(x) > 0.5) == y) > 0.95
    total = np.full(len(x), gam.base)  # a score is the sum of table entries
    c = gam.codes(x)
    for j, t in enumerate(gam.tables):
        total += [t[k] for k in c[j]]
    for (i, j), t in zip(gam.pairs, gam.pair_tables):
        total += [t[a, b] for a, b in zip(c[i], c[j])]
    assert np.allclose(gam.logits(x), total)


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = (langid.identify(docs.select("doc_id", "text"), langid.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
           .where(quality_gam.held_out()).collect())
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_corner_cases(spark):
    texts = [None, "", "12 34 !", "der die das und nicht", "the of and that is", "x" * 3_000_000]
    machines = langid.fit(np.array([langid.features(t) for t in ("the of and that", "der die das und", "le la les des")]), ["en", "de", "xx"])
    got = {r.doc_id: r for r in langid.identify(docs_of(spark, texts), machines).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and got[0].score == 0.0
    assert got[3].lang_pred == "de" and got[4].lang_pred == "en" and got[5].lang_pred in ("en", "de", "xx")
    assert got[3].h == "own" and got[3].score != "own"


def test_decontamination(spark):
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(3000)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [say(30), say(20), "Too short to be evidence.", None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    broken = items[0].split()
    for j in range(3, 30, 7):
        broken[j] = "other"
    texts = [None, "", say(400), say(50) + "\n" + items[0].upper() + "! " + say(20), say(9) + " " + " ".join(broken),
             items[1].replace(" ", " - "), " ".join(items[0].split()[:15]) + " " + say(80), " ".join(items[0].split()[:7]) + say(20)]
    got = decontaminate.overlaps(docs_of(spark, texts), bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(3, 0), (4, 0), (5, 1), (6, 0)}
    whole = {r.doc_id: r for r in got.collect()}
    assert (whole[3].first_word, whole[3].last_word, whole[3].n_matched) == (50, 79, 30)
    kept = decontaminate.clean(docs_of(spark, texts), bench)
    assert kept.columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
    assert {r.doc_id for r in kept.collect()} == {0, 1, 2, 7}
    blocks = decontaminate.overlaps(docs_of(spark, texts), bench, block_chars=60)  # several passes, same rows
    assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_seeds_survive_substitutions(seed):
    """Verified overlaps equal a search along every diagonal, for items with up to a fifth of the words changed."""
    rng, found, truth = random.Random(seed), 0, 0
    for _ in range(100):
        item = [f"t{rng.randrange(500)}" for _ in range(rng.randrange(13, 50))]
        doc = list(item)
        for j in rng.sample(range(len(doc)), int(len(doc) * 0.15)):
            doc[j] = "changed"
        words = decontaminate._words([" ".join(item), " ".join(doc)])
        same, need = words[0] == words[1], 13
        truth += any(same[a:a + need].sum() >= 0.8 * need for a in range(len(item) - need + 1))
        found += bool(decontaminate.Index([(0, " ".join(item))]).hits(words[1], 13, 0.8))
    assert found >= 0.99 * truth


@pytest.mark.parametrize("n", range(1, 14))
def test_seeds_find_every_allowed_substitution(n):
    """All choices of substituted words, alone and inside a longer item that agrees nowhere else."""
    item = [f"t{i}" for i in range(n)]
    around = [f"a{i}" for i in range(12)]
    alone, inside = (decontaminate.Index([(0, " ".join(x))]) for x in (item, [*around[:6], *item, *around[6:]]))
    allowed = max(k for k in range(n) if n - k >= 0.8 * n)
    for k in range(allowed + 2):
        for gone in itertools.combinations(range(n), k):
            doc = [f"b{i}" for i in range(12)] + ["changed" if i in gone else w for i, w in enumerate(item)] + [f"c{i}" for i in range(12)]
            words = decontaminate._words([" ".join(doc)])[0]
            hits = alone.hits(words, 13, 0.8)
            assert [(h["first_word"], h["last_word"], h["n_matched"]) for h in hits] == ([(12, 11 + n, n - k)] if k <= allowed else []), gone
            if n == 13:
                assert bool(inside.hits(words, 13, 0.8)) == (k <= allowed), gone


def test_license_scan_equals_containment(spark):
    rng = random.Random(3)
    texts = [None, "", "..."]
    for name, t in license_scan.NOTICES:
        w = t.split()
        texts += [t, prose(rng, 33) + "\n" + t.upper() + "\n" + prose(rng, 70), prose(rng, 11) + " " + " ".join(w[:len(w) // 2])]
        if len(w) > 20:
            w[len(w) // 2] = "changed"
            texts.append(prose(rng, 200) + " " + " ".join(w) + " " + prose(rng, 17))
    texts += [prose(rng, 300), "license rights licensed without " + prose(rng, 40)]
    expected = set()
    for i, t in enumerate(texts):
        w = license_scan.words(t or "")
        for name, notice in license_scan.NOTICES:
            n = license_scan.words(notice)
            k = min(5, len(n))
            a, b = set(license_scan._shingle_words(n, k)), set(license_scan._shingle_words(w, k))
            if len(a & b) >= 0.8 * len(a):
                expected.add((i, name))
    got = license_scan.scan(docs_of(spark, texts))
    assert {(r.doc_id, r.license) for r in got.collect()} == expected and len(expected) > 20
    assert license_scan.scan(docs_of(spark, texts), notices=[("none", " ")]).count() == 0


def test_license_scan_names_the_best_per_place(spark):
    """Related wordings: each notice bears its own name only; two notices side by side are both found."""
    rng = random.Random(9)
    own = license_scan.NOTICES
    texts, expected = [], set()
    for name, t in own:
        expected.add((len(texts), name))
        texts.append(prose(rng, 40) + "\n" + t + "\n" + prose(rng, 90))
    long = {name: t for name, t in own if len(t.split()) > 60}  # the last, longest form of each
    assert {"MIT", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0"} <= set(long)
    for a, b in [("GPL-2.0", "GPL-3.0"), ("MIT", "Apache-2.0"), ("AGPL-3.0", "GPL-3.0"), ("BSD-2-Clause", "BSD-3-Clause")]:
        expected |= {(len(texts), a), (len(texts), b)}
        texts.append(long[a] + "\n" + prose(rng, 5) + "\n" + long[b])
    spelled = {"SPDX-License-Identifier: MIT": "MIT", "// SPDX-License-Identifier: MIT-0": "MIT-0", "licensed under the MIT license": "MIT",
               "# SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0", "Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0"}
    for t, name in spelled.items():
        expected.add((len(texts), name))
        texts.append(t)
    got = license_scan.scan(docs_of(spark, texts + [None, "", "x"]), best=True)
    found = {(r.doc_id, r.license) for r in got.collect()}
    assert found >= expected
    # what else is found stands there too: a short form inside a longer notice
    for i, name in found - expected:
        low = " ".join(license_scan.words(texts[i]))
        assert any(" ".join(license_scan.words(t)) in low for n, t in own if n == name), (texts[i], name)


def test_license_anchors_lose_nothing():
    chosen = license_scan.anchors(license_scan.NOTICES, 0.8)
    for _, t in license_scan.NOTICES:
        s = set(license_scan._shingle_words(license_scan.words(t)))
        assert sum(not any(a in x for a in chosen) for x in s) < 0.8 * len(s)


def winnowed(values, w):
    """Positions chosen by the definition: smallest of each window, rightmost of ties."""
    out = set()
    for i in range(max(1, len(values) - w + 1)) if values else ():
        win = values[i:i + w]
        out.add(i + max(j for j, v in enumerate(win) if v == min(win)))
    return sorted(out)


def test_winnowing_by_definition(spark, corpus):
    texts = corpus + ["a a a a a a a a a a", "b a b a b a b a b a b a"]
    df = docs_of(spark, texts).withColumn("c", F.expr(winnow.chosen_sql("coalesce(text, '')", 3, 4)))
    df = df.withColumn("g", F.expr(winnow._grams_sql("coalesce(text, '')", 3)))
    for r in df.collect():
        hashes = [x >> 23 for x in r.g]
        assert [winnow._POS - (x & winnow._POS) for x in r.c] == winnowed(hashes, 4)
        words = len((texts[r.doc_id] or "").split())
        assert len(r.g) == (max(1, words - 2) if words else 0)


def test_shared_runs_share_a_chosen_gram(spark):
    rng = random.Random(6)
    run = prose(rng, 6)  # k + w - 1 words
    rows = [(i, f"{prose(rng, 40)} {run} {prose(rng, 40)}") for i in range(20)]
    got = spark.createDataFrame(rows, "doc_id bigint, text string").select(F.expr(winnow.chosen_sql("text", 3, 4)).alias("c")).collect()
    sets = [{x >> 23 for x in r.c} for r in got]
    assert all(a & b for a in sets for b in sets)


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_edit_report(spark, corpus, buckets, monkeypatch):
    rng = random.Random(9)
    ids = rng.sample(range(-500, 10_000), len(corpus))
    df = spark.createDataFrame(list(zip(ids, corpus)), "doc_id bigint, text string")
    monkeypatch.setattr(winnow.with_next, "__defaults__", ("id", buckets, None))
    got = {r.doc_id: r for r in winnow.edit_report(df).collect()}
    order = sorted(ids)
    text = {i: t or "" for i, t in zip(ids, corpus)}
    assert len(got) == len(ids)
    prints = {}
    for i, n in zip(order, order[1:] + order[:1]):
        f = len(text[i]) // 2
        edited = text[i][:len(text[i]) - f] + text[n][:f]
        r = got[i]
        assert r.n_chars == len(text[i]) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(text[i], r.fingerprint) == r.fingerprint
        if text[i] == text[n]:
            assert r.near_next == 1
        a, b = ({h.split(":")[0] for h in x.split(",") if h} for x in (r.fingerprint, r.edited_fingerprint))
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    # the edited text's fingerprint is that of the same text as a document
    probe = spark.createDataFrame([(e, text[e][:len(text[e]) - len(text[e]) // 2] + text[n][:len(text[e]) // 2])
                                   for e, n in zip(order, order[1:] + order[:1])], "doc_id bigint, text string")
    for r in winnow.fingerprints(probe).collect():
        assert r.fingerprint == got[r.doc_id].edited_fingerprint


def test_edit_report_one_row_and_ties(spark):
    one = winnow.edit_report(spark.createDataFrame([(5, "abcd efgh")], "doc_id bigint, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    ties = winnow.edit_report(spark.createDataFrame([(5, "a b"), (5, "a b"), (5, "c"), (None, "d")], "doc_id bigint, text string"))
    assert ties.count() == 4


def test_chat_format_round_trip(spark):
    rng = random.Random(7)
    bits = ["<|im_end|>\n", "<|im_start|>user\n", "\\", "</s>[INST] ok [/INST]", "<\\/s>", "\x1f", "\n", "hello", "[\\INST]", "é"]
    say = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(0, 6)))
    rows, expected = [], {}
    for c in range(120):
        turns = [("system", "shared first turn")] if c % 3 else []
        turns += [("user", "same"), ("assistant", "reply")] if c % 2 else []
        turns += [(rng.choice(["user", "assistant", "to\nol", None, "<|im_end|>"]), rng.choice([say(), None])) for _ in range(rng.randrange(1, 5))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
        expected[c] = [(r or "", t or "") for r, t in turns]
    rows += [(500, 0, "user", "copy"), (501, 0, "user", "copy"), (None, 0, "assistant", "no id")]
    expected |= {500: [("user", "copy")], 501: [("user", "copy")], None: [("assistant", "no id")]}
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    convs = chat_tree.gather(df)
    for size in (256, 4):
        packs = chat_tree.pack(convs, pack_size=size)
        got = convs.select("conv", "leaf").join(chat_tree.read_back(packs), "leaf").collect()
        assert {r.conv: [tuple(t) for t in r.turns] for r in got} == expected
        for r in got:
            assert r.loss == [t for role, t in expected[r.conv] if role == "assistant"]
            assert r.formatted_chars == sum(len(chat_tree.format_turn(a, b)[0]) for a, b in expected[r.conv])


def test_chat_tree_shares_and_positions():
    a, b = [("user", "q"), ("assistant", "x")], [("user", "q"), ("assistant", "yy"), ("user", "z")]
    p = chat_tree.build_pack("p", [("A", a), ("B", b), ("C", a[:1]), ("N", [])])
    assert p["text"].count("q") == 1  # the shared turn is written once
    first, x, y, z = p["nodes"]
    assert first["position"] == 0 and x["position"] == y["position"] == first["stop"] == z["ancestors"][1]["start"] - (x["stop"] - x["start"])
    assert z["position"] == y["position"] + y["stop"] - y["start"] and [q["start"] for q in z["ancestors"]] == [first["start"], y["start"]]
    assert {v["leaf"]: v["node"] for v in p["leaves"]} == {"A": 1, "B": 3, "C": 0, "N": -1}
    assert p["text"][x["loss_start"]:x["loss_stop"]] == "x" and first["loss_start"] is None


def test_chat_ancestors_that_meet_are_one_interval():
    long = [("user", str(i)) for i in range(50)]
    p = chat_tree.build_pack("p", [("A", long), ("B", long[:20] + [("user", "other")])])
    assert max(len(n["ancestors"]) for n in p["nodes"]) == 1
    assert p["nodes"][-1]["ancestors"] == [{"start": 0, "stop": p["nodes"][19]["stop"]}]


def test_chat_packs_follow_shared_prefixes(spark):
    """A hot first turn, below it a hot second turn, small families and single conversations: families stay together."""
    rows = []
    for c in range(400):
        family = ["big"] if c < 150 else [f"family {c // 8}", "and its third turn"] if c < 300 else []
        rows += [(c, i, "user", t) for i, t in enumerate(["system", *family, f"own {c}"])]
    rows += [(c, 0, "user", "rare") for c in (900, 901)] + [(902, 0, "user", "rare"), (902, 1, "user", "more")]
    convs = chat_tree.gather(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string"))
    packs = chat_tree.pack(convs, pack_size=32).collect()
    whole = "".join(p.text for p in packs)
    for f in range(150 // 8 + 1, 300 // 8):
        assert whole.count(f"family {f}<") == 1
    assert whole.count("\nbig<") == -(-150 // 32) and whole.count("\nrare<") == 1
    assert whole.count("\nsystem<") <= -(-150 // 32) + -(-250 // 32)
    assert all(whole.count(f"own {c}<") == 1 for c in range(400)) and max(len(p.leaves) for p in packs) < 3 * 32
    by_chars = chat_tree.pack(convs, pack_size=1000, pack_chars=500).collect()
    assert max(len(p.text) for p in by_chars) < 10_000 and sum(len(p.leaves) for p in by_chars) == 402


@pytest.mark.parametrize("seed", range(4))
def test_word_hashes_do_not_depend_on_pieces(seed, monkeypatch):
    rng = random.Random(seed)
    text = "".join(rng.choice(["ab", " ", "\n", "ü", "  ", "x" * rng.randrange(1, 90)]) for _ in range(400))
    whole = common.hash_words(text.encode())
    monkeypatch.setattr(common, "_SEG", 37)
    cut = common.hash_words(text.encode())
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    assert len(whole[0]) == len(words) and len(set(whole[0].tolist())) == len({w.lower() for w in words})


def test_fits_take_no_more_rows_than_their_bound(spark, monkeypatch):
    """One id repeated 300 times is 300 rows; the fits see ``max_rows`` of them at most."""
    ids = [2] * 300 + list(range(3, 60))
    docs = spark.createDataFrame([(i, f"ein text mit worten {n}" if n % 2 else f"some text of words {n}", "de" if n % 2 else "en")
                                  for n, i in enumerate(ids)], "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality").distinct()
    seen = []
    with monkeypatch.context() as m:
        m.setattr(quality_gam, "fit", lambda x, y: seen.append(len(x)))
        m.setattr(langid, "fit", lambda x, y: seen.append(len(x)))
        quality_gam.train(docs, labels, max_rows=10)
        langid.train(docs, max_rows=10)
    assert len(seen) == 2 and max(seen) <= 10
