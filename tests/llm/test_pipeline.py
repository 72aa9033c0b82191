"""The corpus pipeline against a brute-force version, stage by stage, and its corner cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from kairos.llm import decontaminate, quality_gam, queries, spiece
from tests.llm.test_operators import jaccard_groups, removed_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """sf0.001 plus nulls, blanks, repeated rows, copies and clashing columns."""
    d = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.limit(40).collect()
    more = [(10_000 + i, t, None, None, None) for i, t in enumerate([None, "", " \n", "x", rows[0].text, rows[1].text + " tail"])]
    more += [(None, "a row without an id", "en", "s", 1)]
    docs = (docs.unionByName(spark.createDataFrame(more, docs.schema)).unionByName(docs.where("doc_id = 3"))
            .withColumns({c: F.lit("own") for c in ("score", "predicted", "hits", "n_lines", "n_removed", "id", "h", "prefix")}))
    docs.write.parquet(f"{d}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    return d


def test_stages_equal_brute_force(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = sorted(docs.collect(), key=str)
        stage(spark, docs, tables).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        if k < 4:
            assert docs.columns == columns, name
            assert all(r.score == r.predicted == r.id == "own" for r in after)
        got = sorted(((r.doc_id, r.text) for r in after), key=str) if k < 4 else []
        texts = [(r.doc_id, r.text) for r in before]
        if k == 0:
            model = quality_gam.train(spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet"))
            keep = model.score(np.array([quality_gam.features(t) for _, t in texts])) >= 0.5
            assert got == sorted((x for x, ok in zip(texts, keep) if ok), key=str)
        elif k == 1:
            order = sorted((x for x in texts if x[0] is not None), key=lambda x: x[0])
            alone = [x for i, x in enumerate(order) if i == 0 or x != order[i - 1]]  # repeated rows don't remove each other
            gone = removed_lines([t for _, t in alone])
            for doc, text in got:
                i = next((i for i, x in enumerate(alone) if x[0] == doc), None)
                if i is not None and alone[i][1]:
                    assert text == "\n".join(x for j, x in enumerate(alone[i][1].split("\n")) if (i, j) not in gone)
        elif k == 2:
            known = [x for x in texts if x[0] is not None]
            group = jaccard_groups([t for _, t in known], 5, 4, 5)
            low = {}
            for (doc, _), (_, c) in zip(known, group):
                low[c] = min(low.get(c, doc), doc)
            assert got == sorted([x for x, (_, c) in zip(known, group) if low[c] == x[0]] + [x for x in texts if x[0] is None], key=str)
        elif k == 3:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
            clean = []
            for x in texts:
                w = decontaminate._words([x[1]])[0]
                hit = False
                for _, t in items:
                    v = decontaminate._words([t])[0]
                    need = min(13, len(v))
                    for d in range(-len(v) + need, len(w) - need + 1):
                        a, b = max(0, d), min(len(w), d + len(v))
                        total = np.concatenate(([0], np.cumsum(w[a:b] == v[a - d:b - d])))
                        hit = hit or len(v) >= decontaminate.SPAN and b - a >= need and (total[need:] - total[:-need]).max() >= 0.8 * need
                    if hit:
                        break
                if not hit:
                    clean.append(x)
            assert got == sorted(clean, key=str) and len(clean) < len(texts)
        else:
            sp = spiece.load(queries.tokenizer_file("piece_bpe_32k.model"))
            ids = {r.doc_id: sp.encode(r.text or "", add_bos=True, add_eos=True) for r in before}
            assert {r.doc_id: np.frombuffer(r.packed_ids, "<u4").tolist() for r in after} == ids
            assert all(r.n_tokens == len(ids[r.doc_id]) and r.decoded == sp.decode(ids[r.doc_id]) for r in after)


def test_line_stage_drops_only_emptied_documents(spark):
    """Surviving ids against brute force: a document with any word left stays, whatever its lines' lengths."""
    shared = "one shared boilerplate line of text"
    own = [(1, shared), (2, shared + "\nnobody else\nhas this"), (3, shared + "\n \t\r\n"), (4, "\n" + shared), (5, ""), (6, "two\nwords")]
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    texts += [(1_000_000 + i, t) for i, t in own]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    lost = removed_lines([t for _, t in texts])
    left = {}
    for i, (doc, t) in enumerate(texts):
        kept = "\n".join(x for j, x in enumerate(t.split("\n")) if (i, j) not in lost)
        if kept == t or kept.strip(" \t\r\n"):
            left[doc] = kept
    assert {1_000_001, 1_000_002, 1_000_005, 1_000_006} <= set(left) and not {1_000_003, 1_000_004} & set(left)
    assert {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, docs, SF).collect()} == left


def test_stages_take_empty_tables(spark, tables):
    empty = spark.read.parquet(f"{tables}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tables).count() == 0


def test_registered(spark):
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert entry.queries()["pipeline"](spark, SF).count() > 50


@pytest.mark.parametrize("name", ["op1_ngram_jaccard_join", "op7_chat_format", "op9_line_dedup"])
def test_queries_match_duckdb(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(entry.oracle_sql()[name])
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == sorted((tuple(dict(zip(rel.columns, r))[c] for c in cols) for r in rel.fetchall()), key=str)
