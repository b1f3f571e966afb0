"""The registered queries: with SQL against DuckDB, else against their own contract."""

import math
import os
import re
import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from basketweave.llm.queries import DRILL, QUERIES, SQL
from tests.llm.test_minhash import groups
from tests.llm.test_pii import spans

SF_DIR = os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not found")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries().keys()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= names and SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(found.columns) == sorted(names)
    expected = sorted(map(str, result.fetchall()))
    assert sorted(str(tuple(r[n] for n in names)) for r in found.collect()) == expected


def test_op1(spark, duck, texts):
    """Whole items in documents are found, and nothing that is far from an item."""
    from basketweave.llm.decontaminate import normalise

    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    rows = QUERIES["op1_decontamination"](spark, SF_DIR).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    plain = {d: normalise(t) for d, t in texts.items()}
    whole = {(d, i) for d, t in plain.items() for i, x in items if normalise(x) and normalise(x) in t}
    assert whole == {(r["doc_id"], r["item_id"]) for r in rows if r["distance"] == 0} and whole <= found


def test_op2(spark, texts):
    rows = QUERIES["op2_near_duplicates"](spark, SF_DIR).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == groups(texts)


def test_op3(spark, texts):
    rows = QUERIES["op3_pii"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = spans(texts[r["doc_id"]])
        assert r["base_sha256"] == sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        for kind in ("email", "ip", "card", "phone"):
            assert r[f"n_{kind}"] == base.count(f"{kind}:")


def test_op4(spark, duck):
    data = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, vectors = np.array([i for i, _ in data]), np.array([v for _, v in data], float)
    near = {}
    for r in QUERIES["op4_neighbours"](spark, SF_DIR).collect():
        near.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    hits = []
    for q in ids[ids % 20 == 0]:
        scores = vectors @ vectors[ids == q][0]
        best = [ids[j] for j in np.lexsort((ids, -scores)) if ids[j] != q][:20]
        hits.append(len(near[q].keys() & set(best)) / 20)
        assert all(math.isclose(s, scores[ids == i][0], rel_tol=1e-12) for i, s in near[q].items())
    assert len(near) == len(hits) and np.mean(hits) >= 0.9


def test_op5_and_op9(spark, duck, texts):
    lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    for name, folds, out in (("op5_toxicity", 3, 1), ("op9_language", 4, 2)):
        rows = QUERIES[name](spark, SF_DIR).collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(texts)
        for r in rows:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == out)
            assert 0 <= r["score"] <= 1
            if name == "op5_toxicity":
                assert r["predicted"] == (r["score"] >= 0.7)
        if name == "op9_language":
            right = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"] and lang[r["doc_id"]]]
            assert np.mean(right) > 0.95


def test_op6(spark, texts):
    rows = sorted(QUERIES["op6_token_files"](spark, SF_DIR).collect(), key=lambda r: r["doc_id"])
    check_tokens(rows, sorted(texts.items()))


def check_tokens(rows, pairs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for r, (doc_id, text) in zip(rows, pairs, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, start, len(ids), crc)
        start += len(ids)


def test_op12(spark, texts):
    from tests.llm.test_align import brute_force

    rows = sorted(QUERIES["op12_token_alignment"](spark, SF_DIR).collect(), key=lambda r: r["doc_id"])
    ids = sorted(texts)
    assert [r["doc_id"] for r in rows] == ids
    short = [(r, texts[r["doc_id"]]) for r in rows if len(texts[r["doc_id"]] or "") < 1500]
    for (r, _), want in zip(short, brute_force([t for _, t in short]), strict=True):
        # The counts are of the whole corpus, so they are no less than those of the short texts.
        assert all(r[k] == want[k] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"))
        assert r["count_sum"] >= want["count_sum"] and r["n_best"] <= r["n_links"]


def test_op13(spark, duck, texts):
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL").fetchall())
    rows = QUERIES["op13_quality"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    right = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] in labels:
            right.append(r["predicted"] == labels[r["doc_id"]])
    assert np.mean(right) > 0.9


def test_pipeline_on_odd_tables(spark, tmp_path, vocabulary):
    """Nulls in every column, repeated ids and rows, a very long text, a further column; no rows."""
    from tests.llm.conftest import documents, with_clashes

    prose = [" ".join(vocabulary[30 * i : 30 * i + 30]) for i in range(12)]
    rows = [*enumerate(prose), (None, None), (None, prose[0] + " x"), (3, "another text under the id"), (40, ""), (41, None)]
    rows += [(50, " ".join(f"long{i}" for i in range(50_000))), (51, prose[1]), (52, "you idiot moron loser"), (7, prose[7])]
    docs = with_clashes(documents(spark, rows))
    labels = "doc_id BIGINT, quality INT, toxic INT"
    for name, frame in (("some", docs), ("none", docs.limit(0))):
        folder = f"{tmp_path}/{name}"
        frame.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(0, 1, 0), (52, 0, 1), (None, 1, 1), (3, None, None)], labels).write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(0, prose[4]), (1, None), (None, prose[5])], "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
        out = [(r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.run(spark, folder).collect()]
        if name == "none":
            assert out == []
            continue
        ids = [i for i, _ in out]
        assert {0, 1, 2, 3, 5, 6, 7, 8, 9, 10, 11, 40, 41, 50, None} <= set(ids)
        assert 51 not in ids and 4 not in ids
        assert min(n for i, n in out if i == 50) > 50_000


def test_op10(spark):
    rows = QUERIES["op10_warc_audit"](spark, SF_DIR).collect()
    assert len({r["page_id"] for r in rows}) == len(rows) > 0
    for r in rows:
        assert r["intact"] == (zlib.crc32(str(r["page_id"]).encode()) % DRILL != 0)


def test_pipeline(spark, duck, texts):
    """Each stage against a plain version of it, on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ws = __import__("basketweave").Workspace(spark)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = ws.write(name, stage(spark, docs, SF_DIR)).df
        if name != "token_output":
            assert out.columns == docs.columns
        kept[name], docs = [r.asDict() for r in out.collect()], out
    ids = {n: [r["doc_id"] for r in rows] for n, rows in kept.items()}
    toxic = {r["doc_id"] for r in QUERIES["op5_toxicity"](spark, SF_DIR).collect() if r["predicted"]}
    assert set(ids["toxicity"]) == texts.keys() - toxic
    group = groups({d: texts[d] for d in ids["toxicity"]})
    assert sorted(ids["near_dedup"]) == sorted(d for d, g in group.items() if d == g)
    dirty = {r["doc_id"] for r in QUERIES["op1_decontamination"](spark, SF_DIR).collect()}
    assert set(ids["decontamination"]) == set(ids["near_dedup"]) - dirty
    assert set(ids["mixing"]) == set(ids["decontamination"])
    copies = max(ids["mixing"].count(d) for d in ids["mixing"])
    assert copies <= math.ceil(corpus_pipeline.REPEATS)
    rows = sorted(kept["token_output"], key=lambda r: r["start"])
    check_tokens(rows, sorted((d, texts[d]) for d in ids["mixing"]))
    whole = [tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()]
    assert sorted(whole) == sorted(tuple(r.values()) for r in kept["token_output"])
