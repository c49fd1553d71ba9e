"""The pipeline against brute force, stage by stage, and the registered queries."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_mod
import corpus_pipeline
from bramble.llm import queries, simhash
from bramble.llm.shared import write_shared
from conftest import SF_MID, SF_SMALL
from helpers import components, documents, fingerprint, odd_rows, without_repeats
from oracle_harness import compare, duck
from test_html_pack_code import check_pieces
from test_line_pairs import brute_all_pairs


def test_stages_equal_brute_force(spark):
    sf = SF_SMALL
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = write_shared(stage(spark, docs, sf), f"test-{name}")
        out[name] = docs
        if name != "packing":
            assert docs.columns == columns
    texts = {n: {r.doc_id: r.text for r in df.collect()} for n, df in out.items() if n != "packing"}
    scored = queries.op4_quality_classifier(spark, sf).collect()
    assert set(texts["quality_classifier"]) == {r.doc_id for r in scored if r.predicted == 1}
    assert texts["line_dedup"] == brute_all_pairs(texts["quality_classifier"])
    fps = {d: fingerprint(t) for d, t in texts["line_dedup"].items()}
    group = components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    assert texts["simhash_near_dedup"] == {d: t for d, t in texts["line_dedup"].items() if group[d] == d}
    want = without_repeats(texts["simhash_near_dedup"], 50)
    assert {d: hashlib.sha256(b" ".join(t.encode().split())).hexdigest() for d, t in texts["substring_dedup"].items()} == {
        d: w[2] for d, w in want.items()}
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = out["packing"].collect()
    check_pieces(list(texts["substring_dedup"].items()), got, lambda s: t.encode(s, add_special_tokens=False).ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, got))


def test_stages_take_odd_rows(spark):
    docs = documents(spark, odd_rows())
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = write_shared(stage(spark, docs, SF_SMALL), f"odd-{name}")
        if name != "packing":
            assert docs.columns == columns
    assert docs.count() > 0
    empty = documents(spark, odd_rows()).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_good_documents_stay(spark):
    labels = dict(duck(SF_MID).execute("select doc_id, quality from labels").fetchall())
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.classify_quality(spark, docs, SF_MID).select("doc_id").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)


@pytest.mark.parametrize("key", sorted(queries.QUERIES))
def test_queries_cover_whole_tables(spark, key):
    got = entry_mod.queries()[key](spark, SF_SMALL)
    of = {"op2": "count(*) from pages", "op11": "count(distinct lang) from documents", "op13": "count(distinct conv_id) from conversations"}
    n = duck(SF_SMALL).execute(f"select {of.get(key.split('_')[0], 'count(*) from documents')}").fetchone()[0]
    rows = got.collect()
    distinct = {"op6": "doc_id", "op11": "lang"}.get(key.split("_")[0])
    assert (len({r[distinct] for r in rows}) if distinct else len(rows)) == n


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_oracle(spark, key):
    df = entry_mod.queries()[key](spark, SF_MID)
    rel = duck(SF_MID).execute(entry_mod.oracle_sql()[key])
    cols = [d[0] for d in rel.description]
    ok, msg = compare([r.asDict() for r in df.collect()], df.columns, [dict(zip(cols, r)) for r in rel.fetchall()], cols)
    assert ok, msg


def test_contract_names():
    names = set(entry_mod.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names if x.startswith("op")} and "pipeline" in names


def test_near_duplicate_stage_broadcasts_no_multiplied_rows(spark, monkeypatch):
    """Its anchors are a hundred rows for each fingerprint, which the planner cannot know."""
    seen, whole = [], simhash.connected_components
    monkeypatch.setattr(simhash, "connected_components", lambda edges: seen.append(edges) or whole(edges))
    assert corpus_pipeline.drop_near_duplicates(spark, documents(spark, odd_rows()), "").count() > 5
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
