import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from check import TABLES, compare
from llm import queries
from test_jaccard import shingles

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not Path(SF_DIR).exists():
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_its_sql_twin(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_every_operator_has_a_query():
    names = set(entry_module.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and set(queries.queries()) <= names


def test_stages(spark, con):
    docs = corpus_pipeline.documents(spark, SF_DIR)
    before = {r.doc_id: r.text for r in docs.collect()}
    columns, kept = docs.columns, [set(before)]
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == columns
        found = docs.collect()
        assert all(before[r.doc_id] == r.text for r in found)
        kept.append({r.doc_id for r in found})
        assert len(found) == len(kept[-1]) and kept[-1] <= kept[-2]
    _, good, distinct, apart, mixed = kept
    judged = {r.doc_id for r in queries.op1_quality_rules(spark, SF_DIR).filter("kept").collect()}
    assert good == judged
    plain = {}
    for i in good:
        plain.setdefault(re.sub(r"[\x20\x09-\x0D]", "", before[i]), []).append(i)
    assert distinct == {min(v, key=lambda i: (-len(before[i]), i)) for v in plain.values()}
    sets = {i: shingles(before[i]) for i in distinct}
    linked = {(a, b) for a in distinct for b in distinct if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0}
    least = {i: i for i in distinct}
    for _ in range(len(distinct)):
        for a, b in linked:
            least[a] = least[b] = min(least[a], least[b])
    assert apart == set(least.values()) and mixed == apart
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == mixed
    assert sum(r.length for r in packed) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", before[i])) for i in mixed)


def test_run_returns_the_bins(spark, con):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert set(found.columns) == {"doc_id", "piece", "start", "length", "shard", "bin", "place"} and found.count() > 50


def test_bins_follow_the_mixture(docs, monkeypatch):
    """Sources differ; the packed rows do, too, when the weights do, and shards are ranges of the mixture."""
    frame = docs([(i, f"w{i} " * (1 + i % 9)) for i in range(9000)], ["a", "b", "c"])
    shards = {}
    for name, weights in (("even", {"a": 1, "b": 1, "c": 1}), ("a first", {"a": 98, "b": 1, "c": 1})):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", weights)
        ordered = [r.doc_id for r in corpus_pipeline.source_mixing(frame.sparkSession, frame, "").collect()]
        found = corpus_pipeline.best_fit_packing(frame.sparkSession, frame, "").collect()
        shards[name] = {r.doc_id: (r.shard, r.bin, r.place) for r in found}
        assert set(shards[name]) == set(range(9000))
        at = {d: n for n, d in enumerate(ordered)}
        by_shard = [sorted(at[d] for d, k in shards[name].items() if k[0] == s) for s in sorted({k[0] for k in shards[name].values()})]
        assert len(by_shard) >= 3 and [n for own in by_shard for n in own] == list(range(9000))
        held = {}
        for d, (s, b, place) in shards[name].items():
            held.setdefault((s, b), []).append((place, at[d]))
        assert all(sorted(v) == [(n, p) for n, p in enumerate(sorted(p for _, p in v))] for v in held.values())
    assert shards["even"] != shards["a first"]
    first = {name: sum(k[0] == 0 and d % 3 == 0 for d, k in own.items()) for name, own in shards.items()}
    assert first["a first"] > 1.5 * first["even"]
