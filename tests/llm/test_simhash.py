import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marketlens.llm import simhash
from marketlens.llm.components import components

SMALL = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(fps, most=4):
    """fps: {id: fingerprint} -> {id: least id reachable}."""
    ids = sorted(fps)
    v = np.array([fps[i] for i in ids], np.uint64)
    out = {}
    for i in ids:
        if i in out:
            continue
        out[i], stack = i, [ids.index(i)]
        while stack:
            for j in np.flatnonzero(np.bitwise_count(v ^ v[stack.pop()]) <= most):
                if ids[j] not in out:
                    out[ids[j]] = i
                    stack.append(j)
    return out


@pytest.mark.parametrize("hot", [simhash.HOT, 1])
def test_links_join_what_brute_force_joins(spark, hot):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40).tolist()
    fps = {0}
    for b in base:
        for _ in range(30):
            x = b
            for bit in rng.choice(64, rng.integers(0, 6), replace=False).tolist():
                x ^= 1 << bit
            fps.add(x)
    fps |= {1, (1 << 64) - 1, 3 << 62}
    signed = {simhash._signed(x): x for x in fps}
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.node: r.component for r in components(simhash.links(df, hot=hot)).collect()}
    order = {x: i for i, x in enumerate(sorted(signed))}
    want = brute_components({order[s]: u for s, u in signed.items()})
    back = sorted(signed)
    assert {s: got.get(s, s) for s in signed} == {s: back[want[order[s]]] for s in signed}


def test_small_corpus_against_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows]
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "one"), (1004, "ONE"), (1005, "a b c d"),
             (1006, "é À a\x0bb"), (1007, "x " * 70_000), (1008, rows[3][1]), (1008, rows[3][1])]
    got = simhash.grouped(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fps = {d: brute_fingerprint(t) for d, t in rows}
    comp = brute_components(fps)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (d, f"{fps[d]:016x}", comp[d]) for d, _ in rows)


def test_one_row_of_each_component_stays(spark):
    schema = "doc_id long, text string, source string"
    rows = [(4, "same words here now", "a")] * 50 + [(4, "Same words  here now", "b"), (6, "same words here now", "c")]
    rows += [(4, "quite another text it is", "d"), (2, "quite another text it is", "e")]       # id 4 is no winner here
    rows += [(None, "same words here now", "f"), (None, "nobody else has this text", "g"), (None, "nobody else has this text", "g")]
    docs = spark.createDataFrame(rows, schema).repartition(5)
    kept = sorted((r.doc_id or -1, " ".join(r.text.lower().split())) for r in simhash.keep(docs, null_ids_stay=False).collect())
    assert kept == [(-1, "nobody else has this text"), (2, "quite another text it is"), (4, "same words here now")]
    with_null = sorted((r.doc_id or -1, r.source) for r in simhash.keep(docs).collect())
    assert [x for x in with_null if x[0] == -1] == [(-1, "f"), (-1, "g"), (-1, "g")]
    assert [x[0] for x in with_null if x[0] > 0] == [2, 4]


def test_nulls_empty_tables_and_clashing_names(spark):
    schema = "doc_id long, text string, fp string, component_id int, KEPT_DOC int"
    empty = spark.createDataFrame([], schema)
    assert simhash.grouped(empty).count() == 0 and simhash.keep(empty).count() == 0
    docs = spark.createDataFrame([(5, "same words here now", "p", 1, 2), (3, "same words here now", "q", 3, 4),
                                  (None, "same words here now", None, None, None), (9, "quite another text it is", "r", 0, 0)],
                                 schema)
    assert sorted((r.doc_id or -1, r.component_id) for r in simhash.grouped(docs).collect()) == [
        (-1, 3), (3, 3), (5, 3), (9, 9)]
    kept = simhash.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 9]


def test_links_and_components_are_no_two_python_steps_of_one_stage(spark, monkeypatch):
    seen, real = [], simhash.components

    def components(edges):
        seen.append(edges._jdf.queryExecution().executedPlan().toString())
        return real(edges)

    monkeypatch.setattr(simhash, "components", components)
    text = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(1, text), (2, text), (3, "something else altogether")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.grouped(df).collect()} == {(1, 1), (2, 1), (3, 3)}
    assert len(seen) == 1 and "MapInArrow" not in seen[0]


def test_steps_of_short_rows_are_written_in_few_files_and_only_own_values_are_counted(spark, monkeypatch):
    seen, real = {}, simhash.stored

    def stored(df, name, *args, **kwargs):
        seen[name] = df._jdf.queryExecution().optimizedPlan().toString(), real(df, name, *args, **kwargs)
        return seen[name][1]

    monkeypatch.setattr(simhash, "stored", stored)
    rows = [(i, f"text number {i // 2} has words of its own {i // 2 * 7919}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for run in (simhash.grouped, simhash.keep):
        seen.clear()
        run(docs).collect()
        assert len(seen["fingerprints"][1].inputFiles()) == 1
        assert seen["links"][0].startswith("RebalancePartitions")
    fps = spark.createDataFrame([(5, True)], "fp long, exact boolean")
    assert simhash._probes(fps, F.lit(0), 0, radii=False).count() == 3
    probes = simhash._probes(fps, F.lit(0), 0)
    assert probes.count() == 45 and probes.filter("exact").count() == 3
