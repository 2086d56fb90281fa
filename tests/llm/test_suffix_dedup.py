import hashlib
import random
import time
from pathlib import Path

import numpy as np
import pytest

from marketlens.llm import suffix_dedup as sd
from marketlens.llm.common import FREED, stored

L = 50


def brute(rows):
    first = {}
    for doc, text in rows:
        doc, raw = sd.LAST if doc is None else doc, (text or "").encode()
        for i in range(len(raw) - L + 1):
            w = raw[i:i + L]
            first[w] = min(doc, first.get(w, doc))
    out = []
    for doc, text in rows:
        own, raw = sd.LAST if doc is None else doc, (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - L + 1):
            if first[raw[i:i + L]] < own:
                gone[i:i + L] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((doc, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def _rows():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdeéü", k=rng.randrange(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(k) for k in (9, 12, 14, 20, 60)]
    exact = "".join(rng.choices("xyz", k=50))
    rows = [(i, text(30) + " " + rng.choice(passages) + " " + text(rng.randrange(0, 30)) + rng.choice(["", passages[4]]))
            for i in range(120)]
    rows += [(200, "p" + exact + "q"), (201, "r" + exact + "s"), (202, exact), (203, exact[:49]), (204, exact[1:] + "!"),
             (205, None), (206, ""), (207, "a" * 5000), (208, "a" * 300), (209, "ab" * 400), (210, "b" + "ab" * 60),
             (5, passages[4]), (5, passages[4]), (211, passages[4] * 40), (212, passages[4] + "z" + passages[3]),
             (None, passages[4]), (None, "null " + passages[3] * 2), (213, text(20_000)), (-7, passages[2] + passages[3])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_against_brute_force(spark, batches, monkeypatch):
    monkeypatch.setattr(sd.marks, "__defaults__", (batches,))
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = [tuple(r) for r in sd.report(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_levels_merge_geometrically(spark):
    df = spark.createDataFrame([(i, i, f"{i} words ".encode() * 20 + b"the passage that all of the documents here share, all of it")
                                for i in range(40)], "doc long, rk long, text binary")
    found = sd.repeats.seen_twice(df.select("text"), sd._anchor_hashes, sd.repeats.MIN_BITS)
    family = sd.IndexFamily(spark, found, 4)
    sizes = []
    for i in range(4):
        got = family.add(df.filter(f"doc between {10 * i} and {10 * i + 9}")).select("doc").distinct().count()
        assert got == (9 if i == 0 else 10)
        sizes.append([n for n, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4]]


def test_keep_leaves_other_columns_and_valid_text(spark):
    shared = "é" * 40
    schema = "doc_id long, text string, n_chars long, suffix_doc int, kept string"
    df = spark.createDataFrame([(1, "x" + shared, 41, 1, "k"), (2, "tail é " + shared + " end", 51, 2, "l"),
                                (3, "quite another", 13, 3, "m")], schema)
    out = sd.keep(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text == "x" + shared and rows[3].text == "quite another"
    assert rows[2].text == "tail é  end" and rows[2].n_chars == 11 and rows[2].kept == "l"
    assert sd.keep(df.limit(0)).count() == 0 and sd.report(df.limit(0)).count() == 0


def _headed(n):
    rng = random.Random(4)
    noise = lambda k: "".join(rng.choices("abcdefghijklmnop", k=k))
    rows = [(i, noise(40) + "== a header of all pages of one site, by date ==" + noise(40)) for i in range(n)]
    shared = noise(70) + "== a header of all pages of one site, by date ==" + noise(70)
    return rows + [(n + i, noise(9) + shared[i:i + 120]) for i in range(20)] + [(7, shared), (None, shared * 2)]


def test_a_frequent_anchor_is_dealt_by_window(spark, monkeypatch):
    monkeypatch.setattr(sd, "HOT", 5)
    rows, shards = _headed(400), 16
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = df.selectExpr("coalesce(doc_id, 0) AS doc", "xxhash64(text) AS rk", "CAST(text AS binary) AS text")
    found = sd.repeats.seen_twice(texts.select("text"), sd._anchor_hashes, sd.repeats.MIN_BITS, sd.HOT)
    held = [0] * shards
    for r in texts.mapInArrow(sd._suspects(found, shards), sd.ROWS).filter("blob IS NOT NULL").collect():
        held[r.shard] += sum(len(t) - L + 1 for t in sd._unpacked(r.blob)["text"].to_pylist())
    assert max(held) < 3 * sum(held) / shards
    got = [tuple(r) for r in sd.report(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("batches", [1, 3])
def test_windows_dealt_alone_against_brute_force(spark, batches, monkeypatch):
    monkeypatch.setattr(sd.marks, "__defaults__", (batches,))
    monkeypatch.setattr(sd, "HOT", 3)
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = [tuple(r) for r in sd.report(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in Path(d).rglob("shuffle_*.data")}


def test_what_is_stored_leaves_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(FREED)
    out = stored(spark.range(1000).repartition(3, "id"), "freed", freed=True)
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(FREED) == setting
    assert out.count() == 1000


def test_the_last_join_moves_a_text_once(spark):
    df = spark.createDataFrame(_rows()[:20], "doc_id long, text string")
    plan = sd.dedup(df)[0]._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    columns = plan.left().output()
    moved = [columns.apply(i).dataType().simpleString() for i in range(columns.size())]
    assert sorted(moved) == ["bigint", "bigint", "bigint", "string"]
