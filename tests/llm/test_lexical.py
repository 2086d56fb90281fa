import math
import random
import re
from collections import Counter

import duckdb
import pytest

from marketlens.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    bags = [(d, Counter(_terms(t))) for d, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            n = sum(b.values())
            s = 0
            for t, k in Counter(_terms(text)).items():
                if t in b:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += k * w * (10**9 * b[t] // (1000 * b[t] + 8 * (25 + 75 * n * n_docs // n_terms)))
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores)[:10])]
    return out


WORDS = [f"w{i}" for i in range(150)] + ["Éa", "ÉA", "éa", "naïve", "x1", "The", "THE", "ſ", "K"]


def _docs(n=400, seed=1):
    rng = random.Random(seed)
    docs = [(i, rng.choice(" -_\n\t").join(rng.choices(WORDS, [1 / (k + 1) for k in range(len(WORDS))], k=rng.randrange(0, 40))))
            for i in range(n)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)]                                       # ties
    return docs + [(None, docs[5][1]), (3, docs[5][1]), (2001, None), (2002, ""), (2003, "w1 " * 60_000 + "w140"), docs[7], docs[7]]


def _items(n=20, seed=2):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(1, 30)))) for i in range(n)]
    return items + [(n, " ".join(WORDS)), (n + 1, " ".join(f"w{i} absent{i}" for i in range(140))), (n + 2, None), (n + 3, "!?"),
                    (n + 4, "absent"), (4, "w3 w3 w3 w9"), (None, "w2 The")]


def _key(r):
    return tuple((v is None, v or 0) for v in r)


def _got(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in lexical.search(d, i, **kw).collect()), key=_key)


def test_against_brute_force(spark):
    docs, items = _docs(), _items()
    assert _got(spark, docs, items) == sorted(brute(docs, items), key=_key)


@pytest.mark.parametrize("block", [4, 10_000])
def test_blocks_of_items_and_of_documents(spark, monkeypatch, block):
    docs, items = _docs(120), _items(8)
    want = sorted(brute(docs, items), key=_key)
    assert _got(spark, docs, items, block=block) == want


def test_groups_are_left_out_only_below_the_tenth_score():
    """Many blocks and single-group steps give the brute-force result, and not every group is scored."""
    import numpy as np
    import pyarrow as pa

    docs, items = _docs(500, 7), _items(30, 8)
    bags = [(d, Counter(_terms(t))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    counted = [Counter(_terms(t)) for _, t in items]
    vocabulary = {t: i for i, t in enumerate(sorted({t for c in counted for t in c}))}
    df = np.zeros(len(vocabulary), np.int64)
    for _, b in bags:
        for t in b:
            if t in vocabulary:
                df[vocabulary[t]] += 1
    rows = [(d, sum(b.values()), *zip(*sorted((vocabulary[t], k) for t, k in b.items() if t in vocabulary))) for d, b in bags]
    rows = [r if len(r) == 4 else (*r, (), ()) for r in rows]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([list(r[2]) for r in rows], pa.list_(pa.int32())), pa.array([list(r[3]) for r in rows], pa.list_(pa.int64()))],
        names=["doc_id", "n", "terms", "tfs"])
    block = lexical.Block([batch], lexical.weight(n_docs, df), n_docs, n_terms)
    scored, exact = [], block.exact
    block.exact = lambda docs, *a: scored.append(len(docs)) or exact(docs, *a)
    out = []
    for (item, _), c in zip(items, counted):
        top, scores = block.best(Counter({vocabulary[t]: k for t, k in c.items()}))
        out += [(item, i + 1, docs[d][0], int(s)) for i, (d, s) in enumerate(zip(top, scores))]
    assert sorted(out, key=_key) == sorted(brute(docs, items), key=_key)
    assert sum(scored) < len(docs) * len(items) / 2


def test_empty_tables(spark):
    docs, items = _docs(20), _items(2)
    assert _got(spark, [], items) == [] == _got(spark, docs, [])
    assert _got(spark, [(1, None), (2, "...")], items) == []


def test_extra_columns_are_ignored(spark):
    docs, items = _docs(50), _items(5)
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, `a.b` int, score string")
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    assert sorted((tuple(r) for r in lexical.search(d, i).collect()), key=_key) == sorted(brute(docs, items), key=_key)


def test_sql_is_the_same(spark, tmp_path):
    docs, items = _docs(150), _items(10)
    con = duckdb.connect()
    for name, rows, schema in (("documents", docs, "doc_id long, text string"), ("benchmark", items, "item_id long, text string")):
        key = schema.split()[0]
        spark.createDataFrame(rows, schema).toPandas().astype({key: "Int64"}).to_parquet(tmp_path / f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet')")
    assert sorted(con.execute(lexical.search_sql()).fetchall(), key=_key) == _got(spark, docs, items)


def test_long_texts_are_split_alike(monkeypatch):
    text = _docs()[-3][1] or "a b"
    whole = list(lexical.terms(text))
    monkeypatch.setattr(lexical, "LONG", 8)
    assert list(lexical.terms(text)) == whole
