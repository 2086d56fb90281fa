import hashlib
import random
import zlib

import duckdb
import pytest

from marketlens.llm import merkle
from tests.oracle import rows_of

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return _h(*map(enc, row))


def _paths(nodes):
    """Top of the tree, and each leaf's list of (left, right) by levels."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, p in enumerate(paths):
            a = at[i] - at[i] % 3
            p.append((level[a:at[i]], level[at[i] + 1:a + 3]))
            at[i] //= 3
        level = [_h(*level[a:a + 3]) for a in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[s] = (own, *_paths([_leaf(r) for r in own]))
    if not names:
        return []
    root, tops = _paths([trees[s][1] for s in names])
    out = []
    for s, high in zip(names, tops):
        own, sub, paths = trees[s]
        for r, low in zip(own, paths):
            path = low + high
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            h = _leaf((*r[:4], r[4].replace("\n", ""))) if hit else _leaf(r)
            for left, right in path:
                h = _h(*left, h, *right)
            out.append((r[0], _leaf(r), sub, root, _h(*[x for a, b in path for x in a + b]), h, h == root))
    return out


def _rows(n, seed=5):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot"] * 3 + ["a", "b", "ü", "Z", None]), rng.choice(["en", None]), rng.randrange(99),
             f"text\nof {i}" if i % 3 else f"one line of {i}") for i in range(n)]
    rows += [(None, "hot", None, None, "a\nb"), (None, None, "de", 1, None), (7, "hot", "en", 5, "again\n7"),
             (8, "lone", "en", 0, ""), (9, "long", "en", 400_000, "ab\n" * 133_000)]
    return rows + [rows[3], rows[3], (10, "", "", 1, "-"), (11, "x:y", "2:ab", 1, "1:\n")]


def _key(r):
    return tuple("" if v is None else str(v) for v in r)


def _got(spark, rows, parts=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in merkle.manifest(df).collect()), key=_key)


def test_against_brute_force(spark):
    rows = _rows(400)
    assert _got(spark, rows) == sorted(brute(rows), key=_key)


@pytest.mark.parametrize("levels", [1, 2])
def test_many_rounds_of_groups(spark, monkeypatch, levels):
    """Small groups: the tops of groups are folded by further rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "SPAN", merkle.RUN ** levels)
    rows = _rows(60 if levels == 1 else 150)
    assert _got(spark, rows) == sorted(brute(rows), key=_key)


def test_many_sources_and_small_tables(spark):
    for rows in ([], [(1, "a", "en", 1, "x")], [(None, None, None, None, None)] * 2,
                 [(i, f"s{i:03}", "en", i, "l\n") for i in range(100)]):
        assert _got(spark, rows) == sorted(brute(rows), key=_key)


def test_tampering_shows(spark):
    out = merkle.manifest(spark.createDataFrame(_rows(100), SCHEMA)).collect()
    for r in out:
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
        assert r.verified == (r.folded_root == r.root) and (r.verified or hit)
    assert any(not r.verified for r in out)


def test_sql_is_the_same(spark, tmp_path):
    df = spark.createDataFrame(_rows(120), SCHEMA)
    df.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}).to_parquet(tmp_path / "d.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d.parquet')")
    res = con.execute(merkle.manifest_sql())
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    out = merkle.manifest(df)
    assert sorted(rows_of(out.columns, [tuple(r) for r in out.collect()]), key=_key) == sorted(want, key=_key)


def test_extra_columns_are_ignored(spark):
    rows = _rows(30)
    df = spark.createDataFrame([(*r, "x", 1, "y", 3) for r in rows],
                               SCHEMA + ", leaf string, slot int, tree string, `h0.x` int")
    assert sorted((tuple(r) for r in merkle.manifest(df).collect()), key=_key) == sorted(brute(rows), key=_key)
