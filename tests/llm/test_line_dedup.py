import hashlib
import random

import duckdb

from marketlens.llm import line_dedup, repeats

SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    first = {}
    held = {}
    for doc, text in rows:
        doc = line_dedup.LAST if doc is None else doc
        for line in (text or "").split("\n"):
            k = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
            if len(k) >= 10:
                held.setdefault(k, set()).add(doc)
                first[k] = min(doc, first.get(k, doc))
    out = []
    for doc, text in rows:
        own = line_dedup.LAST if doc is None else doc
        lines, stay = (text or "").split("\n"), []
        for line in lines:
            k = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
            if len(k) < 10 or len(held[k]) < 2 or own == first[k]:
                stay.append(line)
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


ROWS = [(3, "A shared line here\nown line of three\n  a SHARED line here\t"), (1, "a shared line here \nx\n"),
        (2, "tiny\ntiny\ntiny"), (4, "tiny"), (5, None), (6, ""), (None, "a shared line here\nnull's own line"),
        (7, "ÀÉ shared accents\n"), (8, "àé shared accents\nÀÉ SHARED accents"), (9, " a shared line here"),
        (1, "second row of document one\na shared line here"), (10, "y" * 200_000 + "\nA SHARED LINE HERE"),
        (11, "\n".join(["a line that one document repeats"] * 50)), (12, "123456789\n1234567890"), (13, "1234567890\n123456789")]


def test_against_brute_force(spark):
    rng = random.Random(3)
    pool = [f"common line number {i}" for i in range(60)]
    rows = ROWS + [(100 + i, "\n".join(rng.choices(pool, k=rng.randrange(1, 12)) + [f"own {i} {rng.random()}"]))
                   for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = [tuple(r) for r in line_dedup.report(df).collect()]
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(rows)]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_full_filters_only_add_suspects(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MAX_BITS", repeats.CHUNK_BITS)
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert sorted(r.n_dropped for r in line_dedup.report(df).collect()) == sorted(x[2] for x in brute(ROWS))


def test_lost_keys_are_listed_by_text(spark):
    rows = [(1, "\n".join(f"a common line, number {i}" for i in range(200)))]
    rows += [(None, f"a common line, number {i}\nown line of row {i}") for i in range(200)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lost = line_dedup.repeated_keys(df.selectExpr(f"coalesce(doc_id, {line_dedup.LAST}) AS doc", "xxhash64(text) AS rk", "text"),
                                    *("doc", "rk", "text"))
    assert sorted(len(r["keys"]) for r in lost.collect()) == [1] * 200
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(rows)]
    assert sorted((tuple(r) for r in line_dedup.report(df).collect()), key=key) == sorted(want, key=key)


def test_keep_leaves_other_columns(spark):
    schema = "doc_id long, text string, n_chars long, line_doc int, kept string, `a.b` int"
    df = spark.createDataFrame([(2, "one same line\nrest", 18, 1, "k", 3), (1, "one same line", 13, 2, "l", 4)], schema)
    out = line_dedup.keep(df)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, "one same line", 13, 2, "l", 4), (2, "rest", 4, 1, "k", 3)]
    assert line_dedup.keep(df.limit(0)).count() == 0


def test_sql_says_the_same(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = con.execute(line_dedup.report_sql()).fetchall()
    names = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
    got = [tuple(r[c] for c in names) for r in line_dedup.report(df).collect()]
    assert sorted(map(str, got)) == sorted(str((None if a != a else a, *r)) if a is None else str((int(a), *r))
                                           for a, *r in want)
