import duckdb

from marketlens.llm import quality_rules, quality_sql


def _rows():
    rows = [(i, f"plain words of document {i} " + " ".join(f"w{j * 7 + i}" for j in range(60)), "en", "s1")
            for i in range(150)]
    rows += [(200 + i, " ".join(f"w{j}x{i}###" for j in range(60)), "en", "s1") for i in range(20)]
    rows += [(300, None, "en", "s1"), (301, "", None, None), (302, " \n\t ", "de", None), (303, "short text", "de", "s2"),
             (304, "same three words " * 40, "en", "s1"), (305, "repeat these lines now\n" * 30, None, "s1"),
             (306, " ".join(f"z{i}" for i in range(20_000)), "en", "s1"), (None, "no id " * 30, None, None),
             (309, "é " * 55, "fr", "s3"), (309, "é " * 55, "fr", "s3"), (308, "a\x0bb\x0cc\rd\te " * 30, "fr", "s3")]
    return rows


def test_counts_and_verdicts_as_sql_has_them(spark):
    schema = "doc_id long, text string, lang string, source string, kept int, judged int"
    df = spark.createDataFrame([(*r, 1, 2) for r in _rows()], schema)
    got = [r.asDict() for r in quality_rules.report(df).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", _rows())
    cur = con.execute(quality_sql.report_sql())
    names = [d[0] for d in cur.description]
    want = [dict(zip(names, r)) for r in cur.fetchall()]
    assert sorted(map(lambda r: str(sorted(r.items())), got)) == sorted(map(lambda r: str(sorted(r.items())), want))
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["kept"] for i in range(150)) and not any(by[200 + i]["kept"] for i in range(20))
    assert by[304]["base_failed"] and by[304]["n_repeat_words"] == 120 and not by[306]["base_failed"]


def test_keep_returns_the_documents_unchanged(spark):
    schema = "doc_id long, text string, lang string, source string, judged int"
    df = spark.createDataFrame([(*r, 1) for r in _rows()], schema)
    out = quality_rules.keep(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} >= set(range(150))
    assert quality_rules.keep(df.limit(0)).count() == 0 and quality_rules.report(df.limit(0)).count() == 0


def test_main_path_runs_no_python(spark):
    df = spark.createDataFrame(_rows(), "doc_id long, text string, lang string, source string")
    plan = quality_rules.report(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
