import duckdb

from marketlens.llm import chat


def _rows():
    base = [("system", "be kind"), ("user", "hello <|im_end|>"), ("assistant", "hi"), ("user", None), ("assistant", "ok")]
    rows = []

    def log(conv, turns, first=0):
        rows.extend((conv, first + i, r, t) for i, (r, t) in enumerate(turns))

    for n in range(1, 6):
        log(n, base[:n])                                        # snapshots 1 to 4 are prefixes of 5
    log(6, base)                                                # equal to 5
    log(7, base[:2] + [("assistant", "other")])                 # a branch
    log(8, base[1:])                                            # not a prefix
    log(9, base[:3], first=1)                                   # other turn numbers
    log(10, [("user", "long")] * 3000)
    log(11, [("user", "long")] * 1024)                          # a prefix over a segment's border
    log(12, [("user", "long")] * 1500 + [("user", "short")])
    rows += [(13, 0, "user", "same"), (13, 0, "user", "same"), (13, 1, None, "x")]   # a repeated row
    rows += [(14, 0, "user", "same")]                           # half of 13's first turn: no prefix
    rows += [(15, None, "user", "no turn"), (16, None, "user", "no turn"), (16, 1, "user", "more")]
    rows += [(100 + i, 0, "user", "common first turn") for i in range(300)]
    rows += [(100 + i, 1, "assistant", f"answer {i % 7}") for i in range(300)]
    return rows


def test_kept_logs_and_rendering_as_sql_has_them(spark):
    df = spark.createDataFrame([(*r, 1) for r in _rows()], "conv_id long, turn long, role string, text string, n int")
    names = ["conv_id", "part", "n_turns", "n_copies", "chat"]
    got = sorted(tuple(r[c] for c in names) for r in chat.render(df).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", _rows())
    cur = con.execute(chat.render_sql())
    order = [[d[0] for d in cur.description].index(c) for c in names]
    assert got == sorted(tuple(r[i] for i in order) for r in cur.fetchall())
    kept = {r[0]: r for r in got}
    assert set(kept) == {5, 7, 8, 9, 10, 12, 13, 14, 16, *range(100, 107)}
    assert kept[5][3] == 2 and kept[100][3] == 43 and [r[1] for r in got if r[0] == 10] == [0, 1, 2]
    assert kept[7][4].startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user\nhello < |im_end|><|im_end|>\n")


def test_null_conversation_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "user", "b"), (1, 0, "user", "a")], schema)
    out = chat.render(df).collect()
    assert [(r.conv_id, r.n_turns) for r in out] == [(None, 2)]
    assert chat.render(df.limit(0)).count() == 0


def test_sql_keeps_a_null_conversation_too(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "user", "b"), (1, 0, "user", "a"), (2, 0, "user", "c"), (3, 0, "user", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = sorted((tuple(r) for r in chat.render(df).select("conv_id", "part", "n_turns", "n_copies", "chat").collect()), key=str)
    assert got == sorted(con.execute(chat.render_sql()).fetchall(), key=str) and {r[0] for r in got} == {None, 2}


def test_main_path_runs_no_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = chat.render(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
