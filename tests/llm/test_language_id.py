import zlib

import numpy as np
import pytest

from marketlens.llm import language_id as li


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int, lang_pred int")


def test_held_out_accuracy_on_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "lang").join(li.report(docs), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.held_out for r in rows} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_defined_cases(spark):
    en, de = "the house of the river and the people " * 30, "das haus und der fluss mit den leuten " * 30
    rows = [(i, (en, de)[i % 2], ("en", "de")[i % 2], "s", 1, 2) for i in range(60)]
    rows += [(100, None, "en", "s", 1, 2), (101, "", "en", "s", 1, 2), (102, "123 !? \n", None, None, 1, 2),
             (None, en, "en", "s", 1, 2), (103, de * 400, None, "s", 1, 2), (0, en, "en", "s", 1, 2), (104, "x", None, "s", 1, 2)]
    out = li.report(_docs(spark, rows)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0.0
    assert by[103].lang_pred == "de" and by[None].lang_pred == "en" and by[None].held_out is False
    assert by[104].lang_pred in ("en", "de")
    unlabelled = li.report(_docs(spark, [(1, en, None, "s", 1, 2)])).first()
    assert (unlabelled.lang_pred, unlabelled.score) == ("und", 0.0)
    assert li.report(_docs(spark, [])).count() == 0


def test_numerals_are_no_letters(spark):
    en, de = "the house of the river and the people " * 30, "das haus und der fluss mit den leuten " * 30
    rows = [(i, (en, de)[i % 2], ("en", "de")[i % 2], "s", 1, 2) for i in range(40)]
    rows += [(100, "½ ② ²", None, "s", 1, 2), (101, "Ⅷ ₃ _ 7", None, "s", 1, 2), (102, "ª", None, "s", 1, 2)]
    by = {r.doc_id: r.lang_pred for r in li.report(_docs(spark, rows)).collect()}
    assert by[100] == by[101] == "und" and by[102] in ("en", "de")


def test_scoring_tables_equal_the_plain_network():
    rng = np.random.default_rng(0)
    net = li.ByteNet(["a", "b", "c"])
    x = rng.integers(0, 256, (5, li.WINDOW + li.REACH)).astype(np.uint8)
    top = np.concatenate([r.max(axis=1) for r in net._responses(x)], axis=1)
    assert net.scorer()(x) == pytest.approx(np.tanh(top) @ net.out + net.bias, abs=1e-4)


def test_windows_cover_the_whole_text():
    text = "ab" * 300 + "é"
    w = li.windows_of(text)
    assert w.shape == (3, li.WINDOW + li.REACH)
    assert b"".join(r[:li.WINDOW].tobytes() for r in w).rstrip(b"\0") == text.encode()
