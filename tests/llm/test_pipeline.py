import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from marketlens.llm import quality_rules  # noqa: E402
from tests.llm.test_line_dedup import brute as brute_lines  # noqa: E402
from tests.llm.test_simhash import brute_components, brute_fingerprint  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_stages_and_their_decisions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "suffix_array_dedup", "packing"]
    given = {r.doc_id: r for r in docs.collect()}
    state, out = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, SMALL)
        state = corpus_pipeline.stored(state, f"test_{name}")
        out[name] = state.collect()
        if name != "packing":
            assert state.columns == docs.columns
    kept = {r.doc_id for r in quality_rules.report(docs).collect() if r.kept}
    assert {r.doc_id for r in out["quality_rules"]} == kept and 0 < len(kept) < len(given)
    assert all(r == given[r.doc_id] for r in out["quality_rules"])
    want = {d: t for d, _, _, t in brute_lines([(r.doc_id, r.text) for r in out["quality_rules"]])}
    assert {r.doc_id: r.text for r in out["line_dedup"]} == want
    comp = brute_components({d: brute_fingerprint(t) for d, t in want.items()})
    assert {r.doc_id for r in out["simhash_near_dedup"]} == {d for d, c in comp.items() if c == d}
    windows = set()
    for r in sorted(out["suffix_array_dedup"], key=lambda r: r.doc_id):
        raw = r.text.encode()
        assert len(r.text) <= len(want[r.doc_id]) and r.n_chars == len(r.text)
        own = want[r.doc_id].encode()
        if not any(own[i:i + 50] in windows for i in range(len(own) - 49)):
            assert raw == own
        windows |= {own[i:i + 50] for i in range(len(own) - 49)}
    assert {r.doc_id for r in out["packing"]} == {r.doc_id for r in out["suffix_array_dedup"]}
    assert sum(r.length for r in out["packing"]) == sum({r.doc_id: r.doc_tokens for r in out["packing"]}.values())


def test_stages_take_nulls_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], schema)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0)], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
        stage(spark, odd, SMALL).collect()
