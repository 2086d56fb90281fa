import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from marketlens.llm import training_order as to  # noqa: E402
from marketlens.session import scratch_dir  # noqa: E402

PATH = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 1000, 4096, 70_001])
def test_slots_are_a_keyed_permutation(total):
    n = np.arange(total)
    a, b = to.slots_of(n, total, 1), to.slots_of(n, total, 2)
    assert sorted(a.tolist()) == n.tolist() == sorted(b.tolist())
    assert to.slots_of(a, total, 1, back=True).tolist() == n.tolist()
    if total > 100:
        assert (a != b).mean() > 0.9 and abs(np.corrcoef(n, a)[0, 1]) < 0.15


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, slot int, payload string")


def test_every_sequence_is_in_its_slot_and_reading_resumes(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    rows = [(r.doc_id, r.text, 1, "x") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(900, None, 1, "x"), (None, "no id", None, None), (901, "", 0, ""), (901, "", 0, ""), (902, "word " * 9000, 0, "")]
    path = scratch_dir(spark, "order_test")
    to.materialise(_docs(spark, rows).repartition(5), PATH, path, length=64, slots=50, key=9)
    got = sorted(to.read_from(spark, path, length=64, slots=50).collect(), key=lambda r: r.slot)
    assert [r.slot for r in got] == list(range(len(got)))
    assert all(r.shard == r.slot // 50 and r.byte_offset == r.slot % 50 * 128 for r in got)
    want = []
    for doc, text, *_ in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        want += [(doc or -1, a, ids[a:a + 64]) for a in range(0, len(ids), 64)]
    have = [(r.doc_id or -1, r.start, np.frombuffer(r.ids, "<u2").tolist()) for r in got]
    assert sorted(have) == sorted(want)
    shards = spark.read.parquet(path).collect()
    assert all(len(s.payload) == 128 * len(s.lengths) and len(s.lengths) <= 50 for s in shards)
    tail = sorted(to.read_from(spark, path, slot=77, n=60, length=64, slots=50).collect(), key=lambda r: r.slot)
    assert tail == got[77:137]


def test_report_and_empty_table(spark):
    rep = to.report(_docs(spark, [(1, "a b c", 1, "p"), (2, "d", 2, "q")]), PATH).collect()
    assert {r.doc_id for r in rep} == {1, 2} and {r.slot for r in rep} == {0, 1}
    from marketlens.llm.packing import WordIds
    ids = np.frombuffer(WordIds.of(PATH).encode("d"), "<u4").astype("<u2").tobytes() + b"\x02\x00"
    assert next(r for r in rep if r.doc_id == 2).ids_crc32 == zlib.crc32(ids)
    assert to.report(_docs(spark, []), PATH).count() == 0


def test_ranges_are_dealt_evenly_and_the_manifest_finds_broken_shards(spark):
    rows = [(i, "word " * 300, 0, "") for i in range(200)]
    path = scratch_dir(spark, "order_manifest")
    to.materialise(_docs(spark, rows).repartition(4), PATH, path, length=16, slots=8, key=1 << 70)
    listed = to.manifest(spark, path).orderBy("shard").collect()
    total = listed[0].total
    assert [r.shard for r in listed] == list(range(-(-total // 8))) and sum(r.n_slots for r in listed) == total
    assert {(r.key, r.stride, r.slots) for r in listed} == {(str(1 << 70), 32, 8)}
    files = spark.read.schema(to.SHARDS).parquet(path).selectExpr("_metadata.file_name AS f", "shard").collect()
    by_file = {f: sorted(r.shard for r in files if r.f == f) for f in {r.f for r in files}}
    sizes = [len(v) for v in by_file.values()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) - min(sizes) <= 1
    assert all(v == list(range(v[0], v[-1] + 1)) for v in by_file.values())
    assert sorted(by_file) == sorted(by_file, key=lambda f: by_file[f][0])
    assert to.broken(spark, path).count() == 0
    shards = spark.read.schema(to.SHARDS).parquet(path)
    other = scratch_dir(spark, "order_broken")
    shards.filter("shard <> 3").selectExpr("shard", "first_slot", "doc_ids", "starts", "lengths",
                                           "IF(shard = 5, unhex('00'), payload) AS payload", "crc32").write.parquet(other)
    to.manifest(spark, path).write.parquet(f"{other}/_manifest")
    assert {r.shard for r in to.broken(spark, other).collect()} == {3, 5}


def test_written_slots_are_those_of_the_permutation(spark):
    rows = [(i, "word " * (40 * i), 0, "") for i in range(1, 30)]
    path = scratch_dir(spark, "order_slots")
    to.materialise(_docs(spark, rows).coalesce(1), PATH, path, length=16, slots=8, key=5)
    got = sorted(to.read_from(spark, path, length=16, slots=8).collect(), key=lambda r: r.slot)
    total = len(got)
    # one writing task: the numbers follow the documents
    numbers = to.slots_of(np.arange(total), total, 5, back=True)
    place = sorted((r.doc_id, r.start) for r in got)
    assert [(r.doc_id, r.start) for r in got] == [place[n] for n in numbers]
