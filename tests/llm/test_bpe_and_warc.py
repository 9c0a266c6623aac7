from __future__ import annotations

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from check_queries import normalise
from promoledger.llm import bpe, warc
from tests.llm.data import SMALL, edge_docs, empty_docs, oracle


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(bpe.vocabulary_path())


def test_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for row in bpe.query(spark, SMALL).collect():
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_any_text_equals_the_library(library):
    encoder, rng = bpe.Encoder(bpe.vocabulary_path()), random.Random(3)
    for turn in range(1500):
        text = "".join(rng.choice("abcthe   onéß漢😀<|>!!  \n\t0123  \x1c'slld") for _ in range(rng.choice([1, 3, 20, 300])))
        text = "<|endoftext|>" + text + "<|endoftext|> x" if turn % 9 == 0 else text
        text = "aé" * 400 + text if turn % 50 == 0 else text
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_scan_and_heap_agree():
    encoder, rng = bpe.Encoder(bpe.vocabulary_path()), random.Random(4)
    for _ in range(300):
        ids = [encoder.bytes[b] for b in "".join(rng.choice("thean ing") for _ in range(rng.randint(0, 60))).encode()]
        assert bpe.merge_short(list(ids), encoder.pairs) == bpe.merge_long(ids, encoder.pairs)


def test_bpe_edges(spark, monkeypatch):
    docs = edge_docs(spark)
    path = bpe.vocabulary_path()
    encoded = bpe.encode(docs, path, out="n")
    assert set(encoded.columns) == set(docs.columns)
    for row in bpe.decode(encoded, path, "n").collect():
        assert row["decoded"] == (row["text"] or "") and (row["text"] or row["n"] == [])
    assert bpe.decode(bpe.encode(empty_docs(spark), path), path).count() == 0
    nothing = spark.createDataFrame([(None,), ([50256],), ([],), ([120],)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(nothing, path).collect()][:3] == ["", "<|endoftext|>", ""]


def test_warc_equals_sql(spark):
    assert normalise(warc.query(spark, SMALL).toPandas()) == normalise(oracle(warc.SQL))


def pages(spark):
    big = "<p>same</p>" * 40
    rows = [(i, f"http://h/{i}?a=b c", f"<p>{i}</p>" * (i * 30)) for i in range(40)]
    rows += [(100, "u", big), (90, "v\r\nX: y", big), (95, None, big), (None, "w", big), (90, "v\r\nX: y", big), (7, "é", None), (8, "", ""), (9, "s", "short"), (11, "s", "short")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", pages_extra())


def pages_extra():
    from pyspark.sql import functions as F

    return F.lit("clash")


def files_of(folder):
    return {n: hashlib.sha256(open(f"{folder}/{n}", "rb").read()).hexdigest() for n in os.listdir(folder) if n.endswith(".gz")}


def test_round_trip_and_revisits(spark, tmp_path):
    folder = str(tmp_path / "a")
    rows = pages(spark)
    manifest = warc.write_archive(rows, folder, file_bytes=2_000, shard_bytes=20_000)
    assert manifest.count() > 3 and {r["name"] for r in manifest.collect()} == set(files_of(folder))
    found = warc.read_archive(spark, folder).collect()
    want = sorted((r["page_id"] or -1, r["url"] or "", hashlib.sha256((r["html"] or "").encode()).hexdigest()) for r in rows.collect())
    assert sorted((r["page_id"] or -1, r["url"] or "", r["payload_digest"]) for r in found) == want
    same = [r for r in found if r["payload_bytes"] == 440]
    assert sorted((r["record_type"], r["page_id"], r["refers_to"]) for r in same if r["page_id"]) == [
        ("response", 90, None), ("revisit", 90, 90), ("revisit", 95, 90), ("revisit", 100, 90)
    ]
    assert all(r["record_type"] == "response" for r in found if r["payload_bytes"] < 100)
    for r in found:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        if r["payload"] is not None:
            assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"]


def test_bytes_do_not_depend_on_partitions_and_rewriting_is_safe(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    warc.write_archive(pages(spark), a, file_bytes=2_000, shard_bytes=20_000)
    warc.write_archive(pages(spark).repartition(7), b, file_bytes=2_000, shard_bytes=20_000)
    assert files_of(a) == files_of(b)
    warc.write_archive(pages(spark), a, file_bytes=2_000, shard_bytes=20_000)
    assert files_of(a) == files_of(b) and not os.path.exists(f"{a}/_temporary")


def test_damage_is_seen(spark, tmp_path):
    import io
    import zlib

    data = warc.record(1, "http://h/", b"hello", None, False)
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    bad = squeeze.compress(zlib.decompress(data, 31).replace(b"hello", b"hallo")) + squeeze.flush()
    assert len(list(warc.parse(io.BytesIO(data + data)))) == 2
    with pytest.raises(ValueError, match="damaged"):
        list(warc.parse(io.BytesIO(bad)))


def test_empty_archive(spark, tmp_path):
    folder = str(tmp_path / "none")
    warc.write_archive(pages(spark).limit(0), folder)
    assert warc.read_archive(spark, folder).count() == 0


def test_every_shard_has_a_task_of_its_own(spark, tmp_path):
    rows = spark.range(4000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), F.col("id")).alias("url"), F.concat(F.lit("page "), F.sha2(F.col("id").cast("string"), 512)).alias("html"))
    seen = []
    real = warc.range_bounds
    try:
        warc.range_bounds = lambda *a, **k: seen.append(real(*a, **k)) or seen[-1]
        manifest = warc.write_archive(rows, str(tmp_path / "a"), file_bytes=1 << 30, shard_bytes=40_000)
    finally:
        warc.range_bounds = real
    shards = len(seen[0]) + 1
    assert shards >= 8 and manifest.count() == shards
    records = warc.read_archive(spark, str(tmp_path / "a"))
    sizes = [n for n in records.rdd.glom().map(len).collect() if n]
    assert len(sizes) == shards and max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]
