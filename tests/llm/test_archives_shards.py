"""WARC framing and digests; shards that split only where they must."""

import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from beatwise.llm import shards, warc
from beatwise.llm.host_quality import judge_hosts

from .conftest import SF


def member(payload=b"abc", **change):
    return warc.format_record("urn:page:1", "http://x/", payload, change.get("refers_to"))


def plain(data):
    return gzip.decompress(data)


def read(data):
    return list(warc.read_records(io.BytesIO(data), "test.warc.gz"))


def test_records_come_back_in_order():
    payloads = [b"", b"\r\n\r\n", b"x" * 500_000, "é".encode() * 10]
    got = read(b"".join(map(member, payloads)))
    assert [r["payload"] for r in got] == payloads and all(r["digest_ok"] for r in got)
    assert [r["payload_digest"] for r in got] == [hashlib.sha1(p).hexdigest() for p in payloads]
    assert got[0]["uri"] == "http://x/" and got[0]["record_id"] == "urn:page:1"


def test_revisit_keeps_length_and_digest_of_the_full_payload():
    r, = read(member(b"y" * 1234, refers_to="urn:page:9"))
    assert (r["record_type"], r["refers_to"], r["payload_bytes"], r["payload"]) == ("revisit", "urn:page:9", 1234, None)
    assert r["payload_digest"] == hashlib.sha1(b"y" * 1234).hexdigest() and r["digest_ok"]


def test_a_changed_payload_is_seen():
    r, = read(gzip.compress(plain(member(b"abcdef")).replace(b"abcdef", b"abcdeX")))
    assert not r["digest_ok"]


@pytest.mark.parametrize("broken", [
    member()[:-5], member() + member()[:30], gzip.compress(plain(member()) * 2), gzip.compress(plain(member())[:-1]),
    gzip.compress(plain(member()).replace(b"Content-Length: ", b"Content-Length: 9")), b"not gzip at all",
    gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"), gzip.compress(plain(member()).replace(b"\r\nContent-Length: ", b"\r\nX: "))])
def test_broken_framing_fails(broken):
    with pytest.raises(ValueError, match=r"test\.warc\.gz"):
        read(broken)


def test_reader_holds_little(monkeypatch):
    """Bytes are decompressed in steps, however well they are packed."""
    steps = []
    more = warc.MemberReader.more
    monkeypatch.setattr(warc.MemberReader, "more", lambda self: more(self) and not steps.append(len(self.plain)) or bool(steps and not self.inflate.eof))
    reader = warc.MemberReader(io.BytesIO(gzip.compress(b"\0" * 50_000_000)), "x")
    reader.begin()
    more(reader)
    assert len(reader.plain) <= warc.READ_BYTES and len(reader.packed) <= warc.READ_BYTES


def test_archives_roll_over_and_leftovers_are_not_read(spark, monkeypatch, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i} " * 50) for i in range(40)], "page_id bigint, url string, html string")
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    folder = f"file://{tmp_path}/archives"
    manifest = warc.write_archives(warc.mark_revisits(pages).coalesce(2), folder)
    assert manifest.count() > 2
    (tmp_path / "archives" / "left-by-a-lost-executor.warc.gz").write_bytes(member()[:20])
    rows = warc.read_archives(manifest).collect()
    assert sorted(r["record_id"] for r in rows) == sorted(f"urn:page:{i}" for i in range(40))
    assert {r["payload"].decode() for r in rows} == {f"page {i} " * 50 for i in range(40)}
    assert manifest.agg(F.sum("records")).first()[0] == 40


def test_only_oversized_shards_split(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    limit = 20_000
    rows = shards.assign_shards(docs, limit=limit).select("shard.*", F.octet_length("text").alias("size")).collect()
    size, said = {}, {}
    for r in rows:
        said[r["name"]] = r["bytes"]
        for k in range(61):
            if k <= len(r["name"]):
                size[r["name"][:k]] = size.get(r["name"][:k], 0) + r["size"]
    assert len(rows) == docs.count() and len(said) > 10
    for name, n in said.items():
        assert size[name] == n and (n <= limit or len(name) == shards.HASH_BITS)
        assert not name or size[name[:-1]] > limit  # its parent had to split
        assert not any(other != name and other.startswith(name) for other in said)


def test_further_rounds_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lambda: sorted(map(repr, shards.assign_shards(docs, limit=5000, keep=["doc_id"]).collect()))
    whole = rows()
    monkeypatch.setattr(shards, "SPARE_BITS", 1)
    assert rows() == whole


def test_equal_rows_stay_together_and_a_hot_id_splits(spark):
    df = spark.createDataFrame([(1, "same " * 50)] * 20 + [(1, f"text {i} " * 50) for i in range(40)], "doc_id bigint, text string")
    rows = shards.assign_shards(df, limit=2000).collect()
    same = {r["shard"] for r in rows if r["text"].startswith("same")}
    assert len(same) == 1 and next(iter(same))["depth"] == shards.HASH_BITS and next(iter(same))["bytes"] == 20 * 250
    assert all(r["shard"]["bytes"] <= 2000 for r in rows if not r["text"].startswith("same"))
    with pytest.raises(ValueError):
        shards.assign_shards(df, limit=0)


def test_shards_are_written(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    shards.write_shards(shards.assign_shards(docs, limit=50_000), f"{tmp_path}/out")
    back = spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out")
    assert back.count() == docs.count() and back.groupBy("shard_name").agg(F.sum(F.octet_length("text")).alias("n")).filter("n > 50000").isEmpty()


def test_a_bad_host_is_rejected_and_a_small_one_is_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [("bad", "too short")] * 90 + [("bad", good)] * 10 + [("good", good)] * 300 + [("tiny", "too short"), ("tiny", good)] \
        + [(f"h{i}", good) for i in range(30)] + [(None, good)]
    got = judge_hosts(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, source string, text string"))
    kept = {}
    for r in got.collect():
        kept.setdefault((r["source"], r["text"] == good), set()).add(r["quality"]["kept"])
    assert kept[("bad", True)] == {False} and kept[("good", True)] == {True} and kept[(None, True)] == {True}
    assert kept[("tiny", True)] == {True} and kept[("tiny", False)] == {False} and kept[("h1", True)] == {True}
