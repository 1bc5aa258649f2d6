"""Sharding against brute force; WARC by exact round trip."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from martforge.llm import sharding, warc
from martforge.llm.common import new_path
from tests.llm.helpers import awkward, table


def best_capacity(sizes, shards):
    n = len(sizes)
    best = sum(sizes)
    for cuts in combinations(range(1, n), min(shards, n) - 1):
        ends = [0, *cuts, n]
        best = min(best, max(sum(sizes[a:b]) for a, b in zip(ends, ends[1:])))
    return best


def test_smallest_capacity_is_minimax():
    rnd = random.Random(1)
    for _ in range(60):
        sizes = [rnd.randint(0, 30) for _ in range(rnd.randint(1, 9))]
        shards = rnd.randint(1, 5)
        capacity = sharding.smallest_capacity(sizes, shards)
        assert capacity == best_capacity(sizes, shards)
        ends = [0, *sharding.cut_points(sizes, shards), len(sizes)]
        assert len(ends) == shards + 1 and ends == sorted(ends)
        assert max(sum(sizes[a:b]) for a, b in zip(ends, ends[1:])) <= capacity


def test_assign_shards(spark):
    rows = awkward(n=200)
    got = sharding.assign_shards(table(spark, rows).repartition(3), n_shards=7).collect()
    assert len(got) == len(rows)
    data = lambda t: (t or "").encode()
    assert (Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
            == Counter((i, len(data(t)) + 16, zlib.crc32(data(t))) for i, t in rows))
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    of_text = defaultdict(set)
    for r in got:
        of_text[(r["text_crc32"], r["size"])].add(r["shard"])
    assert all(len(s) == 1 for s in of_text.values())
    assert sharding.assign_shards(table(spark, [])).collect() == []


def test_sharding_runs_no_python(spark):
    plan = sharding.assign_shards(table(spark, awkward(n=5)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("size", [1, 3, 8192])
def test_chunked_framing(size):
    for payload in (b"", b"a", b"\r\n0\r\n\r\n" * 5, bytes(range(256)) * 50):
        assert warc.unchunked(warc.chunked(payload, size)) == payload
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def pages():
    rnd = random.Random(3)
    rows = [(i, f"http://x/{i}", "<p>" + "äb\r\n\r\nWARC/1.1 " * rnd.randint(0, 400)) for i in range(40)]
    rows += [(100 + i, "http://c\r\nX: y", rows[i % 3][2]) for i in range(20)]
    rows += [(200, None, None), (201, "u", ""), (202, "long", "x" * 300_000), (203, "long", "x" * 300_000), (204, "n", "\u0000")]
    return rows


def read_back(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("sha", F.lit("z"))
    path = new_path(spark, "test-warc")
    warc.write_warc(df.repartition(3), path, **options)
    return warc.read_warc(spark, path).collect(), path


@pytest.mark.parametrize("segment", [50, 1000, 32_768])
def test_archives(spark, segment):
    rows = pages()
    got, _ = read_back(spark, rows, segment_bytes=segment)
    assert len(got) == len(rows) and all(r["error"] is None for r in got)
    owner = {}
    for i, _, t in rows:
        owner[t or ""] = min(owner.get(t or "", i), i)
    found = {int(r["record_id"].split(":")[2]): r for r in got}
    for i, _, t in rows:
        r, data = found[i], (t or "").encode()
        assert r["stated_digest"] == warc.digest32(data)
        if owner[t or ""] == i:
            assert r["record_type"] == "response" and r["payload"] == data and r["refers_to"] is None
        else:
            assert r["record_type"] == "revisit" and r["stated_bytes"] == len(data) and r["payload"] is None
            assert int(r["refers_to"].split(":")[2]) == owner[t or ""]


def test_small_payloads_may_all_be_responses(spark):
    got, _ = read_back(spark, [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdefgh"), (4, "u", "abcdefgh")], min_bytes=5)
    assert Counter(r["record_type"] for r in got) == {"response": 3, "revisit": 1}


def test_repeated_rows_null_ids_and_empty_tables(spark):
    big = "y" * 500
    got, _ = read_back(spark, [(1, "u", big), (1, "u", big), (None, "u", big), (None, None, "solo")], segment_bytes=100)
    assert Counter(r["record_type"] for r in got) == {"response": 3, "revisit": 1}
    assert sorted(r["record_id"].split(":")[2] for r in got) == ["1", "1", "null", "null"]
    assert read_back(spark, [])[0] == []


def test_a_lost_segment_is_reported(spark, tmp_path):
    records = warc.records_of(7, "u", b"z" * 500, warc.digest32(b"z" * 500), None, False, 120)
    assert len(records) > 3
    (tmp_path / "a.warc").write_bytes(b"".join(r + warc.END for r in records[:2] + records[3:]))
    (tmp_path / "b.warc").write_bytes(b"".join(r + warc.END for r in warc.records_of(8, "u", b"ok", "D", None, False, 999)))
    got = {r["record_id"].split(":")[2]: r for r in warc.read_warc(spark, f"file://{tmp_path}").collect()}
    assert got["7"]["error"] == "missing segment" and got["7"]["payload"] is None
    assert got["8"]["payload"] == b"ok"
    with pytest.raises(ValueError):
        list(warc.parse_records(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcd\r\n\r\n"))
