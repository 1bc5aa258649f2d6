"""Exact dedup, line dedup and SimHash near-dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from martforge.llm import exact_dedup, line_dedup, simhash
from martforge.llm.common import bucketed
from tests.llm.helpers import awkward, table

WS = re.compile(r"[\x20\x09-\x0D]")


def exact_brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[WS.sub("", t or "")].append((-len(t or ""), i is None, i))
    out = []
    for key, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        out += [(i, keep, len(members), i == keep, hashlib.sha256(key.encode()).hexdigest()) for _, _, i in members]
    return Counter(out)


@pytest.mark.parametrize("memory", [exact_dedup.LOCAL_MEMORY, 2_000])
def test_exact_duplicates(spark, monkeypatch, memory):
    monkeypatch.setattr(exact_dedup, "LOCAL_MEMORY", memory)
    rows = awkward()
    got = exact_dedup.exact_duplicates(table(spark, rows).repartition(5)).collect()
    assert Counter(map(tuple, got)) == exact_brute(rows)


def test_exact_duplicates_of_an_empty_table(spark):
    assert exact_dedup.exact_duplicates(table(spark, [])).collect() == []


@pytest.mark.parametrize("shared", [0, 200, 2_000, 20_000])
def test_trie_spills_below_long_shared_beginnings(shared, tmp_path, monkeypatch):
    """A licence text before every key: no recursion, few rewrites of a row, files in Spark's folder and none left."""
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(tmp_path))
    written = []
    real = exact_dedup._append
    monkeypatch.setattr(exact_dedup, "_append", lambda path, rows: (lambda r: (written.append(len(r)), real(path, r)))(list(rows)))
    rnd = random.Random(shared)
    keys = [b"L" * shared + bytes(rnd.choices(b"abc", k=rnd.randint(0, 30))) for _ in range(600)]
    keys += [b"L" * shared + b"c" * k for k in range(300)]  # each the beginning of the next
    rows = [(rnd.choice(keys), i, i) for i in range(3_000)]
    trie = exact_dedup.PatriciaTrie(shared + 12_000)
    for row in rows:
        trie.insert(*row)
    assert trie.spilled and all(str(tmp_path) in f for f in trie.spilled)
    want = {}
    for key, i, _ in rows:
        want[key] = min(want.get(key, i), i)
    assert dict(trie.owners()) == {i: want[key] for key, i, _ in rows}
    assert sum(written) < 12 * len(rows) and list(tmp_path.iterdir()) == []


def test_trie_spills_subtrees_and_still_finds_all_owners():
    rnd = random.Random(3)
    keys = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    small, large = exact_dedup.PatriciaTrie(5_000), exact_dedup.PatriciaTrie(1 << 40)
    least = {}
    for i, k in enumerate(keys):
        small.insert(k, i, i)
        large.insert(k, i, i)
        least.setdefault(k, i)
    assert small.spilled and not large.spilled
    want = {i: least[k] for i, k in enumerate(keys)}
    assert dict(small.owners()) == want and dict(large.owners()) == want


def lines_brute(rows, min_chars=40, min_docs=5):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)
        return k if len(k) >= min_chars else None
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None and t is not None:
            for line in t.split("\n"):
                if key(line):
                    holders[key(line)].add(i)
    out = Counter()
    for i, t in rows:
        have = (t or "").split("\n")
        kept = [x for x in have if i is None or not (k := key(x)) or len(holders[k]) < min_docs or max(holders[k]) == i]
        out[(i, "\n".join(kept), len(have), len(have) - len(kept))] += 1
    return out


@pytest.mark.parametrize("batches,fan_out", [(4, 2), (1, 2), (6, 3)])
def test_dedup_lines(spark, batches, fan_out):
    rows = awkward(n=80)
    docs = table(spark, rows).repartition(3)
    got = line_dedup.dedup_lines(docs, batches=batches, fan_out=fan_out)
    assert got.columns == [*docs.columns, "_n_lines", "_n_dropped"]
    found = Counter((r["doc_id"], r["text"], r["_n_lines"], r["_n_dropped"]) for r in got.collect())
    assert found == lines_brute(rows)
    assert sum(n for (_, _, _, dropped), n in found.items() if dropped) > 5
    assert all(r["c0"] == r["doc_id"] and r["in_text"] == "y" and r["n"] is None for r in got.collect())


def test_runs_of_lines_are_never_exchanged_again(spark):
    lines = spark.createDataFrame([(b, i, bytes([i % 11])) for b in range(3) for i in range(60 * b, 200)],
                                  "batch int, id long, key binary")
    runs = [bucketed(lines.where(F.col("batch") == b).where(F.col("key") != bytes([b])).groupBy("key").agg(
        F.count_distinct("id").alias("n"), F.max("id").alias("owner")), "test-run", "key") for b in range(3)]
    for plan in (line_dedup._merged(*runs[:2]), line_dedup._unsettled(runs[0], runs[1:], 18), line_dedup._totals(runs, "t")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Bucketed: true") >= 2 and "SortMergeJoin" in text and "Exchange" not in text
    totals = [(r["key"][0], r["n"], r["owner"]) for r in line_dedup._totals(runs, "t").collect()]
    assert sorted(totals) == [
        (k, sum(len([i for i in range(60 * b, 200) if i % 11 == k]) for b in range(3) if b != k),
         max(i for i in range(200) if i % 11 == k)) for k in range(11)]
    settled = {r["key"][0] for r in runs[1].where("n >= 12").collect()}
    left = [r["key"][0] for r in line_dedup._unsettled(runs[0], [runs[1]], 12).collect()]
    assert settled and left and sorted(left) == sorted(set(range(1, 11)) - settled)


def test_dedup_lines_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(table(spark, [])).collect() == []


def test_line_key_counts_code_points():
    assert line_dedup.line_hash(("é" * 39).encode(), 40) is None
    assert line_dedup.line_hash(("é" * 40).encode(), 40) is not None
    assert line_dedup.line_hash(b" A" + b"b" * 40 + b"\r", 40) == line_dedup.line_hash(b"a" + b"b" * 40, 40)
    assert line_dedup.line_hash("É".encode() * 40, 40) != line_dedup.line_hash("é".encode() * 40, 40)


def fingerprint_brute(text, size=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(points, bits):
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= bits:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(points))]


def test_near_duplicates(spark):
    rows = [(i, (t or "")[:3000] if t is not None else None) for i, t in awkward(n=60)]
    got = simhash.near_duplicates(table(spark, rows).repartition(3)).collect()
    points = [fingerprint_brute(t) for _, t in rows]
    comp = components_brute(points, 2)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = Counter((i, f"{p:016x}", least.get(c)) for (i, _), p, c in zip(rows, points, comp))
    assert Counter(map(tuple, got)) == want
    assert simhash.near_duplicates(table(spark, [])).collect() == []


def test_majority_over_many_shingles():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 255, 256, 1000):
        values = rnd.integers(0, 1 << 63, n, dtype=np.uint64) * 2 + rnd.integers(0, 2, n, dtype=np.uint64)
        digests = np.frombuffer(b"".join(int(v).to_bytes(8, "big") for v in values), np.uint8).reshape(n, 8)
        want = sum(1 << b for b in range(64) if 2 * sum(int(v) >> b & 1 for v in values) > n)
        assert simhash.majority(digests) == want


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_shards_and_trees_find_every_close_pair(bits):
    rnd = np.random.default_rng(bits)
    centres = rnd.integers(0, 1 << 62, 12, dtype=np.uint64)
    points = set()
    for c in centres.tolist():
        for _ in range(70):
            flips = rnd.choice(64, rnd.integers(0, 5), replace=False)
            points.add(c ^ sum(1 << int(f) for f in flips))
    points = np.array(sorted(points), np.uint64)
    want = {(i, j) for i in range(len(points)) for j in range(i + 1, len(points))
            if int(points[i] ^ points[j]).bit_count() <= bits}
    left, right = simhash.close_pairs(points, bits)
    assert {(min(a, b), max(a, b)) for a, b in zip(left.tolist(), right.tolist())} == want
    keys = [set(k) for k in simhash.shard_keys(points, bits).tolist()]
    assert all(keys[i] & keys[j] for i, j in want)


def test_a_chain_of_links_is_one_component(spark):
    chain = [((1 << 2 * k) - 1, 900 - k) for k in range(30)]
    signed = [(i, p - (1 << 64) if p >= 1 << 63 else p) for p, i in chain]
    points = spark.createDataFrame(signed, "id long, fp long").selectExpr("fp", "id as least")
    found = simhash.components(simhash.link_forest(points, 2))
    assert found.count() == 29 and found.select("root").distinct().count() == 1
