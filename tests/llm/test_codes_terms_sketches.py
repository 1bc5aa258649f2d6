"""Vector codes, source divergence and fingerprints: small cases by hand, brute force, and every awkward table."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm import divergence, sketch, vector_codes
from tests.llm.helpers import awkward, table


# ---------------------------------------------------------------- vector codes

def codes_brute(rows, parts=4, entries=256, rounds=4):
    """``{row number: (code, error)}`` and the books, in whole numbers."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(1024 * float(x)) for x in v] for _, v in rows]
    n = len(whole[0])
    cuts = [(n * p // parts, n * (p + 1) // parts) for p in range(parts)]
    books = [[w[a:b] for w in whole[:entries]] for a, b in cuts]
    near = lambda x, book: min((sum((p - q) ** 2 for p, q in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            held = defaultdict(list)
            for w in whole:
                held[near(w[a:b], books[p])[1]].append(w[a:b])
            for i, got in held.items():
                books[p][i] = [sum(c) // len(got) for c in zip(*got)]
    out = []
    for (i, _), w in zip(rows, whole):
        best = [near(w[a:b], books[p]) for p, (a, b) in enumerate(cuts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    return out, books


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("code", T.StringType()), T.StructField("id", T.LongType())])


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 7) for i, v, lab in rows], VECTORS)


def test_vector_codes_against_brute_force(spark):
    """Ties, copies, repeated ids, few rows, large numbers, null and non-finite components, wrong lengths."""
    rnd = random.Random(4)
    f32 = lambda x: float(np.float32(x))
    rows = [(i, [f32(rnd.choice([0.0, 0.25, -0.25, rnd.gauss(0, 0.2)])) for _ in range(10)], rnd.choice([0, 1, None])) for i in range(90)]
    rows += [(3, rows[3][1], 1), (None, rows[5][1], 0), (200, rows[0][1], 0), (201, [f32(9e4)] * 10, 1), (202, [f32(-9e4)] * 10, 1)]
    dropped = [(300, None, 1), (301, [None] * 10, 1), (302, [float("nan")] + [0.0] * 9, 1), (303, [float("inf")] * 10, 0),
               (304, [1.0], 1), (305, [], None)]
    codes, books = vector_codes.compress(vector_table(spark, rows + dropped), entries=16)
    want, want_books = codes_brute([(i, v) for i, v, _ in rows], entries=16)
    assert sorted(codes.select("id", "code", "error").collect(), key=str) == sorted(want, key=str)
    assert [b.tolist() for b in books.entries] == want_books
    text = ",".join(str(x) for b in want_books for e in b for x in e)
    assert books.sha256() == hashlib.sha256(text.encode()).hexdigest()
    sums = defaultdict(int)
    for r in codes.collect():
        sums[r["label"]] += r["error"]
    assert {(r["label"], r["label_error"]) for r in vector_codes.with_label_error(codes).collect()} == set(sums.items())
    near = vector_codes.decoded(codes, books).where("id = 0").select("approx").first()[0]
    assert len(near) == 10


def test_vector_codes_of_empty_tables(spark):
    for rows in ([], [(1, None, 2)], [(1, [float("nan")], None)]):
        codes, books = vector_codes.compress(vector_table(spark, rows))
        assert codes.count() == 0 and books is None and vector_codes.with_label_error(codes).count() == 0
    codes, books = vector_codes.compress(vector_table(spark, [(1, [], 2), (2, [], 2)]))
    assert sorted(map(tuple, codes.select("id", "code", "error").collect())) == [(1, "00000000", 0), (2, "00000000", 0)]


def test_bounds_prune_and_keep_results():
    """On separated groups most pairs are never evaluated; results are those of all pairs, ties to the lower entry."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (256, 16))
    points = centres[rng.integers(0, 256, 4000)] + rng.integers(-20, 20, (4000, 16))
    entries = np.concatenate([centres[:255], centres[:1]])
    pivots = vector_codes.choose_pivots(entries)
    code, best, evaluated = vector_codes.assign(points, vector_codes.pivot_distances(points, pivots), entries, pivots)
    d = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (code == d.argmin(axis=1)).all() and (best.astype(np.int64) == d.min(axis=1)).all()
    assert evaluated < 0.5 * d.size
    noise = rng.integers(-300, 300, (500, 16))
    code, best, _ = vector_codes.assign(noise, vector_codes.pivot_distances(noise, pivots), entries, pivots)
    d = ((noise[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (code == d.argmin(axis=1)).all() and (best.astype(np.int64) == d.min(axis=1)).all()


# ---------------------------------------------------------------- source divergence

def audit_brute(rows, min_docs, top):
    """Rows of ``(text, lang, source)``."""
    rows = [tuple(x or "" for x in r) for r in rows]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = [re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t.translate(low)) for t, _, _ in rows]
    df = defaultdict(Counter)
    for (_, lang, _), found in zip(rows, terms):
        df[lang].update(set(found))
    kept = {lang: {t for t, n in c.items() if n >= min_docs} for lang, c in df.items()}
    count = {(lang, src): Counter() for _, lang, src in rows}
    for (_, lang, src), found in zip(rows, terms):
        count[lang, src].update(t for t in found if t in kept[lang])
    whole = defaultdict(Counter)
    for (lang, _), c in count.items():
        whole[lang].update(c)
    p = lambda c, t, v: 1 + (10 ** 9 * (c[t] + 5)) // (sum(c.values()) + 5 * v)
    out = []
    for (lang, src), c in count.items():
        v = len(kept[lang])
        pairs = [(sum(abs(p(c, t, v) - p(o, t, v)) for t in kept[lang]), s) for (k, s), o in count.items() if k == lang and s != src]
        lone = [(p(c, t, v) - p(whole[lang], t, v), t) for t in kept[lang] if c[t] and p(c, t, v) > p(whole[lang], t, v)]
        for part, found, n in (("pair", pairs, None), ("term", lone, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:n]
            out += [(lang, src, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def sourced(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", 1, b"y", 2) for i, (t, lang, s) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, item string, rank int, term binary, n int")


@pytest.mark.parametrize("first_width", [1, 2, 6])
def test_divergence_against_brute_force(spark, first_width):
    """Terms that are each other's prefixes, of all lengths; other scripts; null and empty fields; groups without terms."""
    rnd = random.Random(first_width)
    stems = ["a", "ab", "abc", "abcd", "abcdefgh", "abcdefghi", "é", "éa", "日本", "日本語", "x" * 40, "x" * 41, "Zz", "zZ9z"]
    rows = [(" ".join(rnd.choice(stems[:rnd.randint(1, 14)]) for _ in range(rnd.randint(0, 30))), rnd.choice(["en", "fr", None, ""]),
             rnd.choice(["s1", "s2", "s3", None])) for _ in range(160)]
    rows += [(None, "en", "nothing"), ("", "de", "alone"), ("once only", "de", "two"), ("1 2 3 !", "fr", "signs"), ("y" * 5000, "en", "s1")]
    rows += [("copy copy abc", "en", "hot")] * 40
    got = divergence.audit(sourced(spark, rows), min_docs=8, top=5, first_width=first_width)
    assert sorted(map(tuple, got.collect())) == audit_brute(rows, 8, 5)


def test_collisions_of_the_bitmap_change_nothing(spark):
    """With a bitmap of 8 bits every prefix passes; exact counts still decide, also when tasks pass on each few terms."""
    rows = [(f"common{i % 3} rare{i} word prefix{'x' * (i % 9)}", "en", f"s{i % 2}") for i in range(60)]
    docs = sourced(spark, rows)
    want = sorted(map(tuple, divergence.common_terms(docs, 6).select("lang", "term", "docs").collect()))
    for slots, held in ((8, 400_000), (1 << 24, 3)):
        got = divergence.common_terms(docs, 6, first_width=2, held=held, slots=slots).select("lang", "term", "docs").collect()
        assert sorted(map(tuple, got)) == want and len(want) > 3


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(sourced(spark, [("a", "b", "c")]).limit(0)).count() == 0


# ---------------------------------------------------------------- fingerprints

def sketch_brute(text, words=5, limit="4000"):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    runs = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    hashes = [hashlib.md5(x.encode()).hexdigest() for x in runs]
    below = [h for h in hashes if h < limit]
    return sorted({h[:16] for h in (below or ([min(hashes)] if hashes else []))})


def test_fingerprints_against_brute_force(spark):
    """Every awkward row: order by id (nulls first), ties by text, the first row after the last one."""
    rows = awkward()
    docs = table(spark, rows)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        a, b, c = sketch_brute(t), sketch_brute(edited), sketch_brute(following)
        like = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y)) if x or y else 1.0
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), " ".join(a), " ".join(b), like(a, b), like(a, c)))
    for rows_a_range in (5, 1000):  # many ranges, and one
        dealt = sketch.with_sketch(sketch.with_next(docs, range_rows=rows_a_range), "__text", "__own")
        assert dealt.count() >= len(rows) + 1
    got = sketch.fingerprint_documents(docs).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                                    "near_edited", "near_next").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("rows_a_range", [1, 3, 50])
def test_successors_do_not_depend_on_the_ranges(spark, rows_a_range):
    ids = [-5, 0, 1, 2, 3, 10, 10, 11, 400, 401, 9_000_000_000]
    docs = spark.createDataFrame([(i, f"t{i} {k}") for k, i in enumerate(ids)], "doc_id long, text string")
    got = sketch.next_of(sketch.with_next(docs, range_rows=rows_a_range), "__text")
    texts = [f"t{i} {k}" for k, i in enumerate(ids)]
    assert {(r["__text"], r["__next_text"]) for r in got.collect()} == set(zip(texts, texts[1:] + texts[:1]))


def test_sketches_merge_rescale_and_contain(spark):
    rnd = random.Random(1)
    small = " ".join(f"w{rnd.random()}" for _ in range(400))
    large = " ".join(f"v{rnd.random()}" for _ in range(8000)) + " " + small
    df = spark.createDataFrame([("a", small), ("a", large), ("b", "")], "k string, text string")
    done = sketch.with_sketch(df, "text", "s")
    both = {(r["k"], r["hash"]) for r in sketch.merged(done, "k", "s").collect()}
    assert both == {("a", h) for h in set(sketch_brute(small)) | set(sketch_brute(large))}
    a, b = sketch_brute(small), sketch_brute(large)
    pair = spark.createDataFrame([(a, b)], "a array<string>, b array<string>").select(
        sketch.containment(F.col("a"), F.col("b")).alias("held"), sketch.likeness(F.col("a"), F.col("b")).alias("like"),
        sketch.rescaled(F.col("b"), 1 / 16).alias("less")).first()
    assert pair["held"] == 1.0 and pair["like"] < 0.1 and pair["less"] == [h for h in b if h < "1000"]


def test_fingerprints_are_native_and_empty_tables_work(spark):
    docs = table(spark, [(1, "a b c d e f g")])
    done = sketch.fingerprint_documents(docs)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert sketch.fingerprint_documents(docs.limit(0)).count() == 0
