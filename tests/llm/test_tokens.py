"""BPE against the tokenizers library; token files by exact round trip."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martforge.llm import bpe, token_files
from martforge.llm.common import new_path, tokenizer_path
from tests.llm.helpers import awkward, table

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path(NAME))


def mixed(seed, n, marks):
    rnd = random.Random(seed)
    letters = [chr(c) for c in [*range(1, 0x600), *range(0x1E00, 0x2100), 0x3000, 0x4E00, 0x1F600, 0x10D50, 0x16EA0]]
    out = ["", "   ", "ΑΣ ΣΑΣ", "a" * 3000, "thing" * 400, "ab1c" * 100, "İstanbul ǅ ﬀ ß ẞ", "\x1c \x1f", "don't we'LL"]
    for k in range(n):
        text = "".join(rnd.choice(letters) if rnd.random() < 0.3 else rnd.choice(" \nabcstrelm'1,.DE")
                       for _ in range(rnd.choice([5, 40, 90])))
        out.append(text[:4] + rnd.choice(marks) + text[4:] if k % 5 == 0 else text)
    return out


def test_encoding_and_decoding_match_the_library(library):
    own = bpe.WordBpe(NAME)
    for text in mixed(2, 600, ["<|endoftext|>", "<|startoftext|>", "<|", "|>"]):
        want = library.encode(text, add_special_tokens=False).ids
        entries = own.entries([own.words_of(text)])[0]
        assert [int(i) for e in entries for i in e[1].split(" ")] == want, repr(text)
        assert " ".join(e[2] for e in entries) == library.decode(want, skip_special_tokens=False)
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_rows_and_heap_merge_alike():
    own = bpe.WordBpe(NAME)
    words = sorted({w for t in mixed(4, 200, [" "]) for w in own.words_of(t)} | {"thing" * 9, "aaaaaaaaaaaaaaaa"})
    spelled = [w.encode() for w in words]
    assert own.merge_rows(spelled) == [own.merge_long(s) for s in spelled]


def test_the_word_table_stays_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    own = bpe.WordBpe(NAME)
    first = [own.encode(t) for t in mixed(6, 100, [" "])]
    assert first == [own.encode(t) for t in mixed(6, 100, [" "])] and len(own.known) < 300


def test_documents(spark, library):
    rows = awkward(n=20)
    got = {(r[0], r[1], r[2], r[3]) for r in bpe.digest_documents(table(spark, rows), NAME).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == want
    full = bpe.encode_documents(table(spark, rows), NAME).collect()
    assert len(full) == len(rows)
    assert all(r["ids"] == library.encode(t or "", add_special_tokens=False).ids for r, (_, t) in
               zip(sorted(full, key=lambda r: (str(r[0]), len(r["ids"]))),
                   sorted(rows, key=lambda r: (str(r[0]), len(library.encode(r[1] or "", add_special_tokens=False).ids)))))
    assert bpe.digest_documents(table(spark, [])).collect() == []


@pytest.mark.parametrize("width", [1, 7, 8, 13, 15, 16, 17, 20, 31, 32])
def test_packing_round_trip(width):
    rnd = np.random.default_rng(width)
    ids = rnd.integers(0, 1 << width, 1001, dtype=np.uint64).astype(np.uint32)
    data = token_files.pack(ids, width)
    assert len(data) == -(-1001 * width // 8)
    assert np.array_equal(token_files.unpack(data, 1001, width), ids)
    assert np.array_equal(token_files.unpack(data, 30, width, 501), ids[501:531])


def test_width_is_the_least():
    assert [token_files.width_for(n) for n in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_blocks_are_read_by_offset_and_broken_ones_are_seen():
    docs = [np.arange(k, dtype=np.uint32) for k in (0, 5, 3)]
    data = b"".join(token_files.block([k, 8, 9], docs, 11) + token_files.END for k in (1, 2))
    assert token_files.read_document(data, 1, 1).tolist() == [0, 1, 2, 3, 4]
    assert token_files.read_document(data, 0, 0).tolist() == []
    with pytest.raises(ValueError):
        list(token_files.blocks_of(data[:-1] + b"x"))


def test_byte_level_ids_match_the_library():
    own = token_files.encoder("byte_bpe_50k.json")
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    for text in mixed(8, 500, ["<|endoftext|>", "<|"]):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_new_words_of_a_text_go_to_the_library_in_a_row():
    own = token_files.ByteLevelEncoder("byte_bpe_50k.json")
    library, asked = own.library, []

    class Counted:
        def encode(self, text, **kw):
            asked.append(text)
            return library.encode(text, **kw)

        def encode_batch_fast(self, texts, **kw):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **kw)

    own.library = Counted()
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdeilmnorstuÀßäéſŽ") for _ in range(rnd.randint(1, 12)))
    for k in range(6):
        asked.clear()
        text = " ".join(word() for _ in range(300)) + "  it's 12 x\n"
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(asked) < 12, k


def test_the_piece_table_stays_bounded(monkeypatch):
    texts = [t for _, t in awkward(n=60) if t and len(t) < 5000]
    want = [token_files.ByteLevelEncoder("byte_bpe_50k.json").encode(t).tolist() for t in texts]
    monkeypatch.setattr(token_files, "CACHE_WORDS", 40)
    own = token_files.ByteLevelEncoder("byte_bpe_50k.json")
    assert [own.encode(t).tolist() for t in texts] == want == [own.encode(t).tolist() for t in texts]
    assert len(own.pieces) < 2000


def test_token_files(spark):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    rows = awkward(n=30)
    path = new_path(spark, "test-tokens")
    token_files.write_token_files(table(spark, rows).repartition(4), path)
    got = token_files.document_starts(spark, path).collect()
    ids = [(i, np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for i, t in rows]
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == sorted((str(i), len(x), zlib.crc32(x)) for i, x in ids)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order[0] is None and order[1:] == sorted(order[1:])
    empty = new_path(spark, "test-tokens-empty")
    token_files.write_token_files(table(spark, []), empty)
    assert token_files.document_starts(spark, empty).collect() == []


def test_files_follow_each_other_by_number(spark):
    """The 1000th part of a task comes after its 999th, task 100000 after task 99999."""
    names = [f"file:/x/part-12/part-{task:05d}-8a-4b-c{part:03d}.txt" for task in (0, 7, 99_999, 100_000) for part in (0, 9, 999, 1000)]
    rows = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "file string, k int")
    got = rows.select("k", *token_files.file_order("file")).orderBy("task", "part").collect()
    assert [r["k"] for r in got] == list(range(len(names)))


def test_starts_over_a_thousand_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 1)
    monkeypatch.setattr(token_files, "BLOCKS_PER_FILE", 1)
    docs = spark.range(1050).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")).coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        token_files.write_token_files(docs, str(tmp_path / "t"))
        got = {r["id"]: (r["start"], r["n_tokens"]) for r in token_files.document_starts(spark, str(tmp_path / "t")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(list((tmp_path / "t").glob("part-*"))) == 1050
    assert got == {k: (3 * k, 3) for k in range(1050)}
