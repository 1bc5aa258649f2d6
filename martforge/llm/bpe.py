"""BPE encoding and decoding over contiguous rank arrays.

A word's parts lie in one array of symbol ids, beside it the ranks of adjacent pairs.  The smallest
rank (the leftmost of equals) is searched, its boundary deleted, and the two neighbouring ranks
are looked up again, until no pair has a rank.  Short words are merged together: the arrays of
many words are the rows of one matrix, and each step merges one pair in every row that
still has one.  Words longer than ``LONG_WORD`` symbols use a heap over linked parts, in
n log n instead of n squared, with the same result.

The vocabulary, merges, normaliser and splitting pattern are those of a public tokenizer file: NFC,
white space to one space, lower case by character; words, contractions, single digits and runs of other
marks; bytes as printable symbols, ``</w>`` at a word's end.  Its special tokens are recognised in raw text.
Decoding maps ids to their symbols, joined by one space, as the file (which names no decoder) has it.

A word's ids are kept in a bounded table per Python worker, as words repeat; the table's two
generations drop words that did not come again.

Defined cases: null and empty texts have no ids and decode to the empty text; ids outside the
vocabulary are skipped when decoded; ids of documents are passed through, repeated or null;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import map_batches, tokenizer_path

NO_RANK = np.int32(1 << 30)
LONG_WORD = 48
CACHE_WORDS = 250_000  # words of one generation of the table

#: Lower-case forms of letters newer than this interpreter's character table (single ones, then
#: ranges as first, last, distance).
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
             0xA7DA: 0xA7DB, 0xA7DC: 0x019B}
#: Letters and numbers newer than that table (first, last).
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
               (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
NEW_LOWER_RANGES = ((0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B))


def _class_of_new(c: str) -> str:
    """A stand-in of the same class for a character that this interpreter's table does not hold."""
    at = ord(c)
    if any(a <= at <= b for a, b in NEW_LETTERS):
        return "\u0298"
    return "\u00b2" if any(a <= at <= b for a, b in NEW_NUMBERS) else "\ue000"


class WordBpe:
    """The tokenizer of one file."""

    def __init__(self, name: str):
        with open(tokenizer_path(name), encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.symbols = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(shown)]
        self.byte_symbol = [""] * 256
        for b in shown:
            self.byte_symbol[b] = chr(b)
        for i, b in enumerate(rest):
            self.byte_symbol[b] = chr(256 + i)
        self.inner = np.array([self.ids[s] for s in self.byte_symbol], np.int32)
        self.final = np.array([self.ids[s + self.suffix] for s in self.byte_symbol], np.int32)
        # pair (left id, right id) -> rank and merged id, in sorted arrays for whole rows of lookups
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([(self.ids[a] << 32) | self.ids[b] for a, b in pairs], np.int64)
        merged = np.array([self.ids[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int32)
        self.merged_of_rank = merged
        self.rank_of = {int(k): int(r) for k, r in zip(self.pair_keys, self.pair_ranks)}
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        # the fast path: on these characters the classes are known, and NFC changes nothing
        latin = "a-zß-öø-ÿ"
        self.plain = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ–—‘’“”„…«»¿¡]*")
        self.plain_words = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{latin}]+|[0-9]|[^\s0-9{latin}]+")
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.space = regex.compile(r"\s+")
        self.lower = NEW_LOWER | {c: c + d for a, b, d in NEW_LOWER_RANGES for c in range(a, b + 1)} | {ord("Σ"): "σ"}
        self.marked = {s: (1, str(i), s) for s, i in self.special.items()}
        self.known: dict[str, tuple[int, str, str]] = dict(self.marked)  # word: number of ids, ids, decoded
        self.older: dict[str, tuple[int, str, str]] = {}

    # -- merging ------------------------------------------------------------------------------------------
    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of adjacent pairs; NO_RANK where they do not merge.  A negative id is no symbol."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (right >= 0), self.pair_ranks[at], NO_RANK)

    def merge_rows(self, rows: list[bytes]) -> list[list[int]]:
        """Ids of many short words at once."""
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        width = int(lengths.max())
        parts = np.full((len(rows), width + 1), -1, np.int32)
        flat = np.frombuffer(b"".join(rows), np.uint8)
        row_of = np.repeat(np.arange(len(rows)), lengths)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        last = column == lengths[row_of] - 1
        parts[row_of, column] = np.where(last, self.final[flat], self.inner[flat])
        rank = np.full((len(rows), width + 1), NO_RANK, np.int32)
        rank[:, :-1] = self.ranks(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(len(rows), width)
        columns = np.arange(width + 1)
        active = np.arange(len(rows))
        while len(active):
            best = rank[active].argmin(axis=1)
            least = rank[active, best]
            more = least < NO_RANK
            active, best, least = active[more], best[more], least[more]
            if not len(active):
                break
            # delete the boundary: everything right of the pair moves one place left
            source = np.minimum(columns[None, :] + (columns[None, :] > best[:, None]), width)
            some, some_rank = parts[active[:, None], source], rank[active[:, None], source]
            n = np.arange(len(active))
            some[n, best] = self.merged_of_rank[least]
            some[:, width] = -1
            some_rank[:, width] = NO_RANK
            # refresh the neighbouring ranks
            some_rank[n, best] = self.ranks(some[n, best], some[n, np.minimum(best + 1, width)])
            before = np.flatnonzero(best > 0)
            some_rank[before, best[before] - 1] = self.ranks(some[before, best[before] - 1], some[before, best[before]])
            parts[active], rank[active] = some, some_rank
        return [row[:n].tolist() for row, n in zip(parts, (parts >= 0).sum(axis=1))]

    def merge_long(self, word: bytes) -> list[int]:
        """Ids of one long word: the same merges, from a heap of (rank, position)."""
        raw = np.frombuffer(word, np.uint8)
        part = self.inner[raw].tolist()
        part[-1] = int(self.final[raw[-1]])
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1)
                if (r := self.rank_of.get((part[i] << 32) | part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if part[i] == a else n
            if j >= n or part[j] != b or part[i] != a:
                continue
            part[i], part[j] = int(self.merged_of_rank[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                r = self.rank_of.get((part[i] << 32) | part[after[i]])
                if r is not None:
                    heapq.heappush(heap, (r, i, part[i], part[after[i]]))
            if before[i] >= 0:
                r = self.rank_of.get((part[before[i]] << 32) | part[i])
                if r is not None:
                    heapq.heappush(heap, (r, before[i], part[before[i]], part[i]))
        return [p for p in part if p >= 0]

    # -- texts --------------------------------------------------------------------------------------------
    def normalised(self, text: str) -> str:
        text = self.space.sub(" ", unicodedata.normalize("NFC", text))
        # lower case by character: a final sigma is no special case here
        return text.translate(self.lower).lower()

    def words_of(self, text: str) -> list[str]:
        """The words of a text; special tokens stay apart, as the tokenizer has them."""
        if "<|" in text and self.marks.search(text):
            return [w for part in self.marks.split(text)
                    for w in ([part] if part in self.special else self.words_of(part))]
        if self.plain.fullmatch(text):
            return self.plain_words.findall(text.lower())
        text = self.normalised(text)
        seen = "".join([_class_of_new(c) if unicodedata.category(c) == "Cn" else c for c in text])
        return [text[m.start():m.end()] for m in self.words.finditer(seen)]

    def learn(self, words: list[str]) -> None:
        """Put new words into the table."""
        spelled = {w: w.encode("utf-8", "surrogatepass") for w in words}
        short = sorted([w for w in words if len(spelled[w]) <= LONG_WORD], key=lambda w: len(spelled[w]))
        found = [(w, self.merge_long(spelled[w])) for w in words if len(spelled[w]) > LONG_WORD]
        for at in range(0, len(short), 8192):
            some = short[at:at + 8192]
            found += zip(some, self.merge_rows([spelled[w] for w in some]))
        symbols = self.symbols
        for w, ids in found:
            self.known[w] = (len(ids), " ".join(map(str, ids)), " ".join([symbols[i] for i in ids]))

    def decode(self, ids) -> str:
        return " ".join([s for i in ids if (s := self.symbols.get(i)) is not None])

    def encode(self, text: str) -> list[int]:
        return [int(i) for e in self.entries([self.words_of(text)])[0] for i in e[1].split(" ")]

    def entries(self, texts: list[list[str]]) -> list[list[tuple[int, str, str]]]:
        """Table entries of the words of some texts; new words of all of them are merged together."""
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = dict(self.marked), self.known
        known, older = self.known, self.older
        fresh = set().union(*texts).difference(known)
        if fresh:
            for w in fresh.intersection(older):
                known[w] = older[w]
            self.learn(list(fresh.difference(older)))
        return [[known[w] for w in words] for words in texts]


_LOADED: dict[str, WordBpe] = {}


def tokenizer(name: str) -> WordBpe:
    """One tokenizer a Python worker."""
    if name not in _LOADED:
        _LOADED[name] = WordBpe(name)
    return _LOADED[name]


def _rows(batch: pa.RecordBatch, name: str):
    """``(ids as text, decoded text, number of ids)`` of each text, in groups of bounded size."""
    tok, group, size = tokenizer(name), [], 0

    def flush():
        for found in tok.entries(group):
            yield " ".join([e[1] for e in found]), " ".join([e[2] for e in found]), sum([e[0] for e in found])

    for text in batch.column(1).to_pylist():
        group.append(tok.words_of(text or ""))
        size += len(group[-1])
        if size > 200_000:
            yield from flush()
            group, size = [], 0
    yield from flush()


def encode_documents(docs: DataFrame, name: str = "word_bpe_49k.json", id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>, decoded string`` of every whole text."""
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batch: pa.RecordBatch) -> dict:
        rows = list(_rows(batch, name))
        return {"id": batch.column(0), "ids": [list(map(int, r[0].split())) for r in rows], "decoded": [r[1] for r in rows]}

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_batches(src, run, "id long, ids array<int>, decoded string", schema).withColumnRenamed("id", id_col)


def digest_documents(docs: DataFrame, name: str = "word_bpe_49k.json", id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: the same rows, digested where they are made."""
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])

    def run(batch: pa.RecordBatch) -> dict:
        rows = [(n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                for ids, decoded, n in _rows(batch, name)]
        return {"id": batch.column(0), "n_tokens": [r[0] for r in rows], "ids_sha256": [r[1] for r in rows],
                "decoded_sha256": [r[2] for r in rows]}

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_batches(src, run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                       schema).withColumnRenamed("id", id_col)
