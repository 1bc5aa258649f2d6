"""Benchmark decontamination: BM25 over the test items, block-max WAND, then question and answer overlap.

Index: an inverted index of the test items.  A posting's impact is its BM25 term weight divided by the item's
total, so a passage's score is the share of the item's BM25 mass that the passage covers, and one
threshold serves all items.  Items are numbered in blocks; each term keeps its largest impact overall
and in each block.

Queries: every passage of every text.  A text's words are cut into segments as long as the longest item (with room
for inserted words); a passage is two segments in a row, and passages overlap by one, so each item lies in one of them
whole.  For a batch of texts at once:

1. the terms' largest impacts, summed over a passage, bound its score; passages below the threshold end here;
2. the terms' block maxima, summed, bound it for each block of items; blocks below the threshold end here;
3. what is left is scored exactly, term by term; all items above the threshold are retrieved;
4. an item counts if the passage holds ``min_overlap`` of its ``shingle``-word shingles, and parts of its question
   and of its answer (``min_part`` of either's words in a row).

Both bounds only overestimate, so nothing above the threshold is lost.

The statistics of BM25 (number of items, document frequencies, mean length) and the length of passages are those of the
whole benchmark: Spark counts them once, and each item carries the frequencies of its own words.  Only the
postings are cut, by hashes of the items, into indexes of about ``INDEX_BYTES`` of item text (one larger item makes its
own larger), so results do not depend on where the cuts fall.  A task builds an index from its items and writes it
to the shared folder (a few times its text: postings, and block maxima only where a block has the term);
neither items nor indexes pass through the driver's memory, and nothing is broadcast.  Spark brings the files to the
executors.  One pass over the documents tokenises each text once and looks a group of texts up in one index
after the other; a worker keeps up to ``HELD_BYTES`` of indexes and holds one more at a time.

Question and answer: an item's text after ``Answer:`` is its answer, else what follows the last question
mark, else its last line, else its last sentence; an item of one sentence is all question.

Defined cases: null and empty texts match nothing; items without words are skipped; repeated items are each reported;
repeated ids are separate rows; a null id is kept; an empty table on either side gives no match; other
columns pass through.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import append_columns, executor_file, new_path, share_files, written

THRESHOLD = 0.5
SHINGLE = 5
MIN_OVERLAP = 0.8
MIN_PART = 0.5
K1, B = 1.2, 0.75
INDEX_BYTES = 4 << 20
MAX_BLOCKS = 128     # blocks of items in one index
HELD_BYTES = 64 << 20  # indexes that a worker keeps between groups of texts, in bytes of their files
GROUP_WORDS = 150_000

WORD = re.compile(r"[^\W_]+")
ANSWER = re.compile(r"\banswer\s*:", re.IGNORECASE)
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_answer(text: str) -> tuple[str, str]:
    """The question and the answer of an item."""
    if m := ANSWER.search(text):
        return text[:m.start()], text[m.end():]
    at = text.rfind("?")
    if at >= 0 and WORD.search(text, at):
        return text[:at + 1], text[at + 1:]
    lines = text.strip().split("\n")
    if len(lines) > 1:
        return "\n".join(lines[:-1]), lines[-1]
    sentences = SENTENCE.split(text.strip())
    return (" ".join(sentences[:-1]), sentences[-1]) if len(sentences) > 1 else (text, "")


def shingles(words: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def share_of(part: list[str], passage: list[str], size: int) -> float:
    """Share of the part's words that lie in one of its runs of ``size`` words found in the passage."""
    size = min(size, len(part))
    if not size:
        return 1.0
    have = shingles(passage, size)
    covered = [False] * len(part)
    for i in range(len(part) - size + 1):
        if tuple(part[i:i + size]) in have:
            covered[i:i + size] = [True] * size
    return sum(covered) / len(part)


@dataclass(frozen=True)
class Statistics:
    """Of all items with words: their number, total and largest number of words."""

    items: int
    words: int
    longest: int
    text_bytes: int = 0


class BlockMaxIndex:
    """Inverted index of some items with block maxima.

    ``items`` are ``(id, text)``, or ``(id, text, document frequency of each word)`` with the ``statistics`` of all
    items that the index is a part of; without them, the items given are all.
    """

    def __init__(self, items: list[tuple], statistics: Statistics | None = None):
        self.items, counts = [], []
        known: dict[str, int] = {}
        for item, text, *frequencies in items:
            words = words_of(text)
            if words:
                question, answer = question_answer(text)
                self.items.append((item, words, words_of(question), words_of(answer)))
                if frequencies:
                    known.update(frequencies[0])
        n = len(self.items)
        longest = max((len(x[1]) for x in self.items), default=0)
        whole = statistics or Statistics(n, sum(len(x[1]) for x in self.items), longest)
        # numbered in the order of the words, so a score is the same sum in every cut
        self.vocabulary = {w: t for t, w in enumerate(sorted({w for x in self.items for w in x[1]}))}
        one = {w: w for w in self.vocabulary}  # an image holds each word once
        self.items = [(item, *([one[w] for w in part] for part in parts)) for item, *parts in self.items]
        for _, words, _, _ in self.items:
            own: dict[int, int] = {}
            for w in words:
                t = self.vocabulary[w]
                own[t] = own.get(t, 0) + 1
            counts.append(own)
        if statistics:
            df = np.array([known[w] for w in self.vocabulary], np.int64)
        else:
            df = np.bincount([t for own in counts for t in own], minlength=len(self.vocabulary))
        idf = np.log1p((whole.items - df + 0.5) / (df + 0.5))
        mean = whole.words / max(1, whole.items)
        self.block_items = max(1, -(-n // MAX_BLOCKS))
        self.n_blocks = -(-n // self.block_items)
        postings: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        for i, own in enumerate(counts):
            length = K1 * (1 - B + B * len(self.items[i][1]) / mean)
            impact = {t: float(idf[t]) * f * (K1 + 1) / (f + length) for t, f in own.items()}
            total = sum(impact.values())
            for t, x in impact.items():
                postings[t].append((i, x / total))
        self.posting_start = np.cumsum([0, *map(len, postings)])
        self.posting_item = np.array([i for p in postings for i, _ in p], np.int64)
        self.posting_impact = np.array([x for p in postings for _, x in p])
        # the largest impact of a term in each block that has it, and over all
        term = np.repeat(np.arange(len(postings)), np.diff(self.posting_start))
        place, at = np.unique(term * max(1, self.n_blocks) + self.posting_item // self.block_items, return_inverse=True)
        self.max_impact = np.zeros(len(place), np.float32)
        np.maximum.at(self.max_impact, at, self.posting_impact.astype(np.float32))
        self.max_block = (place % max(1, self.n_blocks)).astype(np.int32)
        self.max_start = np.searchsorted(place, np.arange(len(postings) + 1) * max(1, self.n_blocks))
        self.most = np.zeros(len(postings), np.float32)
        np.maximum.at(self.most, place // max(1, self.n_blocks), self.max_impact)
        self.segment = max(SHINGLE, whole.longest + whole.longest // 4)

    def passages(self, texts: list[list[str]], threshold: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(text, first word, blocks, terms)`` of the passages that the bounds leave."""
        term, size = self.vocabulary.get, self.segment
        terms = [np.fromiter(map(term, t, repeat(-1)), np.int64, len(t)) for t in texts]
        lengths = np.array([-(-len(t) // size) for t in terms])
        first = np.cumsum(lengths) - lengths  # the text's first segment
        last = first + lengths - 1
        where = [np.arange(len(t)) // size + at for t, at in zip(terms, first)]
        term_of, segment_of = np.concatenate(terms), np.concatenate(where)
        known = term_of >= 0
        v = len(self.vocabulary)
        pairs = np.unique(segment_of[known] * v + term_of[known])
        segment_of, term_of = pairs // v, pairs % v
        n = int(lengths.sum())
        slack = 1e-4
        bound = np.bincount(segment_of, self.most[term_of], n)
        follows = np.ones(n, bool)  # the next segment is of the same text
        follows[last[lengths > 0]] = False
        joined = bound + np.where(follows, np.append(bound[1:], 0), 0)
        alive = joined >= threshold - slack
        need = alive | np.append(False, (alive & follows)[:-1])
        keep = need[segment_of]
        segment_of, term_of = segment_of[keep], term_of[keep]
        if not len(segment_of):
            return
        sums = np.zeros((n + 1, self.n_blocks), np.float32)
        step = 500_000
        for at in range(0, len(segment_of), step):
            some, own = term_of[at:at + step], segment_of[at:at + step]
            sizes = self.max_start[some + 1] - self.max_start[some]
            places = np.repeat(self.max_start[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            cells = np.repeat(own, sizes) * self.n_blocks + self.max_block[places]
            used, cell = np.unique(cells, return_inverse=True)
            sums.reshape(-1)[used] += np.bincount(cell, self.max_impact[places], len(used)).astype(np.float32)
        for s in np.flatnonzero(alive):
            both = sums[s] + sums[s + 1] if follows[s] else sums[s]
            blocks = np.flatnonzero(both >= threshold - slack)
            if len(blocks):
                text = int(np.searchsorted(first, s, side="right")) - 1
                while lengths[text] == 0:
                    text -= 1
                a, b = np.searchsorted(segment_of, (s, s + 1 + bool(follows[s])))
                yield text, int(s - first[text]) * size, blocks, np.unique(term_of[a:b])

    def score(self, terms: np.ndarray, blocks: np.ndarray) -> list[tuple[int, float]]:
        """Exact scores of the items of some blocks, for a passage's different terms."""
        starts, sizes = self.posting_start[terms], self.posting_start[terms + 1] - self.posting_start[terms]
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        scores = np.bincount(self.posting_item[at], self.posting_impact[at], len(self.items))
        items = (blocks[:, None] * self.block_items + np.arange(self.block_items)[None, :]).ravel()
        items = items[items < len(self.items)]
        return list(zip(items.tolist(), scores[items].tolist()))

    def matches(self, texts: list[list[str]], threshold: float = THRESHOLD, min_overlap: float = MIN_OVERLAP,
                min_part: float = MIN_PART) -> list[list[dict]]:
        """For each text its verified items, each by its best passage."""
        best: list[dict[int, dict]] = [{} for _ in texts]
        if not self.items:
            return [[] for _ in texts]
        for text, at, blocks, terms in self.passages(texts, threshold):
            passage, have = texts[text][at:at + 2 * self.segment], None
            for i, score in self.score(terms, blocks):
                if score < threshold:
                    continue
                have = have or shingles(passage)
                item, words, question, answer = self.items[i]
                if len(words) < SHINGLE:
                    overlap = share_of(words, passage, SHINGLE)
                else:
                    own = shingles(words)
                    overlap = len(own & have) / len(own)
                if overlap < min_overlap:
                    continue
                q, a = share_of(question, passage, 3), share_of(answer, passage, 3)
                if min(q, a) >= min_part and overlap > best[text].get(i, {"overlap": -1})["overlap"]:
                    best[text][i] = {"item_id": item, "first_word": at, "bm25_share": score, "overlap": overlap,
                                     "question_overlap": q, "answer_overlap": a}
        return [[found[i] for i in sorted(found)] for found in best]


def item_rows(bench: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, Statistics]:
    """``key, item, text, frequencies`` of the items with words, and the statistics of all; counted in Spark."""
    schema = pa.schema([("words", pa.list_(pa.string())), ("size", pa.int64())])

    def run(batch):
        found = [words_of(t or "") for t in batch.column("text").to_pylist()]
        return {"words": [sorted(set(w)) for w in found], "size": [len(w) for w in found]}

    given = bench.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")).withColumn(
        "key", F.monotonically_increasing_id())
    items = written(append_columns(given, {"text": given["text"]}, run, "words array<string>, size long", schema)
                    .where("size > 0"), "items")
    total = items.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"), F.max("size").alias("longest"),
                      F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    words = items.select("key", F.explode("words").alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    of_item = words.join(counts, "word").groupBy("key").agg(  # an item's own words
        F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("frequencies"))
    return (items.join(of_item, "key").select("key", "item", "text", "frequencies"),
            Statistics(total["n"], total["words"] or 0, total["longest"] or 0, total["bytes"] or 0))


def _order(item: tuple) -> tuple:
    return item[0] is None, item[0] or 0, item[1]


def index_files(bench: DataFrame, item_col: str, text_col: str) -> list[str]:
    """Names of the index files on the executors, each an index of about ``INDEX_BYTES`` of item text."""
    rows, statistics = item_rows(bench, item_col, text_col)
    cuts = -(-statistics.text_bytes // INDEX_BYTES)
    if not cuts:
        return []
    schema = pa.schema([("cut", pa.int64()), ("image", pa.binary())])

    def build(key: tuple, group: pa.Table) -> pa.Table:
        items = zip(group["item"].to_pylist(), group["text"].to_pylist(), map(dict, group["frequencies"].to_pylist()))
        index = BlockMaxIndex(sorted(items, key=_order), statistics)
        image = pickle.dumps(index, protocol=pickle.HIGHEST_PROTOCOL)
        return pa.table({"cut": [key[0].as_py()], "image": pa.array([image], pa.binary())}, schema=schema)

    spark, path = bench.sparkSession, new_path(bench.sparkSession, "indexes")
    made = (rows.withColumn("cut", F.pmod(F.xxhash64("key"), F.lit(cuts))).groupBy("cut")
            .applyInArrow(build, "cut long, image binary"))
    made.write.option("maxRecordsPerFile", 1).parquet(path)
    return share_files(spark, path)


_HELD: dict[str, tuple[BlockMaxIndex, int]] = {}


def held_index(name: str) -> BlockMaxIndex:
    """The index of a file; the first ones, ``HELD_BYTES`` together, stay in the worker."""
    if name in _HELD:
        return _HELD[name][0]
    image = pq.read_table(executor_file(name), columns=["image"]).column("image")[0].as_buffer()
    index = pickle.loads(image)
    if sum(size for _, size in _HELD.values()) + image.size <= HELD_BYTES:
        _HELD[name] = index, image.size
    return index


HIT = ("item_id long, first_word long, bm25_share double, overlap double, question_overlap double, "
       "answer_overlap double")
_HIT = pa.struct([("item_id", pa.int64()), ("first_word", pa.int64()), ("bm25_share", pa.float64()),
                  ("overlap", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
HITS = "__benchmark_items"


def with_matches(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", threshold: float = THRESHOLD, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``docs`` with the column ``HITS``: the benchmark items found in each text (empty: clean)."""
    schema = pa.schema([("found", pa.list_(_HIT))])
    files = index_files(bench, item_col, item_text)
    if not files:
        return docs.withColumn(HITS, F.array().cast(f"array<struct<{_ddl()}>>"))

    def matches(group: list[list[str]]) -> list[list[dict]]:
        found: list[list[dict]] = [[] for _ in group]
        for name in files:
            for own, more in zip(found, held_index(name).matches(group, threshold, min_overlap)):
                own += more
        return found

    def run(batch: pa.RecordBatch) -> dict:
        result, group, size = [], [], 0
        for text in batch.column("text").to_pylist():
            group.append(words_of(text or ""))
            size += len(group[-1])
            if size > GROUP_WORDS:
                result += matches(group)
                group, size = [], 0
        return {"found": result + (matches(group) if group else [])}

    made = append_columns(docs, {"text": docs[f"`{text_col}`"]}, run, f"found array<struct<{_ddl()}>>", schema)
    return made.toDF(*docs.columns, HITS)


def _ddl() -> str:
    return ", ".join(f"{n}:{t}" for n, t in (x.split(" ") for x in HIT.split(", ")))


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document and benchmark item found in it."""
    return (with_matches(docs, bench, **options).select(F.col(id_col), F.explode(HITS).alias("hit"))
            .select(id_col, "hit.*"))


def decontaminated(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, unchanged."""
    return with_matches(docs, bench, **options).where(F.size(HITS) == 0).drop(HITS)
