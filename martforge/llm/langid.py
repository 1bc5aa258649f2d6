"""Language identification with interpolated Kneser-Ney character models.

Training.  Words (letters, lower-cased) of all labelled training texts are counted per language where they
are read and turned into counts of four-character sequences (word starts and ends are characters of their own);
Spark adds these up.  From the four-character counts follow all lower orders: Kneser-Ney's
lower orders count how many different characters precede a sequence, not how often it occurs.  Each order is
discounted by n1 / (n1 + 2 n2) and interpolated with the next lower one, the first with the uniform distribution.

Model.  A sequence of four 16-bit characters is one 64-bit number, a hash without collisions on the
basic plane; other characters share one code.  The model holds every sequence of every language, however rare.
Spark counts each order, sorts it by language and context, and its tasks write the discounted shares and back-off
weights as sorted arrays, in pieces of about ``PIECE_ROWS`` sequences, one Parquet file each, in the shared folder.  Only
the list of pieces is collected and broadcast; Spark brings the files to the executors' disks, whatever store holds them.
Scoring tasks look up the sequences they meet by binary search, hold at most ``HELD_BYTES`` of pieces (and one more) and
keep the finished log probabilities of recent sequences.

Prediction.  Lowest cross-entropy per character.  The score is the winner's share of the
likelihood over at most ``EVIDENCE`` characters.  Rejection is calibrated on all training texts: a text whose entropy under its best
language exceeds that language's ``REJECT_QUANTILE`` (of the training texts that it wins rightly) is marked ``rejected``; its
prediction stays visible.  ``identified`` scores every text once, for the limits and for its prediction.

Defined cases: null texts and texts without a letter are ``und`` with score 0; without training rows all are ``und``;
ties go to the first language in alphabetical order; a null language is never learned; ids and other columns
are never read by the model; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import append_columns, drop_path, executor_file, new_path, share_files, small_batches, written

ORDER = 4
PIECE_ROWS = 500_000
PIECE_TASKS = 16        # tasks that write an order, at least
HELD_BYTES = 192 << 20   # pieces that a worker keeps
CACHE_BYTES = 64 << 20  # finished log probabilities that a worker keeps
REJECT_QUANTILE = 0.999
RANGES = 4_096  # ranges of entropy a nat, counted before a quantile is looked for in one of them
EVIDENCE = 48
CACHE_WORDS = 250_000
FLUSH_WORDS = 200_000

WORD = re.compile(r"[^\W\d_]+")
PAD = "\x01" * (ORDER - 1)
STOP = "\x02"
LOW = np.int64(0xFFFF)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all four-character sequences of the words, and the word that each belongs to."""
    flat = np.frombuffer("".join([f"{PAD}{w}{STOP}" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.minimum(flat, 0xFFFF).astype(np.uint64)
    keys = (codes[:-3] << np.uint64(48)) | (codes[1:-2] << np.uint64(32)) | (codes[2:-1] << np.uint64(16)) | codes[3:]
    ends = codes[3:] != 1
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return keys[ends], np.repeat(np.arange(len(words)), lengths + 1)


def _gram_counts(batches):
    """``(lang, key, n)`` partial counts of a task."""
    schema = pa.schema([("lang", pa.string()), ("key", pa.int64()), ("n", pa.int64())])
    counts: dict[str, Counter] = {}

    def flush():
        for lang, words in counts.items():
            if not words:
                continue
            keys, of = grams(list(words))
            weight = np.fromiter(words.values(), np.int64, len(words))[of]
            keys, where = np.unique(keys, return_inverse=True)
            n = np.bincount(where, weight).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)],
                                             schema=schema)
        counts.clear()

    for batch in small_batches(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, counts.values())) > FLUSH_WORDS:
            yield from flush()
    yield from flush()


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    """Values by key from sorted arrays."""
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def discount(n1: int, n2: int) -> float:
    """What is taken from each count, from the numbers of sequences seen once and twice."""
    return min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


def level(keys: np.ndarray, counts: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys with their discounted shares, and their contexts with back-off weights."""
    context, where = np.unique(keys >> np.uint64(16), return_inverse=True)
    total = np.bincount(where, counts)
    return keys, (counts - d).clip(0) / total[where], context, d * np.bincount(where) / total


class KneserNey:
    """One language: for each order, discounted shares by sequence and back-off weights by context."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.levels = []
        for order in range(ORDER, 0, -1):
            self.levels.append(level(keys, counts, discount(int((counts == 1).sum()), int((counts == 2).sum()))))
            # one order lower: how many different characters precede each sequence
            keys, counts = np.unique(keys & np.uint64((1 << 16 * (order - 1)) - 1), return_counts=True)

    def find(self, order: int, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of sequences and back-off weights of their contexts."""
        keys, share, context, back = self.levels[ORDER - order]
        return _find(keys, share, part, 0.0), _find(context, back, part >> np.uint64(16), 1.0)

    def probability(self, wanted: np.ndarray, characters: int) -> np.ndarray:
        p = np.full(len(wanted), 1.0 / characters)
        for order in range(1, ORDER + 1):
            share, back = self.find(order, wanted & np.uint64((1 << 16 * order) - 1))
            p = share + back * p
        return p


class StoredKneserNey(KneserNey):
    """The same over pieces in files: for each order ``(first context, file, keys, contexts)``."""

    def __init__(self, pieces: dict[int, list[tuple[int, str, int, int]]]):
        self.pieces = {order: sorted(some) for order, some in pieces.items()}
        self.firsts = {order: np.array([p[0] for p in some], np.uint64) for order, some in self.pieces.items()}

    def find(self, order: int, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        share, back = np.zeros(len(part)), np.ones(len(part))
        at = np.searchsorted(self.firsts[order], part >> np.uint64(16), "right") - 1
        for i in np.unique(at[at >= 0]):
            own = np.flatnonzero(at == i)
            keys, shares, context, backs = _piece(*self.pieces[order][i][1:])
            share[own] = _find(keys, shares, part[own], 0.0)
            back[own] = _find(context, backs, part[own] >> np.uint64(16), 1.0)
        return share, back


_HELD: OrderedDict[str, pa.Buffer] = OrderedDict()


def _piece(name: str, n_keys: int, n_contexts: int) -> tuple[np.ndarray, ...]:
    """The arrays of a piece; those used last are held, up to ``HELD_BYTES``."""
    data = _HELD.pop(name, None)
    if data is None:
        size = 16 * (n_keys + n_contexts)
        while _HELD and sum(b.size for b in _HELD.values()) + size > HELD_BYTES:
            _HELD.popitem(last=False)
        data = pq.read_table(executor_file(name), columns=["data"])["data"][0].as_buffer()
    _HELD[name] = data
    at, out = 0, []
    for kind, n in ((np.uint64, n_keys), (np.float64, n_keys), (np.uint64, n_contexts), (np.float64, n_contexts)):
        out.append(np.frombuffer(data, kind, n, at))
        at += 8 * n
    return tuple(out)


PIECE = "lang string, first long, keys long, contexts long, data binary"


def _pieces(discounts: dict[str, float]):
    """Rows ``(lang, key, n)``, sorted, as pieces, a row each; whole contexts stay together."""
    schema = pa.schema([("lang", pa.string()), ("first", pa.int64()), ("keys", pa.int64()), ("contexts", pa.int64()),
                        ("data", pa.binary())])

    def piece(lang: str, keys: np.ndarray, n: np.ndarray):
        arrays = level(keys, n, discounts[lang])
        return pa.RecordBatch.from_pydict({"lang": [lang], "first": [int(arrays[2][0])], "keys": [len(keys)],
                                           "contexts": [len(arrays[2])],
                                           "data": [b"".join(a.tobytes() for a in arrays)]}, schema=schema)

    def run(batches):
        now, keys, n, size = None, [], [], 0
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            of = langs.indices.to_numpy()
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else []
            for a, b in zip(starts, [*starts[1:], len(of)]):
                lang = langs.dictionary[int(of[a])].as_py()
                if lang != now and size:
                    yield piece(now, np.concatenate(keys), np.concatenate(n))
                    keys, n, size = [], [], 0
                now = lang
                keys.append(batch.column(1).to_numpy()[a:b].view(np.uint64))
                n.append(batch.column(2).to_numpy()[a:b])
                size += b - a
                if size >= PIECE_ROWS:
                    every, counts = np.concatenate(keys), np.concatenate(n)
                    last = np.searchsorted(every, every[-1] >> np.uint64(16) << np.uint64(16))
                    if last:
                        yield piece(now, every[:last], counts[:last])
                    keys, n, size = [every[last:]], [counts[last:]], len(every) - last
        if size:
            yield piece(now, np.concatenate(keys), np.concatenate(n))

    return run


class LanguageModel:
    """All languages, and the finished log probabilities of the sequences met last."""

    def __init__(self, languages: list[str], models: list[KneserNey], characters: int):
        self.languages, self.models, self.characters = languages, models, characters
        self.limits = np.full(len(languages), np.inf)
        self._start()

    def _start(self):
        self.row = {}
        self.rows = np.zeros((0, len(self.languages)))
        self._forget()

    def _forget(self):
        self.keys, self.logs = np.zeros(0, np.uint64), np.zeros((0, len(self.languages)), np.float32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("row", "rows", "keys", "logs")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def _logs(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros((len(keys), len(self.models)), np.float32)
        for i, m in enumerate(self.models):
            out[:, i] = np.log(m.probability(keys, self.characters))
        return out

    def gram_logs(self, keys: np.ndarray) -> np.ndarray:
        """Log probabilities of sorted different sequences in each language."""
        fresh = keys[~np.isin(keys, self.keys, assume_unique=True)]
        if len(fresh):
            if (len(self.keys) + len(fresh)) * (8 + 4 * len(self.languages)) > CACHE_BYTES:
                self._forget()
                fresh = keys
            every = np.concatenate((self.keys, fresh))
            order = np.argsort(every, kind="stable")
            self.keys, self.logs = every[order], np.concatenate((self.logs, self._logs(fresh)))[order]
        return self.logs[np.searchsorted(self.keys, keys)]

    def word_logs(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        keys, of = grams(words)
        different, where = np.unique(keys, return_inverse=True)
        logs = self.gram_logs(different)[where]
        starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        return np.add.reduceat(logs.astype(np.float64), starts, axis=0)

    def texts_logs(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Summed log probabilities and numbers of characters of texts, each a list of words (not empty)."""
        if len(self.row) > CACHE_WORDS:
            self.row, self.rows = {}, np.zeros((0, len(self.languages)))
        fresh = list(set().union(*texts).difference(self.row))
        for at in range(0, len(fresh), 20_000):
            some = fresh[at:at + 20_000]
            base = len(self.row)
            self.row.update(zip(some, range(base, base + len(some))))
            if len(self.row) > len(self.rows):
                grown = np.zeros((max(len(self.row), 2 * len(self.rows)), len(self.languages)))
                grown[:base] = self.rows[:base]
                self.rows = grown
            self.rows[base:base + len(some)] = self.word_logs(some)
        row = self.row
        sums, sizes = [], []
        for words in texts:
            sums.append(self.rows[[row[w] for w in words]].sum(axis=0))
            sizes.append(sum(map(len, words)) + len(words))
        return np.array(sums), np.array(sizes)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        """``(language, score, entropy, rejected)`` of each text."""
        split = [words_of(t) if t else [] for t in texts]
        some = [i for i, words in enumerate(split) if any(c.isalpha() for w in words for c in w)]
        out: list[tuple[str, float, float | None, bool]] = [("und", 0.0, None, True)] * len(texts)
        if not some or not self.languages:
            return out
        sums, sizes = self.texts_logs([split[i] for i in some])
        entropy = -sums / sizes[:, None]
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(some)), best]
        likely = np.exp(-(entropy - lowest[:, None]) * np.minimum(sizes, EVIDENCE)[:, None])
        for i, b, h, p in zip(some, best, lowest, 1.0 / likely.sum(axis=1)):
            out[i] = (self.languages[b], float(p), float(h), bool(h > self.limits[b]))
        return out


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", calibration_rows: int | None = None) -> LanguageModel:
    """A model from all rows of ``docs`` (the training rows), which calibrate rejection too.

    ``calibration_rows=0`` leaves calibration out; there is no other number, since limits never come from a sample.
    """
    if calibration_rows:
        raise ValueError("rejection is calibrated on all rows (None) or not at all (0)")
    rows = _labelled(docs.where(F.col(lang_col).isNotNull()), text_col, lang_col)
    counts = rows.mapInArrow(_gram_counts, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    model = _stored_model(counts)
    if model.languages and calibration_rows is None:
        scored = written(predicted(rows, model).select("lang", "__lang"), "langid-scored")
        for lang, limit in rejection_limits(scored, "lang").items():
            model.limits[model.languages.index(lang)] = limit
    return model


def identified(docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without its text and with ``__lang`` as by ``predicted``, for a model of the rows where ``training`` holds.

    The scores of the training rows are those that calibrate rejection, so no text is scored twice.
    """
    model = train(docs.where(training), text_col, lang_col, calibration_rows=0)
    marked = docs.withColumn("__known", F.when(training, F.col(lang_col)))
    scored = written(predicted(marked, model, text_col).drop(text_col), "langid-scored")
    limits = rejection_limits(scored, "__known")
    if limits:
        limit = F.element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("__lang.lang"))
        over = F.col("__lang.entropy") > F.coalesce(limit, F.lit(float("inf")))
        scored = scored.withColumn("__lang", F.col("__lang").withField("rejected", F.coalesce(over, F.lit(True))))
    return scored.drop("__known")


def rejection_limits(scored: DataFrame, known_col: str) -> dict[str, float]:
    """``percentile(entropy, REJECT_QUANTILE)`` of each language over all texts that its model wins rightly.

    Ranges of entropy are counted first; only the different values in the ranges that hold the wanted places are put in order,
    so no task holds a language's values.  Two rows a language reach the driver.
    """
    rows = scored.where(F.col(known_col) == F.col("__lang.lang")).select(
        F.col(known_col).alias("lang"), F.col("__lang.entropy").alias("h")).where(F.col("h").isNotNull())
    rows = rows.withColumn("range", F.floor(F.col("h") * RANGES))
    before = lambda order, *by: F.coalesce(F.sum("n").over(
        Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    holds = (F.col("before") <= F.ceil("place")) & (F.col("before") + F.col("n") > F.floor("place"))
    ranges = (rows.groupBy("lang", "range").agg(F.count(F.lit(1)).alias("n"))
              .select("lang", "range", "n", before("range", "lang").alias("before"),
                      ((F.sum("n").over(Window.partitionBy("lang")) - 1) * F.lit(REJECT_QUANTILE)).alias("place"))
              .where(holds).select("lang", "range", "place", F.col("before").alias("first")))
    values = (rows.join(F.broadcast(ranges), ["lang", "range"]).groupBy("lang", "range", "place", "first", "h")
              .agg(F.count(F.lit(1)).alias("n"))
              .select("lang", "place", "h", "n", (F.col("first") + before("h", "lang", "range")).alias("before")).where(holds))
    share = F.col("place") - F.floor("place")
    found = values.groupBy("lang").agg(((1 - F.max(share)) * F.min("h") + F.max(share) * F.max("h")).alias("h"))
    return {r["lang"]: r["h"] for r in found.collect()}


def _stored_model(counts: DataFrame) -> LanguageModel:
    """The model of ``(lang, key, n)``, one row for each sequence of a language; its arrays stay in files in the shared folder."""
    spark = counts.sparkSession
    found: dict[str, dict[int, list]] = {}
    characters, before = 0, None
    for order in range(ORDER, 0, -1):
        path, tasks = new_path(spark, f"langid-{order}"), PIECE_TASKS
        counts.write.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
        counts = spark.read.schema("lang string, key long, n long").parquet(path)
        discounts = {}
        for r in counts.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("n") == 1).alias("n1"),
                                            F.count_if(F.col("n") == 2).alias("n2")).collect():
            discounts[r["lang"]] = discount(r["n1"], r["n2"])
            tasks += r["rows"] // PIECE_ROWS
        context, low = F.shiftrightunsigned("key", 16), F.col("key").bitwiseAND(F.lit(0xFFFF))
        folder = new_path(spark, f"langid-pieces-{order}")
        (counts.repartitionByRange(tasks, "lang", context).sortWithinPartitions("lang", context, low)
         .mapInArrow(_pieces(discounts), PIECE).write.option("maxRecordsPerFile", 1).parquet(folder))
        share_files(spark, folder)
        pieces = spark.read.schema(PIECE).parquet(folder).select(
            "lang", "first", "keys", "contexts", F.substring_index(F.input_file_name(), "/", -1).alias("file"))
        for r in pieces.collect():  # a row for each piece
            found.setdefault(r["lang"], {}).setdefault(order, []).append((r["first"], r["file"], r["keys"], r["contexts"]))
        if order == 1:
            characters = counts.select("key").distinct().count() + 1
        else:
            # one order lower: how many different characters precede each sequence
            rest = F.col("key").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))
            counts = counts.groupBy("lang", rest.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    drop_path(spark, before)
    languages = sorted(found)
    return LanguageModel(languages, [StoredKneserNey(found[x]) for x in languages], characters)


def _labelled(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.where(F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))


def predicted(docs: DataFrame, model: LanguageModel, text_col: str = "text", text: Column | None = None) -> DataFrame:
    """``docs`` with ``__lang``: struct of lang, score, entropy, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the list of its pieces
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()), ("rejected", pa.bool_())])

    def run(batch: pa.RecordBatch) -> dict:
        names = ("lang", "score", "entropy", "rejected")
        return {"__lang": [dict(zip(names, x)) for x in shared.value.predict(batch.column(0).to_pylist())]}

    source = docs[f"`{text_col}`"] if text is None else text
    return append_columns(docs, {"text": source}, run,
                          "__lang struct<lang:string,score:double,entropy:double,rejected:boolean>",
                          pa.schema([("__lang", kind)]))
