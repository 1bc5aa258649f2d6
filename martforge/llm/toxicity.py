"""Toxicity by a weighted finite-state pattern grammar.

Terminals.  Insults are learned: words, and word beginnings that many words share, that occur in far
more toxic than clean training texts; their weight is the smoothed log ratio.  Threat verbs, intent words, targets,
negations and words of reported speech are fixed lists.

Grammar.  A clause is what lies between sentence marks and line breaks; its tokens are words, with contractions
and elisions taken apart (``i'll``: i will, ``don't``: do not, ``t'es``: te es), and quotation marks.  A token's symbol is its word
class.  Five weighted transducers, each a table of states and arcs, read the symbols:

* ``NEGATION``: a negation word scales what the next tokens add;
* ``REPORTED``: after a word of saying, or inside quotation marks, what is added is scaled;
* ``threat``: reads the symbol with the factor of the two before; intent, threat verb, target in this order add a fixed
  weight times the verb's factor, and so does an imperative verb that opens the clause right before a reflexive;
* ``TARGET``: remembers that a target was seen; its final weight scales the clause's insults;
* insult: one state, an arc for each learned terminal, whose weight is scaled by the factor.

``compose`` makes one deterministic table of them (``PRODUCT``), built once: negation and reported speech
in parallel, their factor fed to threats and insults, the target beside them.  A clause's score is the weight of its path.
A lone insult is an accepting pattern of its own and adds its
whole weight, because the labels of the tables call such texts toxic; a target only strengthens it, and a threat verb
alone adds nothing.  A text's features are its best clause and the saturated sum over its clauses, and a logistic function, fitted on the
training rows, maps them to 0 .. 1.

Training uses about ``TRAIN_ROWS`` labelled rows (chosen by the hash of the id), each different text once,
with the label of most of its copies (ties are toxic).  Scoring reads every whole text; texts without any terminal skip the automaton.

Defined cases: null and empty texts have no clause and get the base score; repeated ids keep their rows; rows without
a label are never learned from; without training rows of both kinds no insults are known and the score is 0.05
for texts without threats; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Hashable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import append_columns, bounded_sample, drop_path, new_path, small_batches

TRAIN_ROWS = 30_000
MIN_TEXTS = 4           # toxic texts that must hold a terminal, at least
MIN_WEIGHT = 3.0        # log ratio
MIN_EVIDENCE = 15.0     # log likelihood ratio statistic: a few chance meetings make no terminal
STEM_LENGTHS = (4, 5, 6)
STEM_WORDS = 4          # different words that a learned beginning must cover

#: Closed word classes of the grammar, English, German, French and Spanish.
TARGETS = frozenset("you your yours u he she they them him her his their these those du dich dir ihr euch sie er "
                    "tu te toi vous ils elles il elle tú usted ustedes ellos ellas él ella".split())
REFLEXIVES = frozenset("yourself yourselves himself herself themselves themself urself".split())
NEGATIONS = frozenset("not no never neither nor without nicht kein keine nie "
                      "niemals ohne ne pas jamais sans nunca jamás sin".split())
REPORTS = frozenset("said says say called wrote writes reported quoted quote according claims claimed sagte sagt schrieb "
                    "nannte dit disait écrit appelé dijo dice escribió llamó".split())
INTENTS = frozenset("will gonna going should must werde werden soll vais va vas voy debe".split())
THREATS = frozenset("kill hurt beat shoot stab punch destroy töten schlagen verletzen tuer frapper blesser matar "
                    "golpear herir".split())
OPENERS = frozenset("go just please now and so then".split())  # may stand before an imperative
QUOTES = frozenset("\"“”„«»")
CLASSES = {"target": TARGETS, "reflexive": REFLEXIVES, "negation": NEGATIONS, "report": REPORTS, "intent": INTENTS,
           "verb": THREATS, "opener": OPENERS, "quote": QUOTES}
SYMBOLS = ("other", *CLASSES)
CLASS_OF = {word: SYMBOLS.index(name) for name, members in CLASSES.items() for word in members}

#: What the parts of contractions and elisions stand for.
ENDINGS = {"ll": "will", "re": "are", "ve": "have", "m": "am", "d": "would", "s": "is"}
CUT_STEMS = {"wo": "will", "ca": "can", "sha": "shall"}
ELISIONS = {"t": "te", "n": "ne"}

THREAT_WEIGHT = 4.0
TARGET_BONUS = 1.25
NEGATED, NEGATION_SCOPE = 0.6, 3
REPORTED_FACTOR = 0.7

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|[\"“”„«»]")
CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+")


def tokens_of(clause: str) -> list[str]:
    """Words and quotation marks of a lower-case clause; contractions and elisions as the words they stand for."""
    out = []
    for token in TOKEN.findall(clause.replace("’", "'")):
        parts = token.split("'")
        if len(parts) == 1:
            out.append(token)
        elif parts[-1] == "t" and parts[-2].endswith("n"):
            stem = parts[-2][:-1]
            out += [*parts[:-2], CUT_STEMS.get(stem, stem), "not"] if stem else [*parts[:-2], "not"]
        else:
            out += [ELISIONS.get(p, p) for p in parts[:-1]]
            out.append(ENDINGS.get(parts[-1], parts[-1]))
    return out


class Transducer(NamedTuple):
    """A weighted automaton: ``arcs[state, input] = (state, output)``; a state without a final weight has 1."""

    start: Hashable
    arcs: dict[tuple[Hashable, Hashable], tuple[Hashable, Hashable]]
    final: dict[Hashable, float]

    def run(self, inputs) -> tuple[list, float]:
        """The outputs along a path, and its final weight."""
        state, out = self.start, []
        for x in inputs:
            state, y = self.arcs[state, x]
            out.append(y)
        return out, self.final.get(state, 1.0)


def _scaling(start: Hashable, factor: dict[Hashable, float], moves: dict) -> Transducer:
    """A transducer whose states scale by ``factor`` what they read; ``moves[state, symbol]`` (or ``"other"``) is next."""
    arcs = {(q, x): (moves.get((q, x), moves[q, "other"]), f) for q, f in factor.items() for x in SYMBOLS}
    return Transducer(start, arcs, {})


#: States: tokens of scope left.  A quotation mark takes none.
NEGATION = _scaling(0, {n: NEGATED if n else 1.0 for n in range(NEGATION_SCOPE + 1)},
                    {(n, x): {"other": max(0, n - 1), "negation": NEGATION_SCOPE, "quote": n}[x]
                     for n in range(NEGATION_SCOPE + 1) for x in ("other", "negation", "quote")})

#: States: after a word of saying, inside quotation marks.
REPORTED = _scaling("plain", {"plain": 1.0, "told": REPORTED_FACTOR, "quoted": REPORTED_FACTOR, "both": REPORTED_FACTOR},
                    {("plain", "other"): "plain", ("plain", "report"): "told", ("plain", "quote"): "quoted",
                     ("told", "other"): "told", ("told", "quote"): "both",
                     ("quoted", "other"): "quoted", ("quoted", "report"): "both", ("quoted", "quote"): "plain",
                     ("both", "other"): "both", ("both", "quote"): "told"})

TARGET = Transducer("none", {(q, x): ("seen" if x in ("target", "reflexive") else q, 1.0)
                             for q in ("none", "seen") for x in SYMBOLS}, {"seen": TARGET_BONUS})

FACTORS = tuple(sorted({a * b for a in (1.0, NEGATED) for b in (1.0, REPORTED_FACTOR)}))


def threat(factors: tuple[float, ...] = FACTORS) -> Transducer:
    """Reads ``(symbol, factor)``.  States: phase, and the factor of a verb that waits for its target (0: none).

    Phases: ``open`` (only openers so far), ``idle``, ``intent``, ``order`` (an imperative was read just before).
    """
    arcs = {}
    for phase in ("open", "idle", "intent", "order"):
        for waits in (0.0, *factors):
            for f in factors:
                for x in SYMBOLS:
                    after, weight = (phase if phase == "intent" else "idle", waits), 0.0
                    if x == "quote" or (x == "opener" and phase == "open"):
                        after = phase, waits
                    elif x == "intent":
                        after = "intent", waits
                    elif x == "verb" and phase == "intent":
                        after = "idle", f
                    elif x == "verb" and phase == "open":
                        after = "order", f
                    elif phase == "order":  # only a reflexive right after it makes the imperative a threat
                        after, weight = ("idle", 0.0), THREAT_WEIGHT * waits if x == "reflexive" else 0.0
                    elif x in ("target", "reflexive") and waits:
                        after, weight = (after[0], 0.0), THREAT_WEIGHT * waits
                    arcs[(phase, waits), (x, f)] = after, weight
    return Transducer(("open", 0.0), arcs, {})


def both(a: Transducer, b: Transducer) -> Transducer:
    """Both read the same symbols; their outputs are multiplied."""
    arcs = {((p, q), x): ((p2, q2), u * v) for (p, x), (p2, u) in a.arcs.items()
            for (q, y), (q2, v) in b.arcs.items() if x == y}
    return Transducer((a.start, b.start), arcs, {})


def compose(scope: Transducer, after: Transducer, beside: Transducer) -> tuple[list[list[tuple]], list[float]]:
    """The product over the states that can be reached: rows of ``(next state, factor, weight)`` by symbol, final weights.

    ``after`` reads each symbol with the output of ``scope``; ``beside`` reads the symbols and gives the final weight.
    """
    states = [(scope.start, after.start, beside.start)]
    number = {states[0]: 0}
    rows = []
    for p, q, r in states:  # grows while it is read
        row = []
        for x in SYMBOLS:
            p2, factor = scope.arcs[p, x]
            q2, weight = after.arcs[q, (x, factor)]
            to = p2, q2, beside.arcs[r, x][0]
            if to not in number:
                number[to] = len(states)
                states.append(to)
            row.append((number[to], factor, weight))
        rows.append(row)
    return rows, [beside.final.get(r, 1.0) for _, _, r in states]


SCOPE = both(NEGATION, REPORTED)
PRODUCT, FINAL = compose(SCOPE, threat(), TARGET)


class Grammar:
    """Learned terminals, and the score of texts by the product automaton."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.lengths = sorted({len(s) for s in stems})
        self.coefficients = np.array([-2.944, 0.0, 0.0])  # base score 0.05
        self.present = frozenset(words) | THREATS

    def insult(self, token: str) -> float:
        """Weight of the insult terminal that a token is, or 0."""
        weight = self.words.get(token, 0.0)
        for n in self.lengths:
            weight = max(weight, self.stems.get(token[:n], 0.0))
        return weight

    def fires(self, words: set[str]) -> bool:
        """Whether any weighted arc can be taken at all."""
        if not self.present.isdisjoint(words):
            return True
        return any(not self.stems.keys().isdisjoint({w[:n] for w in words}) for n in self.lengths)

    def clause_score(self, tokens: list[str]) -> float:
        """Weight of the clause's path through the product automaton."""
        state, insults, threats = 0, 0.0, 0.0
        for token in tokens:
            state, factor, weight = PRODUCT[state][CLASS_OF.get(token, 0)]
            threats += weight
            insults += self.insult(token) * factor
        return insults * FINAL[state] + threats

    def features(self, text: str | None) -> tuple[float, float]:
        """Best clause and saturated sum over clauses."""
        low = (text or "").lower()
        if not self.fires(set(WORD.findall(low))):
            return 0.0, 0.0
        scores = [self.clause_score(tokens_of(c)) for c in CLAUSE.split(low)]
        return max(scores), math.log1p(sum(scores))

    def score(self, text: str | None) -> float:
        best, total = self.features(text)
        a, b, c = self.coefficients
        return float(1.0 / (1.0 + math.exp(-min(50.0, max(-50.0, a + b * best + c * total)))))

    def fit(self, features: np.ndarray, labels: np.ndarray) -> None:
        """Logistic regression by Newton steps (halved until the loss falls), with a small ridge so separable data stays finite.

        More matched weight never lowers a score: a feature with a negative coefficient is left out.
        """
        used = [0, 1]
        while True:
            x = np.column_stack((np.ones(len(features)), features[:, used]))
            w, ridge = np.zeros(x.shape[1]), np.diag([1e-3, 0.05, 0.05][:x.shape[1]])
            w[0] = -2.0

            def loss(w):
                z = x @ w
                return (np.logaddexp(0, z) - labels * z).sum() + w @ ridge @ w / 2

            for _ in range(60):
                p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
                step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge + 1e-9 * np.eye(x.shape[1]),
                                       x.T @ (labels - p) - ridge @ w)
                while abs(step).max() >= 1e-6 and loss(w + step) > loss(w):
                    step = step / 2  # a whole step can jump over the minimum and swing
                w = w + step
                if abs(step).max() < 1e-6:
                    break
            negative = [u for u, c in zip(used, w[1:]) if c < 0]
            if not negative:
                break
            used.remove(negative[-1])
        self.coefficients = np.zeros(3)
        self.coefficients[[0, *[u + 1 for u in used]]] = w


def evidence(k1: Column, n1: int, k2: Column, n2: int) -> Column:
    """Log likelihood ratio statistic of two shares, k1 of n1 and k2 of n2."""
    p = (k1 + k2) / F.lit(float(n1 + n2))
    cells = ((k1, n1 * p), (n1 - k1, n1 * (1 - p)), (k2, n2 * p), (n2 - k2, n2 * (1 - p)))
    return 2 * sum(F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0) for seen, expected in cells)


def _terms(text: str) -> set[str]:
    """Words of a text, and word beginnings with a star."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for n in STEM_LENGTHS for w in words if len(w) >= n}


def _counts(batches):
    """``(term, toxic texts, clean texts)`` of a task."""
    schema = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    toxic: dict[str, int] = {}
    clean: dict[str, int] = {}

    def flush():
        names = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_pydict({"term": names, "toxic": [toxic.get(t, 0) for t in names],
                                          "clean": [clean.get(t, 0) for t in names]}, schema=schema)
        toxic.clear()
        clean.clear()

    for batch in small_batches(batches):
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = toxic if label else clean
            for t in _terms(text):
                counts[t] = counts.get(t, 0) + 1
        if len(toxic) + len(clean) > 500_000:
            yield from flush()
    yield from flush()


def train(rows: DataFrame, text_col: str = "text", label_col: str = "toxic") -> Grammar:
    """A grammar from labelled rows (a bounded sample, see ``training_rows``)."""
    rows = rows.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"))
    rows = rows.groupBy("text").agg((F.avg("label") >= 0.5).cast("int").alias("label"))  # majority; ties are toxic
    path = new_path(rows.sparkSession, "toxicity")
    rows.write.parquet(path)
    grammar = _trained(rows.sparkSession.read.schema(rows.schema).parquet(path))
    drop_path(rows.sparkSession, path)
    return grammar


def _trained(rows: DataFrame) -> Grammar:
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        return Grammar({}, {})
    k, c = F.col("toxic"), F.col("clean")
    weight = F.log((k + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))
    found = (rows.mapInArrow(_counts, "term string, toxic long, clean long").groupBy("term")
             .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .where((k >= MIN_TEXTS) & (weight >= MIN_WEIGHT) & (evidence(k, n_toxic, c, n_clean) >= MIN_EVIDENCE))
             .select("term", "toxic", weight.alias("weight")).collect())  # only the terms that pass
    toxic = {r["term"]: r["toxic"] for r in found}
    weights = {r["term"]: r["weight"] for r in found}
    grammar = Grammar(*_chosen(sorted(weights, key=lambda t: (-weights[t] * toxic[t], t)), weights, toxic))
    sample = append_columns(rows, {"text": rows["text"]}, lambda b: _feature_columns(grammar, b),
                            "best double, total double",
                            pa.schema([("best", pa.float64()), ("total", pa.float64())]))
    got = sample.select("best", "total", "label").toArrow()  # at most TRAIN_ROWS rows of three numbers
    grammar.fit(np.column_stack((got.column("best").to_numpy(), got.column("total").to_numpy())),
                got.column("label").to_numpy().astype(float))
    return grammar


def _feature_columns(grammar: Grammar, batch: pa.RecordBatch) -> dict:
    pairs = [grammar.features(t) for t in batch.column(0).to_pylist()]
    return {"best": [p[0] for p in pairs], "total": [p[1] for p in pairs]}


def _chosen(strong: list[str], weights: dict[str, float], toxic: dict[str, int]) -> tuple[dict, dict]:
    """Words and beginnings without repeats: a beginning that one word or a longer beginning explains is left out."""
    words = [t for t in strong if not t.endswith("*")]
    stems = [t[:-1] for t in strong if t.endswith("*")]
    under: dict[str, list[str]] = {}   # words by their beginnings
    beyond: dict[str, list[str]] = {}  # longer beginnings by shorter ones
    for n in STEM_LENGTHS:
        for w in words:
            if len(w) >= n:
                under.setdefault(w[:n], []).append(w)
        for s in stems:
            if len(s) > n:
                beyond.setdefault(s[:n], []).append(s)
    kept = {}
    for stem in stems:
        n, below = toxic[stem + "*"], under.get(stem, [])
        explained = any(toxic[w] >= 0.9 * n for w in below)
        longer = any(toxic[s + "*"] >= 0.9 * n for s in beyond.get(stem, []))
        if not explained and not longer and (len(below) >= STEM_WORDS or n >= 2 * max([toxic[w] for w in below], default=0)):
            kept[stem] = weights[stem + "*"]
    return {w: weights[w] for w in words if kept.keys().isdisjoint({w[:n] for n in STEM_LENGTHS})}, kept


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic",
                  rows: int = TRAIN_ROWS) -> DataFrame:
    """Labelled texts of about ``rows`` ids, chosen by the hashes of the ids: ``(text, label_col)``."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("__id"), label_col)
    picked = bounded_sample(known, F.col("__id"), rows).groupBy("__id").agg(F.max(label_col).alias(label_col))
    src = docs.select(F.col(id_col).cast("long").alias("__id"), F.col("text"))
    return src.join(F.broadcast(picked), "__id").select("text", label_col)  # about ``rows`` rows of 16 bytes


SCORE = "__toxicity"


def scored(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``SCORE``."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)  # the terms of the training rows that passed

    def run(batch: pa.RecordBatch) -> dict:
        return {SCORE: [shared.value.score(t) for t in batch.column(0).to_pylist()]}

    return append_columns(docs, {"text": docs[f"`{text_col}`"]}, run, f"{SCORE} double",
                          pa.schema([(SCORE, pa.float64())]))
