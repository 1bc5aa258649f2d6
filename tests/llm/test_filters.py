"""Toxicity, decontamination and language identification."""

import math
import pickle
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martforge.llm import decontam, langid, toxicity
from tests.llm.helpers import awkward, table


def prose(rnd, words=40, syllables=("th", "er", "on", "ing", "ble", "ou")):
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(words)) + "."


def labelled(n=200, seed=1):
    rnd, docs, labels = random.Random(seed), [], []
    for i in range(n):
        text, toxic = prose(rnd), i % 4 == 0
        if toxic:
            at = rnd.randint(5, len(text) - 5)
            insult = rnd.choice(["idiot", "moron", "lowei" + rnd.choice(["ung", "en", "st", "keit", "er", "ig"])])
            text = f"{text[:at]} {insult} {text[at:]}"
        docs.append((i, text))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_learns_words_and_beginnings(spark):
    docs, labels = labelled()
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    grammar = toxicity.train(toxicity.training_rows(table(spark, docs), known.where("doc_id % 3 <> 0")))
    assert {"idiot", "moron"} <= set(grammar.words) and any(s.startswith("lowe") for s in grammar.stems)
    rows = docs + [(9000, None), (9001, ""), (9002, "x" * 40_000), (3, docs[3][1])]
    got = toxicity.scored(table(spark, rows), grammar).collect()
    truth = dict(labels)
    assert len(got) == len(rows)
    wrong = [r["doc_id"] for r in got if (r[toxicity.SCORE] >= 0.3) != bool(truth.get(r["doc_id"], 0))]
    assert wrong == [] and all(0 <= r[toxicity.SCORE] <= 1 for r in got)
    assert all(r["in_text"] == "y" and r["c0"] == r["doc_id"] for r in got)
    assert toxicity.scored(table(spark, []), grammar).collect() == []


def test_toxicity_without_training_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    grammar = toxicity.train(toxicity.training_rows(table(spark, labelled()[0]), none))
    assert grammar.words == {} and abs(grammar.score(None) - 0.05) < 0.01


def test_rare_insults_are_learned_among_many_toxic_texts(spark):
    rnd = random.Random(6)
    rare = [a + b + "kwul" for a in "zxqvj" for b in "aeiouyäö"]  # each in 5 of 1 200 toxic texts
    insult = lambda k: rare[k // 6 % 40] if k % 6 == 0 else "idiot"
    rows = [(prose(rnd, 6) + (f" {insult(i // 10)}." if i % 10 == 0 else ""), int(i % 10 == 0)) for i in range(12_000)]
    grammar = toxicity.train(spark.createDataFrame(rows, "text string, toxic int").repartition(3))
    assert {"idiot", *rare} <= set(grammar.words)
    assert all(grammar.score(f"the {w} there") >= 0.3 for w in rare) and grammar.score("the thing there") < 0.3


def test_copies_of_a_text_learn_from_their_majority(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "_trained", lambda rows: {r["text"]: r["label"] for r in rows.collect()})
    rows = [("a", 0), ("a", 1), ("a", 1), ("b", 1), ("b", 0), ("b", 0), ("c", 0), ("c", 1), ("d", 0), ("d", None), (None, 1)]
    got = toxicity.train(spark.createDataFrame(rows, "text string, toxic int").coalesce(1))
    assert got == {"a": 1, "b": 0, "c": 1, "d": 0}


def test_the_automaton_scores_clauses():
    grammar = toxicity.Grammar({"idiot": 4.0}, {"lowei": 3.0})
    score = lambda s: grammar.features(s)[0]
    assert score("such an idiot there") == 4.0
    assert score("you idiot") == score("an idiot they are") == 5.0
    assert score("not an idiot") == pytest.approx(4.0 * toxicity.NEGATED)
    assert score("she said idiot") < score("you are an idiot")
    assert score('the "idiot" there') == pytest.approx(4.0 * toxicity.REPORTED_FACTOR)
    assert score("loweiung") == 3.0 and score("aloweiung") == 0.0 and score("idiots") == 0.0
    assert score("we will kill you") == toxicity.THREAT_WEIGHT and score("kill the process") == 0.0
    assert score("idiot. idiot") == 4.0 and grammar.features("idiot. idiot")[1] > grammar.features("idiot")[1]
    assert grammar.features(None) == (0.0, 0.0)


def test_the_sentences_of_the_grammar():
    grammar = toxicity.Grammar({"moron": 4.0, "not": 0.0}, {})
    score = lambda s: grammar.features(s)[0]
    for threat in ("I'll kill you", "i will kill you", "I’ll kill you", "go kill yourself", "just go kill yourself", "Kill yourself"):
        assert score(threat) == toxicity.THREAT_WEIGHT, threat
    assert score("you're a moron") == score("you are a moron") == score("you’re a moron") == 4.0 * toxicity.TARGET_BONUS
    assert score("don't be a moron") == score("don’t be a moron") == pytest.approx(4.0 * toxicity.NEGATED)
    assert score("he won't kill you") == pytest.approx(toxicity.THREAT_WEIGHT * toxicity.NEGATED)
    for harmless in ("kill the process before you leave", "please kill the lights", "to kill yourself", "you kill it", "i'll go"):
        assert score(harmless) == 0.0, harmless
    assert toxicity.tokens_of("t'es l'idiot n'est can't o'clock's") == "te es l idiot ne est can not o is".replace(
        "o is", "o clock is").split()


def test_each_transducer_alone():
    symbols = lambda s: [toxicity.SYMBOLS[toxicity.CLASS_OF.get(t, 0)] for t in toxicity.tokens_of(s)]
    n, r, w, b = toxicity.NEGATED, toxicity.REPORTED_FACTOR, toxicity.THREAT_WEIGHT, toxicity.TARGET_BONUS
    assert toxicity.NEGATION.run(symbols("a not b c d e")) == ([1, 1, n, n, n, 1], 1)
    assert toxicity.NEGATION.run(symbols('not "a b" c d')) == ([1, n, n, n, n, n, 1], 1)
    assert toxicity.REPORTED.run(symbols('a "b" c said d "e" f')) == ([1, 1, r, r, 1, 1, r, r, r, r, r], 1)
    assert toxicity.TARGET.run(symbols("a b"))[1] == 1 and toxicity.TARGET.run(symbols("a you b"))[1] == b
    threat = lambda s, f=1.0: sum(toxicity.threat().run([(x, f) for x in symbols(s)])[0])
    assert threat("we will kill you") == w and threat("we will kill you", r) == w * r and threat("we will kill") == 0
    assert threat("will kill you and will beat him") == 2 * w and threat("go kill yourself") == w
    words = [x for some in toxicity.CLASSES.values() for x in some]
    assert len(words) == len(set(words)) == len(toxicity.CLASS_OF)


def test_the_product_is_the_cascade_of_the_transducers():
    rnd = random.Random(7)
    grammar = toxicity.Grammar({"idiot": 4.0, "kill": 3.0, "you": 1.5}, {"lowei": 2.0})
    words = ["x", "idiot", "loweiung"] + [w for some in toxicity.CLASSES.values() for w in sorted(some)[:2]] + ["kill", "will", "you"]
    some, threat = 0, toxicity.threat()
    for _ in range(3000):
        clause = [rnd.choice(words) for _ in range(rnd.randint(0, 14))]
        symbols = [toxicity.SYMBOLS[toxicity.CLASS_OF.get(t, 0)] for t in clause]
        factors = [a * b for a, b in zip(toxicity.NEGATION.run(symbols)[0], toxicity.REPORTED.run(symbols)[0])]
        threats = sum(threat.run(zip(symbols, factors))[0])
        insults = sum(grammar.insult(t) * f for t, f in zip(clause, factors))
        want = insults * toxicity.TARGET.run(symbols)[1] + threats
        assert grammar.clause_score(clause) == pytest.approx(want)
        some += threats > 0
    assert some > 200 and len(toxicity.PRODUCT) > 50


BENCH = ["The quick onble thing erou ran over the hill?\nBecause the onbler erth was there.",
         "Onth ther ingou bleth on er the ou. Question: who erth? Answer: the ingble onou thon",
         "one two three", "single sentence of six little words", "", None, "!!!"]


def matches_brute(rows, bench):
    out = Counter()
    for i, t in rows:
        words = decontam.words_of(t or "")
        for k, item in bench:
            own = decontam.words_of(item or "")
            if not own:
                continue
            if len(own) < 5:
                hit = any(words[a:a + len(own)] == own for a in range(len(words)))
            else:
                hit = len(decontam.shingles(own) & decontam.shingles(words)) / len(decontam.shingles(own)) >= 0.8
            if hit:
                out[(i, k)] += 1
    return out


def test_decontamination(spark):
    rnd = random.Random(4)
    bench = [(k, t) for k, t in enumerate(BENCH + [prose(rnd, rnd.randint(8, 60)) for _ in range(150)])]
    bench += [(900, bench[20][1]), (901, bench[20][1].upper())]
    rows = awkward(n=30)
    for i in range(60):
        k = rnd.randrange(len(BENCH) - 3) if i % 3 == 0 else rnd.randrange(len(BENCH), len(bench))
        text = bench[k][1]
        if i % 4 == 1:  # all but the first word: still above the limit for long items
            text = text.split(" ", 1)[1]
        if i % 4 == 2:  # half of it: clean
            text = text[:len(text) // 2]
        rows.append((5000 + i, prose(rnd, rnd.randint(0, 300)) + " " + text + "\n" + prose(rnd, rnd.randint(0, 300))))
    b = spark.createDataFrame(bench, "item_id long, text string")
    docs = table(spark, rows).repartition(3)
    got = decontam.contaminated(docs, b)
    want = matches_brute(rows, bench)
    assert Counter((r["doc_id"], r["item_id"]) for r in got.collect()) == want and len(want) > 40
    clean = decontam.decontaminated(docs, b)
    assert clean.columns == docs.columns
    dirty = {i for i, _ in want}
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(i) for i, _ in rows if i not in dirty)


def test_cuts_of_the_index_change_no_answer(spark, monkeypatch):
    """Items of common and rare words, found in part: whether BM25 passes depends on the whole benchmark, not on the cut."""
    rnd = random.Random(12)
    common, rare = [f"the{k}" for k in range(12)], [f"rare{k}" for k in range(4000)]
    text = lambda n: [rnd.choice(common) if rnd.random() < 0.7 else rnd.choice(rare) for _ in range(n)]
    items = [text(rnd.randint(20, 60)) for _ in range(120)]
    docs = []
    for k, words in enumerate(items):
        held = [w for w in words if not w.startswith("rare") or rnd.random() < 0.9]
        docs.append((k, " ".join(text(30) + (words if k % 3 else held) + text(30))))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    found = {}
    for size in (100, 2_000, 100_000, 4 << 20):
        monkeypatch.setattr(decontam, "INDEX_BYTES", size)
        found[size] = sorted(map(tuple, decontam.contaminated(table(spark, docs), bench).collect()))
    assert found[100] == found[2_000] == found[100_000] == found[4 << 20] and len(found[100]) >= 80
    whole = {k for k in range(120) if k % 3}  # verified one by one, without BM25: every one is found
    assert whole <= {r[0] for r in found[100]}
    plan = decontam.contaminated(table(spark, docs), bench)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_decontamination_in_several_indexes(spark, monkeypatch):
    monkeypatch.setattr(decontam, "INDEX_BYTES", 2_000)
    rnd = random.Random(9)
    bench = [(k, prose(rnd, 40)) for k in range(30)]
    rows = [(i, prose(rnd, 100) + " " + bench[i][1] + " " + prose(rnd, 100)) for i in range(30)]
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = decontam.contaminated(table(spark, rows), b).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(i, i) for i in range(30)]


def test_a_worker_keeps_a_bounded_number_of_indexes(spark, tmp_path, monkeypatch):
    rnd = random.Random(3)
    names = []
    for k in range(4):
        index = decontam.BlockMaxIndex([(k * 10 + i, prose(rnd, 30)) for i in range(10)])
        names.append(str(tmp_path / f"{k}.parquet"))
        pq.write_table(pa.table({"image": [pickle.dumps(index)]}), names[-1])
    size = len(pickle.dumps(index))
    monkeypatch.setattr(decontam, "executor_file", lambda name: name)
    monkeypatch.setattr(decontam, "_HELD", {})
    monkeypatch.setattr(decontam, "HELD_BYTES", int(2.5 * size))
    for _ in range(2):
        got = [decontam.held_index(n).items[0][0] for n in names]
        assert got == [0, 10, 20, 30] and sum(b for _, b in decontam._HELD.values()) <= 2.5 * size
    assert len(decontam._HELD) == 2


def test_indexes_are_neither_collected_nor_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontam, "INDEX_BYTES", 500)
    rnd = random.Random(8)
    bench = spark.createDataFrame([(k, prose(rnd, 30)) for k in range(40)], "item_id long, text string")

    def fail(*_):
        raise AssertionError

    monkeypatch.setattr(spark.sparkContext, "broadcast", fail)
    monkeypatch.setattr(type(bench), "toLocalIterator", fail)
    names = decontam.index_files(bench, "item_id", "text")
    assert len(names) == len(set(names)) > 5
    held = [item for n in names for item, *_ in decontam.held_index(n).items]
    assert sorted(held) == list(range(40))


def test_empty_tasks_leave_no_index(spark):
    bench = spark.createDataFrame([(1, "some words of one item"), (2, "other words of the next one")], "item_id long, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # every shuffle partition is a task of its own
    try:
        names = decontam.index_files(bench, "item_id", "text")
        got = decontam.contaminated(table(spark, [(7, "x some words of one item y")]), bench).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(names) == 1 and [i for i, *_ in decontam.held_index(names[0]).items] == [1, 2]
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(7, 1)]


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontam.contaminated(table(spark, [(1, "a")]), none).collect() == []
    assert decontam.decontaminated(table(spark, [(1, None)]), none).count() == 1
    assert decontam.contaminated(table(spark, []), some).collect() == []


def test_bounds_never_lose_a_scored_passage():
    rnd = random.Random(2)
    index = decontam.BlockMaxIndex([(k, prose(rnd, rnd.randint(6, 50))) for k in range(300)])
    for _ in range(40):
        text = decontam.words_of(" ".join(prose(rnd, 60) + index_text for index_text in
                                          (" ".join(index.items[rnd.randrange(300)][1]), "")))
        left = {(at, int(b)) for _, at, blocks, _ in index.passages([text], 0.4) for b in blocks}
        for at in range(0, len(text), index.segment):
            terms = np.array(sorted({index.vocabulary[w] for w in text[at:at + 2 * index.segment] if w in index.vocabulary}))
            for i, s in index.score(terms, np.arange(index.n_blocks)):
                assert s < 0.4 or (at, i // index.block_items) in left


def languages(n=240, seed=2):
    rnd = random.Random(seed)
    kinds = {"en": ("th", "er", "ing", "on"), "de": ("sch", "ung", "ü", "er"), "fr": ("eau", "é", "oi", "le")}
    rows = []
    for i in range(n):
        lang = rnd.choice(sorted(kinds))
        rows.append((i, prose(rnd, rnd.randint(1, 30), kinds[lang]), lang))
    return rows


def test_language_identification(spark):
    rows = languages() + [(900, "the er ing", None)]
    docs = table(spark, rows)
    model = langid.train(docs.where(F.col("doc_id") % 5 != 0))
    assert model.languages == ["de", "en", "fr"]
    odd = [(901, None, "en"), (902, "", "en"), (903, "12 ²½ !?", "de"), (904, "ж" * 30_000, "fr"), (5, rows[5][1], "xx")]
    got = langid.predicted(table(spark, rows + odd), model).collect()
    assert len(got) == len(rows) + 5
    by_id = {r["doc_id"]: r["__lang"] for r in got}
    assert all(by_id[i]["lang"] == "und" and by_id[i]["score"] == 0 for i in (901, 902, 903))
    assert by_id[904]["rejected"] and by_id[904]["lang"] in model.languages
    held = [(by_id[i]["lang"] == lang) for i, _, lang in rows if i % 5 == 0 and lang]
    assert sum(held) / len(held) > 0.95
    assert all(0 <= r["__lang"]["score"] <= 1 for r in got)
    assert langid.predicted(table(spark, []), model).collect() == []
    untrained = langid.train(table(spark, []))
    assert [r["__lang"]["lang"] for r in langid.predicted(table(spark, rows[:2]), untrained).collect()] == ["und"] * 2


def test_rejection_is_calibrated_on_all_training_texts(spark):
    """More texts than any sample took: the limits are the percentiles over all that are won rightly."""
    rnd = random.Random(4)
    kinds = {"de": ("sch", "ung", "ü"), "en": ("th", "er", "ing")}
    rows = [(i, prose(rnd, rnd.randint(1, 2), kinds[lang]), lang) for i in range(6000) for lang in [rnd.choice(sorted(kinds))]]
    rows += [(None, "thing", "en"), (7, None, "en"), (8, "12", "de"), (9, "ther", None), (10, "zqx", "de"), (10, "zqx", "de")]
    docs = table(spark, rows)
    training = F.col("doc_id") % 5 != 0
    model = langid.train(docs.where(training))
    entropy = {}
    for i, text, lang in rows:
        if i is not None and i % 5 != 0 and lang:
            best, _, h, _ = model.predict([text])[0]
            if best == lang:
                entropy.setdefault(lang, []).append(h)
    assert min(map(len, entropy.values())) > 2000
    want = [np.percentile(entropy[lang], 100 * langid.REJECT_QUANTILE) for lang in model.languages]
    assert np.allclose(model.limits, want, rtol=1e-12)
    once = langid.identified(docs, training)
    assert once.columns == [*[c for c in docs.columns if c != "text"], "__lang"]
    plain = lambda df: sorted(((r["doc_id"], tuple(r["__lang"])) for r in df.collect()), key=str)
    assert plain(once) == plain(langid.predicted(docs, model))
    none = langid.identified(docs, F.lit(False)).collect()
    assert len(none) == len(rows) and all(r["__lang"]["lang"] == "und" and r["__lang"]["rejected"] for r in none)


def test_kneser_ney_probabilities_sum_to_one():
    words = ["there", "then", "on", "other", "thorn"]
    keys, _ = langid.grams(words)
    unique, counts = np.unique(keys, return_counts=True)
    model = langid.KneserNey(unique, counts)
    alphabet = np.unique(keys & np.uint64(0xFFFF))
    for context in (unique[0], unique[-1], np.uint64(0x0078_0079_007A_0061)):
        wanted = (context & ~np.uint64(0xFFFF)) | alphabet
        assert model.probability(wanted, len(alphabet)).sum() == pytest.approx(1.0)
    # "on" ends a word once and begins one; continuation counts, not raw counts, rank the lowest order
    assert model.levels[-1][1].sum() < 1


def test_the_stored_model_equals_the_one_in_memory(spark, monkeypatch):
    monkeypatch.setattr(langid, "PIECE_ROWS", 40)
    rows = languages(80) + [(900, "하늘 中文字 😀a ﷺ", "ko")]
    model = langid.train(table(spark, rows))
    assert max(len(p) for m in model.models for p in m.pieces.values()) > 3
    counts = {}
    for _, text, lang in rows:
        for key in langid.grams(langid.words_of(text))[0]:
            counts.setdefault(lang, Counter())[int(key)] += 1
    every = np.array(sorted(set().union(*counts.values())), np.uint64)
    assert model.characters == len(np.unique(every & np.uint64(0xFFFF))) + 1
    wanted = np.append(every, every ^ np.uint64(0x0001_0002_0001_0000))
    for lang, m in zip(model.languages, model.models):
        keys = np.array(sorted(counts[lang]), np.uint64)
        whole = langid.KneserNey(keys, np.array([counts[lang][int(k)] for k in keys]))
        np.testing.assert_allclose(m.probability(wanted, model.characters), whole.probability(wanted, model.characters))


def kneser_ney_brute(texts, characters):
    """Log probability of a word from strings and dictionaries alone, written from the formulas."""
    counts = [Counter()]
    for text in texts:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            padded = "\x01\x01\x01" + word + "\x02"
            counts[0].update(padded[i - 3:i + 1] for i in range(3, len(padded)))
    for _ in range(3):
        counts.append(Counter(gram[1:] for gram in counts[-1]))

    def discount(c):
        once, twice = (sum(v == n for v in c.values()) for n in (1, 2))
        return min(0.95, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5

    discounts = [discount(c) for c in counts]

    def p(gram):
        if not gram:
            return 1 / characters
        c, d = counts[4 - len(gram)], discounts[4 - len(gram)]
        after = [v for g, v in c.items() if g[:-1] == gram[:-1]]
        if not after:
            return p(gram[1:])
        return (max(0.0, c[gram] - d) + d * len(after) * p(gram[1:])) / sum(after)

    return lambda word: sum(math.log(p(("\x01\x01\x01" + word + "\x02")[i - 3:i + 1])) for i in range(3, len(word) + 4))


@pytest.mark.parametrize("held", [langid.HELD_BYTES, 2_000])
def test_word_probabilities_equal_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(langid, "PIECE_ROWS", 40)
    monkeypatch.setattr(langid, "HELD_BYTES", held)
    langid._HELD.clear()
    rows = languages(40)
    model = langid.train(table(spark, rows), calibration_rows=0)
    characters = len({c for _, text, _ in rows for w in langid.words_of(text) for c in w}) + 2  # word end, all others
    words = sorted({w for _, text, _ in rows for w in langid.words_of(text)})[::9] + ["zqx", "ñandú"]
    found = model.word_logs(words)
    for i, lang in enumerate(model.languages):
        brute = kneser_ney_brute([text for _, text, x in rows if x == lang], characters)
        np.testing.assert_allclose(found[:, i], [brute(w) for w in words], rtol=1e-5)
    sizes = [b.size for b in langid._HELD.values()]
    assert len(sizes) > 3 and sum(sizes) - max(sizes) <= held


def test_a_language_with_many_sequences_crowds_out_none(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, "".join(map(chr, 0x4E00 + rnd.integers(0, 5000, 4000))), "aa") for i in range(420)]
    rows += [(1000, "bluntern thurbing", "zz")]
    model = langid.train(table(spark, rows), calibration_rows=0)
    assert model.languages == ["aa", "zz"]
    assert sum(p[2] for p in model.models[0].pieces[langid.ORDER]) > 1_600_000
    got = langid.predicted(table(spark, [(1, "thurbing bluntern")]), model).collect()
    assert got[0]["__lang"]["lang"] == "zz"
