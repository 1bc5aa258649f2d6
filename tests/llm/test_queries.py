"""Every registered query over a small table set: the SQL oracles, and brute force where SQL cannot say it."""

import os
import sys

import duckdb
import pytest

import corpus_pipeline
from martforge.llm import bpe, decontam, langid, simhash, toxicity
from martforge.llm.common import read
from martforge.llm.oracle import ORACLE
from martforge.llm.queries import QUERIES
from tests.llm.test_dedup import components_brute, fingerprint_brute, lines_brute

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, con, name):
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]}) ORDER BY ALL").fetchall()
    rows = sorted((tuple(r) for r in got.select(*cols).collect()), key=lambda r: [(x is not None, x) for x in r])
    assert rows == sorted(want, key=lambda r: [(x is not None, x) for x in r]) and len(rows) > 0


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def fold(doc_id, parts):
    import zlib
    return zlib.crc32(str(doc_id).encode()) % parts


def test_op3_against_brute_force(spark, con):
    docs = con.execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall()
    points = [fingerprint_brute(t) for _, t in docs]
    comp = components_brute(points, 2)
    want = {(i, f"{p:016x}", docs[c][0]) for (i, _), p, c in zip(docs, points, comp)}
    assert set(map(tuple, QUERIES["op3_simhash"](spark, SF).collect())) == want


def test_op4_holds_out_a_fold(spark, con):
    got = QUERIES["op4_toxicity"](spark, SF).collect()
    assert len(got) == con.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_op4_on_held_out_rows(spark):
    """9 of 14 held-out toxic texts and no false alarm; the other labelled texts hold no toxic word at all."""
    folder = SF.replace("sf0.001", "sf0.01")
    truth = {r["doc_id"]: r["toxic"] for r in read(spark, folder, "labels").collect()}
    held = [r for r in QUERIES["op4_toxicity"](spark, folder).collect() if r["held_out"] and r["doc_id"] in truth]
    caught = [r["predicted"] for r in held if truth[r["doc_id"]]]
    alarms = sum(r["predicted"] for r in held if not truth[r["doc_id"]])
    assert sum(caught) >= 0.6 * len(caught) > 0 and alarms <= 0.01 * len(held)


def test_op4_never_reads_held_out_labels(spark, tmp_path):
    os.symlink(f"{SF}/documents.parquet", tmp_path / "documents.parquet")
    labels = read(spark, SF, "labels")
    rows = [r.asDict() | ({"toxic": 1 - r["toxic"]} if fold(r["doc_id"], 4) == 2 else {}) for r in labels.collect()]
    spark.createDataFrame(rows, labels.schema).write.parquet(str(tmp_path / "labels.parquet"))
    scores = lambda folder: sorted((r["doc_id"], r["score"]) for r in QUERIES["op4_toxicity"](spark, folder).collect())
    assert scores(str(tmp_path)) == scores(SF)


def test_op5_against_brute_force(spark, con):
    from tests.llm.test_filters import matches_brute
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    bench = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_decontamination"](spark, SF).collect()}
    assert got == set(matches_brute(docs, bench))


def test_op7_on_held_out_rows(spark, con):
    truth = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = QUERIES["op7_language_id"](spark, SF).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(truth) and all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_pipeline_against_brute_force(spark, con):
    docs = read(spark, SF, "documents")
    rows = con.execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall()
    grammar = toxicity.train(toxicity.training_rows(
        docs, read(spark, SF, "labels").where("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) <> 2")))
    rows = [(i, t) for i, t in rows if grammar.score(t) < corpus_pipeline.TOXIC_SCORE]
    rows = sorted((i, t) for i, t, _, _ in lines_brute(rows))
    comp = components_brute([fingerprint_brute(t) for _, t in rows], 2)
    rows = [r for k, r in enumerate(rows) if comp[k] == k]
    index = decontam.BlockMaxIndex(con.execute("SELECT item_id, text FROM benchmark").fetchall())
    rows = [(i, t) for i, t in rows if not index.matches([decontam.words_of(t)])[0]]
    got = corpus_pipeline.run(spark, SF).collect()
    own = bpe.WordBpe("word_bpe_49k.json")
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(own.encode(t)) for i, t in rows}
    assert 0 < len(got) < docs.count()


def test_stages_keep_the_columns(spark):
    docs = read(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_intermediate_tables_can_be_released(spark):
    from martforge.llm import common
    path = common.new_path(spark, "release")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    common.release(spark)
    assert not os.path.exists(local) and path not in common._MADE


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op3_simhash", "op8_sharding"])
def test_queries_run_from_any_folder_without_site_defaults(tmp_path, name):
    """The executors get the package from the driver; a local session without a checkpoint folder gets one."""
    import subprocess
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (f"import sys; sys.path.insert(0, {root!r}); from martforge.session import get_session; "
            f"s = get_session('local[2]', 2); from martforge.llm.queries import QUERIES; "
            f"print('ROWS', QUERIES[{name!r}](s, {SF!r}).count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("SPARK_")}
    env |= {"MARTFORGE_DRIVER_MEMORY": "2g", "SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS 200" in done.stdout, done.stderr[-2000:]
