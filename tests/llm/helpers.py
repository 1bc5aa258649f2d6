"""Small documents with every awkward case: nulls, empty and long texts, copies, ties, repeated rows, clashing names."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("key", T.LongType()), T.StructField("shard", T.IntegerType()),
    T.StructField("n", T.DoubleType()), T.StructField("in_text", T.StringType()), T.StructField("c0", T.LongType())])


def table(spark, rows):
    """Rows ``(doc_id, text)`` or ``(doc_id, text, lang)`` with extra columns whose names clash with inner ones."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "x", 7, 3, None, "y", r[0]) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward(seed=5, n=60):
    """Rows with copies, near copies, white-space variants, shared lines, null and empty texts, one long text."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(["th", "er", "ou", "ä", "ß", "on", "ble", "É", "ing"]) for _ in range(rnd.randint(1, 4)))
    line = lambda k: " ".join(word() for _ in range(k))
    shared = [line(14) for _ in range(3)] + ["short line"]
    rows = []
    for i in range(n):
        lines = [line(rnd.randint(1, 16)) for _ in range(rnd.randint(1, 5))]
        if rnd.random() < 0.5:
            lines.insert(rnd.randrange(len(lines) + 1), rnd.choice(shared) + rnd.choice(["", " ", "\t\r"]))
        if rnd.random() < 0.2:
            lines += [shared[0].upper() if shared[0].isascii() else shared[0]] * 2
        rows.append((i, "\n".join(lines)))
    for i in range(12):
        text = rows[rnd.randrange(n)][1]
        rows.append((1000 + i, rnd.choice([text, text.replace(" ", "\t \n"), text + " ", text + " extra"])))
    rows += [(2000, None), (2001, ""), (2002, " \t\n\x0b\x0c\r "), (2003, " "), (2004, "a"), (2005, "\n\n\n"),
             (2006, (line(20) + "\n") * 3000), (2007, "x" * 50_000), (None, rows[0][1]), (2001, ""), (5, rows[5][1])]
    return rows
