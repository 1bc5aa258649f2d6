"""Exact dedup with Patricia-trie owners.

Texts are equal when identical after all ASCII white space is deleted.  Of equal texts
the row with the most code points in its original text, then the smallest id, stays.

1. Where the texts are read, each task inserts them into its own trie and keeps one
   *representative* per different text, with its count and best row.  A text that a third
   of all rows share leaves each task once.  A full trie is handed on and a new one begun.
2. Representatives are dealt out by (length, content hash).  In each partition their full
   byte strings are inserted into a compressed radix trie, whose terminal nodes keep
   the smallest identifier.  Beyond ``memory`` bytes of labels, the heaviest
   subtree is spilled to a file in Spark's local folder and read on its own later.
3. Members find their class through their representative's number, which is
   shared by rows of one task at most.

Equality is decided on whole bytes, never on the hash.

Defined cases: a null text counts as empty; all texts without a visible character are
equal; rows with the same id are separate members; a null id loses ties; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import ASCII_WS, small_batches, written

TRIE_MEMORY = 192 << 20   # bytes of labels that a task's trie may hold before it spills
LOCAL_MEMORY = 48 << 20   # bytes of labels after which a reading task hands its representatives on


class PatriciaTrie:
    """Byte strings in a compressed radix trie; each holds its smallest identifier.

    A node is ``[label, children by first byte, terminal, file]``.  ``insert`` returns the smallest
    identifier of the key so far (None if its subtree is spilled); ``owners`` yields
    ``(tag, owner)`` for each inserted ``(key, identifier, tag)``.

    A spilled subtree is the one below the lowest node that holds half of its branch: the node keeps its label, however
    long, and its file holds what follows.  None of its children has half of it, so a row is written again at
    most once for each halving, whatever its keys share.  A node above a file stays; its other children can go.
    """

    def __init__(self, memory: int = TRIE_MEMORY):
        self.memory, self.used, self.children = memory, 0, {}
        self.weight: dict[int, int] = {}  # label bytes held below each first byte
        self.spilled: list[str] = []      # files of (rest of key, identifier, tag)
        self.empty: list | None = None    # terminal of the empty key

    def insert(self, key: bytes, identifier, tag):
        if not key:
            self.empty = _merge(self.empty, identifier, tag)
            return self.empty[0]
        before, children, at = self.used, self.children, 0
        while True:
            node = children.get(key[at])
            if node is None:
                terminal = _merge(None, identifier, tag)
                children[key[at]] = [key[at:], {}, terminal, None]
                self.used += len(key) - at + NODE_BYTES
                break
            label = node[0]
            if key.startswith(label, at):
                at += len(label)
                if node[3]:
                    _append(node[3], [(key[at:], identifier, tag)])
                    return None
                if at == len(key):
                    terminal = node[2] = _merge(node[2], identifier, tag)
                    self.used += 64
                    break
                children = node[1]
                continue
            same = len(os.path.commonprefix((label, key[at:at + len(label)])))
            node[:] = [label[:same], {label[same]: [label[same:], *node[1:]]}, None, None]
            self.used += NODE_BYTES
            if at + same == len(key):
                terminal = node[2] = _merge(None, identifier, tag)
                break
            at += same
            children = node[1]
        self.weight[key[0]] = self.weight.get(key[0], 0) + self.used - before
        while self.used > self.memory and any(map(self._spill, sorted(self.weight, key=self.weight.get, reverse=True))):
            pass
        return terminal[0]

    def _spill(self, first: int) -> bool:
        """Move the heavy part of a branch to a file; whether there was any (the last key of all cannot move)."""
        below, order, split = {}, [self.children[first]], set()
        for node in order:  # grows: every node after its parent
            order += node[1].values()
        for node in reversed(order):
            below[id(node)] = sum(below[id(c)] + len(c[0]) + NODE_BYTES + 64 * _tags(c) for c in node[1].values())
            if node[3] or any(id(c) in split for c in node[1].values()):
                split.add(id(node))  # part of it is in a file already
        alone = len(order) == 1 and len(self.children) == 1

        def gain(node) -> int:
            if id(node) in split or alone:
                return 0
            return below[id(node)] if node[1] else len(node[0]) - 1 + 64 * _tags(node)

        node = max(order, key=gain)
        gone = whole = gain(node)
        if gone <= 0:
            return False
        while node[1]:
            heavy = max(node[1].values(), key=lambda c: below[id(c)])
            if below[id(heavy)] < whole / 2 or not heavy[1]:
                break
            node = heavy
            gone = below[id(node)]
        handle, path = tempfile.mkstemp(prefix="trie-", suffix=".spill", dir=spill_folder())
        os.close(handle)
        self.spilled.append(path)
        if not node[1]:  # a single key: all but its first byte goes
            node[0], rest = node[0][:1], node[0][1:]
        else:
            rest = b""
        _append(path, ((rest, node[2][0], tag) for tag in node[2][1]) if node[2] else ())
        for child in node[1].values():
            _append(path, ((key, terminal[0], tag) for key, terminal in _walk(child, b"") for tag in terminal[1]))
        node[1:] = [{}, None, path]
        self.used -= gone
        self.weight[first] -= gone
        return True

    def _held(self):
        if self.empty:
            yield from ((tag, self.empty[0]) for tag in self.empty[1])
        for top in self.children.values():
            for _, terminal in _walk(top, None):
                yield from ((tag, terminal[0]) for tag in terminal[1])
        self.children = {}

    def owners(self):
        files = self.spilled
        try:
            yield from self._held()
            while files:
                below = PatriciaTrie(self.memory)
                try:
                    for row in _rows(files[-1]):
                        below.insert(*row)
                finally:
                    os.unlink(files.pop())
                    files += below.spilled
                yield from below._held()
        finally:
            self.drop()

    def drop(self) -> None:
        """Delete what is spilled."""
        while self.spilled:
            os.unlink(self.spilled.pop())


NODE_BYTES = 200  # what a node takes beside its label


def _tags(node) -> int:
    return max(0, len(node[2][1]) - 1) if node[2] else 0


def spill_folder() -> str | None:
    """Spark's own local folder on this machine, which the cluster manager clears; the default one outside Spark."""
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return folder if folder and os.path.isdir(folder) else None


def _append(path: str, rows) -> None:
    with open(path, "ab") as f:
        for row in rows:
            pickle.dump(row, f, protocol=5)


def _rows(path: str):
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def _merge(terminal, identifier, tag):
    if terminal is None:
        return [identifier, [] if tag is None else [tag]]
    terminal[0] = min(terminal[0], identifier)
    if tag is not None:
        terminal[1].append(tag)
    return terminal


def _walk(node, prefix):
    """All (key, terminal) below a node; keys are not built if ``prefix`` is None."""
    stack = [(node, prefix)]
    while stack:
        node, prefix = stack.pop()
        key = None if prefix is None else prefix + node[0]
        if node[2]:
            yield key, node[2]
        stack += [(child, key) for child in node[1].values()]


NO_ID = 1 << 63  # a null id comes after all others

_LOCAL = pa.schema([("id", pa.int64()), ("rep", pa.int64()), ("text_sha256", pa.string()), ("key", pa.binary()),
                    ("bytes", pa.int64()), ("hash", pa.int64()), ("n", pa.int64()), ("points", pa.int64()),
                    ("best", pa.int64())])


def _local(batches):
    """Member rows ``(id, rep, digest)``, then one row per representative with key, count and best row."""
    task, number = TaskContext.get().partitionId() << 40, 0
    trie, reps = PatriciaTrie(1 << 62), {}

    def rows(columns):
        size = len(columns["rep"])
        return pa.RecordBatch.from_pydict({n: columns.get(n, [None] * size) for n in _LOCAL.names}, schema=_LOCAL)

    def handed_on():
        numbers = list(reps)
        for at in range(0, len(numbers), 256):
            some = numbers[at:at + 256]
            keys = [reps[r][3] for r in some]
            yield rows({
                "rep": some, "key": keys, "bytes": [len(k) for k in keys],
                "hash": [xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in keys], "n": [reps[r][1] for r in some],
                "points": [-reps[r][0][0] for r in some],
                "best": [None if reps[r][0][1] == NO_ID else reps[r][0][1] for r in some]})

    for batch in small_batches(batches):
        ids, of, digests = batch.column(0).to_pylist(), [], []
        for i, text in zip(ids, batch.column(1).to_pylist()):
            text = text or b""
            key = text.translate(None, ASCII_WS)
            rank = (-len(text.decode("utf-8", "replace")), NO_ID if i is None else i)
            number += 1
            rep = trie.insert(key, task + number, None)
            if rep == task + number:
                reps[rep] = [rank, 1, hashlib.sha256(key).hexdigest(), key]
            else:
                state = reps[rep]
                state[0], state[1] = min(state[0], rank), state[1] + 1
            of.append(rep)
            digests.append(reps[rep][2])
        yield rows({"id": ids, "rep": of, "text_sha256": digests})
        if trie.used > LOCAL_MEMORY:
            yield from handed_on()
            trie, reps = PatriciaTrie(1 << 62), {}
    yield from handed_on()


def _classes(batches):
    """Class of each representative in a partition: the smallest representative with the same bytes."""
    trie = PatriciaTrie()
    reps, classes = [], []
    schema = pa.schema([("rep", pa.int64()), ("class", pa.int64())])
    try:
        for batch in small_batches(batches):
            for key, rep in zip(batch.column("key").to_pylist(), batch.column("rep").to_pylist()):
                trie.insert(key, rep, rep)
        for rep, owner in trie.owners():
            reps.append(rep)
            classes.append(owner)
            if len(reps) == 50_000:
                yield pa.RecordBatch.from_pydict({"rep": reps, "class": classes}, schema=schema)
                reps, classes = [], []
        yield pa.RecordBatch.from_pydict({"rep": reps, "class": classes}, schema=schema)
    finally:
        trie.drop()  # also when the task fails


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept, text_sha256``."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    local = written(src.mapInArrow(_local, "id long, rep long, text_sha256 string, key binary, bytes long, hash long, "
                                           "n long, points long, best long"), "exact")
    reps = local.where(F.col("n").isNotNull())
    dealt = reps.select("rep", "key", "bytes", "hash")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    classes = written(dealt.repartition(parts, "bytes", "hash").select("rep", "key")
                      .mapInArrow(_classes, "rep long, class long"), "exact-classes")
    # most code points, then smallest id (null last): one comparable value per representative
    order = F.struct((-F.col("points")).alias("points"), F.col("best").isNull().alias("none"), F.col("best").alias("best"))
    totals = (reps.select("rep", "n", order.alias("rank")).join(classes, "rep")
              .groupBy("class").agg(F.sum("n").alias("group_size"), F.min("rank")["best"].alias("keep_id")))
    owner = classes.join(totals, "class").select("rep", "group_size", "keep_id")
    return (local.where(F.col("n").isNull()).select("id", "rep", "text_sha256").join(owner, "rep")
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
