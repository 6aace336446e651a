"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

The commonest training words are items, about as many as the square root of the number of distinct words, dealt by
frequency into classes; all other words share one tail item as targets. The next item's class, and then the item within
its class, get scores from hashed features of the words before it: the last one (a rarer word by a code of its own), the items of the
last two together, and the item before the last with the last skipped. Tail words divide the tail item's chance by their
training counts.

Weights are trained in rounds, each over documents of its own: learners take stochastic gradient steps from the weights of
the round before, and their steps are averaged row by row, weighted by how often a row was used. A learner gets a share of
bounded size, rounds grow from one learner on, and both follow from the number of training tokens alone, so the model does
not depend on how the rows lie in files.

Training counts and gradients cover all training documents. A null or empty text is its end alone; a row without an id is
a training document; rows that repeat an id are counted and scored each. Without any training document every word is
unknown. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lodestrata.llm import text as T
from lodestrata.storage import materialise, release

FOLDS, HELD_OUT = 7, 2
#: Fewest and most classes (and items of a class); a task holds the weights, at most some 100 MB.
NARROW, WIDE = 32, 64
#: Rows of hashed features, codes of rarer words, gradient steps' tokens, step size.
HASHED, CODES, STEP_TOKENS, RATE = 1 << 15, 1 << 15, 4096, 0.2
#: Tokens of a learner, growth of the number of learners from round to round, parts that documents are dealt into.
SHARE, GROWTH, PARTS = 1 << 21, 4, 1 << 30
#: Commonest words whose counts every task holds; counts of all others are joined.
COMMON = 1 << 17
#: Rows of weights that travel together.
ROWS = 256
END = np.uint64(0x454E44)
#: Shift that leaves the leading twenty bits of a hash.
SLOT = np.uint64(44)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every word in lower case, with the end of the text after its words."""
    data, at = T.texts_of(column)
    doc, start, end = T.words(data, at)
    last = np.searchsorted(doc, np.arange(len(column)), "right")
    hashes = np.insert(T.word_hashes(data, start, end), last, END)
    return np.insert(doc, last, np.arange(len(column))), hashes


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words in a task, merged now and then."""
    waiting, size = [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        every, inverse = np.unique(np.concatenate([h for h, _ in waiting]), return_inverse=True)
        return every, np.bincount(inverse, np.concatenate([n for _, n in waiting])).astype(np.int64)

    def rows(hashes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["h", "c"])

    for batch in batches:
        for part in T.slices(batch):
            waiting.append(np.unique(tokens(part.column("text"))[1], return_counts=True))
            size += len(waiting[-1][0])
            if size > 2_000_000:
                waiting = [merged()]
                size = len(waiting[0][0])
                if size > 1_000_000:
                    yield rows(*waiting[0])
                    waiting, size = [], 0
    if waiting:
        yield rows(*merged())


@dataclass
class Vocabulary:
    """Commonest words by hash (ascending) with counts and items; -1 marks a tail word. total and distinct are of all words."""
    hashes: np.ndarray
    counts: np.ndarray
    items: np.ndarray
    item_counts: np.ndarray
    total: int
    distinct: int
    classes: int
    width: int

    @property
    def tail(self) -> int:
        return len(self.item_counts) - 1

    @property
    def tail_mass(self) -> int:
        """What a tail word's count plus one is divided by."""
        return int(self.item_counts[self.tail]) + max(0, self.distinct - self.tail) + 1

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, count) of every token; count -1 where it has to be joined."""
        if not len(self.hashes):
            return np.full(len(hashes), self.tail), np.full(len(hashes), -1, np.int64)
        if getattr(self, "_slots", None) is None:
            top = (self.hashes >> SLOT).astype(np.int64)
            n = np.bincount(top, minlength=1 << 20)
            self._slots = np.minimum(np.cumsum(n) - n, len(self.hashes) - 1), n > 1
        # A slot by leading bits holds one word mostly; only those with more are searched.
        top = (hashes >> SLOT).astype(np.int64)
        at = self._slots[0][top]
        more = np.flatnonzero(self._slots[1][top])
        at[more] = np.minimum(np.searchsorted(self.hashes, hashes[more]), len(self.hashes) - 1)
        found = self.hashes[at] == hashes
        item = np.where(found, self.items[at], -1)
        return np.where(item < 0, self.tail, item), np.where(found, self.counts[at], -1)

    def code(self, item: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """What a word is as context: its item, or beyond the items and the start of a text one of ``CODES`` by its hash."""
        return np.where(item < self.tail, item, self.tail + 2 + (hashes >> T.U64(40)).astype(np.int64) % CODES).astype(np.uint16)


def _commonest(counts: DataFrame, n: int, distinct: int) -> pd.DataFrame:
    """About the ``n`` commonest of (h, c), commonest first; the tasks send no others.

    Counts fall into ranges of their seven leading bits, so a few thousand numbers tell where to cut; of the range at the
    cut a share by hash is taken.
    """
    if distinct > n:
        ranged = counts.withColumn("low", F.expr("shiftleft(shiftright(c, greatest(length(bin(c)) - 7, 0)), greatest(length(bin(c)) - 7, 0))"))
        left = n
        for cut, words in sorted(((r["low"], r["count"]) for r in ranged.groupBy("low").count().collect()), reverse=True):
            if words > left:
                break
            left -= words
        counts = ranged.where((F.col("low") > cut) | ((F.col("low") == cut) & (F.pmod(F.xxhash64("h"), F.lit(1 << 40)) < (left << 40) // words)))
    return counts.select("h", "c").toPandas().sort_values(["c", "h"], ascending=[False, True])


def vocabulary(counts: DataFrame, classes: int | None = None, width: int | None = None, common: int = COMMON) -> Vocabulary:
    """From (h, c) of all words; only about the ``common`` commonest reach the driver."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    side = min(max(8 * round(distinct ** 0.25 / 8), NARROW), WIDE)
    classes, width = classes or side, width or side
    top = _commonest(counts, common, distinct)
    hashes, n = top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    size = min(len(top), classes * width - 1)
    items = np.where(np.arange(len(top)) < size, np.arange(len(top)), -1)
    item_counts = np.append(n[:size], total - n[:size].sum())
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], n[order], items[order], item_counts, int(total), int(distinct), classes, width)


class Model:
    """Weights: ``by_class`` adds to the classes' scores, ``by_item`` to those of the items of one class."""

    def __init__(self, words: Vocabulary, hashed: int = HASHED):
        self.words, self.hashed, self.items = words, hashed, len(words.item_counts)
        c, w, k = words.classes, words.width, self.items
        chance = np.zeros(c * w) + 1e-9
        chance[:k] = words.item_counts + 1.0
        chance = chance.reshape(c, w)
        self.class_bias = np.log(chance.sum(axis=1) / chance.sum()).astype(np.float32)
        self.item_bias = np.log(chance / chance.sum(axis=1, keepdims=True)).astype(np.float32)
        self.by_class = np.zeros((2 * (k + 1) + hashed, c), np.float32)
        self.by_item = np.zeros((c * (k + 1) + hashed, w), np.float32)
        self.squares = [np.full(len(t), 1e-4, np.float32) for t in (self.by_class, self.by_item)]

    def features(self, doc: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``by_class`` and ``by_item`` for every token; what stands before a text's first is a code of its own."""
        k, start = self.items + 1, self.items
        before = []
        for back in (1, 2):
            shifted = np.full(len(code), start, np.int64)
            same = doc[back:] == doc[:-back]
            shifted[back:][same] = code[:-back][same]
            before.append(shifted)
        one, two = before
        rare = one > start
        last, two = np.where(rare, self.words.tail, one), np.where(two > start, self.words.tail, two)
        class_ = np.minimum(code, self.words.tail).astype(np.int64) // self.words.width

        def hashed(kind: int, a: np.ndarray | int, b: np.ndarray) -> np.ndarray:
            return (T.mixed((((a + (kind << 20)) << 20) + b).astype(np.uint64)) % T.U64(self.hashed)).astype(np.int64)

        above, below = 2 * k, self.words.classes * k
        return np.stack([np.where(rare, above + hashed(0, 0, one), one), k + two, above + hashed(1, last, two)]), \
            np.stack([np.where(rare, below + hashed(2, class_, one), class_ * k + one), below + hashed(3, class_, two)])

    def forward(self, item: np.ndarray, rows: tuple[np.ndarray, np.ndarray], chances: bool = True) -> tuple[list[np.ndarray], np.ndarray]:
        """Chances of classes and of the class's items (if asked for), and the log chance of the item (natural)."""
        class_, place = item // self.words.width, item % self.words.width
        out, log = [], np.zeros(len(item))
        for bias, table, own, target in ((self.class_bias, self.by_class, rows[0], class_),
                                         (self.item_bias[class_], self.by_item, rows[1], place)):
            score = table.take(own[0], axis=0)
            score += bias
            for r in own[1:]:
                score += table.take(r, axis=0)
            score -= score.max(axis=1, keepdims=True)
            log += score[np.arange(len(item)), target]
            np.exp(score, out=score)
            total = score @ np.ones(score.shape[1], np.float32)
            log -= np.log(total)
            if chances:
                score /= total[:, None]
                out.append(score)
        return out, log

    def log10(self, doc: np.ndarray, code: np.ndarray) -> np.ndarray:
        out = np.zeros(len(code))
        rows, item = self.features(doc, code), np.minimum(code, self.words.tail)
        for first in range(0, len(item), 4 * STEP_TOKENS):
            part = slice(first, first + 4 * STEP_TOKENS)
            out[part] = self.forward(item[part], (rows[0][:, part], rows[1][:, part]), False)[1]
        return out / np.log(10)


def run_sums(rows: np.ndarray, at: np.ndarray, n: np.ndarray, few: int = 8) -> np.ndarray:
    """Sums of the runs of ``n`` rows that start ``at``. Most runs are short and added row by row for all runs together;
    ``reduceat`` walks every run column by column."""
    out = rows.take(at, axis=0)
    for k in range(1, few):
        more = np.flatnonzero((n > k) & (n <= few))
        out[more] += rows.take(at[more] + k, axis=0)
    for i in np.flatnonzero(n > few):
        np.add.reduce(rows[at[i]:at[i] + n[i]], axis=0, out=out[i])
    return out


class Learner:
    """A learner's own copy of the weights and its step sizes."""

    def __init__(self, model: Model, rate: float = RATE):
        self.model, self.rate = model, rate
        self.tables = [model.by_class.copy(), model.by_item.copy()]
        self.squares = [x.copy() for x in model.squares]
        self.used = [np.zeros(len(t), np.int64) for t in self.tables]

    def learn(self, doc: np.ndarray, code: np.ndarray) -> None:
        model = self.model
        own = model.by_class, model.by_item
        model.by_class, model.by_item = self.tables
        rows, item = model.features(doc, code), np.minimum(code, model.words.tail)
        for first in range(0, len(item), STEP_TOKENS):
            part = slice(first, first + STEP_TOKENS)
            target = item[part]
            chances, _ = model.forward(target, (rows[0][:, part], rows[1][:, part]))
            for t, (chance, hit) in enumerate(zip(chances, (target // model.words.width, target % model.words.width), strict=True)):
                chance[np.arange(len(hit)), hit] -= 1
                for r in rows[t][:, part]:
                    order = np.argsort(r)
                    at = np.flatnonzero(np.diff(r[order], prepend=-1))
                    row, n = r[order][at], np.diff(np.append(at, len(r)))
                    slope = run_sums(chance.take(order, axis=0), at, n)
                    self.squares[t][row] += np.einsum("ij,ij->i", slope, slope) / slope.shape[1]
                    self.used[t][row] += n
                    slope *= (self.rate / np.sqrt(self.squares[t][row]))[:, None]
                    self.tables[t][row] -= slope
        model.by_class, model.by_item = own


def _encoded(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Vocabulary = shared.value
        for batch in batches:
            for part in T.slices(batch):
                doc, hashes = tokens(part.column("text"))
                code = words.code(words.look_up(hashes)[0], hashes)
                at = (np.searchsorted(doc, np.arange(part.num_rows + 1)) * code.itemsize).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("part"), pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(at), pa.py_buffer(code)])
                     .cast(pa.binary())], ["part", "codes"])

    return run


def _learned(shared, sums: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        learner, waiting, size = Learner(model), [], 0

        def learn() -> None:
            learner.learn(np.repeat(np.arange(len(waiting)), [len(c) for c in waiting]), np.concatenate(waiting))

        for batch in batches:
            for codes in batch.column("codes"):
                waiting.append(np.frombuffer(codes.as_buffer(), np.uint16).astype(np.int64))
                size += len(waiting[-1])
                if size > 32 * STEP_TOKENS:
                    learn()
                    waiting, size = [], 0
        if size:
            learn()
        salt = TaskContext.get().partitionId() % sums
        for t, (start, own, used) in enumerate(zip((model.by_class, model.by_item), learner.tables, learner.used, strict=True)):
            for first in range(0, len(own), ROWS):
                n = used[first:first + ROWS].astype(np.float32)
                at = np.flatnonzero(n)
                if len(at):
                    moved = (own[first + at] - start[first + at]).astype(np.float16)
                    square = learner.squares[t][first + at] - model.squares[t][first + at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t]), pa.array([first]), pa.array([salt]), pa.array([1], pa.int64())]
                        + [pa.array([x.tobytes()], pa.binary()) for x in (at.astype(np.uint8), n[at], square, moved)], STEP_COLUMNS)

    return run


STEP_COLUMNS = ["t", "first", "salt", "learners", "at", "used", "squares", "moved"]
STEPS = "t long, first long, salt long, learners long, at binary, used binary, squares binary, moved binary"


def _added(exact: bool):
    """Merges steps of the same rows: learners' own in half precision, sums (``exact``) weighted already in single."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        used, squares, total = np.zeros(ROWS, np.float32), np.zeros(ROWS, np.float32), None
        for r in group.itertuples(index=False):
            at, n = np.frombuffer(r.at, np.uint8), np.frombuffer(r.used, np.float32)
            moved = np.frombuffer(r.moved, np.float32 if exact else np.float16).reshape(len(at), -1).astype(np.float32)
            if total is None:
                total = np.zeros((ROWS, moved.shape[1]), np.float32)
            used[at] += n
            squares[at] += np.frombuffer(r.squares, np.float32)
            total[at] += moved if exact else moved * n[:, None]
        at = np.flatnonzero(used)
        out = group.head(1).copy()
        out["learners"] = group["learners"].sum()
        for name, x in (("at", at.astype(np.uint8)), ("used", used[at]), ("squares", squares[at]), ("moved", total[at])):
            out[name] = [x.tobytes()]
        return out

    return run


def rounds(tokens_: int, share: int = SHARE, growth: int = GROWTH) -> list[tuple[int, int, int]]:
    """(first part, end part, learners) of every round: one learner, then ``growth`` times as many, until all are dealt."""
    out, done, learners = [], 0, 1
    while done < tokens_:
        upto = done + learners * share
        # What is left and would not fill half of another round goes with this one.
        if tokens_ - upto < learners * share * growth // 2:
            upto = tokens_
        out.append((PARTS * done // tokens_, PARTS * upto // tokens_, -(-(upto - done) // share)))
        done, learners = upto, learners * growth
    return out


def train(docs: DataFrame, words: Vocabulary) -> Model:
    """The model of all rows of ``docs`` (doc_id, text).

    Texts are written once as codes of two bytes a word; each round deals the documents of its own evenly to learners.
    """
    model, context = Model(words), docs.sparkSession.sparkContext
    if not words.total:
        return model
    codes = materialise(docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS)).alias("part"), "text").mapInArrow(
        _encoded(context.broadcast(words)), "part long, codes binary"), "codes")  # words: COMMON hashes and counts
    for first, end, learners in rounds(words.total):
        shared = context.broadcast(model)  # bounded by WIDE and HASHED
        sums = max(1, round(learners ** 0.5))
        moved = codes.where(F.col("part").between(first, end - 1)).select("codes").repartition(learners) \
            .mapInArrow(_learned(shared, sums), STEPS)
        if sums > 1:
            moved = moved.groupBy("t", "first", "salt").applyInPandas(_added(False), STEPS)
        merged = moved.groupBy("t", "first").applyInPandas(_added(sums > 1), STEPS)
        for row in merged.toLocalIterator():
            table = (model.by_class, model.by_item)[row["t"]]
            at = row["first"] + np.frombuffer(row["at"], np.uint8).astype(np.int64)
            used = np.frombuffer(row["used"], np.float32)
            table[at] += np.frombuffer(row["moved"], np.float32).reshape(len(at), -1) / used[:, None]
            model.squares[row["t"]][at] += np.frombuffer(row["squares"], np.float32) / row["learners"]
    release(codes)
    return model


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        words, row = model.words, TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in T.slices(batch):
                n = part.num_rows
                doc, hashes = tokens(part.column("text"))
                item, count = words.look_up(hashes)
                log = np.log10(np.maximum(count, 0) + 1.0)
                chance = model.log10(doc, words.code(item, hashes))
                chance += np.where(item == words.tail, log - np.log10(words.tail_mass), 0)
                rare = count < 0
                sums = lambda x: np.bincount(doc, x, minlength=n)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(doc[rare], minlength=n))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), part.column("doc_id"), part.column("held_out"), pa.array(np.bincount(doc, minlength=n)),
                     pa.array(sums(count > 0).astype(np.int64)), pa.array(sums(log)), pa.array(sums(chance)),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(hashes[rare].view(np.int64)))],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "score", "rare"])
                row += n

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
    training = docs.where(~F.col("held_out"))
    counts = materialise(training.select("text").mapInArrow(_counted, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "counts")
    words = vocabulary(counts)
    model = train(training, words)
    scored = materialise(docs.mapInArrow(
        _scores(docs.sparkSession.sparkContext.broadcast(model)),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, rare array<long>"), "scores")
    # Words beyond the commonest: their counts meet the documents that hold them.
    rare = scored.select("row", F.explode("rare").alias("h")).join(counts, "h").groupBy("row").agg(
        F.count(F.lit(1)).alias("more_known"), F.sum(F.log10(F.col("c") + F.lit(1.0))).alias("more_logs"))
    more = F.coalesce("more_logs", F.lit(0.0))
    per_token = float(np.log10(words.total + words.distinct + 1))
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.lit(per_token)).alias("base_score"), (F.col("score") + more).alias("score"))
