"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word (a run without white space; case and marks at its ends do not count) has
the mean of the vectors of its hashed whole and its hashed character n-grams.
Filters of several widths run over the words of a text; each keeps its greatest
response (max pooling), and a logistic unit over these gives the raw score. All
weights are trained in numpy by stochastic gradient descent with a step size per
weight; only the windows that win the pooling pass gradients on.

Training takes every labelled row that is not held out. A fifth of them, by hash
of the id, is not trained on; all others are read in rounds, each row in one: the
first is about `ROWS_PER_TASK` rows in one task, each round four times as many as
all before it. Every task of a round takes gradient steps over its rows, and the
tasks' weights are averaged, row by row of the vectors, by how often each met that
row. With few rows, a task goes over them several times. In the loss, labels and
languages count the same if the scarcer has rows enough, so no row need be left
out for balance. Weights depend on how rows are dealt to tasks.

From the other fifth comes a threshold per language, which makes the fewest errors
over all its rows. A language with few such rows has the threshold of all. The
language of a text is not an input: it is told from the text, by the likelihood of
its n-grams in all labelled rows of each language. The score of a text is its raw
score relative to its threshold, so 0.5 is the threshold in every language.

Scoring reads every whole text in blocks of words. The filters' responses to a
word are worked out once and remembered for a while.

A text that is null or without words has the score of the bias. Where nothing
can be learnt, as no row is labelled toxic or none is not, every score is 0. Ids
and labels that are null are not learnt from, and a null language takes no part
in thresholds. Repeated rows are scored each; a document with several labels is
an example with each. Extra columns are left out; an empty table gives an empty
one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from math import ceil, inf, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import MAY_BE, batches, held_out, may_be, steps, struct_array, written
from fareloom.llm.quality import BUCKETS, subwords

ROWS_PER_TASK = 8000  # about, of a round of training
CHUNK_BYTES = 16 << 20  # texts that a task trains on before it reads on
VISITS = 32_000  # of rows in training; fewer rows are visited up to EPOCHS times
FEWEST_TO_CALIBRATE = 8  # rows of either label in a language
WIDTHS = (1, 2, 3)
FILTERS = 16  # of each width
DIMENSIONS = 16
EPOCHS = 8
MINIBATCH = 16
RATE = 0.1
CACHED_WORDS = 100_000
ACCEPT = 0.5
_BLOCK = 1 << 14  # words
_NEW_WORDS = 1 << 13  # looked at together
_ROWS = 4096  # of the vectors that are averaged together
_PAD = max(WIDTHS) - 1
_PARTS = [(w, j) for w in WIDTHS for j in range(w)]  # of all filters, word by word
_MARKS = ".,;:!?#$%&*+=|<>~^_/@\"'()[]{}«»„“”…-"


def words(text: bytes) -> list[str]:
    return text.decode("utf-8", "replace").split()


def _buckets(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words, and where those of each word start; each word has some."""
    found, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(some), _NEW_WORDS):
        block = some[at : at + _NEW_WORDS]
        bucket, owner = subwords([word.lower().strip(_MARKS) or word for word in block])
        found.append(bucket[np.argsort(owner, kind="stable")])
        lengths.append(np.bincount(owner, minlength=len(block)))
    lengths = np.concatenate(lengths)
    return np.concatenate(found), np.cumsum(lengths) - lengths


def _means(table: np.ndarray, bucket: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row per word: the mean of its buckets' rows of the table."""
    out = np.zeros((len(starts), table.shape[1]), table.dtype)
    ends = np.append(starts, len(bucket))
    for at in range(0, len(starts), _NEW_WORDS):
        own = ends[at : at + _NEW_WORDS + 1]
        total = np.add.reduceat(table[bucket[own[0] : own[-1]]], own[:-1] - own[0], axis=0)
        out[at : at + len(total)] = total / np.diff(own)[:, None].astype(np.float32)
    return out


def _sums(rows: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners in order, each once, and the sums of their rows."""
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    return owner[starts], np.add.reduceat(rows[order], starts, axis=0)


def responses(parts: np.ndarray) -> np.ndarray:
    """Responses of all filters to the windows that start at each word.

    `parts` has what each word adds by its place in a window, and ends with
    padding: the windows start at all rows but the last ones.
    """
    n, columns, at = len(parts) - _PAD, [], 0
    for width in WIDTHS:
        total = parts[:n, at : at + FILTERS].copy()
        for j in range(1, width):
            total += parts[j : n + j, at + j * FILTERS : at + (j + 1) * FILTERS]
        columns.append(total)
        at += width * FILTERS
    return np.concatenate(columns, axis=1)


class Weights:
    """All weights, with the mean square of their gradients so far."""

    def __init__(self, random: np.random.Generator):
        def normal(*shape, scale=0.3):
            return random.normal(0, scale, shape).astype(np.float32)

        pooled = len(WIDTHS) * FILTERS
        self.vectors = normal(BUCKETS, DIMENSIONS)
        self.filters = normal(DIMENSIONS, len(_PARTS) * FILTERS)
        self.offsets, self.out = normal(pooled, scale=0.01), normal(pooled)
        self.bias = np.zeros(1, np.float32)
        self.seen = {name: np.full_like(x, 1e-6) for name, x in vars(self).items()}
        self.met, self.steps = np.zeros(BUCKETS), 0  # steps on each vector, and on all else

    def step(self, name: str, gradient: np.ndarray, rows=slice(None)) -> None:
        seen, weights = self.seen[name], getattr(self, name)
        seen[rows] += gradient**2
        weights[rows] -= RATE * gradient / np.sqrt(seen[rows])

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, bucket, starts, counts=1.0) -> None:
        """One step on a few texts, each the numbers of its words; `counts` weighs texts."""
        used, where = np.unique(np.concatenate(texts), return_inverse=True)
        lengths = np.append(starts, len(bucket))[used + 1] - starts[used]
        firsts = np.cumsum(lengths) - lengths
        own = bucket[np.repeat(starts[used] - firsts, lengths) + np.arange(lengths.sum())]
        vectors = _means(self.vectors, own, firsts)
        parts = np.vstack([vectors @ self.filters, np.zeros((1, self.filters.shape[1]))])
        parts = parts.astype(vectors.dtype, copy=False)
        filters = self.filters.reshape(DIMENSIONS, len(_PARTS), FILTERS)
        windows, pooled, at = [], [], 0
        for text in texts:
            best, places = self._winners(parts, where[at : at + len(text)])
            pooled.append(best)
            windows.append(places)
            at += len(text)
        pooled = np.array(pooled) + self.offsets
        hidden = np.maximum(pooled, 0)
        error = (1 / (1 + np.exp(-np.clip(hidden @ self.out + self.bias, -30, 30)))) - labels
        error = (error * counts / len(texts)).astype(np.float32)
        back = error[:, None] * self.out * (pooled > 0)
        vectors = np.vstack([vectors, np.zeros((1, DIMENSIONS), np.float32)])
        to_filters, to_vectors, moved_words = np.zeros_like(filters), [], []
        windows = np.array(windows)  # text, filter, place in the window
        for part, (width, j) in enumerate(_PARTS):
            own_filters = slice(WIDTHS.index(width) * FILTERS, (WIDTHS.index(width) + 1) * FILTERS)
            at_word, moved = windows[:, own_filters, j], back[:, own_filters]
            to_filters[:, part] += np.einsum("tfd,tf->df", vectors[at_word], moved)
            there, (row, column) = moved != 0, np.nonzero(moved)
            to_vectors.append(moved[there][:, None] * filters[:, part].T[column])
            moved_words.append(at_word[there])
        self.step("out", error @ hidden)
        self.step("bias", error.sum(keepdims=True))
        self.step("offsets", back.sum(axis=0))
        self.step("filters", to_filters.reshape(self.filters.shape))
        self.steps += 1
        touched, total = _sums(np.concatenate(to_vectors), np.concatenate(moved_words))
        touched, total = touched[touched < len(used)], total[touched < len(used)]  # no padding
        if len(touched):
            n = lengths[touched]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            mine = own[np.repeat(firsts[touched], n) + inside]
            rows, total = _sums(np.repeat(total / n[:, None].astype(np.float32), n, axis=0), mine)
            self.step("vectors", total, rows)
            self.met[rows] += 1

    @staticmethod
    def _winners(parts: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's greatest response to a text, and the words of that window."""
        padded = np.append(numbers, np.full(_PAD, len(parts) - 1))
        most, first = None, None
        for at in range(0, len(numbers), _BLOCK):
            found = responses(parts[padded[at : at + _BLOCK + _PAD]])
            best = found.argmax(axis=0)
            here = found[best, np.arange(found.shape[1])]
            if most is None:
                most, first = here, best
            else:
                first = np.where(here > most, best + at, first)
                most = np.maximum(most, here)
        return most, padded[first[:, None] + np.arange(_PAD + 1)]


def _piece(raw: np.ndarray, step: np.ndarray) -> tuple:
    """Of scores in order, each once, and what errors a cut above each adds: the sum of
    these, the ends, and the best cut between them: errors, minus the gap, and place."""
    below, best = np.cumsum(step), (inf, 0.0, 0.0)
    if len(raw) > 1:
        gap = np.diff(raw)
        at = np.lexsort((-gap, below[:-1]))[0]
        best = (float(below[at]), -float(gap[at]), float((raw[at] + raw[at + 1]) / 2))
    return (float(below[-1]), float(raw[0]), float(raw[-1]), *best)


def _joined(a: tuple, b: tuple) -> tuple:
    """The piece of two, of which all scores of the second are above those of the first."""
    between = (a[0], a[2] - b[1], (a[2] + b[1]) / 2)
    return (a[0] + b[0], a[1], b[2], *min(a[3:], between, (a[0] + b[3], *b[4:])))


def _cut(piece: tuple) -> float:
    total, first, last = piece[:3]
    return min((0.0, -2.0, first - 1), piece[3:], (total, -2.0, last + 1))[2]


def threshold(raw: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The cut between raw scores with the least weight of errors, in its widest gap."""
    raw, at = np.unique(raw, return_inverse=True)
    return _cut(_piece(raw, np.bincount(at, np.where(toxic == 1, weight, -weight))))


def _pieces(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A piece per language, from its scores in order."""
    found: dict[int, tuple] = {}
    for batch in rows:
        of = batch.column("of").to_numpy()
        raw, step = batch.column("raw").to_numpy(), batch.column("step").to_numpy()
        for one in np.unique(of).tolist():
            new = _piece(raw[of == one], step[of == one])
            found[one] = _joined(found[one], new) if one in found else new
    if found:
        yield pa.RecordBatch.from_pydict(
            {"of": pa.array(list(found), pa.int32()), "piece": list(map(list, found.values()))}
        )


def thresholds(scored: DataFrame, names: list[str]) -> dict[int, float]:
    """The threshold of each language, by its number, and of all rows (-1).

    Scores are counted and cut into ranges of languages and scores. A range hands over
    its errors and best cut, so the thresholds are those of all rows in one order.
    """
    number = {name: i for i, name in enumerate(names)}
    own = F.lit(-1)
    if names:
        listed = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])
        own = F.coalesce(F.try_element_at(listed, F.col("lang")), F.lit(-1))
    of = F.explode(F.array_distinct(F.array(own, F.lit(-1)))).alias("of")
    step = F.when(F.col("label") == 1, 1.0).otherwise(-1.0)
    counted = scored.select(of, "raw", step.alias("step")).groupBy("of", "raw").agg(F.sum("step").alias("step"))
    ranged = written(counted, "toxicity-scores").repartitionByRange("of", "raw")
    ranged = ranged.sortWithinPartitions("of", "raw")
    rows = ranged.mapInArrow(_pieces, "of int, piece array<double>").collect()
    found: dict[int, list[tuple]] = {}
    for of, piece in sorted((row["of"], tuple(row["piece"])) for row in rows):
        found.setdefault(of, []).append(piece)
    return {
        of: _cut(reduce(_joined, sorted(pieces, key=lambda piece: piece[1])))
        for of, pieces in found.items()
    }


def _chunks(rows: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (text, lang, label) in the order of their places, so many that fit a chunk."""
    held, size = [], 0
    for batch in rows:
        place = batch.column("place").to_pylist()
        langs, labels = batch.column("lang").to_pylist(), batch.column("label").to_pylist()
        texts = (text for some in batches(batch.column("text")) for text in some)
        for row in zip(place, labels, texts, langs, strict=True):
            held.append(row)
            size += len(row[2])
            if size >= CHUNK_BYTES:
                yield _ordered(held)
                held, size = [], 0
    if held:
        yield _ordered(held)


def _ordered(rows: list[tuple]) -> list[tuple]:
    rows = sorted(rows, key=lambda row: (*row[:3], row[3] or ""))
    return [(text, lang, label) for _, label, text, lang in rows]


def _numbered(texts: Iterable[bytes]):
    """The numbers of each text's words, and the buckets of all words."""
    known: dict[str, int] = {}
    numbers = [
        np.array([known.setdefault(word, len(known)) for word in words(text)], np.int32)
        for text in texts
    ]
    return numbers, *_buckets(list(known))


def _languages(texts, langs, names: list[str], bucket, starts) -> np.ndarray:
    """How often every bucket is in the texts of each language."""
    counts = np.zeros((BUCKETS, len(names)))
    owner = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(bucket)))
    for column, name in enumerate(names):
        own = [text for text, lang in zip(texts, langs, strict=True) if lang == name]
        if own:
            often = np.bincount(np.concatenate(own), minlength=len(starts))
            counts[:, column] += np.bincount(bucket, often[owner], BUCKETS)
    return counts


_TYPES = "block int, slot int, sums binary"
_HEAD, _COUNTS = -1, -2  # blocks that hold no vectors


def _handed(block: int, slot: int, sums: np.ndarray) -> pa.RecordBatch:
    kinds = {"block": pa.array([block], pa.int32()), "slot": pa.array([slot], pa.int32())}
    return pa.RecordBatch.from_pydict(kinds | {"sums": [sums.astype(np.float32).tobytes()]})


def _add(table: pa.Table) -> pa.Table:
    """The sum of all tasks' rows of one block."""
    total = 0.0
    for sums in table.column("sums"):
        total = total + np.frombuffer(sums.as_buffer(), np.float32).astype(np.float64)
    block = table.column("block")[0].as_py()
    return pa.Table.from_batches([_handed(block, 0, total)])


def _summed(blocks: DataFrame, slots: int) -> dict[int, np.ndarray]:
    """Blocks summed in groups of about the root of the number of tasks."""
    slot = F.col("slot") % max(1, ceil(sqrt(slots)))
    summed = blocks.withColumn("slot", slot).groupBy("block", "slot").applyInArrow(_add, _TYPES)
    summed = summed.groupBy("block").applyInArrow(_add, _TYPES)
    return {row["block"]: np.frombuffer(row["sums"], np.float32) for row in summed.collect()}


def _weighted(met: np.ndarray, weights: np.ndarray, seen: np.ndarray) -> np.ndarray:
    return np.concatenate([met[:, None], met[:, None] * weights, met[:, None] * seen], axis=1)


_HEADS = ("filters", "offsets", "out", "bias")


def _round(rows: DataFrame, model: Weights, names: list[str], counts: dict, epochs: int, tasks: int):
    """One round of training: the model with the tasks' mean weights, and the counts of
    languages in the rows. `counts` has the weight of each label and language."""

    def work(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = TaskContext.get().partitionId()
        random, often = np.random.default_rng(slot), np.zeros((BUCKETS, len(names)))
        model.met, model.steps = np.zeros(BUCKETS), 0
        for chunk in _chunks(batches_):
            texts, langs, labels = zip(*chunk, strict=True)
            numbers, bucket, starts = _numbered(texts)
            often += _languages(numbers, langs, names, bucket, starts)
            labels = np.array(labels, np.int64)
            weight = np.array([counts[pair] for pair in zip(labels.tolist(), langs, strict=True)])
            filled = np.array([i for i, words in enumerate(numbers) if len(words)], np.int64)
            for _ in range(epochs):
                order = random.permutation(filled)
                for start in range(0, len(order), MINIBATCH):
                    some = order[start : start + MINIBATCH]
                    model.learn([numbers[i] for i in some], labels[some], bucket, starts, weight[some])
        yield _handed(_COUNTS, slot, often)
        if model.steps:
            head, seen = (np.concatenate([x[name].ravel() for name in _HEADS]) for x in (vars(model), model.seen))
            yield _handed(_HEAD, slot, _weighted(np.array([model.steps]), head[None], seen[None]))
        for at in range(0, BUCKETS, _ROWS):
            own = slice(at, at + _ROWS)
            if model.met[own].any():
                sums = _weighted(model.met[own], model.vectors[own], model.seen["vectors"][own])
                yield _handed(at // _ROWS, slot, sums)

    found = _summed(rows.select("text", "lang", "label", "place").coalesce(tasks).mapInArrow(work, _TYPES), tasks)
    often = found.pop(_COUNTS, np.zeros(BUCKETS * len(names))).reshape(BUCKETS, len(names))
    for block, sums in found.items():
        if block == _HEAD:
            at, (head, seen) = 0, np.split(sums[1:] / sums[0], 2)
            for name in _HEADS:
                shape, n = getattr(model, name).shape, getattr(model, name).size
                setattr(model, name, head[at : at + n].reshape(shape))
                model.seen[name], at = seen[at : at + n].reshape(shape), at + n
        else:
            sums = sums.reshape(-1, 1 + 2 * DIMENSIONS)
            met = np.flatnonzero(sums[:, 0])
            means = sums[met, 1:] / sums[met, :1]
            model.vectors[block * _ROWS + met] = means[:, :DIMENSIONS]
            model.seen["vectors"][block * _ROWS + met] = means[:, DIMENSIONS:]
    return model, often


def _count(rows: DataFrame, names: list[str]) -> np.ndarray:
    """How often every bucket is in the rows of each language."""

    def work(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.zeros((BUCKETS, len(names)))
        for chunk in _chunks(batches_):
            texts, langs, _ = zip(*chunk, strict=True)
            numbers, bucket, starts = _numbered(texts)
            often += _languages(numbers, langs, names, bucket, starts)
        yield _handed(_COUNTS, TaskContext.get().partitionId(), often)

    own = rows.select("text", "lang", "label", "place")
    found = _summed(own.mapInArrow(work, _TYPES), own.sparkSession.sparkContext.defaultParallelism)
    return found.get(_COUNTS, np.zeros(BUCKETS * len(names))).reshape(BUCKETS, len(names))


class Scorer:
    """Scores of texts by a trained model; words are remembered for a while."""

    def __init__(self, model: Weights | None, names: list[str], likelihood: np.ndarray):
        self.names, self.likelihood, self.cuts = names, likelihood, [0.0] * (len(names) + 1)
        if model is not None:
            self.vectors = model.vectors
            parts = (model.filters.ravel(), model.offsets, model.out, model.bias)
            self.head = np.concatenate(parts).astype(np.float32)
        self._unpack()

    def _unpack(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, 0), np.float32)
        if hasattr(self, "head"):
            pooled, n = len(WIDTHS) * FILTERS, DIMENSIONS * len(_PARTS) * FILTERS
            self.filters = self.head[:n].reshape(DIMENSIONS, -1)
            self.offsets, self.out = self.head[n : n + pooled], self.head[n + pooled : n + 2 * pooled]
            self.bias = float(self.head[-1])

    @staticmethod
    def read(arrays: bytes, names: list[str], cuts: list[float]) -> Scorer:
        flat, n = np.frombuffer(arrays, np.float32), BUCKETS * DIMENSIONS
        rest = len(flat) - BUCKETS * len(names)
        scorer = Scorer(None, names, flat[rest:].reshape(BUCKETS, len(names)))
        scorer.vectors, scorer.head = flat[:n].reshape(BUCKETS, DIMENSIONS), flat[n:rest]
        scorer.cuts = cuts
        scorer._unpack()
        return scorer

    def __getstate__(self):
        kept = ("names", "likelihood", "cuts", "vectors", "head")
        return {name: getattr(self, name) for name in kept}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._unpack()

    def remember(self, new: list[str], bucket: np.ndarray, starts: np.ndarray) -> None:
        """What each word adds to the filters' responses and to each language."""
        if not len(self.known) and len(new) or len(self.known) + len(new) > len(self.rows):
            self.known = {}
            size = max(len(new), CACHED_WORDS)
            self.rows = np.zeros((size, self.filters.shape[1] + len(self.names)), np.float32)
        first = len(self.known)
        added = [_means(self.vectors, bucket, starts) @ self.filters]
        added.append(_means(self.likelihood, bucket, starts))
        self.rows[first : first + len(new)] = np.concatenate(added, axis=1)
        self.known.update(zip(new, range(first, first + len(new)), strict=True))

    def learn(self, some: set[str]) -> None:
        new = list(some - self.known.keys())
        if len(self.known) + len(new) > max(len(self.rows), CACHED_WORDS):
            self.known, new = {}, list(some)
        if new:
            self.remember(new, *_buckets(new))

    def raw(self, numbers: np.ndarray) -> tuple[float, float]:
        """Raw score and threshold of a text, given by the numbers of its words."""
        if not len(numbers):
            pooled, cut = np.full_like(self.offsets, -np.inf), self.cuts[-1]
        else:
            pooled, likely = np.full_like(self.offsets, -np.inf), np.zeros(len(self.names))
            n = self.filters.shape[1]
            for start in range(0, len(numbers), _BLOCK):
                block = self.rows[numbers[start : start + _BLOCK + _PAD]]
                likely += block[:_BLOCK, n:].sum(axis=0)
                missing = min(_PAD, _BLOCK + _PAD - len(block))
                parts = block[:, :n]
                if missing:
                    parts = np.concatenate([parts, np.zeros((missing, n), np.float32)])
                np.maximum(pooled, responses(parts).max(axis=0), out=pooled)
            cut = self.cuts[int(likely.argmax())] if self.names else self.cuts[-1]
        return float(np.maximum(pooled + self.offsets, 0) @ self.out) + self.bias, cut

    def raws(self, texts: list[bytes]) -> list[tuple[float, float]]:
        """Raw score and threshold of each text."""
        split = [words(text) for text in texts]
        self.learn(set().union(*split) if split else set())
        number = self.known.__getitem__
        return [self.raw(np.fromiter(map(number, some), np.int32, len(some))) for some in split]

    def score(self, texts: list[bytes]) -> list[float]:
        relative = [raw - cut for raw, cut in self.raws(texts)]
        return (1 / (1 + np.exp(-np.clip(relative, -500, 500)))).tolist()


def judged() -> Column:
    """Labelled rows that thresholds come from; weights come from all others."""
    return F.pmod(F.xxhash64("doc_id", F.lit("threshold")), F.lit(5)) == 0


def _labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """Labelled rows that are not held out, by the round (`part`) that they are in, and
    about how many are trained on. Part 0 is judged."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(5, 0))
    same = F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")
    known = written(known.select(same, F.col("toxic").cast("int").alias("label")).distinct(), "toxicity-labels")
    n = known.where(~judged()).count()
    place = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)).cast("int")
    part, end = F.lit(1), ROWS_PER_TASK
    while end < n:
        part = part + (F.col("place") >= F.lit(int((1 << 30) * end / n))).cast("int")
        end *= 5
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    own = may_be(own, "doc_id", known.select("doc_id")).where(MAY_BE).drop(MAY_BE)
    rows = own.join(known.hint("merge"), "doc_id").withColumn("place", place)  # nothing broadcast
    rows = rows.withColumn("part", F.when(judged(), 0).otherwise(part))
    return written(rows.drop("doc_id"), "toxicity-rows", by="part"), n


def _balance(cells: dict[tuple, int]) -> dict[tuple, float]:
    """The weight in the loss of rows of each label and language, one in the mean.

    A label's languages share as many rows as the scarcer label has; a row of a cell
    with more than its share counts so much less.
    """
    of = {label: [n for (own, _), n in cells.items() if own == label] for label in (0, 1)}
    scarce = min(sum(own) for own in of.values())
    share = {label: scarce / max(1, len(own)) for label, own in of.items()}
    weight = {cell: min(1.0, max(1.0, share[cell[0]]) / n) for cell, n in cells.items()}
    mean = sum(weight[cell] * n for cell, n in cells.items()) / sum(cells.values())
    return {cell: x / mean for cell, x in weight.items()}


def train(docs: DataFrame, labels: DataFrame, seed: int = 13) -> Scorer | None:
    """Fit on all labelled rows that are not held out; None without rows of both labels."""
    with steps(docs.sparkSession):
        rows, n = _labelled(docs, labels)
        found = rows.groupBy("label", "lang", "part").agg(F.count(F.lit(1)).alias("n")).collect()
        cells: dict[tuple, int] = {}
        for row in found:
            cells[row["label"], row["lang"]] = cells.get((row["label"], row["lang"]), 0) + row["n"]
        if len({label for label, _ in cells}) < 2:
            return None
        names = sorted({lang for _, lang in cells if lang is not None})
        model, weight = Weights(np.random.default_rng(seed)), _balance(cells)
        epochs = min(EPOCHS, max(1, ceil(VISITS / max(1, n))))
        often = _count(rows.where("part = 0"), names) if names else np.zeros((BUCKETS, 0))
        for part in sorted({row["part"] for row in found} - {0}):
            size = sum(row["n"] for row in found if row["part"] == part)
            own = rows.where(F.col("part") == part)
            model, more = _round(own, model, names, weight, epochs, ceil(size / ROWS_PER_TASK))
            often = often + more
        likelihood = np.log((often + 1) / (often + 1).sum(axis=0)).astype(np.float32)
        scorer = Scorer(model, names, likelihood)

        def enough(lang: str | None = None) -> bool:
            n = {0: 0, 1: 0}
            for row in found:
                if row["part"] == 0 and lang in (None, row["lang"]):
                    n[row["label"]] += row["n"]
            return min(n.values()) >= FEWEST_TO_CALIBRATE

        some = rows.where("part = 0") if enough() else rows
        cuts = thresholds(some.select("lang", "label", _raw(F.col("text"), scorer).alias("raw")), names)
        scorer.cuts = [cuts[i] if enough() and enough(name) else cuts[-1] for i, name in enumerate(names)]
        scorer.cuts.append(cuts[-1])
        return scorer


def _raw(text: Column, scorer: Scorer) -> Column:
    """The raw score of a text column."""

    @F.arrow_udf("double")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            scores = [raw for texts in batches(column) for raw, _ in scorer.raws(texts)]
            yield pa.array(scores, pa.float64())

    return run(text)


def toxicity(text: Column, scorer: Scorer | None) -> Column:
    """A struct of score and predicted label of a text column."""

    @F.arrow_udf("score double, predicted int")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = {"score": pa.float64(), "predicted": pa.int32()}
        for column in columns:
            scores = [0.0] * len(column)
            if scorer is not None:
                scores = [x for texts in batches(column) for x in scorer.score(texts)]
            accepted = [int(score >= ACCEPT) for score in scores]
            yield struct_array({"score": scores, "predicted": accepted}, kinds)

    return run(F.coalesce(text, F.lit("")))


def predict(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    found = docs.select(
        "doc_id", held_out(5, 0).alias("held_out"), toxicity(F.col("text"), scorer).alias("found")
    )
    return found.select("doc_id", "held_out", "found.*")
