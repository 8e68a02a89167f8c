"""Quality classifier by supervised subword embeddings.

A token (a run without white space, as it is written) has the mean of the
vectors of its hashed whole and its hashed character n-grams, ends included. A
token that repeats the one before it adds the vector of that word pair, in
which the repetition stands for the word. A document is the mean over its
tokens and pairs; a softmax over the two labels follows. Vectors and softmax
are trained by stochastic gradient descent with a step size per bucket.

Training takes a sample of labelled rows of at most about `most` documents
(3,000), spread evenly by hash, so the one task that trains is bounded; scoring
reads every whole text. Since averaging is linear, a trained model scores with
one number per bucket: what its vector adds to the difference of the logits.

A text that is null or without tokens has the score of the bias alone. Without
labels every score is 0.5. Ids and labels that are null are not learnt from.
Repeated rows are scored each; a document with several labels is an example
with each of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import batches, held_out, struct_array

BUCKETS = 1 << 16
DIMENSIONS = 16
LENGTHS = (3, 4)  # of character n-grams
MOST_EXAMPLES = 3000
EPOCHS = 6
MINIBATCH = 32
RATE = 0.3
ACCEPT = 0.7
CACHED_WORDS = 150_000
PAIR = 0  # the bucket of repeated words, used by nothing else
_END = 10  # a line break stands at both ends of a token


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _bucket(x: np.ndarray) -> np.ndarray:
    return (_mix(x) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' wholes and n-grams, and the word each belongs to."""
    text = "\n" + "\n".join(words) + "\n"
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = codes == _END
    owner = np.cumsum(ends) - 1
    starts = np.flatnonzero(ends)[:-1]
    place = (np.arange(len(codes)) - np.append(starts, len(codes))[owner]).astype(np.uint64)
    mixed = _mix(codes * np.uint64(0x10001) + (place << np.uint64(40)))
    whole = np.add.reduceat(mixed[:-1], starts)  # the last break belongs to no word
    found, owners = [_bucket(whole)], [np.arange(len(words))]
    for n in LENGTHS:
        last = len(codes) - n + 1
        if last <= 0:
            continue
        key = np.full(last, n, np.uint64)
        inside = np.ones(last, bool)
        for i in range(n):
            key = _mix(key * np.uint64(1_000_003) + codes[i : i + last])
            if 0 < i < n - 1:
                inside &= ~ends[i : i + last]
        at = np.flatnonzero(inside)
        found.append(_bucket(key[at]))
        owners.append(owner[at + 1])
    return np.concatenate(found), np.concatenate(owners)


def tokens(text: bytes) -> list[str]:
    return text.decode("utf-8", "replace").split()


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one document and their weights, which are one in total."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    distinct, count = np.unique(np.array(words, object), return_counts=True)
    bucket, owner = subwords(distinct.tolist())
    pairs = sum(map(eq, words, words[1:]))
    units = len(words) + pairs
    weight = (count / np.bincount(owner, minlength=len(distinct)) / units)[owner]
    total = np.bincount(bucket, weight, BUCKETS)
    total[PAIR] = pairs / units
    used = np.flatnonzero(total)
    return used.astype(np.int32), total[used].astype(np.float32)


def _train(rows: Iterator[pa.RecordBatch], seed: int = 7) -> Iterator[pa.RecordBatch]:
    """One row with the trained model from columns text and label."""
    examples, labels = [], []
    for batch in rows:
        labels += batch.column("label").to_pylist()
        for run in batches(batch.column("text")):
            examples += [features(tokens(text)) for text in run]
    score, bias = _descend(examples, np.array(labels, np.int64), np.random.default_rng(seed))
    yield pa.RecordBatch.from_pydict({"table": [score.tobytes()], "bias": [float(bias)]})


def _sums(rows: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows per owner; rows come in the order of their owners."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    if len(rows):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[starts]] = np.add.reduceat(rows, starts, axis=0)
    return out


def _descend(examples, labels: np.ndarray, random: np.random.Generator):
    """What each bucket adds to the difference of the logits, and the bias."""
    if not len(labels):
        return np.zeros(BUCKETS, np.float32), 0.0
    vectors = random.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = random.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = np.full((BUCKETS, 1), 1e-6, np.float32)
    seen_softmax, seen_bias = np.full_like(softmax, 1e-6), np.full_like(bias, 1e-6)
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for start in range(0, len(order), MINIBATCH):
            chosen = order[start : start + MINIBATCH]
            lengths = np.array([len(examples[i][0]) for i in chosen])
            buckets = np.concatenate([examples[i][0] for i in chosen])
            weights = np.concatenate([examples[i][1] for i in chosen])[:, None]
            owner = np.repeat(np.arange(len(chosen)), lengths)
            hidden = _sums(vectors[buckets] * weights, owner, len(chosen))
            logits = hidden @ softmax + bias
            logits -= logits.max(axis=1, keepdims=True)
            error = np.exp(logits)
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            error /= len(chosen)
            back = error @ softmax.T
            step = hidden.T @ error
            seen_softmax += step**2
            softmax -= RATE * step / np.sqrt(seen_softmax)
            seen_bias += error.sum(axis=0) ** 2
            bias -= RATE * error.sum(axis=0) / np.sqrt(seen_bias)
            moves = back[owner] * weights
            used, group = np.unique(buckets, return_inverse=True)
            in_order = np.argsort(group, kind="stable")
            moves = _sums(moves[in_order], group[in_order], len(used))
            seen[used] += (moves**2).mean(axis=1, keepdims=True)
            vectors[used] -= RATE * moves / np.sqrt(seen[used])
    difference = softmax[:, 1] - softmax[:, 0]
    return (vectors @ difference).astype(np.float32), bias[1] - bias[0]


class Scorer:
    """Scores of texts by a trained table; tokens are remembered for a while."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias
        self.learnt = bool(bias or table.any())  # false without a labelled row
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {"table": self.table, "bias": self.bias, "learnt": self.learnt, "known": {}}

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > CACHED_WORDS:
            self.known = {}
        new = list(words - self.known.keys())
        if new:
            bucket, owner = subwords(new)
            total = np.bincount(owner, self.table[bucket], len(new))
            mean = total / np.bincount(owner, minlength=len(new))
            self.known.update(zip(new, mean.tolist(), strict=True))

    def score(self, texts: list[bytes]) -> list[float]:
        split = [tokens(text) for text in texts]
        self.learn(set().union(*split) if split else set())
        value, pair, logits = self.known.__getitem__, float(self.table[PAIR]), []
        for words in split:
            pairs = sum(map(eq, words, words[1:]))
            units = max(1, len(words) + pairs)
            logits.append((sum(map(value, words)) + pairs * pair) / units + self.bias)
        return (1 / (1 + np.exp(-np.clip(logits, -500, 500)))).tolist()


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_EXAMPLES) -> Scorer:
    """Fit on a sample of the labelled rows that are not held out.

    The sample is drawn by hash of the id at a rate of `most` over the number of
    labelled rows, and cut at twice `most`, which chance can't reach.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(4))
    known = known.select("doc_id", F.col("quality").alias("label"))
    rate = min(1.0, most / max(1, known.count()))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000)) < rate * 1_000_000
    sample = known.where(drawn).join(docs.select("doc_id", "text"), "doc_id").limit(2 * most)
    ordered = sample.select("doc_id", "text", "label").repartition(1)
    ordered = ordered.sortWithinPartitions("doc_id", "label", "text").select("text", "label")
    row = ordered.mapInArrow(_train, "table binary, bias double").first()
    if row is None:
        return Scorer(np.zeros(BUCKETS, np.float32), 0.0)
    return Scorer(np.frombuffer(row["table"], np.float32), row["bias"])


def quality(text: Column, scorer: Scorer) -> Column:
    """A struct of score and predicted label of a text column."""

    @F.arrow_udf("score double, predicted int")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = {"score": pa.float64(), "predicted": pa.int32()}
        for column in columns:
            scores = [x for texts in batches(column) for x in scorer.score(texts)]
            accepted = [int(score >= ACCEPT) for score in scores]
            yield struct_array({"score": scores, "predicted": accepted}, kinds)

    return run(F.coalesce(text, F.lit("")))


def predict(docs: DataFrame, scorer: Scorer) -> DataFrame:
    found = docs.select(
        "doc_id", held_out(4).alias("held_out"), quality(F.col("text"), scorer).alias("found")
    )
    return found.select("doc_id", "held_out", "found.*")
