"""Language-model scores by a hashed maximum-entropy model.

Tokens are runs without ASCII white space, A-Z in lower case, and one end per
text. The probability of a token is that of its class given the tokens before,
times that of the token in its class: a softmax over 32 classes and one over 32
members. Features of the class are the hashed last token, the one before it (a
skip of one), and both as a trigram; the feature of the member is its class with
the last token. Weights start at zero, on top of the logarithms of the classes'
and members' shares, which make the model without features the unigram model.
Classes go by word ending. Members are the
frequent words of a class; the last member stands for all others, which share
its probability by their count plus one, with one more for what is unknown.

Counts cover all training rows. Words of the commonest 50,000 are looked up in
the worker that has the text, all others in a join on the word, so that no key
of the join is hot and nothing that grows is broadcast. Weights are trained in
three rounds over disjoint parts of the training rows, each row used once:
every task takes gradient steps over its rows, and the tasks' weights are
averaged, row by row of the weight table, by how often each met that row.

A null text is empty and has its end only; bytes that are no UTF-8 are read as
the replacement character. Rows with a null id are scored, and never learnt from.
Repeated rows are scored each. Words of equal count are common in their own order.
Texts of any length are read whole. Without a row to learn from, all words are
unknown; an empty table gives an empty one. Extra columns are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import ceil, log10, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import batches, held_out, struct_array, utf8, written

END = "\n"  # no word holds a line break
WIDTH = 32  # classes, and members of a class
COMMON_WORDS = 50_000
ATOMS = 2000  # words that are features themselves; others stand as their class
BUCKETS = 1 << 14
ROWS = 2 * BUCKETS  # of the weights: class features, then member features
BLOCK = 1024  # rows of the weight table that are averaged together
STEP_TOKENS = 4096
RATE = 0.15
PARTS = ((0, 1), (1, 4), (4, 16))  # sixteenths of the training rows in each round
FLUSH_WORDS = 500_000
REMEMBERED_WORDS = 200_000
_TRIM = b".,;:!?*&$%#|"


def ending(word: bytes) -> bytes:
    return word.rstrip(_TRIM)[-2:]


def _mix(x: np.ndarray, kind: int) -> np.ndarray:
    """Bucket of a feature, given as a number below 2^32, of one kind."""
    x = (x + np.uint32(kind * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x & np.uint32(BUCKETS - 1)


class Words(dict):
    """Number of each common word; any other word has the number of its class,
    which is remembered for the first of them."""

    def __init__(self, common: list[bytes], classes: dict[bytes, int]):
        super().__init__((word, i) for i, word in enumerate(common))
        self.common, self.classes = common, classes

    def __missing__(self, word: bytes) -> int:
        number = len(self.common) + self.classes.get(ending(word), WIDTH - 1)
        if len(self) < REMEMBERED_WORDS:
            self[word] = number
        return number

    def __reduce__(self):
        return Words, (self.common, self.classes)


@dataclass
class Lexicon:
    """The common words with their counts, their classes and members.

    Arrays are by word number, and have an entry per class after the words.
    """

    common: list[bytes]
    counts: np.ndarray
    words: Words = field(init=False)
    class_of: np.ndarray = field(init=False)
    member_of: np.ndarray = field(init=False)
    atom_of: np.ndarray = field(init=False)
    shares: np.ndarray | None = None  # log share of each member in its class; last row: of classes

    def __post_init__(self):
        mass: Counter = Counter()
        for word, n in zip(self.common, self.counts.tolist(), strict=True):
            mass[ending(word)] += n
        largest = sorted(mass, key=lambda e: (-mass[e], e))[: WIDTH - 1]
        classes = {e: i for i, e in enumerate(largest)}
        self.words = Words(self.common, classes)
        n = len(self.common)
        own = [classes.get(ending(word), WIDTH - 1) for word in self.common]
        self.class_of = np.array([*own, *range(WIDTH)], np.int64)
        self.member_of = np.full(n + WIDTH, WIDTH - 1, np.int64)
        filled = [0] * WIDTH
        for i, c in enumerate(own):
            if filled[c] < WIDTH - 1:
                self.member_of[i] = filled[c]
                filled[c] += 1
        self.atom_of = np.where(
            np.arange(n + WIDTH) < min(n, ATOMS), np.arange(n + WIDTH), ATOMS + self.class_of
        )

    def numbers(self, words: list[bytes]) -> np.ndarray:
        end = self.words[END.encode()]
        found = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        return np.append(found, end)

    def contexts(self, numbers: np.ndarray, starts: np.ndarray):
        """Feature rows of each token's class (without bias) and member."""
        atoms = self.atom_of[numbers].astype(np.uint32)
        start = np.uint32(ATOMS + WIDTH)
        last, before = np.full(len(atoms), start), np.full(len(atoms), start)
        last[1:], before[2:] = atoms[:-1], atoms[:-2]
        last[starts] = start
        before[starts] = start
        second = starts + 1
        before[second[second < len(atoms)]] = start
        classes = self.class_of[numbers]
        rows = np.stack(
            [_mix(last, 1), _mix(before, 2), _mix(last * np.uint32(4096) + before, 3)]
        )
        inside = _mix(last * np.uint32(64) + classes.astype(np.uint32), 4) + np.uint32(BUCKETS)
        return rows, inside, classes

    def set_shares(self, rest: np.ndarray) -> None:
        """Shares from the members' counts and the mass of each class's others."""
        mass = np.full((WIDTH, WIDTH), 0.5)
        n = len(self.common)
        own = np.flatnonzero(self.member_of[:n] < WIDTH - 1)
        mass[self.class_of[own], self.member_of[own]] = self.counts[own] + 1
        mass[:, WIDTH - 1] = rest
        classes = mass.sum(axis=1)
        rows = [np.log(mass / classes[:, None]), np.log(classes / classes.sum())[None, :]]
        self.shares = np.concatenate(rows).astype(np.float32)


_ONES = np.ones(WIDTH, np.float32)


def _exponentials(weights: np.ndarray, start: np.ndarray, rows: Iterable[np.ndarray]):
    """Exponentials of the logits, up to a factor, and their sum per token."""
    rows = iter(rows)
    logits = weights[next(rows)]
    for row in rows:
        logits += weights[row]
    logits += start
    logits -= logits.max()
    np.exp(logits, out=logits)
    return logits, np.maximum(logits @ _ONES, np.float32(1e-30))


def log_probabilities(lexicon: Lexicon, weights: np.ndarray, numbers, starts) -> np.ndarray:
    """log10 of the probability of each token's class and member."""
    out = np.empty(len(numbers))
    rows, inside, classes = lexicon.contexts(numbers, starts)
    for at in range(0, len(numbers), STEP_TOKENS):
        cut = slice(at, at + STEP_TOKENS)
        own, place = classes[cut], np.arange(len(classes[cut]))
        upper, total = _exponentials(weights, lexicon.shares[WIDTH], rows[:, cut])
        out[cut] = np.log10(upper[place, own] / total + 1e-12)
        lower, total = _exponentials(weights, lexicon.shares[own], inside[None, cut])
        out[cut] += np.log10(lower[place, lexicon.member_of[numbers[cut]]] / total + 1e-12)
    return out


class Trainer:
    """Gradient steps over the rows of one task, with a step size per row."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray, squares: np.ndarray):
        self.lexicon, self.weights, self.squares = lexicon, weights.copy(), squares.copy()
        self.met = np.zeros(ROWS)

    def _descend(self, start: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> None:
        error, total = _exponentials(self.weights, start, rows)
        error /= total[:, None]
        error[np.arange(len(wanted)), wanted] -= 1
        for row in rows.astype(np.uint16):
            order = np.argsort(row, kind="stable")
            in_order = row[order]
            starts = np.flatnonzero(np.diff(in_order.astype(np.int32), prepend=-1))
            used = in_order[starts]
            step = np.add.reduceat(error[order], starts, axis=0)
            self.met[used] += np.diff(starts, append=len(row))
            self.squares[used] += np.einsum("ij,ij->i", step, step) / WIDTH
            step *= (RATE / np.sqrt(self.squares[used])).astype(np.float32)[:, None]
            self.weights[used] -= step

    def learn(self, numbers: np.ndarray, starts: np.ndarray) -> None:
        rows, inside, classes = self.lexicon.contexts(numbers, starts)
        members = self.lexicon.member_of[numbers]
        for at in range(0, len(numbers), STEP_TOKENS):
            cut = slice(at, at + STEP_TOKENS)
            shares, own = self.lexicon.shares, classes[cut]
            self._descend(shares[WIDTH], rows[:, cut], own)
            self._descend(shares[own], inside[None, cut], members[cut])


def _numbered(lexicon: Lexicon, texts: list[bytes]):
    """Words of each text, and all numbers with the place where each text starts."""
    split = [utf8(text).lower().split() for text in texts]
    numbers = [lexicon.numbers(words) for words in split]
    starts = np.cumsum([0, *map(len, numbers)])[:-1]
    return split, np.concatenate(numbers), starts


def _count_words(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counted: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        words = pa.array(list(counted.keys()), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_pydict(
            {"word": words, "n": pa.array(list(counted.values()), pa.int64())}
        )

    for batch in rows:
        for run in batches(batch.column("text")):
            for text in run:
                counted.update(utf8(text).lower().split())
            counted[END.encode()] += len(run)
            if len(counted) > FLUSH_WORDS:
                yield flushed()
                counted.clear()
    yield flushed()


def word_counts(docs: DataFrame) -> DataFrame:
    """Count of each word of the training rows, the end included."""
    found = docs.where(~held_out(7)).select("text")
    found = found.mapInArrow(_count_words, "word string, n bigint")
    return written(found.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def lexicon_of(counts: DataFrame, most: int = COMMON_WORDS) -> Lexicon:
    rows = counts.orderBy(F.desc("n"), "word").limit(most).toArrow()
    words = [word.encode() for word in rows.column("word").to_pylist()]
    return Lexicon(words, rows.column("n").to_numpy())


def rest_mass(counts: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Per class, what its words that are no members share: counts plus one
    each, and one for what is unknown."""

    def sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WIDTH, np.int64)
        for batch in rows:
            words = batch.column("word").cast(pa.binary()).to_pylist()
            numbers = np.fromiter(map(lexicon.words.__getitem__, words), np.int64, len(words))
            others = lexicon.member_of[numbers] == WIDTH - 1
            shares = batch.column("n").to_numpy(zero_copy_only=False) + 1
            np.add.at(total, lexicon.class_of[numbers[others]], shares[others])
        yield pa.RecordBatch.from_pydict(
            {"class": pa.array(range(WIDTH), pa.int32()), "share": pa.array(total)}
        )

    found = counts.mapInArrow(sums, "class int, share bigint")
    mass = np.ones(WIDTH)
    for row in found.groupBy("class").agg(F.sum("share").alias("share")).collect():
        mass[row["class"]] += row["share"]
    return mass


def _weighted(rows: Iterable[dict]):
    """Sums over the tasks' blocks of one group."""
    total = None
    for row in rows:
        got = [np.frombuffer(row[name], np.float64) for name in ("met", "weights", "squares")]
        total = got if total is None else [a + b for a, b in zip(total, got, strict=True)]
    return total


_BLOCK_TYPES = "block int, slot int, met binary, weights binary, squares binary"


def _add_blocks(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    met, weights, squares = _weighted(rows)
    return pa.table(
        {
            "block": pa.array([rows[0]["block"]], pa.int32()),
            "slot": pa.array([0], pa.int32()),
            "met": [met.tobytes()],
            "weights": [weights.tobytes()],
            "squares": [squares.tobytes()],
        }
    )


def train(docs: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """The weights after all rounds, as one table of `ROWS` by `WIDTH` numbers.

    A task hands over one table, however many rows it read. Tables are summed
    block by block, in groups of about the root of the number of tasks.
    """
    spark = docs.sparkSession
    weights = np.zeros((ROWS, WIDTH), np.float32)
    squares = np.full(ROWS, 1.0, np.float64)
    tasks = 2 * spark.sparkContext.defaultParallelism
    slots = ceil(sqrt(tasks))
    part = F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(16))
    for first, last in PARTS:

        def work(rows: Iterator[pa.RecordBatch], weights=weights, squares=squares):
            trainer = Trainer(lexicon, weights, squares)
            for batch in rows:
                for texts in batches(batch.column("text")):
                    _, numbers, starts = _numbered(lexicon, texts)
                    trainer.learn(numbers, starts)
            slot = TaskContext.get().partitionId() % slots
            for at in range(0, ROWS, BLOCK):
                met = trainer.met[at : at + BLOCK]
                if met.any():
                    yield pa.RecordBatch.from_pydict(
                        {
                            "block": pa.array([at // BLOCK], pa.int32()),
                            "slot": pa.array([slot], pa.int32()),
                            "met": [met.tobytes()],
                            "weights": [
                                (trainer.weights[at : at + BLOCK] * met[:, None]).tobytes()
                            ],
                            "squares": [(trainer.squares[at : at + BLOCK] * met).tobytes()],
                        }
                    )

        chosen = docs.where(~held_out(7)).where((part >= first) & (part < last)).select("text")
        tables = chosen.coalesce(tasks).mapInArrow(work, _BLOCK_TYPES)
        summed = tables.groupBy("block", "slot").applyInArrow(_add_blocks, _BLOCK_TYPES)
        summed = summed.groupBy("block").applyInArrow(_add_blocks, _BLOCK_TYPES)
        weights, squares = weights.copy(), squares.copy()
        for row in summed.toLocalIterator():
            met = np.frombuffer(row["met"], np.float64)
            at = row["block"] * BLOCK + np.flatnonzero(met)
            met, used = met[met > 0], met > 0
            mixed = np.frombuffer(row["weights"], np.float64).reshape(-1, WIDTH)[used]
            weights[at] = mixed / met[:, None]
            squares[at] = np.frombuffer(row["squares"], np.float64)[used] / met
    return weights


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    rest: np.ndarray  # log10 of the mass of each class's other words
    n_tokens: int
    n_words: int


def fit(docs: DataFrame, counts: DataFrame) -> Model:
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    lexicon = lexicon_of(counts)
    rest = rest_mass(counts, lexicon)
    lexicon.set_shares(rest)
    return Model(lexicon, train(docs, lexicon), np.log10(rest), total["n"] or 0, total["v"])


_SCORED = {
    "n_tokens": pa.int64(),
    "known": pa.int64(),
    "logs": pa.float64(),
    "model": pa.float64(),
}
_SCORED_TYPES = (
    "n_tokens bigint, known bigint, logs double, model double, "
    "others array<struct<word: string, times: int>>"
)


def _score(texts: list[bytes], model: Model):
    """Sums over each text's tokens, and its words that are not common.

    `logs` is the sum of log10(count + 1) over common words, `model` that of all
    logarithms of the model but for log10(count + 1) of the other words.
    """
    lexicon = model.lexicon
    split, numbers, starts = _numbered(lexicon, texts)
    n = len(lexicon.common)
    common = numbers < n
    log_count = np.zeros(n + WIDTH)
    log_count[:n] = np.log10(lexicon.counts + 1.0)
    logs = log_count[numbers]
    value = log_probabilities(lexicon, model.weights, numbers, starts)
    rest = lexicon.member_of[numbers] == WIDTH - 1
    value[rest] += logs[rest] - model.rest[lexicon.class_of[numbers[rest]]]
    lengths = np.diff(np.append(starts, len(numbers)))
    sums = {
        "n_tokens": lengths,
        "known": np.add.reduceat(common.astype(np.int64), starts),
        "logs": np.add.reduceat(logs, starts),
        "model": np.add.reduceat(value, starts),
    }
    others = []
    for words, start in zip(split, starts, strict=True):
        rare = np.flatnonzero(~common[start : start + len(words)]).tolist()
        others.append(Counter([words[i] for i in rare]))
    return sums, others


def scores(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Per document: tokens, known tokens, and both log10 probabilities."""

    @F.arrow_udf(_SCORED_TYPES)
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            totals = {name: [] for name in _SCORED}
            words, times, ends = [], [], [0]
            for texts in batches(column):
                sums, others = _score(texts, model)
                for name, values in sums.items():
                    totals[name] += values.tolist()
                for found in others:
                    words += found.keys()
                    times += found.values()
                    ends.append(len(words))
            pairs = pa.StructArray.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int32())],
                names=["word", "times"],
            )
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
            plain = struct_array(totals, _SCORED)
            yield pa.StructArray.from_arrays(
                [*plain.flatten(), lists], names=[*_SCORED, "others"]
            )

    found = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        held_out(7).alias("held_out"),
        run(F.coalesce("text", F.lit(""))).alias("found"),
    )
    found = written(found.select("row", "doc_id", "held_out", "found.*"), "lm-scores")
    other = found.select("row", F.explode("others").alias("x")).select("row", "x.word", "x.times")
    joined = other.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("more_known"),
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"),
    )
    scale = log10(model.n_tokens + model.n_words + 1)
    more = F.coalesce("more_logs", F.lit(0.0))
    return found.join(joined, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """Count, train and score over one table of documents."""
    counts = word_counts(docs)
    return scores(docs, fit(docs, counts), counts)
