"""Language identification as inference of a mixture of languages.

A language is a distribution over hashed character trigrams, counted over all
labelled documents that are not held out. A document is a mixture: each of its
words comes from one of its languages, with the likelihood of the word's
trigrams. Expectation-maximisation gives the proportions of the best one, two
and three languages, and the set with the greatest penalised likelihood (half
the logarithm of the word count per language) is kept. The predicted language
has the largest proportion in it, the score is that proportion.

A text that is null or without a letter is `und` with score 0, as is every text
if nothing is labelled. Ties go to the language first in alphabetical order.
Only text and language are read; repeated rows are predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import batches, held_out, struct_array

BUCKETS = 1 << 15
SMOOTHING = 0.5
ROUNDS = 12
CACHED_WORDS = 120_000
NONE = "und"
_LETTERS = regex.compile(r"\p{L}+")
_PRIMES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around each letter, and where each word starts.

    A word is runs of letters between line breaks, which mark its ends.
    """
    text = "\n" + "\n".join(words) + "\n"
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    mixed = codes[:-2] * np.uint64(_PRIMES[0])
    mixed ^= codes[1:-1] * np.uint64(_PRIMES[1]) + np.uint64(1)
    mixed ^= (codes[2:] * np.uint64(_PRIMES[2])) << np.uint64(3)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    buckets = (mixed >> np.uint64(49)).astype(np.int64)  # the upper 15 bits
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    buckets[codes[1:-1] == 10] = -1  # around a line break there is no trigram
    return buckets, starts


def letters_of(word: str) -> str:
    """The runs of letters in a word between spaces, with line breaks between."""
    lowered = word.lower()
    return lowered if lowered.isalpha() else "\n".join(_LETTERS.findall(lowered))


def count_trigrams(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language of one partition, from columns lang and text."""
    totals: dict[str, np.ndarray] = {}
    for batch in rows:
        languages = batch.column("lang").to_pylist()
        at = 0
        for run in batches(batch.column("text")):
            words: dict[str, dict[str, int]] = {}
            for text in run:
                known = words.setdefault(languages[at], {})
                at += 1
                for word in text.decode("utf-8", "replace").split():
                    known[word] = known.get(word, 0) + 1
            for language, counted in words.items():
                if not counted:
                    continue
                spelled = [letters_of(word) for word in counted]
                buckets, starts = trigrams(spelled)
                each = np.repeat(
                    np.fromiter(counted.values(), np.int64, len(counted)),
                    np.diff(np.append(starts, len(buckets))),
                )
                there = buckets >= 0
                found = np.bincount(buckets[there], each[there], BUCKETS).astype(np.int64)
                totals[language] = totals.get(language, 0) + found
    for language, found in totals.items():
        bucket = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([language] * len(bucket), pa.string()),
                "bucket": pa.array(bucket, pa.int32()),
                "n": pa.array(found[bucket], pa.int64()),
            }
        )


class Mixture:
    """Log-likelihoods of trigrams per language, and the inference over them."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=0) + SMOOTHING * BUCKETS
        self.table = np.log((counts + SMOOTHING) / total).astype(np.float32)
        self.known: dict[str, int] = {}
        self.rows = np.empty((0, len(languages)), np.float32)

    def __getstate__(self):
        return {"languages": self.languages, "table": self.table}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.known, self.rows = {}, np.empty((0, len(self.languages)), np.float32)

    def learn(self, words: set[str]) -> None:
        """Log-likelihoods of words not met before; row 0 is for no letters."""
        if not self.known or len(self.known) + len(words) > CACHED_WORDS:
            self.known = {}
            self.rows = np.zeros((1, len(self.languages)), np.float32)
        new = list(words - self.known.keys())
        spelled = [letters_of(word) for word in new]
        self.known.update((word, 0) for word, x in zip(new, spelled, strict=True) if not x)
        pairs = [(word, x) for word, x in zip(new, spelled, strict=True) if x]
        if not pairs:
            return
        buckets, starts = trigrams([x for _, x in pairs])
        each = self.table[buckets]
        each[buckets < 0] = 0
        base = len(self.rows)
        self.rows = np.concatenate([self.rows, np.add.reduceat(each, starts, axis=0)])
        self.known.update((word, base + i) for i, (word, _) in enumerate(pairs))

    def _proportions(self, likelihood, starts, lengths, share):
        """Expectation-maximisation from given shares; zero shares stay zero.
        Also the log-likelihood under the shares of the last round but one."""
        ones = np.ones(likelihood.shape[1], np.float32)
        for _ in range(ROUNDS):
            weight = likelihood * np.repeat(share, lengths, axis=0)
            total = weight @ ones
            weight /= total[:, None]
            share = np.add.reduceat(weight, starts, axis=0) / lengths[:, None].astype(np.float32)
        return share, np.add.reduceat(np.log(total), starts, dtype=np.float64)

    def _in_sets(self, likelihood, starts, lengths, some, member):
        """Fits and proportions of some documents, each in its own set of languages."""
        own = lengths[some]
        firsts = np.cumsum(own) - own
        inside = np.arange(own.sum()) + np.repeat(starts[some] - firsts, own)
        even = member / member.sum(axis=1, keepdims=True)
        share, fit = self._proportions(likelihood[inside], firsts, own, even.astype(np.float32))
        return fit, share

    def _sets(self, likelihood, lengths, first, most, least, penalty):
        """Best set of two or more languages for documents whose penalised value
        exceeds `least` in it: shares, all zero if there is none.

        `first` is each document's best single language, and `most` its fit in all
        languages together, which no set exceeds; a document leaves when that tells
        that no larger set can win.
        """
        n, wide = len(lengths), likelihood.shape[1]
        starts = np.cumsum(lengths) - lengths
        best, best_share = least.copy(), np.zeros((n, wide), np.float32)
        member = np.arange(wide) == first[:, None]
        fit, share = np.full(n, -np.inf), np.zeros((n, wide), np.float32)
        found = member.copy()

        def offer(some, candidate):
            """Take over candidates that fit better than what the documents have found."""
            if not len(some):
                return False
            fits, shares = self._in_sets(likelihood, starts, lengths, some, candidate)
            better = fits > fit[some] + 1e-6
            at = some[better]
            fit[at], share[at], found[at] = fits[better], shares[better], candidate[better]
            return bool(len(at))

        for size in range(2, wide + 1):
            here = np.flatnonzero(most - size * penalty > best)
            if not len(here):
                break
            fit[:] = -np.inf
            for more in range(wide):
                some = here[~member[here, more]]
                offer(some, member[some] | (np.arange(wide) == more))
            moved = size < wide
            while moved:
                moved = False
                for out in range(wide):
                    for into in range(wide):
                        some = here[found[here, out] & ~found[here, into]]
                        candidate = found[some]
                        candidate[:, out], candidate[:, into] = False, True
                        moved |= offer(some, candidate)
            member[here] = found[here]
            value = fit[here] - size * penalty[here]
            better = here[value > best[here]]
            best_share[better], best[better] = share[better], fit[better] - size * penalty[better]
        return best_share

    def infer(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Predicted language and its proportion for each text."""
        split = [text.split() for text in texts]
        self.learn(set().union(*split) if split else set())
        index = [np.fromiter(map(self.known.__getitem__, w), np.int64, len(w)) for w in split]
        index = [x[x > 0] for x in index]
        names, scores = [NONE] * len(texts), [0.0] * len(texts)
        there = [i for i, x in enumerate(index) if len(x)]
        if not there or not self.languages:
            return names, scores
        lengths = np.array([len(index[i]) for i in there])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        logs = self.rows[np.concatenate([index[i] for i in there])]
        top = logs.max(axis=1)
        likelihood = np.exp(np.maximum(logs - top[:, None], -60.0))
        alone = np.add.reduceat(logs, starts, axis=0, dtype=np.float64)
        tops = np.add.reduceat(top, starts, dtype=np.float64)
        penalty = 0.5 * np.log(lengths + 1.0)
        n, wide = alone.shape
        best_share = np.zeros((n, wide), np.float32)
        best_share[np.arange(n), alone.argmax(axis=1)] = 1.0
        least = alone.max(axis=1) - tops - penalty
        everyone = np.full((n, wide), 1.0 / wide, np.float32)
        _, fit = self._proportions(likelihood, starts, lengths, everyone)
        # No set fits better than all languages together, which bounds its value.
        mixed = np.flatnonzero(fit - 2 * penalty > least)
        if len(mixed):
            inside = np.concatenate([np.arange(starts[i], starts[i] + lengths[i]) for i in mixed])
            first = alone[mixed].argmax(axis=1)
            found = self._sets(
                likelihood[inside], lengths[mixed], first, fit[mixed], least[mixed], penalty[mixed]
            )
            better = found.any(axis=1)
            best_share[mixed[better]] = found[better]
        chosen = best_share.argmax(axis=1)
        for i, language, score in zip(there, chosen, best_share.max(axis=1), strict=True):
            names[i], scores[i] = self.languages[language], float(min(1.0, score))
        return names, scores


def fit(docs: DataFrame) -> Mixture:
    """Count trigrams per language over all labelled rows of `docs`.

    The driver gets one number per language and trigram bucket in use: 32,768
    per language at most, however large the corpus.
    """
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    found = labelled.mapInArrow(count_trigrams, "lang string, bucket int, n bigint")
    rows = found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = rows.column("lang").to_pylist()
    languages = sorted(set(names))
    counts = np.zeros((BUCKETS, len(languages)))
    columns = {language: i for i, language in enumerate(languages)}
    at = np.array([columns[x] for x in names], np.int64)
    counts[rows.column("bucket").to_numpy(), at] = rows.column("n").to_numpy()
    return Mixture(languages, counts)


def language(text: Column, model: Mixture) -> Column:
    """A struct of predicted language and score of a text column."""

    @F.arrow_udf("lang_pred string, score double")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = {"lang_pred": pa.string(), "score": pa.float64()}
        for column in columns:
            names, scores = [], []
            for batch in batches(column):
                got = model.infer([t.decode("utf-8", "replace") for t in batch])
                names += got[0]
                scores += got[1]
            yield struct_array({"lang_pred": names, "score": scores}, kinds)

    return run(F.coalesce(text, F.lit("")))


def train(docs: DataFrame) -> Mixture:
    """The model from the rows of `docs` that are not held out."""
    return fit(docs.where(~held_out(4)))


def predict(docs: DataFrame, model: Mixture) -> DataFrame:
    found = docs.select(
        "doc_id", held_out(4).alias("held_out"), language(F.col("text"), model).alias("found")
    )
    return found.select("doc_id", "held_out", "found.*")
