"""BPE encoding and decoding by a segment tree over the ranks of adjacent pairs.

A leaf of the tree holds the rank of the pair that starts at a symbol, an inner
node the least value below it. A value is rank times width plus place, so the
root is the leftmost pair of lowest rank. A merge changes three leaves (the
merged pair, the one before it, the one that its right symbol began), and their
paths to the root are computed anew: logarithmic work, until the root holds no
pair. Short words go through their trees side by side in arrays, one merge in
every word a round; a long one has a tree of its own.

Pieces of words are encoded once per task while they are remembered; a text is the
sequence of its words' tokens, as white space is dropped before. Null texts are empty,
and an empty text has no tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

from fareloom.llm.common import batches, struct_array, utf8, vocabulary_path

TOKENIZER = "word_bpe_49k.json"
TEXT_BYTES = 2 << 20
CACHED_WORDS = 200_000  # pieces of words that a task keeps
CACHED_OTHERS = 40_000  # words that a task keeps with the pieces they were split into
WIDEST = 64  # symbols of a word that is encoded side by side with others
SIDE_BY_SIDE = 4096  # words whose trees are in memory at once
NO_PAIR = np.iinfo(np.int64).max
_SETTLED = "\u0250"  # the first character behind the Latin letters
_SPACES = b"\t\n\v\f\r "
_WIDE_SPACES = [
    chr(c).encode()
    for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]
_IN_WORD = ~np.isin(np.arange(256), list(_SPACES))  # by byte
_SPECIAL = 0xFF  # a byte that no UTF-8 has
_APOSTROPHE = ord("'")
_LETTER, _NUMBER, _SIGN = range(3)
_LATIN = [chr(c) for c in range(ord(_SETTLED))]
_KIND = np.array(
    [{"L": _LETTER, "N": _NUMBER}.get(category(c)[0], _SIGN) for c in _LATIN], np.uint8
)
_LOWER = np.array([ord(c.lower()[0]) for c in _LATIN], np.uint16)
# Characters whose lower case is not one character of as many bytes.
_CHANGES = np.array(
    [len(c.lower()) > 1 or len(c.lower().encode()) != len(c.encode()) for c in _LATIN]
)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it
    is printable, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(shown))
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """The tables of a byte-level BPE with word ends, read from its file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special = {token.encode(): i for token, i in special.items()}
        tokens = {i: token for token, i in (self.ids | special).items()}
        self.written = pa.array(
            [f"{tokens.get(i, '')} ".encode() for i in range(max(tokens) + 1)], pa.binary()
        )
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.split = Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        self.normalize = Tokenizer.from_file(path).normalizer.normalize_str
        self.splitter = regex.compile(b"|".join(map(regex.escape, self.special)))
        letters = byte_letters()
        self.inner = np.array([self.ids[x] for x in letters], np.int64)
        self.final = np.array([self.ids[x + suffix] for x in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([(self.ids[a] << 20) | self.ids[b] for a, b in merges], np.int64)
        self.merged = np.array([self.ids[a + b] for a, b in merges], np.int64)
        self.by_pair = np.argsort(pairs, kind="stable")
        self.pairs = pairs[self.by_pair]
        self.rank_of = dict(zip(self.pairs.tolist(), self.by_pair.tolist(), strict=True))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it is no merge; a negative symbol is none."""
        pair = (left << 20) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        found = (self.pairs[at] == pair) & (left >= 0) & (right >= 0)
        return np.where(found, self.by_pair[at], -1)


def encode_long(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """One word by a tree of its own."""
    n = len(symbols)
    width = 1 << max(1, (n - 1).bit_length())
    none = int(NO_PAIR)
    rank_of, merged = vocabulary.rank_of, vocabulary.merged
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    symbols, tree = list(symbols), [none] * (2 * width)

    def value(at: int) -> int:
        if after[at] < 0:
            return none
        rank = rank_of.get((symbols[at] << 20) | symbols[after[at]])
        return none if rank is None else rank * width + at

    for at in range(n):
        tree[width + at] = value(at)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    while tree[1] != none:
        rank, at = divmod(tree[1], width)
        right = after[at]
        symbols[at], after[at] = int(merged[rank]), after[right]
        if after[right] >= 0:
            before[after[right]] = at
        symbols[right] = -1
        tree[width + right] = none
        tree[width + at] = value(at)
        changed = [at, right]
        if before[at] >= 0:
            tree[width + before[at]] = value(before[at])
            changed.append(before[at])
        for leaf in changed:
            node = (width + leaf) >> 1
            while node:
                tree[node] = min(tree[2 * node], tree[2 * node + 1])
                node >>= 1
    return [x for x in symbols if x >= 0]


def encode_side_by_side(symbols: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Words of one width, a row each, filled up with -1; rows of the same form."""
    n, width = symbols.shape
    symbols = np.concatenate([symbols, np.full((n, 1), -1, np.int64)], axis=1)
    place = np.arange(width)
    before = np.broadcast_to(place - 1, (n, width)).copy()
    after = np.broadcast_to(place + 1, (n, width)).copy()  # width stands for no symbol
    tree = np.full((n, 2 * width), NO_PAIR, np.int64)
    ranks = vocabulary.ranks(symbols[:, :width], symbols[:, 1:])
    tree[:, width:] = np.where(ranks >= 0, ranks * width + place, NO_PAIR)
    for node in range(width - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
    row = np.flatnonzero(tree[:, 1] != NO_PAIR)
    while len(row):
        rank, at = np.divmod(tree[row, 1], width)
        right = after[row, at]
        beyond = after[row, right]
        symbols[row, at] = vocabulary.merged[rank]
        symbols[row, right] = -1
        after[row, at] = beyond
        inside = beyond < width
        before[row[inside], beyond[inside]] = at[inside]
        prior = before[row, at]
        first = prior < 0
        prior = np.where(first, right, prior)  # no pair before it: the right leaf again
        leaf = np.stack([at, right, prior])
        left = np.stack([symbols[row, at], symbols[row, right], symbols[row, prior]])
        follower = np.stack([symbols[row, beyond], left[1], left[0]])
        got = vocabulary.ranks(left, follower)
        tree[row, width + leaf] = np.where(got >= 0, got * width + leaf, NO_PAIR)
        node = (width + leaf) >> 1
        while node[0, 0]:
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            node >>= 1
        row = row[tree[row, 1] != NO_PAIR]
    return symbols[:, :width]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after the other."""
    ends = np.cumsum(lengths)
    places = np.arange(ends[-1] if len(ends) else 0)
    places += np.repeat(starts - ends + lengths, lengths)
    return places


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Byte strings that lie one after the other."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def parts(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings and where each begins and the last one ends."""
    if not len(found):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = found.buffers()
    at = np.frombuffer(offsets, np.int32)[found.offset : found.offset + len(found) + 1]
    at = at.astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class Tokens:
    """Ids of texts, one text after the other, and the bytes that they decode to."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary):
        self.ids, self.bounds = ids, bounds
        data, offsets = parts(vocabulary.written.take(pa.array(ids)))
        self._data, self._from = memoryview(data), offsets[bounds].tolist()
        self._ids, self._bounds = memoryview(ids).cast("B"), bounds.tolist()

    def __iter__(self) -> Iterator[tuple[memoryview, memoryview]]:
        """Per text: ids (little-endian, 32 bits each) and decoded text in UTF-8."""
        for i in range(len(self._bounds) - 1):
            ids = self._ids[4 * self._bounds[i] : 4 * self._bounds[i + 1]]
            end = self._from[i + 1] - (1 if len(ids) else 0)  # no space behind the last token
            yield ids, self._data[self._from[i] : end]

    def array(self) -> pa.Array:
        """A struct of ids and decoded text per text."""
        ids = pa.ListArray.from_arrays(pa.array(self.bounds, pa.int32()), self.ids)
        # Arrow never lets go of a memoryview that it makes an array from.
        texts = [bytes(text) for _, text in self]
        decoded = pa.array(texts, pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays([ids, decoded], names=["ids", "decoded"])


class Encoder:
    """Token ids and texts; pieces of words are kept as they come again.

    Texts are taken as one row of bytes: words and their pieces are told apart in
    arrays, and what is different is looked up or encoded. When too many pieces are
    kept, those not met in the texts at hand are forgotten.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known = pa.array([], pa.binary())
        self.ids = np.zeros(0, np.int32)
        self.starts = self.lengths = np.zeros(0, np.int64)
        self.others: dict[bytes, list[bytes]] = {}

    def _words(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """Words of all texts, and the number of words before each text and in all.

        A special token becomes a word: its id behind a byte that UTF-8 does not have.
        """
        special = self.vocabulary.special
        for i, text in enumerate(texts):
            if any(token in text for token in special):
                texts[i] = self.vocabulary.splitter.sub(
                    lambda found: b" \xff%d " % special[found[0]], text
                )
        data = b"\n".join(texts) + b"\n"
        if not data.isascii():
            for space in _WIDE_SPACES:
                data = data.replace(space, b" " * len(space))
        values = np.frombuffer(data, np.uint8)
        filled = _IN_WORD[values]
        change = np.flatnonzero(filled[1:] != filled[:-1]) + 1  # a space ends the data
        if filled[0]:
            change = np.concatenate([[0], change])
        starts, ends = change[::2], change[1::2]
        sizes = np.array([len(text) + 1 for text in texts])
        first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
        return strings(values[filled], np.concatenate([[0], np.cumsum(ends - starts)])), first

    def _other_pieces(self, word: bytes) -> list[bytes]:
        """Pieces of a word with an apostrophe or with characters that are not settled."""
        if word[0] == _SPECIAL:
            return [word]
        text = word.decode()
        if text.isascii() or max(text) < _SETTLED:
            return [piece.encode() for piece in self.vocabulary.pattern.findall(text.lower())]
        text = self.vocabulary.normalize(text)
        return [piece.encode() for piece, _ in self.vocabulary.split(text)]

    def _pieces(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Pieces of words by the vocabulary's pattern: where a word's begin, and how many.

        What a letter is and its lower case depend on the version of Unicode. They
        are settled for Latin letters, which are in normal form too; words with
        other characters are normalised and split by the library's parts. So are
        words with apostrophes by the pattern itself, for its short forms.
        """
        data, offsets = parts(words)
        kind, lower = _KIND[data], _LOWER[data]
        other = (data == _APOSTROPHE) | (data >= 0xC9)
        two = np.flatnonzero((data >= 0xC2) & (data < 0xC9))  # first of two bytes
        if len(two):
            code = ((data[two].astype(np.int64) & 0x1F) << 6) | (data[two + 1] & 0x3F)
            small = _LOWER[code]
            kind[two] = kind[two + 1] = _KIND[code]
            lower[two], lower[two + 1] = 0xC0 | (small >> 6), 0x80 | (small & 0x3F)
            other[two] = _CHANGES[code]
        begins = np.ones(len(data), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        begins[two + 1] = False
        begins[offsets[:-1]] = True
        starts = np.flatnonzero(begins)
        counts = np.diff(np.searchsorted(starts, offsets))
        pieces = strings(lower.astype(np.uint8), np.append(starts, len(data)))
        left = np.unique(np.searchsorted(offsets, np.flatnonzero(other), "right") - 1)
        if not len(left):
            return pieces, np.cumsum(counts) - counts, counts
        whole = np.ones(len(words), bool)
        whole[left] = False
        pieces = pieces.filter(pa.array(np.repeat(whole, counts)))
        found = []
        if len(self.others) > CACHED_OTHERS:
            self.others = {}
        for word in words.take(pa.array(left)).to_pylist():
            split = self.others.get(word)
            if split is None:
                split = self.others[word] = self._other_pieces(word)
            found.append(split)
        counts[left] = 0
        first = np.cumsum(counts) - counts
        counts[left] = [len(split) for split in found]
        first[left] = len(pieces) + np.cumsum(counts[left]) - counts[left]
        more = pa.array([piece for split in found for piece in split], pa.binary())
        return pa.concat_arrays([pieces, more]), first, counts

    def _encode_new(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, where each piece's begin, and how many they are."""
        vocabulary = self.vocabulary
        data, offsets = parts(pieces)
        begins, sizes = offsets[:-1], np.diff(offsets)
        starts, lengths, out, filled = np.zeros_like(sizes), np.zeros_like(sizes), [], 0
        special = data[begins] == _SPECIAL
        alone = np.flatnonzero((sizes > WIDEST) | special)
        for at in alone.tolist():
            values = data[begins[at] : begins[at] + sizes[at]]
            if special[at]:
                ids = [int(values[1:].tobytes())]
            else:
                symbols = vocabulary.inner[values]
                symbols[-1] = vocabulary.final[values[-1]]
                ids = encode_long(symbols.tolist(), vocabulary)
            starts[at], lengths[at] = filled, len(ids)
            filled += len(ids)
            out.append(np.array(ids, np.int32))
        side = ~special
        width = 2
        while width <= WIDEST:
            fits = side & (sizes <= width) & ((sizes > width // 2) | (width == 2))
            every = np.flatnonzero(fits)
            for run in range(0, len(every), SIDE_BY_SIDE):
                rows = every[run : run + SIDE_BY_SIDE]
                place, last = np.arange(width), sizes[rows] - 1
                got = data[np.minimum(begins[rows, None] + place, len(data) - 1)]
                symbols = vocabulary.inner[got]
                each = np.arange(len(rows))
                symbols[each, last] = vocabulary.final[got[each, last]]
                symbols[place > last[:, None]] = -1
                ids = encode_side_by_side(symbols, vocabulary)
                kept = ids >= 0
                lengths[rows] = kept.sum(axis=1)
                ends = filled + np.cumsum(lengths[rows])
                starts[rows] = ends - lengths[rows]
                filled = int(ends[-1])
                out.append(ids[kept].astype(np.int32))
            width *= 2
        return np.concatenate(out), starts, lengths

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """Where different pieces are among the known ones; new ones are encoded."""
        at = pc.index_in(pieces, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if not len(new):
            return at
        if len(self.known) + len(new) > CACHED_WORDS:
            met = np.flatnonzero(at >= 0)
            kept = at[met]
            at[met] = np.arange(len(met))
            self.known = self.known.take(pa.array(kept))
            self.ids = self.ids[spread(self.starts[kept], self.lengths[kept])]
            self.lengths = self.lengths[kept]
            self.starts = np.cumsum(self.lengths) - self.lengths
        unknown = pieces.take(pa.array(new))
        ids, starts, lengths = self._encode_new(unknown)
        at[new] = len(self.known) + np.arange(len(new))
        self.known = pa.concat_arrays([self.known, unknown])
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        return at

    def tokens(self, texts: list[bytes]) -> Tokens:
        """Tokens of texts in UTF-8."""
        words, first = self._words([utf8(text) for text in texts])
        words = words.dictionary_encode()
        pieces, starts, counts = self._pieces(words.dictionary)
        pieces = pieces.dictionary_encode()
        at = self._learn(pieces.dictionary)[pieces.indices.to_numpy()]
        at = at[spread(starts, counts)]  # pieces of the different words, word by word
        ids = self.ids[spread(self.starts[at], self.lengths[at])]
        ends = np.concatenate([[0], np.cumsum(self.lengths[at])])[np.cumsum(counts)]
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        met = words.indices.to_numpy()
        lengths = (ends - starts)[met]
        bounds = np.concatenate([[0], np.cumsum(lengths)])[first]
        return Tokens(ids[spread(starts[met], lengths)], bounds, self.vocabulary)

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids (little-endian, 32 bits each) and decoded text of each text."""
        found = self.tokens([text.encode() for text in texts])
        return [(bytes(ids), str(decoded, "utf-8")) for ids, decoded in found]


@lru_cache(maxsize=2)
def vocabulary(name: str) -> Vocabulary:
    return Vocabulary(vocabulary_path(name))


def encoder(name: str) -> Encoder:
    """An encoder for one task. A worker outlives its tasks and keeps the tables of
    the vocabulary, but no words."""
    return Encoder(vocabulary(name))


def encode(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """A struct of the ids and of the text that they decode to."""

    @F.arrow_udf("ids array<int>, decoded string")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(tokenizer)
        for column in columns:
            for batch in batches(column, TEXT_BYTES):  # handed over run by run
                yield coder.tokens(batch).array()
        pa.default_memory_pool().release_unused()  # a worker outlives its tasks

    return run(F.coalesce(text, F.lit("")))


def digest(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """A struct of the number of ids and of both digests; ids stay in the worker."""

    @F.arrow_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(tokenizer)
        kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
        for column in columns:
            out = {name: [] for name in kinds}
            for batch in batches(column, TEXT_BYTES):
                for ids, decoded in coder.tokens(batch):
                    out["n_tokens"].append(len(ids) // 4)
                    out["ids_sha256"].append(sha256(ids).hexdigest())
                    out["decoded_sha256"].append(sha256(decoded).hexdigest())
            yield struct_array(out, kinds)
        pa.default_memory_pool().release_unused()

    return run(F.coalesce(text, F.lit("")))


def token_digests(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per document: number of tokens, digests of its ids and of their decoding."""
    found = docs.select("doc_id", digest(F.col("text"), tokenizer).alias("found"))
    return found.select("doc_id", "found.*")


def encode_documents(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per document: its ids and the text that they decode to."""
    found = docs.select("doc_id", encode(F.col("text"), tokenizer).alias("found"))
    return found.select("doc_id", "found.*")
