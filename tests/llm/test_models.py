"""The trained models: held-out accuracy, exact sums, odd rows, empty tables."""

import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest

from fareloom.llm import language, lm, quality, queries


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_languages_of_held_out_documents(spark, sf_dir, rows_of):
    known = dict(rows_of(f"{sf_dir}/documents.parquet", "doc_id, lang"))
    rows = queries.all_queries()["op9_language"](spark, sf_dir).collect()
    assert len(rows) == len(known)
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in rows)
    unseen = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == known[r["doc_id"]] for r in unseen]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def mixture():
    german, english = "der die und ist nicht eine auch", "the and of is not a this"
    table = pa.RecordBatch.from_pydict({"lang": ["de", "en"], "text": [german * 50, english * 50]})
    counts = np.zeros((language.BUCKETS, 2))
    for batch in language.count_trigrams(iter([table])):
        at = ["de", "en"].index(batch.column("lang")[0].as_py())
        counts[batch.column("bucket").to_numpy(), at] = batch.column("n").to_numpy()
    return language.Mixture(["de", "en"], counts), german, english


def test_mixed_documents_have_both_languages():
    model, german, english = mixture()
    names, scores = model.infer([german, english, f"{german} {german} {english}", "12 34", ""])
    assert names == ["de", "en", "de", "und", "und"]
    assert scores[0] == scores[1] == 1 and scores[3] == scores[4] == 0
    assert 0.55 < scores[2] < 0.8


def test_trigrams_are_the_three_characters_around_each_letter():
    def bucket(before, letter, after):
        wide = (1 << 64) - 1
        mixed = ord(before) * 0x9E3779B1 & wide
        mixed ^= (ord(letter) * 0x85EBCA77 + 1) & wide
        mixed ^= (ord(after) * 0xC2B2AE3D & wide) << 3 & wide
        mixed = (mixed ^ mixed >> 29) * 0xBF58476D1CE4E5B9 & wide
        return mixed >> 49

    buckets, starts = language.trigrams(["äb", "c", "d\ne"])
    assert starts.tolist() == [0, 3, 5]
    expected = [("\n", "ä", "b"), ("ä", "b", "\n"), None, ("\n", "c", "\n"), None]
    expected += [("\n", "d", "\n"), None, ("\n", "e", "\n")]
    assert buckets.tolist() == [-1 if x is None else bucket(*x) for x in expected]


def test_trigram_counts_are_exact(spark):
    """Of every text and language, against counts one by one."""
    texts = [("en", "ab ab, a1b é"), ("de", "ab"), ("en", "AB " * 50), ("de", None), (None, "ab")]
    docs = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model, counts = language.fit(docs), {}
    for lang, text in texts:
        for word in (text or "").split() if lang else []:
            buckets, _ = language.trigrams([language.letters_of(word)])
            for b in buckets[buckets >= 0].tolist():
                counts[b, lang] = counts.get((b, lang), 0) + 1
    assert model.languages == ["de", "en"]
    total = {g: sum(n for (_, x), n in counts.items() if x == g) for g in model.languages}
    for (b, lang), n in counts.items():
        at = model.languages.index(lang)
        share = (n + language.SMOOTHING) / (total[lang] + language.SMOOTHING * language.BUCKETS)
        assert model.table[b, at] == pytest.approx(np.log(share), abs=1e-5)


def best_set(model, text):
    """Language and proportion by the best of all sets of languages, one text at a time."""
    logs = []
    for word in text.split():
        buckets, _ = language.trigrams([language.letters_of(word)])
        logs.append(model.table[buckets[buckets >= 0]].astype(np.float64).sum(axis=0))
    logs = np.array(logs)
    penalty, found = 0.5 * np.log(len(logs) + 1.0), []
    for bits in range(1, 1 << len(model.languages)):
        inside = [i for i in range(len(model.languages)) if bits >> i & 1]
        likely, share = np.exp(logs[:, inside] - logs.max(axis=1, keepdims=True)), None
        share = np.full(len(inside), 1 / len(inside))
        for _ in range(language.ROUNDS):
            weight = likely * share
            fit = np.log(weight.sum(axis=1)).sum()
            share = (weight / weight.sum(axis=1, keepdims=True)).mean(axis=0)
        found.append((fit - len(inside) * penalty, inside, share))
    value, inside, share = max(found, key=lambda x: x[0])
    return value, len(inside), model.languages[inside[int(share.argmax())]], share.max()


def test_sets_of_languages_are_the_best_of_all():
    """Mixtures of one to five languages, against all sets."""
    random = np.random.default_rng(12)
    names = ["aa", "bb", "cc", "dd", "ee"]
    letters = ["abcdef", "efghij", "ijklmn", "mnopab", "cdghkl"]
    words = [["".join(random.choice(list(x), random.integers(2, 7))) for _ in range(60)] for x in letters]
    batch = pa.RecordBatch.from_pydict({"lang": names, "text": [" ".join(w * 3) for w in words]})
    counts = np.zeros((language.BUCKETS, 5))
    for found in language.count_trigrams(iter([batch])):
        at = names.index(found.column("lang")[0].as_py())
        counts[found.column("bucket").to_numpy(), at] = found.column("n").to_numpy()
    model, texts = language.Mixture(names, counts), []
    for parts in range(1, 6):
        for _ in range(16):
            chosen = random.choice(5, parts, replace=False)
            often = random.integers(4, 60, parts)
            some = [random.choice(words[i], n) for i, n in zip(chosen, often, strict=True)]
            texts.append(" ".join(np.concatenate(some)))
    got, sizes = model.infer(texts), set()
    for name, score, text in zip(*got, texts, strict=True):
        _, size, language_of, share = best_set(model, text)
        sizes.add(size)
        assert score == pytest.approx(share, abs=2e-3) and (name == language_of or share < 0.5)
    assert sizes == {1, 2, 3, 4, 5}
    even = " ".join(" ".join(w) for w in words[:4])
    assert model.infer([even])[1][0] < 0.4  # four equal parts


def test_languages_of_odd_rows(odd, nothing):
    model = language.train(odd)
    rows = language.predict(odd, model).collect()
    texts = [r["text"] for r in odd.collect()]
    assert len(rows) == len(texts)
    for row, text in zip(rows, texts, strict=True):
        letters = any(c.isalpha() for c in text or "")
        assert row["lang_pred"] == ("en" if letters else "und")
    empty = language.train(nothing)
    assert {r["lang_pred"] for r in language.predict(odd, empty).collect()} == {"und"}
    assert language.predict(nothing, model).collect() == []


def test_quality_of_held_out_documents(spark, sf_dir, rows_of):
    known = dict(rows_of(f"{sf_dir}/labels.parquet", "doc_id, quality"))
    rows = queries.all_queries()["op1_quality"](spark, sf_dir).collect()
    assert len(rows) == 1000
    unseen = [r for r in rows if r["held_out"] and r["doc_id"] in known]
    assert np.mean([r["predicted"] == known[r["doc_id"]] for r in unseen]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_quality_scores_are_the_model(odd, nothing, spark):
    random = np.random.default_rng(0)
    scorer = quality.Scorer(random.normal(0, 5, quality.BUCKETS).astype(np.float32), 0.25)
    rows = quality.predict(odd, scorer).collect()
    for row, source in zip(rows, odd.collect(), strict=True):
        buckets, weights = quality.features(quality.tokens((source["text"] or "").encode()))
        logit = float((scorer.table[buckets] * weights).sum()) + 0.25
        assert row["score"] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-4)
    labels = spark.createDataFrame([(1, 1), (None, 0), (4, None)], "doc_id bigint, quality int")
    assert quality.predict(odd, quality.train(odd, labels)).count() == odd.count()
    unlearnt = quality.predict(odd, quality.train(nothing, labels)).collect()
    assert {r["score"] for r in unlearnt} == {0.5}
    assert quality.predict(nothing, scorer).collect() == []


def brute(rows):
    """Training counts, and what is known of each text."""
    counts = Counter()
    texts = [(i, (text or "").encode().lower().split() + [b"\n"]) for i, text in rows]
    for doc_id, words in texts:
        if doc_id is not None and remainder(doc_id, 7) != 2:
            counts.update(words)
    scale = log10(sum(counts.values()) + len(counts) + 1)
    return counts, [
        (
            i, len(words), sum(w in counts for w in words), sum(counts.values()),
            sum(log10(counts[w] + 1) - scale for w in words),
        )
        for i, words in texts
    ]


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def check_base(frame, rows):
    _, expected = brute(rows)
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score")
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=key)
    for a, b in zip(got, sorted(expected, key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], abs=1e-6)


def test_language_model_scores(spark, sf_dir, rows_of):
    frame = queries.all_queries()["op2_lm"](spark, sf_dir)
    check_base(frame, rows_of(f"{sf_dir}/documents.parquet", "doc_id, text"))
    unseen = [r for r in frame.collect() if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)
    assert all(r["score"] < 0 for r in unseen)


def test_language_model_of_odd_rows(odd, nothing, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check_base(lm.score_documents(odd), rows)
    monkeypatch.setattr(lm, "COMMON_WORDS", 3)
    counts = lm.word_counts(odd)
    lexicon = lm.lexicon_of(counts, 3)  # nearly all words go through the join
    lexicon.set_shares(lm.rest_mass(counts, lexicon))
    known, _ = brute(rows)
    weights = np.zeros((lm.ROWS, lm.WIDTH), np.float32)
    rest = np.log10(lm.rest_mass(counts, lexicon))
    model = lm.Model(lexicon, weights, rest, sum(known.values()), len(known))
    check_base(lm.scores(odd, model, counts), rows)
    assert lm.score_documents(nothing).collect() == []


def test_known_words_have_nearly_all_probability():
    counts = {b"the": 50, b"a": 30, b"\n": 10, b"rare": 2, b"ring": 1, b"king": 1}
    common = sorted(counts, key=lambda w: -counts[w])[:4]
    lexicon = lm.Lexicon(common, np.array([counts[w] for w in common]))
    rest = np.ones(lm.WIDTH)
    for word, n in counts.items():
        number = lexicon.words[word]
        if lexicon.member_of[number] == lm.WIDTH - 1:
            rest[lexicon.class_of[number]] += n + 1
    lexicon.set_shares(rest)
    random = np.random.default_rng(1)
    weights = random.normal(0, 1, (lm.ROWS, lm.WIDTH)).astype(np.float32)
    total = 0.0
    for word, n in counts.items():
        number = lexicon.words[word]
        numbers, starts = np.array([lexicon.words[b"the"], number]), np.array([0])
        value = lm.log_probabilities(lexicon, weights, numbers, starts)[1]
        if lexicon.member_of[number] == lm.WIDTH - 1:
            value += log10(n + 1) - log10(rest[lexicon.class_of[number]])
        total += 10**value
    assert 0 < total <= 1 + 1e-6


def test_training_lowers_the_error():
    text = [b"the cat sat on the mat " * 20, b"der hund lag auf dem sofa " * 20]
    counted = Counter(w for t in text for w in t.split() + [b"\n"])
    common = sorted(counted)
    lexicon = lm.Lexicon(common, np.array([counted[w] for w in common]))
    lexicon.set_shares(np.ones(lm.WIDTH))
    weights = np.zeros((lm.ROWS, lm.WIDTH), np.float32)
    trainer = lm.Trainer(lexicon, weights, np.ones(lm.ROWS))
    _, numbers, starts = lm._numbered(lexicon, text)
    before = lm.log_probabilities(lexicon, weights, numbers, starts).sum()
    for _ in range(20):
        trainer.learn(numbers, starts)
    assert lm.log_probabilities(lexicon, trainer.weights, numbers, starts).sum() > before / 2


def test_bytes_that_are_no_text(spark):
    frame = spark.sql(
        "SELECT id AS doc_id, CAST(X'61FF6220C3' AS STRING) AS text FROM range(20) "
        "UNION ALL SELECT 99, 'a\ufffdb \ufffd'"
    )
    rows = {r["doc_id"]: r for r in lm.score_documents(frame).collect()}
    assert len(rows) == 21
    for row in rows.values():
        assert (row["n_tokens"], row["n_known"]) == (3, 3)
        assert (row["base_score"], row["score"]) == pytest.approx(
            (rows[99]["base_score"], rows[99]["score"]), abs=1e-4
        )


def plain_mix(x, kind):
    """The bucket of a feature, in whole numbers."""
    wide = (1 << 32) - 1
    x = (x + (kind * 0x9E3779B1 & wide)) * 0x85EBCA6B & wide
    x ^= x >> 13
    x = x * 0xC2B2AE35 & wide
    x ^= x >> 16
    return x & (lm.BUCKETS - 1)


def plain_score(model, counts, text):
    """log10 of a text's probability, token by token, from the model's own tables."""
    lexicon, total, history = model.lexicon, 0.0, []
    start = lm.ATOMS + lm.WIDTH
    known = {word: i for i, word in enumerate(lexicon.common)}
    largest = {}
    for word, n in zip(lexicon.common, lexicon.counts.tolist(), strict=True):
        largest[lm.ending(word)] = largest.get(lm.ending(word), 0) + n
    endings = sorted(largest, key=lambda e: (-largest[e], e))[: lm.WIDTH - 1]
    members = {}
    for i, word in enumerate(lexicon.common):
        group = endings.index(lm.ending(word)) if lm.ending(word) in endings else lm.WIDTH - 1
        own = members.setdefault(group, {})
        if len(own) < lm.WIDTH - 1:
            own[word] = len(own)
    for word in [*text.encode().lower().split(), lm.END.encode()]:
        group = endings.index(lm.ending(word)) if lm.ending(word) in endings else lm.WIDTH - 1
        member = members.get(group, {}).get(word, lm.WIDTH - 1)
        last, before = ([start, start] + history)[-1], ([start, start] + history)[-2]
        rows = [plain_mix(last, 1), plain_mix(before, 2), plain_mix((last * 4096 + before) & 0xFFFFFFFF, 3)]
        logits = lexicon.shares[lm.WIDTH] + sum(model.weights[r] for r in rows)
        inside = model.weights[lm.BUCKETS + plain_mix(last * 64 + group, 4)] + lexicon.shares[group]
        for values, at in ((logits.astype(float), group), (inside.astype(float), member)):
            total += (values[at] - np.log(np.exp(values).sum())) / np.log(10)
        if member == lm.WIDTH - 1:
            total += log10(counts.get(word.decode(), 0) + 1) - model.rest[group]
        at = known.get(word)
        history.append(at if at is not None and at < min(len(known), lm.ATOMS) else lm.ATOMS + group)
    return total


def test_scores_are_the_model_token_by_token(spark, small_dir, rows_of):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    counts = lm.word_counts(docs)
    model = lm.fit(docs, counts)
    assert np.abs(model.weights).max() > 0.1
    table = {r["word"]: r["n"] for r in counts.collect()}
    got = {r["doc_id"]: r["score"] for r in lm.scores(docs, model, counts).collect()}
    rows = sorted(rows_of(f"{small_dir}/documents.parquet", "doc_id, text"))[::9]
    for doc_id, text in rows:
        assert got[doc_id] == pytest.approx(plain_score(model, table, text or ""), rel=1e-4, abs=1e-3)
