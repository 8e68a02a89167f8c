"""The convolutional classifier: held-out labels, exact responses and gradients, odd rows."""

import zlib
from functools import reduce

import numpy as np
import pytest

from fareloom.llm import queries, toxicity
from fareloom.llm.common import table


def random_scorer(names=("de", "en")):
    random = np.random.default_rng(2)
    model = toxicity.Weights(random)
    model.bias[:] = 0.3
    likelihood = random.normal(0, 2, (toxicity.BUCKETS, len(names))).astype(np.float32)
    scorer = toxicity.Scorer(model, list(names), likelihood)
    scorer.cuts = [0.4, -0.7, 0.1][: len(names)] + [0.1]
    return model, scorer


def plain_score(model, scorer, text):
    """The same model, window by window."""
    some, vectors, likely = toxicity.words(text), [], np.zeros(len(scorer.names))
    for word in some:
        bucket, _ = toxicity._buckets([word])
        vectors.append(model.vectors[bucket].mean(axis=0))
        likely += scorer.likelihood[bucket].mean(axis=0)
    hidden, at = [], 0
    filters = model.filters.reshape(toxicity.DIMENSIONS, -1)
    for width in toxicity.WIDTHS:
        for f in range(toxicity.FILTERS):
            best = -np.inf
            for start in range(len(some)):
                total = sum(
                    vectors[start + j] @ filters[:, at + j * toxicity.FILTERS + f]
                    for j in range(width)
                    if start + j < len(some)
                )
                best = max(best, total)
            hidden.append(best)
        at += width * toxicity.FILTERS
    hidden = np.maximum(np.array(hidden) + model.offsets, 0)
    told = some and scorer.names
    cut = scorer.cuts[int(likely.argmax()) if told else -1]
    return 1 / (1 + np.exp(cut - hidden @ model.out - model.bias[0]))


def test_scores_are_the_model_window_by_window():
    model, scorer = random_scorer()
    dice = np.random.default_rng(4)
    texts = [b"", b"one", b"two words", "Ünï \xff, (mark) ...".encode("latin-1")]
    texts += [" ".join(f"w{x}" for x in dice.integers(0, 40, n)).encode() for n in (3, 7, 60)]
    got = scorer.score(texts)
    assert got == pytest.approx([plain_score(model, scorer, t) for t in texts], abs=1e-5)
    again = random_scorer()[1]
    assert again.score(texts[::-1])[::-1] == pytest.approx(got, abs=1e-6)


def test_blocks_and_forgotten_words_change_nothing(monkeypatch):
    text = " ".join(f"w{x}" for x in np.random.default_rng(1).integers(0, 300, 500)).encode()
    whole = random_scorer()[1].score([text, b"a b", text[:100]])
    for block in (1, 2, 3, 498, 499, 500, 501):
        monkeypatch.setattr(toxicity, "_BLOCK", block)
        assert random_scorer()[1].score([text, b"a b", text[:100]]) == pytest.approx(whole, abs=1e-6)
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 5)
    scorer = random_scorer()[1]
    assert [scorer.score([t])[0] for t in (text, b"a b", text[:100])] == pytest.approx(whole, abs=1e-6)


def test_gradients_are_those_of_the_loss(monkeypatch):
    """Against differences of the loss, for every kind of weight."""
    texts = [b"bad idea of a bad day", b"fine words", b"one", b"some bad words again and again"]
    labels = np.array([1, 0, 0, 1])
    known = sorted({w for t in texts for w in toxicity.words(t)})
    numbers = [np.array([known.index(w) for w in toxicity.words(t)]) for t in texts]
    model, scorer = random_scorer(())
    scorer.cuts = [0.0]

    def loss():
        p = np.array([plain_score(model, scorer, t) for t in texts])
        return float(-np.mean(np.log(np.where(labels == 1, p, 1 - p))))

    for name in ("vectors", "filters", "offsets", "out", "bias"):
        setattr(model, name, getattr(model, name).astype(np.float64))
        model.seen[name] = np.full_like(getattr(model, name), 1e24)
    before = {name: getattr(model, name).copy() for name in model.seen}
    monkeypatch.setattr(toxicity, "RATE", 1e12)  # with 1e24 seen, a step is the gradient
    bucket, starts = toxicity._buckets(known)
    model.learn(numbers, labels, bucket, starts)
    moved = {name: before[name] - getattr(model, name) for name in before}
    for name in before:
        setattr(model, name, before[name])
    dice = np.random.default_rng(0)
    for name, gradient in moved.items():
        flat = getattr(model, name).reshape(-1)
        likely = np.flatnonzero(gradient.reshape(-1))
        for at in dice.choice(likely, min(12, len(likely)), replace=False):
            kept, step = flat[at], 1e-5
            flat[at] = kept + step
            above = loss()
            flat[at] = kept - step
            below = loss()
            flat[at] = kept
            assert gradient.reshape(-1)[at] == pytest.approx((above - below) / 2 / step, abs=2e-4), name


def test_threshold_makes_the_fewest_errors():
    dice = np.random.default_rng(6)
    for n in (1, 2, 5, 40):
        for _ in range(30):
            raw, toxic = dice.integers(0, 9, n) * 1.0 + dice.random(n), dice.integers(0, 2, n)
            weight = dice.integers(1, 4, n) * 1.0

            def errors(cut):
                return weight[(raw >= cut) != (toxic == 1)].sum()

            cuts = [-1, *(raw + 1e-9), *raw, 99]
            assert errors(toxicity.threshold(raw, toxic, weight)) == min(map(errors, cuts))


def test_query_on_all_documents(spark, sf_dir, rows_of):
    result = queries.all_queries()["op13_toxicity"](spark, sf_dir)
    assert result.dtypes[:4] == [
        ("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int"),
    ]
    rows = result.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(
        x for (x,) in rows_of(f"{sf_dir}/documents.parquet", "doc_id")
    )
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(
        r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows
    )


def test_labels_of_held_out_documents(spark, rows_of):
    """On 10,000 documents; those of the small table have few toxic ones."""
    sf_dir = "/root/testdata/sf0.1"
    rows = queries.all_queries()["op13_toxicity"](spark, sf_dir).where("held_out").collect()
    known = dict(rows_of(f"{sf_dir}/labels.parquet", "doc_id, toxic"))
    lang = dict(rows_of(f"{sf_dir}/documents.parquet", "doc_id, lang"))
    judged = [r for r in rows if r["doc_id"] in known]
    clean = [r["predicted"] for r in judged if known[r["doc_id"]] == 0]
    toxic = [r["predicted"] for r in judged if known[r["doc_id"]] == 1 and lang[r["doc_id"]] == "en"]
    assert len(toxic) > 50 and np.mean(clean) < 0.03 and np.mean(toxic) > 0.85


@pytest.fixture(scope="module")
def many(spark):
    """More labelled rows than one task trains on, each of a word that no other has."""
    docs = spark.range(14_000).selectExpr(
        "id AS doc_id", "concat('w', sha1(string(id))) AS text", "IF(id % 3 = 0, 'de', 'en') AS lang"
    )
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic")
    return docs, labels, toxicity.train(docs, labels)


def known_rows(docs, labels, *where):
    rows = docs.join(labels, "doc_id").where("crc32(binary(string(doc_id))) % 5 != 0")
    for condition in where:
        rows = rows.where(condition)
    return rows.select("text", "lang", "toxic").collect()


def bucket_of(word):
    return toxicity._buckets([word])[0][0]  # of the word as a whole


def test_all_labelled_rows_are_learnt_from(many):
    docs, labels, scorer = many
    rows = known_rows(docs, labels, ~toxicity.judged())
    assert len(rows) > toxicity.ROWS_PER_TASK
    first = toxicity.Weights(np.random.default_rng(13)).vectors
    moved = (scorer.vectors != first).any(axis=1)
    assert all(moved[bucket_of(row["text"])] for row in rows)


def test_languages_are_counted_in_all_labelled_rows(many):
    docs, labels, scorer = many
    least = scorer.likelihood.min(axis=0)
    for row in known_rows(docs, labels):
        i = scorer.names.index(row["lang"])
        assert scorer.likelihood[bucket_of(row["text"]), i] > least[i]


def test_thresholds_are_those_of_all_judged_rows(many):
    docs, labels, scorer = many
    rows = known_rows(docs, labels, toxicity.judged())
    assert len(rows) > 2000
    raw = np.array([raw for raw, _ in scorer.raws([row["text"].encode() for row in rows])])
    toxic, lang = np.array([row["toxic"] for row in rows]), np.array([row["lang"] for row in rows])
    for name, cut in zip([*scorer.names, None], scorer.cuts, strict=True):
        own = np.full(len(rows), True) if name is None else lang == name
        assert cut == pytest.approx(toxicity.threshold(raw[own], toxic[own], np.ones(own.sum())), abs=1e-4)


def test_thresholds_do_not_depend_on_how_scores_are_cut(spark):
    dice = np.random.default_rng(8)
    for n in (1, 2, 7, 60):
        raw, toxic = dice.integers(0, 12, n) * 0.5, dice.integers(0, 2, n)
        langs = [["de", "en", None][x] for x in dice.integers(0, 3, n)]
        rows = list(zip(langs, toxic.tolist(), raw.tolist(), strict=True))
        frame = spark.createDataFrame(rows, "lang string, label int, raw double")
        got = toxicity.thresholds(frame, ["de", "en"])
        for i, name in ((-1, None), (0, "de"), (1, "en")):
            own = np.array([name in (None, lang) for lang in langs])
            if own.any():
                assert got[i] == toxicity.threshold(raw[own], toxic[own], np.ones(own.sum()))
        pieces = [toxicity._piece(np.array([x]), np.array([1.0 - 2 * (x % 2)])) for x in range(9)]
        whole = toxicity._piece(np.arange(9.0), 1.0 - 2 * (np.arange(9) % 2))
        assert toxicity._cut(reduce(toxicity._joined, pieces)) == toxicity._cut(whole)


def test_a_null_language_is_not_the_empty_one(spark):
    rows = [("", 0, 0.0), ("", 1, 2.0), (None, 0, 8.0), (None, 1, 9.0), (None, 0, 1.8)]
    got = toxicity.thresholds(spark.createDataFrame(rows, "lang string, label int, raw double"), [""])
    assert got[0] == 1.0


def test_long_texts_learn_as_in_one_block(monkeypatch):
    texts = [np.random.default_rng(3).integers(0, 30, 200), np.array([4, 2])]
    bucket, starts = toxicity._buckets([f"word{i}" for i in range(30)])
    found = []
    for block in (1 << 14, 7, 1):
        monkeypatch.setattr(toxicity, "_BLOCK", block)
        model, _ = random_scorer()
        model.learn(texts, np.array([1, 0]), bucket, starts)
        found.append(model)
    assert all(np.array_equal(m.vectors, found[0].vectors) for m in found)


def test_odd_rows(odd, nothing, spark, small_dir):
    labels = table(spark, small_dir, "labels")
    docs = table(spark, small_dir, "documents")
    scorer = toxicity.train(docs, labels)
    assert toxicity.predict(odd, scorer).count() == odd.count()
    assert toxicity.predict(nothing, scorer).collect() == []
    assert toxicity.train(nothing, labels) is None
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    rows = toxicity.predict(odd, None).collect()
    assert {(r["score"], r["predicted"]) for r in rows} == {(0.0, 0)}
    strange = odd.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    marks = odd.selectExpr("doc_id", "doc_id % 2 AS toxic", "'x' AS lang", "'x' AS text")
    again = toxicity.train(strange, marks)
    assert again.names == [] and toxicity.predict(odd, again).count() == odd.count()
