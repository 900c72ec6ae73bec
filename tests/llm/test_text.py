"""Language, quality, toxicity and pseudo-likelihood on planted texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.llm import langid, pseudo_likelihood, quality, toxicity
from cohortry.llm.langid import LanguageModel, Mixtures, grams, proportions

STEMS = {"xx": "ka lo mi ru ta shi no", "yy": "bren gart stolf wink drusk", "zz": "aeu oie uao eia ioe"}


def sentence(lang, seed, n=60):
    rng = np.random.default_rng(seed)
    parts = STEMS[lang].split()
    return " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def languages(spark):
    rows = [(i, sentence(lang, 10 * i + j), lang) for i in range(40) for j, lang in enumerate(STEMS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_mixtures(spark, languages):
    model = langid.fit(languages)
    assert model.languages == ["xx", "yy", "zz"]
    texts = [(1, sentence("xx", 901)), (2, sentence("yy", 902, 30) + " " + sentence("zz", 903, 30)), (3, " ".join(sentence(x, 904) for x in STEMS))]
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(texts, "doc_id bigint, text string"), model).collect()}
    assert got[1].languages == ["xx"] and got[1].score == 1
    assert set(got[2].languages) == {"yy", "zz"} and sum(got[2].proportions) == pytest.approx(1)
    assert set(got[3].languages) == {"xx", "yy", "zz"}


def test_proportions_against_brute_force():
    rng = np.random.default_rng(0)
    model = LanguageModel(["a", "b"], np.log(rng.dirichlet(np.ones(langid.BUCKETS) * 0.05, 2) + 1e-9))
    data = np.frombuffer(sentence("xx", 1).encode() + sentence("yy", 2).encode(), np.uint8)
    owner, bucket, count = grams(data, np.array([0, len(data)]))
    mix = Mixtures(model, owner, bucket, count)
    found = proportions(mix, 2, 400, 0.0, 0.0)[0]
    grid = np.linspace(0, 1, 2001)
    p = np.exp(model.log_likelihood[:, bucket])
    best = grid[np.argmax([(count * np.log(x * p[0] + (1 - x) * p[1] + 1e-300)).sum() for x in grid])]
    assert found[0] == pytest.approx(best, abs=2e-3)


def test_language_edges(spark, languages, awkward, empty):
    model = langid.fit(languages)
    got = langid.predict(awkward, model).collect()
    assert len(got) == awkward.count()
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].languages == [] for i in (1, 2, 3, 4))
    assert by[6].lang_pred in model.languages and all(0 <= r.score <= 1 for r in got)
    assert langid.predict(empty, model).count() == 0
    none = langid.predict(awkward, langid.fit(empty)).collect()
    assert {r.lang_pred for r in none} == {"und"}
    kept = langid.predict(awkward, model, keep=awkward.columns)
    assert kept.columns == ["doc_id", "lang_pred", "score", "languages", "proportions", "kept_doc_id", "text", "lang", "kept_score", "n_tokens"]
    assert kept.where("kept_score <> 5").count() == 0


@pytest.fixture(scope="module")
def judged(spark):
    rows, labels = [], []
    for i in range(240):
        text = sentence("xx", i, 40)
        if i % 6 == 0:
            text = " | ".join(w + "%%%" for w in text.split())
        if i % 8 == 1:
            words = text.split()
            for at in range(0, 40, 9):
                words[at] = "qworb" + words[at]
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(i % 6 != 0), int(i % 8 == 1)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality(judged, awkward, empty):
    docs, labels = judged
    model = quality.fit(docs.where("doc_id % 5 <> 0"), labels, "quality")
    got = quality.score(docs, model).join(labels, "doc_id")
    assert got.where("predicted <> quality").count() == 0
    rows = quality.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(empty, model).count() == 0
    assert {r.score for r in quality.score(awkward, quality.fit(empty, labels, "quality")).collect()} == {0.5}


def test_votes_are_exact():
    rng = np.random.default_rng(2)
    model = quality.QualityModel(np.zeros((1, 1)), quality.unit(rng.standard_normal((300, 8)).astype(np.float32)), rng.integers(0, 2, 300).astype(np.float32), 0.5)
    vectors = quality.unit(rng.standard_normal((100, 8)).astype(np.float32))
    got = quality.vote(model, vectors, 7, 4.0, block=33)
    for v, s in zip(vectors, got, strict=True):
        cosines = model.references @ v
        best = np.argsort(-cosines)[:7]
        weights = np.maximum(cosines[best], 0).astype(float) ** 4
        assert s == pytest.approx((weights * model.labels[best]).sum() / weights.sum(), abs=1e-5)


def test_toxicity(judged, awkward, empty):
    docs, labels = judged
    model = toxicity.fit(docs.where("doc_id % 4 <> 2"), labels, "toxic")
    got = toxicity.score(docs, model).join(labels, "doc_id")
    assert got.where("predicted <> toxic").count() == 0
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(empty, model).count() == 0
    # Without labels the fixed list still votes.
    bare = toxicity.fit(docs, labels.where("false"), "toxic")
    assert len(bare.lexicon.hashes) == len(toxicity.INSULTS)


def planted_votes(seed, fires, copied=()):
    """Vote patterns of 20,000 texts, how often each occurs, and on how many labelled texts of either class."""
    rng = np.random.default_rng(seed)
    truth = rng.random(20_000) < 0.15
    cast = rng.random((20_000, len(toxicity.VOTERS))) < fires[truth.astype(int)]
    for i, j in copied:
        cast[:, j] = cast[:, i]
    cast[:, -1] = ~cast[:, :-1].any(axis=1)  # the silent voter
    patterns, at = np.unique(cast, axis=0, return_inverse=True)
    labelled = np.arange(20_000) % 5 == 0
    known = np.stack([np.bincount(at[labelled & (truth == c)], minlength=len(patterns)) for c in (False, True)], axis=1)
    return cast, truth, patterns, np.bincount(at[~labelled], minlength=len(patterns)), known


def test_label_model():
    voters = len(toxicity.VOTERS)
    fires = np.stack([np.full(voters, 0.01), np.linspace(0.3, 0.8, voters)])
    cast, truth, patterns, counts, known = planted_votes(4, fires)
    model = toxicity.fit_label_model(patterns, counts, 0.15, known)
    assert np.abs(model.rates - fires)[:, :-1].max() < 0.15
    assert ((model.posterior(cast.astype(float)) > 0.5) == truth).mean() > 0.98


def test_correlated_voters_count_less():
    fires = np.stack([np.full(len(toxicity.VOTERS), 0.05), np.full(len(toxicity.VOTERS), 0.6)])
    _, _, patterns, counts, known = planted_votes(5, fires, copied=[(3, 4)])
    model = toxicity.fit_label_model(patterns, 0 * counts + 1e-6, 0.15, 1e-6 * known)
    others = [i for i in range(len(toxicity.VOTERS) - 1) if i not in (3, 4)]
    assert max(model.weights[3], model.weights[4]) < 0.8 * min(model.weights[others])


def test_log_probabilities_are_normalised():
    weights = pseudo_likelihood.initial()
    around = np.random.default_rng(1).integers(0, pseudo_likelihood.WORDS + 1, (3, 2 * pseudo_likelihood.REACH)).astype(np.int32)
    for row in around:
        every = pseudo_likelihood.log_probabilities(weights, np.repeat(row[None], pseudo_likelihood.WORDS, 0), np.arange(pseudo_likelihood.WORDS))
        assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)


def test_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(3)
    around = rng.integers(0, 50, (4096, 2 * pseudo_likelihood.REACH)).astype(np.int32)
    target = around[:, 2].astype(np.int64) * 7 % pseudo_likelihood.WORDS
    trainer = pseudo_likelihood.Trainer(pseudo_likelihood.initial(), 0.05)
    before = pseudo_likelihood.log_probabilities(trainer.weights, around, target).mean()
    for _ in range(30):
        trainer.step(around, target)
    assert pseudo_likelihood.log_probabilities(trainer.weights, around, target).mean() > before + 2


def test_pseudo_likelihood_prefers_order(spark, awkward, empty):
    text = "the cat sat on the mat and the dog lay by the door "
    docs = spark.createDataFrame([(i, text * 40) for i in range(30)], "doc_id bigint, text string").repartition(3)
    model = pseudo_likelihood.fit(docs, rounds=3, masked=0.5)
    mixed = " ".join(np.random.default_rng(0).permutation((text * 5).split()))
    got = {r.doc_id: r for r in pseudo_likelihood.score(spark.createDataFrame([(1, text * 5), (2, mixed)], "doc_id bigint, text string"), model).collect()}
    assert got[1].n_words == got[2].n_words and got[1].log_likelihood > got[2].log_likelihood + 10
    rows = {r.doc_id: r for r in pseudo_likelihood.score(awkward, model).collect()}
    assert rows[1].n_words == 0 and rows[1].log_likelihood == 0 and rows[1].mean_log_likelihood is None
    assert pseudo_likelihood.score(empty, model).count() == 0
    assert pseudo_likelihood.score(awkward, pseudo_likelihood.fit(empty)).count() == awkward.count()


def test_rare_words_have_their_own_probability(spark):
    filler = " ".join(f"w{i}" for i in range(pseudo_likelihood.WORDS)) + " "
    rare = " ".join(f"seldom{i}" for i in range(300)) + " "
    # Of two words in one bucket, one stands three times as often.
    names = [f"odd{i}" for i in range(400)]
    hashes = {w: int(pseudo_likelihood.words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0]) % pseudo_likelihood.BUCKETS for w in names}
    a = names[0]
    b = next(w for w in names[1:] if hashes[w] == hashes[a])
    docs = spark.createDataFrame([(i, filler * 4) for i in range(3)] + [(3, rare + f"{a} {b} {a} w5 {a}")], "doc_id bigint, text string").repartition(2)
    model = pseudo_likelihood.fit(docs)
    asked = spark.createDataFrame([(1, f"w1 {a} w2"), (2, f"w1 {b} w2"), (2, f"w1 {b} w2"), (3, f"w1 {b} {b} w2"), (4, "w1 w2")], "doc_id bigint, text string")
    got = [(r.doc_id, r.log_likelihood) for r in pseudo_likelihood.score(asked, model).collect()]
    one = dict(got)
    assert len(got) == 5 and len({v for k, v in got if k == 2}) == 1
    assert one[1] - one[2] == pytest.approx(np.log(3), abs=1e-5)


def test_shares_of_a_bucket_add_up(spark):
    docs = spark.createDataFrame([(i, " ".join(f"x{j}" for j in range(3000) if j % (i + 1) == 0)) for i in range(6)], "doc_id bigint, text string")
    model = pseudo_likelihood.fit(docs)
    counts = {r["word"]: r["count"] for r in model.counts.collect()}
    numbers = model.vocabulary.encode(np.array(list(counts), np.int64).view(np.uint64)) - model.vocabulary.first_bucket
    own = np.array(list(counts.values()))
    assert len(counts) == 3000 and (np.bincount(numbers[numbers >= 0], weights=own[numbers >= 0], minlength=len(model.totals)) == model.totals).all()


def test_vocabulary_grows_with_the_corpus(spark):
    def known(occurrences):
        return pseudo_likelihood.vocabulary(spark.range(20_000).select(F.col("id").alias("word"), F.lit(occurrences).cast("bigint").alias("count")))

    small, large = known(1), known(5000)
    assert small.classes == pseudo_likelihood.CLASSES and len(small.hashes) == pseudo_likelihood.WORDS - pseudo_likelihood.BUCKETS
    assert len(large.hashes) >= 5000 and len(np.unique(large.numbers)) == len(large.hashes) and large.numbers.max() < large.first_bucket


def slow_log_likelihood(model, counts, text):
    """Word by word: both softmaxes over plain lists, and a rare word's share of its bucket."""
    known, w = model.vocabulary, pseudo_likelihood.shaped(model.weights, model.vocabulary.classes)
    data = np.frombuffer(text.encode(), np.uint8)
    hashes = pseudo_likelihood.words(data, np.array([0, len(data)]))[0]
    numbers = [int(known.encode(hashes[i : i + 1])[0]) for i in range(len(hashes))]
    softmax = lambda z: np.exp(z) / np.exp(z).sum()
    total = 0.0
    for i, n in enumerate(numbers):
        hidden = w["hidden"].astype(float)
        for k, step in enumerate((-3, -2, -1, 1, 2, 3)):
            inside = 0 <= i + step < len(numbers)
            hidden = hidden + w["embedding"][k, numbers[i + step] if inside else known.classes**2]
        hidden = np.tanh(hidden)
        c, m = divmod(n, known.classes)
        p = softmax(w["classes"].astype(float) @ hidden + w["class_bias"])[c] * softmax(w["members"][c].astype(float) @ hidden + w["member_bias"][c])[m]
        if n >= known.first_bucket:
            p *= counts.get(int(hashes[i].astype(np.int64)), 1) / (model.totals[n - known.first_bucket] + 1)
        total += np.log(p)
    return total


@pytest.fixture(scope="module")
def read_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = pseudo_likelihood.fit(docs.where("doc_id % 10 <> 0"))
    return docs, model, {r["word"]: r["count"] for r in model.counts.collect()}


def test_log_likelihood_word_by_word(spark, read_corpus):
    docs, model, counts = read_corpus
    some = docs.where("doc_id % 10 = 0 and length(text) between 1 and 900").limit(12).collect()
    asked = spark.createDataFrame([tuple(r) for r in some] + [(-1, "one"), (-2, "unseenword anotherunseen one the")], "doc_id bigint, text string")
    got = {r.doc_id: r.log_likelihood for r in pseudo_likelihood.score(asked, model).collect()}
    for r in asked.collect():
        assert got[r.doc_id] == pytest.approx(slow_log_likelihood(model, counts, r.text), rel=1e-4, abs=1e-3)


def test_held_out_words_and_order(spark, read_corpus):
    """Neighbours tell something: better than the words' shares alone, and the given order better than a shuffled one."""
    docs, model, counts = read_corpus
    held = [r for r in docs.where("doc_id % 10 = 0 and text is not null").collect() if len(r.text.split()) > 20]
    rng = np.random.default_rng(2)
    mixed = [(-1 - r.doc_id, " ".join(rng.permutation(r.text.split()))) for r in held]
    got = {r.doc_id: r for r in pseudo_likelihood.score(spark.createDataFrame([tuple(r) for r in held] + mixed, "doc_id bigint, text string"), model).collect()}
    total, plain, n = sum(counts.values()), 0.0, 0
    for r in held:
        data = np.frombuffer(r.text.encode(), np.uint8)
        hashes = pseudo_likelihood.words(data, np.array([0, len(data)]))[0].astype(np.int64)
        plain += sum(np.log(counts.get(int(h), 1) / total) for h in hashes)
        n += len(hashes)
    assert sum(got[r.doc_id].log_likelihood for r in held) / n > plain / n + 0.1
    assert np.mean([got[r.doc_id].log_likelihood > got[-1 - r.doc_id].log_likelihood for r in held]) > 0.65


def test_words_are_found_by_the_low_bits_of_their_hashes():
    rng = np.random.default_rng(3)
    # Many words agree in their low bits; zero is the place of an empty slot.
    hashes = np.unique(np.concatenate([rng.integers(0, 1 << 63, 300).astype(np.uint64), (np.arange(5, dtype=np.uint64) << np.uint64(40)) + np.uint64(7), np.zeros(1, np.uint64)]))
    known = pseudo_likelihood.Vocabulary(hashes, rng.permutation(len(hashes)).astype(np.int64))
    assert len(known.levels()) >= 5
    asked = np.concatenate([hashes, hashes[::-1], hashes + np.uint64(1), rng.integers(0, 1 << 63, 500).astype(np.uint64)])
    numbers = dict(zip(hashes.tolist(), known.numbers.tolist(), strict=True))
    assert known.encode(asked).tolist() == [numbers.get(h, known.first_bucket + h % (2 * known.classes)) for h in asked.tolist()]
    nothing = pseudo_likelihood.Vocabulary(hashes[:0], known.numbers[:0])
    assert nothing.levels() == [] and nothing.encode(asked).tolist() == [nothing.first_bucket + h % (2 * nothing.classes) for h in asked.tolist()]
    assert known.encode(asked[:0]).tolist() == []
