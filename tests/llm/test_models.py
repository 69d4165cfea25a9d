import zlib

import duckdb
import numpy as np
import pytest

from gridtide.llm import langid, toxicity
from gridtide.llm.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.01"


def crc(k, n):
    return zlib.crc32(str(k).encode()) % n


def test_toxicity_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    rows = duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/documents.parquet' LEFT JOIN '/root/testdata/sf0.1/labels.parquet' USING (doc_id)").fetchall()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (crc(k, 3) == 1) for k, r in got.items())
    held = [(got[k].predicted, toxic) for k, toxic in rows if toxic is not None and crc(k, 3) == 1]
    toxic = [p for p, t in held if t == 1]
    clean = [p for p, t in held if t == 0]
    assert sum(toxic) / len(toxic) > 0.82
    assert sum(clean) / len(clean) < 0.01


def plain_ngrams(text):
    """Hashes of the n-grams that a text has, one n-gram after another."""
    padded, found = " " + " ".join(text.lower().split()) + " ", set()
    for n in toxicity.SIZES:
        for k in range(len(padded) - n + 1):
            h = ord(padded[k])
            for c in padded[k + 1 : k + n]:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ ord(c)
            mixed = ((h ^ h >> 15) * 0x85EBCA6B + n) & 0xFFFFFFFF
            found.add((mixed * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - toxicity.BITS)
    return found


def test_toxicity_by_brute_force(spark):
    """Every n-gram of the sample is a feature with its ratio, and the weights are where the penalised loss is least."""
    words = ["awful", "stupid", "nice", "day", "the", "é", "a b", "lovely"]
    draw = np.random.default_rng(2)
    texts = [" ".join(draw.choice(words, 6, p=[0.25, 0.2, 0.05, 0.1, 0.1, 0.1, 0.1, 0.1] if k % 3 == 0 else [0.05, 0.05, 0.2, 0.2, 0.2, 0.1, 0.1, 0.1])) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    toxic = np.array([k % 3 == 0 for k in range(60)])
    grams = [plain_ngrams(t) for t in texts]
    seen, ratio = sorted(set().union(*grams)), {}
    for g in seen:
        has = np.array([g in some for some in grams])
        a, b = (has & toxic).sum() / toxic.sum() + 1 / 60, (has & ~toxic).sum() / (~toxic).sum() + 1 / 60
        error = sum(1 / (share * n) - 1 / (n + n / 60) for share, n in ((a, toxic.sum()), (b, (~toxic).sum())))
        plain = np.log(a / b)
        ratio[g] = plain * (1 - 4 * error / plain**2) if plain**2 > 4 * error else 0.0
    assert sum(v != 0 for v in ratio.values()) > 20
    x = np.array([[ratio[g] if g in some else 0.0 for g in seen] for some in grams])
    constant = np.sqrt((x**2).sum(axis=1).mean()) + 1
    x, y, cost = np.column_stack([x, np.full(60, constant)]), toxic.astype(float), np.where(toxic, toxicity.TOXIC_WEIGHT, 1)
    w = np.zeros(x.shape[1])
    for _ in range(60):  # Newton steps
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (cost * (p - y)) + toxicity.PENALTY * w
        w -= np.linalg.solve(x.T @ (x * (cost * p * (1 - p))[:, None]) + toxicity.PENALTY * np.eye(len(w)), slope)
    assert np.flatnonzero(model.weight).tolist() == [g for g, v in zip(seen, w) if ratio[g] and abs(v * ratio[g]) > 0]
    for text in [*texts, "", "nice awful day", "quite other words"]:
        z = constant * w[-1] + sum(w[seen.index(g)] * ratio[g] for g in (plain_ngrams(text) if text else ()) if g in ratio)
        assert model.score(text) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-2)


def test_labels_are_no_input(spark):
    """Labels of held-out ids change nothing."""
    docs = spark.createDataFrame([(k, f"text number {k} " + "awful nonsense " * (k % 2)) for k in range(60)], "doc_id long, text string")
    known = [(k, k % 2) for k in range(60)]
    models = []
    for flipped in (0, 1):
        labels = spark.createDataFrame([(k, t ^ (flipped if crc(k, 3) == 1 else 0)) for k, t in known], "doc_id long, toxic int")
        models.append(toxicity.train(docs, labels, toxicity.may_learn()))
    assert (models[0].weight == models[1].weight).all() and models[0].bias == models[1].bias
    assert models[0].score("awful nonsense") > 0.5 > models[0].score("text number")


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "x" * 300_000, "c"), (3, "\U0001f600 é", "d")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 0)], "doc_id long, toxic int")
    for labels in (none, odd):
        model = toxicity.train(docs, labels)
        scores = toxicity.score_toxicity(docs, model).collect()
        assert len(scores) == 5 and len({r.score for r in scores}) == 1 and 0 < scores[0].score < 1
        assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_languages_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op10_language"](spark, FOLDER).collect()}
    rows = duckdb.sql(f"SELECT doc_id, lang, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert len(got) == len(rows) and all(r.held_out == (crc(k, 4) == 2) for k, r in got.items())
    held = [got[k].lang_pred == lang for k, lang, text in rows if crc(k, 4) == 2 and langid.has_letter(text)]
    assert len(held) > 150 and np.mean(held) > 0.97


def plain_model(texts):
    """Kneser-Ney probabilities by the textbook, for one language: p(c | h), plain dictionaries."""
    grams = {}
    for text in texts:
        letters = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split()) + " "
        for k in range(len(letters) - 3):
            grams[letters[k : k + 4]] = grams.get(letters[k : k + 4], 0) + 1
    tables = {4: grams}
    for n in (3, 2, 1):
        tables[n] = {}
        for g in tables[n + 1]:
            tables[n][g[1:]] = tables[n].get(g[1:], 0) + 1

    def probability(gram, letters):
        n = len(gram)
        if not n:
            return 1 / letters
        t = tables[n]
        once, twice = sum(v == 1 for v in t.values()), sum(v == 2 for v in t.values())
        d = once / (once + 2 * twice) if once and twice else 0.5
        after = [v for g, v in t.items() if g[:-1] == gram[:-1]]
        lower = probability(gram[1:], letters)
        if not after:
            return lower
        return max(t.get(gram, 0) - d, 0) / sum(after) + d * len(after) / sum(after) * lower

    return probability


def test_probabilities_by_the_textbook(spark):
    texts = {"x": ["the cat sat on the mat", "The dog, the log"], "y": ["le chat est la", "été là-bas"]}
    rows = [(k, t, lang) for lang, some in texts.items() for k, t in enumerate(some)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["x", "y"]
    letters = len({c for some in texts.values() for t in some for c in " " + t.lower() if c.isalpha() or c == " "}) + 1
    for j, lang in enumerate(model.langs):
        plain = plain_model(texts[lang])
        for gram in ("the ", "he c", " été", "zzzz", "at q", "la "[:3] + "x"):
            key = np.array([sum(ord(c) << 16 * (3 - k) for k, c in enumerate(gram))], np.uint64)
            assert np.exp(model.log_probabilities(4, key)[0, j]) == pytest.approx(plain(gram, letters), rel=1e-9)


def test_language_odd_rows(spark):
    rows = [(1, "Hello there my friend", "en"), (3, "Bonjour mon cher ami", "fr"), (5, None, "en"), (6, "no language", None), (7, "", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    odd = [(1, None, "s"), (2, "", "s"), (2, "", "s"), (3, "123 !?", "s"), (None, "my friend " * 20_000, "s"), (4, "\U00010400\U00010401 a\0b", "s"), (5, "ami", "s")]
    found = langid.identify(spark.createDataFrame(odd, "doc_id long, text string, score string"), model).collect()
    assert [r.lang_pred for r in found[:4]] == ["und"] * 4 and len(found) == 7
    assert found[4].lang_pred == "en" and found[6].lang_pred == "fr" and all(0 <= r.score <= 1 for r in found)
    assert langid.train(docs.limit(0)) is None
    assert [r.lang_pred for r in langid.identify(docs, None).collect()] == ["und"] * 5
    assert langid.identify(docs.limit(0), model).count() == 0


def test_rare_runs_back_off_where_tables_are_full(spark, monkeypatch):
    monkeypatch.setattr(langid, "STORED", 60)
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("the cat and the dog " * 5 + "xylophone zebra", "en"), ("le chat et le chien " * 5, "fr")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert 0 < len(model.runs[3].hashes) <= 60
    assert [r.lang_pred for r in langid.identify(docs, model).collect()] == ["en", "fr"]


def test_languages_keep_every_run_beyond_the_stored_ones(spark, monkeypatch):
    """Tables joined in Spark give what whole tables give; rare runs and the statistics of all runs count."""
    words = {"en": "the cat and dog walked home over green fields", "fr": "le chat et chien marche vers la maison verte", "de": "die katze und der hund laufen nach hause"}
    rows = [(k, " ".join(text.split()[k % 5 :] + [f"{chr(97 + k % 26)}{chr(97 + k * 7 % 26)}q{chr(98 + k % 9)}é" * 2]), lang) for k in range(30) for lang, text in words.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    odd = [(1, None), (2, "123"), (3, "le chat zzqx"), (3, "le chat zzqx"), (4, "a"), (5, "Ωμέγα der hund " * 50), (None, "the xylophone")]
    asked = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))

    def result(model):
        return sorted((str(r.doc_id), str(r.text), r.lang_pred, r.score, r.rejected) for r in langid.identify(asked, model).collect())

    model = langid.train(docs)
    want = result(model)
    for stored in (40, 0):
        monkeypatch.setattr(langid, "STORED", stored)
        other = langid.train(docs)
        assert len(other.runs[3].hashes) <= stored < len(model.runs[3].hashes) == other.rest.runs[3].count()
        assert other.sharpness == model.sharpness and other.limit == pytest.approx(model.limit)
        got = result(other)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-9)
        # the limit is the cost of a text, whose last digits may differ
        assert sum(g[4] != w[4] for g, w in zip(got, want)) <= 1


def test_quantiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(langid, "BINS", 3)
    for some in ([2.0], [1.0, 1.0, 1.0], [5e-324, 0.0, 1.0, 1.0 + 2**-52, 1e300], [float(k * k % 101) for k in range(300)]):
        for share in (0.0, 0.31, 0.5, 0.999, 1.0):
            assert langid.quantile(spark.createDataFrame([(x,) for x in some], "x double"), share) == pytest.approx(np.quantile(some, share), rel=1e-12)


def test_all_training_texts_calibrate(spark, monkeypatch):
    """Sharpness and limit are those of every text that may teach, a repeated id's too, in tables and beyond them."""
    monkeypatch.setattr(langid, "CALIBRATION", 3)
    words = {"en": "the cat and dog walked home over green fields".split(), "fr": "le chat et chien marche vers la maison verte".split()}
    rows = [(k % 20, " ".join(words[lang][k % 7 :][: 1 + k % 3] + words[other][: k % 4]), lang) for k in range(60) for lang, other in (("en", "fr"), ("fr", "en"))]
    rows += [(None, "xq zz the", "fr"), (7, None, "en"), (8, "maison", None), (9, "12", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    taught = [(t, lang) for _, t, lang in rows if t and lang and langid.has_letter(t)]
    cost = model.cross_entropies([t for t, _ in taught])
    true = cost[np.arange(len(taught)), [model.langs.index(lang) for _, lang in taught]]
    loss = {s: np.mean(np.log(np.exp(-s * (cost - true[:, None])).sum(axis=1))) for s in langid.SHARPNESS}
    assert model.sharpness == min(loss, key=loss.get)
    assert model.limit == pytest.approx(np.quantile(true, langid.REJECT))
    monkeypatch.setattr(langid, "STORED", 40)
    beyond = langid.train(docs)
    assert beyond.rest and beyond.sharpness == model.sharpness and beyond.limit == pytest.approx(model.limit)


def test_samples_are_bounded_where_an_id_repeats(spark, monkeypatch):
    rows = [(k if k % 3 else 0, f"text {k % 200} of the house", "en") for k in range(600)] + [(None, "no id", "en")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 2)) for k in range(600) if k % 3 or not k], "doc_id long, toxic int")
    got = toxicity.sample(docs, labels, None).collect()
    assert len(got) == len({k for k, _, _ in rows if k is not None}) == 401
    assert toxicity.sample(docs, labels, None, 20).count() == 20
    assert sorted(got) == sorted(toxicity.sample(docs.repartition(7), labels, None).collect())
    assert langid.calibration_rows(docs).count() == 402
    monkeypatch.setattr(langid, "CALIBRATION", 30)
    assert langid.calibration_rows(docs).count() == 30
