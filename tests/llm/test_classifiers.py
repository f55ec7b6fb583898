import random

import numpy as np

from tapflow.llm import langid, quality, toxicity

TARGET_LEX = toxicity.Lexicon(exact={"idiot": 3.0}, prefix={"grob": 2.0})


def arcs(text):
    return [a for a, _ in toxicity.matches(text, toxicity.Symbols(TARGET_LEX))]


def test_grammar_marks_clauses():
    assert arcs("What an idiot.") == ["insult"]
    assert arcs("You are an idiot.") == ["insult_target"]
    assert arcs("idiot, all of you") == ["insult_target"]
    assert arcs("He is not an idiot.") == ["insult_negated"]
    assert arcs("She said idiot. Idiot!") == ["insult_reported", "insult"]       # a scope ends with its clause
    assert arcs("ein grober Satz") == ["insult"]
    assert arcs("I will kill you") == ["threat_target"]
    assert arcs("this will kill time") == []                                     # no target, no match
    assert arcs("they said he would kill you") == ["threat_hedged"]
    assert arcs("") == []


def test_grammar_weights_order_the_scores():
    model = toxicity.ToxicityModel(TARGET_LEX)
    x = np.array([toxicity.evidence(t, toxicity.Symbols(TARGET_LEX)) for t in
                  ("fine words", "not an idiot", "an idiot", "you idiot", "you idiot. you idiot.")])
    s = model.scores(x)
    assert (np.diff(s) > 0).all() and (0 <= s).all() and (s <= 1).all()


def labelled(spark, n, make):
    rng = random.Random(5)
    rows = [(i, *make(rng, i)) for i in range(n)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, y int")
    return docs, labels


def prose(rng, n=30):
    return " ".join("".join(rng.choice("abdeilnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_toxicity_learns_words_and_beginnings(prepared):
    def make(rng, i):
        t = prose(rng).split()
        if bad := i % 5 == 0:
            t.insert(rng.randrange(len(t)), "moron" if i % 2 else "qvaz" + prose(rng, 1))
        return " ".join(t), int(bad)
    docs, labels = labelled(prepared, 400, make)
    model = toxicity.fit_toxicity(docs, labels.where("doc_id < 200"), label_col="y")
    assert "moron" in model.lexicon.exact and "qvaz" in model.lexicon.prefix
    held = toxicity.score_toxicity(docs.where("doc_id >= 200"), model).join(labels, "doc_id").collect()
    assert all((r.score >= 0.7) == bool(r.y) for r in held)


def test_toxicity_edges(prepared, docs, no_docs):
    none = prepared.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, none)
    assert toxicity.fit_toxicity(no_docs, none) == model
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score < 0.7 and r.n_matches == 0 for r in got)
    assert toxicity.score_toxicity(no_docs, model).count() == 0


def test_language_backoff(prepared):
    rng = random.Random(3)
    sound = {"en": "the of and thing with".split(), "de": "der und ung schaft nicht".split()}
    rows = []
    for i in range(120):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join(rng.choice(sound[lang]) + rng.choice(sound[lang]) for _ in range(12)), lang))
    train = prepared.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(train)
    probe = prepared.createDataFrame(
        [(1, "thethethe ofofthing withthingthe"), (2, "ungundung schaftderung"), (3, None), (4, "12 !! _"), (5, ""),
         (6, "日本"), (7, "²")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict_languages(probe, model).collect()}
    assert [got[i].lang_pred for i in range(1, 8)] == ["en", "de", "und", "und", "und", got[6].lang_pred, "und"]
    assert got[6].lang_pred in ("en", "de") and all(0 <= r.score <= 1 for r in got.values())
    # an unseen word is scored by its longest known n-grams, a known one by itself
    assert (model.word_vector("thething") == model.table[model.rows["wthething"]]).all()
    known = [model.rows[f"4{g}"] for g in langid.grams("thingthething", 4) if f"4{g}" in model.rows]
    assert np.allclose(model.word_vector("thingthething"), model.table[known].mean(0))


def test_language_edges(docs, no_docs):
    empty = langid.fit_languages(no_docs)
    assert {r.lang_pred for r in langid.predict_languages(docs, empty).collect()} == {"und"}
    model = langid.fit_languages(docs)
    got = langid.predict_languages(docs, model).collect()
    assert len(got) == docs.count()
    assert {r.lang_pred for r in got if r.doc_id in (3, 4, 12, 13)} == {"und"}
    assert langid.predict_languages(no_docs, model).count() == 0


def test_quality_learns_subwords(prepared):
    def make(rng, i):
        t = prose(rng).split()
        if i % 4 == 0:
            t = [w + "%%%" for w in t] if i % 8 else [t[0]] * 15 + [t[1]] * 15
        return " ".join(t), int(i % 4 != 0)
    docs, labels = labelled(prepared, 480, make)
    model = quality.fit_quality(docs, labels.where("doc_id < 240"), label_col="y")
    held = quality.score_quality(docs.where("doc_id >= 240"), model).join(labels, "doc_id").collect()
    assert np.mean([(r.score >= 0.5) == bool(r.y) for r in held]) > 0.95


def test_quality_folding_equals_the_network():
    rng = np.random.default_rng(1)
    model = quality.QualityModel(rng.normal(size=quality.BUCKETS).astype(np.float32), 0.3)
    for text in ("a b b c", "One  two two\nthree%%%", "x"):
        at, share = quality.document_features(text, quality._TokenBuckets())
        assert np.isclose(quality._Folded(model).average(text), float(share @ model.fold[at]), atol=1e-4)


def test_quality_edges(prepared, docs, no_docs):
    none = prepared.createDataFrame([], "doc_id long, quality int")
    assert quality.fit_quality(docs, none).bias == 0.0
    one = prepared.createDataFrame([(1, 1)], "doc_id long, quality int")
    got = quality.score_quality(docs, quality.fit_quality(docs, one)).collect()
    assert len(got) == docs.count() and all(0.99 < r.score <= 1 for r in got)
    assert quality.score_quality(no_docs, quality.QualityModel()).count() == 0


def test_every_known_word_counts(prepared):
    """200,000 words that the training rows hold twice each, a text of one of
    them: the word decides, whether it is broadcast or joined, though its
    n-grams say nothing (they are as frequent in either language)."""
    # letters for digits; the language follows a hash of the word
    word = "translate(cast(id as string), '0123456789', 'abcdefghij')"
    known = prepared.range(200_000).selectExpr(f"{word} AS word", f"IF(crc32(cast({word} as binary)) % 2 = 0, 'en', 'de') AS lang", "id")
    train = known.selectExpr("id AS doc_id", "concat(word, ' ', word) AS text", "lang")
    model = langid.fit_languages(train)
    probe = known.where("id % 1000 = 7").selectExpr("id AS doc_id", "word AS text", "lang")
    for most in (langid.BROADCAST_WORDS, 20):
        got = langid.predict_languages(probe, model, broadcast_words=most).join(probe, "doc_id").collect()
        assert len(got) == 200 and all(r.lang_pred == r.lang for r in got)


def test_broadcast_and_joined_words_give_the_same(prepared, docs):
    model = langid.fit_languages(docs)
    texts = docs.unionByName(docs.selectExpr("doc_id + 100 AS doc_id", "concat(text, ' unseenword brownish') AS text", "lang", "source",
                                             "n_chars", "kept", "score")).withColumn("held_out", docs["kept"])
    runs = [sorted((str(r.doc_id), r.lang_pred, round(r.score, 6)) for r in
                   langid.predict_languages(texts, model, broadcast_words=most).collect()) for most in (500_000, 5, 0)]
    assert runs[0] == runs[1] == runs[2]
    # by the model's own backoff, one text after the other
    for r in texts.where("doc_id > 100 and doc_id < 110").collect():
        tokens = langid.letter_words(r.text or "")
        total = sum((model.word_vector(t) for t in tokens), np.zeros(len(model.languages)))
        if np.ptp(total) > 0:
            z = total / len(tokens) * min(len(tokens), langid.EVIDENCE_WORDS)
            want = (model.languages[int(z.argmax())], float(1 / np.exp(z - z.max()).sum()))
            got = [(p, s) for i, p, s in runs[0] if i == str(r.doc_id)]
            assert got[0][0] == want[0] and abs(got[0][1] - want[1]) < 1e-4
