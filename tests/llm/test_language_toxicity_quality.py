from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import DOCS, doc, prose
from wanderlake.llm import langid, quality, toxicity
from wanderlake.llm.common import is_held_out


@pytest.fixture(scope="module")
def two_languages(spark):
    rows = [doc(i, prose(i, 60, lang), lang) for i, lang in enumerate(["en", "de"] * 60)]
    return spark.createDataFrame(rows, DOCS)


def kneser_ney(texts: list[str], order: int, known: set[str]):
    """Direct interpolated Kneser-Ney; characters that no language knows have equal chances."""
    alphabet = len(known) + 1
    pad = "\uffff"
    grams = Counter()
    for t in texts:
        t = pad * (order - 1) + langid.normal_form(t).translate({c: "0" for c in range(48, 58)})
        grams.update(t[i : i + order] for i in range(len(t) - order + 1))
    levels = {order: grams}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[-k:] for g in {g[-k - 1 :] for g in grams})

    def p(gram: str) -> float:
        k, counts = len(gram), levels[len(gram)]
        if k == 1:
            total = sum(counts.values())
            return max(counts[gram] - 0.75, 0) / total + 0.75 * len(counts) / total / alphabet if gram in known else 1 / alphabet
        own = {g: n for g, n in counts.items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        total = sum(own.values())
        return max(own.get(gram, 0) - 0.75, 0) / total + 0.75 * len(own) / total * p(gram[1:])

    def bits(text: str) -> float:
        t = pad * (order - 1) + langid.normal_form(text)
        n = len(t) - order + 1
        return -sum(math.log2(p(t[i : i + order])) for i in range(n)) / n

    return bits


def test_cross_entropy_equals_direct_kneser_ney(two_languages):
    models = langid.train(two_languages)
    rows = two_languages.collect()
    alphabet = {c for r in rows for c in langid.normal_form(r["text"])}
    for i, lang in enumerate(models.languages):
        direct = kneser_ney([r["text"] for r in rows if r["lang"] == lang], 4, alphabet)
        for text in ("the house is thing", "der straßen über", "zzz qqq the"):
            assert models.cross_entropies(text)[0][i] == pytest.approx(direct(text), rel=1e-3)


def test_held_out_languages(spark, two_languages):
    models = langid.train(two_languages.filter(~is_held_out()))
    rows = langid.identify(two_languages, models).filter(is_held_out()).collect()
    assert rows and all(r["lang_pred"] == r["lang"] and not r["lang_rejected"] for r in rows)


def test_language_edges(spark, edge_docs, no_docs, two_languages):
    models = langid.train(two_languages)
    rows = langid.identify(edge_docs, models).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert 0 <= r["lang_score"] <= 1 and r["size"] == "x"
        if not (r["text"] or "").strip():
            assert r["lang_pred"] == "und" and r["lang_rejected"]
    assert langid.identify(no_docs, models).count() == 0
    untrained = langid.train(no_docs)
    assert {r["lang_pred"] for r in langid.identify(edge_docs, untrained).collect()} == {"und"}


def test_no_language_is_rejected(spark, two_languages):
    models = langid.train(two_languages)
    rng = np.random.default_rng(0)
    noise = "".join(chr(c) for c in rng.integers(0x3000, 0x9000, 400))
    rows = spark.createDataFrame([doc(1, noise), doc(2, prose(500, 30)), doc(3, "1234 !!")], DOCS)
    found = {r["doc_id"]: (r["lang_pred"], r["lang_rejected"]) for r in langid.identify(rows, models).collect()}
    assert found[1][1] and found[2] == ("en", False) and found[3] == ("und", True)


def test_slices_of_a_long_text_do_not_change_its_score(two_languages, monkeypatch):
    models, text = langid.train(two_languages), prose(9, 3_000)
    whole = models.cross_entropies(text)
    monkeypatch.setattr(langid, "SLICE", 997)
    assert models.cross_entropies(text)[1] == whole[1]
    assert models.cross_entropies(text)[0] == pytest.approx(whole[0])


def test_driver_sees_no_counts_of_ngrams(two_languages, monkeypatch):
    """Kneser-Ney is grouped and joined in Spark: the driver reads finished entries and rows a language only."""
    read = []
    arrow, collect = type(two_languages).toArrow, type(two_languages).collect
    monkeypatch.setattr(type(two_languages), "toArrow", lambda df: (read.append(df.columns), arrow(df))[1])
    monkeypatch.setattr(type(two_languages), "collect", lambda df: (lambda rows: (read.append(len(rows)), rows)[1])(collect(df)))
    langid.train(two_languages)
    assert [c for c in read if isinstance(c, list)] == [["lang", "gram", "gain", "back"]] * 4
    assert all(n <= 2 for n in read if isinstance(n, int))


def test_unlearned_ngrams_are_never_taken_for_learned_ones(spark):
    """However many n-grams are known, and wherever their hashes fall."""
    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 500))) for _ in range(600)]
    models = langid.train(spark.createDataFrame([(t, "zh") for t in texts], "text string, lang string"))
    learned = np.unique(np.concatenate([langid._windows(c, 4) for t in texts for c in langid._slices(t, 4, {})]))
    unseen = np.setdiff1d(rng.integers(0, 1 << 62, 200_000).astype(np.uint64), learned)
    assert not models._find(4, unseen)[0].any()
    found, at = models._find(4, learned)
    assert found.all() and (models.keys[3][at] == learned).all()


def test_models_beyond_the_broadcast_bound_score_the_same(spark, two_languages, edge_docs, monkeypatch):
    rows = edge_docs.union(spark.createDataFrame([doc(500, "zzz qqq the 漢字 😀 12"), doc(501, prose(7, 50, "de"))], DOCS))
    added = ("doc_id", "text", "size", "lang_pred", "lang_rejected", "lang_score", "cross_entropy")

    def found(models):
        return sorted(langid.identify(rows, models).select(*added).collect(), key=lambda r: (str(r[0]), str(r[1])))

    small = langid.train(two_languages)
    monkeypatch.setattr(langid, "MOST_CELLS", 100)
    large = langid.train(two_languages)
    assert isinstance(large, langid.Tables)
    assert large.limits == pytest.approx(small.limits, rel=1e-5)
    for a, b in zip(found(small), found(large), strict=True):
        assert a[:5] == b[:5] and [x or 0 for x in a[5:]] == pytest.approx([x or 0 for x in b[5:]], rel=1e-5)


def test_rejection_is_calibrated_on_all_texts(spark):
    """Copies of few texts, and ones far more than others: every row counts."""
    texts = {"en": [prose(i, 40) for i in range(4)], "de": [prose(i, 40, "de") for i in range(3)]}
    rows = [(t, lang) for lang, own in texts.items() for t in own for _ in range(3000 if t is own[0] else 150)]
    models = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    for i, lang in enumerate(models.languages):
        bits = np.array([models.cross_entropies(t)[0][i] for t in texts[lang] for _ in range(3000 if t is texts[lang][0] else 150)])
        assert models.limits[i] == pytest.approx([bits.mean(), bits.std()], rel=1e-6)


@pytest.fixture(scope="module")
def labelled(spark):
    rows, marks = [], []
    for i in range(300):
        bad = i % 3 == 0
        sentences = [prose(i * 50 + k, 8).replace(".", "") for k in range(6)]
        if bad:
            sentences[i % 6] += " vilewordung" if i % 2 else " nastything"
        rows.append(doc(i, ". ".join(sentences)))
        marks.append((i, 1, int(bad)))
    labels = spark.createDataFrame([*marks, (None, 1, 1), (5, None, None), (10**9, 1, 1)], "doc_id long, quality int, toxic int")
    return spark.createDataFrame(rows, DOCS), labels


def test_held_out_toxicity_and_places(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    for r in toxicity.score(docs, model).filter(is_held_out()).collect():
        bad = r["doc_id"] % 3 == 0
        assert (r["toxic_score"] >= 0.5) == bad
        if bad:
            assert len(r["toxic_spans"]) == 1
            span = r["toxic_spans"][0]
            assert "vilewordung" in r["text"][span["start"] : span["end"]] or "nastything" in r["text"][span["start"] : span["end"]]


def test_inflected_words_of_a_learned_stem(spark, labelled):
    model = toxicity.train(*labelled)
    assert model.document("the and vilewordlich of")[0] > 0.5
    assert model.document(prose(77, 400))[0] < 0.5


def test_noisy_or(labelled):
    model = toxicity.train(*labelled)
    text = "the vilewordung of. and to. nastything is"
    chances = [1 / (1 + math.exp(-(model.bias + sum(model.word(w) for w in set(s.split()))))) for s in text.split(".")]
    assert model.document(text)[0] == pytest.approx(1 - math.prod(1 - p for p in chances))


def test_toxicity_edges(spark, edge_docs, no_docs, labelled):
    model = toxicity.train(*labelled)
    rows = toxicity.score(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["toxic_score"] <= 1 and r["kept"] == "x" for r in rows)
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.train(no_docs, labelled[1])
    assert {r["toxic_score"] for r in toxicity.score(edge_docs, none).collect()} == {0.0}


def test_characters_beyond_the_first_plane_are_told_apart(spark):
    adlam, chakma = "\U0001e900\U0001e901\U0001e902 " * 8, "\U00011103\U00011104\U00011105 " * 8
    private = "\ue001\ue002 " * 12
    rows = [doc(i, t, name) for i, (t, name) in enumerate([(adlam, "ff"), (chakma, "ccp"), (private, "qaa")] * 20)]
    models = langid.train(spark.createDataFrame(rows, DOCS))
    assert len(set(models.rare.values())) == 8
    found = langid.identify(spark.createDataFrame(rows, DOCS), models).collect()
    assert all(r["lang_pred"] == r["lang"] for r in found if r["lang"] != "qaa")
    assert langid._codes("\U0001f600\uf8ff", models.rare).tolist() == [0xF8FF, 0xF8FF]


def harmless(n: int, seed: int = 5) -> str:
    return ". ".join(prose(seed * 100_000 + i, 8).replace(".", "") for i in range(n)) + "."


def test_long_clean_texts_stay_clean_and_one_toxic_sentence_is_found(spark, labelled):
    model = toxicity.train(*labelled)
    clean = harmless(10_000)
    toxic = clean.replace(". ", ". he is a vilewordung and of. ", 1)
    one_line = " ".join(clean.replace(".", "").split()[:20_000])
    again = (prose(77, 8).replace(".", "") + ". ") * 20_000
    first, second, third, fourth = (model.document(t) for t in (clean, toxic, one_line, again))
    assert first[0] < 0.5 and third[0] < 0.5 and fourth[0] < 0.5 and not first[1]
    assert second[0] >= 0.5 and len(second[1]) == 1 and "vilewordung" in toxic[second[1][0][0] : second[1][0][1]]
    # The score of clean sentences does not grow with their number.
    assert model.document(harmless(5_000))[0] == pytest.approx(first[0], abs=0.1)


def test_long_labelled_texts_are_fitted(spark):
    long_clean, long_bad = harmless(3_000, 6), harmless(3_000, 7) + " a nastything here."
    rows = [doc(i, long_bad if i % 2 else long_clean) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.train(spark.createDataFrame(rows, DOCS), labels)
    assert model.document(long_bad)[0] >= 0.5 > model.document(long_clean)[0]


def test_fit_against_a_direct_likelihood(spark, labelled):
    """Screening and the fitted weights, recomputed from the texts."""
    docs, labels = labelled
    fit = toxicity.Fit(steps=600)
    model = toxicity.train(docs, labels, fit)
    marks = {r["doc_id"]: r["toxic"] for r in labels.filter(~is_held_out()).collect()}
    texts = [(r["text"], marks[r["doc_id"]]) for r in docs.filter("text IS NOT NULL").collect() if marks.get(r["doc_id"]) in (0, 1)]
    stands = {0: Counter(), 1: Counter()}
    for text, y in texts:
        stands[y].update({f for w in set(text.lower().split()) for f in toxicity.features_of(w)})
    n = Counter(y for _, y in texts)

    def z(f):
        a, b = stands[1][f] + 0.5, stands[0][f] + 0.5
        return (math.log(a / (n[1] + 1 - a)) - math.log(b / (n[0] + 1 - b))) / math.sqrt(1 / a + 1 / b)

    assert set(model.weights) == {f for f, c in stands[1].items() if c >= fit.least_docs and z(f) >= fit.least_z}
    share = n[1] / len(texts)
    scale = {1: share * len(texts) / n[1], 0: (1 - share) * len(texts) / n[0]}

    def loss(weights, bias):
        total = 0.0
        for text, y in texts:
            q = 0.0
            for _, _, sentence in toxicity.sentences(text):
                logit = bias + sum(weights.get(f, 0.0) for w in set(sentence.lower().split()) for f in toxicity.features_of(w))
                q += math.log1p(math.exp(min(logit, 50)))
            total += scale[y] * (q if y == 0 else -math.log(-math.expm1(-q)))
        return total / len(texts) + fit.ridge * sum(w * w for w in weights.values()) / 2 / max(len(weights), 1)

    best = loss(model.weights, model.bias)
    for shift in (-0.5, 0.5):
        assert loss(model.weights, model.bias + shift) >= best - 1e-4
        assert loss({f: w + shift for f, w in model.weights.items()}, model.bias) >= best - 1e-4


def naive_quality(text: str | None):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed


def test_quality_measures(spark, edge_docs, no_docs):
    extra = [doc(20, "a b c d e f g h " * 12 + "\nline one\nline one\n \n \nline one\r"), doc(21, (prose(5, 30) + "\n") * 2), doc(22, "## x | y <z> é\U0001f600 $\n")]
    docs = edge_docs.union(spark.createDataFrame(extra, DOCS))
    refs = quality.references(docs)
    rows = quality.assess(docs, refs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == naive_quality(r["text"])
        assert not (r["base_failed"] and r["kept"])
    assert quality.references(no_docs) == {} and quality.assess(no_docs, {}).count() == 0
    assert quality.assess(docs, {}).filter("kept").count() > 0


def test_references_count_the_whole_corpus(spark):
    docs = spark.createDataFrame([doc(i, prose(i, 400)) for i in range(20)] + [doc(90, "odd " + prose(1, 100, "de"), None)], DOCS)
    refs = quality.references(docs, common_share=0.01)
    words = Counter(w for r in docs.filter("lang = 'en'").collect() for w in r["text"].encode().lower().split())
    total = sum(words.values())
    assert refs["en"].total_words == total
    assert refs["en"].words == {w: n for w, n in words.items() if n >= 0.01 * total}
    assert refs["en"].classes.sum() == sum(len(r["text"]) for r in docs.filter("lang = 'en'").collect())
    assert set(refs) == {"en", ""}


def test_odd_texts_diverge(spark):
    docs = [doc(i, prose(i, 400)) for i in range(20)]
    shouted, table = prose(50, 300).upper(), " | ".join(f"{i}" for i in range(400))
    df = spark.createDataFrame([*docs, doc(100, shouted), doc(101, table), doc(102, prose(60, 25))], DOCS)
    kept = {r["doc_id"]: r["kept"] for r in quality.assess(df, quality.references(df.filter("doc_id < 100"))).collect()}
    assert all(kept[i] for i in range(20)) and kept[102]
    assert not kept[100] and not kept[101]


def test_distance():
    assert quality.distance(np.array([1.0, 0]), np.array([0, 1.0])) == pytest.approx(1)
    assert quality.distance(np.array([2.0, 2]), np.array([5, 5.0])) == pytest.approx(0)
