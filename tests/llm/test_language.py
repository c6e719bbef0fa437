"""Language spans: the best path against brute force, scripts, held-out accuracy, edge rows."""

from itertools import product

import numpy as np
import pytest

from tallybridge.llm import language, queries


def test_best_paths_as_brute_force():
    draw = np.random.default_rng(3)
    sizes = np.array([3, 0, 6, 1, 5])
    scores = draw.integers(-9, 0, (sizes.sum(), 3)).astype(np.float32)
    found = language.best_paths(scores, sizes, switch=4)
    at = 0
    value = lambda part, path: sum(part[i, p] for i, p in enumerate(path)) - 4 * sum(a != b for a, b in zip(path, path[1:], strict=False))
    for size in sizes:
        part, path = scores[at : at + size], found[at : at + size].tolist()
        if size:
            assert value(part, path) == max(value(part, p) for p in product(range(3), repeat=size))
        at += size


def model_of(texts):
    counts = {}
    for lang, text in texts.items():
        words = language.Words([text])
        row = counts.setdefault(lang, np.zeros(language.GRAMS + language.OTHER + 1))
        row[: language.GRAMS] += np.bincount(words.gram, minlength=language.GRAMS)
        row[language.GRAMS :] += np.bincount(words.script, words.letters, language.OTHER + 1)
    return language.Model(counts)


TEXTS = {
    "en": "the house and the river with which they were never seen " * 20,
    "de": "das haus und der fluss mit denen sie nicht gesehen wurden " * 20,
    "ru": "дом и река которые они никогда не видели раньше " * 20,
}


def test_mixed_text_has_spans_and_scripts_rule_out():
    model = model_of(TEXTS)
    texts = ["the river and the house они никогда не видели das haus und der fluss", "видели", "xx東京"]
    words = language.Words(texts)
    found = language.labelled(model.languages, words.text, words.start, words.size, words.letters, model.word_scores(words), 3)
    assert [(s["lang"], texts[0][s["start"] : s["end"]]) for s in found["spans"][0]] == [
        ("en", "the river and the house"), ("ru", "они никогда не видели"), ("de", "das haus und der fluss")
    ]
    assert found["lang_pred"][1] == "ru" and found["score"][1] == 1
    latin = [model.languages.index(x) for x in ("en", "de")]
    assert (model.word_scores(language.Words(["видели"]))[0, latin] < -1e5).all()


def test_words_are_runs_of_one_script():
    words = language.Words(["Ab, c1д東x", "", "é́ 🙂𐐷"])
    assert list(zip(words.text.tolist(), words.start.tolist(), words.size.tolist(), strict=True)) == [
        (0, 0, 2), (0, 4, 1), (0, 6, 1), (0, 7, 1), (0, 8, 1), (2, 0, 2), (2, 4, 1)
    ]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = queries.op4_language(spark, sf).join(langs, "doc_id").filter("held_out").toPandas()
    assert len(rows) > 200 and (rows.lang == rows.lang_pred).mean() > 0.95
    assert rows.score.between(0, 1).all()


def test_a_text_longer_than_a_portion(monkeypatch):
    text = TEXTS["en"]
    whole = language.Words([text])
    monkeypatch.setattr(language, "CHARS", 70)
    places = [(p + s, n) for _, at, parts in language.portions([None, text]) for words in [language.Words(parts)] for p, s, n in zip([at[t] for t in words.text], words.start.tolist(), words.size.tolist(), strict=True)]
    assert places == list(zip(whole.start.tolist(), whole.size.tolist(), strict=True))


@pytest.mark.parametrize("words", [1 << 20, 5])
def test_edge_rows(edge, nothing, monkeypatch, words):
    monkeypatch.setattr(language, "WORDS", words)
    model = language.learn(edge)
    assert model.languages == ["en", "fr"]
    found = language.identify(edge, model).collect()
    assert len(found) == edge.count()
    by_id = {r.doc_id: (r.lang_pred, r.score, len(r.spans)) for r in found}
    assert by_id[3] == by_id[4] == by_id[5] == ("und", 0.0, 0)
    assert by_id[1][0] == by_id[7][0] == "en" and by_id[8][0] == "fr"
    assert language.identify(nothing, model).count() == 0
    untaught = language.learn(nothing)
    assert {(r.lang_pred, r.score) for r in language.identify(edge, untaught).collect()} == {("und", 0.0)}
