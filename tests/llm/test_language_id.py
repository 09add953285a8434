"""Operator 11: vectors against brute force, held-out accuracy, rejection, defined cases."""

import collections
import math

import numpy as np
import pytest

from tests.conftest import SF_CHECK
from tests.llm import data
from vireo.llm import language_id as li
from vireo.llm import queries

WORDS = {"en": "the of and to in that was with for this house water people morning little under", "de": "der die und nicht ein auch ist von das haus wasser leute morgen klein unter über",
         "el": "και το να με για από που σε είναι νερό σπίτι άνθρωποι πρωί μικρό κάτω δεν"}


def text(lang, n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang].split(), n))


def labelled(per=60):
    rows, i = [], 0
    for lang in WORDS:
        for k in range(per):
            i += 1
            rows.append((i, text(lang, 5 + k, i), lang))
    return rows


def frame(spark, rows, parts=3):
    return data.frame(spark, [(i, t, lang, "s", None, *["x"] * 9) for i, t, lang in rows], parts=parts)


def plain_grams(value):
    """n-grams of one to three by plain Python."""
    out = " "
    for c in value.lower():
        out += c if c.isalpha() else "" if out.endswith(" ") else " "
    out += "" if out.endswith(" ") else " "
    return collections.Counter(g for n in (1, 2, 3) for g in (out[i:i + n] for i in range(len(out) - n + 1)) if g != " ")


def test_counts_are_those_of_plain_grams(monkeypatch):
    samples = ["The cat, the CAT!", "a", "élan  vital\n\nx", "  1 2 3 a4b  ", text("el", 50, 1), "ß" * 40]
    slots = 1 << 20  # wide enough that these grams share no slot
    known = {}
    for value in samples:
        for cut in (7, 1 << 20):
            monkeypatch.setattr(li, "SLICE", cut)
            got = li.counts(li.letters(value), slots)
            want = plain_grams(value)
            assert sorted(got[got > 0].tolist()) == sorted(want.values())
        for g in want:
            points = np.array([ord(c) for c in g], dtype=np.uint64)
            if len(g) == 3:
                one = int(np.flatnonzero(li.counts(points, slots))[-1])
                known.setdefault(g, one)
    assert li.letters("12 !? 3") is None and li.letters("") is None


def test_document_frequencies_count_every_text(spark):
    rows = labelled(30) + [(900, None, "en"), (901, "12", "en")]
    has, n = li.document_frequencies(frame(spark, rows, parts=7))
    want = sum((li.counts(li.letters(t)) > 0).astype(int) for _, t, _ in rows if t and li.letters(t) is not None)
    assert n == 90 and (has == want).all()


def test_predictions_are_the_nearest_centroid_of_brute_force(spark):
    rows = labelled()
    model = li.fit(frame(spark, rows))
    assert model.languages == ["de", "el", "en"]
    centroids = model.by_slot.T.astype(np.float64)
    assert np.allclose(np.linalg.norm(centroids, axis=1), 1, atol=1e-5) and len(centroids) > len(model.languages)
    for r in li.classify(frame(spark, rows[::7]), model).collect():
        value = next(t for i, t, _ in rows if i == r["doc_id"])
        x = np.sqrt(li.counts(li.letters(value))) * model.idf
        cosine = centroids @ (x / np.linalg.norm(x))
        assert model.languages[model.owner[int(np.argmax(cosine))]] == r["lang_pred"]
        assert math.isclose(r["distance"], 1 - cosine.max(), abs_tol=1e-4)


def test_held_out_accuracy_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = queries.QUERIES["op11_nearest_centroid_language"](spark, SF_CHECK).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    held = got[got["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.98
    assert got["rejected"].mean() < 0.02 and got["score"].between(0, 1).all()
    right = held["lang_pred"] == held["lang"]
    assert held.loc[right, "score"].mean() > 0.9


def test_foreign_texts_are_rejected_and_known_ones_are_not(spark):
    model = li.fit(frame(spark, [r for r in labelled(200) if r[2] != "el"]))
    fresh = [(i, text(lang, 60, 10_000 + i), lang) for i in range(40) for lang in ("en", "de")]
    strange = [(1000 + i, text("el", 60, i), "el") for i in range(20)] + [(2000 + i, "".join(np.random.default_rng(i).choice(list("qxzjkvw "), 300)), "x") for i in range(20)]
    assert not any(r["rejected"] for r in li.classify(frame(spark, fresh), model).collect())
    assert all(r["rejected"] for r in li.classify(frame(spark, strange), model).collect())


def test_partitioning_and_copies_do_not_change_the_model(spark):
    rows = labelled(40)
    a = li.fit(frame(spark, rows, parts=1))
    b = li.fit(frame(spark, rows, parts=9))
    assert (a.by_slot == b.by_slot).all() and a.limits == b.limits and (a.weights == b.weights).all()
    # a language of one text that a third of all rows repeat is learned like any other
    hot = rows + [(5000 + i, "bonjour mes amis de la ville", "fr") for i in range(2000)]
    model = li.fit(frame(spark, hot))
    assert "fr" in model.languages and model.predict("bonjour mes amis de la ville")[0] == "fr"
    assert model.predict(text("el", 30, 77))[0] == "el"


@pytest.mark.parametrize("rows", [[], [(1, None, "en"), (2, "text", None)], [(1, "12 34", "en")]])
def test_nothing_to_learn(spark, rows):
    docs = frame(spark, rows)
    got = li.classify(docs.select("doc_id", "text"), li.fit(docs)).collect()
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in got] == [("und", 0.0, False)] * len(rows)


def test_language_edges(spark):
    docs = data.frame(spark, data.edge_rows())
    got = {r["doc_id"]: r for r in li.languages(docs).collect()}
    assert docs.count() == li.languages(docs).count()
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1, 2, 3))
    assert all(got[i]["lang_pred"] == "en" for i in (4, 5, 6, 7, 8, 10, 12, 14))
    one = li.fit(docs)
    kept = li.classify(docs, one)  # its own score column gives way to the result, all others stay
    assert sorted(kept.columns) == sorted([*[c for c in docs.columns if c not in ("text", "score")], "lang_pred", "score", "distance", "rejected"])
    assert kept.count() == docs.count()
