"""Toxicity and language identification: held-out accuracy and defined cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesmart.llm import language_id as lid
from salesmart.llm import toxicity as tox
from salesmart.llm.queries import QUERIES
from tests.conftest import SF01

SF1 = "/root/testdata/sf0.1"


def test_toxicity_on_held_out_documents(spark):
    got = QUERIES["op7_toxicity"](spark, SF1).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF1}/labels.parquet").toPandas().dropna(subset=["toxic"]).set_index("doc_id")["toxic"]
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.5)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in got["held_out"].items())
    both = got.join(labels, how="inner")
    held = both[both["held_out"]]
    wrong = (held["predicted"] != held["toxic"])
    assert wrong.mean() < 0.06
    assert wrong[held["toxic"] == 0].mean() < 0.04


def test_unseen_misspellings_share_subwords():
    rng = np.random.default_rng(0)
    clean = [" ".join(f"word{k}" for k in rng.integers(0, 300, 60)) for _ in range(300)]
    bad = [t + " " + w + " word1 word2" for t, w in zip(clean[:150], ["nastiest", "dreadfulness", "horribleton"] * 50)]
    gain, bias = tox.train(clean + bad, np.array([0] * 300 + [1] * 150))
    score = tox.window_scores(pa.array(["word5 word6", "word5 nastiestt word6", "word9 dreadfulnes word3",
                                        " ".join(["word7"] * 5000) + " horribletonn", "", None]), gain, bias)
    assert score[0] < 0.5 < min(score[1], score[2], score[3])
    assert score[4] == score[5] < 0.5
    again, bias_again = tox.train(clean + bad, np.array([0] * 300 + [1] * 150))
    assert (again == gain).all() and bias == bias_again


def test_toxicity_defined_cases(spark, documents, no_documents):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (4, None, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    frame = documents[0]
    assert tox.fit_model(frame, none) is None
    flat = tox.score_documents(frame, None).collect()
    assert len(flat) == len(documents[1]) and all(r.score == 0 and r.predicted == 0 for r in flat)
    model = tox.fit_model(frame, labels)
    assert tox.score_documents(frame, model).count() == len(documents[1])
    assert tox.score_documents(no_documents, model).isEmpty()
    kept = tox.drop_toxic(frame, none)
    assert kept.columns == frame.columns and kept.count() == len(documents[1])
    repeated = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert tox.score_documents(repeated, model).count() == 3


def test_language_on_held_out_documents(spark):
    got = QUERIES["op4_language_id"](spark, SF01).toPandas().set_index("doc_id")
    truth = spark.read.parquet(f"{SF01}/documents.parquet").toPandas().set_index("doc_id")
    assert len(got) == len(truth) and got["score"].between(0, 1).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in got["held_out"].items())
    held = got[got["held_out"]].join(truth["lang"])
    assert (held["lang_pred"] == held["lang"]).mean() > 0.98


def test_language_defined_cases(spark, documents, no_documents):
    en, de = [i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    rows = [(en, "the cat and the dog and the bird", "en"), (de, "der hund und die katze und der vogel", "de"),
            (9, None, "en"), (12, "", "de"), (15, "1234 !?", None), (18, "the dog", None), (None, "und der vogel", None),
            (18, "the dog", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [tuple(r) for r in lid.predict_languages(frame).collect()]
    assert len(got) == len(rows)
    by = {r[0]: r for r in got}
    assert [by[i][2:] for i in (9, 12, 15)] == [("und", 0.0)] * 3
    assert by[18][2] == "en" and by[None][1] is False and by[None][2] == "de"
    assert lid.predict_languages(no_documents).isEmpty()
    unlabelled = frame.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lid.predict_languages(unlabelled).collect()} == {"und"}
    assert lid.predict_languages(documents[0]).count() == len(documents[1])


@pytest.mark.parametrize("text", ["abc", "ab cd", "été à Żółw", "日本語 テスト", "a", " x  y "])
def test_bundles_are_sums_of_bound_permuted_letters(text):
    def signs(ch):
        if ch == " ":
            bits = lid.letter_vectors(np.array([0]))
        else:
            bits = lid.letter_vectors(np.array([ord(ch)]))
        return np.unpackbits(bits.view(np.uint8), bitorder="little").astype(int) * 2 - 1

    padded = " " + " ".join(text.lower().split()) + " "
    want = sum(np.roll(signs(a), 2) * np.roll(signs(b), 1) * signs(c)
               for a, b, c in zip(padded, padded[1:], padded[2:]))
    (_, _, lettered, rows, index, grams), = lid.grams_of(pa.array([text]), lid.Symbols())
    got = lid.bundles(rows, index, grams, 1)[0]
    # Signs of an exclusive-or are the negated product of two signs, so three factors keep theirs.
    assert lettered[0] and (got == want).all()
