"""The pipeline's language stage keeps code-switched documents and drops what is in no learned language."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from lotgraph.llm import language_id

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the of and to that with this from have which", "de": "der die und nicht sich auf für ist eine über", "fr": "le la les des une que est pour dans été"}


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(5)
    made = {k: w.split() + ["".join(r.choice(w.split()) for _ in range(2)) for _ in range(60)] for k, w in WORDS.items()}
    text = lambda k, n: " ".join(r.choice(made[k]) for _ in range(n))
    rows = [(i, text(k, r.randint(30, 80)), k) for i, k in enumerate(list(WORDS) * 50)]
    rows += [(900, f"{text('en', 40)}\n{text('de', 30)}\n{text('fr', 30)}", "en"), (901, "это предложение на русском языке " * 5, None), (902, "12 -- ?", "en"), (903, None, "en")]
    return spark.createDataFrame([(i, t, k, "s", len(t or "")) for i, t, k in rows], SCHEMA)


def test_three_clean_languages_stay(spark, docs):
    model = language_id.fit(docs, F.lit(True))
    mixed = language_id.predict(docs.where("doc_id = 900"), model, familiar=True).first()
    assert mixed.score < 0.5 and mixed.familiar > 0.95
    assert {x.doc_id for x in cp.identify_language(spark, docs, "").select("doc_id").collect()} == {*range(150), 900}
