"""Long words and scripts without blanks are judged whole."""

import random

from pyspark.sql import functions as F

from lotgraph.llm import language_id

SCHEMA = "doc_id long, text string, lang string"
SIGNS = {"zh": "的一是不了人我在有他这为之大来以个中上们到说国和地也子时道出", "ja": "のにはをたがでてとしれさあいるうけなもこらりょく日本人大中", "th": "กขคงจชซดตถทนบปผพฟมยรลวสหอ"}


def line(r, lang, n):
    return "".join(r.choice(SIGNS[lang]) + ("\u0e31" if lang == "th" and i % 3 == 0 else "") for i in range(n))


def test_the_middle_of_a_long_word_counts():
    a, b = "x" * 40, "z" * 40
    assert sorted(language_id.features(a + "abc" + b, [])) != sorted(language_id.features(a + "def" + b, []))


def test_elements():
    assert language_id.elements("(Word),") == ["word"] and language_id.elements("12") == []
    assert language_id.elements("abc中文字。12def") == ["abc", "中文", "文字", "字", "def"]
    assert language_id.elements("กัข") == ["กัข", "ข"]


def test_lines_without_blanks_are_read_whole(spark):
    r = random.Random(4)
    rows = [(i, line(r, lang, r.randint(30, 80)), lang) for i, lang in enumerate(list(SIGNS) * 40)]
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA), F.lit(True))
    late = [(lang, other, line(r, other, 30) + line(r, lang, 300) + line(r, other, 5)) for lang in SIGNS for other in SIGNS if lang != other]
    df = spark.createDataFrame([(i, text, lang) for i, (lang, _, text) in enumerate(late)], SCHEMA)
    got = language_id.predict(df, model).collect()
    assert all(x.lang_pred == x.lang and x.n_letter_words > 300 for x in got)
