"""Every language value is learned, however many there are."""

from pyspark.sql import functions as F

from lotgraph.llm import language_id


def test_more_than_two_hundred_labels(spark):
    df = spark.createDataFrame([(i, f"{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + i // 26)}", f"l{i:03}") for i in range(203)], "doc_id long, text string, lang string")
    assert language_id.fit(df, F.lit(True)).labels == [f"l{i:03}" for i in range(203)]
