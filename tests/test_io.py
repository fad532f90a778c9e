import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotgraph.plans import report
from lotgraph.sources import files, recognition
from lotgraph.streaming import runs

RECORD = "ord int, project_name string, project_code string, lot_code string, lot_name string, company_name string, award_status string, rank string, category string, source_path string, source_pages string, extraction_method string, evidence string, confidence double, review_status string, generated_at string"


def test_csv_round_trip(spark, tmp_path):
    row = (1, "项目,\"甲\"", "P", "L", "", "甲公司", "是", "1", "bid_list", "f", "1", "text", "line\nbreak", 1.2, "通过", "2024-01-01")
    path = str(tmp_path / "final.csv")
    files.write_records(spark.createDataFrame([row], RECORD), path)
    assert open(path, "rb").read(3) == b"\xef\xbb\xbf"
    got = files.read_records(spark, path).first()
    assert (got.project_name, got.evidence, got.confidence) == (row[1], row[12], 1.0)
    files.write_by_category(spark.createDataFrame([row], RECORD), str(tmp_path), ["bid_list", "award_notice"])
    assert files.read_records(spark, str(tmp_path / "award_notice.csv")).count() == 0
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n", encoding="utf-8-sig")
    with pytest.raises(ValueError):
        files.read_records(spark, str(tmp_path / "bad.csv"))


def test_tree_pages_and_cache(spark, tmp_path):
    (tmp_path / "x").mkdir()
    for name, data in (("x/a.PDF", b"one"), ("b.pdf", b"bad"), ("c.txt", b"")):
        (tmp_path / name).write_bytes(data)
    found = files.document_tree(spark, str(tmp_path), content=True)
    assert found.count() == 2 and "content" not in files.document_tree(spark, str(tmp_path)).columns

    def reader(path, data):
        if data == b"bad":
            raise OSError("broken")
        return [{"doc_path": path, "page_number": 1, "error": None}]

    got = files.read_pages(found, reader, "doc_path string, page_number int, error string").collect()
    assert sorted(str(r.error) for r in got) == ["None", "OSError: broken"]
    pages = spark.createDataFrame([("h", 1, 300, "p"), ("h", 2, 300, "p")], "sha256 string, page_number int, dpi int, profile string")
    files.add_to_cache(pages.where("page_number = 1").withColumn("text", F.lit("t")), str(tmp_path / "cache"))
    hits, misses = files.cached(pages, spark.read.parquet(str(tmp_path / "cache")))
    assert (hits.count(), misses.count()) == (1, 1)


def test_recognition(spark):
    class Fake:
        def prepare(self):
            pass

        def recognize(self, image):
            return [("投标文件 项目名称 投标人：甲建设有限公司" if image.shape[0] > 10 else "x", 0.9, [])]

    pages = spark.createDataFrame([("d", 1, 300)], "doc_path string, page_number int, dpi int")
    read = recognition.recognize(pages, Fake, lambda p, n, d: np.zeros((16, 8, 3), np.uint8))
    best = recognition.best_variant(read).first()
    assert best.variant in ("original", "no_seal") and best.company == "甲建设有限公司" and best.again
    red = np.full((2, 2, 3), 10, np.uint8)
    red[0, 0] = (250, 20, 20)
    assert recognition.without_red_seal(red)[0, 0].tolist() == [255, 255, 255] and recognition.without_red_seal(red)[1, 1].tolist() == [10, 10, 10]
    votes = spark.createDataFrame([("d", "甲", 5.0, 0.5), ("d", "乙", 5.0, 0.4), ("d", "乙", 4.0, 0.4)], "doc_path string, name string, score double, confidence double")
    assert recognition.company_vote(votes).first().name == "乙"


def test_report():
    text = "{{#rows}}{{name}};{{/rows}}{{#none}}x{{/none}}{{title}}"
    assert report.fill(text, {"rows": [{"name": "a"}, {"name": "b"}], "title": "t"}) == "a;b;t"
    with pytest.raises(ValueError):
        report.render("{{missing}}", {})
    with pytest.raises(ValueError):
        report.check_document({"summary": {}})


def test_json_source(spark, tmp_path):
    files.write_json({"runId": "r", "summary": {"n": 1}}, str(tmp_path / "a.json"))
    assert json.loads((tmp_path / "a.json").read_text())["runId"] == "r"
    assert files.read_json(spark, str(tmp_path / "a.json"), "runId string, summary struct<n:int>").first().summary.n == 1


def test_stream_twins(spark, tmp_path):
    rows = [(r, i, f"2024-01-01 0{i}:00:00" if r else f"2024-01-01 00:0{i}:00", k) for r in (0, 1) for i, k in enumerate("aab")]
    df = spark.createDataFrame(rows, "run_id long, event_id long, ts string, event_type string").withColumn("ts", F.to_timestamp("ts"))
    for part in range(3):  # three batches, in order
        df.where(F.col("event_id") == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = []
    query = runs.run_states(stream).writeStream.foreachBatch(lambda b, n: out.append({r.run_id: r for r in b.collect()})).option("checkpointLocation", str(tmp_path / "log")).outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = {r.run_id: r for r in runs.run_states_batch(df).collect()}
    last = {k: v for b in out for k, v in b.items()}
    assert len(out) == 3
    for r in (0, 1):
        assert (last[r].events, last[r].changes, last[r].last_state, last[r].stalled) == (batch[r].events, batch[r].changes, batch[r].last_state, batch[r].stalled) == (3, 2, "b", bool(r))
    warnings = []
    runs.on_each_batch(lambda b: 1 / 0, warnings)(df, 4)
    assert warnings and warnings[0].startswith("batch 4")
