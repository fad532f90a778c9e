"""Streams that keep results, outcomes of polled runs, folded entities, the paged queue and the page fallback, each against a plain version or a count of calls."""

import itertools
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lotgraph import api
from lotgraph.functions.status import PRIORITY
from lotgraph.operators import crawl, responses, risk
from lotgraph.sources import paged, recognition
from lotgraph.streaming import polls, upserts


def test_nested_values(spark):
    rows = [
        (1, '{"a": [{"Query_Status": "Wait\\"ing, ok"}, [{"MSG": null, "code": 7}]], "status": {"state": true}}'), (2, '{"has_data": true, "x": {"hasData": "true"}}'), (3, "not json"), (4, None), (5, '{"a": "status: failed"}'), (6, "[]"),
    ]
    df = spark.createDataFrame(rows, "id int, value string")
    got = sorted((r.id, r.value) for r in responses.nested_values(df).collect())
    assert got == [(1, "7"), (1, "true"), (1, 'wait"ing, ok'), (1, '{"state":true}'), (2, "has_data")]
    assert {r.id: r.state for r in responses.response_states(df).collect()} == {1: "success", 2: "existing", 3: "unknown", 4: "unknown", 5: "unknown", 6: "unknown"}


def merged(rows):
    """Rows of one entity merged one after the other, as the fold has to give it."""
    cur = None
    for r in rows:
        if cur is None:
            cur = dict(r, messages=[r["message"]] if r["message"] else [], sources=set(r["related_sources"]), n=1)
            continue
        high = PRIORITY.get(r["status"], -1) > PRIORITY.get(cur["status"], -1)
        best, new = (r if high else cur), dict(cur)
        new |= {c: best[c] for c in ("company_type", "company_name", "status")}
        new |= {c: best[c] or cur[c] or r[c] for c in crawl.FILLED}
        new |= {c: cur[c] or r[c] for c in crawl.FIRST}
        new |= {"attempts": cur["attempts"] + r["attempts"], "poll_count": cur["poll_count"] + r["poll_count"], "database_rows": max(cur["database_rows"], r["database_rows"]), "has_data": cur["has_data"] or r["has_data"], "n": cur["n"] + 1}
        new["messages"] = list(dict.fromkeys([*cur["messages"], *([r["message"]] if r["message"] else [])]))
        new["sources"] = cur["sources"] | set(r["related_sources"])
        cur = new
    return cur


def test_fold_equals_merging_in_order(spark):
    rng = random.Random(5)
    pick = lambda *v: rng.choice(v)
    rows = [
        {"entity": f"e{min(9, int(rng.expovariate(0.5)))}", "ord": i, "status": pick(*PRIORITY, "odd"), "company_type": pick("root", "related"), "company_name": f"n{i}", "message": pick("", "a", "b", f"m{i % 9}"), "related_sources": [pick("x", "y", "z")],
         "attempts": pick(0, 1, 2), "poll_count": i % 3, "database_rows": pick(0, 5, i), "has_data": pick(False, False, True), **{c: pick("", "", f"{c}{i}") for c in (*crawl.FILLED, *crawl.FIRST)}}
        for i in range(400)
    ]
    df = spark.createDataFrame([Row(**r) for r in rows]).repartition(5)
    got = {r.entity: r for r in crawl.fold_entities(df).collect()}
    for entity in {r["entity"] for r in rows}:
        want, r = merged([x for x in rows if x["entity"] == entity]), got[entity]
        assert {c: r[c] for c in (*crawl.FILLED, *crawl.FIRST, "company_type", "company_name", "status", "attempts", "poll_count", "database_rows", "has_data")} == {c: want[c] for c in (*crawl.FILLED, *crawl.FIRST, "company_type", "company_name", "status", "attempts", "poll_count", "database_rows", "has_data")}
        assert (r.message, r.related_sources, r.n_results) == ("; ".join(want["messages"]), sorted(want["sources"]), want["n"])
    assert crawl.audit_rows(df.union(df)).count() == len(rows)


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    schema = "k int, v string, ord int"
    log = upserts.ResultLog(spark, f"{tmp_path}/log", spark.createDataFrame([], schema).schema, ["k"], "ord")
    calls = []
    handle = upserts.reconcile(log, ["k", "v"], lambda table, number: calls.append((number, table.count())))
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    assert log.current().count() == 0
    batches = [make((1, "a", 1), (1, "b", 2), (2, "c", 1)), make((1, "b", 9)), make((2, "d", 3), (3, None, 3))]
    for i, b in enumerate(batches):
        handle(b, i)
    state = lambda: sorted((r.k, r.v or "") for r in log.current().collect())
    assert state() == [(1, "b"), (2, "d"), (3, "")] and calls == [(0, 2), (2, 3)]  # batch 1 changed no column that counts
    for i, b in enumerate(batches):
        handle(b, i)
    assert state() == [(1, "b"), (2, "d"), (3, "")] and calls == [(0, 2), (2, 3)]

    def broken(table, number):
        raise RuntimeError("no report")

    with pytest.raises(RuntimeError):
        upserts.reconcile(log, ["k", "v"], broken)(make((4, "x", 1)), 3)
    handle(make((4, "x", 1)), 3)  # the batch is run again: analysis is made up for, the row is there once
    assert calls[-1] == (3, 4) and state()[-1] == (4, "x")


def test_names_are_stored_once(spark, tmp_path):
    store = upserts.store_names(spark, f"{tmp_path}/names")
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name_key string")
    for number, batch in ((0, names("a", "b", "a")), (1, names("b", "c")), (1, names("b", "c")), (0, names("a", "b"))):
        store(batch, number)
    assert sorted(r.name_key for r in upserts.stored_names(spark, f"{tmp_path}/names").collect()) == ["a", "b", "c"]


def followed(rows, limits, now):
    """The polling loop as told: one poll after the other."""
    s, names = None, [x.split()[0] for x in polls.STATE.split(", ")]
    machine = polls.Runs(limits)
    for r in rows:
        if s is None:
            s = dict.fromkeys(names) | {"started": r.at, "last_poll": r.at, "progress": r.at, "fingerprint": "", "polls": 0, "answered": False, "idle": False, "ended": False}
        at, reason = machine.deadline(s)
        if r.at >= at:
            return ("failed" if reason == "timeout" and limits.fail_at_hard else polls.pending(s["answered"], s["idle"])), reason, s["polls"], at
        if told := machine.decided(s, r):
            return *told, s["polls"], r.at
    at, reason = machine.deadline(s)
    return (("failed" if reason == "timeout" and limits.fail_at_hard else polls.pending(s["answered"], s["idle"])), reason, s["polls"], at) if at <= now else None


def test_run_outcomes_equal_the_loop(spark):
    rng, rows = random.Random(8), []
    for run in range(150):
        at = 0
        for i in range(rng.randrange(1, 60)):
            at += rng.choice((30, 60, 60, 200, 900)) * polls.SECOND
            rows.append((run, at, i, rng.random() > 0.3, rng.choice(("RUNNING",) * 30 + ("WAITING",) * 20 + ("COMPLETED", "FAILED", "CANCELLED")), rng.random() > 0.6, rng.choice((0, 3)), rng.random() > 0.5, rng.choice("aaaaab"), rng.random() < 0.01))
    schema = "run_id long, us long, poll_id long, ok boolean, phase string, terminal boolean, nodes int, begun boolean, fingerprint string, cancel boolean"
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_micros("us")).drop("us")
    reasons = set()
    for limits in (polls.Limits(hard=3000, grace=300, stall=600, silence=800), polls.Limits(hard=4000, grace=120, stall=1800, silence=3600, fail_at_hard=False)):
        got = {r.run_id: (r.status, r.reason, r.polls, r.e) for r in polls.outcomes_batch(df, limits).withColumn("e", F.unix_micros("ended_at")).collect()}
        now, of = max(r[1] for r in rows), lambda r: Row(at=r[1], **dict(zip(("poll_id", "ok", "phase", "terminal", "nodes", "begun", "fingerprint", "cancel"), r[2:], strict=True)))
        want = {run: followed([of(r) for r in each], limits, now) for run, each in itertools.groupby(rows, key=lambda r: r[0])}
        assert got == {k: v for k, v in want.items() if v}
        reasons |= {v[1] for v in got.values()}
    assert reasons >= {"cancel_requested", "outage", "failed", "completed", "stalled", "silent", "timeout"}


QUEUE = '''
import os
def fetch(run_id, page):
    open(os.path.join(os.environ["QUEUE_CALLS"], f"{page}-{os.getpid()}-{os.urandom(4).hex()}"), "w").close()
    if run_id == "gone": return None
    if run_id == "gap" and page == 3: return None
    if run_id == "short" and page == 3: return {"items": []}
    items = [{"n": i} for i in range(10 * (page - 1), min(10 * page, 47))]
    return {"items": [*items, "no object"], "total": 47, "pageSize": 10}
'''


def test_paged_queue(spark, tmp_path, monkeypatch):
    folder = os.path.dirname(os.path.abspath(paged.__file__))
    calls = tmp_path / "calls"
    calls.mkdir()
    (tmp_path / "queue_of_test.py").write_text(QUEUE.replace('os.environ["QUEUE_CALLS"]', repr(str(calls))))
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "queue_of_test.py"))
    assert folder in sys.modules["lotgraph.sources.paged"].__file__
    read = lambda run, **more: sorted(r.page for r in paged.read_queue(spark, "queue_of_test:fetch", run, **more).collect())
    assert read("all") == [1] * 10 + [2] * 10 + [3] * 10 + [4] * 10 + [5] * 7
    assert read("gap") == read("short") == [1] * 10 + [2] * 10 and read("gone") == []
    for f in calls.iterdir():
        f.unlink()
    assert read("all", pages=(4, 5)) == [4] * 10 + [5] * 7
    assert {f.name.split("-")[0] for f in calls.iterdir()} == {"1", "4", "5"}  # page 1 tells the number of pages; 2 and 3 were never asked for


def test_pages_fall_back_once(spark, tmp_path):
    calls, cache = tmp_path / "calls", f"{tmp_path}/cache"
    calls.mkdir()
    folder = str(calls)

    class Fake:
        """A model that notes each whole image it reads; the image holds the document's number and the resolution."""

        def prepare(self):
            pass

        def recognize(self, image):
            number, dpi = int(image[0, 0, 0]), int(image[0, 1, 0]) * 10
            if image.shape[0] == 20:  # crops aren't counted
                open(os.path.join(folder, f"{number}-{dpi}-{os.urandom(4).hex()}"), "w").close()
            text = "投标文件 项目名称：某县农田建设项目 投标人：江苏甲建设有限公司（盖章）" if number == 1 or dpi > 300 else "投"
            return [(text, 0.95 if len(text) > 5 else 0.2, [[0.0, 0.0]])]

    def render(path, number, dpi):
        return np.full((20, 8, 3), 0, np.uint8) + np.where(np.arange(8)[None, :, None] == 0, number if "copy" not in path else 1, dpi // 10).astype(np.uint8)

    native = "项目名称：某县高标准农田建设项目施工招标文件，投标人：江苏甲建设有限公司，建设地点位于某县某镇某村，工期九十天，质量合格。" * 2
    rows = [("a.pdf", "h1", 1, 300, None), ("copy.pdf", "h1", 1, 300, ""), ("b.pdf", "h2", 2, 300, None), ("c.pdf", "h3", 1, 300, native)]
    pages = spark.createDataFrame(rows, "doc_path string, sha256 string, page_number int, dpi int, text string")
    read = lambda: {(r.doc_path, r.page_number): r for r in recognition.read_with_fallback(pages, cache, Fake, render, "test-fallback").collect()}
    got = read()
    assert {k: (r.source, r.method) for k, r in got.items()} == {("a.pdf", 1): ("read", "ocr"), ("copy.pdf", 1): ("read", "ocr"), ("b.pdf", 2): ("read", "ocr"), ("c.pdf", 1): ("native", "text")}
    assert "农田建设项目" in got["b.pdf", 2].text  # the retry at a higher resolution was better
    made = sorted(f.name.rsplit("-", 1)[0] for f in calls.iterdir())
    assert {x.split("-")[0] for x in made} == {"1", "2"} and any(int(x.split("-")[1]) > 300 for x in made if x.startswith("2")) and not any(int(x.split("-")[1]) > 300 for x in made if x.startswith("1"))
    again = read()
    assert {k: r.source for k, r in again.items()} == {("a.pdf", 1): "cache", ("copy.pdf", 1): "cache", ("b.pdf", 2): "cache", ("c.pdf", 1): "native"}
    assert {k: r.text for k, r in again.items()} == {k: r.text for k, r in got.items()} and len(list(calls.iterdir())) == len(made)


RESULTS = "run_id string, business_key string, project_name string, project_code string, lot_code string, lot_name string, company_name string, award_status string, rank string, category string, source_path string, source_pages string, extraction_method string, evidence string, review_status string, generated_at string, confidence double"
COMPANY, PEOPLE = "record_id string, search_value string, company_name string, phone_number string, email string", "record_id string, search_value string, {0} string, {1} string"
RELATIONS = "search_value string, company_name string, source_type string, relation_type string, person_name string, position string, holding_ratio string, related_ent_id string, ord int"


def bid(run, project, company, award="否"):
    return (run, f"k-{run}-{project}-{company}", project, f"P{project}", "L", "", company, award, "", "bid_list", "x.pdf", "1", "text", "e", "通过", "t", 1.0)


def registry(spark, *firms):
    """(company, shareholder, staff, relations): the firms with one phone, nobody in them, nothing related."""
    company = spark.createDataFrame([(str(i), "", f, "13800000000", "") for i, f in enumerate(firms)], COMPANY)
    people = (spark.createDataFrame([], PEOPLE.format(a, b)) for a, b in (("shareholder_name", "subscribed_ratio"), ("staff_name", "position")))
    return company, *people, spark.createDataFrame([], RELATIONS)


def test_document_has_common_projects_of_all_runs(spark):
    rows = [bid("r2", "1", "甲公司", "是"), bid("r2", "1", "乙公司"), bid("r1", "2", "甲公司"), bid("r1", "2", "乙公司", "是"), bid("r1", "2", "丙公司"), bid("r1", "3", "甲公司"), bid("r1", "4", "丁公司")]
    results = spark.createDataFrame(rows, RESULTS)
    made = api.analyze("r2", results, *registry(spark, "甲公司", "乙公司"), "t")
    (only,) = made["risks"]
    assert len(only["trigger_projects"]) == 1 and [p["project_name"] for p in sorted(only["commonProjects"], key=lambda p: p["project_name"])] == ["1", "2"]
    past = next(p for p in only["commonProjects"] if p["project_name"] == "2")
    assert past["bidders"] == sorted(["甲公司", "乙公司", "丙公司"]) and past["awarded_companies"] == ["乙公司"]


def test_whole_run_in_one_call(spark, tmp_path):
    """A run over a notice finds the phone that its firms share and the project that both had in an earlier run."""
    from lotgraph.operators import pages

    def notice(doc, code, firms):
        lines = [f"{t}" for t in (f"第{code}号农田建设项目中标候选人公示", f"项目编号：ABC2024{code}-S01", "五、所有投标人得分汇总表：", "序号 投标人名称 排名", *(f"{i} {f} {i}" for i, f in enumerate(firms, 1)), f"六、拟定中标人：{firms[0]}")]
        boxes = [(t, 0.98, [[1.0, 10.0 * i], [9.0, 10.0 * i], [9.0, 10.0 * i + 8], [1.0, 10.0 * i + 8]]) for i, t in enumerate(lines)]
        return (doc, "bid_candidates", 1, "\n".join(lines), "text", 300, "", boxes, [])

    firms = ["江苏甲建设有限公司", "江苏乙建设有限公司"]
    make = lambda *rows: spark.createDataFrame(list(rows), pages.PAGES)
    earlier = spark.createDataFrame([bid("r1", "1", f) for f in firms], RESULTS)
    blank = {c: "" for c in (*crawl.FILLED, *crawl.FIRST)}
    lookups = spark.createDataFrame([Row(ord=i, company_type="root", company_name=f, status=s, message="", attempts=1, poll_count=1, database_rows=0, has_data=False, related_sources=["a"], **blank) for i, (f, s) in enumerate([(firms[0], "waiting"), (firms[0], "success"), (firms[1], "timeout")])])
    second = api.run(make(notice("b.pdf", "0002", firms)), "r2", "t2", earlier, lookups, *registry(spark, *firms), categories=("bid_candidates",))
    assert (second.results.count(), second.lookups.count(), second.outcome.open_lookups, second.outcome.exit_code, second.document["finality"]) == (4, 2, 1, 2, "provisional")
    (only,) = second.document["risks"]
    assert (only["risk_type"], len(only["commonProjects"]), len(only["trigger_projects"])) == ("shared_phone", 2, 1)


def test_current_names_and_awards_count(spark):
    schema = "project_key string, company_key string, company_name string, awarded boolean, ord string, project_name string, project_code string, lot_code string, lot_name string"
    now = spark.createDataFrame([("p", "a", "A now", False, "1", "new", "", "", ""), ("q", "a", "A now", False, "1", "only now", "", "", "")], schema)
    past = spark.createDataFrame([("p", "a", "A then", True, "2", "old", "", "", ""), ("p", "b", "B", False, "3", "old", "", "", "")], schema)
    got = {(r.project_key, r.company_key): (r.company_name, r.awarded, r.project_name) for r in risk.with_history(now, past).collect()}
    assert got == {("p", "a"): ("A now", True, "old"), ("p", "b"): ("B", False, "old"), ("q", "a"): ("A now", False, "only now")}
