"""The driver's tables seen as tender data: projects, bidders, networks, evidence, events. Whole tables always."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bid for each order line: the order is the project, the line's status the lot, the supplier the bidder."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    category = F.element_at(F.array(*[F.lit(c) for c in ("tender_cover", "bid_evaluation_report", "bid_candidates", "award_notice", "bid_announcement", "bid_list", "archive_info")]), F.col("l_linenumber"))
    status = F.when(F.col("l_returnflag") == "R", "是").when(F.col("l_returnflag") == "A", "否").otherwise("未知")
    return rows.select(
        F.concat(F.lit("Order "), F.col("l_orderkey")).alias("project_name"),
        F.when(F.col("l_linenumber") == 7, "").otherwise(F.concat(F.lit("P"), F.col("l_orderkey"))).alias("project_code"),
        F.col("l_linestatus").alias("lot_code"), F.col("l_linestatus").alias("lot_name"), F.col("s_name").alias("company_name"), status.alias("award_status"),
        F.when(status == "是", "1").otherwise("").alias("rank"), category.alias("category"), F.concat(F.lit("doc-"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("source_path"),
        F.col("l_linenumber").cast("string").alias("source_pages"), F.lit("text").alias("extraction_method"), F.concat(F.lit("part "), F.col("l_partkey")).alias("evidence"),
        F.when(F.col("l_discount") > 0.08, "待复核").otherwise("通过").alias("review_status"), F.round(1 - 5 * F.col("l_discount"), 4).alias("confidence"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("generated_at"), F.format_string("%012d-%02d-%09d-%09d", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("ord"),
        F.lit("").alias("record_id"), "l_orderkey", "l_suppkey",
    )


#: The same in SQL.
BIDS = """bids AS (
  SELECT 'Order ' || l_orderkey AS project_name, CASE WHEN l_linenumber = 7 THEN '' ELSE 'P' || l_orderkey END AS project_code, l_linestatus AS lot_code, l_linestatus AS lot_name,
         s_name AS company_name, CASE l_returnflag WHEN 'R' THEN '是' WHEN 'A' THEN '否' ELSE '未知' END AS award_status, CASE WHEN l_returnflag = 'R' THEN '1' ELSE '' END AS rank,
         ['tender_cover', 'bid_evaluation_report', 'bid_candidates', 'award_notice', 'bid_announcement', 'bid_list', 'archive_info'][l_linenumber] AS category,
         'doc-' || l_orderkey || '-' || l_linenumber AS source_path, l_linenumber::VARCHAR AS source_pages, 'part ' || l_partkey AS evidence,
         CASE WHEN l_discount > 0.08 THEN '待复核' ELSE '通过' END AS review_status, round(1 - 5 * l_discount, 4) AS confidence, strftime(l_shipdate, '%Y-%m-%d') AS generated_at,
         printf('%012d-%02d-%09d-%09d', l_orderkey, l_linenumber, l_suppkey, l_partkey) AS ord, '' AS record_id, l_orderkey, l_suppkey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
)"""


def bidders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(project_key, company_key, company_name, awarded): each supplier of an order once."""
    rows = bids(spark, sf_dir).select(F.col("l_orderkey").cast("string").alias("project_key"), F.lower("company_name").alias("company_key"), "company_name", "award_status")
    # A project's rows stay together, so that neither this group nor the pairs of a project's bidders move them again.
    return rows.repartition("project_key").groupBy("project_key", "company_key").agg(F.min("company_name").alias("company_name"), F.max(F.col("award_status") == "是").alias("awarded"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's network: itself, and the customers related to it. Every customer is related to two suppliers, by the remainder of the square of its number;
    so some suppliers have many and some none."""
    s, c = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    own = s.select(F.lower("s_name").alias("root_key"), F.lower("s_name").alias("company_key"), F.col("s_name").alias("company_name"), F.lit("root").alias("role"))
    n, square = s.agg(F.count("*")).scalar(), F.col("c_custkey") * F.col("c_custkey")
    ties = c.select("c_name", F.explode(F.array(square % n, (square + 1) % n)).alias("_of"))
    related = s.join(ties, F.col("s_suppkey") == F.col("_of")).select(F.lower("s_name").alias("root_key"), F.lower("c_name").alias("company_key"), F.col("c_name").alias("company_name"), F.lit("related").alias("role"))
    return own.unionByName(related)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phones shared by a nation's suppliers and by three customers each, one of seven customers without any; addresses by tens of the balance, none in debt."""
    s = table(spark, sf_dir, "supplier").select(F.lower("s_name").alias("company_key"), F.concat(F.lit("n"), F.col("s_nationkey")).alias("phone"), F.col("s_acctbal").alias("balance"))
    phone = F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit("p"), F.floor(F.col("c_custkey") / 3)))
    c = table(spark, sf_dir, "customer").select(F.lower("c_name").alias("company_key"), phone.alias("phone"), F.col("c_acctbal").alias("balance"))
    address = F.when(F.col("balance") >= 0, F.concat(F.lit("b"), F.floor(F.col("balance") / 10)))
    values = F.explode(F.array(F.struct(F.lit("shared_phone").alias("risk_type"), F.col("phone").alias("value")), F.struct(F.lit("shared_email").alias("risk_type"), address.alias("value")))).alias("f")
    return s.unionByName(c).select("company_key", values).where("f.value is not null").select("company_key", "f.risk_type", "f.value", F.col("f.value").alias("display"))


def whole_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phones shared by a nation's suppliers and customers, addresses by thousands of the balance: every company has both."""
    s = table(spark, sf_dir, "supplier").select(F.lower("s_name").alias("company_key"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    c = table(spark, sf_dir, "customer").select(F.lower("c_name").alias("company_key"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    values = F.explode(F.array(
        F.struct(F.lit("shared_phone").alias("risk_type"), F.concat(F.lit("n"), F.col("nation")).alias("value")),
        F.struct(F.lit("shared_email").alias("risk_type"), F.concat(F.lit("b"), F.floor(F.col("balance") / 1000)).alias("value")),
    )).alias("f")
    return s.unionByName(c).select("company_key", values).select("company_key", "f.risk_type", "f.value", F.col("f.value").alias("display"))


NETWORK = """bidders AS (SELECT DISTINCT l_orderkey::VARCHAR AS project_key, lower(s_name) AS company_key FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
ties AS (SELECT c_name, unnest([(c_custkey * c_custkey) % n, (c_custkey * c_custkey + 1) % n]) AS s FROM customer, (SELECT count(*) AS n FROM supplier)),
members AS (
  SELECT lower(s_name) AS root_key, lower(s_name) AS company_key, 'root' AS role FROM supplier
  UNION ALL SELECT lower(s_name), lower(c_name), 'related' FROM supplier JOIN ties ON s_suppkey = s
),
facts AS (
  SELECT lower(s_name) AS company_key, 'shared_phone' AS risk_type, 'n' || s_nationkey AS value FROM supplier
  UNION ALL SELECT lower(c_name), 'shared_phone', 'p' || (c_custkey // 3) FROM customer WHERE c_custkey % 7 <> 0
  UNION ALL SELECT lower(s_name), 'shared_email', 'b' || floor(s_acctbal / 10)::BIGINT FROM supplier WHERE s_acctbal >= 0
  UNION ALL SELECT lower(c_name), 'shared_email', 'b' || floor(c_acctbal / 10)::BIGINT FROM customer WHERE c_acctbal >= 0
),
occurs AS (SELECT project_key, root_key, m.company_key, role, risk_type, value FROM bidders b JOIN members m ON b.company_key = m.root_key JOIN facts f ON f.company_key = m.company_key),
shared AS (
  SELECT a.root_key AS root_a, b.root_key AS root_b, a.risk_type, a.value, a.company_key AS company_a, a.role AS role_a, b.company_key AS company_b, b.role AS role_b,
         CASE WHEN a.role <> b.role THEN 'root_related' WHEN a.role = 'root' THEN 'root_root' ELSE 'related_related' END AS comparison_type, a.project_key
  FROM occurs a JOIN occurs b ON a.project_key = b.project_key AND a.risk_type = b.risk_type AND a.value = b.value AND a.root_key < b.root_key AND a.company_key <> b.company_key
),
met AS (
  SELECT a.project_key, a.company_key AS root_a, b.company_key AS root_b FROM bidders a JOIN bidders b ON a.project_key = b.project_key AND a.company_key < b.company_key
),
identity AS (
  SELECT m.root_a, m.root_b, 'shared_company_identity' AS risk_type, x.company_key AS value, x.company_key AS company_a, x.role AS role_a, x.company_key AS company_b, y.role AS role_b,
         CASE WHEN x.role <> y.role THEN 'root_related' ELSE 'related_related' END AS comparison_type, m.project_key
  FROM met m JOIN members x ON x.root_key = m.root_a JOIN members y ON y.root_key = m.root_b AND x.company_key = y.company_key
)"""

#: NETWORK with whole_facts().
WHOLE_NETWORK = NETWORK[: NETWORK.index("facts AS")] + """holders AS (SELECT lower(s_name) AS company_key, s_nationkey AS nation, s_acctbal AS balance FROM supplier UNION ALL SELECT lower(c_name), c_nationkey, c_acctbal FROM customer),
facts AS (
  SELECT company_key, 'shared_phone' AS risk_type, 'n' || nation AS value FROM holders
  UNION ALL SELECT company_key, 'shared_email', 'b' || floor(balance / 1000)::BIGINT FROM holders
),
""" + NETWORK[NETWORK.index("occurs AS") :]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as runs, events as states of their entities."""
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type").isin("purchase", "signup"), "success").when(F.col("event_type") == "click", "running").otherwise("waiting")
    return e.select(F.col("user_id").alias("run_id"), "event_id", "ts", "event_type", status.alias("status"), "value", "props")


def bidders_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, names): each order's suppliers as companies, by their first line."""
    first = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), "l_suppkey").agg(F.min("l_linenumber").alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("m", "l_suppkey")))
    return first.groupBy("k").agg(F.transform(ordered, lambda x: F.concat(F.lit("甲"), x["l_suppkey"], F.lit("建设有限公司"))).alias("names"))


#: The same in SQL, a row for each company: its place and how many there are.
IN_ORDER = """b AS (
  SELECT k, '甲' || s || '建设有限公司' AS company, row_number() OVER (PARTITION BY k ORDER BY m, s) AS i, count(*) OVER (PARTITION BY k) AS n
  FROM (SELECT l_orderkey AS k, l_suppkey AS s, min(l_linenumber) AS m FROM lineitem GROUP BY 1, 2)
)"""


def tender_pages(spark: SparkSession, sf_dir: str, category: str) -> DataFrame:
    """Each order as a document of a category, laid out as such documents are; its suppliers are the bidders."""
    names, first, last = F.col("names"), F.element_at("names", 1), F.element_at("names", -1)
    project, code = F.col("project"), F.col("code")
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def line(text, x, y):
        x, y = (F.lit(v) if isinstance(v, int) else v for v in (x, y))
        corners = F.array(*[F.array((x + a).cast("double"), (y + b).cast("double")) for a, b in ((-4, -4), (4, -4), (4, 4), (-4, 4))])
        return F.struct(text.alias("text"), F.lit(0.98).alias("confidence"), corners.alias("bbox"))

    def numbered(y):
        return lambda c, i: line(say((i + 1).cast("string"), " ", c), 5, y + 20 * (i + 1))

    def bare(y):
        return lambda c, i: line(c, 5, y + 20 * (i + 1))

    listing = F.array_join(names, "、")
    broken = F.transform(F.sequence(F.lit(0), F.floor((F.length(listing) - 1) / 9).cast("int")), lambda i: F.substring(listing, i * 9 + 1, F.lit(9)))

    def page(*texts):
        """Lines from top to bottom; an array makes a line of each element, the names' with their number before them."""
        out, y = [], F.lit(0)
        for t in texts:
            if t is names or t is broken:
                out.append(F.transform(t, numbered(y) if t is names else bare(y)))
                y = y + 20 * F.size(t)
            else:
                out.append(F.array(line(say(t), 5, y + 20)))
                y = y + 20
        return F.concat(*out)

    facts = F.array(line(F.lit("基本情况一览表"), 50, 5), line(F.lit("工程名称"), 10, 50), line(project, 90, 50))
    heads = F.array(line(say("项目名称：", project, "三标段"), 600, 1), line(say("标段（包）编号：", code, "-S04"), 600, 5), line(F.lit("序号"), 10, 20), line(F.lit("单位名称"), 100, 20), line(F.lit("联系人"), 300, 20))
    column = F.transform(names, lambda c, i: line(c, 100, 40 + 30 * i))
    made = {
        "award_notice": [F.when(F.col("k") % 2 == 0, page(say(code, "-A1"), say("项目名称：", project), say("中标人：", first))).otherwise(
            page("交易结果通知书", "编号：", say(F.lower(code), "—a1"), say(first, "："), say("甲方的", F.substring(project, F.lit(1), F.length(project) - 2)), "项目施工的评审工作已经", "结束。"))],
        "bid_announcement": [page(say("工程名称：", project), say("标段编号：", code), "招标人：某局有限公司", say("中标单位：", last))],
        "bid_list": [F.concat(heads, column)],
        "bid_candidates": [page(say(project, "中标候选人公示"), say("项目编号：", code, "-S01"), "投标人名称：无关建设有限公司", "五、所有投标人得分汇总表：", "序号 投标人名称 排名", names, say("六、拟定中标人：", last), "征询：无关发展有限公司")],
        "bid_evaluation_report": [facts, page("投标人排序及推荐的中标候选人", "投标人名称", names, "推荐的中标候选人", "第一名", last)],
        "archive_info": [
            page(F.when(F.col("k") % 2 == 0, "2、按时送达投标文件的投标人名单：").otherwise("投标人名单"), broken, "3、开标基本情况：", "无关建设有限公司到场"),
            page("中标通知书", say("工程名称：", project), say("项目编号：", code, "—01"), say("中标人：", last)),
        ],
        "tender_cover": [page(project, say("项目编号：", code, "-02"), say("投标人：", first, "（盖章）"))],
    }[category]
    orders = bidders_in_order(spark, sf_dir).select("k", "names", F.format_string("第%d号农田建设项目", "k").alias("project"), F.format_string("JS%08d", "k").alias("code"))
    pages = orders.select("k", F.posexplode(F.array(*made)).alias("p", "lines"))
    return pages.select(
        say("d/中标资料/", F.col("k").cast("string"), ".pdf").alias("doc_path"), F.lit(category).alias("category"), (F.col("p") + 1).alias("page_number"),
        F.array_join(F.transform("lines", lambda x: x["text"]), "\n").alias("text"), F.lit("text").alias("method"), F.lit(300).alias("dpi"), F.lit("").alias("layout_text"), "lines",
        F.slice("lines", 1, 0).alias("native_fragments"),
    )
