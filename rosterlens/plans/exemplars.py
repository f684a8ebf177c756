"""Each relational operator of the directory audit on the star-schema tables, with the oracle of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import norm
from ..operators import compact, reports


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def phone_concentration(t: Tables) -> DataFrame:
    """Keys on at least 50 and 1 % of a group's rows."""
    pairs = t.events.select("event_type", "user_id").where("user_id is not null")
    sizes = pairs.groupBy("event_type").agg(F.count("*").alias("n"))
    return pairs.groupBy("event_type", "user_id").agg(F.count("*").alias("k")).join(sizes, "event_type").where(F.col("k") >= F.greatest(F.lit(20.0), 0.001 * F.col("n"))).select("event_type", "user_id", "k")


def all_values_concentrated(t: Tables) -> DataFrame:
    """Orders all of whose parts are in many orders."""
    pairs = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    common = pairs.groupBy("l_partkey").count().where("count >= 30").select("l_partkey", F.lit(1).alias("hit"))
    return pairs.join(common, "l_partkey", "left").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count("hit").alias("hits")).where("n = hits").select("l_orderkey", "n")


def distinct_inflation(t: Tables) -> DataFrame:
    per = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.count_distinct("l_partkey").alias("n"))
    return per.where("n > 10").withColumn("tier", F.when(F.col("n") > 50, "GT50").when(F.col("n") > 25, "GT25").otherwise("GT10"))


def anti_join_inactive(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority like '1%'")
    return t.customer.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


def semi_join_active(t: Tables) -> DataFrame:
    big = t.lineitem.where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.join(big, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey")


def in_subquery_flag(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority like '1%'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(1))
    return t.customer.join(urgent, "c_custkey", "left").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count("hit").alias("n_urgent"))


def full_outer_status(t: Tables) -> DataFrame:
    """Keys before and after a date: new, persisting, resolved."""
    key = ["o_custkey", "o_orderpriority"]
    early = F.col("o_orderdate") < "1995-06-17"
    b = t.orders.where(early).select(*key).distinct().withColumn("b", F.lit(1))
    n = t.orders.where(~early).select(*key).distinct().withColumn("n", F.lit(1))
    return b.join(n, key, "full").select(*key, F.when(F.col("b").isNull(), "new").when(F.col("n").isNull(), "resolved").otherwise("persisting").alias("status"))


def count_delta(t: Tables) -> DataFrame:
    key = ["l_returnflag", "l_linestatus"]
    early = F.col("l_shipdate") < "1995-06-17"
    b, n = (t.lineitem.where(c).groupBy(*key).agg(F.count("*").alias(name)) for c, name in ((early, "b"), (~early, "n")))
    return b.join(n, key, "full").na.fill(0, ["b", "n"]).withColumn("delta", F.col("n") - F.col("b"))


def sublinear_penalty(t: Tables) -> DataFrame:
    w, odd = F.col("l_discount"), F.when(F.col("l_linenumber") % 2 == 1, F.col("l_discount"))

    def capped(x):
        top = F.coalesce(F.max(x), F.lit(0.0))
        return norm.rounded(F.least(F.lit(1.0), top + 0.25 * (F.coalesce(F.sum(x), F.lit(0.0)) - top)), 6)

    return t.lineitem.groupBy("l_orderkey").agg(capped(w).alias("pen"), capped(odd).alias("pen_odd"))


def scope_crossjoin(t: Tables) -> DataFrame:
    """Every nation in both scopes, zeros filled in."""
    scopes = t.nation.select("n_nationkey", F.explode(F.array(F.lit("all"), F.lit("sub"))).alias("scope"))
    per = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("all"), F.count(F.when(F.col("s_acctbal") > 5000, 1)).alias("sub"))
    return scopes.join(per, "n_nationkey", "left").select("n_nationkey", "scope", F.coalesce(F.when(F.col("scope") == "all", F.col("all")).otherwise(F.col("sub")), F.lit(0)).alias("n"))


def wilson_suppression(t: Tables) -> DataFrame:
    """Half-width of Wilson's interval for a rate, and a grade."""
    per = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("p"))
    n, p = F.col("n").cast("double"), F.col("p")
    half = 1.96 * F.sqrt(p * (1 - p) / n + 0.9604 / (n * n)) / (1 + 3.8416 / n)
    return per.select("l_suppkey", "n", norm.rounded(half, 6).alias("half_width"), norm.grade(100 * (1 - p), F.col("n")).alias("grade"))


def pivot_scope(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count("o_orderkey")).na.fill(0).withColumnsRenamed({"F": "n_f", "O": "n_o", "P": "n_p"})


def topk_per_group(t: Tables) -> DataFrame:
    order = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t.orders.withColumn("rk", F.row_number().over(order)).where("rk <= 2").select("o_custkey", "o_orderkey", "rk")


def dedup_cascade(t: Tables) -> DataFrame:
    """One order of a customer and priority, then one of a clerk's day, by MD5."""
    h = F.md5(F.col("o_orderkey").cast("string"))
    one = t.orders.withColumn("h", h).withColumn("r", F.row_number().over(Window.partitionBy("o_custkey", "o_orderpriority").orderBy("h"))).where("r = 1")
    two = one.withColumn("r", F.row_number().over(Window.partitionBy(F.to_date("o_orderdate")).orderBy("h"))).where("r = 1")
    return two.select("o_orderkey", "o_custkey")


def surrogate_key(t: Tables) -> DataFrame:
    return compact.surrogate_keys(t.customer, "c_name", "id")


def adjacency_expand(t: Tables) -> DataFrame:
    """A set and its neighbours one step away."""
    own = t.nation.where("n_nationkey < 5").select("n_nationkey", "n_regionkey")
    near = own.select("n_regionkey").distinct().join(t.nation, "n_regionkey").where("n_nationkey % 3 = 0").select("n_nationkey")
    return own.select("n_nationkey").union(near).distinct()


def explode_split(t: Tables) -> DataFrame:
    return t.part.select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def json_extract(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").cast("long")).alias("total"), F.count(F.get_json_object("props", "$.k")).alias("n"))


def median_months(t: Tables) -> DataFrame:
    """Median of month boundaries crossed."""
    d = F.col("o_orderdate")
    months = (1998 - F.year(d)) * 12 + 12 - F.month(d)
    return t.orders.groupBy("o_orderpriority").agg(F.median(months).alias("months"))


def string_agg_sorted(t: Tables) -> DataFrame:
    return t.nation.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_set("n_name")), ", ").alias("nations"))


def luhn(t: Tables) -> DataFrame:
    npi = F.concat(F.lit("1"), F.lpad((F.col("c_custkey") * 7919 % 1000000000).cast("string"), 9, "0"))
    return t.customer.select("c_custkey", npi.alias("npi"), norm.luhn_npi(npi).alias("valid"))


def regex_digits(t: Tables) -> DataFrame:
    return t.pages.select("page_id", norm.digits(F.col("url")).alias("digits"), norm.bad_phone(F.col("url")).alias("bad"))


def placeholder_filter(t: Tables) -> DataFrame:
    zip_code = F.concat(F.lit("1000"), F.col("p_size").cast("string"))
    return t.part.where(norm.bad_zip(zip_code) | norm.bad_address(F.col("p_brand"))).select("p_partkey")


def stale_threshold_sweep(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    end = F.lit("1998-12-31").cast("date")
    return t.orders.groupBy("o_orderpriority").agg(*[F.count(F.when(d < F.date_sub(end, n), 1)).alias(f"d{n}") for n in (365, 730, 1095)])


def hash_sample_exact(t: Tables) -> DataFrame:
    return reports.hash_sample(t.documents.select("doc_id", "lang"), "doc_id", 50)


def league_table(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"), norm.rounded(F.avg("l_discount"), 6).alias("avg_discount"))
    return per.where("n >= 20").orderBy("avg_discount", "l_suppkey").limit(15)


def ilike_filter(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_type").ilike("econ%") | F.col("p_name").ilike("%Q%")).select("p_partkey", "p_type")


def bool_or_flags(t: Tables) -> DataFrame:
    """Whether any, and whether every, line of an order came back."""
    back = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy("l_orderkey").agg(F.bool_or(back).alias("any_back"), F.bool_and(back).alias("all_back"))


def array_membership(t: Tables) -> DataFrame:
    """Customers by the priorities of their orders: how many they have, and whether one is urgent."""
    per = t.orders.groupBy("o_custkey").agg(F.array_distinct(F.collect_list("o_orderpriority")).alias("kinds"))
    return per.select("o_custkey", F.size("kinds").alias("n_kinds"), F.array_contains("kinds", "1-URGENT").alias("urgent"), F.array_join(F.array_sort("kinds"), "|").alias("kinds"))


def lenient_dates(t: Tables) -> DataFrame:
    """Texts that may be dates: M/d/yyyy, ISO, or none."""
    k = F.col("o_orderkey") % 3
    text = F.when(k == 0, F.date_format("o_orderdate", "M/d/yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("soon"))
    return t.orders.select("o_orderkey", F.to_date(F.try_to_timestamp(text, F.lit("M/d/yyyy"))).cast("string").alias("american"), text.try_cast("date").cast("string").alias("iso"))


def mean_of_means(t: Tables) -> DataFrame:
    """Mean discount of suppliers, each counted once."""
    per = t.lineitem.groupBy("l_suppkey").agg(F.avg("l_discount").alias("m"))
    return per.agg(norm.rounded(F.avg("m"), 6).alias("mean"), F.count("*").alias("n"))


def any_value_skips_nulls(t: Tables) -> DataFrame:
    """A value of each group that is not null; groups here have one value at most."""
    one = F.when(F.col("n_nationkey") == 5 * F.floor(F.col("n_nationkey") / 5), F.col("n_regionkey") * 10)
    return t.nation.groupBy(F.floor(F.col("n_nationkey") / 5).alias("block")).agg(F.any_value(one, F.lit(True)).alias("value"))


def bound_parameter(t: Tables) -> DataFrame:
    """A statement with named parameters."""
    return t.spark.sql("SELECT c_custkey, c_acctbal FROM {customer} WHERE c_mktsegment = :segment AND c_acctbal > :least", args={"segment": "BUILDING", "least": 5000.0}, customer=t.customer)


def phone_format(t: Tables) -> DataFrame:
    phone = F.concat(F.lit("212555"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"))
    return t.customer.select("c_custkey", norm.formatted_phone(F.when(F.col("c_custkey") % 7 == 0, F.lit("none")).otherwise(phone)).alias("phone"))


_EARLY = "o_orderdate < TIMESTAMP '1995-06-17'"
_MD5 = "md5(CAST(o_orderkey AS VARCHAR))"

ORACLES = {
    "phone_concentration": "SELECT event_type, user_id, count(*) AS k FROM events JOIN (SELECT event_type, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY 1) USING (event_type) WHERE user_id IS NOT NULL GROUP BY event_type, user_id, n HAVING count(*) >= greatest(20, 0.001 * n)",
    "all_values_concentrated": "SELECT l_orderkey, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) a LEFT JOIN (SELECT l_partkey, count(DISTINCT l_orderkey) AS k FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) >= 30) b USING (l_partkey) GROUP BY 1 HAVING count(*) = count(k)",
    "distinct_inflation": "SELECT o_custkey, n, CASE WHEN n > 50 THEN 'GT50' WHEN n > 25 THEN 'GT25' ELSE 'GT10' END AS tier FROM (SELECT o_custkey, count(DISTINCT l_partkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) WHERE n > 10",
    "anti_join_inactive": "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority LIKE '1%')",
    "semi_join_active": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)",
    "in_subquery_flag": "SELECT c_mktsegment, count(*) AS n, count(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%') THEN 1 END) AS n_urgent FROM customer GROUP BY 1",
    "full_outer_status": f"SELECT coalesce(b.o_custkey, n.o_custkey) AS o_custkey, coalesce(b.o_orderpriority, n.o_orderpriority) AS o_orderpriority, CASE WHEN b.o_custkey IS NULL THEN 'new' WHEN n.o_custkey IS NULL THEN 'resolved' ELSE 'persisting' END AS status FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE {_EARLY}) b FULL JOIN (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE NOT {_EARLY}) n ON b.o_custkey = n.o_custkey AND b.o_orderpriority = n.o_orderpriority",
    "count_delta": "SELECT l_returnflag, l_linestatus, b, n, n - b AS delta FROM (SELECT l_returnflag, l_linestatus, count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1995-06-17') AS b, count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1995-06-17') AS n FROM lineitem GROUP BY 1, 2)",
    "sublinear_penalty": "SELECT l_orderkey, round(round(least(1, max(l_discount) + 0.25 * (sum(l_discount) - max(l_discount))), 9), 6) AS pen, round(round(least(1, coalesce(max(l_discount) FILTER (WHERE l_linenumber % 2 = 1), 0) + 0.25 * (coalesce(sum(l_discount) FILTER (WHERE l_linenumber % 2 = 1), 0) - coalesce(max(l_discount) FILTER (WHERE l_linenumber % 2 = 1), 0))), 9), 6) AS pen_odd FROM lineitem GROUP BY 1",
    "scope_crossjoin": "SELECT n_nationkey, scope, count(s_suppkey) AS n FROM nation CROSS JOIN (VALUES ('all'), ('sub')) v(scope) LEFT JOIN supplier ON s_nationkey = n_nationkey AND (scope = 'all' OR s_acctbal > 5000) GROUP BY 1, 2",
    "wilson_suppression": "SELECT l_suppkey, n, round(round(1.96 * sqrt(p * (1 - p) / n + 0.9604 / (n * n)) / (1 + 3.8416 / n), 9), 6) AS half_width, CASE WHEN n < 10 THEN NULL WHEN 100 * (1 - p) >= 90 THEN 'A' WHEN 100 * (1 - p) >= 80 THEN 'B' WHEN 100 * (1 - p) >= 70 THEN 'C' WHEN 100 * (1 - p) >= 55 THEN 'D' ELSE 'F' END AS grade FROM (SELECT l_suppkey, count(*) AS n, avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END) AS p FROM lineitem GROUP BY 1)",
    "pivot_scope": "SELECT o_orderpriority, " + ", ".join(f"count(*) FILTER (WHERE o_orderstatus = '{s}') AS n_{s.lower()}" for s in "FOP") + " FROM orders GROUP BY 1",
    "topk_per_group": "SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS rk FROM orders QUALIFY rk <= 2",
    "dedup_cascade": f"SELECT o_orderkey, o_custkey FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY {_MD5}) = 1) QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY {_MD5}) = 1",
    "surrogate_key": "SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS id FROM (SELECT DISTINCT c_name FROM customer)",
    "adjacency_expand": "SELECT n_nationkey FROM nation WHERE n_nationkey < 5 UNION SELECT n_nationkey FROM nation WHERE n_nationkey % 3 = 0 AND n_regionkey IN (SELECT n_regionkey FROM nation WHERE n_nationkey < 5)",
    "explode_split": "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1",
    "json_extract": "SELECT event_type, CAST(sum(CAST(props ->> '$.k' AS BIGINT)) AS BIGINT) AS total, count(props ->> '$.k') AS n FROM events GROUP BY 1",
    "median_months": "SELECT o_orderpriority, median(date_diff('month', o_orderdate, TIMESTAMP '1998-12-31')) AS months FROM orders GROUP BY 1",
    "string_agg_sorted": "SELECT n_regionkey, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS nations FROM nation GROUP BY 1",
    "luhn": "SELECT c_custkey, npi, (24 + list_sum(list_transform(range(1, 11), lambda i: CASE WHEN i % 2 = 1 THEN (2 * CAST(substr(npi, i::INT, 1) AS INT)) // 10 + (2 * CAST(substr(npi, i::INT, 1) AS INT)) % 10 ELSE CAST(substr(npi, i::INT, 1) AS INT) END))) % 10 = 0 AS valid FROM (SELECT c_custkey, '1' || lpad(CAST(c_custkey * 7919 % 1000000000 AS VARCHAR), 9, '0') AS npi FROM customer)",
    "regex_digits": "SELECT page_id, regexp_replace(coalesce(url, ''), '[^0-9]', '', 'g') AS digits, length(digits) < 10 OR length(replace(digits, substr(digits, 1, 1), '')) = 0 AS bad FROM pages",
    "placeholder_filter": "SELECT p_partkey FROM part WHERE length('1000' || p_size) NOT IN (5, 9) OR lower(coalesce(p_brand, '')) IN ('', 'null', 'n/a', 'na', 'unknown')",
    "stale_threshold_sweep": "SELECT o_orderpriority, " + ", ".join(f"count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '1998-12-31' - {n}) AS d{n}" for n in (365, 730, 1095)) + " FROM orders GROUP BY 1",
    "hash_sample_exact": "SELECT doc_id, lang FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 50",
    "ilike_filter": "SELECT p_partkey, p_type FROM part WHERE lower(p_type) LIKE 'econ%' OR contains(lower(p_name), 'q')",
    "bool_or_flags": "SELECT l_orderkey, count_if(l_returnflag = 'R') > 0 AS any_back, count_if(l_returnflag = 'R') = count(*) AS all_back FROM lineitem GROUP BY 1",
    "array_membership": "SELECT o_custkey, CAST(count(DISTINCT o_orderpriority) AS INT) AS n_kinds, max(o_orderpriority = '1-URGENT') AS urgent, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS kinds FROM orders GROUP BY 1",
    "lenient_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS american, CASE WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders",
    "mean_of_means": "SELECT round(round(avg(m), 9), 6) AS mean, count(*) AS n FROM (SELECT sum(l_discount) / count(l_discount) AS m FROM lineitem GROUP BY l_suppkey)",
    "any_value_skips_nulls": "SELECT n_nationkey // 5 AS block, max(CASE WHEN n_nationkey % 5 = 0 THEN n_regionkey * 10 END) AS value FROM nation GROUP BY 1",
    "bound_parameter": "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000",
    "phone_format": "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'none' ELSE '(212) 555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone FROM customer",
    "league_table": "SELECT l_suppkey, count(*) AS n, round(round(avg(l_discount), 9), 6) AS avg_discount FROM lineitem GROUP BY 1 HAVING count(*) >= 20 ORDER BY avg_discount, l_suppkey LIMIT 15",
}

QUERIES = {name: (lambda spark, sf_dir, build=globals()[name]: build(Tables(spark, sf_dir))) for name in ORACLES}
