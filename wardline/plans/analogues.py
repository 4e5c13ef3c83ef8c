"""The operators of the reports and rules, run on the driver's test tables.

The hospital schema has no rows to test with, so each operator is also run on
a stand-in built from the test tables (the mapping is in ``FIXTURES.md`` §C).
Every function takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables (iterative and range-sorted operators run jobs while it is built).
``ORACLE_SQL`` holds, for the same key, a SQL statement that DuckDB runs on the
same files; the two must agree on rows, column names and values.  Stand-ins that
return a row per stored row leave out the report's global sort.

Conventions shared with the SQL side:
* money sums are ``DECIMAL(38,2)`` over values cast to ``DECIMAL(12,2)``;
* ratios and averages are exact half-away-from-zero roundings, as DOUBLE;
* years are INT, counts BIGINT.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.calendar import days_between, in_week, in_year, minutes_between
from wardline.functions.numeric import dialect_avg, greatest_strict, money, money_sum, scaled_half_up, unscale
from wardline.operators import audit as A
from wardline.operators.hierarchy import ancestors, find_cycles
from wardline.operators.joins import anti_join, interval_join
from wardline.operators.maintain import ForeignKey, assign_ids, propagate_delete, propagate_key_change
from wardline.operators.relate import (
    consecutive_equal,
    cross_overlap_pairs,
    distinct_counts,
    equal_measure_groups,
    equal_measure_pairs,
    flag_any,
    gap_to_max,
    lookup,
    next_in_key,
    overlap_flags,
    overlap_pairs,
    pair_cooccurrence,
)
from wardline.plans import reports as R
from wardline.plans.reports import triage_summary
from wardline.plans.rules import Catalogue, declared_constraints
from wardline.sources.tables import TableSet

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the stand-ins (fixed so results do not drift with the clock).
AS_OF = dt.date(2001, 12, 31)
ROSTER_YEAR = 1998
NOT_ASSIGNED_YEAR = 1997
GAP_YEAR = 1997
WEEK_OF = dt.date(1997, 5, 20)


def _t(spark: SparkSession, sf_dir: str) -> TableSet:
    return TableSet(spark, sf_dir)


# ---------------------------------------------------------------- Q1


def revenue_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate").filter(
        F.col("l_shipdate").isNotNull()
    )
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    c = t["customer"].select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t["nation"].select("n_nationkey", "n_name")
    p = t["part"].select("p_partkey", "p_type", "p_size", "p_retailprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    j = lookup(j, c, [("o_custkey", "c_custkey")])
    j = lookup(j, n, [("c_nationkey", "n_nationkey")])
    j = lookup(j, p, [("l_partkey", "p_partkey")])
    over = greatest_strict(F.lit(0), days_between("o_orderdate", "l_shipdate") - F.col("p_size"))
    return (
        j.groupBy("n_name", F.year("l_shipdate").alias("ship_year"), "p_type", "c_mktsegment")
        .agg(
            F.count("l_orderkey").alias("total_items"),
            money_sum("p_retailprice").alias("total_basic_cost"),
            F.sum(over * money("p_retailprice")).cast("decimal(38,2)").alias("total_extra_cost"),
            money_sum("l_extendedprice").alias("final_total_revenue"),
        )
        .orderBy("n_name", "ship_year", "p_type")
    )


# ---------------------------------------------------------------- Q2


def roster_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    base = t["customer"].filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name", "c_mktsegment")
    year_orders = t["orders"].filter(in_year("o_orderdate", ROSTER_YEAR)).select("o_custkey")
    out = flag_any(base, "c_custkey", year_orders, "o_custkey", "had_order_in_year")
    return distinct_counts(out, "c_custkey", [(t["events"], "user_id", "event_id", "events_count")])


# ---------------------------------------------------------------- Q3


def frequent_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    per_group = (
        t["orders"]
        .groupBy("o_custkey", "o_orderstatus")
        .agg(F.count("o_orderkey").alias("total_orders"), money_sum("o_totalprice").alias("total_cost"))
        .filter(F.col("total_orders") > R.MIN_STAYS)
    )
    c = t["customer"].select("c_custkey", "c_name")
    return (
        per_group.join(c, per_group.o_custkey == c.c_custkey)
        .select("c_custkey", "c_name", "o_orderstatus", "total_orders", "total_cost")
        .orderBy(F.col("total_orders").desc(), "c_custkey", "o_orderstatus")
    )


# ---------------------------------------------------------------- Q4


def bridge_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4's shape for every supplier: mean quantity and line number over its line items, through the order bridge."""
    t = _t(spark, sf_dir)
    s = t["supplier"].select("s_suppkey", "s_name")
    li = t["lineitem"].select("l_suppkey", "l_orderkey", "l_quantity", "l_linenumber")
    o = t["orders"].select("o_orderkey")
    j = s.join(li, s.s_suppkey == li.l_suppkey).join(o, F.col("l_orderkey") == o.o_orderkey)
    cents = (money("l_quantity") * 100).cast("decimal(38,0)")
    agg = j.groupBy("s_suppkey", "s_name").agg(
        F.sum(cents).alias("__q"), F.count("l_quantity").alias("__nq"),
        F.sum("l_linenumber").alias("__l"), F.count("l_linenumber").alias("__nl"),
    )
    return agg.select(
        "s_suppkey", "s_name",
        unscale(scaled_half_up("__q", F.col("__nq") * 100, 4), 4).alias("avg_quantity"),
        dialect_avg("__l", "__nl", 4).alias("avg_linenumber"),
    )


# ---------------------------------------------------------------- Q5


def filtered_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    per_user = (
        t["events"].filter(F.col("event_type") == "purchase").groupBy("user_id").agg(F.count("event_id").alias("total_purchases"))
    )
    c = t["customer"].filter(F.col("c_acctbal") < 1000).select("c_custkey", "c_name", "c_acctbal")
    return (
        c.join(per_user, c.c_custkey == per_user.user_id)
        .select("c_custkey", "c_name", "c_acctbal", "total_purchases")
        .orderBy(F.col("total_purchases").desc(), "c_custkey")
    )


# ---------------------------------------------------------------- Q6


def entity_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    d = t["documents"].select("doc_id", "source", "n_chars")
    lab = t["labels"].select(F.col("doc_id").alias("l_doc_id"), "quality", "toxic")
    return (
        d.join(lab, d.doc_id == lab.l_doc_id, "left")
        .select(
            "doc_id", "source", "n_chars", "quality", "toxic",
            ((F.col("quality") + F.col("toxic")).cast("double") / 2.0).alias("avg_label_score"),
        )
    )


def entity_timeline_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6b's reduced form for every document: no second lookup, the score alone."""
    t = _t(spark, sf_dir)
    d = t["documents"].select("doc_id", "lang", "n_chars")
    lab = t["labels"].select(F.col("doc_id").alias("l_doc_id"), "quality", "toxic")
    score = (F.col("quality") + F.col("toxic")).cast("double") / 2.0
    return d.join(lab, d.doc_id == lab.l_doc_id, "left").select("doc_id", "lang", "n_chars", score.alias("avg_score"))


def dual_role_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6's two-role lookup for every order: nation as the customer's (inner) and the supplier's (left)."""
    t = _t(spark, sf_dir)
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    c = t["customer"].select("c_custkey", "c_nationkey")
    s = t["supplier"].select("s_suppkey", "s_nationkey")
    nc = t["nation"].select(F.col("n_nationkey").alias("nc_key"), F.col("n_name").alias("customer_nation"))
    ns = t["nation"].select(F.col("n_nationkey").alias("ns_key"), F.col("n_name").alias("supplier_nation"))
    j = o.join(li, o.o_orderkey == li.l_orderkey)
    j = lookup(j, c, [("o_custkey", "c_custkey")])
    j = lookup(j, nc, [("c_nationkey", "nc_key")])
    j = lookup(j, s, [("l_suppkey", "s_suppkey")], "left")
    j = lookup(j, ns, [("s_nationkey", "ns_key")], "left")
    return j.select(
        "o_orderkey", "l_linenumber", "o_orderdate", "customer_nation", "supplier_nation", "l_extendedprice"
    )


# ---------------------------------------------------------------- Q7


def dual_optional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    base = t["customer"].select("c_custkey", "c_name")
    return distinct_counts(
        base,
        "c_custkey",
        [(t["orders"], "o_custkey", "o_orderkey", "orders_count"), (t["events"], "user_id", "event_id", "events_count")],
    ).orderBy(F.col("orders_count").desc(), "c_custkey")


# ---------------------------------------------------------------- Q8


def not_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    busy = t["orders"].filter((F.col("o_orderstatus") == "F") & in_year("o_orderdate", NOT_ASSIGNED_YEAR)).select("o_custkey")
    c = t["customer"].select("c_custkey", "c_name", "c_mktsegment")
    return anti_join(c, busy, [("c_custkey", "o_custkey")])


# ---------------------------------------------------------------- Q9


def equal_measure_pairs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    totals = _year_totals(t)
    pairs = equal_measure_pairs(totals, "o_custkey", ["order_year"], "total_days")
    return pairs.select(
        F.col("o_custkey_a").alias("customer_a"), F.col("o_custkey_b").alias("customer_b"), "total_days", "order_year"
    )


def _year_totals(t: TableSet) -> DataFrame:
    return (
        t["orders"]
        .groupBy("o_custkey", F.year("o_orderdate").alias("order_year"))
        .agg(F.sum(days_between("o_orderdate", F.lit(AS_OF))).cast("long").alias("total_days"))
        .filter(F.col("total_days") > R.MIN_TOTAL_DAYS)
    )


def equal_measure_groups_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 as groups: every customer that shares its year total with another, one row per member."""
    groups = equal_measure_groups(_year_totals(_t(spark, sf_dir)), "o_custkey", ["order_year"], "total_days")
    return groups.select("order_year", "total_days", "group_size", "o_custkey")


# ---------------------------------------------------------------- Q10


def pair_cooccurrence_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t["lineitem"].select("l_orderkey", "l_partkey")
    p = t["part"].select("p_partkey", "p_brand")
    items = lookup(li, p, [("l_partkey", "p_partkey")]).select("l_orderkey", "p_brand")
    return pair_cooccurrence(items, "l_orderkey", "p_brand", top=R.TOP_PAIRS).select(
        F.col("item_1").alias("brand_1"), F.col("item_2").alias("brand_2"), "co_occurrence_count"
    )


# ---------------------------------------------------------------- Q11


def gap_to_max_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    counts = (
        t["orders"].filter(in_year("o_orderdate", GAP_YEAR)).groupBy("o_custkey").agg(F.count("o_orderkey").alias("num_orders"))
    )
    return gap_to_max(counts, "num_orders", R.GAP_TO_MAX, "max_orders").orderBy(F.col("num_orders").desc(), "o_custkey")


# ---------------------------------------------------------------- Q12


def weekly_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t["lineitem"].filter(in_week("l_shipdate", WEEK_OF)).select(
        "l_orderkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus"
    )
    s = t["supplier"].select("s_suppkey", "s_nationkey")
    n = t["nation"].select("n_nationkey", "n_name")
    j = lookup(lookup(li, s, [("l_suppkey", "s_suppkey")]), n, [("s_nationkey", "n_nationkey")])
    return (
        j.groupBy("n_nationkey", "n_name", F.to_date("l_shipdate").alias("ship_date"), "l_returnflag", "l_linestatus")
        .agg(F.count("l_orderkey").alias("assigned_count"))
        .orderBy("n_nationkey", "ship_date", "l_returnflag", "l_linestatus")
    )


# ---------------------------------------------------------------- Q13


def ancestor_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    cust = t["customer"].select("c_custkey", "c_name", "c_mktsegment")
    nodes = cust.select(
        "c_custkey", F.when(F.col("c_custkey") != 0, F.expr("c_custkey div 10")).alias("parent_key")
    )
    walk = ancestors(nodes, "c_custkey", "parent_key")
    c1 = cust.select(F.col("c_custkey").alias("k1"), F.col("c_name").alias("customer_name"))
    c2 = cust.select(
        F.col("c_custkey").alias("k2"), F.col("c_name").alias("supervisor_name"), F.col("c_mktsegment").alias("supervisor_segment")
    )
    return (
        walk.join(c1, walk.origin_c_custkey == c1.k1)
        .join(c2, walk.ancestor_c_custkey == c2.k2)
        .select(
            F.col("origin_c_custkey").alias("customer_key"), "customer_name",
            F.col("ancestor_c_custkey").alias("supervisor_key"), "supervisor_name", "supervisor_segment",
            F.col("level").alias("hierarchy_level"),
        )
    )


def reply_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    conv = t["conversations"].select("conv_id", "turn", "role")
    nodes = conv.select(
        "conv_id", "turn",
        F.when(F.col("turn") > 0, F.col("conv_id")).alias("parent_conv"),
        F.when(F.col("turn") > 0, F.col("turn") - 1).alias("parent_turn"),
    )
    walk = ancestors(nodes, ["conv_id", "turn"], ["parent_conv", "parent_turn"])
    anc = conv.select(F.col("conv_id").alias("a_conv"), F.col("turn").alias("a_turn"), F.col("role").alias("ancestor_role"))
    return (
        walk.join(anc, (walk.ancestor_conv_id == anc.a_conv) & (walk.ancestor_turn == anc.a_turn))
        .select(
            F.col("origin_conv_id").alias("conv_id"), F.col("origin_turn").alias("turn"),
            F.col("ancestor_turn"), "ancestor_role", F.col("level").alias("hierarchy_level"),
        )
    )


# ---------------------------------------------------------------- Q14


def consecutive_equal_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t["lineitem"].select("l_partkey", "l_shipdate")
    p = t["part"].select("p_partkey", "p_brand", "p_type")
    counts = (
        lookup(li, p, [("l_partkey", "p_partkey")])
        .groupBy("p_brand", "p_type", F.year("l_shipdate").alias("ship_year"))
        .agg(F.count(F.lit(1)).alias("n_items"))
        .filter(F.col("n_items") >= R.MIN_ADMISSIONS)
    )
    return (
        consecutive_equal(counts, ["p_brand", "p_type"], "ship_year", "n_items")
        .select("p_brand", "p_type", F.col("period_1").alias("year_1"), F.col("period_2").alias("year_2"), "n_items")
        .orderBy(F.col("n_items").desc(), "p_brand", "p_type", "year_1")
    )


# ---------------------------------------------------------------- Q15


def triage_referral(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    ev = t["events"].select("event_id", "user_id", "ts", "event_type", "value", "props")
    # service start = the user's next event of any kind (NULL for the last one)
    ev = next_in_key(ev, "user_id", "ts", "event_id", "service_start_ts")
    visits = ev.filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("visit_id"), "user_id", F.col("ts").alias("arrival_ts"),
        F.floor(F.col("value") / 50).cast("int").alias("emergency_level"),
        "service_start_ts",
        F.when(F.get_json_object("props", "$.k").cast("int") >= 50, F.lit("HOSPITALIZED"))
        .otherwise(F.lit("DISCHARGED")).alias("disposition"),
    )
    stays = t["events"].filter(F.col("event_type").isin("purchase", "signup")).select(
        F.col("user_id").alias("stay_user"), F.col("ts").alias("admission_ts"), F.col("event_type").alias("department_name")
    )
    vd = interval_join(
        visits, stays, keys=[("user_id", "stay_user")], left_ts="arrival_ts", right_ts="admission_ts",
        hours=R.REFERRAL_HOURS,
    ).withColumn("wait_time_mins", minutes_between("arrival_ts", "service_start_ts"))
    return triage_summary(vd)


# ---------------------------------------------------------------- audits D1-D6


def audit_primary_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return A.audit_primary_key(t["lineitem"], "lineitem", ["l_orderkey", "l_linenumber"])


def audit_unique_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return A.audit_unique(t["orders"], "orders", ["o_custkey", "o_orderdate"]).unionByName(
        A.audit_unique(t["customer"], "customer", ["c_name"])
    )


def audit_not_null_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t["lineitem"]
    e, c = t["events"].select("event_id", "user_id", "value"), t["customer"].select("c_custkey", "c_name")
    seen = c.join(e, e.user_id == c.c_custkey, "left")  # customers without events have NULLs
    return A.audit_not_null(li, "lineitem", ["l_orderkey", "l_linenumber"], li.columns).unionByName(
        A.audit_not_null(seen, "customer", ["c_custkey", "event_id"], ["c_name", "event_id", "value"]))


def audit_check_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_shipdate")
    o = t["orders"].select("o_orderkey", "o_orderdate")
    lo = li.join(o, li.l_orderkey == o.o_orderkey)
    return A.union_all([
        A.audit_check(lo, "lineitem", ["l_orderkey", "l_linenumber"], {"ship_after_order": "l_shipdate >= o_orderdate"}),
        A.audit_check(t["supplier"], "supplier", ["s_suppkey"], {"supplier_acctbal_nonneg": F.col("s_acctbal") >= 0}),
        A.audit_check(t["customer"], "customer", ["c_custkey"], {"customer_acctbal_nonneg": F.col("c_acctbal") >= 0}),
    ])


def audit_check_forms_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CHECK forms of the schema: BETWEEN, IN, IS NULL OR, and kind with its time of day (TIME as text)."""
    t = _t(spark, sf_dir)
    c = t["customer"].select("c_custkey", "c_acctbal")
    e = t["events"].select("event_id", "event_type", "value", "user_id", F.date_format("ts", "HH:mm:ss").alias("clock"))
    e = e.join(c, e.user_id == c.c_custkey, "left")
    return A.audit_check(e, "events", "event_id", {
        "value_between": "value BETWEEN 5 AND 95",
        "type_in": "event_type IN ('view', 'click', 'purchase', 'signup')",
        "balance_null_or_positive": "c_acctbal IS NULL OR c_acctbal > 0",
        "type_and_clock": "(event_type = 'view' AND clock >= '07:00:00' AND clock < '15:00:00')"
                          " OR (event_type = 'click' AND clock >= '15:00:00' AND clock < '23:00:00')"
                          " OR event_type NOT IN ('view', 'click')",
    })


def default_values_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared defaults filled in: balance and segment of the user of every event, 0 and 'NONE' where there is none."""
    t = _t(spark, sf_dir)
    c = t["customer"].select("c_custkey", "c_acctbal", "c_mktsegment")
    e = t["events"].select("event_id", "user_id")
    return e.join(c, e.user_id == c.c_custkey, "left").select(
        "event_id", F.coalesce("c_acctbal", F.lit(0.0)).alias("balance"), F.coalesce("c_mktsegment", F.lit("NONE")).alias("segment"))


def audit_unique_collated_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique part names in a case-insensitive database; every second name is in capitals here."""
    t = _t(spark, sf_dir)
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return A.audit_unique(t["part"].select(name.alias("p_name")), "part", "p_name", collation="UNICODE_CI_AI_RTRIM")


def audit_length_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return A.audit_length(t["part"], "part", ["p_partkey"], {"p_name": 10, "p_brand": 10}).unionByName(
        A.audit_length(t["customer"], "customer", ["c_custkey"], {"c_name": 18})
    )


def audit_decimal_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return A.audit_decimal(t["customer"], "customer", ["c_custkey"], {"c_acctbal": (5, 2)})


def audit_foreign_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return A.audit_foreign_key(
        t["lineitem"], "lineitem", ["l_orderkey", "l_linenumber"], "l_orderkey", t["orders"], "o_orderkey"
    ).unionByName(
        A.audit_foreign_key(t["customer"], "customer", "c_custkey", "c_custkey", t["events"], "user_id")
    )


# A catalogue over the growing tables; some of its constraints hold, others don't.
TEST_CATALOGUE = Catalogue(
    primary_keys={"customer": ("c_custkey",), "supplier": ("s_suppkey",), "part": ("p_partkey",), "orders": ("o_orderkey",),
                  "lineitem": ("l_orderkey", "l_linenumber"), "events": ("event_id",)},
    uniques=[("orders", ("o_custkey", "o_orderdate")), ("customer", ("c_name",)), ("part", ("p_name",)), ("part", ("p_brand", "p_type", "p_size")),
             ("events", ("user_id", "event_type")), ("lineitem", ("l_partkey", "l_suppkey", "l_shipdate"))],
    foreign_keys=[ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",)), ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
                  ForeignKey("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)), ForeignKey("lineitem", ("l_partkey",), "part", ("p_partkey",)),
                  ForeignKey("events", ("user_id",), "customer", ("c_custkey",)), ForeignKey("part", ("p_partkey",), "customer", ("c_custkey",)),
                  ForeignKey("customer", ("c_custkey",), "events", ("user_id",)), ForeignKey("customer", ("c_custkey", "c_nationkey"), "supplier", ("s_suppkey", "s_nationkey"))],
    not_null={"lineitem": ("l_orderkey", "l_suppkey", "l_shipdate"), "events": ("user_id", "ts")},
    checks={"supplier": {"balance": "s_acctbal >= 0"}, "customer": {"balance": "c_acctbal >= 0"}, "events": {"value": "value BETWEEN 5 AND 95"}},
    lengths={"part": {"p_name": 10, "p_brand": 10}, "customer": {"c_name": 18}},
    decimals={"customer": {"c_acctbal": (5, 2)}},
)


def roster_flag_now_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 and Q9 by the clock: customers with an order within as many days as lie between 1998-01-01 and today, and days since their last order."""
    t = _t(spark, sf_dir)
    c = t["customer"].select("c_custkey")
    now, today = F.current_timestamp(), F.current_date()
    since = F.datediff(today, F.lit("1998-01-01").cast("date"))
    o = t["orders"].select("o_custkey", "o_orderdate")
    last = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    recent = o.filter(days_between("o_orderdate", today) < since).select("o_custkey")
    out = flag_any(c, "c_custkey", recent, "o_custkey", "had_recent_order").join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
    days = days_between(F.coalesce(F.col("last_order").cast("timestamp"), now), now)
    return out.select("c_custkey", "had_recent_order", days.cast("long").alias("days_since"), F.year(today).alias("this_year"))


def audit_all_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1-D6 at once over a catalogue of six tables: keys, foreign keys and row rules."""
    return declared_constraints(_t(spark, sf_dir), catalogue=TEST_CATALOGUE)


# ---------------------------------------------------------------- D7, D8, ids

TEST_FKS = [
    ForeignKey("nation", ("n_regionkey",), "region", ("r_regionkey",), "CASCADE"),
    ForeignKey("customer", ("c_nationkey",), "nation", ("n_nationkey",), "CASCADE"),
    ForeignKey("supplier", ("s_nationkey",), "nation", ("n_nationkey",), "RESTRICT"),
    ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",), "CASCADE"),
    ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",), "CASCADE"),
    ForeignKey("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",), "RESTRICT"),
]
TEST_KEYS = {
    "region": ("r_regionkey",), "nation": ("n_nationkey",), "customer": ("c_custkey",),
    "supplier": ("s_suppkey",), "orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_linenumber"),
}
DELETE_REGION = "AFRICA"


def propagate_delete_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    tables = {name: t[name] for name in TEST_KEYS}
    doomed = t["region"].filter(F.col("r_name") == DELETE_REGION)
    return propagate_delete(tables, TEST_FKS, {"region": doomed}, TEST_KEYS).summary()


def _delete_by_keys(spark: SparkSession, sf_dir: str):
    t = _t(spark, sf_dir)
    # a second RESTRICT key of line items on customers, through their order, gives rows with two of them
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey")
    o = t["orders"].select("o_orderkey", "o_custkey")
    li = li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("l_custkey")), "l_orderkey")
    tables = {"region": t["region"].select("r_regionkey", "r_name"), "nation": t["nation"].select("n_nationkey", "n_regionkey"),
              "customer": t["customer"].select("c_custkey", "c_nationkey"), "supplier": t["supplier"].select("s_suppkey", "s_nationkey"),
              "lineitem": li}
    fks = [ForeignKey("nation", ("n_regionkey",), "region", ("r_regionkey",), "CASCADE"),
           ForeignKey("customer", ("c_nationkey",), "nation", ("n_nationkey",), "CASCADE"),
           ForeignKey("supplier", ("s_nationkey",), "nation", ("n_nationkey",), "CASCADE"),
           ForeignKey("lineitem", ("l_custkey",), "customer", ("c_custkey",), "RESTRICT"),
           ForeignKey("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",), "RESTRICT")]
    return propagate_delete(tables, fks, {"region": tables["region"].filter(F.col("r_name") == DELETE_REGION)},
                            {"region": ("r_regionkey",), "nation": ("n_nationkey",), "customer": ("c_custkey",), "supplier": ("s_suppkey",)})


def propagate_delete_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 row by row: the surviving keys of every table, and the line items that block, each once."""
    res = _delete_by_keys(spark, sf_dir)
    out = [res.survivors[t].select(F.lit(t).alias("table_name"), F.lit("survives").alias("outcome"), F.col(k).cast("string").alias("key_value"))
           for t, k in (("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"))]
    held = res.blocked["lineitem"].select(F.lit("lineitem").alias("table_name"), F.lit("blocks").alias("outcome"),
                                          A.key_text(["l_orderkey", "l_linenumber"]).alias("key_value"))
    return A.union_all([*out, held])


def propagate_key_change_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 row by row: nation of every customer and supplier, and every nation, after the renumbering."""
    t = _t(spark, sf_dir)
    tables = {name: t[name] for name in TEST_KEYS}
    moved = t["nation"].join(t["region"].filter(F.col("r_name") == DELETE_REGION), F.col("n_regionkey") == F.col("r_regionkey"))
    key_map = moved.select(F.col("n_nationkey").alias("old_key"), (F.col("n_nationkey") + 100).alias("new_key"))
    new = propagate_key_change(tables, TEST_FKS, "nation", "n_nationkey", key_map).tables
    parts = [new[tab].select(F.lit(tab).alias("table_name"), F.col(k).cast("long").alias("row_key"), F.col(c).cast("long").alias("nation_key"))
             for tab, k, c in (("customer", "c_custkey", "c_nationkey"), ("supplier", "s_suppkey", "s_nationkey"))]
    return A.union_all([*parts, new["nation"].select(F.lit("nation").alias("table_name"), F.lit(None).cast("long").alias("row_key"),
                                                     F.col("n_nationkey").cast("long").alias("nation_key"))])


def propagate_key_change_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    tables = {name: t[name] for name in TEST_KEYS}
    # renumber the nations of one region: key k becomes k + 100
    moved = t["nation"].join(t["region"].filter(F.col("r_name") == DELETE_REGION), F.col("n_regionkey") == F.col("r_regionkey"))
    key_map = moved.select(F.col("n_nationkey").alias("old_key"), (F.col("n_nationkey") + 100).alias("new_key"))
    res = propagate_key_change(tables, TEST_FKS, "nation", "n_nationkey", key_map)
    return res.summary()


def assign_ids_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    ev = t["events"].select("event_id", "ts")
    return assign_ids(ev, ["ts", "event_id"], id_col="seq_id", start=1).select("event_id", "seq_id")


# ---------------------------------------------------------------- trigger rules


def find_cycles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item's part supervised by the part of the supplier that the line names (a graph that grows with the table)."""
    t = _t(spark, sf_dir)
    li = t["lineitem"].select("l_partkey", "l_suppkey", "l_orderkey")
    nodes = li.groupBy("l_partkey").agg(F.max(F.struct("l_orderkey", "l_suppkey")).alias("last"))
    nodes = nodes.select("l_partkey", F.when(F.col("last.l_orderkey") % 97 > 0, F.col("last.l_suppkey")).alias("parent_key"))
    return find_cycles(nodes, "l_partkey", "parent_key")


def find_cycles_orders_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers pointing to the customer of the order numbered like them (a random functional graph)."""
    t = _t(spark, sf_dir)
    c = t["customer"].select("c_custkey")
    o = t["orders"].select("o_orderkey", "o_custkey")
    nodes = c.join(o, c.c_custkey == o.o_orderkey, "left").select("c_custkey", F.col("o_custkey").alias("parent_key"))
    return find_cycles(nodes, "c_custkey", "parent_key")


def find_cycles_repeated_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as nodes, one row per order: repeated nodes with several parents, and roots."""
    t = _t(spark, sf_dir)
    up = F.when(F.col("o_orderkey") % 7 != 0, F.expr("(o_orderkey * 3) div 40"))
    nodes = t["orders"].select("o_custkey", up.alias("parent_key"))
    return find_cycles(nodes, "o_custkey", "parent_key")


def conflict_pairs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose supplier shares a nation with the ordering customer (the allergy rule's shape)."""
    t = _t(spark, sf_dir)
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey")
    o = t["orders"].select("o_orderkey", "o_custkey")
    allergy = t["customer"].select(F.col("c_custkey").alias("a_cust"), F.col("c_nationkey").alias("a_sub"))
    contains = t["supplier"].select(F.col("s_suppkey").alias("d_supp"), F.col("s_nationkey").alias("d_sub"))
    rx = li.join(o, li.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", "l_suppkey", "o_custkey")
    from wardline.plans.rules import conflicts

    return conflicts(rx, "o_custkey", "l_suppkey", allergy, "a_cust", "a_sub", contains, "d_supp", "d_sub").select(
        "l_orderkey", "l_linenumber", F.col("o_custkey").alias("c_custkey"), F.col("l_suppkey").alias("s_suppkey"),
        F.col("substance").alias("shared_nationkey"),
    )


def _event_intervals(t: TableSet) -> DataFrame:
    return t["events"].select(
        "event_id", "user_id", F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("end_ts")
    )


def overlap_pairs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return overlap_pairs(_event_intervals(t), "user_id", "event_id", "start_ts", "end_ts").select(
        "user_id", "event_id_a", "event_id_b"
    )


def overlap_flags_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return overlap_flags(_event_intervals(t), "user_id", "event_id", "start_ts", "end_ts").select(
        "event_id", "user_id", "start_ts"
    )


def cross_overlap_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5b's shape: a user's purchase (as "chief") overlapping one of their views (as "participant")."""
    t = _t(spark, sf_dir)
    iv = t["events"].select("event_id", "user_id", "event_type", F.col("ts").alias("start_ts"),
                            (F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("end_ts"))
    purchases = iv.filter(F.col("event_type") == "purchase").drop("event_type")
    views = iv.filter(F.col("event_type") == "view").drop("event_type")
    return cross_overlap_pairs(purchases, views, "user_id", "event_id", "start_ts", "end_ts").select(
        "user_id", F.col("left_event_id").alias("purchase_event_id"), F.col("right_event_id").alias("view_event_id"))


def supervision_checks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1a-c's shape on the customer tree: no self-parent; BUILDING needs a parent; AUTOMOBILE has none."""
    t = _t(spark, sf_dir)
    nodes = t["customer"].select(
        "c_custkey", "c_mktsegment", F.when(F.col("c_custkey") != 0, F.expr("c_custkey div 10")).alias("parent_key"))
    return A.audit_check(nodes, "customer", ["c_custkey"], {
        "no_self_parent": F.coalesce(F.col("parent_key") != F.col("c_custkey"), F.lit(True)),
        "building_needs_parent": ~((F.col("c_mktsegment") == "BUILDING") & F.col("parent_key").isNull()),
        "automobile_has_no_parent": ~((F.col("c_mktsegment") == "AUTOMOBILE") & F.col("parent_key").isNotNull()),
    })


def _half_hours(df: DataFrame) -> DataFrame:
    return df.select("event_id", "user_id", F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("end_ts"))


def place_overlap_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3's shape: an event that overlaps an earlier one of the same kind and hour of the day (the place)."""
    t = _t(spark, sf_dir)
    place = F.concat_ws("-", "event_type", F.hour("ts").cast("string"))
    iv = t["events"].select("event_id", place.alias("place"), F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("INTERVAL 10 MINUTES")).alias("end_ts"))
    return overlap_flags(iv, "place", "event_id", "start_ts", "end_ts").select("event_id", "place")


def chief_overlap_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4's shape: an order within 30 days of an earlier order of the same customer."""
    t = _t(spark, sf_dir)
    o = t["orders"].select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("s"), (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("e"))
    return overlap_flags(o, "o_custkey", "o_orderkey", "s", "e").select("o_orderkey", "o_custkey")


def _supply(t: TableSet) -> DataFrame:
    """Suppliers' part in orders with the order's time: the participant table joined to its events."""
    o = t["orders"].select(F.col("o_orderkey").alias("event"), F.col("o_orderdate").alias("s"), (F.col("o_orderdate") + F.expr("INTERVAL 12 HOURS")).alias("e"))
    li = t["lineitem"].select(F.col("l_orderkey").alias("event"), F.col("l_suppkey").alias("person")).distinct()
    return li.join(o, "event")


def participant_overlap_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5a's shape with the event-time join: a supplier's part in an order that overlaps an earlier one of its orders."""
    rows = _supply(_t(spark, sf_dir))
    return overlap_flags(rows, "person", "event", "s", "e").select("event", "person")


def busy_chief_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5b's shape: a supplier's part in an order while the person of that number is the customer of another overlapping one."""
    from wardline.plans.rules import busy_chief_rows

    t = _t(spark, sf_dir)
    chiefs = t["orders"].select(F.col("o_orderkey").alias("event"), F.col("o_custkey").alias("person"), F.col("o_orderdate").alias("s"),
                                (F.col("o_orderdate") + F.expr("INTERVAL 12 HOURS")).alias("e"))
    return busy_chief_rows(_supply(t), chiefs, "person", "event", "s", "e")


GATE_STORED = ("purchase", "signup")
GATE_FIRST = ("view", "click")


def ingest_gate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 on the test tables: events arrive as a stream in two micro-batches, with others stored already.

    Purchases and signups are stored; views and clicks arrive first, the rest
    after them.  Events are admitted one by one in the order of their id: one that
    overlaps a stored or admitted event of the same user (30-minute intervals) is
    refused, as is one of a user who is not a customer.  What users have
    occupied is the stream's keyed state.  The result is the rejected rows,
    one per failing rule.
    """
    import uuid

    from wardline.session import ensure_checkpoint_dir
    from wardline.streaming.keyed import admitted, run_keyed_gate

    t = _t(spark, sf_dir)
    run = f"{ensure_checkpoint_dir(spark)}/ingest-gate-{uuid.uuid4().hex}"
    events, customers = t["events"], t["customer"].select("c_custkey")
    kind, end = F.col("event_type"), F.col("ts") + F.expr("INTERVAL 30 MINUTES")
    stored = events.filter(kind.isin(*GATE_STORED)).withColumn("end_ts", end)
    unknown = F.col("user_id").isNotNull() & F.col("c_custkey").isNull()

    # two deliveries into one folder, each taken up by the next run of the stream
    for sent in (kind.isin(*GATE_FIRST), ~kind.isin(*GATE_STORED, *GATE_FIRST) | kind.isNull()):
        events.filter(sent).write.mode("append").parquet(f"{run}/in")
        source = spark.readStream.schema(events.schema).parquet(f"{run}/in").withColumn("end_ts", end)
        source = source.join(customers, F.col("user_id") == F.col("c_custkey"), "left")
        checked = admitted(source, stored, "user_id", "event_id", "ts", "end_ts", static={"unknown_user": unknown}, cell_seconds=30 * 86_400)
        q = run_keyed_gate(checked, f"{run}/out", checkpoint_location=f"{run}/checkpoint", key=["event_id"])
        q.awaitTermination()  # availableNow: ends when what has arrived is done
        if q.exception() is not None:
            raise q.exception()
    return spark.read.parquet(f"{run}/out/rejected").select("event_id", "rule")


def accept_in_order_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3-T5's shape as a trigger sees it: events admitted one by one by id, none overlapping an admitted one of its user (6 hours)."""
    from wardline.operators.acceptance import accept_in_order

    t = _t(spark, sf_dir)
    events = t["events"].select("event_id", "user_id", "ts", (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("end_ts"))
    accepted, refused = accept_in_order(events, None, ["event_id"], [("overlaps", "user_id", "ts", "end_ts")])
    out = accepted.select("event_id", "user_id", F.lit(None).cast("string").alias("rule"))
    return out.unionByName(refused.select("event_id", "user_id", "rule"))


def role_conflict_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7's shape: line items whose supplier key equals their own order's customer key (lead listed as member)."""
    from wardline.plans.rules import role_conflicts

    t = _t(spark, sf_dir)
    members = t["lineitem"].select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("person_key"))
    leads = t["orders"].select("o_orderkey", "o_custkey")
    return role_conflicts(members, "l_orderkey", "person_key", leads, "o_orderkey", "o_custkey").select(
        "l_orderkey", "l_linenumber", "person_key")


def forbidden_member_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8's shape: line items supplied by a supplier in a forbidden category (negative balance)."""
    from wardline.plans.rules import forbidden_members

    t = _t(spark, sf_dir)
    members = t["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey")
    return forbidden_members(members, "l_suppkey", t["supplier"], "s_suppkey", F.col("s_acctbal") < 0)


def mismatch_lookup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t["lineitem"].filter(F.col("l_linestatus") != "F").select("l_orderkey", "l_linenumber", "l_linestatus")
    o = t["orders"].filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.col("o_orderstatus").alias("required_status"), F.col("l_linestatus").alias("actual_status")
    )


QUERIES: dict[str, Query] = {
    "revenue_rollup": revenue_rollup,
    "roster_flag": roster_flag,
    "frequent_groups": frequent_groups,
    "bridge_average": bridge_average,
    "filtered_leaderboard": filtered_leaderboard,
    "entity_timeline": entity_timeline,
    "entity_timeline_reduced": entity_timeline_reduced,
    "dual_role_lookup": dual_role_lookup,
    "dual_optional_counts": dual_optional_counts,
    "not_assigned": not_assigned,
    "equal_measure_pairs": equal_measure_pairs_q,
    "equal_measure_groups": equal_measure_groups_q,
    "pair_cooccurrence": pair_cooccurrence_q,
    "gap_to_max": gap_to_max_q,
    "weekly_roster": weekly_roster,
    "ancestor_closure": ancestor_closure,
    "reply_chain": reply_chain,
    "consecutive_equal": consecutive_equal_q,
    "triage_referral": triage_referral,
    "audit_primary_key": audit_primary_key_q,
    "audit_unique": audit_unique_q,
    "audit_not_null": audit_not_null_q,
    "audit_check": audit_check_q,
    "audit_check_forms": audit_check_forms_q,
    "audit_unique_collated": audit_unique_collated_q,
    "default_values": default_values_q,
    "audit_length": audit_length_q,
    "audit_decimal": audit_decimal_q,
    "audit_foreign_key": audit_foreign_key_q,
    "propagate_delete": propagate_delete_q,
    "propagate_delete_rows": propagate_delete_rows_q,
    "propagate_key_change": propagate_key_change_q,
    "propagate_key_change_rows": propagate_key_change_rows_q,
    "assign_ids": assign_ids_q,
    "find_cycles": find_cycles_q,
    "find_cycles_orders": find_cycles_orders_q,
    "find_cycles_repeated": find_cycles_repeated_q,
    "conflict_pairs": conflict_pairs_q,
    "overlap_pairs": overlap_pairs_q,
    "overlap_flags": overlap_flags_q,
    "mismatch_lookup": mismatch_lookup_q,
    "cross_overlap": cross_overlap_q,
    "place_overlap": place_overlap_q,
    "chief_overlap": chief_overlap_q,
    "participant_overlap": participant_overlap_q,
    "busy_chief": busy_chief_q,
    "supervision_checks": supervision_checks_q,
    "audit_all": audit_all_q,
    "roster_flag_now": roster_flag_now_q,
    "ingest_gate": ingest_gate_q,
    "accept_in_order": accept_in_order_q,
    "role_conflict": role_conflict_q,
    "forbidden_member": forbidden_member_q,
}
