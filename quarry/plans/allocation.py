"""Bid allocation over FIX-13: bids from lineitem, budgets from supplier, arrivals from orders."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import aggregate as agg
from quarry.operators import allocation as al
from quarry.plans import fixtures as fx
from quarry.plans.registry import register

BASE = fx.with_sql(bi=fx.BIDS_SQL, bu=fx.BUDGETS_SQL, ar=fx.ARRIVALS_SQL,
                   el="SELECT bi.*, bu.budget AS remaining FROM bi JOIN bu USING (advertiser) WHERE bu.budget > bi.bid")


def raw_bid_rows(spark, d):
    """Rows in the reference's file layout: the budget only on an advertiser's first row (lowest keyword)."""
    b = fx.bids(spark, d).join(fx.budgets(spark, d), "advertiser")
    first = b.groupBy("advertiser").agg(F.min("keyword").alias("__k"))
    return (b.join(first, "advertiser")
            .select("advertiser", "keyword", "bid", F.when(F.col("keyword") == F.col("__k"), F.col("budget")).alias("budget"),
                    (F.col("advertiser") * 1000 + F.col("keyword")).alias("row_no")))


@register("revenue_bound", "2.4", BASE + " SELECT sum(budget) AS revenue_bound FROM bu")
def q_revenue_bound(spark, d):
    return agg.revenue_bound(fx.budgets(spark, d))


@register("advertiser_budgets", "2.4", BASE + (
    ", raw AS (SELECT bi.advertiser, bi.keyword, bi.bid, CASE WHEN bi.keyword = (SELECT min(keyword) FROM bi b2 "
    "WHERE b2.advertiser = bi.advertiser) THEN bu.budget END AS budget FROM bi JOIN bu USING (advertiser)) "
    "SELECT advertiser, coalesce(max(round_even(budget, 2)), 0.0) AS budget FROM raw GROUP BY advertiser"))
def q_advertiser_budgets(spark, d):
    return agg.advertiser_budgets(raw_bid_rows(spark, d))


@register("latest_bids", "2.4", BASE + " SELECT keyword, advertiser, round_even(bid, 2) AS bid FROM bi")
def q_latest_bids(spark, d):
    return agg.latest_bids(raw_bid_rows(spark, d))


def _best_sql(score):
    return BASE + (f", w AS (SELECT keyword, advertiser, bid, row_number() OVER (PARTITION BY keyword ORDER BY {score} DESC, "
                   "advertiser) AS rn FROM el) SELECT ar.query_id, ar.keyword, w.advertiser, w.bid FROM ar JOIN w "
                   "ON ar.keyword = w.keyword AND w.rn = 1")


@register("greedy_best_bid", "2.5", _best_sql("bid"))
def q_greedy_best_bid(spark, d):
    return al.best_bid(fx.arrivals(spark, d), fx.bids(spark, d), fx.budgets(spark, d), "greedy")


@register("balance_best_bid", "2.5", _best_sql("remaining"))
def q_balance_best_bid(spark, d):
    return al.best_bid(fx.arrivals(spark, d), fx.bids(spark, d), fx.budgets(spark, d), "balance")


@register("msvv_best_bid", "2.5", _best_sql("bid * (1 - exp(0.0 / (remaining + 0.0) - 1))"))
def q_msvv_best_bid(spark, d):
    return al.best_bid(fx.arrivals(spark, d), fx.bids(spark, d), fx.budgets(spark, d), "msvv")


@register("budgeted_allocation_rounds", "2.5")
def q_budgeted_allocation_rounds(spark, d):
    arr = fx.arrivals(spark, d)
    assign, _ = al.budgeted_allocation_rounds(arr, fx.bids(spark, d), fx.budgets(spark, d), "greedy",
                                              round_size=10000, order=["o_orderdate", "query_id"])
    return assign
