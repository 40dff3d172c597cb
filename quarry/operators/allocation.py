"""Budgeted bid allocation (online bipartite matching): greedy, balance and MSVV choices, and a
round-based allocator.

Inputs: ``bids(advertiser, keyword, bid)``, ``budgets(advertiser, budget)`` (remaining), optional
``spent(advertiser, spent)``, ``arrivals(query_id, keyword, arrival)``.  A bidder is eligible for a
query when its remaining budget is strictly greater than its bid.  Ties go to the lower advertiser id.
"""
from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.sequence import dense_index
from quarry.session import Scratch


def _score(rule: str, bid=None, remaining=None, spent=None):
    bid, remaining, spent = (F.col(name) if c is None else c for c, name in ((bid, "bid"), (remaining, "remaining"), (spent, "spent")))
    if rule == "greedy":
        return bid
    if rule == "balance":
        return remaining
    if rule == "msvv":
        return bid * (1 - F.exp(spent / (remaining + spent) - 1))
    raise ValueError(rule)


def best_bidder_per_keyword(bids: DataFrame, budgets: DataFrame, rule: str, spent: DataFrame | None = None) -> DataFrame:
    """``(keyword, advertiser, bid)``: the chosen bidder of each keyword under static budgets.  The
    choice depends on the keyword only, so it is one grouped ``max_by`` (partial aggregation) instead of
    a ranking per arriving query."""
    b = bids.join(budgets.select("advertiser", F.col("budget").alias("remaining")), "advertiser")
    if spent is not None:
        b = b.join(spent.select("advertiser", "spent"), "advertiser", "left").withColumn("spent", F.coalesce("spent", F.lit(0.0)))
    else:
        b = b.withColumn("spent", F.lit(0.0))
    elig = b.filter(F.col("remaining") > F.col("bid")).withColumn("__s", _score(rule))
    return (elig.groupBy("keyword")
            .agg(F.max_by(F.struct("advertiser", "bid"), F.struct(F.col("__s"), -F.col("advertiser"))).alias("w"))
            .select("keyword", "w.advertiser", "w.bid"))


def best_bid(arrivals: DataFrame, bids: DataFrame, budgets: DataFrame, rule: str,
             spent: DataFrame | None = None) -> DataFrame:
    """Per arriving query: the winning advertiser and bid under static budgets (no winner → no row)."""
    return arrivals.join(best_bidder_per_keyword(bids, budgets, rule, spent), "keyword").select(
        "query_id", "keyword", "advertiser", "bid")


#: Queries and offers that one step plays through, about.
QUERIES, OFFERS = 100_000, 131_072


class _Market:
    """The best offers of some keywords and what their advertisers have left.  Budgets only fall, and scores with them, so a
    keyword's choice stays the best until its advertiser pays, and offers beyond a cut list can't pass its last one."""

    def __init__(self, offers: pd.DataFrame, rule: str):
        self.rule = rule
        held = offers.drop_duplicates("advertiser").sort_values("advertiser", kind="stable")
        self.names = held["advertiser"].to_numpy()
        self.size = held["held"].map(len).to_numpy(dtype=np.int64)                    # rows of an advertiser, one as a rule
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        rows = [row for some in held["held"] for row in some]
        self.budget, self.spent = (np.array([r[c] for r in rows], dtype=np.float64) for c in ("budget", "spent"))
        self.place = np.array([r["place"] for r in rows], dtype=np.int64)
        offers = offers.sort_values(["keyword", "advertiser"], kind="stable")
        self.keywords, first = np.unique(offers["keyword"].to_numpy(), return_index=True)
        self.more = offers["more"].to_numpy(dtype=bool)[first]
        owner = np.searchsorted(self.names, offers["advertiser"].to_numpy())
        at = np.repeat(np.arange(len(offers)), self.size[owner])                      # an offer for each of its advertiser's rows
        self.owner, self.bid = owner[at], offers["bid"].to_numpy(dtype=np.float64)[at]
        self.slot = self.start[self.owner] + np.arange(len(at)) - np.searchsorted(at, at)
        self.bounds = np.searchsorted(at, np.append(first, len(offers)))
        n = len(self.keywords)
        self.last = [self._last(k) if self.more[k] else None for k in range(n)]
        self.stale, self.best, self.price = np.ones(n, dtype=bool), np.full(n, -1), np.zeros(n)
        self.touched = np.zeros(len(self.names), dtype=bool)

    def _scores(self, k: int):
        part = slice(self.bounds[k], self.bounds[k + 1])
        bid, left, spent = self.bid[part], self.budget[self.slot[part]], self.spent[self.slot[part]]
        able = left > bid
        if self.rule == "greedy":
            score = bid
        elif self.rule == "balance":
            score = left
        else:
            with np.errstate(divide="ignore", invalid="ignore"):
                score = bid * (1 - np.exp(spent / (left + spent) - 1))
        return self.owner[part], bid, np.where(able, score, -np.inf), able

    def _last(self, k: int) -> tuple[float, int]:
        owner, _, score, able = self._scores(k)
        low = score[able].min()
        return low, owner[able & (score == low)].max()

    def choose(self, k: int) -> bool:
        """Finds keyword k's best offer; False if one beyond its list may be better."""
        owner, bid, score, able = self._scores(k)
        j = int(np.argmax(score))                                                     # ties: smaller advertiser
        if self.more[k] and not (able[j] and (score[j] > self.last[k][0] or score[j] == self.last[k][0] and owner[j] <= self.last[k][1])):
            return False
        self.best[k], self.price[k], self.stale[k] = (owner[j], bid[j], False) if able[j] else (-1, 0.0, False)
        return True

    def pay(self, who: int, amount: float) -> None:
        rows = slice(self.start[who], self.start[who + 1])
        self.budget[rows] -= amount
        self.spent[rows] += amount
        self.touched[who] = True


def _sub_round(market: _Market, codes: np.ndarray, pending: np.ndarray):
    """Every pending query (places, in order of arrival) tries its keyword's choice: (winners, advertisers, bids, losers), or
    None where a list must be filled up first."""
    for k in np.unique(codes[pending]):
        if market.stale[k] and not market.choose(k):
            return None
    who = market.best[codes[pending]]
    pending, who = pending[who >= 0], who[who >= 0]
    rows = np.repeat(np.arange(len(pending)), market.size[who])
    offset = np.arange(len(rows)) - np.searchsorted(rows, rows)
    order = np.argsort(who[rows], kind="stable")
    rows, offset = rows[order], offset[order]
    owner, bid, won = who[rows], market.price[codes[pending[rows]]], np.zeros(len(rows), dtype=bool)
    for lo, hi in zip(*(np.searchsorted(owner, np.unique(owner), side=s) for s in ("left", "right"))):
        w, b = owner[lo], bid[lo:hi]
        before = np.concatenate([[0.0], np.cumsum(b)[:-1]])
        won[lo:hi] = market.budget[market.start[w] + offset[lo:hi]] - before > b
        if won[lo:hi].any():
            market.pay(w, np.cumsum(b[won[lo:hi]])[-1])
    market.stale |= np.isin(market.best, np.unique(owner))
    return pending[rows[won]], owner[won], bid[won], np.sort(pending[rows[~won]], kind="stable")


def _play(queries: pd.DataFrame, offers: pd.DataFrame, rule: str, round_size: int, columns: list[str]) -> pd.DataFrame:
    """Rounds of arrivals one after the other, as far as the lists of offers go.  Rows: ``won`` queries, the ``state`` rows
    that changed, queries ``left`` of the round that has to go on with longer lists, and the ``round`` to go on with."""
    queries, market = queries.sort_values("arrival", kind="stable").reset_index(drop=True), _Market(offers, rule)
    codes = pd.Index(market.keywords).get_indexer(queries["keyword"])
    rounds = queries["arrival"].to_numpy(dtype=np.int64) // round_size
    wins, left, at = [], np.zeros(0, dtype=np.int64), int(rounds[-1]) + 1
    for r in np.unique(rounds):
        pending = np.arange(*np.searchsorted(rounds, [r, r + 1]))
        pending = pending[codes[pending] >= 0]
        while len(pending):
            done = _sub_round(market, codes, pending)
            if done is None:
                left, at = pending, int(r)
                break
            wins.append(done[:3])
            pending = done[3]
        if len(left):
            break
    query, who, bid = (np.concatenate([w[i] for w in wins]) if wins else np.zeros(0, dtype=np.int64) for i in range(3))
    changed = np.repeat(market.touched, market.size)
    won = queries.loc[query, ["query_id", "arrival"]].assign(kind="won", advertiser=market.names[who], bid=bid)
    state = pd.DataFrame({"kind": "state", "arrival": market.place[changed], "bid": market.budget[changed], "spent": market.spent[changed]})
    parts = [won, state, queries.loc[left, ["query_id", "keyword", "arrival"]].assign(kind="left"), pd.DataFrame({"kind": ["round"], "arrival": [at]})]
    return pd.concat([p.reindex(columns=columns).astype(object) for p in parts if len(p)], ignore_index=True)


def budgeted_allocation_rounds(arrivals: DataFrame, bids: DataFrame, budgets: DataFrame, rule: str = "greedy",
                               round_size: int = 10_000, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Online allocation in rounds of ``round_size`` arrivals.  Within a round budgets are frozen: every query takes the best
    eligible bidder of its keyword (``best_bidder_per_keyword``), and a running sum over each advertiser's queries in arrival
    order cuts off those that its budget doesn't cover any more; they try again in a sub-round with the budgets that are
    left, until none has an eligible bidder.  With ``round_size=1`` this is the one-query-at-a-time algorithm; larger
    rounds differ from it only in that a choice doesn't see what its own sub-round spends, and nobody overspends.

    Sub-rounds depend on each other, and there may be one for every advertiser, so they can't be a job each.  Spark joins,
    filters and ranks the offers and deals out the best ``OFFERS`` of the next ``QUERIES`` arrivals' keywords; one task plays
    these rounds until a list of offers runs out, which the next step then fills up.  A step's size doesn't grow with the
    tables.  (Negative bids can raise budgets: then lists can't be cut, and a step gets all offers of its keywords.)

    Returns ``(assignments(query_id, advertiser, bid, arrival), budgets(advertiser, budget, spent))``."""
    spark, scratch = arrivals.sparkSession, Scratch(arrivals.sparkSession, "allocation")
    order = order or ["query_id"]
    arr = dense_index(arrivals.select("query_id", "keyword", *[c for c in order if c not in ("query_id", "keyword")]), order, "arrival")
    arr = scratch.write(arr.select("query_id", "keyword", "arrival", F.floor(F.col("arrival") / round_size).alias("round")), "arrivals")
    n_rounds = math.ceil(arr.count() / round_size)
    offers = scratch.write(bids.select("advertiser", "keyword", "bid").filter("bid IS NOT NULL AND keyword IS NOT NULL"), "offers-0")
    falling = (offers.agg(F.min("bid")).first()[0] or 0) >= 0
    state = scratch.write(budgets.select("advertiser", F.col("budget").cast("double").alias("budget"), F.lit(0.0).alias("spent"), F.monotonically_increasing_id().alias("place")), "state-0")
    kinds = {c: df.schema[c].dataType.simpleString() for c, df in (("query_id", arr), ("keyword", arr), ("advertiser", offers))}
    schema = f"kind string, query_id {kinds['query_id']}, keyword {kinds['keyword']}, arrival long, advertiser {kinds['advertiser']}, bid double, spent double"
    columns = ["kind", "query_id", "keyword", "arrival", "advertiser", "bid", "spent"]
    step, at, begun, results, per_step = 0, 0, None, [], max(1, QUERIES // round_size)
    able = F.filter("held", lambda h: h["budget"] > F.col("bid"))
    best = F.array_max(F.transform(able, lambda h: _score(rule, F.col("bid"), h["budget"], h["spent"])))
    ranked = Window.partitionBy("keyword").orderBy(F.col("score").desc(), "advertiser")

    def play(key, queries: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        return _play(queries, some, rule, round_size, columns)

    while at < n_rounds:
        step, until = step + 1, min(n_rounds, at + per_step)
        ahead = arr.filter((F.col("round") >= at + (begun is not None)) & (F.col("round") < until) & F.col("keyword").isNotNull()).select("query_id", "keyword", "arrival")
        ahead = ahead if begun is None else ahead.unionByName(begun)
        wanted = ahead.select("keyword").distinct()
        most = max(1, OFFERS // max(1, wanted.count()))
        held = state.filter("budget IS NOT NULL").groupBy("advertiser").agg(F.collect_list(F.struct("budget", "spent", "place")).alias("held"))
        open_ = offers.join(held, "advertiser")
        open_ = open_.filter(F.size(able) > 0) if falling else open_
        list_ = open_.join(wanted, "keyword", "left_semi")
        if falling:
            list_ = (list_.withColumn("score", best).withColumn("n", F.row_number().over(ranked)).filter(F.col("n") <= most + 1)
                     .withColumn("more", F.max("n").over(Window.partitionBy("keyword")) > most).filter(F.col("n") <= most))
        else:
            list_ = list_.withColumn("more", F.lit(False))
        list_ = scratch.write(list_.select("keyword", "advertiser", "bid", "held", "more"), f"list-{step}")
        if list_.isEmpty():                                               # nobody is left who could pay for these
            at, begun = until, None
            offers = scratch.write(open_.select("advertiser", "keyword", "bid"), f"offers-{step}")
            if offers.isEmpty():
                break
            continue
        one = F.lit(0).alias("one")
        out = scratch.write(ahead.select(one, "*").groupBy("one").cogroup(list_.select(one, "*").groupBy("one")).applyInPandas(play, schema), f"played-{step}")
        at, n_left = out.agg(F.max(F.when(F.col("kind") == "round", F.col("arrival"))), F.count_if(F.col("kind") == "left")).first()
        begun = out.filter("kind = 'left'").select("query_id", "keyword", "arrival") if n_left else None
        results.append(out.filter("kind = 'won'").select("query_id", "advertiser", "bid", "arrival"))
        paid = out.filter("kind = 'state'").select(F.col("arrival").alias("place"), F.col("bid").alias("now"), F.col("spent").alias("sum"))
        state = scratch.write(state.join(paid, "place", "left").select("advertiser", F.coalesce("now", "budget").alias("budget"), F.coalesce("sum", "spent").alias("spent"), "place"), f"state-{step}")
        scratch.drop(f"state-{step - 1}", f"list-{step}")
    state = scratch.write(state.drop("place"), "state")
    if not results:
        scratch.finish("state")
        return spark.createDataFrame([], "query_id long, advertiser long, bid double, arrival long"), state
    out = scratch.write(reduce(DataFrame.unionByName, results), "assignments")
    scratch.finish("assignments", "state")
    return out, state


def revenue(assignments: DataFrame) -> DataFrame:
    return assignments.agg(F.round(F.coalesce(F.sum("bid"), F.lit(0.0)), 2).alias("revenue"))
