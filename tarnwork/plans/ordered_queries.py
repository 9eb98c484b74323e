"""Registered queries of ordered operators, joins on inequalities, sets, cubes, sketches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.cubes import cube_sets, grouping_sets, rollup_sets
from tarnwork.operators.gaps import fill_gaps
from tarnwork.operators.multisets import except_all, intersect_all, symmetric_difference
from tarnwork.operators.ordered import asof_join, neighbours, ranks, running_totals, sessions, sliding
from tarnwork.operators.quantiles import quantiles
from tarnwork.operators.ranges import count_both, interval_join
from tarnwork.operators.sketches import (
    distinct_error,
    estimates,
    merge_sketches,
    rank_error,
    read_sketches,
    store_sketches,
)
from tarnwork.plans.registry import Tables, query
from tarnwork.sources.files import write_partitioned
from tarnwork.sources.versioned import read_version, upsert_partitions
from tarnwork.streaming.state import keep_latest
from tarnwork.streaming.windows import read_file_stream, run_available, windowed

_CENTS = "cast(round(value * 100) as bigint)"


def _cents(column: str = "value") -> Column:
    return F.round(F.col(column) * 100).cast("long")


def _events_of(t: Tables, kind: str, prefix: str) -> DataFrame:
    chosen = t.events.where(F.col("event_type") == kind)
    return chosen.select("user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))


# --- as-of joins --------------------------------------------------------------------


@query(
    """
    select p.user_id, p.event_id as purchase_id, p.ts as purchase_ts, v.event_id as view_id,
           v.ts as view_ts
    from (select * from events where event_type = 'purchase') p
    asof left join (select * from events where event_type = 'view') v
      on p.user_id = v.user_id and p.ts >= v.ts
    """
)
def asof_last_view(t: Tables) -> DataFrame:
    """Each purchase with the user's last view before it."""
    purchases, views = _events_of(t, "purchase", "purchase"), _events_of(t, "view", "view")
    return asof_join(purchases, views, "user_id", "purchase_ts", "view_ts")


@query(
    """
    select v.user_id, v.event_id as view_id, v.ts as view_ts, p.event_id as purchase_id,
           p.ts as purchase_ts
    from (select * from events where event_type = 'view') v
    asof join (select * from events where event_type = 'purchase') p
      on v.user_id = p.user_id and v.ts < p.ts
    where p.ts <= v.ts + interval 2 days
    """
)
def asof_next_purchase(t: Tables) -> DataFrame:
    """Each view that the user's next purchase follows within two days."""
    views, purchases = _events_of(t, "view", "view"), _events_of(t, "purchase", "purchase")
    return asof_join(
        views, purchases, "user_id", "view_ts", "purchase_ts", how="inner", direction="forward",
        allow_equal=False, tolerance=F.expr("interval 2 days"),
    )


# --- joins on inequalities ------------------------------------------------------------


def _deliveries(t: Tables, prefix: str) -> DataFrame:
    spans = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("sent"), F.max("l_shipdate").alias("received")
    )
    return t.orders.join(spans, "o_orderkey").select(
        "o_custkey", F.col("o_orderkey").alias(f"{prefix}_order"), F.col("sent").alias(f"{prefix}_sent"),
        F.col("received").alias(f"{prefix}_received"),
    )


@query(
    """
    with d as (
        select o_custkey, o_orderkey, min(l_shipdate) as sent, max(l_shipdate) as received
        from orders join lineitem on o_orderkey = l_orderkey group by 1, 2)
    select a.o_custkey, a.o_orderkey as a_order, a.sent as a_sent, a.received as a_received,
           b.o_orderkey as b_order, b.sent as b_sent, b.received as b_received
    from d a join d b on a.o_custkey = b.o_custkey and a.sent <= b.received and b.sent <= a.received
    where a.o_orderkey < b.o_orderkey
    """
)
def overlapping_deliveries(t: Tables) -> DataFrame:
    """Pairs of a customer's orders that were being sent out at the same time."""
    pairs = interval_join(
        _deliveries(t, "a"), _deliveries(t, "b"), ("a_sent", "a_received"), ("b_sent", "b_received"),
        on="o_custkey",
    )
    return pairs.where("a_order < b_order")


@query(
    """
    with a as (select o_orderkey, o_orderdate, cast(round(o_totalprice * 100) as bigint) as cents from orders)
    select x.o_orderkey, x.o_orderdate, x.cents, count(y.o_orderkey) as n_earlier_dearer
    from a x left join a y on y.o_orderdate < x.o_orderdate and y.cents > x.cents
    group by all
    """
)
def earlier_dearer_orders(t: Tables) -> DataFrame:
    """For each order, how many earlier ones cost more."""
    orders = t.orders.select("o_orderkey", "o_orderdate", _cents("o_totalprice").alias("cents"))
    return count_both(
        orders, orders, ("o_orderdate", "<", "o_orderdate"), ("cents", ">", "cents"), out="n_earlier_dearer"
    )


# --- frames, ranks, quantiles, sessions -------------------------------------------------


@query(
    f"""
    select event_id, event_type, sum({_CENTS}) over w as balance, count(*) over w as n_so_far
    from events window w as (partition by event_type order by ts, event_id rows unbounded preceding)
    """
)
def running_balance(t: Tables) -> DataFrame:
    """Running totals within a handful of hot keys."""
    events = t.events.select("event_id", "event_type", "ts", _cents().alias("cents"))
    totals = running_totals(
        events, "event_type", ["ts", "event_id"], {"balance": F.col("cents"), "n_so_far": F.lit(1)}
    )
    return totals.select("event_id", "event_type", "balance", F.col("n_so_far").cast("long").alias("n_so_far"))


@query(
    f"""
    select event_id, user_id, sum({_CENTS}) over w as around, max({_CENTS}) over w as highest,
           count(*) over w as n_around
    from events window w as (partition by event_type order by ts, event_id
                             rows between 6 preceding and 3 following)
    """
)
def moving_rows(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "user_id", "event_type", "ts", _cents().alias("cents"))
    new = {"around": F.sum("cents"), "highest": F.max("cents"), "n_around": F.count(F.lit(1))}
    framed = sliding(events, "event_type", ["ts", "event_id"], new, rows=(6, 3))
    return framed.select("event_id", "user_id", *new)


@query(
    """
    with o as (select o_orderkey, o_orderpriority, date_diff('day', date '1992-01-01', cast(o_orderdate as date)) as day,
                      cast(round(o_totalprice * 100) as bigint) as cents from orders)
    select o_orderkey, sum(cents) over w as last_days, count(*) over w as n_last_days,
           min(cents) over w as lowest
    from o window w as (partition by o_orderpriority order by day range between 6 preceding and current row)
    """
)
def moving_days(t: Tables) -> DataFrame:
    """Totals of the last seven days, by calendar and not by rows."""
    day = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
    orders = t.orders.select("o_orderkey", "o_orderpriority", day.alias("day"), _cents("o_totalprice").alias("cents"))
    new = {"last_days": F.sum("cents"), "n_last_days": F.count(F.lit(1)), "lowest": F.min("cents")}
    return sliding(orders, "o_orderpriority", "day", new, values=(6, 0)).select("o_orderkey", *new)


@query(
    """
    select event_id, lag(event_id) over w as previous_id, lag(ts) over w as previous_ts,
           lead(event_type, 2) over w as type_after_next
    from events window w as (partition by user_id order by ts, event_id)
    """
)
def neighbouring_events(t: Tables) -> DataFrame:
    new = {"previous_id": ("event_id", -1), "previous_ts": ("ts", -1), "type_after_next": ("event_type", 2)}
    events = t.events.select("event_id", "user_id", "event_type", "ts")
    return neighbours(events, "user_id", ["ts", "event_id"], new).select("event_id", *new)


@query(
    """
    select l_orderkey, l_linenumber, rank() over w as rank, dense_rank() over w as dense_rank,
           count(*) over (partition by l_returnflag) as n_rows
    from lineitem window w as (partition by l_returnflag order by l_quantity)
    """
)
def ranked_quantities(t: Tables) -> DataFrame:
    """Three keys for all lines, and fifty values for each key."""
    ranked = ranks(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"),
                   "l_returnflag", "l_quantity")
    return ranked.select("l_orderkey", "l_linenumber", "rank", F.col("dense_rank").cast("long").alias("dense_rank"), "n_rows")


@query(
    """
    select o_orderkey, row_number() over w as row_number, cast(ntile(7) over w as integer) as tile
    from orders window w as (partition by o_orderstatus order by o_totalprice, o_orderkey)
    """
)
def price_tiles(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return ranks(orders, "o_orderstatus", ["o_totalprice", "o_orderkey"], tiles=7).select(
        "o_orderkey", "row_number", "tile"
    )


@query(
    """
    select event_type, p as prob, quantile
    from (select event_type, unnest([0.0::double, 0.1, 0.5, 0.9, 0.99, 1.0]) as p,
                 unnest(quantile_disc(value, [0.0, 0.1, 0.5, 0.9, 0.99, 1.0])) as quantile
          from events where value is not null group by event_type)
    """
)
def value_quantiles(t: Tables) -> DataFrame:
    return quantiles(t.events, "event_type", "value", [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]).select(
        "event_type", "prob", "quantile"
    )


@query(
    """
    select unnest([0.25::double, 0.5, 0.75]) as prob,
           round(unnest(quantile_cont(o_totalprice, [0.25, 0.5, 0.75])), 6) as quantile
    from orders
    """
)
def price_quartiles(t: Tables) -> DataFrame:
    found = quantiles(t.orders, [], "o_totalprice", [0.25, 0.5, 0.75], kind="continuous")
    return found.select("prob", F.round("quantile", 6).alias("quantile"))


@query(
    f"""
    with marked as (
        select *, case when ts <= lag(ts) over w + interval 6 hours then 0 else 1 end as opens
        from events window w as (partition by user_id order by ts)),
    numbered as (
        select *, sum(opens) over (partition by user_id order by ts rows unbounded preceding) as s from marked)
    select user_id, min(ts) as start, max(ts) as end, count(*) as n_rows,
           cast(sum({_CENTS}) as bigint) as cents
    from numbered group by user_id, s
    """
)
def user_sessions(t: Tables) -> DataFrame:
    events = t.events.select("user_id", "ts", _cents().alias("cents"))
    return sessions(events, "user_id", "ts", F.expr("interval 6 hours"), {"cents": F.col("cents")})


@query(
    """
    with marked as (
        select *, case when ts <= lag(ts) over w + interval 2 minutes then 0 else 1 end as opens
        from events window w as (partition by event_type order by ts)),
    numbered as (
        select *, sum(opens) over (partition by event_type order by ts rows unbounded preceding) as s from marked)
    select event_type, min(ts) as start, max(ts) as end, count(*) as n_rows from numbered group by event_type, s
    """
)
def event_bursts(t: Tables) -> DataFrame:
    """Sessions of a handful of hot keys."""
    return sessions(t.events.select("event_type", "ts"), "event_type", "ts", F.expr("interval 2 minutes"))


# --- grouping sets, multisets -----------------------------------------------------------


_SALES = """
    with s as (select l_returnflag as flag, l_linestatus as status, year(l_shipdate) as year, l_suppkey,
                      cast(l_quantity as bigint) as quantity from lineitem)
    select flag, status, cast(year as integer) as year, cast(grouping_id(flag, status, year) as integer) as grouping,
           count(*) as n, cast(sum(quantity) as bigint) as quantity, max(quantity) as most,
           count(distinct l_suppkey) as n_suppliers
    from s group by {}
"""


def _sales(t: Tables, sets) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
        F.year("l_shipdate").alias("year"), F.col("l_quantity").cast("long").alias("quantity"), "l_suppkey",
    )
    measures = {"n": ("count", None), "quantity": ("sum", "quantity"), "most": ("max", "quantity")}
    return grouping_sets(rows, sets, measures, distinct=("n_suppliers", "l_suppkey"))


@query(_SALES.format("rollup (flag, status, year)"))
def sales_rollup(t: Tables) -> DataFrame:
    return _sales(t, rollup_sets(["flag", "status", "year"]))


@query(_SALES.format("cube (flag, status, year)"))
def sales_cube(t: Tables) -> DataFrame:
    return _sales(t, cube_sets(["flag", "status", "year"]))


@query(_SALES.format("grouping sets ((flag, status, year), (flag, year), (status), ())"))
def sales_grouping_sets(t: Tables) -> DataFrame:
    return _sales(t, [("flag", "status", "year"), ("flag", "year"), ("status",), ()])


_PARTS_SHIPPED = (
    "select l_suppkey, cast(l_quantity as bigint) as quantity from lineitem where l_returnflag {} 'R'"
)


def _parts_shipped(t: Tables, returned: bool) -> DataFrame:
    flag = F.col("l_returnflag")
    chosen = t.lineitem.where(flag == "R" if returned else flag != "R")
    return chosen.select("l_suppkey", F.col("l_quantity").cast("long").alias("quantity"))


@query(f"{_PARTS_SHIPPED.format('=')} intersect all {_PARTS_SHIPPED.format('<>')}", name="intersect_all")
def returned_and_kept(t: Tables) -> DataFrame:
    return intersect_all(_parts_shipped(t, True), _parts_shipped(t, False))


@query(f"{_PARTS_SHIPPED.format('<>')} except all {_PARTS_SHIPPED.format('=')}", name="except_all")
def kept_beyond_returned(t: Tables) -> DataFrame:
    return except_all(_parts_shipped(t, False), _parts_shipped(t, True))


@query(
    f"""
    with a as ({_PARTS_SHIPPED.format('<>')}), b as ({_PARTS_SHIPPED.format('=')})
    (select * from a except all select * from b) union all (select * from b except all select * from a)
    """,
    name="symmetric_difference",
)
def kept_or_returned(t: Tables) -> DataFrame:
    return symmetric_difference(_parts_shipped(t, False), _parts_shipped(t, True))


# --- tables that are changed ------------------------------------------------------------


@query(
    """
    with o as (select o_orderkey, strftime(o_orderdate, '%m') as month, o_orderstatus,
                      cast(round(o_totalprice * 100) as bigint) as cents from orders),
         s as (select o_orderkey, month, 'X' as o_orderstatus, cents + 1 as cents from o
               where month in ('02', '11') and o_orderstatus = 'F'
               union all select -o_orderkey, month, 'N', cents from o where month = '02' and o_orderstatus = 'O')
    select coalesce(s.o_orderkey, o.o_orderkey) as o_orderkey, coalesce(s.month, o.month) as month,
           coalesce(s.o_orderstatus, o.o_orderstatus) as o_orderstatus, coalesce(s.cents, o.cents) as cents
    from o full join s on o.o_orderkey = s.o_orderkey and o.month = s.month
    """
)
def upsert_touched_partitions(t: Tables) -> DataFrame:
    """Months as text with a leading zero: two of twelve partitions are rewritten."""
    orders = t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "MM").alias("month"), "o_orderstatus",
        _cents("o_totalprice").alias("cents"),
    )
    path = t.scratch("by-month")
    write_partitioned(orders, path, ["month"])
    changed = orders.where("month in ('02', '11') and o_orderstatus = 'F'").select(
        "o_orderkey", "month", F.lit("X").alias("o_orderstatus"), (F.col("cents") + 1).alias("cents")
    )
    added = orders.where("month = '02' and o_orderstatus = 'O'").select(
        (-F.col("o_orderkey")).alias("o_orderkey"), "month", F.lit("N").alias("o_orderstatus"), "cents"
    )
    upsert_partitions(t.spark, path, changed.unionByName(added), ["o_orderkey", "month"], ["month"])
    stored = t.spark.read.schema("o_orderkey long, o_orderstatus string, cents long, month string")
    return stored.parquet(path).select("o_orderkey", "month", "o_orderstatus", "cents")


# --- stored sketches --------------------------------------------------------------------


@query(
    """
    select year(l_shipdate) as year, l_returnflag, count(*) as n_rows,
           cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as cents,
           count(distinct l_orderkey) as n_orders, true as orders_close, true as prices_close
    from lineitem group by 1, 2
    """
)
def sketched_years(t: Tables) -> DataFrame:
    """Years from sketches stored by month, beside the exact figures.

    ``orders_close`` and ``prices_close`` tell whether the distinct count lies within four
    standard errors, and the ranks of the three quartiles within twice the rank error.
    """
    items = t.lineitem.select(
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), "l_returnflag", "l_orderkey", "l_extendedprice",
        _cents("l_extendedprice").alias("cents"),
    )
    path = t.scratch("sketches")
    store_sketches(
        items, path, "month", "l_returnflag", distinct={"orders": "l_orderkey"},
        quantile={"price": "l_extendedprice"}, sums={"cents": "cents"},
    )
    year = F.substring("month", 1, 4).cast("int").alias("year")
    stored = read_sketches(t.spark, path, "month string, l_returnflag string")
    probs = (0.25, 0.5, 0.75)
    found = estimates(merge_sketches(stored, [year, "l_returnflag"]), probs)
    found = found.withColumnsRenamed({"year": "y", "l_returnflag": "flag"})

    exact = items.groupBy(year, "l_returnflag").agg(F.countDistinct("l_orderkey").alias("n_orders"))
    at = items.select(year, "l_returnflag", F.col("l_extendedprice").cast("double").alias("price"))
    at = at.join(found.select("y", "flag", "quantile_price"), (F.col("year") == F.col("y")) & F.col("l_returnflag").eqNullSafe(F.col("flag")))
    share = lambda hit: F.avg(F.when(hit, 1.0).otherwise(0.0))
    allowed = 2 * rank_error()
    close = F.lit(True)
    for i, p in enumerate(probs):
        bound = F.col("quantile_price")[i]
        close = close & (share(F.col("price") < bound) <= p + allowed) & (share(F.col("price") <= bound) >= p - allowed)
    ranks = at.groupBy("year", "l_returnflag").agg(close.alias("prices_close"))
    same = lambda other: (F.col("y") == other["year"]) & F.col("flag").eqNullSafe(other["l_returnflag"])
    off = F.abs(F.col("distinct_orders") - F.col("n_orders"))
    return (
        found.join(exact, same(exact)).select(
            "y", "flag", "n_rows", F.col("sum_cents").alias("cents"), "n_orders",
            (off <= 4 * distinct_error() * F.col("n_orders")).alias("orders_close"),
        )
        .join(ranks, same(ranks))
        .select("year", "l_returnflag", "n_rows", "cents", "n_orders", "orders_close", "prices_close")
    )


# --- table functions --------------------------------------------------------------------


@query(
    f"""
    with d as (
        select user_id, time_bucket(interval 2 hours, ts, timestamp '1970-01-01') as slot, count(*) as n,
               cast(sum({_CENTS}) as bigint) as cents, max({_CENTS}) as top
        from events where ts is not null group by 1, 2),
    r as (
        select user_id, unnest(generate_series(min(slot), max(slot), interval 2 hours)) as slot
        from d group by 1),
    j as (
        select r.user_id, r.slot, d.n, d.cents, d.top, d.n is null as filled,
               last_value(d.top ignore nulls) over back as a, first_value(d.top ignore nulls) over ahead as b,
               last_value(case when d.n is not null then r.slot end ignore nulls) over back as a_at,
               first_value(case when d.n is not null then r.slot end ignore nulls) over ahead as b_at
        from r left join d on r.user_id is not distinct from d.user_id and r.slot = d.slot
        window back as (partition by r.user_id order by r.slot),
               ahead as (partition by r.user_id order by r.slot rows between current row and unbounded following))
    select user_id, slot as ts, coalesce(n, 0) as n, coalesce(cents, 0) as cents, a as last_top,
           case when filled then a + cast((b - a) * (epoch(slot) - epoch(a_at)) as double) / (epoch(b_at) - epoch(a_at))
                else cast(top as double) end as top, filled
    from j
    """
)
def filled_hours(t: Tables) -> DataFrame:
    """A row for every two hours between a user's first and last event."""
    events = t.events.select("user_id", "ts", _cents().alias("v"))
    return fill_gaps(
        events, "user_id", "ts", 7200,
        {
            "n": (F.count(F.lit(1)), "zero"), "cents": (F.sum("v"), "zero"),
            "last_top": (F.max("v"), "previous"), "top": (F.max("v"), "linear"),
        },
        chunk_slots=64,
    )


# --- streams ----------------------------------------------------------------------------


@query(
    f"""
    with w as (
        select event_type, time_bucket(interval 3 hours, ts, timestamp '1970-01-01') as window_start,
               count(*) as n, sum({_CENTS}) as cents
        from events where ts is not null group by 1, 2)
    select event_type, window_start, window_start + interval 3 hours as window_end, n,
           cast(cents as bigint) as cents
    from w where window_start + interval 3 hours <= (select max(ts) - interval 1 hour from events)
    """
)
def stream_windows(t: Tables) -> DataFrame:
    """Tumbling windows of a stream that the watermark has closed."""
    stream = read_file_stream(t.spark, t.path, t.events.schema, pattern="events.parquet")
    found = windowed(
        stream.withColumn("cents", _cents()), "ts", "3 hours", "1 hour",
        {"n": F.count(F.lit(1)), "cents": F.sum("cents")}, keys="event_type",
    )
    path = t.scratch("stream-windows")
    run_available(found, path, t.scratch("stream-windows-checkpoint"))
    return t.spark.read.schema(found.schema).parquet(path)


@query(
    """
    select event_id, ts, user_id, event_type, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
    """
)
def stream_latest_events(t: Tables) -> DataFrame:
    """The newest event of each user and type, kept up to date by four micro-batches."""
    events = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    files = t.scratch("event-files")
    events.repartitionByRange(4, "event_id").write.parquet(files)
    stream = read_file_stream(t.spark, files, events.schema, files_per_batch=1)
    path = t.scratch("latest-events")
    keep_latest(stream, path, t.scratch("latest-events-checkpoint"), ["user_id", "event_type"], ["ts", "event_id"])
    return read_version(t.spark, path)
