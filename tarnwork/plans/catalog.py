"""Registered queries over the driver tables, each with the SQL it must equal.

A query is a function of the tables; its oracle is independent SQL over the same
parquet files. Every query works on whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.checks import (
    AggregateBetween,
    Between,
    Equals,
    GreaterThan,
    NotNull,
    StablePopulation,
    failing_rows,
    run_checks,
)
from tarnwork.operators.drift import bucketize, psi, psi_components, with_share
from tarnwork.operators.external import call_external
from tarnwork.operators.hierarchy import ancestors, ancestors_by_role
from tarnwork.operators.joins import hot_keys, salted_join
from tarnwork.operators.keyed import dedup_latest, merge_snapshot, upsert
from tarnwork.operators.shape import (
    aggregate_to_map,
    collect_joined,
    explode_map,
    parse_form,
    parse_json_column,
    pivot_by_rules,
    unpivot_measures,
    with_date_parts,
    zip_columns,
)
from tarnwork.operators.windows import dominant_key, group_stats, max_rows, tied_keys
from tarnwork.plans import ordered_queries  # noqa: F401  registers its queries
from tarnwork.plans.order_pipeline import (
    build_order_details,
    extract_all,
    extract_day,
    extract_table,
)
from tarnwork.plans.registry import ORACLES, QUERIES, Query, Tables, query
from tarnwork.scratch import materialize
from tarnwork.sources.files import (
    list_periods,
    read_csv,
    read_json,
    read_partitions,
    read_table,
    write_csv,
)
from tarnwork.sources.versioned import create_versioned, read_version, upsert_versioned

# --- pipeline ---------------------------------------------------------------


@query(
    """
    select o_orderkey, o_custkey, o_orderdate,
           cast(strftime(o_orderdate, '%Y') as integer) as year,
           cast(strftime(o_orderdate, '%Y%m') as integer) as month,
           cast(strftime(o_orderdate, '%Y%m%d') as integer) as day,
           l_linenumber, l_extendedprice, l_quantity, l_discount
    from orders join lineitem on o_orderkey = l_orderkey
    """
)
def order_details(t: Tables) -> DataFrame:
    return build_order_details(
        with_date_parts(t.orders, "o_orderdate"),
        t.lineitem,
        order_key="o_orderkey",
        order_columns=["o_orderkey", "o_custkey", "o_orderdate", "year", "month", "day"],
        detail_key="l_orderkey",
        detail_columns=["l_linenumber", "l_extendedprice", "l_quantity", "l_discount"],
    )


@query(
    """
    select cast(strftime(o_orderdate, '%Y%m%d') as integer) as day,
           count(*) as n_details,
           cast(sum(cast(l_extendedprice as decimal(12, 2))
                    * (1 - cast(l_discount as decimal(4, 2)))) as double) as revenue
    from orders join lineitem on o_orderkey = l_orderkey
    group by 1
    """
)
def daily_revenue(t: Tables) -> DataFrame:
    # Whole cents times whole hundredths: exact in a long, and cheaper than decimals.
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    revenue = cents * (100 - F.round(F.col("l_discount") * 100).cast("long"))
    # Details are summed per order before they meet the order's date, so the join
    # reads one row per order and reuses the partitioning of the sums.
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(revenue).alias("revenue")
    )
    orders = with_date_parts(t.orders, "o_orderdate").select("o_orderkey", "day")
    return (
        orders.join(per_order, "o_orderkey")
        .groupBy("day")
        .agg(
            F.sum("n").alias("n_details"),
            (F.sum("revenue") / 10_000).alias("revenue"),
        )
    )


@query(
    """
    select o_orderkey,
           cast(strftime(o_orderdate, '%Y') as integer) as year,
           cast(strftime(o_orderdate, '%Y%m') as integer) as month,
           cast(strftime(o_orderdate, '%Y%m%d') as integer) as day
    from orders
    """
)
def date_parts(t: Tables) -> DataFrame:
    return with_date_parts(t.orders, "o_orderdate").select("o_orderkey", "year", "month", "day")


@query(
    "select distinct strftime(o_orderdate, '%Y%m') as period from orders order by 1",
    name="list_periods",
)
def periods(t: Tables) -> DataFrame:
    return list_periods(t.orders, "o_orderdate")


@query(
    """
    select o_orderkey, o_custkey, o_totalprice, 1997 as year, 199705 as month, 19970514 as day
    from orders where cast(o_orderdate as date) = date '1997-05-14'
    """,
    name="extract_day_roundtrip",
)
def extract_one_day(t: Tables) -> DataFrame:
    out = t.scratch("orders-day")
    extract_day(t.orders, "o_orderdate", "19970514", out)
    return read_partitions(t.spark, out, day="19970514").select(
        "o_orderkey", "o_custkey", "o_totalprice", "year", "month", "day"
    )


@query(
    """
    select cast(strftime(ts, '%Y%m%d') as integer) as day,
           count(*) as n_events, round(sum(value), 2) as total
    from events group by 1
    """
)
def extract_all_days(t: Tables) -> DataFrame:
    out = t.scratch("events-all")
    extract_all(t.events, "ts", out)
    return (
        read_partitions(t.spark, out)
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("total"))
    )


@query("select * from customer", name="extract_table")
def extract_customers(t: Tables) -> DataFrame:
    out = t.scratch("customer")
    extract_table(t.customer, out)
    return t.spark.read.parquet(out)


# --- files ------------------------------------------------------------------


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def csv_roundtrip(t: Tables) -> DataFrame:
    out = t.scratch("orders-csv")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    write_csv(t.orders.select(*columns), out)
    return read_csv(t.spark, out).select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").try_cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").try_cast("double").alias("o_totalprice"),
    )


@query("select event_id, user_id, event_type, value, props from events")
def json_file_roundtrip(t: Tables) -> DataFrame:
    out = t.scratch("events-json")
    columns = ["event_id", "user_id", "event_type", "value", "props"]
    source = t.events.select(*columns)
    source.write.json(out)
    return read_json(t.spark, out, schema=source.schema, multiline=False)


@query("select event_id, event_type, value from events")
def json_documents_roundtrip(t: Tables) -> DataFrame:
    """Multi-line documents, one array of some events per file; the schema is inferred."""
    out = t.scratch("events-documents")
    rows = F.collect_list(F.struct("event_id", "event_type", "value"))
    text = F.to_json(rows, {"pretty": "true", "ignoreNullFields": "false"})
    number = F.floor(F.col("event_id") / 5000).alias("document")
    documents = t.events.groupBy(number).agg(text.alias("body"))
    documents.write.partitionBy("document").text(out)
    return read_json(t.spark, f"{out}/*").select("event_id", "event_type", "value")


@query(
    """
    select o_orderkey, o_totalprice from orders
    where o_orderdate >= timestamp '1997-01-01 00:00:00' and o_orderstatus = 'F'
    """
)
def read_table_filtered(t: Tables) -> DataFrame:
    return read_table(
        t.spark,
        "parquet",
        f"{t.path}/orders.parquet",
        columns=["o_orderkey", "o_totalprice"],
        predicate="o_orderdate >= timestamp_ntz'1997-01-01 00:00:00' and o_orderstatus = 'F'",
    )


# --- projections and filters -------------------------------------------------


@query(
    """
    select o_orderkey as order_key,
           o_custkey as customer_key,
           o_totalprice / 100 as price_hundreds,
           coalesce(case when o_orderstatus = 'P' then null else o_orderstatus end, 'open')
             as status,
           case when o_totalprice < 100000 then 'small'
                when o_totalprice < 300000 then 'medium'
                else 'large' end as size,
           'orders' as origin,
           cast(null as varchar) as note,
           concat(o_orderpriority, '/', o_orderstatus) as tag,
           concat_ws(';', o_orderpriority, nullif(o_orderstatus, 'P')) as tag_without_null,
           floor(ln(o_totalprice)) as magnitude
    from orders
    """
)
def column_edits(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    known_status = F.nullif("o_orderstatus", F.lit("P"))
    return (
        t.orders.withColumns(
            {
                "price_hundreds": price / 100,
                "status": known_status,
                "size": F.when(price < 100000, "small")
                .when(price < 300000, "medium")
                .otherwise("large"),
                "origin": F.lit("orders"),
                "note": F.lit(None).cast("string"),
                "tag": F.concat("o_orderpriority", F.lit("/"), "o_orderstatus"),
                "tag_without_null": F.concat_ws(";", "o_orderpriority", known_status),
                "magnitude": F.floor(F.ln(price)).cast("double"),
            }
        )
        .fillna({"status": "open"})
        .withColumnsRenamed({"o_orderkey": "order_key", "o_custkey": "customer_key"})
        .drop("o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    )


@query(
    """
    select o_orderkey, o_orderstatus, o_orderpriority, o_totalprice from orders
    where (o_totalprice > 50000 and o_orderstatus is not null)
      and (o_orderstatus = 'F' or o_orderpriority = '1-URGENT')
      and o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')
      and o_custkey <> o_orderkey
    order by o_totalprice desc, o_orderkey
    """
)
def row_filters(t: Tables) -> DataFrame:
    return (
        t.orders.where("o_totalprice > 50000 and o_orderstatus is not null")
        .filter((F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "1-URGENT"))
        .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW"))
        .where(F.col("o_custkey") != F.col("o_orderkey"))
        .select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
        .orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    )


# --- keyed state --------------------------------------------------------------


@query(
    """
    select event_id, ts, user_id, event_type, value from events
    qualify row_number() over (
        partition by user_id, event_type order by ts desc, event_id desc) = 1
    """
)
def dedup_latest_one(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return dedup_latest(events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    """
    select o.* from orders o
    join (select o_custkey as k, max(o_orderdate) as newest from orders group by 1) m
      on o.o_custkey = m.k and o.o_orderdate = m.newest
    """
)
def dedup_latest_all(t: Tables) -> DataFrame:
    return dedup_latest(t.orders, "o_custkey", "o_orderdate", ties="all")


def _ledger(t: Tables, line_status: str) -> DataFrame:
    """Parts per ship month, for lines of one status; not every month has returns."""
    month = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))
    return (
        t.lineitem.where(F.col("l_linestatus") == line_status)
        .groupBy(F.col("l_partkey").alias("part"), month.alias("month"))
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.max(returned).alias("last_return"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )


_LEDGERS = """
    with ledger as (
        select l_linestatus as side, l_partkey as part,
               cast(year(l_shipdate) * 100 + month(l_shipdate) as integer) as month,
               sum(l_quantity) as quantity,
               max(case when l_returnflag = 'R' then l_shipdate end) as last_return,
               count(*) as n_lines
        from lineitem group by 1, 2, 3),
    h as (select * from ledger where side = 'F'),
    u as (select * from ledger where side = 'O')
"""


@query(
    _LEDGERS
    + """
    select coalesce(u.part, h.part) as part, coalesce(u.month, h.month) as month,
           coalesce(u.quantity, h.quantity) as quantity,
           coalesce(u.last_return, h.last_return) as last_return,
           coalesce(u.n_lines, h.n_lines) as n_lines
    from h full join u on h.part = u.part and h.month = u.month
    """
)
def snapshot_merge(t: Tables) -> DataFrame:
    history = materialize(_ledger(t, "F"), "ledger")
    return merge_snapshot(history, _ledger(t, "O"), ["part", "month"])


@query(
    _LEDGERS
    + """
    select coalesce(u.part, h.part) as part, coalesce(u.month, h.month) as month,
           case when u.part is not null then u.quantity else h.quantity end as quantity,
           case when u.part is not null then u.last_return else h.last_return end
             as last_return,
           case when h.part is not null then h.n_lines end as n_lines
    from h full join u on h.part = u.part and h.month = u.month
    """,
    name="upsert",
)
def upsert_ledger(t: Tables) -> DataFrame:
    return upsert(
        materialize(_ledger(t, "F"), "ledger"),
        _ledger(t, "O"),
        ["part", "month"],
        update_cols=["quantity", "last_return"],
        insert_cols=["part", "month", "quantity", "last_return"],
    )


def _versioned_ledger(t: Tables) -> str:
    path = t.scratch("ledger")
    create_versioned(_ledger(t, "F"), path)
    upsert_versioned(t.spark, path, _ledger(t, "O"), ["part", "month"])
    return path


@query(_LEDGERS + "select part, month, quantity, last_return, n_lines from h")
def upsert_time_travel(t: Tables) -> DataFrame:
    return read_version(t.spark, _versioned_ledger(t), 0)


@query(
    _LEDGERS
    + """
    select part, month, quantity, last_return, n_lines from u
    union all
    select part, month, quantity, last_return, n_lines from h
    where (part, month) not in (select part, month from u)
    """
)
def upsert_latest_version(t: Tables) -> DataFrame:
    return read_version(t.spark, _versioned_ledger(t))


# --- joins ---------------------------------------------------------------------


_PART_SALES = """
    select p_brand as brand, count(*) as n_lines, round(sum(l_quantity), 2) as quantity,
           round(sum(l_extendedprice), 2) as price
    from lineitem left join part on l_partkey = p_partkey
    group by 1
"""


def _part_sales(joined: DataFrame) -> DataFrame:
    return joined.groupBy(F.col("p_brand").alias("brand")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
    )


def _lines_and_parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    lines = t.lineitem.select(
        F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_quantity", "l_extendedprice"
    )
    return lines, t.part.select("p_partkey", "p_brand")


@query(_PART_SALES, name="salted_join")
def salted_join_all_keys(t: Tables) -> DataFrame:
    lines, parts = _lines_and_parts(t)
    return _part_sales(
        salted_join(lines, parts, "p_partkey", n_salts=16, hint="merge")
    )


@query(_PART_SALES)
def salted_join_hot_keys(t: Tables) -> DataFrame:
    lines, parts = _lines_and_parts(t)
    hot = hot_keys(lines, "p_partkey")
    return _part_sales(salted_join(lines, parts, "p_partkey", hot=hot))


@query(
    """
    select c_custkey, c_name, count(o_orderkey) as n_orders, max(o_orderdate) as last_order
    from customer left join orders on c_custkey = o_custkey
    group by 1, 2
    """
)
def customer_orders(t: Tables) -> DataFrame:
    per_customer = (
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("o_orderkey").alias("n_orders"), F.max("o_orderdate").alias("last_order"))
    )
    return (
        t.customer.select("c_custkey", "c_name")
        .join(per_customer, "c_custkey", "left")
        .fillna({"n_orders": 0})
    )


# --- aggregates, windows ----------------------------------------------------------


@query(
    """
    select sum(l_quantity) as total, min(l_quantity) as lowest, max(l_quantity) as highest,
           round(avg(l_quantity), 8) as average, count(*) as n
    from lineitem
    """
)
def global_summary(t: Tables) -> DataFrame:
    quantity = F.col("l_quantity")
    return t.lineitem.agg(
        F.sum(quantity).alias("total"),
        F.min(quantity).alias("lowest"),
        F.max(quantity).alias("highest"),
        F.round(F.avg(quantity), 8).alias("average"),
        F.count(F.lit(1)).alias("n"),
    )


def _event_counts(t: Tables) -> DataFrame:
    """Events per user and type. A large value makes its type the user's incumbent."""
    incumbent = F.when(F.col("value") > 150, F.col("event_type"))
    return t.events.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max(incumbent).alias("incumbent")
    )


#: Aggregates joined back, so that the windows are checked by other means.
_EVENT_COUNTS = """
    with counts as (
        select user_id, event_type, count(*) as n,
               max(case when value > 150 then event_type end) as incumbent
        from events group by user_id, event_type),
    users as (
        select user_id as u, max(n) as top, max(incumbent) as favourite from counts group by user_id),
    tops as (
        select u, count(*) as sharing from users join counts on u = user_id and n = top group by u),
    places as (
        select a.user_id as u, a.event_type as kind, count(*) as place
        from counts a join counts b on a.user_id = b.user_id
             and (b.n, b.event_type) <= (a.n, a.event_type)
        group by a.user_id, a.event_type),
    stats as (
        select user_id, event_type, n, incumbent, top as max_value, favourite as group_incumbent,
               place as row_number, case when n = top then sharing else 0 end as equal_count
        from counts join users on users.u = user_id join tops on tops.u = user_id
             join places on places.u = user_id and kind = event_type)
"""


@query(
    _EVENT_COUNTS
    + """
    select user_id,
           case when max(equal_count) = 1 or max(group_incumbent) is null
                then min(event_type) else max(group_incumbent) end as event_type,
           case when max(equal_count) = 1 then 'unique'
                when max(group_incumbent) is not null then 'incumbent'
                else 'tie_break' end as reason
    from stats where n = max_value group by 1
    """
)
def dominant_event(t: Tables) -> DataFrame:
    return dominant_key(_event_counts(t), "user_id", "event_type", "n", "incumbent")


@query(
    _EVENT_COUNTS
    + """
    select user_id, event_type, n, incumbent, max_value, group_incumbent, row_number,
           equal_count
    from stats
    """
)
def window_totals(t: Tables) -> DataFrame:
    return group_stats(_event_counts(t), "user_id", "event_type", "n", "incumbent")


@query(_EVENT_COUNTS + "select user_id, event_type, n from stats where n = max_value", name="max_rows")
def dominant_rows(t: Tables) -> DataFrame:
    return max_rows(_event_counts(t).drop("incumbent"), "user_id", "n")


@query(
    """
    select * from events
    qualify value = max(value) over (partition by user_id)
    """
)
def largest_events(t: Tables) -> DataFrame:
    return max_rows(t.events, "user_id", "value")


@query(
    _EVENT_COUNTS
    + "select user_id, event_type from stats where n = max_value and equal_count >= 3",
    name="tied_keys",
)
def tied_events(t: Tables) -> DataFrame:
    return tied_keys(_event_counts(t), "user_id", "event_type", "n", min_ties=3)


@query(
    """
    select user_id, event_type as key, n as value, max(last_ts) over (partition by user_id)
             as last_date
    from (select user_id, event_type, count(*) as n, max(ts) as last_ts
          from events group by 1, 2)
    """
)
def user_event_map(t: Tables) -> DataFrame:
    ones = t.events.select("user_id", "event_type", "ts", F.lit(1).alias("one"))
    maps = aggregate_to_map(ones, "user_id", "event_type", "one", last="ts")
    return explode_map(maps, "totals")


@query(
    """
    select user_id, string_agg(distinct event_type, ';' order by event_type) as event_type
    from events group by 1
    """,
    name="collect_joined",
)
def event_types_joined(t: Tables) -> DataFrame:
    return collect_joined(t.events, "user_id", ["event_type"])


# --- drift ------------------------------------------------------------------------

_SPLITS = [0.0, 5.0, 10.0, 20.0, 50.0, 100.0, float("inf")]


def _two_periods(t: Tables) -> DataFrame:
    first_half = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return t.events.select(
        "value", F.when(first_half, "reference").otherwise("current").alias("period")
    )


_BINS = """
    case when value >= 100 then 5 when value >= 50 then 4 when value >= 20 then 3
         when value >= 10 then 2 when value >= 5 then 1 when value >= 0 then 0 end
"""

_PSI = f"""
    with counts as (
        select {_BINS} as bin,
               count(*) filter (where ts < timestamp '2024-01-16') as b,
               count(*) filter (where ts >= timestamp '2024-01-16') as c
        from events group by 1),
    shares as (
        select bin, b / sum(b) over () as baseline_share, c / sum(c) over () as current_share
        from counts where bin is not null),
    components as (
        select bin, baseline_share, current_share,
               case when baseline_share = 0 or current_share = 0 then 0
                    else (current_share - baseline_share)
                         * ln(current_share / baseline_share) end as psi_component
        from shares)
"""


@query(_PSI + "select round(sum(psi_component), 8) as psi from components")
def psi_total(t: Tables) -> DataFrame:
    result = psi(_two_periods(t), "value", "period", _SPLITS, "reference", "current")
    return result.select(F.round("psi", 8).alias("psi"))


@query(
    _PSI
    + """
    select bin, round(baseline_share, 10) as baseline_share,
           round(current_share, 10) as current_share,
           round(psi_component, 10) as psi_component
    from components
    """,
    name="psi_components",
)
def psi_by_bin(t: Tables) -> DataFrame:
    parts = psi_components(_two_periods(t), "value", "period", _SPLITS, "reference", "current")
    shares = ["baseline_share", "current_share", "psi_component"]
    return parts.select("bin", *[F.round(c, 10).alias(c) for c in shares])


@query(
    f"""
    select {_BINS} as bin, count(*) as n, round(sum(value), 2) as total
    from events group by 1
    """
)
def bucket_counts(t: Tables) -> DataFrame:
    binned = bucketize(t.events, "value", _SPLITS)
    return binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    """
    select month, o_orderpriority, n, n / sum(n) over (partition by month) as share
    from (select cast(strftime(o_orderdate, '%Y%m') as integer) as month, o_orderpriority,
                 count(*) as n
          from orders group by 1, 2)
    """,
    name="group_shares",
)
def priority_shares(t: Tables) -> DataFrame:
    counts = (
        with_date_parts(t.orders, "o_orderdate")
        .groupBy("month", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_share(materialize(counts, "priority-counts"), "n", "month")


# --- hierarchy ----------------------------------------------------------------------


def _customer_tree(t: Tables) -> DataFrame:
    """Customers as a tree: every customer reports to the one with a quarter of its key."""
    return t.customer.select(
        F.col("c_custkey").alias("child"), F.expr("c_custkey div 4").alias("parent")
    )


_PAIRS = """
    with recursive pairs(node, ancestor, depth) as (
        select c_custkey, c_custkey // 4, 1 from customer where c_custkey <> c_custkey // 4
        union all
        select p.node, c.c_custkey // 4, p.depth + 1
        from pairs p join customer c on c.c_custkey = p.ancestor
        where c.c_custkey <> c.c_custkey // 4)
"""


@query(_PAIRS + "select node, ancestor, depth from pairs", name="ancestors")
def customer_ancestors(t: Tables) -> DataFrame:
    return ancestors(_customer_tree(t), "child", "parent")


@query(
    _PAIRS
    + """
    , roles as (
        select c_custkey,
               case c_custkey % 3 when 0 then 'director' when 1 then 'manager'
                                  else 'lead' end as role
        from customer)
    select r.c_custkey,
           coalesce(string_agg(cast(ancestor as varchar), ';' order by depth)
                    filter (where a.role = 'lead'), '') as lead,
           coalesce(string_agg(cast(ancestor as varchar), ';' order by depth)
                    filter (where a.role = 'manager'), '') as manager,
           coalesce(string_agg(cast(ancestor as varchar), ';' order by depth)
                    filter (where a.role = 'director'), '') as director
    from roles r left join pairs p on p.node = r.c_custkey
    left join roles a on a.c_custkey = p.ancestor
    group by 1
    """,
    name="ancestors_by_role",
)
def customer_ancestors_by_role(t: Tables) -> DataFrame:
    third = F.col("c_custkey") % 3
    role = F.when(third == 0, "director").when(third == 1, "manager").otherwise("lead")
    roles = t.customer.select("c_custkey", role.alias("role"))
    pairs = ancestors(_customer_tree(t), "child", "parent")
    return ancestors_by_role(pairs, roles, "c_custkey", "role", ["lead", "manager", "director"])


# --- reshape --------------------------------------------------------------------------


@query(
    """
    select l_orderkey, l_linenumber, 'l_discount' as measure, l_discount as rate from lineitem
    union all
    select l_orderkey, l_linenumber, 'l_tax', l_tax from lineitem
    """
)
def unpivot_charges(t: Tables) -> DataFrame:
    return unpivot_measures(
        t.lineitem, ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"], value="rate"
    )


def _spread(value: Column) -> Column:
    return F.max(value) - F.min(value)


def _event_statistics(t: Tables) -> DataFrame:
    """Statistics of event values in the second half of the month against the first."""
    value, late = F.col("value"), F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    size = F.when(value < 10, "low").when(value < 50, "mid").otherwise("high")
    statistics = {"mean": F.avg, "rows": F.count, "top": F.max, "spread": _spread}
    wide = t.events.groupBy(
        size.alias("band"), F.col("event_type").alias("kind")
    ).agg(
        *[
            agg(F.when(half, value)).cast("double").alias(f"{name}_{side}")
            for name, agg in statistics.items()
            for side, half in (("now", late), ("then", ~late))
        ]
    )
    cells = ", ".join(
        f"struct('{name}' as statistic, {name}_now as late, {name}_then as early, "
        f"{name}_now - {name}_then as step)"
        for name in statistics
    )
    return wide.selectExpr("band", "kind", f"inline(array({cells}))")


@query(
    """
    with s as (
        select case when value < 10 then 'low' when value < 50 then 'mid' else 'high' end
                 as band,
               event_type as kind,
               avg(value) filter (where ts >= timestamp '2024-01-16') as avg_now,
               avg(value) filter (where ts < timestamp '2024-01-16') as avg_then,
               min(value) filter (where ts >= timestamp '2024-01-16') as min_now,
               min(value) filter (where ts < timestamp '2024-01-16') as min_then,
               max(value) filter (where ts >= timestamp '2024-01-16') as max_now,
               max(value) filter (where ts < timestamp '2024-01-16') as max_then,
               cast(count(*) filter (where ts >= timestamp '2024-01-16') as double) as n_now,
               cast(count(*) filter (where ts < timestamp '2024-01-16') as double) as n_then
        from events group by 1, 2)
    select band, kind, round(avg_now - avg_then, 6) as mean_step, n_then as early_rows,
           round(max_then - min_then, 6) as early_spread, round(max_now, 6) as late_top,
           round(coalesce(avg_now, n_now, max_now - min_now, avg_then, max_then,
                          (max_now - min_now) - (max_then - min_then)), 6) as "except"
    from s
    """,
    name="pivot_stats",
)
def pivot_statistics(t: Tables) -> DataFrame:
    rules = {
        ("mean", "step"): "mean_step",
        ("rows", "early"): "early_rows",
        ("spread", "early"): "early_spread",
        ("top", "late"): "late_top",
    }
    ids = ["band", "kind"]
    pivoted = pivot_by_rules(
        _event_statistics(t), ids, "statistic", ["late", "early", "step"], rules
    )
    return pivoted.select(
        *ids, *[F.round(c, 6).alias(c) for c in pivoted.columns if c not in ids]
    )


@query(
    """
    select cast(strftime(o_orderdate, '%Y') as integer) as year,
           count(*) filter (where o_orderstatus = 'F') as "F",
           count(*) filter (where o_orderstatus = 'O') as "O",
           count(*) filter (where o_orderstatus = 'P') as "P"
    from orders group by 1
    """
)
def pivot_fixed_values(t: Tables) -> DataFrame:
    orders = with_date_parts(t.orders, "o_orderdate")
    return orders.groupBy("year").pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)


@query(
    """
    select user_id,
           max(value) filter (where event_type = 'click') as click,
           max(value) filter (where event_type = 'error') as error,
           max(value) filter (where event_type = 'purchase') as purchase,
           max(value) filter (where event_type = 'signup') as signup,
           max(value) filter (where event_type = 'view') as view
    from events group by 1
    """
)
def pivot_discovered_values(t: Tables) -> DataFrame:
    # Spark first runs a distinct over event_type to learn the columns.
    return t.events.groupBy("user_id").pivot("event_type").agg(F.max("value"))


@query(
    """
    select l_orderkey, l_linenumber, l_quantity as amount, l_discount as rate from lineitem
    union all
    select l_orderkey, l_linenumber, l_extendedprice, l_tax from lineitem
    """
)
def zip_nested(t: Tables) -> DataFrame:
    zipped = zip_columns(
        t.lineitem,
        {"amount": ["l_quantity", "l_extendedprice"], "rate": ["l_discount", "l_tax"]},
        "cells",
    )
    return zipped.selectExpr("l_orderkey", "l_linenumber", "inline(cells)")


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_props(t: Tables) -> DataFrame:
    return parse_json_column(t.events, "props").select("event_id", "props.k")


@query(
    """
    select event_id, event_type as action, 'u' || user_id as actor, 'a+b' as note
    from events
    """
)
def form_body(t: Tables) -> DataFrame:
    forms = parse_form(t.events.select("event_id", _event_form().alias("form")), "form")
    return forms.select(
        "event_id", *[F.col("form")[name].alias(name) for name in ("action", "actor", "note")]
    )


def _event_form() -> Column:
    return F.format_string("action=%s&actor=u%d&note=a+b", "event_type", "user_id")


# --- checks -----------------------------------------------------------------------------


def _stability(max_psi: float | None) -> StablePopulation:
    return StablePopulation(
        column="value",
        period="period",
        splits=_SPLITS,
        baseline="reference",
        current="current",
        max_psi=max_psi,
    )


@query(
    """
    with e as (
        select *, nullif(event_type, 'error') as good_type from events)
    select 'known type' as "check", 'good_type' as "column", 'warning' as severity,
           count(*) as evaluated, count(*) - count(good_type) as unexpected,
           count(good_type) / count(*) as success_ratio, cast(null as double) as observed,
           count(good_type) / count(*) >= 0.7 as success
    from e
    union all
    select 'greater_than(value)', 'value', 'critical', count(value),
           count(*) filter (where value <= 2.5),
           (count(value) - count(*) filter (where value <= 2.5)) / count(value), null,
           (count(value) - count(*) filter (where value <= 2.5)) / count(value) >= 0.9
    from e
    union all
    select 'between(value)', 'value', 'critical', count(value),
           count(*) filter (where value > 300),
           (count(value) - count(*) filter (where value > 300)) / count(value), null,
           (count(value) - count(*) filter (where value > 300)) / count(value) >= 1
    from e
    union all
    select 'aggregate_between(value)', 'value', 'critical', count(value), null, null,
           round(avg(value), 6), avg(value) >= 20 and avg(value) < 60
    from e
    union all
    select 'equals(good_type)', 'good_type', 'critical', count(*),
           count(*) filter (where good_type is distinct from 'click'),
           count(*) filter (where good_type = 'click') / count(*), null,
           count(*) filter (where good_type = 'click') / count(*) >= 0.1
    from e
    """
)
def checks_events(t: Tables) -> DataFrame:
    events = t.events.withColumn("good_type", F.nullif("event_type", F.lit("error")))
    results = run_checks(
        events,
        [
            NotNull(column="good_type", mostly=0.7, severity="warning", name="known type"),
            GreaterThan(column="value", bound=2.5, mostly=0.9),
            Between(column="value", max_value=300),
            AggregateBetween(column="value", min_value=20, max_value=60, strict_max=True),
            Equals(column="good_type", constant="click", mostly=0.1),
        ],
    )
    return results.withColumn("observed", F.round("observed", 6))


@query(
    _PSI
    + """
    select 'stable_population(value)' as "check", (select count(value) from events) as evaluated,
           round(sum(psi_component), 8) as observed, sum(psi_component) <= 0.1 as success
    from components
    """,
    name="check_psi",
)
def check_stability(t: Tables) -> DataFrame:
    return run_checks(_two_periods(t), [_stability(0.1)]).select(
        "check", "evaluated", F.round("observed", 8).alias("observed"), "success"
    )


@query("select * from events where value <= 12.5", name="failing_rows")
def failing_events(t: Tables) -> DataFrame:
    return failing_rows(t.events, GreaterThan(column="value", bound=12.5))


# --- external calls -----------------------------------------------------------------------


@query(
    """
    select event_id,
           case event_id % 10 when 0 then null when 1 then 500 else 201 end as status,
           case event_id % 10 when 0 then 'timeout' when 1 then 'error' else 'success' end
             as outcome,
           event_type as action, 'u' || user_id as actor
    from events
    """,
    name="call_external",
)
def external_calls(t: Tables) -> DataFrame:
    def answer(payload, timeout_s):
        last_digit = payload["event_id"] % 10
        if last_digit == 0:
            raise TimeoutError
        return 500 if last_digit == 1 else 201

    events = t.events.select("event_id", _event_form().alias("form"))
    called = parse_form(call_external(events, answer, ["event_id", "form"]), "form")
    return called.select(
        "event_id", "status", "outcome", *[F.col("form")[n].alias(n) for n in ("action", "actor")]
    )


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
