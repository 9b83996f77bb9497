"""The registered queries over the given tables, each with the DuckDB SQL that
states the same result.

Every query reads whole tables (or rows Spark derives from them); the filters
that appear are the *query* of the roll-up (which child rows are hits), as in
the reference's term query, not a way to shrink the input.

Sums of doubles are computed as DECIMAL(18,2) and cast back to DOUBLE on both
sides, so the two engines agree to the last bit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinroll.functions import declared, filter_buckets, range_filters, term_buckets
from kinroll.operators import (
    bucket_levels,
    bucket_tree,
    chain_levels,
    chain_rollup,
    family_filter,
    family_having,
    family_values,
    filter_rows,
    finish_states,
    lift_to_parents,
    merge_bitmaps,
    merge_rollups,
    merge_states,
    only_live,
    parent_bitmaps,
    parent_rollup,
    partial_rollup,
    running,
)
from kinroll.plans import Relation, spread
from kinroll.session import ensure_checkpoint_dir
from kinroll.sources import family_route, family_shards, join_field_rows, mixed_table, read_table, write_co_located


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def _dsum(c: str) -> tuple[str, str]:
    """Exact sum of a double price: per parent key, then per bucket."""
    return ("sum", f"CAST({c} AS DECIMAL(18,2))")


def _dsum_sql(c: str) -> str:
    return f"sum(CAST({c} AS DECIMAL(18,2)))"


def _as_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def _orders(spark, d, parents: DataFrame | None = None, unique: bool = False) -> Relation:
    o = parents if parents is not None else _t(spark, d, "orders")
    return Relation.from_tables(o, child_key="l_orderkey", parent_key="o_orderkey", unique_parents=unique)


def _customers(spark, d, child_key: str) -> Relation:
    return Relation.from_tables(_t(spark, d, "customer"), child_key=child_key, parent_key="c_custkey")


def _order_line_docs(spark, d) -> DataFrame:
    return mixed_table(
        _t(spark, d, "orders"), _t(spark, d, "lineitem"),
        parent_id="o_orderkey", child_parent_id="l_orderkey",
        parent_role="order", child_role="line",
    )


ORDER_LINE = {"order": "line"}
CUSTOMER_ORDER_LINE = {"customer": "order", "order": "line"}


# ---------------------------------------------------------------- queries

def rollup_sum(spark, d):
    """Flagship: orders per return flag of their big lines, with order value."""
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 25)
    r = parent_rollup(hits, _orders(spark, d), "l_returnflag", {"sp": _dsum("o_totalprice")})
    return _as_double(r, "sp")


def rollup_missing_parent(spark, d):
    """Parents restricted (status P is gone): buckets may drop to 0."""
    live = _t(spark, d, "orders").filter(F.col("o_orderstatus") != "P")
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 49)
    return parent_rollup(hits, _orders(spark, d, live), "l_partkey")


def rollup_chain(spark, d):
    """lineitem → orders → customer, deduplicated at each level."""
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 45)
    rels = [_orders(spark, d), Relation.from_tables(_t(spark, d, "customer"), child_key="o_custkey",
                                                    parent_key="c_custkey")]
    r = chain_rollup(hits, rels, "l_returnflag", {"sa": _dsum("c_acctbal")})
    return _as_double(r, "sa")


def rollup_chain_region(spark, d):
    """Four levels: lineitem → orders → customer → nation → region."""
    rels = [
        _orders(spark, d),
        Relation.from_tables(_t(spark, d, "customer"), child_key="o_custkey", parent_key="c_custkey"),
        Relation.from_tables(_t(spark, d, "nation"), child_key="c_nationkey", parent_key="n_nationkey"),
        Relation.from_tables(_t(spark, d, "region"), child_key="n_regionkey", parent_key="r_regionkey", unique_parents=True),
    ]
    return chain_rollup(_t(spark, d, "lineitem"), rels, "l_linestatus",
                        {"first_region": ("min", "r_name"), "last_region": ("max", "r_name")})


def rollup_terms(spark, d):
    """Customers per term of their orders' priority text (multi-valued buckets)."""
    hits = term_buckets(_t(spark, d, "orders"), "o_orderpriority", "term")
    r = parent_rollup(hits, _customers(spark, d, "o_custkey"), "term", {"sa": _dsum("c_acctbal")})
    return _as_double(r, "sa")


def rollup_doc_terms(spark, d):
    """Documents per term, over every line of every document's whole text.

    Lines are the children (derived by Spark from ``documents``), the document
    is their parent; ``n_lines`` is the term bucket's own count of lines.
    """
    docs = _t(spark, d, "documents")
    text = spread(docs.select("doc_id", "text"), "doc_id")
    lines = text.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    hits = term_buckets(lines, "line", "term")
    rel = Relation.from_tables(docs, child_key="doc_id", parent_key="doc_id")
    return parent_rollup(hits, rel, "term", {"total_chars": ("sum", "n_chars")}, child_count="n_lines")


def rollup_join_field(spark, d):
    """Same relation held as one mixed table with a join field."""
    docs = _order_line_docs(spark, d)
    hits = docs.filter(F.col("join_field.name") == "line")
    rel = Relation.from_join_field(docs, child_role="line", relations=ORDER_LINE)
    return parent_rollup(hits, rel, "l_returnflag", {"n_customers": "count(DISTINCT o_custkey)"})


def rollup_join_field_chain(spark, d):
    """Three roles in one mixed table: line → order → customer."""
    docs = (
        join_field_rows(_t(spark, d, "customer"), "customer", id_of="c_custkey")
        .unionByName(join_field_rows(_t(spark, d, "orders"), "order", id_of="o_orderkey",
                                     parent_of="o_custkey"), allowMissingColumns=True)
        .unionByName(join_field_rows(_t(spark, d, "lineitem"), "line", parent_of="l_orderkey"),
                     allowMissingColumns=True)
    )
    hits = docs.filter((F.col("join_field.name") == "line") & (F.col("l_quantity") > 45))
    rels = [Relation.from_join_field(docs, child_role=r, relations=CUSTOMER_ORDER_LINE)
            for r in ("line", "order")]
    return chain_rollup(hits, rels, "l_returnflag")


def rollup_unknown_role(spark, d):
    """A child role the mixed table does not declare: every bucket is 0."""
    docs = _order_line_docs(spark, d)
    hits = docs.filter(F.col("join_field.name") == "line")
    rel = Relation.from_join_field(docs, child_role="shipment", relations=ORDER_LINE)
    return parent_rollup(hits, rel, "l_returnflag")


def rollup_merge(spark, d):
    """Partial roll-ups of four shards routed by family, merged into one.

    The shard is a grouping column (a function of the family key), so the
    partial results come from one pass over the hits, disjoint by parent.
    """
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 25)
    hits = hits.withColumn("shard", family_route("l_orderkey", 4))
    partials = parent_rollup(hits, _orders(spark, d), ["l_returnflag", "shard"],
                             {"sp": _dsum("o_totalprice")})
    return _as_double(merge_rollups([partials], "l_returnflag", {"sp": "sum"}), "sp")


def rollup_labels(spark, d):
    """Documents per toxicity label, with their size."""
    rel = Relation.from_tables(_t(spark, d, "documents"), child_key="doc_id", parent_key="doc_id")
    return parent_rollup(_t(spark, d, "labels"), rel, "toxic",
                         {"mn": ("min", "n_chars"), "total_chars": ("sum", "n_chars")}, child_count="n_labels")


def rollup_events(spark, d):
    """Customers per event type, with their balance and nations."""
    r = parent_rollup(_t(spark, d, "events"), _customers(spark, d, "user_id"), "event_type",
                      {"sa": _dsum_sql("c_acctbal"), "n_nations": "count(DISTINCT c_nationkey)"},
                      child_count="n_events")
    return _as_double(r, "sa")


def rollup_parts(spark, d):
    """Parts per (return flag, line status): two bucket columns."""
    rel = Relation.from_tables(_t(spark, d, "part"), child_key="l_partkey", parent_key="p_partkey")
    return parent_rollup(_t(spark, d, "lineitem"), rel, ["l_returnflag", "l_linestatus"],
                         {"n_brands": "count(DISTINCT p_brand)", "max_size": "max(p_size)"})


def rollup_global(spark, d):
    """No enclosing bucket: one row."""
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 49)
    return _as_double(parent_rollup(hits, _orders(spark, d), (), {"sp": _dsum("o_totalprice")}), "sp")


def rollup_with_child_count(spark, d):
    """Term-bucket count and parent count side by side."""
    return parent_rollup(_t(spark, d, "lineitem"), _orders(spark, d), "l_returnflag",
                         child_count="n_children")


def lift_rows(spark, d):
    """The lifted parent rows themselves, once per bucket."""
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 49)
    return lift_to_parents(hits, _orders(spark, d), "l_returnflag").select(
        "l_returnflag", "o_orderkey", "o_custkey", "o_totalprice")


def lift_group_below(spark, d):
    """Buckets below the roll-up: lifted parents grouped by their status."""
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 25)
    return (lift_to_parents(hits, _orders(spark, d), "l_returnflag")
            .groupBy("l_returnflag", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


def family_values_lines(spark, d):
    """Line statuses in each order's family, with multiplicity."""
    return family_values(_t(spark, d, "lineitem"), _orders(spark, d), "l_linestatus")


def family_values_join_field(spark, d):
    """Statuses over a whole family, the parent's own status included."""
    docs = (
        join_field_rows(_t(spark, d, "orders").withColumn("status", F.col("o_orderstatus")),
                        "order", id_of="o_orderkey")
        .unionByName(join_field_rows(_t(spark, d, "lineitem").withColumn("status", F.col("l_linestatus")),
                                     "line", parent_of="l_orderkey"), allowMissingColumns=True)
    )
    rel = Relation.from_join_field(docs, child_role="line", relations=ORDER_LINE)
    return family_values(docs, rel, "status", key_name="family")


def filter_predicate(spark, d):
    """Orders whose family holds an open line."""
    orders = _t(spark, d, "orders")
    return family_filter(orders, _orders(spark, d, orders), _t(spark, d, "lineitem"),
                         F.col("l_linestatus") == "O").select("o_orderkey", "o_orderstatus")


def filter_predicate_join_field(spark, d):
    """Every document (order or line) of families holding a line over 49 units."""
    docs = _order_line_docs(spark, d)
    rel = Relation.from_join_field(docs, child_role="line", relations=ORDER_LINE)
    kept = family_filter(docs, rel, docs, F.coalesce(F.col("l_quantity") > 49, F.lit(False)),
                         docs_key=rel.family_key)
    return kept.select(F.col("join_field.name").alias("role"), rel.family_key.alias("family"),
                       F.coalesce("o_orderstatus", "l_linestatus").alias("status"))


def rollup_join_field_terms(spark, d):
    """The reference test's query shape on real tables: one mixed table of
    customers and orders, a term query on the role, term buckets on analysed
    text, customers per term beside the term's own count of orders."""
    docs = (
        join_field_rows(_t(spark, d, "customer"), "customer", id_of="c_custkey")
        .unionByName(join_field_rows(_t(spark, d, "orders"), "order", id_of="o_orderkey",
                                     parent_of="o_custkey"), allowMissingColumns=True)
    )
    hits = term_buckets(docs.filter(F.col("join_field.name") == "order"), "o_orderpriority", "term")
    rel = Relation.from_join_field(docs, child_role="order", relations={"customer": "order"})
    return parent_rollup(hits, rel, "term", child_count="n_orders")


def rollup_live_only(spark, d):
    """Restricted parents, buckets without a live parent dropped."""
    live = _t(spark, d, "orders").filter(F.col("o_orderstatus") != "P")
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 49)
    r = parent_rollup(hits, _orders(spark, d, live), "l_partkey", {"sp": _dsum("o_totalprice")},
                      keep_empty=False)
    return _as_double(r, "sp")


def rollup_missing_parent_co_locate(spark, d):
    """As rollup_missing_parent, pairs co-located by key (left-join plan)."""
    live = _t(spark, d, "orders").filter(F.col("o_orderstatus") != "P")
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 49)
    return parent_rollup(hits, _orders(spark, d, live), "l_partkey", dedup="co_locate")


def rollup_events_co_locate(spark, d):
    """As rollup_events, pairs co-located by key, child counts past the join."""
    r = parent_rollup(_t(spark, d, "events"), _customers(spark, d, "user_id"), "event_type",
                      {"sa": _dsum_sql("c_acctbal"), "n_nations": "count(DISTINCT c_nationkey)"},
                      child_count="n_events", dedup="co_locate")
    return _as_double(r, "sa")


def rollup_orders_by_part(spark, d):
    """
    the order key declared unique."""
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 10)
    return _as_double(parent_rollup(hits, _orders(spark, d, unique=True), "l_partkey", {"sp": _dsum("o_totalprice")}), "sp")


def rollup_orders_by_flag(spark, d):
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 10)
    return _as_double(parent_rollup(hits, _orders(spark, d, unique=True), "l_returnflag", {"sp": _dsum("o_totalprice")}), "sp")


def rollup_conversation_terms(spark, d):
    """Conversations per term of their later turns (whole texts, all roles).

    Each conversation's opening turn (turn 0) is the parent, its later turns
    the children, keyed by ``conv_id``: both derived by Spark from
    ``conversations``. Sub-results run over the opening turns.
    """
    conv = _t(spark, d, "conversations")
    openings = conv.filter(F.col("turn") == 0)
    rel = Relation.from_tables(openings, child_key="conv_id", parent_key="conv_id")
    later = conv.filter(F.col("turn") > 0).select("conv_id", "turn", "text")
    turns = spread(later, "conv_id", "turn")
    hits = term_buckets(turns, "text", "term")
    return parent_rollup(hits, rel, "term",
                         {"opening_chars": ("sum", "length(text)"),
                          "system_opened": ("count", "CASE WHEN role = 'system' THEN 1 END")},
                         child_count="n_turns")


def rollup_merge_shards(spark, d):
    """Three roll-ups computed separately, one per shard of the lines routed by
    family, then merged."""
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 25)
    parts = [parent_rollup(part, _orders(spark, d), "l_returnflag", {"sp": _dsum("o_totalprice")})
             for part in family_shards(hits, "l_orderkey", 3)]
    return _as_double(merge_rollups(parts, "l_returnflag", {"sp": "sum"}), "sp")


def rollup_chain_counts(spark, d):
    """lineitem → orders → customer with the buckets' own line counts, and a
    restricted last level: parts without a customer in debt stay at 0."""
    in_debt = _t(spark, d, "customer").filter(F.col("c_acctbal") < 0)
    rels = [_orders(spark, d), Relation.from_tables(in_debt, child_key="o_custkey", parent_key="c_custkey")]
    return chain_rollup(_t(spark, d, "lineitem"), rels, "l_partkey", {"lowest": ("min", "c_acctbal")}, child_count="n_lines")


def rollup_ratio(spark, d):
    """A post-step on finished buckets: a ratio of two sub-aggregations, and
    only the parts with at least 25 orders."""
    r = parent_rollup(_t(spark, d, "lineitem"), _orders(spark, d), "l_partkey",
                      {"total": _dsum("o_totalprice"), "n_open": ("count", "CASE WHEN o_orderstatus = 'O' THEN 1 END")})
    return r.filter(F.col("doc_count") >= 25).select(
        "l_partkey", "doc_count", (F.col("n_open") / F.col("doc_count")).alias("open_share"),
        (F.col("total").cast("double") / F.col("doc_count")).alias("mean_price"))


def rollup_lookup(spark, d):
    """Buckets looked up by their term, then the number of buckets with their
    hits, then the hit total."""
    hits = term_buckets(_t(spark, d, "orders"), "o_orderpriority", "term")
    r = parent_rollup(hits, _customers(spark, d, "o_custkey"), "term", child_count="n_orders")
    bucket = F.struct("term", "doc_count", "n_orders")
    among_all = F.struct(F.lit("(buckets)").alias("term"), F.lit(1).cast("long").alias("doc_count"), "n_orders")
    looked_up = F.when(F.col("term").isin("high", "urgent", "absent"), bucket)
    rows = r.select(F.explode(F.array(among_all, looked_up)).alias("row")).filter("row IS NOT NULL").select("row.*")
    none = spark.range(1).select(F.lit("(buckets)").alias("term"), F.lit(0).cast("long").alias("doc_count"), F.lit(None).cast("long").alias("n_orders"))
    looked = rows.unionByName(none).groupBy("term").agg(F.sum("doc_count").alias("doc_count"), F.sum("n_orders").alias("n_orders"))
    total = _t(spark, d, "orders").agg(F.lit("(hits)").alias("term"), F.count("o_custkey").alias("doc_count"), F.count(F.lit(1)).alias("n_orders"))
    return looked.unionByName(total)


def filter_rows_predicate(spark, d):
    """Rows that a boolean predicate keeps."""
    kept = filter_rows(_t(spark, d, "orders"), (F.col("o_totalprice") > 100_000) & (F.col("o_orderstatus") != "F"))
    return kept.select("o_orderkey", "o_orderstatus", "o_totalprice")


def _customer_docs(spark, d) -> DataFrame:
    """One mixed table: customers with two child roles, orders and events."""
    parts = (
        join_field_rows(_t(spark, d, "customer").withColumn("mark", F.col("c_mktsegment")), "customer", id_of="c_custkey"),
        join_field_rows(_t(spark, d, "orders").withColumn("mark", F.col("o_orderstatus")), "order", parent_of="o_custkey"),
        join_field_rows(_t(spark, d, "events").withColumn("mark", F.col("event_type")), "event", parent_of="user_id"),
    )
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


CUSTOMER_CHILDREN = {"customer": ["order", "event"]}


def family_values_siblings(spark, d):
    """Marks over whole families: the customer's, its orders' and its events'."""
    docs = _customer_docs(spark, d)
    rel = Relation.from_join_field(docs, child_role="order", relations=CUSTOMER_CHILDREN)
    return family_values(docs, rel, "mark", key_name="family")


def family_filter_siblings(spark, d):
    """Every document of families in which some event is a purchase."""
    docs = _customer_docs(spark, d)
    rel = Relation.from_join_field(docs, child_role="order", relations=CUSTOMER_CHILDREN)
    condition = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    kept = family_filter(docs, rel, docs, condition, docs_key=rel.family_key)
    return kept.groupBy(rel.family_key.alias("family"), F.col("join_field.name").alias("role")).agg(F.count(F.lit(1)).alias("n"))


def family_values_parent(spark, d):
    """Statuses over separate tables, the order's own status included."""
    return family_values(_t(spark, d, "lineitem"), _orders(spark, d), "l_linestatus", parent_value="o_orderstatus")


def rollup_merge_states(spark, d):
    """An average, a distinct count and a median of three shards, merged from
    their states; the sketches' results are held against the exact ones."""
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 25)
    rel = _orders(spark, d)
    aggs = {"mean_price": ("avg", "CAST(o_totalprice AS DECIMAL(18,2))"), "lowest": ("min", "o_totalprice"),
            "customers": ("approx_count_distinct", "o_custkey"), "median": ("percentile", "o_totalprice", 0.5)}
    parts = [partial_rollup(part, rel, "l_returnflag", aggs) for part in family_shards(hits, "l_orderkey", 3)]
    merged = finish_states(merge_states(parts, "l_returnflag"))
    exact = parent_rollup(hits, rel, "l_returnflag", {
        "n": "count(DISTINCT o_custkey)", "low": "percentile(o_totalprice, 0.48)", "high": "percentile(o_totalprice, 0.52)"})
    return merged.join(exact.drop("doc_count"), "l_returnflag").select(
        "l_returnflag", "doc_count", "mean_price", "lowest", (F.abs(F.col("customers") - F.col("n")) <= 0.03 * F.col("n")).alias("customers_near"),
        F.col("median").between(F.col("low"), F.col("high")).alias("median_near"))


def rollup_merge_overlap(spark, d):
    """Two runs over lines that overlap, merged to the exact number of orders."""
    lines, rel = _t(spark, d, "lineitem"), _orders(spark, d)
    runs = [parent_bitmaps(lines.filter(c), rel, "l_returnflag") for c in (F.col("l_quantity") > 20, F.col("l_quantity") < 30)]
    return merge_bitmaps(runs, "l_returnflag", repeated="n_repeated")


def rollup_chain_levels(spark, d):
    """lineitem → orders → customer → nation: counts and sub-results of every
    level, per return flag, from one pass over the lines."""
    customers = Relation.from_tables(_t(spark, d, "customer"), child_key="o_custkey", parent_key="c_custkey", unique_parents=True)
    nations = Relation.from_tables(_t(spark, d, "nation"), child_key="c_nationkey", parent_key="n_nationkey", unique_parents=True)
    r = chain_levels(_t(spark, d, "lineitem").filter(F.col("l_quantity") > 45), [
        ("n_orders", _orders(spark, d, unique=True), {"total": _dsum("o_totalprice"), "open": ("count", "CASE WHEN o_orderstatus = 'O' THEN 1 END")}),
        ("n_customers", customers, {"lowest": ("min", "c_acctbal"), "balance": _dsum("c_acctbal")}),
        ("n_nations", nations, {"first_nation": ("min", "n_name")}),
    ], "l_returnflag", child_count="n_lines")
    return _as_double(r, "total", "balance")


def rollup_bucket_levels(spark, d):
    """Orders per return flag, per order status below it, and per priority below
    that, with distinct customers at each depth, from one lift."""
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 25)
    return bucket_levels(hits, _orders(spark, d), "l_returnflag", ["o_orderstatus", "o_orderpriority"],
                         {"n_customers": "count(DISTINCT o_custkey)", "highest": "max(o_totalprice)"})


def rollup_bucket_tree(spark, d):
    """The nested result: parts with the statuses of their orders (as text)."""
    tree = bucket_tree(_t(spark, d, "lineitem"), _orders(spark, d), "l_partkey", "o_orderstatus", {"highest": "max(o_custkey)"})
    entry = lambda b: F.concat_ws(":", b["o_orderstatus"], b["doc_count"], b["highest"])
    return tree.select("l_partkey", "doc_count", "highest", F.array_join(F.transform("buckets", entry), ",").alias("statuses"))


def rollup_declared_ranges(spark, d):
    """Orders per declared range of their lines' quantity: ranges that overlap,
    and one that no line is in."""
    ranges = {"small": (None, 10), "middle": (5, 30), "large": (25, None), "huge": (1000, None)}
    hits = filter_buckets(_t(spark, d, "lineitem"), range_filters("l_quantity", ranges), "size")
    r = parent_rollup(hits, _orders(spark, d), "size", {"total": _dsum("o_totalprice")}, child_count="n_lines")
    return _as_double(declared(r, list(ranges), "size", zero=("doc_count", "n_lines")), "total")


def rollup_expressions(spark, d):
    """Sub-aggregations that are expressions over aggregates, or ordered-set ones."""
    return parent_rollup(_t(spark, d, "lineitem").filter(F.col("l_quantity") > 25), _orders(spark, d), "l_returnflag", {
        "spread": "max(o_custkey) - min(o_custkey)", "n_open": "count(CASE WHEN o_orderstatus = 'O' THEN 1 END)",
        "middle": "percentile_cont(0.5) WITHIN GROUP (ORDER BY o_custkey)",
        "open_share": "count(CASE WHEN o_orderstatus = 'O' THEN 1 END) / count(*)"})


def rollup_running(spark, d):
    """Orders per part, their running total by part and the step from the part before."""
    r = parent_rollup(_t(spark, d, "lineitem"), _orders(spark, d), "l_partkey")
    return running(r, "l_partkey", {"so_far": "doc_count"}, {"step": "doc_count"})


def family_having_closed(spark, d):
    """Orders whose lines are all closed, three of them at least."""
    orders = _t(spark, d, "orders")
    kept = family_having(orders, _orders(spark, d, orders), _t(spark, d, "lineitem"),
                         {"closed": F.col("l_linestatus") == "F"}, "closed = size AND size >= 3")
    return kept.select("o_orderkey", "o_orderstatus")


def family_having_siblings(spark, d):
    """Families of customers, orders and events with a purchase but no finished
    order, over one mixed table: their documents, per role."""
    docs = _customer_docs(spark, d)
    rel = Relation.from_join_field(docs, child_role="order", relations=CUSTOMER_CHILDREN)
    counts = {"bought": F.col("event_type") == "purchase", "finished": F.col("o_orderstatus") == "F"}
    kept = family_having(docs, rel, docs, counts, "bought > 0 AND finished = 0", docs_key=rel.family_key)
    return kept.groupBy(rel.family_key.alias("family"), F.col("join_field.name").alias("role")).agg(F.count(F.lit(1)).alias("n"))


def rollup_stored(spark, d):
    """Lines and orders stored bucketed by the order key, then rolled up without
    an exchange before the join."""
    at, run = ensure_checkpoint_dir(spark), uuid.uuid4().hex
    hits = _t(spark, d, "lineitem").filter(F.col("l_quantity") > 25).select("l_orderkey", "l_returnflag")
    for df, name, key in ((hits, "lines", "l_orderkey"), (_t(spark, d, "orders").select("o_orderkey", "o_totalprice"), "orders", "o_orderkey")):
        write_co_located(df, f"kr_{name}_{run}", key, 8, path=f"{at}/{name}-{run}")
    rel = Relation.from_tables(spark.table(f"kr_orders_{run}"), child_key="l_orderkey", parent_key="o_orderkey")
    r = parent_rollup(spark.table(f"kr_lines_{run}"), rel, "l_returnflag", {"sp": _dsum("o_totalprice")}, dedup="prepartitioned")
    return _as_double(r, "sp")


def rollup_split(spark, d):
    """Customers per event type: hits of heavy customers deduplicated map-side,
    all others co-located (the heaviest one given, so that both plans run)."""
    events = _t(spark, d, "events")
    r = parent_rollup(events, _customers(spark, d, "user_id"), "event_type", {"sa": _dsum("c_acctbal")},
                      child_count="n_events", dedup="split", heavy=[1, 7, None])
    return _as_double(r, "sa")


def rollup_live_reduced(spark, d):
    """Few live parents: the hits are reduced to theirs before any shuffle."""
    live = _orders(spark, d, _t(spark, d, "orders").filter((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200_000)))
    hits = only_live(_t(spark, d, "lineitem"), live)
    return _as_double(parent_rollup(hits, live, "l_partkey", {"sp": _dsum("o_totalprice")}, keep_empty=False), "sp")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rollup_sum": rollup_sum,
    "rollup_missing_parent": rollup_missing_parent,
    "rollup_chain": rollup_chain,
    "rollup_chain_region": rollup_chain_region,
    "rollup_terms": rollup_terms,
    "rollup_doc_terms": rollup_doc_terms,
    "rollup_join_field": rollup_join_field,
    "rollup_join_field_chain": rollup_join_field_chain,
    "rollup_unknown_role": rollup_unknown_role,
    "rollup_merge": rollup_merge,
    "rollup_labels": rollup_labels,
    "rollup_events": rollup_events,
    "rollup_parts": rollup_parts,
    "rollup_global": rollup_global,
    "rollup_with_child_count": rollup_with_child_count,
    "lift_rows": lift_rows,
    "lift_group_below": lift_group_below,
    "family_values": family_values_lines,
    "family_values_join_field": family_values_join_field,
    "filter_predicate": filter_predicate,
    "filter_predicate_join_field": filter_predicate_join_field,
    "rollup_join_field_terms": rollup_join_field_terms,
    "rollup_live_only": rollup_live_only,
    "rollup_missing_parent_co_locate": rollup_missing_parent_co_locate,
    "rollup_events_co_locate": rollup_events_co_locate,
    "rollup_orders_by_part": rollup_orders_by_part,
    "rollup_orders_by_flag": rollup_orders_by_flag,
    "rollup_conversation_terms": rollup_conversation_terms,
    "rollup_merge_shards": rollup_merge_shards,
    "rollup_chain_counts": rollup_chain_counts,
    "rollup_ratio": rollup_ratio,
    "rollup_lookup": rollup_lookup,
    "filter_rows": filter_rows_predicate,
    "family_values_siblings": family_values_siblings,
    "family_filter_siblings": family_filter_siblings,
    "family_values_parent": family_values_parent,
    "rollup_merge_states": rollup_merge_states,
    "rollup_merge_overlap": rollup_merge_overlap,
    "rollup_chain_levels": rollup_chain_levels,
    "rollup_bucket_levels": rollup_bucket_levels,
    "rollup_bucket_tree": rollup_bucket_tree,
    "rollup_declared_ranges": rollup_declared_ranges,
    "rollup_expressions": rollup_expressions,
    "rollup_running": rollup_running,
    "family_having_closed": family_having_closed,
    "family_having_siblings": family_having_siblings,
    "rollup_stored": rollup_stored,
    "rollup_split": rollup_split,
    "rollup_live_reduced": rollup_live_reduced,
}


# ------------------------------------------------------------- oracle SQL

_TOKENS = r"list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> ''))"


def _tokens(c: str) -> str:
    return _TOKENS.format(c=c)


_ROLLUP_SUM = """
SELECT h.l_returnflag, count(o.o_orderkey) AS doc_count,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sp
FROM (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem WHERE l_quantity > 25) h
LEFT JOIN orders o ON h.l_orderkey = o.o_orderkey
GROUP BY h.l_returnflag
"""

ORACLE_SQL: dict[str, str] = {
    "rollup_sum": _ROLLUP_SUM,
    "rollup_missing_parent": """
SELECT h.l_partkey, count(o.o_orderkey) AS doc_count
FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem WHERE l_quantity > 49) h
LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON h.l_orderkey = o.o_orderkey
GROUP BY h.l_partkey
""",
    "rollup_chain": """
WITH h AS (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem WHERE l_quantity > 45),
     l1 AS (SELECT DISTINCT h.l_returnflag, o.o_custkey FROM h LEFT JOIN orders o ON h.l_orderkey = o.o_orderkey)
SELECT l1.l_returnflag, count(c.c_custkey) AS doc_count,
       CAST(sum(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS sa
FROM l1 LEFT JOIN customer c ON l1.o_custkey = c.c_custkey
GROUP BY l1.l_returnflag
""",
    "rollup_chain_region": """
WITH h AS (SELECT DISTINCT l_linestatus, l_orderkey FROM lineitem),
     l1 AS (SELECT DISTINCT h.l_linestatus, o.o_custkey FROM h LEFT JOIN orders o ON h.l_orderkey = o.o_orderkey),
     l2 AS (SELECT DISTINCT l1.l_linestatus, c.c_nationkey FROM l1 LEFT JOIN customer c ON l1.o_custkey = c.c_custkey),
     l3 AS (SELECT DISTINCT l2.l_linestatus, n.n_regionkey FROM l2 LEFT JOIN nation n ON l2.c_nationkey = n.n_nationkey)
SELECT l3.l_linestatus, count(r.r_regionkey) AS doc_count,
       min(r.r_name) AS first_region, max(r.r_name) AS last_region
FROM l3 LEFT JOIN region r ON l3.n_regionkey = r.r_regionkey
GROUP BY l3.l_linestatus
""",
    "rollup_terms": f"""
WITH h AS (SELECT DISTINCT term, o_custkey
           FROM (SELECT o_custkey, unnest({_tokens('o_orderpriority')}) AS term FROM orders) t)
SELECT h.term, count(c.c_custkey) AS doc_count,
       CAST(sum(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS sa
FROM h LEFT JOIN customer c ON h.o_custkey = c.c_custkey
GROUP BY h.term
""",
    "rollup_doc_terms": f"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
     lt AS (SELECT doc_id, unnest({_tokens('line')}) AS term FROM lines),
     c AS (SELECT term, count(*) AS n_lines FROM lt GROUP BY term),
     p AS (SELECT h.term, count(d.doc_id) AS doc_count, CAST(sum(d.n_chars) AS BIGINT) AS total_chars
           FROM (SELECT DISTINCT term, doc_id FROM lt) h LEFT JOIN documents d ON h.doc_id = d.doc_id
           GROUP BY h.term)
SELECT p.term, p.doc_count, c.n_lines, p.total_chars FROM p JOIN c ON p.term = c.term
""",
    "rollup_join_field": """
SELECT h.l_returnflag, count(o.o_orderkey) AS doc_count, count(DISTINCT o.o_custkey) AS n_customers
FROM (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem) h
LEFT JOIN orders o ON h.l_orderkey = o.o_orderkey
GROUP BY h.l_returnflag
""",
    "rollup_join_field_chain": """
WITH h AS (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem WHERE l_quantity > 45),
     l1 AS (SELECT DISTINCT h.l_returnflag, o.o_custkey FROM h LEFT JOIN orders o ON h.l_orderkey = o.o_orderkey)
SELECT l1.l_returnflag, count(c.c_custkey) AS doc_count
FROM l1 LEFT JOIN customer c ON l1.o_custkey = c.c_custkey
GROUP BY l1.l_returnflag
""",
    "rollup_unknown_role": """
SELECT DISTINCT l_returnflag, CAST(0 AS BIGINT) AS doc_count FROM lineitem
""",
    "rollup_merge": _ROLLUP_SUM,
    "rollup_labels": """
WITH c AS (SELECT toxic, count(*) AS n_labels FROM labels GROUP BY toxic),
     p AS (SELECT h.toxic, count(d.doc_id) AS doc_count, min(d.n_chars) AS mn,
                  CAST(sum(d.n_chars) AS BIGINT) AS total_chars
           FROM (SELECT DISTINCT toxic, doc_id FROM labels) h LEFT JOIN documents d ON h.doc_id = d.doc_id
           GROUP BY h.toxic)
SELECT p.toxic, p.doc_count, c.n_labels, p.mn, p.total_chars
FROM p JOIN c ON p.toxic IS NOT DISTINCT FROM c.toxic
""",
    "rollup_events": """
WITH c AS (SELECT event_type, count(*) AS n_events FROM events GROUP BY event_type),
     p AS (SELECT h.event_type, count(cu.c_custkey) AS doc_count,
                  CAST(sum(CAST(cu.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS sa,
                  count(DISTINCT cu.c_nationkey) AS n_nations
           FROM (SELECT DISTINCT event_type, user_id FROM events) h
           LEFT JOIN customer cu ON h.user_id = cu.c_custkey
           GROUP BY h.event_type)
SELECT p.event_type, p.doc_count, c.n_events, p.sa, p.n_nations
FROM p JOIN c ON p.event_type IS NOT DISTINCT FROM c.event_type
""",
    "rollup_parts": """
SELECT h.l_returnflag, h.l_linestatus, count(p.p_partkey) AS doc_count,
       count(DISTINCT p.p_brand) AS n_brands, max(p.p_size) AS max_size
FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_partkey FROM lineitem) h
LEFT JOIN part p ON h.l_partkey = p.p_partkey
GROUP BY h.l_returnflag, h.l_linestatus
""",
    "rollup_global": """
SELECT count(o.o_orderkey) AS doc_count,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sp
FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 49) h
LEFT JOIN orders o ON h.l_orderkey = o.o_orderkey
""",
    "rollup_with_child_count": """
WITH c AS (SELECT l_returnflag, count(*) AS n_children FROM lineitem GROUP BY l_returnflag),
     p AS (SELECT h.l_returnflag, count(o.o_orderkey) AS doc_count
           FROM (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem) h
           LEFT JOIN orders o ON h.l_orderkey = o.o_orderkey
           GROUP BY h.l_returnflag)
SELECT p.l_returnflag, p.doc_count, c.n_children
FROM p JOIN c ON p.l_returnflag IS NOT DISTINCT FROM c.l_returnflag
""",
    "lift_rows": """
SELECT h.l_returnflag, o.o_orderkey, o.o_custkey, o.o_totalprice
FROM (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem WHERE l_quantity > 49) h
JOIN orders o ON h.l_orderkey = o.o_orderkey
""",
    "lift_group_below": """
SELECT h.l_returnflag, o.o_orderstatus, count(*) AS n
FROM (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem WHERE l_quantity > 25) h
JOIN orders o ON h.l_orderkey = o.o_orderkey
GROUP BY h.l_returnflag, o.o_orderstatus
""",
    "family_values": """
SELECT l_orderkey AS o_orderkey, l_linestatus, count(*) AS n
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linestatus IS NOT NULL
GROUP BY l_orderkey, l_linestatus
""",
    "family_values_join_field": """
SELECT family, status, count(*) AS n
FROM (SELECT o_orderkey AS family, o_orderstatus AS status FROM orders
      UNION ALL
      SELECT l_orderkey, l_linestatus FROM lineitem WHERE l_orderkey IS NOT NULL) f
WHERE status IS NOT NULL
GROUP BY family, status
""",
    "filter_predicate": """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'O')
""",
    "filter_predicate_join_field": """
WITH docs AS (SELECT 'order' AS role, o_orderkey AS family, o_orderstatus AS status FROM orders
              UNION ALL
              SELECT 'line', l_orderkey, l_linestatus FROM lineitem)
SELECT role, family, status FROM docs
WHERE family IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)
""",
}

ORACLE_SQL["rollup_join_field_terms"] = f"""
WITH t AS (SELECT o_custkey, unnest({_tokens('o_orderpriority')}) AS term FROM orders),
     c AS (SELECT term, count(*) AS n_orders FROM t GROUP BY term),
     p AS (SELECT h.term, count(cu.c_custkey) AS doc_count
           FROM (SELECT DISTINCT term, o_custkey FROM t) h
           LEFT JOIN customer cu ON h.o_custkey = cu.c_custkey
           GROUP BY h.term)
SELECT p.term, p.doc_count, c.n_orders FROM p JOIN c ON p.term = c.term
"""

ORACLE_SQL["rollup_live_only"] = """
SELECT h.l_partkey, count(*) AS doc_count,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sp
FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem WHERE l_quantity > 49) h
JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON h.l_orderkey = o.o_orderkey
GROUP BY h.l_partkey
"""

ORACLE_SQL["rollup_missing_parent_co_locate"] = ORACLE_SQL["rollup_missing_parent"]
ORACLE_SQL["rollup_events_co_locate"] = ORACLE_SQL["rollup_events"]

for _by in ("l_partkey", "l_returnflag"):
    ORACLE_SQL["rollup_orders_by_part" if _by == "l_partkey" else "rollup_orders_by_flag"] = f"""
SELECT h.{_by}, count(o.o_orderkey) AS doc_count,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sp
FROM (SELECT DISTINCT {_by}, l_orderkey FROM lineitem WHERE l_quantity > 10) h
LEFT JOIN orders o ON h.l_orderkey = o.o_orderkey
GROUP BY h.{_by}
"""

ORACLE_SQL["rollup_conversation_terms"] = f"""
WITH t AS (SELECT conv_id, unnest({_tokens('text')}) AS term FROM conversations WHERE turn > 0),
     c AS (SELECT term, count(*) AS n_turns FROM t GROUP BY term),
     p AS (SELECT h.term, count(o.conv_id) AS doc_count,
                  CAST(sum(length(o.text)) AS BIGINT) AS opening_chars,
                  count(CASE WHEN o.role = 'system' THEN 1 END) AS system_opened
           FROM (SELECT DISTINCT term, conv_id FROM t) h
           LEFT JOIN (SELECT * FROM conversations WHERE turn = 0) o ON h.conv_id = o.conv_id
           GROUP BY h.term)
SELECT p.term, p.doc_count, c.n_turns, p.opening_chars, p.system_opened FROM p JOIN c ON p.term = c.term
"""

ORACLE_SQL["rollup_merge_shards"] = _ROLLUP_SUM

ORACLE_SQL["rollup_chain_counts"] = """
WITH l1 AS (SELECT DISTINCT l_partkey, o_custkey FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
     n AS (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY l_partkey)
SELECT l1.l_partkey, count(c_custkey) AS doc_count, any_value(n.n_lines) AS n_lines, min(c_acctbal) AS lowest
FROM l1 JOIN n ON l1.l_partkey = n.l_partkey
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal < 0) c ON l1.o_custkey = c.c_custkey
GROUP BY l1.l_partkey
"""

ORACLE_SQL["rollup_ratio"] = """
SELECT h.l_partkey, count(*) AS doc_count,
       CAST(count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS DOUBLE) / count(*) AS open_share,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price
FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem) h JOIN orders ON l_orderkey = o_orderkey
GROUP BY h.l_partkey HAVING count(*) >= 25
"""

ORACLE_SQL["rollup_lookup"] = f"""
WITH t AS (SELECT o_custkey, unnest({_tokens('o_orderpriority')}) AS term FROM orders),
     r AS (SELECT term, count(DISTINCT c_custkey) AS doc_count, count(*) AS n_orders
           FROM t LEFT JOIN customer ON o_custkey = c_custkey GROUP BY term)
SELECT term, doc_count, n_orders FROM r WHERE term IN ('high', 'urgent', 'absent')
UNION ALL SELECT '(buckets)', count(*), CAST(sum(n_orders) AS BIGINT) FROM r
UNION ALL SELECT '(hits)', count(o_custkey), count(*) FROM orders
"""

ORACLE_SQL["filter_rows"] = """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'F'
"""

_CUSTOMER_DOCS = """
docs AS (SELECT 'customer' AS role, c_custkey AS family, c_mktsegment AS mark FROM customer
         UNION ALL SELECT 'order', o_custkey, o_orderstatus FROM orders
         UNION ALL SELECT 'event', user_id, event_type FROM events)"""

ORACLE_SQL["family_values_siblings"] = f"""
WITH {_CUSTOMER_DOCS}
SELECT family, mark, count(*) AS n FROM docs WHERE family IS NOT NULL AND mark IS NOT NULL GROUP BY family, mark
"""

ORACLE_SQL["family_filter_siblings"] = f"""
WITH {_CUSTOMER_DOCS}
SELECT family, role, count(*) AS n FROM docs
WHERE family IN (SELECT user_id FROM events WHERE event_type = 'purchase') GROUP BY family, role
"""

ORACLE_SQL["family_values_parent"] = """
SELECT o_orderkey, l_linestatus, count(*) AS n
FROM (SELECT o_orderkey, o_orderstatus AS l_linestatus FROM orders
      UNION ALL SELECT l_orderkey, l_linestatus FROM lineitem WHERE l_orderkey IS NOT NULL) f
WHERE l_linestatus IS NOT NULL GROUP BY o_orderkey, l_linestatus
"""

_BIG_PAIRS = "SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem WHERE l_quantity > 25"

ORACLE_SQL["rollup_merge_states"] = f"""
SELECT l_returnflag, count(*) AS doc_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price,
       min(o_totalprice) AS lowest, TRUE AS customers_near, TRUE AS median_near
FROM ({_BIG_PAIRS}) h JOIN orders ON l_orderkey = o_orderkey GROUP BY l_returnflag
"""

ORACLE_SQL["rollup_merge_overlap"] = """
WITH h AS (SELECT l_returnflag, o_orderkey, bool_or(l_quantity > 20) AS a, bool_or(l_quantity < 30) AS b
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT l_returnflag, count(*) FILTER (a OR b) AS doc_count, count(*) FILTER (a AND b) AS n_repeated FROM h GROUP BY l_returnflag
"""

ORACLE_SQL["rollup_chain_levels"] = """
WITH h AS (SELECT * FROM lineitem WHERE l_quantity > 45),
l1 AS (SELECT * FROM (SELECT DISTINCT l_returnflag, l_orderkey FROM h) JOIN orders ON l_orderkey = o_orderkey),
l2 AS (SELECT * FROM (SELECT DISTINCT l_returnflag, o_custkey FROM l1) JOIN customer ON o_custkey = c_custkey),
l3 AS (SELECT * FROM (SELECT DISTINCT l_returnflag, c_nationkey FROM l2) JOIN nation ON c_nationkey = n_nationkey)
SELECT * FROM (SELECT l_returnflag, count(*) AS n_lines FROM h GROUP BY 1)
JOIN (SELECT l_returnflag, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
             count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS open FROM l1 GROUP BY 1) USING (l_returnflag)
JOIN (SELECT l_returnflag, count(*) AS n_customers, min(c_acctbal) AS lowest,
             CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM l2 GROUP BY 1) USING (l_returnflag)
JOIN (SELECT l_returnflag, count(*) AS n_nations, min(n_name) AS first_nation FROM l3 GROUP BY 1) USING (l_returnflag)
"""

ORACLE_SQL["rollup_bucket_levels"] = f"""
SELECT CAST(2 - grouping(o_orderstatus) - grouping(o_orderpriority) AS INTEGER) AS level, l_returnflag, o_orderstatus, o_orderpriority,
       count(*) AS doc_count, count(DISTINCT o_custkey) AS n_customers, max(o_totalprice) AS highest
FROM ({_BIG_PAIRS}) h JOIN orders ON l_orderkey = o_orderkey
GROUP BY GROUPING SETS ((l_returnflag), (l_returnflag, o_orderstatus), (l_returnflag, o_orderstatus, o_orderpriority))
"""

ORACLE_SQL["rollup_bucket_tree"] = """
WITH h AS (SELECT * FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem) JOIN orders ON l_orderkey = o_orderkey),
b AS (SELECT l_partkey, o_orderstatus, count(*) AS n, max(o_custkey) AS highest FROM h GROUP BY 1, 2)
SELECT l_partkey, CAST(sum(n) AS BIGINT) AS doc_count, max(highest) AS highest,
       string_agg(o_orderstatus || ':' || n || ':' || highest, ',' ORDER BY o_orderstatus) AS statuses
FROM b GROUP BY l_partkey
"""

ORACLE_SQL["rollup_declared_ranges"] = """
WITH r(size, low, high) AS (VALUES ('small', -1e9, 10), ('middle', 5, 30), ('large', 25, 1e9), ('huge', 1000, 1e9)),
h AS (SELECT size, l_orderkey, count(*) AS n FROM lineitem JOIN r ON l_quantity >= low AND l_quantity < high GROUP BY ALL)
SELECT r.size, count(o_orderkey) AS doc_count, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_lines,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM r LEFT JOIN h ON r.size = h.size LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY r.size
"""

ORACLE_SQL["rollup_expressions"] = f"""
SELECT l_returnflag, count(*) AS doc_count, max(o_custkey) - min(o_custkey) AS spread,
       count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS n_open, quantile_cont(CAST(o_custkey AS DOUBLE), 0.5) AS middle,
       CAST(count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS DOUBLE) / count(*) AS open_share
FROM ({_BIG_PAIRS}) h JOIN orders ON l_orderkey = o_orderkey GROUP BY l_returnflag
"""

ORACLE_SQL["rollup_running"] = """
WITH r AS (SELECT l_partkey, count(*) AS doc_count FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem)
           JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey)
SELECT *, CAST(sum(doc_count) OVER (ORDER BY l_partkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far,
       doc_count - lag(doc_count) OVER (ORDER BY l_partkey) AS step FROM r
"""

ORACLE_SQL["family_having_closed"] = """
SELECT o_orderkey, o_orderstatus FROM orders JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY ALL HAVING count(*) >= 3 AND bool_and(l_linestatus = 'F')
"""

ORACLE_SQL["family_having_siblings"] = f"""
WITH {_CUSTOMER_DOCS}
SELECT family, role, count(*) AS n FROM docs
WHERE family IN (SELECT user_id FROM events WHERE event_type = 'purchase')
  AND family NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL)
GROUP BY family, role
"""

ORACLE_SQL["rollup_stored"] = _ROLLUP_SUM

ORACLE_SQL["rollup_split"] = """
WITH h AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL)
SELECT event_type, count(c_custkey) AS doc_count, CAST(sum(n) AS BIGINT) AS n_events,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS sa
FROM h LEFT JOIN customer ON user_id = c_custkey GROUP BY event_type
"""

ORACLE_SQL["rollup_live_reduced"] = """
SELECT l_partkey, count(*) AS doc_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sp
FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem) h
JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P' AND o_totalprice > 200000 GROUP BY l_partkey
"""

FLAGSHIP = "rollup_sum"
