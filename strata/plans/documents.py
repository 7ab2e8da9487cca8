"""Nested JSON documents derived from the driver tables, as inputs of the flatten queries.

The flatten operators take documents; the driver ships flat tables.  These
builders nest the tables back into the document shapes of the raw layer, so the
flat SQL over the same tables is the oracle of each flatten query.

Every nested list is bounded, whatever the data's skew: line items are nested by
blocks of ``CHUNK`` line numbers, and lists of orders are paged at most ``PAGE``
orders per document (by order key).  The block is arithmetic on the line number, so
a hot order is spread over as many groups as it has blocks, and nothing is ranked or
sorted.  The flat result doesn't depend on the blocks.  A posting's roles are the
distinct (status, flag) pairs of its order, a list bounded by that domain, so every
order is one posting whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import read_table

# Nesting bounds (fixed values): items per nested list, orders per page document.
CHUNK = 64
PAGE = 100


def _lines(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    """Line items with ``chunk`` = (line number - 1) div CHUNK (0 without a number).

    The later grouping by (order, chunk) is the only shuffle."""
    df = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", *cols])
    return df.withColumn("chunk", F.coalesce(F.floor((F.col("l_linenumber") - 1) / CHUNK), F.lit(0)).cast("int"))


def _chunk_lists(lines: DataFrame, item: Column, extra: list[Column] = ()) -> DataFrame:
    """(l_orderkey, chunk) → ``items``: the chunk's items ordered by line number."""
    agg = (lines.groupBy("l_orderkey", "chunk")
                .agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("_k"),
                                                          item.alias("_v")))).alias("_items"),
                     *extra))
    return agg.withColumn("items", F.transform("_items", lambda x: x["_v"])).drop("_items")


def role_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue pages ``{"categories": [{id, name, roles: [...]}, ...]}``.

    A category is an order, its roles are the order's line items (one category
    entry per line chunk); orders without lines carry no ``roles`` key.
    """
    role = F.struct(
        F.col("l_linenumber").cast("string").alias("id"),
        F.col("l_returnflag").alias("name"),
        (F.col("l_linestatus") == "O").alias("accept_incomplete_resumes"),
        (F.col("l_discount") >= 0.05).alias("is_default"),
        (F.col("l_tax") >= 0.05).alias("select_deprecated"),
        F.lit(False).alias("search_deprecated"),
    )
    chunks = _chunk_lists(_lines(spark, sf_dir, ["l_returnflag", "l_linestatus", "l_discount", "l_tax"]), role)
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority"])
    cats = orders.join(chunks, orders.o_orderkey == chunks.l_orderkey, "left").select(
        F.floor(F.col("o_orderkey") / PAGE).alias("page"), "chunk",
        F.struct(F.col("o_orderkey").cast("string").alias("id"),
                 F.col("o_orderpriority").alias("name"),
                 F.col("items").alias("roles")).alias("cat"))
    pages = cats.groupBy("page", "chunk").agg(F.collect_list("cat").alias("categories"))
    return pages.select(F.to_json(F.struct("categories")).alias("doc"))


def rate_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate documents, one per line item, keyed by data: the line's return flag and
    its status are the two entry keys (disjoint value sets).

    ``Date`` is the ship date at 01:30 in UTC+3, so its UTC date is the day before.
    Built row by row: no grouping, no shuffle.
    """
    lines = read_table(spark, sf_dir, "lineitem",
                       ["l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice", "l_discount",
                        "l_quantity", "l_shipdate"])
    flag = F.struct(F.lit("flag").alias("Name"), F.col("l_extendedprice").alias("Value"),
                    F.col("l_quantity").cast("int").alias("Nominal"))
    status = F.struct(F.lit("status").alias("Name"), F.col("l_discount").alias("Value"),
                      F.col("l_linenumber").alias("Nominal"))
    valute = F.create_map(F.col("l_returnflag"), flag, F.col("l_linestatus"), status)
    date_text = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T01:30:00+03:00"))
    return lines.select(F.to_json(F.struct(date_text.alias("Date"), valute.alias("Valute"))).alias("doc"))


def posting_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting pages: a JSON array of postings per order page.

    A posting is an order with its customer as ``employer``, the customer's nation
    as ``area``, a ``salary`` unless the order is pending, offset timestamps, and the
    distinct (line status, return flag) pairs of its lines as ``professional_roles``
    (absent when the order has no lines).
    """
    role = F.struct(F.col("l_linestatus").alias("id"), F.col("l_returnflag").alias("name"))
    roles = (read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linestatus", "l_returnflag"])
             .groupBy("l_orderkey").agg(F.sort_array(F.collect_set(role)).alias("items")))
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                         "o_orderpriority"])
    customers = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    nations = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    ref = lambda i, n: F.struct(F.col(i).cast("string").alias("id"), F.col(n).alias("name"))
    local = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    salary = F.when(F.col("o_orderstatus") != "P", F.struct(
        F.floor(F.col("o_totalprice") / 100).cast("double").alias("from"),
        F.floor(F.col("o_totalprice") / 10).cast("double").alias("to"),
        F.lit("USD").alias("currency"),
        (F.col("o_orderstatus") == "F").alias("gross")))
    posting = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.when(F.col("n_nationkey").isNotNull(), ref("n_nationkey", "n_name")).alias("area"),
        F.when(F.col("c_custkey").isNotNull(), ref("c_custkey", "c_name")).alias("employer"),
        salary.alias("salary"),
        ref("c_mktsegment", "c_mktsegment").alias("experience"),
        ref("o_orderstatus", "o_orderstatus").alias("schedule"),
        F.concat(local, F.lit("+0300")).alias("published_at"),
        F.concat(local, F.lit("+0000")).alias("created_at"),
        F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string")).alias("alternate_url"),
        F.col("items").alias("professional_roles"),
    )
    joined = (orders.join(customers, orders.o_custkey == customers.c_custkey, "left")
                    .join(nations, F.col("c_nationkey") == nations.n_nationkey, "left")
                    .join(roles, orders.o_orderkey == roles.l_orderkey, "left"))
    pages = (joined.groupBy(F.floor(F.col("o_orderkey") / PAGE).alias("page"))
                   .agg(F.collect_list(posting).alias("items")))
    return pages.select(F.to_json("items").alias("doc"))


def industry_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups ``{id, name, industries: [{id, name}, ...]}``: an order and a block of its lines."""
    item = F.struct(F.col("l_linenumber").cast("string").alias("id"), F.col("l_returnflag").alias("name"))
    chunks = _chunk_lists(_lines(spark, sf_dir, ["l_returnflag"]), item)
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority"])
    return orders.join(chunks, orders.o_orderkey == chunks.l_orderkey, "left").select(F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("name"),
        F.col("items").alias("industries"))).alias("doc"))


def _line_node(with_children: Column) -> Column:
    ship = F.struct(
        F.concat(F.lit("s"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("id"),
        F.concat(F.lit("l"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("parent_id"),
        F.col("l_linestatus").alias("name"),
        F.col("l_returnflag").alias("lat"),
        F.col("l_tax").alias("lng"),
    )
    return F.struct(
        F.concat(F.lit("l"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("id"),
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("parent_id"),
        F.col("l_returnflag").alias("name"),
        F.col("l_quantity").cast("string").alias("lat"),
        F.col("l_discount").alias("lng"),
        # One child when open, otherwise an empty (typed) list.
        F.filter(F.array(ship), lambda _: with_children).alias("areas"),
    )


def area_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region-style forests: order → line items → shipment node, as JSON arrays of roots.

    An order node holds its first line chunk under ``areas`` (no ``areas`` key when
    it has no lines); further chunks are documents whose roots are line nodes that
    name their order in ``parent_id``.  Open lines have one child; others have
    ``areas: []``; shipment nodes have no ``areas`` key.  ``lat``/``lng`` mix
    numbers, numeric text and non-numeric text.
    """
    # Lines are dealt by (order, chunk) as they were read; their nodes, which are longer, are built where they stay.
    lines = _lines(spark, sf_dir, ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"]).repartition("l_orderkey", "chunk")
    chunks = _chunk_lists(lines, _line_node(F.col("l_linestatus") == "O"))
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus"])
    order_node = F.struct(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("lat"),
        F.col("o_orderstatus").alias("lng"),
        F.col("items").alias("areas"),
    )
    # One full outer join places every chunk: the first chunk of an order under its
    # order node, every other chunk (and any chunk without an order) as roots.  The
    # chunk aggregate is computed once, and joined where it was made: an order asks for
    # chunk 0 by a key of its own (no literal, which the optimizer would fold out of the keys).
    orders = orders.withColumn("o_chunk", F.when(F.col("o_orderkey").isNotNull(), 0))
    placed = orders.join(chunks, (orders.o_orderkey == chunks.l_orderkey) & (orders.o_chunk == chunks.chunk), "full_outer")
    return placed.select(
        F.when(F.col("o_orderkey").isNotNull(), F.to_json(F.array(order_node)))
         .otherwise(F.to_json("items")).alias("doc"))


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundle objects, one per line chunk of an order, with entries of mixed kinds.

    ``lines`` is an array of ``{id, name}``; ``parts`` an array of ``{code, name}``
    (no ``id``); ``empty`` is ``[]``; ``label`` a string that looks like an array;
    ``order`` a number; ``meta`` an object.
    """
    lines = _lines(spark, sf_dir, ["l_partkey", "l_returnflag", "l_linestatus"])
    agg = lines.groupBy("l_orderkey", "chunk").agg(
        F.collect_list(F.struct(F.col("l_linenumber").alias("id"), F.col("l_returnflag").alias("name"))).alias("lines"),
        F.collect_list(F.struct(F.col("l_partkey").alias("code"), F.col("l_linestatus").alias("name"))).alias("parts"),
        F.count(F.lit(1)).alias("n"))
    doc = F.struct(
        "lines", "parts",
        F.array().cast("array<string>").alias("empty"),
        F.concat(F.lit("["), F.col("l_orderkey").cast("string"), F.lit("]")).alias("label"),
        F.col("l_orderkey").alias("order"),
        F.struct(F.col("n").alias("lines")).alias("meta"),
    )
    return agg.select(F.to_json(doc).alias("doc"))
