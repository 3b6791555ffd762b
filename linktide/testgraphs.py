"""Graphs and dumps derived from the trade tables, for queries, tests and the bench."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.operators.graph import Graph, clean_graph
from linktide.operators.skew import HOT_ROWS, KeyParts
from linktide.scratch import Scratch, sorted_lists, string_partitions

# Links that are worth a task of their own.
SMALLEST_PARTITION = 20_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trade_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id)``: customers in credit, all suppliers and all parts."""
    customers = _table(spark, sf_dir, "customer").where("c_acctbal > 0")
    suppliers, parts = _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "part")
    return (
        customers.select(F.concat(F.lit("C"), "c_custkey").alias("id"))
        .union(suppliers.select(F.concat(F.lit("S"), "s_suppkey")))
        .union(parts.select(F.concat(F.lit("P"), "p_partkey")))
    )


def trade_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)``, one per line: a returned one links customer to supplier, an accepted
    one supplier to customer, any other customer to part. Pairs repeat, and some ends are
    no nodes. Parts have no outlinks."""
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    customer = F.concat(F.lit("C"), "o_custkey")
    supplier = F.concat(F.lit("S"), "l_suppkey")
    part = F.concat(F.lit("P"), "l_partkey")
    flag = F.col("l_returnflag")
    # Orders are the smaller side and spread evenly: a hash table of them saves both sorts.
    orders = orders.hint("shuffle_hash")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.when(flag == "A", supplier).otherwise(customer).alias("src"),
        F.when(flag == "A", customer).when(flag == "R", supplier).otherwise(part).alias("dst"),
    )


def trade_graph(spark: SparkSession, sf_dir: str, scratch: Scratch, numbers: bool = False) -> Graph:
    return clean_graph(trade_nodes(spark, sf_dir), trade_links(spark, sf_dir), scratch, numbers=numbers)


def trade_blocks(
    spark: SparkSession, sf_dir: str, scratch: Scratch, list_rows: int = HOT_ROWS
) -> DataFrame:
    """``(block)``: the trade graph as wiki pages, red links and noise links included.

    A page with very many links is rendered as several blocks with the same title,
    which ingest merges, so that no block grows with the data.
    """
    nodes = trade_nodes(spark, sf_dir)
    links, counted = scratch.save(
        trade_links(spark, sf_dir), "wiki_links", {"n": F.count(F.lit(1))}
    )
    parts = KeyParts(links, "src", counted["n"], scratch, list_rows)
    # Links move once, to their page's part; those of a source that is no page find none in the
    # join below. They are written out behind the sort: only targets move and are compared.
    dealt = parts.of_rows(links.where("src is not null"), "src", "dst")
    partitions = min(string_partitions(spark, counted["n"]), 2 + counted["n"] // SMALLEST_PARTITION)
    lists = (
        dealt.repartition(partitions, *parts.keys("src"))
        .groupBy(F.col("src").alias("id"), "part")
        .agg(F.sort_array(F.collect_list("dst")).alias("targets"))
    )
    noise = F.concat(
        F.lit("[[File:x.png|see [[S 1]] now]] [[S 1#h]] [[S 1/t]] [["),
        F.translate(_title(F.col("id")), " ", "_"),
        F.lit("]]"),
    )
    text = F.concat_ws(" ", F.transform("targets", _written_link), noise)
    # Nodes are the hash table, so that no list is sorted for the join.
    pages = parts.per_part(nodes, "id").hint("shuffle_hash").join(lists, ["id", "part"], "left")
    pages = pages.where("part = 0 or targets is not null").select(_block(_title(F.col("id")), text))
    talk = nodes.where(F.col("id").startswith("C")).select(
        _block(F.concat(_title(F.col("id")), F.lit("/talk")), F.lit("[[S 1]]"))
    )
    return pages.union(talk)


def write_dump(blocks: DataFrame, path: str, compression: str | None = None) -> None:
    options = {"compression": compression} if compression else {}
    with sorted_lists(blocks.sparkSession):
        blocks.select("block").write.options(**options).text(path)


def _title(node: Column) -> Column:
    """``C12`` is titled ``C 12``."""
    return F.concat(F.substring(node, 1, 1), F.lit(" "), F.substr(node, F.lit(2)))


def _written_link(target: Column) -> Column:
    odd = F.substr(target, F.lit(2)).cast("long") % 2 == 1
    label = F.when(odd, "").otherwise("|label")
    return F.concat(F.lit("[["), _title(target), label, F.lit("]]"))


def _block(title: Column, text: Column) -> Column:
    return F.concat(
        F.lit("<page>\n  <title>"),
        title,
        F.lit("</title>\n  <revision>\n    <text>"),
        text,
        F.lit("</text>\n  </revision>\n</page>"),
    ).alias("block")
