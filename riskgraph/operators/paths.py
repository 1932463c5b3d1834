"""One-hop and two-hop paths between an order and strictly earlier orders.

``blocks`` is the table of heavy entities from ``graph.load``; see ``block_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskgraph.functions.joins import block_join, copied_rows, spread_facts
from riskgraph.schemas import NODE_PROPERTIES
from riskgraph.sources.staging import stage

SRC = ["order_id_src"] + [f"{p}_src" for p in NODE_PROPERTIES]
HOP1 = ["edg_type_src1", "contact_value1", "edg_type_dst1"]
DST1 = ["order_id_dst1"] + [f"{p}_dst1" for p in NODE_PROPERTIES]
HOP2 = ["edg_type_src2", "contact_value2", "edg_type_dst2"]
DST2 = ["order_id_dst2"] + [f"{p}_dst2" for p in NODE_PROPERTIES]
DEGREE1_COLUMNS = SRC + HOP1 + DST1
DEGREE2_COLUMNS = DEGREE1_COLUMNS + HOP2 + DST2


def from_orders(edges: DataFrame, sources: DataFrame | None) -> DataFrame:
    """Keep the edges of the source orders. Applied before any traversal."""
    if sources is None:
        return edges
    return edges.join(sources.select("order_id").distinct(), "order_id", "left_semi")


def _end(edges: DataFrame, end: str, edge_col: str, value_col: str,
         day_text: bool = False) -> DataFrame:
    """Edges renamed as one end of a path.

    With ``day_text`` the end shows its date as text, made here, once for an edge and not for each
    path, and has its time as ``at_<end>``.
    """
    shown, at = {p: F.col(p) for p in NODE_PROPERTIES}, []
    if day_text:
        shown["apply_date"] = F.date_format("apply_date", "yyyy-MM-dd")
        at = [F.col("apply_date").alias(f"at_{end}")]
    return edges.select(
        F.col("order_id").alias(f"order_id_{end}"),
        *[c.alias(f"{p}_{end}") for p, c in shown.items()],
        F.col("edge_type").alias(edge_col), F.col("entity_value").alias(value_col), *at)


def degree1(edges: DataFrame, blocks: DataFrame, sources: DataFrame | None = None,
            store: tuple[DataFrame, DataFrame] | None = None, day_text: bool = False,
            near: DataFrame | None = None) -> DataFrame:
    """Distinct paths order - value - earlier order (21 columns).

    ``near`` are the edges of the sources where they are at hand (``Graph.edges_of``).
    With ``store`` (from ``graph.store_edges``) the orders at the far end come from the stored edges:
    only the sources' edges are shuffled. ``day_text`` gives dates as ISO text.
    """
    near = from_orders(edges, sources) if near is None else near
    src = _end(near, "src", "edg_type_src1", "contact_value1", day_text)
    ends = [_end(part, "dst1", "edg_type_dst1", "contact_value1", day_text)
            for part in store or (edges,)]
    dst = tuple(ends) if store else ends[0]
    at = "at" if day_text else "apply_date"
    paths = block_join(src, dst, "contact_value1", f"{at}_src", f"{at}_dst1",
                       "order_id_src", "order_id_dst1", blocks)
    # Edges are unique per (order, type), so the paths are distinct as they come.
    return paths.select(*DEGREE1_COLUMNS)


def degree1_unordered(edges: DataFrame, blocks: DataFrame,
                      sources: DataFrame | None = None) -> DataFrame:
    """Five-column export without the date rule.

    A path may not use one relationship twice, so an order meets itself only through two
    different edge types.
    """
    src = from_orders(edges, sources).select(
        F.col("order_id").alias("order_id_src"), F.col("edge_type").alias("edg_type_src1"),
        F.col("entity_value").alias("contact_value1"), F.col("apply_date").alias("at_src"))
    dst = edges.select(
        F.col("order_id").alias("order_id_dst1"), F.col("edge_type").alias("edg_type_dst1"),
        F.col("entity_value").alias("contact_value1"), F.col("apply_date").alias("at_dst1"))
    same = ((F.col("order_id_src") == F.col("order_id_dst1"))
            & (F.col("edg_type_src1") == F.col("edg_type_dst1")))
    return (block_join(src, dst, "contact_value1", "at_src", "at_dst1", "order_id_src",
                       "order_id_dst1", blocks, earlier=False, residual=~same)
            .select("order_id_src", *HOP1, "order_id_dst1"))


def degree2(edges: DataFrame, blocks: DataFrame, sources: DataFrame | None = None,
            busy: DataFrame | None = None, day_text: bool = False,
            near: DataFrame | None = None, reach: DataFrame | None = None) -> DataFrame:
    """Distinct paths order - value - earlier order - value - still earlier order (33 columns).

    Many first hops end in one middle order, so the second hop is found once for each middle order
    that they reach, and the hops are joined by it: no first hop travels once for each value of its
    middle order. A middle order that very many first hops share (``busy``, from ``busy_orders``) is
    joined by several tasks. ``day_text`` gives dates as ISO text, ``near`` is as in ``degree1``,
    and ``reach`` are the edges before the latest source where they are at hand (``Graph.before``).
    """
    def shown(hops: DataFrame, *dates: str) -> DataFrame:
        return hops.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates} if day_text else {})

    near = from_orders(edges, sources) if near is None else near
    reach = edges if reach is None else reach
    first = stage(shown(
        degree1(reach, blocks, near=near).withColumn("at_dst1", F.col("apply_date_dst1")),
        "apply_date_src", "apply_date_dst1"), "first-hops")
    middle = edges.select(
        F.col("order_id").alias("order_id_dst1"), F.col("edge_type").alias("edg_type_src2"),
        F.col("entity_value").alias("contact_value2")).join(
            first.select("order_id_dst1", "at_dst1").distinct(), "order_id_dst1")
    far = _end(reach, "dst2", "edg_type_dst2", "contact_value2")
    second = shown(block_join(middle, far, "contact_value2", "at_dst1", "apply_date_dst2",
                              "order_id_dst1", "order_id_dst2", blocks), "apply_date_dst2")
    reused = ((F.col("edg_type_dst1") == F.col("edg_type_src2"))
              & (F.col("contact_value1") == F.col("contact_value2")))
    other = ((F.col("order_id_src") != F.col("order_id_dst2"))
             & (F.col("cert_no_src") != F.col("cert_no_dst2")))
    if busy is not None:
        busy = busy.withColumnRenamed("order_id", "order_id_dst1")
        first = spread_facts(first, busy, F.col("order_id_src"))
        second = copied_rows(second, busy)
    on = ["order_id_dst1", "at_dst1"] + (["__salt"] if busy is not None else [])
    return first.join(second, on).where(~reused & other).select(*DEGREE2_COLUMNS)
