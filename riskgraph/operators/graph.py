"""Applications and persons as graph nodes and edges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from riskgraph.functions import columns as C
from riskgraph.functions.joins import BLOCK_ROWS, counted_lookup, day_blocks, heavy_split
from riskgraph.schemas import (APPLY_NODE_FIELDS, EDGES, MISSING,
                               NODE_PROPERTIES, PERSON_EDGES)
from riskgraph.sources.staging import stage
from riskgraph.sources.writers import bucketed_table

# Edges of a bucket of the stored edges, and buckets that Spark allows in a table by default.
BUCKET_ROWS, MOST_BUCKETS = 500_000, 100_000


def clean_applications(raw: DataFrame, order_by: tuple = ("source_file", "source_pos")) -> DataFrame:
    """Clean ids, drop empty ones, keep the first row read of each order id.

    ``min`` over a struct is combined map-side, so an order id repeated millions of times
    does not gather in one task.
    """
    ids = raw.withColumn("order_id", C.clean_order_id(F.col("order_id"))).where(
        F.col("order_id") != "")
    rest = [c for c in ids.columns if c != "order_id" and c not in order_by]
    first = F.min(F.struct(*order_by, *rest)).alias("row")
    return (ids.groupBy("order_id").agg(first)
            .select("order_id", *[F.col(f"row.{c}").alias(c) for c in rest]))


def apply_nodes(applications: DataFrame) -> DataFrame:
    return applications.select(*APPLY_NODE_FIELDS)


def to_edges(applications: DataFrame, keep: tuple = NODE_PROPERTIES,
             strict_idcard: bool = True) -> DataFrame:
    """One row per (order, entity value): edge_type, entity_value, label and ``keep`` columns."""
    items = [F.struct(F.lit(e.name).alias("edge_type"),
                      C.edge_value(e, F.col(e.column), strict_idcard).alias("entity_value"),
                      F.lit(e.label).alias("label"))
             for e in EDGES]
    rows = applications.select("order_id", *keep, F.explode(F.array(*items)).alias("edge"))
    return (rows.select("order_id", *keep, "edge.*")
            .where(F.col("entity_value").isNotNull()))


@dataclass(frozen=True)
class Graph:
    applications: DataFrame
    edges: DataFrame
    blocks: DataFrame                    # time blocks of heavy entities
    strict_idcard: bool = True

    def edges_of(self, orders: DataFrame) -> DataFrame:
        """Edges of some orders, which are looked up among the applications: there are several
        edges to an application, and a long list of orders is joined by shuffling."""
        wanted = orders.select("order_id").distinct()
        return to_edges(self.applications.join(wanted, "order_id", "left_semi"),
                        strict_idcard=self.strict_idcard)

    def before(self, orders: DataFrame) -> DataFrame:
        """Edges of the orders before the latest of ``orders``; no other is earlier than one of them."""
        found = self.applications.join(orders.select("order_id").distinct(), "order_id", "left_semi")
        latest = found.agg(F.max(F.unix_micros("apply_date"))).first()[0]
        return self.edges.where(F.unix_micros("apply_date") < F.lit(latest).cast("long"))


def load(applications: DataFrame, strict_idcard: bool = True,
         block_rows: int = BLOCK_ROWS, stage_edges: bool = True,
         by_order: bool = False) -> Graph:
    """Load the graph: stage applications and edges once and look for heavy entities.

    Without ``stage_edges`` the edges are unfolded from the staged applications where they are read,
    which is less than writing them for the few reads of a path export. With ``by_order``
    the applications are bucketed by order, so that those of some orders are found without a shuffle;
    reading all of them takes more, shorter tasks. Applications are dealt out by order first, so that few large input files, or one, do not bound
    the tasks that the far larger edge table is made and read by.
    """
    if by_order:
        tasks = int(applications.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        nodes = bucketed_table(applications, "order_id", tasks, "applications")
    else:
        nodes = stage(applications.repartition("order_id"), "applications")
    edges = to_edges(nodes, strict_idcard=strict_idcard)
    if stage_edges:
        edges = stage(edges, "edges")
    blocks = stage(day_blocks(edges, "entity_value", "apply_date", block_rows), "blocks")
    return Graph(nodes, edges, blocks, strict_idcard)


def store_edges(graph: Graph, buckets: int | None = None,
                bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """(light, heavy): the edges stored by value, so that an export shuffles its sources only.

    Edges of light entities are bucketed and sorted by value; those of heavy entities, which would
    make a bucket large, are kept apart as plain files. ``buckets`` are by default as many as keep a
    bucket at ``bucket_rows`` edges, so that a task sorts it in memory however many edges there are,
    and at least the session's shuffle partitions, as Spark takes fewer for too little parallelism.
    """
    light, heavy = heavy_split(graph.edges, "entity_value", graph.blocks)
    if not buckets:
        least = int(light.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(max(least, -(-graph.edges.count() // bucket_rows)), MOST_BUCKETS)
    return (bucketed_table(light, "entity_value", buckets, "edges-by-value"),
            stage(heavy, "edges-of-heavy-values"))


def entity_nodes(edges: DataFrame) -> DataFrame:
    """Distinct entity values with a label and the number of distinct orders."""
    per_order = edges.groupBy("entity_value", "order_id").agg(F.min("label").alias("label"))
    return per_order.groupBy("entity_value").agg(
        F.min("label").alias("label"), F.count(F.lit(1)).alias("degree"))


def first_persons(persons: DataFrame, order_by: tuple = ("source_file", "source_pos"),
                  ) -> DataFrame:
    """Persons with an id, the first row read of each; ``order_by`` columns that are missing are
    passed over, and rows that are then still equal in order are taken by their content."""
    order = [c for c in order_by if c in persons.columns]
    rest = [c for c in persons.columns if c not in order and c != "cert_no"]
    first = F.min(F.struct(*order, *rest)).alias("row")
    return (persons.where(F.coalesce("cert_no", F.lit("")) != "").groupBy("cert_no").agg(first)
            .select("cert_no", *[F.col(f"row.{c}").alias(c) for c in rest]))


def unpack_person_sets(persons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Packed ``value@@time##value@@time`` sets to (items, rejects).

    items: cert_no, apply_date, edge_type, entity_value, label, entity_at;
    rejects: cert_no, edge_type, item (an item without a time).
    A set cell equal to a missing marker has no items. Of a person on several lines the first
    line read counts.
    """
    cells = [F.struct(F.lit(e.name).alias("edge_type"), F.lit(e.label).alias("label"),
                      F.when(C.present(F.col(e.column), e.missing), F.col(e.column)).alias("cell"))
             for e in PERSON_EDGES]
    items = (first_persons(persons)
             .select("cert_no", "apply_date", F.explode(F.array(*cells)).alias("c"))
             .select("cert_no", "apply_date", "c.edge_type", "c.label",
                     F.explode(F.split("c.cell", "##")).alias("item")))
    parts = items.withColumn("part", F.split("item", "@@"))
    has_time = (F.size("part") >= 2) & (F.col("part")[1] != "")
    value = F.when(F.col("edge_type") == "COMPANYPHONE",
                   C.graph_phone(F.col("part")[0])).otherwise(F.col("part")[0])
    good = (parts.where(has_time)
            .select("cert_no", "apply_date", "edge_type", value.alias("entity_value"), "label",
                    F.col("part")[1].alias("entity_at"))
            .where(C.present(F.col("entity_value"), MISSING)))
    rejects = parts.where(~has_time).select("cert_no", "edge_type", "item")
    return good, rejects


def person_edges(items: DataFrame) -> DataFrame:
    """Distinct person-entity edges; an entity carries the earliest time seen anywhere."""
    keys = ["cert_no", "apply_date", "edge_type", "entity_value", "label"]
    # The sets are unpacked once: links with their own earliest time hold all that is asked.
    links = stage(items.groupBy(*keys).agg(F.min("entity_at").alias("own_at")), "person-links")
    dated = links.groupBy("entity_value").agg(F.min("own_at").alias("entity_at"))
    return counted_lookup(links.select(*keys), dated, ["entity_value"], F.col("cert_no"))


def person_sample(good: DataFrame, black: DataFrame) -> DataFrame:
    return good.select("cert_no").unionByName(black.select("cert_no")).distinct()


def person_entities(sample: DataFrame, edges: DataFrame) -> DataFrame:
    """Every entity of the sampled persons with both dates."""
    return (edges.join(sample, "cert_no", "left_semi")
            .select(F.col("cert_no").alias("cert_no_src"), F.col("apply_date").alias("apply_date_src"),
                    F.col("edge_type").alias("edge_src"),
                    F.col("entity_value").alias("content_key_mid"),
                    F.col("entity_at").alias("apply_date_mid"))
            .distinct())
