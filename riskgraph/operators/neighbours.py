"""Distinct (source, neighbour) pairs with the edge types that connect them.

All edge types of a pair travel as one bit mask: bit e for degree 1, bit ``8 * e1 + e2`` for
degree 2 (8 x 8 edge pairs fill a 64-bit integer). One row per pair then serves every single
edge scope and the all-edge scope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskgraph.functions import columns as C
from riskgraph.functions.joins import (LOOKUP_ROWS, block_join, heavy_keys, heavy_split,
                                       measured_lookup, salted_lookup)
from riskgraph.operators.paths import from_orders
from riskgraph.schemas import (BLACK_CONTRACT, CONTRACT_METRICS, EDGES, ENTITY_METRICS,
                               PRODUCT_METRICS)
from riskgraph.sources.staging import broadcast_below, by_batches, stage

N_EDGES = len(EDGES)
if N_EDGES != 8:
    raise ValueError("masks hold 8 edge types: pairs of types fill a 64-bit integer")
LIST_ROWS = 100                       # edges of a value up to which its orders travel as a list
# Sources whose links, of degree 1 and 2, are on disk at a time.
BATCH_SOURCES = {1: 1_500_000, 2: 200_000}
BLACKLIST_ROWS = 1_000_000            # entries up to which the blacklist is broadcast
ALL_BIT = -1                          # bit number of the all-edge scope
PAIR_KEYS = ["order_id_src", "cert_no_src", "apply_date_src", "order_id_dst", "apply_date_dst"]


def _indexed(edges: DataFrame) -> DataFrame:
    return edges.select("order_id", "apply_date", "cert_no", "entity_value",
                        C.edge_index(F.col("edge_type")).alias("edge"))


def _with_self(links: DataFrame) -> DataFrame:
    """Reduce links to distinct pairs and add each linked source to its own neighbourhood.

    The source row is emitted next to every link and folded away by the same grouping, so the
    traversal is evaluated once. Both sums are combined map-side.
    """
    both = F.array(
        F.struct("order_id_dst", "apply_date_dst"),
        F.struct(F.col("order_id_src").alias("order_id_dst"),
                 F.col("apply_date_src").alias("apply_date_dst")))
    return (links.select("order_id_src", "cert_no_src", "apply_date_src", "mask",
                         F.explode(both).alias("d"))
            .select("order_id_src", "cert_no_src", "apply_date_src", "d.*", "mask")
            .groupBy(*PAIR_KEYS).agg(F.bit_or("mask").alias("mask")))


def _degree1_links(edges: DataFrame, blocks: DataFrame, sources: DataFrame | None,
                   keep_far_type: bool) -> DataFrame:
    idx = _indexed(edges)
    src = from_orders(idx, sources).select(
        F.col("order_id").alias("order_id_src"), F.col("cert_no").alias("cert_no_src"),
        F.col("apply_date").alias("apply_date_src"), "entity_value", F.col("edge").alias("e1"))
    dst = idx.select(
        F.col("order_id").alias("order_id_dst"), F.col("apply_date").alias("apply_date_dst"),
        "entity_value", F.col("edge").alias("r1"))
    if not keep_far_type:
        # Made distinct where the join needs them; those of heavy values are dealt out by row.
        light, heavy = heavy_split(dst.drop("r1"), "entity_value", blocks)
        dst = light.repartition("entity_value").distinct(), heavy.distinct()
    links = block_join(src, dst, "entity_value", "apply_date_src", "apply_date_dst",
                       "order_id_src", "order_id_dst", blocks)
    return links.withColumn(
        "mask", F.expr(f"shiftleft(1L, {f'e1 * {N_EDGES} + r1' if keep_far_type else 'e1'})"))


def degree1_pairs(edges: DataFrame, blocks: DataFrame,
                  sources: DataFrame | None = None) -> DataFrame:
    return _with_self(_degree1_links(edges, blocks, sources, keep_far_type=False))


def busy_orders(edges: DataFrame, blocks: DataFrame, rows: int = LOOKUP_ROWS) -> DataFrame:
    """(order_id, copies): orders that more than ``rows`` sources may reach, as an entity of theirs
    has that many orders; copies spread their lookups. Broadcast only if few."""
    shared = blocks.select("entity_value", ((F.col("last_block") + 1) * F.col("block_rows"))
                           .alias("n")).where(F.col("n") > rows).distinct()
    found = edges.join(shared, "entity_value").groupBy("order_id").agg(
        F.ceil(F.max("n") / rows).cast("int").alias("copies"))
    return broadcast_below(stage(found, "busy-orders"), 1_000_000, "order_id")


def _degree2_hops(edges: DataFrame, blocks: DataFrame, sources: DataFrame | None,
                  busy: DataFrame | None) -> DataFrame:
    """(source, entity_value, mask, near_before): values two edges away, without the paths.

    1. (source, middle) with an 8 x 8 mask of (outgoing type, type at the middle);
    2. for each edge of the middle, the outgoing types that reach it over another edge of the
       middle; per (source, value) only the latest middle counts (``_latest``), because
       a far order is reachable exactly if it is earlier than that middle.
    """
    middle = (_degree1_links(edges, blocks, sources, keep_far_type=True)
              .groupBy("order_id_src", "cert_no_src", "apply_date_src",
                       F.col("order_id_dst").alias("order_id"))
              .agg(F.bit_or("mask").alias("hop")))
    # At most one edge per type: the edges of a middle order travel as one short list.
    out = _indexed(edges).groupBy("order_id").agg(
        F.max("apply_date").alias("apply_date_mid"),
        F.collect_list(F.struct("entity_value", F.col("edge").alias("e2"))).alias("out"))
    # For outgoing type e1 the middle is reached over some type other than e2.
    reach = " + ".join(
        f"if(shiftright(hop, {N_EDGES * e}) & 255 & ~shiftleft(1L, e2) != 0, "
        f"shiftleft(1L, {N_EDGES * e} + e2), 0L)" for e in range(N_EDGES))
    return (_per_order(middle, out, busy)
            .withColumn("o", F.explode("out")).drop("out").select("*", "o.*").drop("o")
            .withColumn("mask", F.expr(reach)).where(F.col("mask") != 0)
            .select("order_id_src", "cert_no_src", "apply_date_src", "entity_value", "mask",
                    F.col("apply_date_mid").alias("near_before")))


def _latest(hops: DataFrame) -> DataFrame:
    return hops.groupBy("order_id_src", "cert_no_src", "apply_date_src", "entity_value",
                        "mask").agg(F.max("near_before").alias("near_before"))


def degree2_pairs(edges: DataFrame, blocks: DataFrame, sources: DataFrame | None = None,
                  busy: DataFrame | None = None,
                  batch_sources: int = BATCH_SOURCES[2]) -> DataFrame:
    """Pairs two hops apart, without enumerating the paths: far orders of the values that the
    source's neighbours lead to, earlier than the latest of these and of another person. More than
    ``batch_sources`` sources are taken in batches."""
    common = common_values(edges)

    def pairs(some: DataFrame | None) -> DataFrame:
        links = neighbour_lists(edges, blocks, None, 2, [], [], some, busy, common=common)
        return links.groupBy(*PAIR_KEYS).agg(F.bit_or("mask").alias("mask")).select(
            *PAIR_KEYS, "mask")

    if sources is None:
        return pairs(None)
    return by_batches(sources, "order_id", batch_sources, "pairs", pairs)


def common_values(edges: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """Values with more than ``list_rows`` edges, and those that an order without a date has."""
    n, dated = F.count(F.lit(1)), F.count("apply_date")
    counted = edges.groupBy("entity_value").agg(n.alias("n"), dated.alias("dated"))
    return stage(counted.where((F.col("n") > list_rows) | (F.col("dated") < F.col("n")))
                 .select("entity_value"), "common-values")


def _packed(columns: list[str]) -> Column:
    """0/1 columns as bits of one number."""
    out = F.lit(0)
    for i, c in enumerate(columns):
        out = out + F.shiftleft(F.col(c), i)
    return out


def neighbour_lists(edges: DataFrame, blocks: DataFrame, prepared: DataFrame | None, degree: int,
                    columns: list[str], marks: list[str], sources: DataFrame | None = None,
                    busy: DataFrame | None = None, dated: bool = True,
                    list_rows: int = LIST_ROWS, common: DataFrame | None = None,
                    few_sources: bool = False) -> DataFrame:
    """Links of the sources with the attributes of their neighbours, dealt out by source.

    One row per link as ``with_attributes`` of the pairs has, and the source itself next to the
    links of each of its values; a pair may come several times, with some of its mask each time.
    ``columns`` and the 0/1 columns ``marks`` of ``prepared`` are kept, and the neighbour's date if
    ``dated``; without ``prepared`` no neighbour is dropped. Up to the source's task the neighbours
    of a value travel as one list. Those of values with more than ``list_rows`` edges come one by
    one, from the cells of a block join; ``common`` are those values, if they are known. With
    ``few_sources`` values that no source has are left out before the attributes come, at degree 1.
    """
    common = common or common_values(edges, list_rows)
    some = not common.isEmpty()

    def few(rows: DataFrame) -> DataFrame:
        return rows.join(common, "entity_value", "left_anti") if some else rows

    def many(rows: DataFrame) -> DataFrame:
        return rows.join(common, "entity_value", "left_semi")

    if degree == 1:
        hops = from_orders(_indexed(edges), sources).select(
            F.col("order_id").alias("order_id_src"), F.col("cert_no").alias("cert_no_src"),
            F.col("apply_date").alias("apply_date_src"), "entity_value",
            F.expr("shiftleft(1L, edge)").alias("mask"), F.col("apply_date").alias("near_before"))
        near_hops, other = few(hops), None
    else:
        hops = _degree2_hops(edges, blocks, sources, busy)
        # Of light values each (source, value) is where the join with the value's list needs it.
        near_hops = _latest(few(hops).repartition("entity_value"))
        other = "x.order_id_dst <> order_id_src and x.cert_no_dst <> cert_no_src"
    names = ["order_id_dst", *(["apply_date_dst"] if dated else []), "known", *columns, "marks"]
    kept = [F.lit(True).alias("known"), *columns, _packed(marks).alias("marks")]
    reached = edges
    if degree == 1 and few_sources:
        reached = edges.join(hops.select("entity_value"), "entity_value", "left_semi")
    orders = reached.groupBy("order_id").agg(F.collect_set(F.struct(
        "entity_value", F.col("apply_date").alias("apply_date_dst"),
        F.col("cert_no").alias("cert_no_dst"))).alias("links"))
    if prepared is None:
        attributed = orders.withColumn("own", F.struct(*kept))
    else:
        attributed = orders.join(prepared.select("order_id", F.struct(*kept).alias("own")),
                                 "order_id", "left")
    far = (attributed.select("order_id", "own", F.explode("links").alias("l"))
           .select("l.entity_value", F.struct(
               F.col("order_id").alias("order_id_dst"), "l.apply_date_dst", "l.cert_no_dst", "own.*")
               .alias("x")))
    lists = (few(far).repartition("entity_value").groupBy("entity_value")
             .agg(F.collect_list("x").alias("far")))
    near = f"x.apply_date_dst < near_before{' and ' + other if other else ''}"
    kept_of_far = "named_struct(" + ", ".join(f"'{n}', x.{n}" for n in names) + ")"
    keys = ["order_id_src", "cert_no_src", "apply_date_src", "mask"]
    links = (near_hops.join(lists, "entity_value")
             .select(*keys, F.expr(f"transform(filter(far, x -> {near}), x -> {kept_of_far})")
                     .alias("far")).where(F.size("far") > 0))
    if some:
        far_hops = many(hops) if degree == 1 else _latest(many(hops))
        single = many(far).select("entity_value", "x", "x.order_id_dst", "x.apply_date_dst")
        links = links.unionByName(block_join(
            far_hops, single, "entity_value", "near_before", "apply_date_dst", "order_id_src",
            "order_id_dst", blocks, residual=F.expr(other) if other else None)
            .select(*keys, F.array(F.expr(kept_of_far)).alias("far")))
    itself = {"order_id_dst": "order_id_src", "apply_date_dst": "apply_date_src"}
    if prepared is None:
        rows = links.repartition("order_id_src").withColumn("own", F.struct(*kept))
    else:
        own = prepared.select(F.col("order_id").alias("order_id_src"), F.struct(*kept).alias("own"))
        rows = links.repartition("order_id_src").join(own.hint("shuffle_hash"), "order_id_src", "left")
    itself = F.struct(*[F.col(itself.get(n, f"own.{n}")).alias(n) for n in names])
    found = (rows.select(*keys, F.explode(F.concat("far", F.array(itself))).alias("x"))
             .where("x.known").select(*keys, "x.*"))
    date = F.col("apply_date_dst") if dated else F.lit(None).cast("timestamp")
    return found.select(*keys, "order_id_dst", date.alias("apply_date_dst"), *columns, *[
        F.shiftright("marks", i).bitwiseAND(1).alias(c) for i, c in enumerate(marks)])


def _per_order(facts: DataFrame, unique: DataFrame, busy: DataFrame | None) -> DataFrame:
    """Look up ``unique`` by order for rows of (source, order)."""
    if busy is None:
        return salted_lookup(facts, unique, ["order_id"], F.col("order_id_src"), salts=4)
    return measured_lookup(facts, unique, ["order_id"], F.col("order_id_src"), busy)


def with_set_bits(rows: DataFrame, mask: str, degree: int, also_all: bool = False) -> DataFrame:
    """``rows`` with ``bit``: one row per bit that is set in ``mask``, with ``also_all`` one more, -1.

    A mask is opened by bytes, each of which is looked up in the fixed lists of the bits of a byte, so
    that no bit is tried and all stays in generated code.
    """
    bits = ", ".join("array({})".format(", ".join(str(b) for b in range(N_EDGES) if n >> b & 1) or
                                        "cast(null as int)") for n in range(1 << N_EDGES))
    first = ([-1] if also_all else []) + list(range(1 if degree == 1 else N_EDGES))
    byte = f"if(__byte < 0, 1, cast(shiftright({mask}, {N_EDGES} * greatest(__byte, 0)) & 255 as int))"
    opened = (rows.withColumn("__byte", F.explode(F.array(*map(F.lit, first))))
              .withColumn("__bits", F.expr(byte)).where("__bits <> 0"))
    return (opened.withColumn("__bit", F.explode(F.expr(f"array({bits})[__bits]")))
            .withColumn("bit", F.expr(f"if(__byte < 0, -1, {N_EDGES} * __byte + __bit)"))
            .drop("__byte", "__bits", "__bit"))


def bits_of(mask: str, degree: int, also_all: bool = False) -> Column:
    """Generator: one row per edge type (or pair) set in ``mask``, with ``also_all`` one more.

    A fixed list is exploded and filtered by the caller with ``has_bit``, which keeps both in
    generated code.
    """
    bits = N_EDGES if degree == 1 else N_EDGES * N_EDGES
    return F.explode(F.array(*[F.lit(b) for b in range(-1 if also_all else 0, bits)]))


def has_bit(mask: str, bit: str = "bit") -> Column:
    """1 if ``bit`` is set in ``mask``; the all-edge bit is set in every mask but 0."""
    return F.expr(f"if({bit} < 0, if({mask} <> 0, 1L, 0L), "
                  f"shiftright({mask}, greatest({bit}, 0)) & 1L)")


def edge_columns(bit, degree: int) -> list:
    """Edge type columns of a bit number."""
    if degree == 1:
        return [C.edge_name(bit).alias("edge1")]
    return [C.edge_name(F.floor(bit / N_EDGES).cast("int")).alias("edge1"),
            C.edge_name(F.pmod(bit, F.lit(N_EDGES)).cast("int")).alias("edge2")]


def pairs_by_edge(pairs: DataFrame, degree: int = 1) -> DataFrame:
    """One row per pair and edge type (or pair of edge types)."""
    opened = pairs.withColumn("bit", bits_of("mask", degree)).where(has_bit("mask") == 1)
    return opened.select("order_id_src", *edge_columns(F.col("bit"), degree), "apply_date_src",
                         "cert_no_src", "order_id_dst", "apply_date_dst")


def blacklisted_orders(attributes: DataFrame, blacklist: DataFrame) -> DataFrame:
    """(order_id, <metric>_black ...): 0/1 per attribute kind, computed once per order.

    Only orders with a hit are returned. The blacklist is reduced to distinct entries first; a small
    one is broadcast, else entries shared by very many orders are counted and spread.
    """
    kinds = [(m.black_type, m.column) for m in ENTITY_METRICS if m.black_type]
    kinds.append((BLACK_CONTRACT, "order_id"))
    values = F.array(*[
        F.struct(F.lit(k).alias("type"), F.col(col).alias("content")) for k, col in kinds])
    probe = (attributes.select("order_id", F.explode(values).alias("v"))
             .select("order_id", "v.type", "v.content"))
    entries = stage(blacklist.select("type", "content").distinct(), "blacklist")
    small = broadcast_below(entries, BLACKLIST_ROWS, "content")
    on = ["type", "content"]
    if small is entries:
        listed = probe.join(entries, on, "left_semi")
        hits = measured_lookup(probe, entries, on, F.col("order_id"), broadcast_below(
            heavy_keys(listed, on), 1_000_000))
    else:
        hits = probe.join(small, on)
    return hits.groupBy("order_id").agg(
        *[F.max(C.flag(F.col("type") == k)).alias(k) for k, _ in kinds])


def prepare_attributes(attributes: DataFrame, blacklist: DataFrame | None = None) -> DataFrame:
    """Neighbour attributes with digits-only phone, flags and blacklist marks, one row per order."""
    kinds = [m.black_type for m in ENTITY_METRICS if m.black_type] + [BLACK_CONTRACT]
    base = attributes.withColumn("comp_phone", C.digits_only(F.col("comp_phone")))
    out = base.select("order_id", *[m.column for m in ENTITY_METRICS],
                      *[f.alias(n) for n, f in C.neighbour_flags().items()])
    if blacklist is None:
        return out.select("*", *[F.lit(0).alias(k) for k in kinds])
    marks = blacklisted_orders(base, blacklist)
    return out.join(marks, "order_id", "left").na.fill(0, kinds)


def with_attributes(pairs: DataFrame, prepared: DataFrame,
                    busy: DataFrame | None = None) -> DataFrame:
    """Attach the neighbour's attributes; pairs whose neighbour has none are dropped.

    Attributes are unique per order; an order that very many sources reach is looked up by
    several tasks: those that ``busy`` names, or all of them four times.
    """
    found = _per_order(pairs.withColumnRenamed("order_id_dst", "order_id"), prepared, busy)
    return found.withColumnRenamed("order_id", "order_id_dst")


FLAG_METRICS = CONTRACT_METRICS + PRODUCT_METRICS
