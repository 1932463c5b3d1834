"""Neighbourhood features of single edge types, without (source, neighbour) pairs.

Along one edge type the neighbourhood of an order follows from the value it shares and its own
date: every order of the value with an earlier date, and the order itself. So a metric is a running
total over dated events of the value, read off at the date of the source:

* a sum over neighbours has an event per order;
* a number of distinct values has one where a value is first seen;
* within n days a value counts from where it comes into sight until n days have passed without it.

What only the source's own person brings is told by events of (value, person), which are taken off
where other persons alone count. The order's own values are added if they are not in sight yet.

Of a value with few orders, as nearly all have, no event is made: its orders travel once, as one short
list, and every counter of a source is read off that list. Lists are bounded by ``LIST_ROWS``.

Work and tables grow with the edges, however many orders share a value. Totals of heavy values run
within spans of time, and each span starts from the total of the spans before it. Of the values of
an attribute only the first sight of each day matters, so that a heavy value has few of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskgraph.functions import columns as C
from riskgraph.functions.joins import LOOKUP_ROWS, measured_lookup
from riskgraph.operators.neighbours import FLAG_METRICS, LIST_ROWS, common_values
from riskgraph.operators.paths import from_orders
from riskgraph.schemas import (BLACK_CONTRACT, CONTRACT_METRICS, ENTITY_METRICS, EXCEPT_SELF,
                               EXCLUDE_METRICS, INCLUDE_METRICS, ORDER_METRIC, PRODUCT_METRICS,
                               SLICE_DAYS)
from riskgraph.sources.staging import broadcast_below, by_batches

ORDER = len(ENTITY_METRICS)           # attribute number of the neighbour order itself
WINDOWS = (None,) + SLICE_DAYS        # None = no time limit; bits of an event say which
SCOPES = ("inc", "exc")               # with the source's own person, and without
BLACK_BIT, FLAG_BIT = len(WINDOWS), len(WINDOWS) + 1
LINK = 2 * (ORDER + 1)                # lane of "has a neighbour at all"
ALL_PERSONS = ""
# Bits of a source's own row: it has attributes, it counts as another person, its person is known.
KNOWN, OTHER, PERSON = 1, 2, 4
DAY_MICROS = 86_400_000_000
BATCH_EDGES = 60_000_000              # edges whose values are on disk with their orders at a time
KEYS = ["entity_value", "attr", "value"]
EVENT = ["entity_value", "who", "at", "lane", "bits", "w"]


def lane(scope: str, attr: int) -> int:
    return SCOPES.index(scope) * (ORDER + 1) + attr


def _definitions() -> dict[str, tuple]:
    """metric -> (kind, lane, bit, window bit of the rows that make it exist)."""
    out = {}
    for scope, end in zip(SCOPES, ("", EXCEPT_SELF)):
        order = lane(scope, ORDER)
        out[ORDER_METRIC + end] = "order", order, 0, 0
        for i, name in enumerate(FLAG_METRICS):
            kind = "contract" if name in CONTRACT_METRICS else "product"
            out[name + end] = kind, order, FLAG_BIT + i, 0
        for attr, m in enumerate(ENTITY_METRICS):
            for bit, days in enumerate(WINDOWS):
                out[f"{m.name}{days or ''}{end}"] = "values", lane(scope, attr), bit, bit
            if m.black_type:
                out[f"{m.black_type}_cnt{end}"] = "black", lane(scope, attr), BLACK_BIT, 0
        out[f"{BLACK_CONTRACT}_cnt{end}"] = "black_order", order, BLACK_BIT, 0
    return out


DEFINITIONS = _definitions()


class _Wanted:
    """What the wanted metrics need: counters (lane, bit), scopes, windows and attributes."""

    def __init__(self, metrics: tuple) -> None:
        self.counters = {(LINK, 0)}
        for m in metrics:
            kind, own, bit, rows = DEFINITIONS[m]
            self.counters.add((own, bit))
            if kind not in ("black", "black_order"):
                self.counters.add((lane(SCOPES[own > ORDER], ORDER), rows))
        self.counters = sorted(self.counters)
        lanes = {own for own, _ in self.counters} - {LINK}
        self.scopes = [s for s in SCOPES if any(own // (ORDER + 1) == SCOPES.index(s)
                                                for own in lanes)]
        self.windows = [b for b in range(1, len(WINDOWS)) if any(
            bit == b and own != LINK for own, bit in self.counters)]

    def attributes(self, sliced: bool) -> list[int]:
        """Attributes counted within windows, or without a time limit."""
        return sorted({own % (ORDER + 1) for own, bit in self.counters
                       if own != LINK and own % (ORDER + 1) != ORDER
                       and (bit in range(1, len(WINDOWS))) == sliced})

    def unlimited_orders(self) -> bool:
        return any(own != LINK and own % (ORDER + 1) == ORDER and bit not in self.windows
                   for own, bit in self.counters)


def _name(counter: tuple[int, int]) -> str:
    return f"c{counter[0]}_{counter[1]}"


def _holds(counter: tuple[int, int], weight: Column) -> Column:
    own, bit = counter
    hit = (F.col("lane") == own) & (F.col("bits").bitwiseAND(1 << bit) != 0)
    return F.when(hit, weight).otherwise(F.lit(0))


def _event(who: Column, at: Column, own: int, bits, w: int, when: Column | None = None) -> Column:
    event = F.struct(who.alias("who"), at.alias("at"), F.lit(own).alias("lane"),
                     (F.lit(bits) if isinstance(bits, int) else bits).cast("int").alias("bits"),
                     F.lit(w).alias("w"))
    return event if when is None else F.when(when, event)


def _opened(rows: DataFrame, events: list[Column]) -> DataFrame:
    return (rows.select("entity_value", F.explode(F.array(*events)).alias("e"))
            .where(F.col("e").isNotNull()).select("entity_value", "e.*"))


def _expiry(day: Column, days: int) -> Column:
    """Last moment of the day ``days`` after ``day``: events count for sources later than it."""
    return (F.date_add(day, days + 1).cast("timestamp")
            - F.expr("INTERVAL '0.000001' SECOND"))


def _of(person: Column) -> Column:
    return F.concat(F.lit("="), person)


def _black(m) -> Column:
    return F.col(m.black_type) if m.black_type else F.lit(0)


def _order_bits(base: int) -> Column:
    """``base``, the blacklist mark of the order and its flags as bits."""
    bits = F.lit(base) + F.shiftleft(F.col(BLACK_CONTRACT), BLACK_BIT)
    for i, name in enumerate(FLAG_METRICS):
        bits = bits + F.shiftleft(F.col(name), FLAG_BIT + i)
    return bits


def dated_orders(edges: DataFrame, prepared: DataFrame) -> DataFrame:
    """One row per value and order with attributes: entity_value, at, person, ``prepared``."""
    values = edges.groupBy("order_id").agg(
        F.max("apply_date").alias("at"), F.collect_set("entity_value").alias("values"))
    return (values.join(prepared, "order_id").withColumn("person", F.col("cert_no"))
            .withColumn("entity_value", F.explode("values")).drop("values"))


def _near(edges: DataFrame, sources: DataFrame, heavy: DataFrame) -> DataFrame:
    """Edges that some source of their value may see within the longest window, and a few more.

    Time is cut into stretches longer than any window, so a source sees its own and the one
    before.
    """
    stretch = max(SLICE_DAYS) + 1

    def number(at: str) -> Column:
        return F.floor(F.unix_date(F.to_date(at)) / stretch).cast("int")

    wanted = sources.select("entity_value", F.explode(F.array(
        number("at"), number("at") - 1)).alias("stretch")).distinct()
    return measured_lookup(edges.withColumn("stretch", number("apply_date")), wanted,
                           ["entity_value", "stretch"], F.col("order_id"), heavy).drop("stretch")


def _order_events(orders: DataFrame, scopes: list[str], windows: list[int],
                  unlimited: bool) -> DataFrame:
    """An event where an order is seen, and one for each window that it leaves."""
    day, out = F.to_date("at"), []
    seen = sum(1 << b for b in windows) + (1 if unlimited else 0)
    bits = _order_bits(seen) if unlimited else F.lit(seen)

    def add(scope: str, who: Column, w: int, when: Column | None) -> None:
        own = lane(scope, ORDER)
        out.append(_event(who, F.col("at"), own, bits, w, when))
        out.extend(_event(who, _expiry(day, WINDOWS[b]), own, 1 << b, -w, when) for b in windows)

    if "inc" in scopes:
        add("inc", F.lit(ALL_PERSONS), 1, None)
    if "exc" in scopes:
        known = F.col("person").isNotNull()
        add("exc", F.lit(ALL_PERSONS), 1, known)
        add("exc", _of(F.col("person")), -1, known)
    return _opened(orders, out)


def _sights(orders: DataFrame, attributes: list[int], by_day: bool, persons: bool) -> DataFrame:
    """(entity_value, attr, value[, day], black, f0[, f1, c1, f2]): first sight of each value.

    ``f0`` is the first of all, ``f1`` the first by a known person, ``c1``, and ``f2`` the first by
    any other known person. Firsts of persons are combined map-side, and so are the two that stay.
    """
    items = [F.struct(F.lit(a).alias("attr"), F.col(ENTITY_METRICS[a].column).alias("value"),
                      _black(ENTITY_METRICS[a]).alias("black")) for a in attributes]
    rows = (orders.select("entity_value", "at", "person", F.explode(F.array(*items)).alias("i"))
            .select("entity_value", "at", "person", "i.*").where(F.col("value").isNotNull()))
    keys = KEYS + ["day"] if by_day else KEYS
    if by_day:
        rows = rows.withColumn("day", F.to_date("at"))
    black = F.max("black").alias("black")
    if not persons:
        return rows.groupBy(*keys).agg(F.min("at").alias("f0"), black)
    first = rows.groupBy(*keys, "person").agg(F.min("at").alias("at"), black).withColumn(
        "unknown", F.col("person").isNull())
    place = F.row_number().over(Window.partitionBy(*keys, "unknown").orderBy("at", "person"))
    two = first.withColumn("place", place).where(F.col("place") <= 2)
    named = F.when(~F.col("unknown"), F.struct("at", "person"))
    return (two.groupBy(*keys).agg(
        F.min("at").alias("f0"), black, F.min(named).alias("one"),
        F.min(F.when(~F.col("unknown") & (F.col("place") == 2), F.col("at"))).alias("f2"))
        .select(*keys, "f0", "black", F.col("one.at").alias("f1"),
                F.col("one.person").alias("c1"), "f2"))


def _with_neighbour_days(sights: DataFrame, persons: bool) -> DataFrame:
    """Days of sight with the days before and after them, of a value at all and by a known person.

    ``other`` is the last day before on which somebody else than ``c1`` brought the value.
    """
    spec = Window.partitionBy(*KEYS).orderBy("day")
    out = sights.withColumns({"day_before": F.lag("day").over(spec),
                              "day_after": F.lead("day").over(spec)})
    if not persons:
        return out
    before = spec.rowsBetween(Window.unboundedPreceding, -1)
    upto = spec.rowsBetween(Window.unboundedPreceding, 0)
    known = F.col("f1").isNotNull()
    following = F.expr("lead(f1) ignore nulls over (partition by entity_value, attr, value "
                       "order by day)")
    out = out.withColumns({
        "last": F.last(F.when(known, F.struct("day", "c1", "f2")), True).over(before),
        "next": following})
    changed = known & ((F.col("last.c1") != F.col("c1")) | F.col("last.f2").isNotNull())
    out = out.withColumn("other", F.last(F.when(changed, F.col("last.day")), True).over(upto))
    return out.withColumn("last_other", F.last(F.when(known, F.struct("other")), True).over(
        before)["other"])


def _fresh(day: Column, before: Column, windows: list[int]) -> Column:
    """Bits of the windows that ``before`` has left by ``day``."""
    return reduce(Column.__add__, [
        F.when(before.isNull() | (F.datediff(day, before) > WINDOWS[b]), 1 << b).otherwise(0)
        for b in windows])


def _value_events(sights: DataFrame, attributes: list[int], scopes: list[str],
                  windows: list[int]) -> DataFrame:
    """Events of the first sights of values; with ``windows`` of days of sight."""
    def where(scope: str) -> Column:
        return F.col("attr") + lane(scope, 0)

    def event(scope, who, at, bits, w, when=None) -> Column:
        made = F.struct(who.alias("who"), at.alias("at"), where(scope).alias("lane"),
                        (F.lit(bits) if isinstance(bits, int) else bits).cast("int").alias("bits"),
                        F.lit(w).alias("w"))
        return made if when is None else F.when(when, made)

    everyone, day, out = F.lit(ALL_PERSONS), F.col("day"), []
    known = F.col("f1").isNotNull()
    own = _of(F.col("c1"))
    if not windows:
        bits = F.lit(1) + F.shiftleft("black", BLACK_BIT)
        if "inc" in scopes:
            out.append(event("inc", everyone, F.col("f0"), bits, 1))
        if "exc" in scopes:
            out += [event("exc", everyone, F.col("f1"), bits, 1, known),
                    event("exc", own, F.col("f1"), bits, -1, known),
                    event("exc", own, F.col("f2"), bits, 1, F.col("f2").isNotNull())]
        return _opened(sights, out)

    def in_and_out(scope: str, first: Column, before: Column, after: Column,
                   when: Column | None) -> None:
        always = F.lit(True) if when is None else when
        bits = _fresh(day, before, windows)
        out.append(event(scope, everyone, first, bits, 1, always & (bits != 0)))
        out.extend(event(scope, everyone, _expiry(day, WINDOWS[b]), 1 << b, -1, always & (
            after.isNull() | (F.datediff(after, day) > WINDOWS[b]))) for b in windows)

    if "inc" in scopes:
        in_and_out("inc", F.col("f0"), F.col("day_before"), F.col("day_after"), None)
    if "exc" in scopes:
        in_and_out("exc", F.col("f1"), F.col("last.day"), F.to_date("next"), known)
        for b in windows:  # in sight, and nobody else brought it within the window
            start = F.greatest(F.col("f1"), _expiry(F.col("other"), WINDOWS[b]))
            end = F.least(F.col("f2"), F.col("next"), _expiry(day, WINDOWS[b]))
            alone = known & (start < end)
            out += [event("exc", own, start, 1 << b, -1, alone),
                    event("exc", own, end, 1 << b, 1, alone)]
    return _opened(sights, out)


def _own_values(sources: DataFrame, sights: DataFrame, attributes: list[int], scopes: list[str],
                windows: list[int], heavy: DataFrame) -> DataFrame:
    """(order_id, edge, lane, bits): values of the sources' own rows that are not in sight yet."""
    items = [F.struct(F.lit(a).alias("attr"), F.col(ENTITY_METRICS[a].column).alias("value"))
             for a in attributes]
    rows = (sources.where(F.col("self").bitwiseAND(KNOWN) != 0)
            .select("order_id", "edge", "entity_value", F.col("at").alias("own_at"), "self",
                    F.col("person").alias("own_person"), F.explode(F.array(*items)).alias("i"))
            .select("*", "i.*").drop("i").where(F.col("value").isNotNull()))
    keys = KEYS + ["day"] if windows else KEYS
    if windows:
        rows = rows.withColumn("day", F.to_date("own_at"))
    found = measured_lookup(rows, sights, keys, F.col("order_id"), heavy)
    at, out = F.col("own_at"), []

    def add(scope: str, seen: Column, before: Column | None, when: Column | None) -> None:
        if windows:
            bits = _fresh(F.col("day"), before, windows)
        else:
            bits = F.lit(1) + F.shiftleft("black", BLACK_BIT)
        new = ~F.coalesce(seen < at, F.lit(False))
        out.append(F.when(new if when is None else new & when, F.struct(
            (F.col("attr") + lane(scope, 0)).alias("lane"), bits.cast("int").alias("bits"))))

    if "inc" in scopes:
        add("inc", F.col("f0"), F.col("day_before") if windows else None, None)
    if "exc" in scopes:
        seen = F.when(F.col("c1") != F.col("own_person"), F.col("f1")).otherwise(F.col("f2"))
        before = None
        if windows:
            strange = (F.col("last.c1") != F.col("own_person")) | F.col("last.f2").isNotNull()
            before = F.when(strange, F.col("last.day")).otherwise(F.col("last_other"))
        add("exc", seen, before, F.col("self").bitwiseAND(OTHER) != 0)
    return (found.select("order_id", "edge", F.explode(F.array(*out)).alias("e"))
            .where(F.col("e").isNotNull()).select("order_id", "edge", "e.*"))


def _source_rows(edges: DataFrame, prepared: DataFrame, sources: DataFrame | None) -> DataFrame:
    """Edges of the sources with their own attributes and the bits of their own row."""
    own = from_orders(edges, sources).select(
        "order_id", "entity_value", C.edge_index(F.col("edge_type")).alias("edge"),
        F.col("apply_date").alias("at"), F.col("cert_no").alias("person"))
    rows = own.join(prepared.withColumn("known", F.lit(True)), "order_id", "left")
    known = F.coalesce("known", F.lit(False))
    bits = (F.when(known, F.coalesce(_order_bits(KNOWN), F.lit(KNOWN))).otherwise(0)
            + F.when(known & (F.col("person") != F.col("cert_no")), OTHER).otherwise(0)
            + F.when(F.col("person").isNotNull(), PERSON).otherwise(0))
    return rows.withColumn("self", bits.cast("int")).drop("known")


def _answers(events: DataFrame, sources: DataFrame, wanted: _Wanted,
             heavy: DataFrame) -> DataFrame:
    """(order_id, edge, self, counters): running totals of the events before each source.

    A heavy value's time is cut into spans; a span's running total starts from the total of the
    spans before it, so that no task runs over all of a heavy value.
    """
    names = [_name(c) for c in wanted.counters]
    span = ["entity_value", "who", "span"]

    def spanned(rows: DataFrame) -> DataFrame:
        micros = F.floor(F.lit(DAY_MICROS) / F.col("parts")).cast("long")
        place = F.floor(F.unix_micros("at") / micros).cast("long")
        return rows.join(heavy.select("entity_value", "parts"), "entity_value", "left").withColumn(
            "span", F.coalesce(place, F.lit(0))).withColumn(
            "cut", F.col("parts").isNotNull()).drop("parts", "copies")

    sums = [F.sum(_holds(c, F.col("w"))).alias(_name(c)) for c in wanted.counters]
    dated = spanned(events).groupBy(*span, "cut", "at").agg(*sums)
    persons = [F.lit(ALL_PERSONS)]
    if "exc" in wanted.scopes:
        persons.append(_of(F.col("person")))
    asked = (spanned(sources.select("order_id", "edge", "self", "entity_value", "at", "person"))
             .withColumn("who", F.explode(F.array(*persons))).where(F.col("who").isNotNull())
             .drop("person"))
    none = {n: F.lit(0).cast("long") for n in names}
    stream = dated.withColumns({"order_id": F.lit(None).cast("string"),
                                "edge": F.lit(None).cast("int"),
                                "self": F.lit(None).cast("int"), "asked": F.lit(False)}).unionByName(
        asked.withColumns({**none, "asked": F.lit(True)}))
    # At one moment the sources come first: only earlier events count for them.
    upto = Window.partitionBy(*span).orderBy("at", F.desc("asked")).rowsBetween(
        Window.unboundedPreceding, 0)
    out = stream.select(*span, "order_id", "edge", "self", "asked",
                        *[F.sum(n).over(upto).alias(n) for n in names]).where("asked")
    earlier = Window.partitionBy("entity_value", "who").orderBy("span").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = (stream.where("cut").groupBy(*span).agg(*[F.sum(n).alias(n) for n in names])
              .select(*span, *[F.sum(n).over(earlier).alias(f"{n}_before") for n in names]))
    return out.join(totals, span, "left").select(
        "order_id", "edge", "self",
        *[(F.col(n) + F.coalesce(f"{n}_before", F.lit(0))).alias(n) for n in names])


def heavy_values(blocks: DataFrame) -> DataFrame:
    """(entity_value, parts, copies): heavy values, the spans that their fullest day is cut into,
    and the copies of a row that all their orders look up. Broadcast only if few."""
    heavy = blocks.groupBy("entity_value").agg(
        F.ceil(F.max(F.col("day_rows") / F.col("block_rows"))).cast("int").alias("parts"),
        F.ceil(F.max((F.col("last_block") + 1) * F.col("block_rows")) / LOOKUP_ROWS).cast("int")
        .alias("copies"))
    return broadcast_below(heavy, 1_000_000, "entity_value")


def _listed_orders(edges: DataFrame, prepared: DataFrame, wanted: _Wanted) -> DataFrame:
    """(entity_value, first, orders): the first date of a value's edges and its orders, each with
    its date, person, mark and flags as bits, and the wanted attributes with their marks."""
    attributes = sorted({*wanted.attributes(False), *wanted.attributes(True)})
    marks = F.lit(0)
    for a in attributes:
        marks = marks + F.shiftleft(_black(ENTITY_METRICS[a]), a)
    known = F.struct(F.lit(True).alias("known"), F.col("cert_no").alias("person"),
                     _order_bits(1).alias("bits"), marks.alias("marks"),
                     *[F.col(ENTITY_METRICS[a].column).alias(f"v{a}") for a in attributes])
    orders = edges.groupBy("order_id").agg(
        F.max("apply_date").alias("at"),
        F.collect_set(F.struct("entity_value", "apply_date")).alias("links"))
    rows = (orders.join(prepared.select("order_id", known.alias("own")), "order_id", "left")
            .select("at", "own", "links", F.explode(F.array_distinct("links.entity_value"))
                    .alias("entity_value")))
    first = F.expr("array_min(transform(filter(links, l -> l.entity_value = entity_value), "
                   "l -> l.apply_date))")
    order = F.when(F.col("own.known"), F.struct("at", "own.*"))
    return (rows.select("entity_value", first.alias("first"), order.alias("o"))
            .repartition("entity_value").groupBy("entity_value")
            .agg(F.min("first").alias("first"), F.collect_list("o").alias("orders")))


def _listed_answers(edges: DataFrame, prepared: DataFrame, asked: DataFrame,
                    wanted: _Wanted) -> DataFrame:
    """(order_id, edge, self, counters) of sources by the lists of their values' orders.

    A value that an order brings itself counts where no earlier order in sight brought it.
    """
    rows = (asked.join(_listed_orders(edges, prepared, wanted), "entity_value")
            .where(F.col("first") < F.col("at")))
    own = sorted({*wanted.attributes(False), *wanted.attributes(True)})
    other = "x.person is not null and (person is null or x.person <> person)"
    rows = rows.select(
        "order_id", "edge", "self", *[F.col(ENTITY_METRICS[a].column).alias(f"own{a}") for a in own],
        F.expr("transform(filter(orders, x -> x.at < at), x -> named_struct('gap', "
               f"datediff(at, x.at), 'other', {other}, 'bits', x.bits"
               + "".join(f", 'v{a}', x.v{a}" for a in own) + "))").alias("seen"),
        *[F.expr(f"transform(filter(orders, x -> x.marks & {1 << a} <> 0), x -> x.v{a})")
          .alias(f"black{a}") for a in own if (lane("inc", a), BLACK_BIT) in wanted.counters
          or (lane("exc", a), BLACK_BIT) in wanted.counters])
    cols = []
    for counter in wanted.counters:
        place, bit = counter
        scope, attr = SCOPES[place // (ORDER + 1) % 2], place % (ORDER + 1)
        within = f"x.gap <= {WINDOWS[bit]}" if 0 < bit < len(WINDOWS) else "true"
        if scope == "exc":
            within += " and x.other"
        if place == LINK:
            n = "1"
        elif attr == ORDER:
            has = "true" if bit < len(WINDOWS) else f"x.bits & {1 << bit} <> 0"
            n = f"size(filter(seen, x -> {within} and {has}))"
        else:
            itself = f"self & {KNOWN if scope == 'inc' else OTHER} <> 0 and own{attr} is not null"
            values = (f"concat(transform(filter(seen, x -> {within} and x.v{attr} is not null), "
                      f"x -> x.v{attr}), if({itself}, array(own{attr}), array()))")
            n = (f"size(array_intersect({values}, black{attr}))" if bit == BLACK_BIT
                 else f"size(array_distinct({values}))")
        cols.append(F.expr(n).cast("long").alias(_name(counter)))
    return rows.select("order_id", "edge", "self", *cols)


def _running_answers(edges: DataFrame, blocks: DataFrame, prepared: DataFrame, asked: DataFrame,
                     wanted: _Wanted) -> DataFrame:
    """(order_id, edge, self, counters) of sources by running totals over dated events."""
    scopes, windows, persons = wanted.scopes, wanted.windows, "exc" in wanted.scopes
    heavy = heavy_values(blocks)
    linked = edges.groupBy("entity_value").agg(F.min("apply_date").alias("first"))
    events = [_opened(linked, [_event(F.lit(ALL_PERSONS), F.col("first"), LINK, 1, 1)])]
    own = []
    plain = wanted.attributes(False)
    if plain or wanted.unlimited_orders():
        orders = dated_orders(edges, prepared)
        if wanted.unlimited_orders():
            events.append(_order_events(orders, scopes, [], True))
        if plain:
            sights = _sights(orders, plain, False, persons)
            events.append(_value_events(sights, plain, scopes, []))
            own.append(_own_values(asked, sights, plain, scopes, [], heavy))
    if windows:
        orders = dated_orders(_near(edges, asked, heavy), prepared)
        events.append(_order_events(orders, scopes, windows, False))
        sliced = wanted.attributes(True)
        sights = _with_neighbour_days(_sights(orders, sliced, True, persons), persons)
        events.append(_value_events(sights, sliced, scopes, windows))
        own.append(_own_values(asked, sights, sliced, scopes, windows, heavy))
    rows = _answers(reduce(DataFrame.unionByName, [e.select(*EVENT) for e in events]), asked,
                    wanted, heavy)
    for part in own:
        rows = rows.unionByName(part.select(
            "order_id", "edge", F.lit(None).cast("int").alias("self"),
            *[_holds(c, F.lit(1)).cast("long").alias(_name(c)) for c in wanted.counters]))
    return rows


def single_edge_features(edges: DataFrame, blocks: DataFrame, prepared: DataFrame,
                         sources: DataFrame | None = None, metrics: tuple | None = None,
                         list_rows: int = LIST_ROWS,
                         batch_edges: int = BATCH_EDGES) -> DataFrame:
    """One row per (order_id_src, edge1) with one column per metric.

    The same rows as ``features`` of ``degree1_pairs`` has for single edge types. ``blocks`` comes
    from ``graph.load``, ``prepared`` from ``prepare_attributes``. ``metrics`` restricts the pass;
    only the attributes and windows that they need are touched. Values with more than ``list_rows``
    edges are counted by running totals, all others by lists of their orders. A value asks for no
    other one: more than ``batch_edges`` edges are taken in batches of whole values.
    """
    metrics = tuple(metrics) if metrics else INCLUDE_METRICS + EXCLUDE_METRICS
    wanted = _Wanted(metrics)
    common = common_values(edges, list_rows)
    some = not common.isEmpty()

    def answers(part: DataFrame) -> DataFrame:
        few = part.join(common, "entity_value", "left_anti") if some else part
        rows = _listed_answers(few, prepared, _source_rows(few, prepared, sources), wanted)
        if some:
            many = part.join(common, "entity_value", "left_semi")
            rows = rows.unionByName(_running_answers(
                many, blocks, prepared, _source_rows(many, prepared, sources), wanted))
        return rows

    rows = by_batches(edges, "entity_value", batch_edges, "answers", answers)
    totals = rows.groupBy("order_id", "edge").agg(
        F.max("self").alias("self"), *[F.sum(_name(c)).alias(_name(c)) for c in wanted.counters])
    return _metrics(totals.where(F.col(_name((LINK, 0))) > 0), metrics)


def _metrics(totals: DataFrame, metrics: tuple) -> DataFrame:
    """Counters to metrics: null where no row passes a metric's filter."""
    def own(bit: int, scope: str) -> Column:
        """A bit of the source's own row, which counts without itself only as another person."""
        has = F.col("self").bitwiseAND(1 << bit) != 0
        if scope == "exc":
            has = has & (F.col("self").bitwiseAND(OTHER) != 0)
        return F.when(has & (F.col("self").bitwiseAND(KNOWN) != 0), F.lit(1)).otherwise(F.lit(0))

    def counter(scope: str, key: tuple[int, int]) -> Column:
        n = F.col(_name(key))
        if scope == "exc":
            n = F.when(F.col("self").bitwiseAND(PERSON) != 0, n).otherwise(F.lit(0))
        return n

    cols = []
    for m in metrics:
        kind, place, bit, rows_bit = DEFINITIONS[m]
        scope = SCOPES[place > ORDER]
        order = lane(scope, ORDER)
        n = counter(scope, (place, bit))
        if kind == "product":
            n = n + own(bit, scope)
        if kind == "black_order":
            n = n + own(BLACK_BIT, scope)
        if kind in ("black", "black_order"):
            n = F.nullif(n, F.lit(0))
        else:
            rows = counter(scope, (order, rows_bit))
            if kind in ("product", "values"):
                rows = rows + own(0, scope)
            n = F.when(rows > 0, n)
        cols.append(n.cast("long").alias(m))
    return (totals.select(F.col("order_id").alias("order_id_src"),
                          C.edge_name(F.col("edge")).alias("edge1"), *cols)
            .where(F.coalesce(*[F.col(m) for m in metrics]).isNotNull()))
