"""Scalar column expressions: cleaning, flags, date parts. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskgraph.schemas import EDGE_NAMES, EDGES, EdgeType, PRODUCT_NAMES


def clean_order_id(c: Column) -> Column:
    return F.translate(c, ":", "")


def present(c: Column, missing: tuple) -> Column:
    """True where a value is neither null nor one of the missing markers."""
    return c.isNotNull() & ~c.isin(*missing)


def graph_phone(c: Column) -> Column:
    """Company phone as an entity value: separators removed."""
    return F.translate(c, "|-", "")


def digits_only(c: Column) -> Column:
    """Company phone as an attribute: digits only."""
    return F.regexp_replace(c, "[^0-9]", "")


def edge_value(edge: EdgeType, c: Column, strict_idcard: bool = True) -> Column:
    """Entity value an application contributes for one edge type, null if it has none."""
    missing = edge.missing
    if edge.name == "IDCARD" and not strict_idcard:
        missing = ("",)
    if edge.is_company_phone:
        stripped = graph_phone(c)
        return F.when(present(c, missing) & present(stripped, missing), stripped)
    return F.when(present(c, missing), c)


def day_gap(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def month_of(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def flag(cond: Column) -> Column:
    """0/1; an unknown condition counts as 0."""
    return F.when(cond, 1).otherwise(0)


def neighbour_flags() -> dict[str, Column]:
    """The ten 0/1 flags of a neighbour order, keyed by the metric that sums them."""
    out = {
        "pass_contract_cnt": flag(F.col("type") == "pass"),
        "q_order_cnt": flag(F.col("performance") == "q_refuse"),
    }
    for side in ("current", "history"):
        due = F.col(f"{side}_due_day")
        out[f"{side}_overdue0_contract_cnt"] = flag(due <= 0)
        out[f"{side}_overdue3_contract_cnt"] = flag(due > 3)
        out[f"{side}_overdue30_contract_cnt"] = flag(due > 30)
    for metric, product in PRODUCT_NAMES.items():
        out[metric] = flag(F.col("product_name") == product)
    return out


def edge_index(c: Column) -> Column:
    """Position of an edge type in the registry, as int."""
    expr = F.lit(None).cast("int")
    for i, e in reversed(list(enumerate(EDGES))):
        expr = F.when(c == e.name, F.lit(i)).otherwise(expr)
    return expr


def edge_name(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in EDGE_NAMES]), index + 1)


def numeric_or_zero(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))
