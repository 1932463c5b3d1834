"""Fixed schemas and the two registries (edge types, metrics) that drive every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------- input layouts
# Field names by position in the two CSV layouts.
APPLICATION_FIELDS = (
    "order_id", "contract_no", "term_id", "loan_pan", "return_pan", "apply_date",
    "recommend", "user_id", "cert_no", "email", "company", "mobile", "company_addr",
    "comp_phone", "emergency_contact_mobile", "contact_mobile", "ipv4", "msg_phone",
    "telecode", "device_id", "current_due_day", "history_due_day", "performance",
    "refuse_type", "product_no", "product_name", "apply_state", "apply_last_state",
    "fail_reason",
)
PERSON_FIELDS = (
    "cert_no", "apply_date", "mobile", "contact_mobile", "emergency_contact_mobile",
    "device_id", "email", "comp_phone", "loan_pan",
)
# Properties an order carries into the path tables, after its id.
NODE_PROPERTIES = (
    "apply_date", "apply_last_state", "apply_state", "current_due_day",
    "history_due_day", "fail_reason", "performance", "cert_no",
)
APPLY_NODE_FIELDS = ("order_id", "product_name") + NODE_PROPERTIES

ATTRIBUTE_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "order_id", "loan_pan", "cert_no", "email", "mobile", "comp_phone",
        "emergency_contact_mobile", "contact_mobile", "device_id", "product_name",
        "type", "performance")]
    + [T.StructField("current_due_day", T.IntegerType()),
       T.StructField("history_due_day", T.IntegerType())]
)
BLACKLIST_SCHEMA = T.StructType(
    [T.StructField("content", T.StringType()), T.StructField("type", T.StringType())]
)

# ---------------------------------------------------------------- edge registry
# Markers that mean "no value" in the source data.
MISSING = ("", "\\N", "-")
MISSING_CARD = MISSING + ("ds!",)


@dataclass(frozen=True)
class EdgeType:
    name: str            # relationship type
    column: str          # application column that holds the entity value
    label: str           # node label of the entity
    missing: tuple = MISSING
    is_company_phone: bool = False

    @property
    def suffix(self) -> str:
        return self.name.lower()


EDGES = (
    EdgeType("BANKCARD", "loan_pan", "BankCard", MISSING_CARD),
    EdgeType("COMPANYPHONE", "comp_phone", "Phone", is_company_phone=True),
    EdgeType("CONTACT", "contact_mobile", "Phone"),
    EdgeType("DEVICE", "device_id", "Device"),
    EdgeType("EMAIL", "email", "Email"),
    EdgeType("EMERGENCY", "emergency_contact_mobile", "Phone"),
    EdgeType("IDCARD", "cert_no", "IDCard"),
    EdgeType("MYPHONE", "mobile", "Phone"),
)
EDGE_NAMES = tuple(e.name for e in EDGES)
EDGE_INDEX = {e.name: i for i, e in enumerate(EDGES)}
PERSON_EDGES = tuple(e for e in EDGES if e.name != "IDCARD")
ALL_EDGES = "ALL"

# -------------------------------------------------------------- metric registry
SLICE_DAYS = (1, 3, 7, 30)
EXCEPT_SELF = "_exception_self"


@dataclass(frozen=True)
class EntityMetric:
    """Number of distinct values of one neighbour attribute."""
    name: str
    column: str
    sliced: bool = True          # also counted inside each time slice
    black_type: str | None = None


ENTITY_METRICS = (
    EntityMetric("cid_cnt", "cert_no", black_type="black_cid"),
    EntityMetric("mobile_cnt", "mobile", black_type="black_mobile"),
    EntityMetric("bankcard_cnt", "loan_pan", black_type="black_bankcard"),
    EntityMetric("imei_cnt", "device_id", black_type="black_imei"),
    EntityMetric("email_cnt", "email", black_type="black_email"),
    EntityMetric("contact_mobile_cnt", "contact_mobile"),
    EntityMetric("emergency_mobile_cnt", "emergency_contact_mobile"),
    EntityMetric("company_phone_cnt", "comp_phone", black_type="black_company_phone"),
    EntityMetric("product_cnt", "product_name", sliced=False),
)
ORDER_METRIC = "order_cnt"
BLACK_CONTRACT = "black_contract"
# Sums of 0/1 flags over neighbour orders; the source order itself is left out.
CONTRACT_METRICS = (
    "pass_contract_cnt", "q_order_cnt",
    "current_overdue0_contract_cnt", "current_overdue3_contract_cnt",
    "current_overdue30_contract_cnt", "history_overdue0_contract_cnt",
    "history_overdue3_contract_cnt", "history_overdue30_contract_cnt",
)
# Sums of 0/1 flags over neighbour orders, the source order included.
PRODUCT_METRICS = ("yfq_cnt", "tnh_cnt")
# The two product names that have their own counter.
PRODUCT_NAMES = {"yfq_cnt": "易分期", "tnh_cnt": "替你还"}

CONTRACT_GROUP = (ORDER_METRIC,) + CONTRACT_METRICS
ENTITY_GROUP = tuple(m.name for m in ENTITY_METRICS) + PRODUCT_METRICS
SLICE_GROUP = tuple(f"{m.name}{n}" for n in SLICE_DAYS for m in ENTITY_METRICS if m.sliced)
BLACK_GROUP = tuple(f"{m.black_type}_cnt" for m in ENTITY_METRICS if m.black_type) + (
    f"{BLACK_CONTRACT}_cnt",)
INCLUDE_METRICS = CONTRACT_GROUP + ENTITY_GROUP + SLICE_GROUP + BLACK_GROUP
EXCLUDE_METRICS = tuple(m + EXCEPT_SELF for m in INCLUDE_METRICS)


def group_columns(group: tuple, except_self: bool = False) -> list[str]:
    return [m + EXCEPT_SELF for m in group] if except_self else list(group)


def title_suffixes(degree: int, all_edges: bool = True) -> list[str]:
    """Edge part of a feature title: '' for all edges, '_a' or '_a_b' otherwise."""
    names = [e.suffix for e in EDGES]
    if degree == 1:
        own = ["_" + a for a in names]
    else:
        own = [f"_{a}_{b}" for a in names for b in names]
    return ([""] if all_edges else []) + own


def titles(degree: int) -> list[str]:
    """Every feature title of a degree, sorted (the fixed list behind wide and sparse forms)."""
    metrics = INCLUDE_METRICS + (EXCLUDE_METRICS if degree == 1 else ())
    return sorted(m + s for m in metrics for s in title_suffixes(degree))
