"""The reference's input tables, derived from the ``orders`` and ``lineitem`` test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskgraph.functions import columns as C
from riskgraph.operators.graph import to_edges
from riskgraph.schemas import (APPLICATION_FIELDS, BLACK_CONTRACT, ENTITY_METRICS, MISSING,
                               PERSON_EDGES, PERSON_FIELDS, PRODUCT_NAMES)

PRODUCTS = tuple(PRODUCT_NAMES.values())


def orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("bp"), F.max("l_partkey").alias("dp"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("r")))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn(
        "r", F.coalesce("r", F.lit(0)))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = orders_with_lines(spark, sf_dir).withColumnsRenamed(
        {"o_orderkey": "k", "o_custkey": "c"})
    return base.selectExpr(
        "cast(k as string) as order_id",
        "cast(o_orderdate as timestamp) as apply_date",
        "concat('C', c) as cert_no",
        "concat('B', bp) as loan_pan",
        "if(k % 5 = 0, '-', concat('D', dp)) as device_id",
        "concat('P', c) as mobile",
        "if(k % 3 = 0, '', concat('P', c + 1 + k % 2)) as contact_mobile",
        "case when k % 16 = 0 then concat('P', c) when k % 4 = 0 then concat('P', c + 2) "
        "else r'\\N' end as emergency_contact_mobile",
        "concat('0', k div 16, '-', k div 8) as comp_phone",
        "if(k % 2 = 0, concat('e', c, '@x.test'), '') as email",
        f"case o_orderpriority when '1-URGENT' then '{PRODUCTS[0]}' "
        f"when '2-HIGH' then '{PRODUCTS[1]}' else o_orderpriority end as product_name",
        "if(o_orderstatus = 'F', 'pass', 'refuse') as type",
        "if(o_orderstatus = 'P', 'q_refuse', 'other_refuse') as performance",
        "cast(r * 6 - 6 as int) as current_due_day",
        "cast(r * 12 - 6 as int) as history_due_day",
        "o_orderstatus as apply_state", "o_orderstatus as apply_last_state",
        "o_orderpriority as fail_reason", "o_totalprice as amount",
        "round(r / 10, 1) as score")


def raw_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated submissions: one raw row per order line, ids partly with a colon, some empty."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "case when l_returnflag = 'A' and l_linestatus = 'F' then ':' "
        "when l_linestatus = 'O' then concat(l_orderkey, ':') "
        "else cast(l_orderkey as string) end as order_id",
        "concat('C', o_custkey) as cert_no", "concat('B', l_partkey) as loan_pan",
        "cast(l_shipdate as timestamp) as apply_date",
        "concat('part-', l_returnflag) as source_file",
        "struct(l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as source_pos")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_edges(applications(spark, sf_dir))


def contracts(apps: DataFrame) -> DataFrame:
    """Source orders: passed applications for one of the two instalment products."""
    return apps.where((F.col("type") == "pass") & F.col("product_name").isin(*PRODUCTS)).select(
        "order_id")


def fraud(apps: DataFrame) -> DataFrame:
    """Large requests for the first product that hit the refusal table."""
    return apps.where((F.col("performance") == "q_refuse")
                      & (F.col("product_name") == PRODUCTS[0])
                      & (F.col("amount") > 300000)).select("order_id")


def attributes(apps: DataFrame) -> DataFrame:
    return apps.select("order_id", "loan_pan", "cert_no", "email", "mobile", "comp_phone",
                       "emergency_contact_mobile", "contact_mobile", "device_id",
                       "product_name", "type", "performance", "current_due_day",
                       "history_due_day")


def blacklist(apps: DataFrame) -> DataFrame:
    """Distinct cleaned attributes of the fraud orders by type."""
    bad = attributes(apps).join(fraud(apps), "order_id", "left_semi").withColumn(
        "comp_phone", C.digits_only(F.col("comp_phone")))
    items = [F.struct(F.lit(m.black_type).alias("type"), F.col(m.column).alias("content"))
             for m in ENTITY_METRICS if m.black_type]
    items.append(F.struct(F.lit(BLACK_CONTRACT).alias("type"),
                          F.col("order_id").alias("content")))
    return (bad.select(F.explode(F.array(*items)).alias("i")).select("i.*")
            .where(C.present(F.col("content"), MISSING)).distinct())


def performance(apps: DataFrame) -> DataFrame:
    return apps.select("order_id", F.col("apply_date").alias("apply_time"), "history_due_day")


def order_table(apps: DataFrame) -> DataFrame:
    """The partitioned order table: id with year, month and day."""
    return apps.select("order_id", F.year("apply_date").alias("year"),
                       F.month("apply_date").alias("month"),
                       F.dayofmonth("apply_date").alias("day"))


def person_sets(apps: DataFrame) -> DataFrame:
    """Per person: first date and, per attribute, the sorted distinct ``value@@date`` items."""
    day = F.date_format("apply_date", "yyyy-MM-dd")
    packed = [F.concat_ws("##", F.array_sort(F.collect_set(
        F.concat(F.col(e.column), F.lit("@@"), day)))).alias(e.column) for e in PERSON_EDGES]
    return apps.groupBy("cert_no").agg(F.min(day).alias("apply_date"), *packed)


def application_lines(apps: DataFrame) -> DataFrame:
    """(part, line): the applications as lines of the CSV layout, fields padded with blanks.

    Some lines are cut short, and some have a date that cannot be read.
    """
    k = F.col("order_id").cast("long")
    known = {**{c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in apps.columns},
             "apply_date": F.when(k % 55 == 9, "1996/13/45").otherwise(
                 F.date_format("apply_date", "yyyy-MM-dd HH:mm:ss"))}
    fields = [F.concat(F.lit(" "), known.get(c, F.lit("")), F.lit("  "))
              for c in APPLICATION_FIELDS]
    line = F.when(k % 40 == 7, F.concat_ws(",", *fields[:12])).otherwise(F.concat_ws(",", *fields))
    return apps.select((k % 3).alias("part"), line.alias("line"))


def person_lines(persons: DataFrame) -> DataFrame:
    """(part, line): person sets as lines; some are cut short, some hold an item without a time."""
    c = F.substring("cert_no", 2, 20).cast("long")
    mobile = F.when(c % 9 == 0, F.concat("mobile", F.lit("##lost"))).otherwise(F.col("mobile"))
    fields = [mobile if f == "mobile" else F.col(f) for f in PERSON_FIELDS]
    line = F.when(c % 31 == 5, F.concat_ws(",", *fields[:2])).otherwise(F.concat_ws(",", *fields))
    return persons.select((c % 2).alias("part"), line.alias("line"))


def person_samples(apps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, black): persons with a contract and no fraud order; persons with a fraud order."""
    black = apps.join(fraud(apps), "order_id", "left_semi").select("cert_no")
    good = (apps.join(contracts(apps), "order_id", "left_semi").select("cert_no")
            .join(black, "cert_no", "left_anti"))
    return good, black


def scored(apps: DataFrame) -> DataFrame:
    """Model-free score with a 0/1 label (1 = fraud)."""
    bad = fraud(apps).withColumn("bad", F.lit(1))
    return apps.join(bad, "order_id", "left").select(
        "order_id", "score", F.coalesce("bad", F.lit(0)).alias("label"))
