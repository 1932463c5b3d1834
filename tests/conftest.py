import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskgraph.functions.joins import BLOCK_ROWS, day_blocks  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stage")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


APP = dict(apply_last_state="s", apply_state="s", current_due_day=0, history_due_day=0,
           fail_reason="", performance="other_refuse", cert_no="", loan_pan="", email="",
           mobile="", comp_phone="", emergency_contact_mobile="", contact_mobile="",
           device_id="", product_name="x", type="pass")
TYPES = ", ".join(f"{k} {'int' if k.endswith('due_day') else 'string'}" for k in APP)


@pytest.fixture(scope="session")
def make_apps(spark):
    """Applications from (order_id, day of 2020-01, overrides)."""
    def build(*rows):
        data = [tuple([oid, datetime(2020, 1, day)] + list({**APP, **over}.values()))
                for oid, day, over in rows]
        return spark.createDataFrame(data, f"order_id string, apply_date timestamp, {TYPES}")
    return build


def blocks(edges, block_rows=BLOCK_ROWS):
    return day_blocks(edges, "entity_value", "apply_date", block_rows)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)
