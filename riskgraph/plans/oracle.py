"""DuckDB statements that answer the registered queries independently.

They follow the plain definition: enumerate paths, make pairs distinct, filter, then group,
one statement per filter.
"""

from __future__ import annotations

from riskgraph.operators.reshape import degree1_wide_titles
from riskgraph.plans import queries as q
from riskgraph.schemas import (APPLY_NODE_FIELDS, BLACK_CONTRACT, BLACK_GROUP, CONTRACT_GROUP,
                               EDGES, ENTITY_GROUP, ENTITY_METRICS, EXCEPT_SELF,
                               NODE_PROPERTIES, PERSON_EDGES, PRODUCT_METRICS, SLICE_DAYS,
                               SLICE_GROUP)

DAY = "strftime({}, '%Y-%m-%d')"


def _day(c: str, alias: str | None = None) -> str:
    return DAY.format(c) + f" AS {alias or c.split('.')[-1]}"


def _quoted(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


CTE = {}
CTE["li"] = """SELECT l_orderkey, min(l_partkey) AS bp, max(l_partkey) AS dp,
    count(*) FILTER (WHERE l_returnflag = 'R') AS r FROM lineitem GROUP BY l_orderkey"""
CTE["apps"] = r"""SELECT CAST(k AS VARCHAR) AS order_id, o_orderdate AS apply_date,
    'C' || c AS cert_no, 'B' || bp AS loan_pan,
    CASE WHEN k % 5 = 0 THEN '-' ELSE 'D' || dp END AS device_id,
    'P' || c AS mobile,
    CASE WHEN k % 3 = 0 THEN '' ELSE 'P' || (c + 1 + k % 2) END AS contact_mobile,
    CASE WHEN k % 16 = 0 THEN 'P' || c WHEN k % 4 = 0 THEN 'P' || (c + 2)
         ELSE '\N' END AS emergency_contact_mobile,
    '0' || (k // 16) || '-' || (k // 8) AS comp_phone,
    CASE WHEN k % 2 = 0 THEN 'e' || c || '@x.test' ELSE '' END AS email,
    CASE o_orderpriority WHEN '1-URGENT' THEN '易分期' WHEN '2-HIGH' THEN '替你还'
         ELSE o_orderpriority END AS product_name,
    CASE WHEN o_orderstatus = 'F' THEN 'pass' ELSE 'refuse' END AS type,
    CASE WHEN o_orderstatus = 'P' THEN 'q_refuse' ELSE 'other_refuse' END AS performance,
    CAST(coalesce(r, 0) * 6 - 6 AS INTEGER) AS current_due_day,
    CAST(coalesce(r, 0) * 12 - 6 AS INTEGER) AS history_due_day,
    o_orderstatus AS apply_state, o_orderstatus AS apply_last_state,
    o_orderpriority AS fail_reason, o_totalprice AS amount,
    round(coalesce(r, 0) / 10, 1) AS score
  FROM (SELECT o_orderkey AS k, o_custkey AS c, * FROM orders) LEFT JOIN li ON k = l_orderkey"""
CTE["contracts"] = """SELECT order_id FROM apps
    WHERE type = 'pass' AND product_name IN ('易分期', '替你还')"""
CTE["fraud"] = """SELECT order_id FROM apps
    WHERE performance = 'q_refuse' AND product_name = '易分期' AND amount > 300000"""


def _edge_select(e) -> str:
    value = f"replace(replace({e.column}, '|', ''), '-', '')" if e.is_company_phone else e.column
    test = f"{e.column} IS NOT NULL AND {e.column} NOT IN ({_quoted(e.missing)})"
    if e.is_company_phone:
        test += f" AND {value} NOT IN ({_quoted(e.missing)})"
    return (f"SELECT order_id, '{e.name}' AS edge_type, {value} AS entity_value, "
            f"'{e.label}' AS label FROM apps WHERE {test}")


CTE["edges"] = "\n    UNION ALL ".join(_edge_select(e) for e in EDGES)
CTE["ends"] = """SELECT e.edge_type, e.entity_value, a.order_id, a.apply_date,
    a.apply_last_state, a.apply_state, a.current_due_day, a.history_due_day, a.fail_reason,
    a.performance, a.cert_no FROM edges e JOIN apps a ON a.order_id = e.order_id"""
CTE["d1"] = """SELECT n.order_id AS order_id_src, r.edge_type AS edg_type_src1,
    r.entity_value AS contact_value1, r1.edge_type AS edg_type_dst1, m.order_id AS order_id_dst1
  FROM apps n JOIN edges r ON n.order_id = r.order_id
  JOIN edges r1 ON r.entity_value = r1.entity_value
  JOIN apps m ON r1.order_id = m.order_id WHERE n.apply_date > m.apply_date"""
CTE["d1c"] = "SELECT * FROM d1 WHERE order_id_src IN (SELECT order_id FROM contracts)"
CTE["d2"] = """SELECT p.*, r2.edge_type AS edg_type_src2, r2.entity_value AS contact_value2,
    r3.edge_type AS edg_type_dst2, r3.order_id AS order_id_dst2
  FROM d1c p JOIN apps n ON n.order_id = p.order_id_src
  JOIN apps m ON m.order_id = p.order_id_dst1
  JOIN edges r2 ON r2.order_id = p.order_id_dst1
  JOIN edges r3 ON r3.entity_value = r2.entity_value
  JOIN apps m2 ON m2.order_id = r3.order_id
  WHERE m.apply_date > m2.apply_date AND n.order_id <> m2.order_id AND n.cert_no <> m2.cert_no
    AND NOT (p.edg_type_dst1 = r2.edge_type AND p.contact_value1 = r2.entity_value)"""

BLACK_COLUMNS = [(m.black_type, m.column) for m in ENTITY_METRICS if m.black_type] + [
    (BLACK_CONTRACT, "order_id")]


def _digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '', 'g')"


CTE["black"] = "SELECT DISTINCT * FROM (" + "\n    UNION ALL ".join(
    f"SELECT '{k}' AS type, {_digits(c) if c == 'comp_phone' else c} AS content "
    "FROM apps WHERE order_id IN (SELECT order_id FROM fraud)" for k, c in BLACK_COLUMNS
) + r") WHERE content IS NOT NULL AND content NOT IN ('', '\N', '-')"

# Distinct pairs per edge (pair), and over all edges, each with the source added.
_PAIR = """SELECT DISTINCT order_id_src, {edges}, {dst} AS order_id_dst FROM {paths}
    UNION SELECT DISTINCT order_id_src, {edges}, order_id_src FROM {paths}"""
CTE["p1"] = _PAIR.format(edges="edg_type_src1 AS edge1", dst="order_id_dst1", paths="d1c")
CTE["p1all"] = _PAIR.format(edges="'ALL' AS edge1", dst="order_id_dst1", paths="d1c")
CTE["p2"] = _PAIR.format(edges="edg_type_src1 AS edge1, edg_type_src2 AS edge2",
                         dst="order_id_dst2", paths="d2")
CTE["p2all"] = _PAIR.format(edges="'ALL' AS edge1, 'ALL' AS edge2",
                            dst="order_id_dst2", paths="d2")
FLAGS = {
    "yfq_cnt": "b.product_name = '易分期'", "tnh_cnt": "b.product_name = '替你还'",
    "pass_contract_cnt": "b.type = 'pass'", "q_order_cnt": "b.performance = 'q_refuse'",
    "current_overdue0_contract_cnt": "b.current_due_day <= 0",
    "current_overdue3_contract_cnt": "b.current_due_day > 3",
    "current_overdue30_contract_cnt": "b.current_due_day > 30",
    "history_overdue0_contract_cnt": "b.history_due_day <= 0",
    "history_overdue3_contract_cnt": "b.history_due_day > 3",
    "history_overdue30_contract_cnt": "b.history_due_day > 30",
}
for _name in ("p1", "p1all", "p2", "p2all"):
    CTE["a" + _name] = ("SELECT p.*, s.cert_no AS cert_no_src, s.apply_date AS date_src, "
        "d.apply_date AS date_dst, b.cert_no, b.mobile, b.loan_pan, b.device_id, b.email, "
        f"b.contact_mobile, b.emergency_contact_mobile, {_digits('b.comp_phone')} AS comp_phone, "
        "b.product_name, " + ", ".join(
            f"CASE WHEN {c} THEN 1 ELSE 0 END AS {n}" for n, c in FLAGS.items())
        + f"""
  FROM {_name} p JOIN apps s ON s.order_id = p.order_id_src
  JOIN apps d ON d.order_id = p.order_id_dst JOIN apps b ON b.order_id = p.order_id_dst""")

NEEDS = {
    "apps": ["li"], "contracts": ["apps"], "fraud": ["apps"], "edges": ["apps"],
    "ends": ["edges"], "d1": ["edges"], "d1c": ["d1", "contracts"], "d2": ["d1c"], "black": ["fraud"],
    "p1": ["d1c"], "p1all": ["d1c"], "p2": ["d2"], "p2all": ["d2"],
    "ap1": ["p1"], "ap1all": ["p1all"], "ap2": ["p2"], "ap2all": ["p2all"],
}


# Parts that several others read.
SHARED = ("apps", "edges", "ends", "one", "d1c", "d2", "long1", "long2")


def _with(names: list[str], body: str, extra: dict | None = None) -> str:
    order: list[str] = []

    def visit(n):
        for d in NEEDS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS {'MATERIALIZED ' if n in SHARED else ''}(\n  {CTE[n]})" for n in order]
    parts += [f"{n} AS {'MATERIALIZED ' if n in SHARED else ''}(\n  {b})"
              for n, b in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ------------------------------------------------------------------------ feature blocks
def _blocks(table: str, keys: list[str], group: tuple, except_self: bool) -> list[str]:
    """One grouped statement per filter of a metric group."""
    end = EXCEPT_SELF if except_self else ""
    by = ", ".join(["order_id_src"] + keys)
    person = "cert_no_src <> a.cert_no" if except_self else "TRUE"
    out = []

    def block(cols, where, join=""):
        out.append(f"SELECT {by}, {', '.join(cols)} FROM {table} a{join} WHERE {where} "
                   f"GROUP BY {by}")

    def distinct(m, days=""):
        return f"count(DISTINCT a.{m.column}) AS {m.name}{days}{end}"

    def total(f):
        return f"CAST(sum({f}) AS BIGINT) AS {f}{end}"

    if group == CONTRACT_GROUP:
        block([f"count(DISTINCT order_id_dst) AS order_cnt{end}"]
              + [total(f) for f in CONTRACT_GROUP[1:]],
              f"order_id_src <> order_id_dst AND {person}")
    elif group == ENTITY_GROUP:
        block([distinct(m) for m in ENTITY_METRICS] + [total(f) for f in PRODUCT_METRICS],
              person)
    elif group == SLICE_GROUP:
        for n in SLICE_DAYS:
            block([distinct(m, n) for m in ENTITY_METRICS if m.sliced],
                  f"date_diff('day', CAST(date_dst AS DATE), CAST(date_src AS DATE)) <= {n} "
                  f"AND {person}")
    elif group == BLACK_GROUP:
        for kind, col in BLACK_COLUMNS:
            c = "order_id_dst" if kind == BLACK_CONTRACT else col
            block([f"count(DISTINCT a.{c}) AS {kind}_cnt{end}"],
                  f"b.type = '{kind}' AND {person}", f" JOIN black b ON a.{c} = b.content")
    return out


GROUPS = (CONTRACT_GROUP, ENTITY_GROUP, SLICE_GROUP, BLACK_GROUP)


def _metrics_of(groups) -> list[str]:
    return [m + (EXCEPT_SELF if x else "") for g, x in groups for m in g]


def _feature_sql(table: str, keys: list[str], groups: list) -> str:
    """Feature frame: all blocks side by side, absent titles null."""
    by = ", ".join(["order_id_src"] + keys)
    blocks = [b for g, x in groups for b in _blocks(table, keys, g, x)]
    cols = ", ".join(f"max({m}) AS {m}" for m in _metrics_of(groups))
    return (f"SELECT {by}, {cols} FROM (" + "\n UNION ALL BY NAME ".join(blocks)
            + f")\n GROUP BY {by}")


def _long_sql(table: str, keys: list[str], groups: list, all_edges: bool) -> str:
    suffix = "''" if all_edges else " || ".join(f"'_' || lower({k})" for k in keys)
    metrics = ", ".join(_metrics_of(groups))
    return (f"SELECT order_id_src, cnt, name || {suffix} AS title FROM (UNPIVOT ("
            + _feature_sql(table, keys, groups) + f") ON {metrics} INTO NAME name VALUE cnt)")


BOTH = [(g, x) for x in (False, True) for g in GROUPS]
INC = [(g, False) for g in GROUPS]
LONG1 = (_long_sql("ap1", ["edge1"], BOTH, False) + "\nUNION ALL "
         + _long_sql("ap1all", ["edge1"], BOTH, True))
LONG2 = (_long_sql("ap2", ["edge1", "edge2"], INC, False) + "\nUNION ALL "
         + _long_sql("ap2all", ["edge1", "edge2"], INC, True))


def _wide_sql(source: str, columns: list[str]) -> str:
    """One column per title; a title that nobody has is null."""
    return ("SELECT order_id_src, " + ", ".join(f"CAST({t} AS BIGINT) AS {t}" for t in columns)
            + f" FROM (PIVOT (SELECT * FROM {source} WHERE title IN ({_quoted(columns)})"
            + f" UNION ALL SELECT DISTINCT order_id_src, NULL, '{columns[0]}' FROM {source})"
            + f" ON title IN ({_quoted(columns)}) USING sum(cnt) GROUP BY order_id_src)")


# The metrics as the published scripts name them, written out apart from the engine's registry.
ENTITIES = "cid mobile bankcard imei email contact_mobile emergency_mobile company_phone".split()
BLACKS = "cid mobile bankcard imei email company_phone contract".split()
METRICS2 = (["order_cnt", "pass_contract_cnt", "q_order_cnt", "product_cnt", "yfq_cnt", "tnh_cnt"]
            + [f"{side}_overdue{d}_contract_cnt" for side in ("current", "history")
               for d in (0, 3, 30)]
            + [f"{e}_cnt{d}" for e in ENTITIES for d in ("", 1, 3, 7, 30)]
            + [f"black_{b}_cnt" for b in BLACKS])
SUFFIXES = "bankcard companyphone contact device email emergency idcard myphone".split()
TITLES2 = sorted(m + s for m in METRICS2
                 for s in ["", *(f"_{a}_{b}" for a in SUFFIXES for b in SUFFIXES)])


# ------------------------------------------------------------------------------ statements
def _props(alias: str, end: str) -> str:
    return ", ".join(
        _day(f"{alias}.{p}", f"{p}_{end}") if p == "apply_date" else f"{alias}.{p} AS {p}_{end}"
        for p in NODE_PROPERTIES)


def _path_statements() -> dict[str, str]:
    start, end = q.RANGE
    early = f"CAST({{}}.apply_date AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'"
    hop1 = """n.edge_type AS edg_type_src1, n.entity_value AS contact_value1,
            m.edge_type AS edg_type_dst1"""
    step = "JOIN ends m ON n.entity_value = m.entity_value AND n.apply_date > m.apply_date"
    within = "CAST(n.apply_date AS DATE) BETWEEN DATE '{}' AND DATE '{}'"

    def one_hop(where: str) -> str:
        """All columns of the paths of some sources."""
        return _with(["ends"], f"""SELECT n.order_id AS order_id_src, {_props('n', 'src')},
            {hop1}, m.order_id AS order_id_dst1, {_props('m', 'dst1')}
          FROM ends n {step} {where} ORDER BY ALL""")

    return {
        "degree1_paths": _with(["ends"], f"""SELECT n.order_id AS order_id_src,
            {_props('n', 'src')}, {hop1}, m.order_id AS order_id_dst1, {_props('m', 'dst1')}
          FROM ends n {step} ORDER BY ALL"""),
        "degree1_paths_unordered": _with(["edges"], """SELECT r.order_id AS order_id_src,
            r.edge_type AS edg_type_src1, r.entity_value AS contact_value1,
            r1.edge_type AS edg_type_dst1, r1.order_id AS order_id_dst1
          FROM edges r JOIN edges r1 ON r.entity_value = r1.entity_value
            AND (r.order_id <> r1.order_id OR r.edge_type <> r1.edge_type) ORDER BY ALL"""),
        "degree1_backfill_range": one_hop(f"WHERE {early.format('n')}"),
        "backfilled_paths": one_hop(f"WHERE {within.format(*q.FILL)}"),
        "backfill_record": _with(["ends"], f"""SELECT strftime(d, '%Y-%m-%d') AS day,
            'done' AS state, count(m.order_id) AS rows
          FROM (SELECT unnest(range(DATE '{q.FILL[0]}', DATE '{q.FILL[1]}' + 1, INTERVAL 1 DAY))
            AS d) LEFT JOIN (ends n {step}) ON CAST(n.apply_date AS DATE) = d GROUP BY d
          UNION ALL SELECT '{q.FAILS_ONCE}', 'failed', 0"""),
        "rewritten_paths": one_hop(f"""WHERE {within.format(*q.SHOWN_DAYS)} AND (n.edge_type <>
            'MYPHONE' OR CAST(n.apply_date AS DATE) <> DATE '{q.REWRITTEN_DAY}')"""),
        "monthly_orders": _with(["apps"], """SELECT CAST(year(apply_date) AS INTEGER) AS year,
            CAST(month(apply_date) AS INTEGER) AS month, count(*) AS orders FROM apps
          WHERE apply_date >= DATE '1996-01-01' AND apply_date < DATE '1998-01-01'
          GROUP BY 1, 2"""),
        "degree2_paths": _with(["ends"], f"""SELECT p.* EXCLUDE (at_dst1),
            r.edge_type AS edg_type_src2, r.entity_value AS contact_value2,
            f.edge_type AS edg_type_dst2, f.order_id AS order_id_dst2, {_props('f', 'dst2')}
          FROM one p JOIN edges r ON r.order_id = p.order_id_dst1
          JOIN ends f ON f.entity_value = r.entity_value AND f.apply_date < p.at_dst1
          WHERE f.order_id <> p.order_id_src AND f.cert_no <> p.cert_no_src
            AND NOT (p.edg_type_dst1 = r.edge_type AND p.contact_value1 = r.entity_value)
          ORDER BY ALL""", {"one": f"""SELECT n.order_id AS order_id_src, {_props('n', 'src')},
            {hop1}, m.order_id AS order_id_dst1, {_props('m', 'dst1')}, m.apply_date AS at_dst1
          FROM ends n {step} WHERE {early.format('n')}"""}),
    }


# Positions of the application fields that the CSV lines fill, as the published loader reads them.
CSV_FIELDS = {0: "order_id", 3: "loan_pan", 5: "told", 8: "cert_no", 9: "email", 11: "mobile",
              13: "comp_phone", 14: "emergency_contact_mobile", 15: "contact_mobile",
              19: "device_id", 20: "current_due_day", 21: "history_due_day", 22: "performance",
              25: "product_name", 26: "apply_state", 27: "apply_last_state", 28: "fail_reason"}
CSV_EMPTY = ("contract_no term_id return_pan recommend user_id company company_addr ipv4 msg_phone "
             "telecode refuse_type product_no").split()


def _csv_statements(persons: dict) -> dict[str, str]:
    k = "CAST(order_id AS BIGINT)"
    dated = f"""SELECT *, CASE WHEN {k} % 55 = 9 THEN '1996/13/45'
        ELSE strftime(apply_date, '%Y-%m-%d %H:%M:%S') END AS told FROM apps"""
    cells = [f"' ' || coalesce(CAST({CSV_FIELDS[i]} AS VARCHAR), '') || '  '" if i in CSV_FIELDS
             else "'   '" for i in range(29)]
    whole, short = (" || ',' || ".join(cells[:n]) for n in (29, 12))
    empty = ", ".join(f"'' AS {c}" for c in CSV_EMPTY)
    text = ", ".join(f"coalesce({c}, '') AS {c}" for c in CSV_FIELDS.values()
                     if c not in ("told", "current_due_day", "history_due_day"))
    c = "CAST(substr(cert_no, 2) AS BIGINT)"
    read = {n: b.replace("FROM apps", f"FROM (SELECT * FROM apps WHERE {c} % 31 <> 5)")
            for n, b in persons.items()}
    first = "min(strftime(apply_date, '%Y-%m-%d'))"
    return {
        "csv_applications": _with(["apps"], f"""SELECT {text}, {empty}, current_due_day,
            history_due_day, {_day('apply_date')} FROM apps
          WHERE {k} % 40 <> 7 AND {k} % 55 <> 9"""),
        "csv_application_rejects": _with(["apps"], f"""SELECT 'part=' || ({k} % 3) AS folder,
            CASE WHEN {k} % 40 = 7 THEN {short} ELSE {whole} END AS line
          FROM dated WHERE {k} % 40 = 7 OR {k} % 55 = 9""", {"dated": dated}),
        "csv_person_edges": _with(["apps"], "SELECT * FROM person", read),
        "csv_person_rejects": _with(["apps"], f"""SELECT DISTINCT cert_no AS folder,
            'MYPHONE:lost' AS line FROM apps WHERE {c} % 9 = 0 AND {c} % 31 <> 5
          UNION ALL SELECT 'part=' || ({c} % 2), cert_no || ',' || {first} FROM apps
            WHERE {c} % 31 = 5 GROUP BY cert_no"""),
    }


def _graph_statements() -> dict[str, str]:
    items = "\n UNION ALL ".join(
        f"SELECT DISTINCT cert_no, '{e.name}' AS edge_type, '{e.label}' AS label, {e.column} "
        f"AS v, {_day('apply_date', 'seen')} FROM apps WHERE {e.column} IS NOT NULL"
        for e in PERSON_EDGES)
    # A packed cell equal to a marker never occurs here, and items keep their separators.
    value = ("CASE WHEN edge_type = 'COMPANYPHONE' THEN replace(replace(v, '|', ''), '-', '') "
             "ELSE v END")
    extra = {
        "items": items,
        "good": f"SELECT cert_no, edge_type, label, seen, {value} AS entity_value FROM items",
        "kept": r"SELECT * FROM good WHERE entity_value NOT IN ('', '\N', '-')",
        "first": f"SELECT cert_no, min({DAY.format('apply_date')}) AS apply_date "
                 "FROM apps GROUP BY cert_no",
        "dated": "SELECT entity_value, min(seen) AS entity_at FROM kept GROUP BY entity_value",
        "person": """SELECT DISTINCT entity_value, cert_no, apply_date, edge_type, label,
            entity_at FROM kept JOIN first USING (cert_no) JOIN dated USING (entity_value)""",
    }
    sample = {**extra, "bad": """SELECT DISTINCT cert_no FROM apps
            WHERE order_id IN (SELECT order_id FROM fraud)""",
              "sample": """SELECT cert_no FROM bad UNION SELECT cert_no FROM apps
            WHERE order_id IN (SELECT order_id FROM contracts)
              AND cert_no NOT IN (SELECT cert_no FROM bad)"""}
    nodes = ", ".join(_day(c) if c == "apply_date" else c for c in APPLY_NODE_FIELDS)
    return {
        "clean_applications": f"""SELECT order_id, cert_no, loan_pan, {_day('apply_date')}
          FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY f, l_linenumber,
              l_partkey, l_suppkey, l_quantity, l_extendedprice, cert_no, apply_date) AS rn
            FROM (SELECT replace(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN ':'
                WHEN l_linestatus = 'O' THEN l_orderkey || ':'
                ELSE CAST(l_orderkey AS VARCHAR) END, ':', '') AS order_id,
              'C' || o_custkey AS cert_no, 'B' || l_partkey AS loan_pan,
              l_shipdate AS apply_date, 'part-' || l_returnflag AS f, l_linenumber, l_partkey,
              l_suppkey, l_quantity, l_extendedprice
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
            WHERE order_id <> '') WHERE rn = 1""",
        "clean_company_phone": _with(["apps"], f"""SELECT DISTINCT comp_phone AS raw,
            replace(replace(comp_phone, '|', ''), '-', '') AS as_entity,
            {_digits('comp_phone')} AS as_attribute FROM apps"""),
        "unpack_person_sets": _with(["apps"], "SELECT * FROM person", extra),
        "application_edges": _with(["edges"], "SELECT * FROM edges"),
        **_csv_statements(extra),
        "entity_nodes": _with(["edges"], """SELECT entity_value, min(label) AS label,
            count(DISTINCT order_id) AS degree FROM edges GROUP BY entity_value"""),
        "apply_nodes": _with(["apps"], f"SELECT {nodes} FROM apps"),
        "person_entities": _with(["fraud", "contracts"], """SELECT cert_no AS cert_no_src,
            apply_date AS apply_date_src, edge_type AS edge_src,
            entity_value AS content_key_mid, entity_at AS apply_date_mid
          FROM person WHERE cert_no IN (SELECT cert_no FROM sample)""", sample),
    }


def _feature_statements() -> dict[str, str]:
    out = {}
    for name, (degree, group, except_self) in q.GROUP_QUERIES.items():
        keys = ["edge1", "edge2"][:degree]
        out[name] = _with(["black", f"ap{degree}"],
                          _feature_sql(f"ap{degree}", keys, [(group, except_self)]))
    dates = f"{_day('s.apply_date', 'apply_date_src')}"
    out["degree1_pairs"] = _with(["p1"], f"""SELECT order_id_src, edge1, {dates},
        s.cert_no AS cert_no_src, order_id_dst, {_day('d.apply_date', 'apply_date_dst')}
      FROM p1 JOIN apps s ON s.order_id = order_id_src JOIN apps d ON d.order_id = order_id_dst""")
    out["degree2_pairs"] = _with(["p2"], f"""SELECT order_id_src, edge1, edge2, {dates},
        s.cert_no AS cert_no_src, order_id_dst, {_day('d.apply_date', 'apply_date_dst')}
      FROM p2 JOIN apps s ON s.order_id = order_id_src JOIN apps d ON d.order_id = order_id_dst""")
    marks = ", ".join(
        f"CAST(EXISTS (SELECT 1 FROM black b WHERE b.type = '{k}' AND b.content = a."
        f"{'order_id_dst' if k == BLACK_CONTRACT else c}) AS INTEGER) AS {k}"
        for k, c in BLACK_COLUMNS)
    out["degree1_attributes"] = _with(["black", "ap1all"], f"""SELECT order_id_src, order_id_dst,
        {_day('date_src', 'apply_date_src')}, cert_no_src, {_day('date_dst', 'apply_date_dst')},
        {', '.join(m.column for m in ENTITY_METRICS)}, {', '.join(FLAGS)}, {marks}
      FROM ap1all a""")
    out["degree1_all_edges"] = _with(["black", "ap1all"], _feature_sql("ap1all", [], BOTH))
    out["degree2_all_edges"] = _with(["black", "ap2all"], _feature_sql("ap2all", [], INC))
    out["features_long_by_title"] = _with(["black", "ap1", "ap1all"], LONG1)
    out["degree1_wide"] = _with(["black", "ap1", "ap1all"],
                                _wide_sql("long1", degree1_wide_titles()), {"long1": LONG1})
    out["degree2_wide"] = _with(["black", "ap2", "ap2all"],
                                _wide_sql("long2", TITLES2), {"long2": LONG2})
    numbers = ", ".join(f"('{t}', {i})" for i, t in enumerate(TITLES2))
    out["degree2_sparse"] = _with(
        ["black", "ap2", "ap2all"], """SELECT order_id_src,
        coalesce(string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) FILTER (WHERE cnt <> 0), '')
          AS indices,
        coalesce(string_agg(CAST(cnt AS VARCHAR), ',' ORDER BY idx) FILTER (WHERE cnt <> 0), '')
          AS values
      FROM long2 JOIN numbers USING (title) GROUP BY order_id_src""",
        {"long2": LONG2, "numbers": f"SELECT * FROM (VALUES {numbers}) AS t(title, idx)"})
    out["rewritten_features"] = _with(["ap1"], """SELECT order_id_src,
        cnt + CASE WHEN title = 'order_cnt_idcard' THEN 1000 ELSE 0 END AS cnt, title
      FROM long WHERE title IN ('order_cnt_idcard', 'order_cnt_device')""",
        {"long": _long_sql("ap1", ["edge1"], [(CONTRACT_GROUP, False)], False)})
    out["feature_counts"] = _with(["d1c", "d2"], """SELECT 'degree2' AS table_name,
        count(DISTINCT order_id_src) AS n FROM d2
      UNION ALL SELECT 'degree1', count(DISTINCT order_id_src) FROM d1c""")
    return out


LABELS = """SELECT a.order_id, {day}, CAST(CASE WHEN {bad} THEN 1
    WHEN history_due_day <= 0 THEN 0 ELSE 2 END AS INTEGER) AS label
  FROM apps a LEFT JOIN fraud f ON a.order_id = f.order_id
  WHERE year(apply_date) >= {year}"""


def _label_sql(overdue: bool, raw_time: bool = False) -> str:
    bad = "f.order_id IS NOT NULL" + (" OR history_due_day >= 30" if overdue else "")
    day = "apply_date AS apply_time" if raw_time else _day("apply_date", "apply_time")
    return LABELS.format(day=day, bad=bad, year=q.LABEL_YEAR)


def _training_statements() -> dict[str, str]:
    labels = {"labels": _label_sql(True)}
    cols1 = degree1_wide_titles()
    parts = {**labels, "long1": LONG1, "one": _wide_sql("long1", cols1), "long2": LONG2,
             "two": _wide_sql("long2", TITLES2)}
    tables = ["black", "ap1", "ap1all", "ap2", "ap2all"]
    names = {f"degree1_{c}": f"o.{c}" for c in cols1} | {c: f"t.{c}" for c in TITLES2}
    rows = (" FROM labels l LEFT JOIN one o ON o.order_id_src = l.order_id"
            " LEFT JOIN two t ON t.order_id_src = l.order_id"
            " WHERE l.order_id IN (SELECT order_id FROM contracts)")
    training = _with(tables, "SELECT label, l.order_id, apply_time, " + ", ".join(
        f"coalesce({c}, 0) AS {n}" for n, c in names.items()) + rows, parts)
    numbers = ", ".join(f"('{n}', {i})" for i, n in enumerate(names))
    # Opened to (column, value) with the missing ones counted by difference.
    values = ("SELECT l.order_id, 'degree1_' || title AS column_name, cnt FROM labels l"
              " JOIN long1 ON order_id_src = l.order_id WHERE l.order_id IN"
              f" (SELECT order_id FROM contracts) AND title IN ({_quoted(cols1)})"
              " UNION ALL SELECT l.order_id, title, cnt FROM labels l JOIN long2"
              " ON order_id_src = l.order_id WHERE l.order_id IN (SELECT order_id FROM contracts)")
    listed = "SELECT unnest([" + _quoted(names) + "]) AS column_name"
    profile = _with(
        tables, """SELECT c.column_name, count(cnt) AS count, round(avg(cnt), 4) AS mean,
        round(stddev_samp(cnt), 4) AS stddev, CAST(min(cnt) AS DOUBLE) AS min,
        CAST(max(cnt) AS DOUBLE) AS max,
        round(1 - count(cnt) / any_value(n_rows), 4) AS missing_rate
      FROM total, listed c LEFT JOIN vals v ON v.column_name = c.column_name
      GROUP BY c.column_name""",
        {**labels, "long1": LONG1, "long2": LONG2, "vals": values, "listed": listed,
         "total": """SELECT count(*) AS n_rows FROM labels l
            WHERE l.order_id IN (SELECT order_id FROM contracts)"""})
    vectors = _with(
        tables, """SELECT label, l.order_id, apply_time,
        coalesce(string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx), '') AS indices,
        coalesce(string_agg(CAST(cnt AS VARCHAR), ',' ORDER BY idx), '') AS values
      FROM labels l LEFT JOIN (SELECT v.*, idx FROM vals v JOIN numbers USING (column_name)
        WHERE cnt <> 0) v ON v.order_id = l.order_id
      WHERE l.order_id IN (SELECT order_id FROM contracts) GROUP BY label, l.order_id, apply_time""",
        {**labels, "long1": LONG1, "long2": LONG2, "vals": values,
         "numbers": f"SELECT * FROM (VALUES {numbers}) AS t(column_name, idx)"})
    key = f"md5('{q.SEED}:' || order_id)"
    share = f"{int(0.7 * 16 ** 8):08x}"
    return {
        "label_v1": _with(["fraud"], "SELECT * FROM labels", labels),
        "label_v2": _with(["fraud"], "SELECT * FROM labels", {"labels": _label_sql(False)}),
        "training_table": training,
        "training_vectors": vectors,
        "replaced_table": _with(["fraud"], "SELECT * FROM labels", {"labels": _label_sql(False)}),
        "column_profile": profile,
        "balanced_sample": _with(["fraud"], f"""SELECT * FROM labels WHERE label = 1
          UNION ALL (SELECT * FROM labels WHERE label = 0 ORDER BY {key}, order_id
            LIMIT {q.SAMPLE_GOOD})""", labels),
        "large_sample": _with(["fraud"], f"""SELECT * FROM labels ORDER BY {key}, order_id
            LIMIT {q.LARGE_SAMPLE}""", labels),
        "out_of_time_split": _with(["fraud"], f"""SELECT *, CASE
            WHEN substr(apply_time, 1, 7) <= '{q.TRAIN_TO}' THEN 'train' ELSE 'valid' END AS part
          FROM labels WHERE substr(apply_time, 1, 7) <= '{q.TRAIN_TO}'
            OR substr(apply_time, 1, 7) BETWEEN '{q.VALID_FROM}' AND '{q.VALID_TO}'""", labels),
        "person_split": _with(["fraud", "contracts"], f"""SELECT cert_no, label,
            CASE WHEN substr(md5('{q.SEED}:' || cert_no), 1, 8) < '{share}' THEN 'train'
              ELSE 'test' END AS part
          FROM (SELECT cert_no, CAST(1 AS INTEGER) AS label FROM bad UNION ALL
            (SELECT cert_no, CAST(0 AS INTEGER) FROM good
              ORDER BY md5('{q.SEED}:' || cert_no), cert_no LIMIT {q.SAMPLE_GOOD}))""",
            {"bad": """SELECT DISTINCT cert_no FROM apps
                WHERE order_id IN (SELECT order_id FROM fraud)""",
             "good": """SELECT DISTINCT cert_no FROM apps
                WHERE order_id IN (SELECT order_id FROM contracts)
                  AND cert_no NOT IN (SELECT cert_no FROM bad)"""}),
        "gbt_scores": _with(["fraud", "contracts"], f"""SELECT order_id, apply_time, label,
            'valid' AS part, true AS scored FROM labels
          WHERE label <> 2 AND order_id IN (SELECT order_id FROM contracts)
            AND substr(apply_time, 1, 7) BETWEEN '{q.VALID_FROM}' AND '{q.VALID_TO}'""", labels),
        "random_split": _with(["fraud"], f"""SELECT *, CASE WHEN substr({key}, 1, 8) < '{share}'
            THEN 'train' ELSE 'test' END AS part FROM labels""", labels),
    }


def _evaluation_statements() -> dict[str, str]:
    extra = {
        "scored": """SELECT apps.order_id, score, CASE WHEN f.order_id IS NULL THEN 0 ELSE 1 END
            AS label FROM apps LEFT JOIN fraud f ON apps.order_id = f.order_id""",
        "counts": """SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored
            GROUP BY score""",
        "cum": """SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
            sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM counts
            WINDOW w AS (ORDER BY score DESC)""",
        "pts": """SELECT score, tp / (tp + fp) AS p, tp / np AS r, fp / nn AS f FROM cum""",
        "pr": """SELECT 0.0::DOUBLE AS recall, arg_max(p, score) AS precision FROM pts
            UNION ALL SELECT r, p FROM pts""",
        "pr_line": """SELECT 0.0::DOUBLE AS r, arg_max(p, score) AS p, 1e9 AS s FROM pts
            UNION ALL SELECT r, p, score FROM pts""",
        "roc_line": """SELECT 0.0::DOUBLE AS f, 0.0::DOUBLE AS r, 1e9 AS s
            UNION ALL SELECT f, r, score FROM pts""",
    }
    return {
        "threshold_metrics": _with(["fraud"], """SELECT score AS threshold,
            round(p, 6) AS precision, round(r, 6) AS recall,
            round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f1,
            round(CASE WHEN p + r = 0 THEN 0 ELSE 1.25 * p * r / (0.25 * p + r) END, 6) AS f_half
          FROM pts""", extra),
        "pr_curve": _with(["fraud"], """SELECT round(recall, 6) AS recall,
            round(precision, 6) AS precision FROM pr""", extra),
        "roc_curve": _with(["fraud"], """SELECT round(f, 6) AS fpr, round(r, 6) AS tpr FROM pts
          UNION ALL SELECT 0.0, 0.0 UNION ALL SELECT 1.0, 1.0""", extra),
        "auc_summary": _with(["fraud"], """SELECT 'area_under_pr' AS name, round(sum((r - r0)
              * (p + p0) / 2), 6) AS value FROM (SELECT *, lag(r) OVER w AS r0,
              lag(p) OVER w AS p0 FROM pr_line WINDOW w AS (ORDER BY s DESC))
          UNION ALL SELECT 'area_under_roc', round(sum((f - f0) * (r + r0) / 2), 6)
            FROM (SELECT *, lag(r) OVER w AS r0, lag(f) OVER w AS f0 FROM roc_line
              WINDOW w AS (ORDER BY s DESC))
          UNION ALL SELECT 'mse', round(avg((score - label) * (score - label)), 6)
            FROM scored""", extra),
    }


def oracle_statements() -> dict[str, str]:
    return {**_graph_statements(), **_path_statements(), **_feature_statements(),
            **_training_statements(), **_evaluation_statements()}
