"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from riskgraph.functions import columns as C
from riskgraph.operators import (evaluate, features as feat, graph, labels, model, neighbours,
                                 paths, profile, reshape, running, sampling)
from riskgraph.plans import backfill, fixtures as fx
from riskgraph.schemas import (ALL_EDGES, BLACK_GROUP, CONTRACT_GROUP, ENTITY_GROUP,
                               SLICE_GROUP, group_columns, title_suffixes, titles)
from riskgraph.sources import readers, writers
from riskgraph.sources.staging import by_batches, new_path, stage, tidied

TRAIN_TO, VALID_FROM, VALID_TO = "1999-12", "2000-01", "2001-08"
SAMPLE_GOOD = 1000
SEED = 11
LARGE_SAMPLE = 5000
LABEL_YEAR = 1996
RANGE = (date(1996, 1, 1), date(1996, 12, 31))
FILL = (date(1996, 2, 1), date(1996, 2, 4))
FAILS_ONCE = date(1996, 2, 3)
SHOWN_DAYS, REWRITTEN_DAY = (date(1996, 1, 8), date(1996, 1, 12)), date(1996, 1, 10)


def as_text(df: DataFrame) -> DataFrame:
    """Timestamps as ISO dates, the text form the path tables are exported in."""
    return df.select(*[F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
                       if f.dataType.typeName().startswith("timestamp") else F.col(f.name)
                       for f in df.schema.fields])


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(f.name, digits).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


# ------------------------------------------------------------------ cleaning and graph
def clean_applications(spark, sf):
    return as_text(graph.clean_applications(fx.raw_applications(spark, sf)))


def clean_company_phone(spark, sf):
    phone = F.col("comp_phone")
    return fx.applications(spark, sf).select(
        phone.alias("raw"), C.graph_phone(phone).alias("as_entity"),
        C.digits_only(phone).alias("as_attribute")).distinct()


def unpack_person_sets(spark, sf):
    items, _ = graph.unpack_person_sets(fx.person_sets(fx.applications(spark, sf)))
    return graph.person_edges(items)


def application_edges(spark, sf):
    return fx.edges(spark, sf).select("order_id", "edge_type", "entity_value", "label")


def entity_nodes(spark, sf):
    return graph.entity_nodes(fx.edges(spark, sf))


def apply_nodes(spark, sf):
    return as_text(graph.apply_nodes(fx.applications(spark, sf)))


def person_entities(spark, sf):
    apps = fx.applications(spark, sf)
    items, _ = graph.unpack_person_sets(fx.person_sets(apps))
    return graph.person_entities(graph.person_sample(*fx.person_samples(apps)),
                                 graph.person_edges(items))


# ------------------------------------------------------------------------- CSV sources
def _csv(spark, lines: DataFrame, name: str) -> str:
    """A tree of text files of the lines."""
    path = new_path(spark, name)
    lines.write.partitionBy("part").text(path)
    return path


def _lines(rejects: DataFrame) -> DataFrame:
    """Rejected lines with the folder of their file."""
    return rejects.select(F.regexp_extract("source_file", r"/(part=\d+)/", 1).alias("folder"),
                          "line")


def _csv_applications(spark, sf):
    return readers.read_applications(spark, _csv(
        spark, fx.application_lines(fx.applications(spark, sf)), "csv-applications"))


def csv_applications(spark, sf):
    """Applications through CSV files: fields trimmed, numbers and dates read."""
    rows, _ = _csv_applications(spark, sf)
    return as_text(rows.drop("source_file", "source_pos"))


def csv_application_rejects(spark, sf):
    _, rejects = _csv_applications(spark, sf)
    return _lines(rejects)


def _csv_persons(spark, sf):
    rows, rejects = readers.read_person_sets(spark, _csv(
        spark, fx.person_lines(fx.person_sets(fx.applications(spark, sf))), "csv-persons"))
    return (*graph.unpack_person_sets(rows), rejects)


def csv_person_edges(spark, sf):
    return graph.person_edges(_csv_persons(spark, sf)[0])


def csv_person_rejects(spark, sf):
    """Lines with too few fields, and items of packed sets without a time."""
    _, items, lines = _csv_persons(spark, sf)
    return items.select(F.col("cert_no").alias("folder"), F.concat_ws(
        ":", "edge_type", "item").alias("line")).unionByName(_lines(lines))


# ------------------------------------------------------------------------------- paths
def _graph(spark, sf, **how) -> graph.Graph:
    return graph.load(fx.applications(spark, sf), **how)


def degree1_paths(spark, sf):
    g = _graph(spark, sf, stage_edges=False)
    return paths.degree1(g.edges, g.blocks, day_text=True)


def degree1_paths_unordered(spark, sf):
    g = _graph(spark, sf, stage_edges=False)
    return paths.degree1_unordered(g.edges, g.blocks)


def _order_store(spark, apps):
    """The order table as it is stored, partitioned by day."""
    path = new_path(spark, "orders")
    writers.write_orders(fx.order_table(apps), path)
    return readers.read_orders(spark, path)


def degree1_backfill_range(spark, sf):
    """Paths of the orders of a range of days, over edges that are stored by value."""
    g = _graph(spark, sf, stage_edges=False, by_order=True)
    days = readers.scan_days(_order_store(spark, g.applications), *RANGE)
    return as_text(paths.degree1(g.edges, g.blocks, store=graph.store_edges(g),
                                 near=g.edges_of(days)))


def _back_fill(spark, sf) -> str:
    """Two runs of a back-fill; one day fails in the first."""
    g = _graph(spark, sf)
    store, folder, failed = graph.store_edges(g), new_path(spark, "back-fill"), []

    def export(orders, day):
        if day == FAILS_ONCE and not failed:
            failed.append(day)
            raise RuntimeError("the export of the day failed")
        return paths.degree1(g.edges, g.blocks, orders, store)

    orders = _order_store(spark, g.applications)
    for _ in range(2):
        backfill.back_fill(orders, export, folder, *FILL)
    return folder


def backfilled_paths(spark, sf):
    stored = spark.read.parquet(f"{_back_fill(spark, sf)}/paths")
    return as_text(stored.select(*paths.DEGREE1_COLUMNS))


def backfill_record(spark, sf):
    record = backfill.run_record(spark, _back_fill(spark, sf))
    return record.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "state", "rows")


def rewritten_paths(spark, sf):
    """Stored paths of a few days; of one of them all but those over the own phone were written anew."""
    g = _graph(spark, sf, stage_edges=False, by_order=True)
    days = readers.scan_days(fx.order_table(g.applications), *RANGE)
    found = stage(paths.degree1(g.before(days), g.blocks, near=g.edges_of(days)), "found-paths")
    path = new_path(spark, "stored-paths")
    writers.write_paths(found, path)
    writers.write_paths(found.where((F.to_date("apply_date_src") == F.lit(REWRITTEN_DAY))
                                    & (F.col("edg_type_src1") != "MYPHONE")), path)
    return as_text(readers.scan_days(spark.read.parquet(path), *SHOWN_DAYS)
                   .select(*paths.DEGREE1_COLUMNS))


def monthly_orders(spark, sf):
    """Month back-fill: first month included, last month left out."""
    orders = _order_store(spark, fx.applications(spark, sf))
    return readers.scan_months(orders, date(1996, 1, 1), date(1998, 1, 1)).groupBy(
        "year", "month").agg(F.count(F.lit(1)).alias("orders"))


def degree2_paths(spark, sf):
    """Degree-2 export of all orders of a date range."""
    g = _graph(spark, sf, stage_edges=False, by_order=True)
    days = readers.scan_days(fx.order_table(g.applications), *RANGE)
    return paths.degree2(g.edges, g.blocks, busy=neighbours.busy_orders(g.edges, g.blocks),
                         day_text=True, near=g.edges_of(days), reach=g.before(days))


# ---------------------------------------------------------------------------- features
def _pairs(spark, sf, degree):
    g = _graph(spark, sf)
    sources = fx.contracts(g.applications)
    if degree == 1:
        return g.applications, neighbours.degree1_pairs(g.edges, g.blocks, sources)
    return g.applications, neighbours.degree2_pairs(
        g.edges, g.blocks, sources, neighbours.busy_orders(g.edges, g.blocks))


def feature_frame(spark, sf, degree, metrics=None, g=None, prepared=None, only=None):
    g = g or _graph(spark, sf)
    busy = neighbours.busy_orders(g.edges, g.blocks)
    return feat.graph_features(g.edges, g.blocks, prepared or _attributes(g.applications), degree,
                               fx.contracts(g.applications), metrics, busy, only=only)


def degree1_pairs(spark, sf):
    _, pairs = _pairs(spark, sf, 1)
    return as_text(neighbours.pairs_by_edge(pairs, 1))


def degree2_pairs(spark, sf):
    _, pairs = _pairs(spark, sf, 2)
    return as_text(neighbours.pairs_by_edge(pairs, 2))


def degree1_attributes(spark, sf):
    g = _graph(spark, sf)
    prepared = _attributes(g.applications)
    busy = neighbours.busy_orders(g.edges, g.blocks)

    def attributed(sources):
        pairs = neighbours.degree1_pairs(g.edges, g.blocks, sources)
        return neighbours.with_attributes(pairs, prepared, busy).drop("mask")

    return as_text(by_batches(fx.contracts(g.applications), "order_id",
                              neighbours.BATCH_SOURCES[1], "attributed", attributed))


def _group(degree, group, except_self=False):
    def query(spark, sf):
        metrics = group_columns(group, except_self)
        if degree == 1:
            g = _graph(spark, sf)
            prepared = _attributes(g.applications)
            return running.single_edge_features(g.edges, g.blocks, prepared,
                                                fx.contracts(g.applications), metrics)
        return feature_frame(spark, sf, degree, metrics, only=F.col("edge1") != ALL_EDGES)
    return query


def degree1_all_edges(spark, sf):
    return feature_frame(spark, sf, 1, only=F.col("edge1") == ALL_EDGES).drop("edge1")


def degree2_all_edges(spark, sf):
    return feature_frame(spark, sf, 2, only=F.col("edge1") == ALL_EDGES).drop("edge1", "edge2")


def features_long_by_title(spark, sf):
    return feat.to_long(feature_frame(spark, sf, 1), 1)


def rewritten_features(spark, sf):
    """Long features stored by title; one title was written anew, with 1,000 more."""
    frame = _group(1, CONTRACT_GROUP)(spark, sf)
    long = stage(feat.to_long(frame.select("order_id_src", "edge1", *CONTRACT_GROUP[:3])), "long")
    path = new_path(spark, "features")
    writers.write_features_by_title(long, path)
    writers.write_features_by_title(long.where("title = 'order_cnt_idcard'").withColumn(
        "cnt", F.col("cnt") + 1000), path)
    stored = spark.read.schema(long.schema).parquet(path)
    return stored.where(F.col("title").isin("order_cnt_idcard", "order_cnt_device"))


def _metrics_of(columns: list[str], degree: int) -> tuple:
    """Metrics that some of the titles need."""
    wanted = set(columns)
    return tuple(m for m in feat.all_metrics(degree)
                 if any(m + x in wanted for x in title_suffixes(degree)))


def _wide(spark, sf, degree, columns, g=None, prepared=None):
    frame = feature_frame(spark, sf, degree, _metrics_of(columns, degree), g, prepared)
    return reshape.to_wide(frame, degree, columns)


def degree1_wide(spark, sf):
    return _wide(spark, sf, 1, reshape.degree1_wide_titles())


def degree2_wide(spark, sf):
    return _wide(spark, sf, 2, titles(2))


def degree2_sparse(spark, sf):
    packed = reshape.to_sparse(feat.to_long(feature_frame(spark, sf, 2), 2), 2)

    def text(c):
        return F.array_join(F.col(c).cast("array<string>"), ",").alias(c)

    return packed.select("order_id_src", text("indices"), text("values"))


def feature_counts(spark, sf):
    g = _graph(spark, sf)

    def sources(degree):
        return feature_frame(spark, sf, degree, CONTRACT_GROUP[:1], g,
                             only=F.col("edge1") == ALL_EDGES)

    return reshape.feature_counts(sources(2), sources(1))


# ----------------------------------------------------------------- labels and training
def _labels(spark, sf, apps=None, **kw):
    apps = apps or fx.applications(spark, sf)
    return labels.label_orders(fx.performance(apps), fx.order_table(apps), fx.fraud(apps),
                               from_year=LABEL_YEAR, **kw)


def label_v1(spark, sf):
    return as_text(_labels(spark, sf))


def label_v2(spark, sf):
    return as_text(_labels(spark, sf, overdue_is_bad=False, year="performance"))


def replaced_table(spark, sf):
    """A table of labels that a query made and another replaced."""
    path = new_path(spark, "labels")
    name = "labels_" + path.rsplit("-", 1)[-1]
    writers.create_table(_labels(spark, sf), name, path)
    writers.overwrite_table(_labels(spark, sf, overdue_is_bad=False, year="performance"), name, path)
    stored = as_text(spark.read.table(name))
    spark.sql(f"drop table {name}")
    return stored


def _contract_labels(spark, sf, apps):
    return _labels(spark, sf, apps).join(fx.contracts(apps), "order_id", "left_semi")


def _attributes(apps):
    return stage(neighbours.prepare_attributes(fx.attributes(apps), fx.blacklist(apps)),
                 "attributes")


def _training(spark, sf):
    """Labelled contract orders with all degree-1 and degree-2 columns, packed by edge scope;
    attributes are shared."""
    g = _graph(spark, sf)
    prepared = _attributes(g.applications)

    def packed(degree, columns):
        frame = feature_frame(spark, sf, degree, _metrics_of(columns, degree), g, prepared)
        return stage(reshape.pack_scopes(frame), f"degree{degree}")

    one, two = packed(1, reshape.degree1_wide_titles()), packed(2, titles(2))
    found = stage(_contract_labels(spark, sf, g.applications), "labels")
    return labels.training_table(found, one, two)


def _sparse_training(spark, sf) -> DataFrame:
    """Labelled contract orders with indices and values of all degree-1 and degree-2 columns."""
    g = _graph(spark, sf)
    prepared = _attributes(g.applications)
    one, two = reshape.degree1_wide_titles(), titles(2)
    first, second = (feat.to_long(feature_frame(spark, sf, d, _metrics_of(t, d), g, prepared), d)
                     for d, t in ((1, one), (2, two)))
    return reshape.sparse_training(_contract_labels(spark, sf, g.applications), first, second)


def training_vectors(spark, sf):
    rows = _sparse_training(spark, sf)

    def text(values):
        return F.array_join(values.cast("array<string>"), ",")

    return as_text(rows).withColumns({
        "indices": text(F.col("indices")),
        "values": text(F.col("values").cast("array<bigint>"))})


def training_table(spark, sf):
    return reshape.open_scopes(
        as_text(_training(spark, sf)), list(model.ID_COLUMNS),
        {"degree1_scopes": (1, reshape.degree1_wide_titles()), "scopes": (2, titles(2))}, missing=0)


def column_profile(spark, sf):
    """Every feature column of the training table."""
    g = _graph(spark, sf)
    prepared = _attributes(g.applications)
    rows = stage(_contract_labels(spark, sf, g.applications), "labels")
    one, two = reshape.degree1_wide_titles(), titles(2)
    first, second = (feat.to_long(feature_frame(spark, sf, d, _metrics_of(t, d), g, prepared), d)
                     for d, t in ((1, one), (2, two)))
    first = first.where(F.col("title").isin(one)).withColumn(
        "title", F.concat(F.lit("degree1_"), "title"))
    long = first.unionByName(second).join(
        rows, F.col("order_id_src") == F.col("order_id"), "left_semi")
    columns = [f"degree1_{t}" for t in one] + two
    return rounded(profile.long_profile(long, columns, rows), 4)


def balanced_sample(spark, sf):
    return as_text(sampling.balanced_sample(_labels(spark, sf), SAMPLE_GOOD, seed=SEED))


def large_sample(spark, sf):
    return as_text(sampling.random_rows(_labels(spark, sf), LARGE_SAMPLE, "order_id", SEED))


def out_of_time_split(spark, sf):
    return as_text(sampling.out_of_time(_labels(spark, sf), TRAIN_TO, VALID_FROM, VALID_TO))


def random_split(spark, sf):
    return as_text(sampling.random_split(_labels(spark, sf), 0.7, seed=SEED))


def scored_months(spark, sf) -> DataFrame:
    """The model chain: all bad and some good orders of the early months train the model, and the
    orders of the later months get its score."""
    rows = _sparse_training(spark, sf).select("label", "order_id", "apply_time", "indices", "values")
    table = model.sparse_vectors(rows, len(reshape.training_titles())).where("label <> 2")
    data = sampling.out_of_time(table, TRAIN_TO, VALID_FROM, VALID_TO)
    train = sampling.balanced_sample(data.where(F.col("part") == "train"), SAMPLE_GOOD, seed=SEED)
    fitted = model.train(train, seed=SEED)
    return model.score(fitted, data.where(F.col("part") == "valid"), model.ID_COLUMNS + ("part",))


def gbt_scores(spark, sf):
    """Scored orders of the later months; the score itself is told only to be a number here."""
    rows = scored_months(spark, sf)
    return as_text(rows.select("order_id", "apply_time", F.col("label").cast("int").alias("label"),
                               "part", (F.col("score").between(-1, 2)).alias("scored")))


def model_metrics(spark, sf):
    """Areas and mean squared error of the model's own scores on the later months."""
    return _summary(stage(scored_months(spark, sf), "scores"))


def person_split(spark, sf):
    """Person-level run: all bad persons and some good ones, split 0.7 to 0.3."""
    good, black = fx.person_samples(fx.applications(spark, sf))
    persons = good.distinct().withColumn("label", F.lit(0)).unionByName(
        black.distinct().withColumn("label", F.lit(1)))
    sample = sampling.balanced_sample(persons, SAMPLE_GOOD, "cert_no", SEED)
    return sampling.random_split(sample, 0.7, "cert_no", SEED)


# -------------------------------------------------------------------------- evaluation
def _cumulative(spark, sf):
    return evaluate.cumulative(evaluate.score_counts(fx.scored(fx.applications(spark, sf))))


def threshold_metrics(spark, sf):
    return rounded(evaluate.threshold_metrics(_cumulative(spark, sf)))


def pr_curve(spark, sf):
    return rounded(evaluate.pr_curve(_cumulative(spark, sf)))


def roc_curve(spark, sf):
    return rounded(evaluate.roc_curve(_cumulative(spark, sf)))


def _summary(scored):
    areas = evaluate.areas(evaluate.cumulative(evaluate.score_counts(scored)))
    names = ("area_under_pr", "area_under_roc")
    long = areas.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])).alias("r"))
    mse = evaluate.mean_squared_error(scored).select(
        F.lit("mse").alias("name"), F.col("mse").alias("value"))
    return rounded(long.select("r.*").unionByName(mse))


def auc_summary(spark, sf):
    return _summary(fx.scored(fx.applications(spark, sf)))


QUERIES = {
    f.__name__: f for f in (
        clean_applications, clean_company_phone, unpack_person_sets, application_edges,
        entity_nodes, apply_nodes, person_entities, degree1_paths, degree1_paths_unordered,
        degree1_backfill_range, monthly_orders, degree2_paths, csv_applications,
        csv_application_rejects, csv_person_edges, csv_person_rejects, backfilled_paths,
        backfill_record, rewritten_paths, rewritten_features, replaced_table, training_vectors,
        degree1_pairs, degree2_pairs, degree1_attributes, degree1_all_edges, degree2_all_edges,
        features_long_by_title, degree1_wide, degree2_wide, degree2_sparse, feature_counts,
        label_v1, label_v2, training_table, column_profile, balanced_sample, large_sample,
        out_of_time_split, random_split, person_split, gbt_scores, model_metrics,
        threshold_metrics, pr_curve, roc_curve, auc_summary)
}
GROUP_QUERIES = {
    "degree1_contract_metrics": (1, CONTRACT_GROUP, False),
    "degree1_entity_metrics": (1, ENTITY_GROUP, False),
    "degree1_slice_metrics": (1, SLICE_GROUP, False),
    "degree1_black_metrics": (1, BLACK_GROUP, False),
    "degree1_exclude_self_contract": (1, CONTRACT_GROUP, True),
    "degree1_exclude_self_entity": (1, ENTITY_GROUP, True),
    "degree1_exclude_self_slices": (1, SLICE_GROUP, True),
    "degree1_exclude_self_black": (1, BLACK_GROUP, True),
    "degree2_contract_metrics": (2, CONTRACT_GROUP, False),
    "degree2_entity_metrics": (2, ENTITY_GROUP, False),
    "degree2_slice_metrics": (2, SLICE_GROUP, False),
    "degree2_black_metrics": (2, BLACK_GROUP, False),
}
QUERIES.update({name: _group(*spec) for name, spec in GROUP_QUERIES.items()})
QUERIES = {name: tidied(query) for name, query in QUERIES.items()}
