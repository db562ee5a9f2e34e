"""Model jobs (small settings) and physical-plan checks."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from devicegrid.operators import boosting, clusters, forecast, ml, ranking
from devicegrid.plans.model import Model


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_label_is_next_event_row(spark):
    rows = [("A", dt.date(2024, 1, d), f) for d, f in [(1, 0), (3, 2), (9, 1)]]
    df = spark.createDataFrame(rows, "atm_id string, event_date date, faults long")
    for c in ml.C.FAULT_FEATURES:
        df = df.withColumn(c, F.lit(0))
    got = [(r.fault_tomorrow, r.label) for r in ml.next_event_label(df).orderBy("event_date").collect()]
    assert got == [(2, 1), (1, 1), (0, 0)]


def test_split_is_repeatable_and_stratified(spark):
    df = spark.range(20000).withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    a = ml.stratified_split(df, ["id"]).collect()
    assert sorted(a) == sorted(ml.stratified_split(df, ["id"]).collect()) and len(a) == 20000
    assert sum(r.split == "test" and r.label == 1 for r in a) == 1000
    assert sum(r.split == "test" and r.label == 0 for r in a) == 3000


def test_gbt_and_kmeans_small(spark, sf_dir):
    m = Model(spark, sf_dir)
    lab = ml.stratified_split(ml.next_event_label(m.daily_faults), ["atm_id", "event_date"])
    model = ml.fit_fault_model(lab.filter("split = 'train'"), max_iter=5)
    scored = ml.score(model, lab.filter("split = 'test'"))
    met = ml.classification_metrics(scored)
    assert 0.0 <= met["roc_auc"] <= 1.0 and 0.0 <= met["f1"] <= 1.0
    imp = ml.feature_importance(spark, model).collect()
    assert len(imp) == len(ml.C.FAULT_FEATURES)
    z = ml.zscore(m.device_profile)
    km = clusters.fit_kmeans(z, restarts=2)
    assigned = clusters.assign(z, km)
    assert assigned.select("cluster").distinct().count() <= 3 and km.cost >= 0 and -1 <= clusters.silhouette(assigned) <= 1
    u = ml.utilisation(m.device_profile).agg(F.min("utilisation_score"), F.max("utilisation_score")).first()
    assert 0.0 <= u[0] <= u[1] <= 1.0


def test_forecast_skips_short_series(spark):
    rows = [("S", dt.date(2024, 1, 1) + dt.timedelta(days=i), 1000.0) for i in range(10)]
    rows += [("L", dt.date(2024, 1, 1) + dt.timedelta(days=i), 60000.0 - 100 * i) for i in range(40)]
    d = spark.createDataFrame(rows, "atm_id string, event_date date, avg_cash_mwk double")
    fc = forecast.forecast_horizon(d).orderBy("ds").collect()
    assert {r.atm_id for r in fc} == {"L"} and len(fc) == 3
    # a clean linear decline is forecast exactly
    assert abs(fc[0].yhat - 56000.0) < 1e-6 and abs(fc[2].yhat - 55800.0) < 1e-6
    assert all(r.needs_refill is False for r in fc)
    mae = forecast.forecast_holdout_error(d).collect()
    assert len(mae) == 1 and mae[0].train_rows == 33 and mae[0].mae < 1e-6


def test_daily_mart_plan_shape(spark, sf_dir):
    p = _plan(E.queries()["daily_cash_mart"](spark, sf_dir))
    # partial aggregate before the shuffle, no Python in the plan
    assert "HashAggregate" in p and "PythonUDF" not in p and "BatchEvalPython" not in p


def test_scan_prunes_columns(spark, sf_dir):
    df = E.queries()["daily_cash_mart"](spark, sf_dir)
    txt = df._jdf.queryExecution().executedPlan().toString()
    schemas = [seg.split(">")[0] for seg in txt.split("ReadSchema: struct<")[1:]]
    assert schemas and all("l_orderkey" not in s and "l_comment" not in s for s in schemas)


def test_no_python_udf_in_core_queries(spark, sf_dir):
    for name in ("daily_fault_mart", "device_profile_mart", "all_alerts", "silver_transactions",
                 "cash_forecast"):
        df = E.queries()[name](spark, sf_dir)
        s = df._jdf.queryExecution().optimizedPlan().toString()
        assert "PythonUDF" not in s and "pythonUDF" not in s, name


def test_mart_shuffles_on_device_and_date_first(spark, sf_dir):
    """Skew safety: raw rows are shuffled on (device, date) after a partial
    aggregate; only aggregated daily rows are shuffled on the device."""
    import re
    plan = E.queries()["daily_cash_mart"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    keys = [{k.split("#")[0].strip() for k in e.split(",")[:-1]}
            for e in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)]
    assert {"atm_id", "event_date"} in keys and {"atm_id"} in keys and len(keys) == 2
    assert "partial_min" in plan


def test_scale_conf_sizes_partitions():
    from devicegrid.session import scale_conf
    c = scale_conf(100 * 1024**4, 8000)
    # three waves of the cores; never hundreds of thousands of reduce tasks
    assert int(c["spark.sql.shuffle.partitions"]) == 24_000
    assert int(scale_conf(100 * 1024**4, 800)["spark.sql.shuffle.partitions"]) == 20_000
    assert scale_conf(10 << 20, 8)["spark.sql.shuffle.partitions"] == "24"


def test_dedupe_limits_each_key_before_the_shuffle(spark, sf_dir):
    """Skew safety of latest-wins de-duplication: a partial window group
    limit (one row per key and partition) runs below the exchange."""
    plan = E.queries()["dedupe_latest"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in below_exchange


def test_forecast_follows_seasons_and_changes(spark):
    import math
    days = range(3 * 365)
    level = [50_000 + 20 * i - (30 * (i - 600) if i > 600 else 0) + 5_000 * math.sin(2 * math.pi * i / 365.25) + (2_000 if i % 7 == 3 else 0) for i in days]
    rows = [("A", dt.date(2021, 1, 1) + dt.timedelta(days=i), y) for i, y in zip(days, level)]
    rows += [("N", dt.date(2021, 1, 1) + dt.timedelta(days=i), None if i % 3 else 100.0) for i in range(60)] + [("Z", dt.date(2021, 1, 1) + dt.timedelta(days=i), 0.0) for i in range(40)]
    d = spark.createDataFrame(rows, "atm_id string, event_date date, avg_cash_mwk double")
    got = {r.atm_id: r for r in forecast.forecast_holdout_error(d).collect()}
    assert got["A"].mae < 1_000 and got["A"].train_rows == len(days) - 7  # 2,000 without the week, 5,000 without the year
    assert abs(got["N"].mae) < 1e-6 and got["Z"].mae == 0
    plain = forecast.forecast_holdout_error(d, season=forecast.Season(0, 0.8, 0, 0)).where("atm_id = 'A'").first()
    assert plain.mae > 3 * got["A"].mae
    assert "Python" not in _plan(forecast.forecast_horizon(d)) and _plan(forecast.forecast_horizon(d)).count("Exchange hashpartitioning") <= 1


def test_forecast_solves_the_normal_equations(spark, sf_dir):
    import numpy as np
    s, season = forecast._series(Model(spark, sf_dir).daily_cash, "atm_id", "event_date", "avg_cash_mwk", 30), forecast.Season()
    for r in s.select("s", forecast.fitted(F.col("s"), season).alias("m")).limit(20).collect():
        t, y = np.array([x.t for x in r.s], float), np.array([x.y for x in r.s]) / r.m.scale
        u = (t - r.m.lo) / r.m.span
        x = [np.ones_like(u), u] + [np.maximum(u - 0.8 * (k + 1) / 7, 0) for k in range(6)]
        x += [f(2 * np.pi * k * t / p) for p in (365.25, 7.0) for k in (1, 2, 3) for f in (np.sin, np.cos)]
        x = np.array(x).T
        assert np.allclose((x.T @ x + np.diag(season.ridge())) @ np.array(r.m.coef), x.T @ y, atol=1e-9)


def test_forecast_sums_by_grouping(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    rows = [("A", d, 5000.0 + 30 * i + 400 * (i % 7)) for i, d in enumerate(days)] + [(None, d, 100.0 * i) for i, d in enumerate(days[:40])]
    rows += [("B", d, None if i % 9 == 4 or i > 50 else 9000.0 - 50 * i + 300 * (i % 5)) for i, d in enumerate(days)]
    d = spark.createDataFrame(rows, "atm_id string, event_date date, avg_cash_mwk double").repartition(4)
    season = forecast.Season()
    s = forecast._series(d, "atm_id", "event_date", "avg_cash_mwk", 30)
    got = {r.atm_id: r for r in forecast._fits(s, "atm_id", {"train": 7, "whole": 0}, season).collect()}
    assert set(got) == {"A", "B", None}
    for n, name in ((7, "train"), (0, "whole")):
        for r in s.select("atm_id", "s", forecast.fitted(F.slice("s", 1, F.size("s") - n), season).alias("m")).collect():
            m = got[r.atm_id][name]
            assert got[r.atm_id].s == r.s and (m.lo, m.span, m.scale) == (r.m.lo, r.m.span, r.m.scale)
            assert all(abs(a - b) < 1e-9 for a, b in zip(m.coef, r.m.coef, strict=True))
    # one row without a date: no model, and no error (the last rows of B have no value)
    dateless = d.union(spark.createDataFrame([("A", None, 1.0)], d.schema))
    assert [r.yhat for r in forecast.forecast_horizon(dateless).where("atm_id = 'A'").collect()] == [None] * 3
    assert {r.atm_id: r.mae is None for r in forecast.forecast_holdout_error(dateless).collect()} == {"A": True, "B": True, None: False}
    plan = _plan(forecast.forecast_summary(d))
    assert plan.count("Exchange hashpartitioning") <= 1 and "partial_sum" in plan


def test_auc_counts_pairs_with_ties(spark):
    rows = [("a", float(i % 7), int(i % 3 == 0)) for i in range(200)] + [("b", 1.0, 1), ("b", None, 0), ("c", 0.5, 1), ("c", 0.5, 0), ("c", 0.1, 0)]
    got = {r.g: r for r in ranking.roc_auc(spark.createDataFrame(rows, "g string, s double, y int").repartition(5), "g", "s", "y").collect()}
    pos, neg = [s for g, s, y in rows if g == "a" and y], [s for g, s, y in rows if g == "a" and not y]
    assert abs(got["a"].auc - sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)) < 1e-12
    assert got["b"].auc is None and got["c"].auc == 0.75 and got["c"].negatives == 2


def test_running_totals_over_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"), (F.col("id") * 3).alias("v"))
        got = ranking.running_totals(df, "g", "o", ["v"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(r.before_v == sum(3 * i for i in range(r.g, r.o, 2)) for r in got) and len(got) == 3000


def test_kmeans_finds_groups_and_stands_few_rows(spark):
    rows = [(i, 10.0 * (i % 3) + (i * 7 % 11) / 100, 0.0) for i in range(90)]
    z = spark.createDataFrame(rows, "id long, x double, y double")
    km = clusters.fit_kmeans(z, "id", ["x", "y"], restarts=4)
    assigned = clusters.assign(z, km, ["x", "y"])
    assert len({(r.id % 3, r.cluster) for r in assigned.collect()}) == 3
    assert clusters.silhouette(assigned, "id", ["x", "y"]) > 0.98
    one = clusters.fit_kmeans(z.limit(1), "id", ["x", "y"])
    assert one.cost == 0 and clusters.silhouette(clusters.assign(z.limit(1), one, ["x", "y"]), "id", ["x", "y"]) == 0
    assert clusters.fit_kmeans(z.where("false"), "id", ["x", "y"]).centres == []


def plain_boosting(x, y, classes, rounds, depth, step, ridge=1.0, least=1.0):
    """Exact greedy trees over all values, row by row."""
    import numpy as np
    outputs = 1 if classes == 2 else classes
    margin = np.zeros((len(y), outputs))
    for _ in range(rounds):
        g, h = boosting.gradients(margin, y)
        new = margin.copy()
        for k in range(outputs):
            def leaf(rows, level):
                gt, ht = g[rows, k].sum(), h[rows, k].sum()
                best = (1e-6, None)
                if level < depth:
                    for f in range(x.shape[1]):
                        for cut in np.unique(x[:, f])[1:]:
                            left = rows[x[rows, f] < cut]
                            gl, hl = g[left, k].sum(), h[left, k].sum()
                            if hl < least or ht - hl < least:
                                continue
                            gain = (gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)) / 2
                            if gain > best[0] + 1e-9:
                                best = (gain, (f, cut))
                if best[1] is None:
                    new[rows, k] += -step * gt / (ht + ridge)
                    return
                f, cut = best[1]
                leaf(rows[x[rows, f] < cut], level + 1)
                leaf(rows[x[rows, f] >= cut], level + 1)
            leaf(np.arange(len(y)), 0)
        margin = new
    return boosting.probabilities(margin)


def test_boosting_equals_exact_greedy_trees(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    x = np.stack([rng.integers(0, 9, 400), rng.integers(0, 4, 400), rng.integers(0, 15, 400)], axis=1)
    for classes in (2, 3):
        y = np.minimum((x[:, 0] > 4).astype(int) + ((x[:, 2] + rng.integers(0, 6, 400)) > 12), classes - 1)
        df = spark.createDataFrame([(i, *map(int, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a int, b int, c int, label int").repartition(5)
        model = boosting.fit(df, ["a", "b", "c"], rounds=12, depth=3, step=0.3, bins=200)
        got = np.array([r.p for r in boosting.with_probabilities(model, df, "p").orderBy("id").collect()])
        want = plain_boosting(x, y, classes, 12, 3, 0.3)
        assert got.shape == (400, classes) and np.allclose(got[:, 1] if classes == 2 else got, want[:, 0] if classes == 2 else want, atol=1e-9)
        assert abs(sum(model.importance().values()) - 1) < 1e-9
    empty = boosting.fit(df.where("false"), ["a", "b", "c"], rounds=2)
    assert boosting.with_probabilities(empty, df, "p").first().p == [0.5, 0.5]


def test_quantile_cuts_are_exact(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("v"), F.lit(None).cast("int").alias("w"))
    assert boosting.quantile_cuts(df.repartition(7), ["v", "w"], 4) == [[25.0, 50.0, 75.0], []]


def test_boosting_tasks_hold_as_many_rows(spark):
    df = spark.range(2_000_000, numPartitions=10).select((F.col("id") % 9).alias("a"), (F.col("id") % 2).cast("int").alias("label"))
    model = boosting.Boosted(["a"], [[3.0, 6.0]], 2, 1)
    sizes = boosting.even_blocks(df, model, "label", 8).rdd.mapPartitions(lambda rows: [sum(len(r.bins) for r in rows)]).collect()
    assert len(sizes) == 8 and sum(sizes) == 2_000_000 and max(sizes) < 1.3 * 250_000


def test_boosting_sums_are_the_same_in_chunks(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(3)
    x, y, margin = rng.integers(0, 6, (4, 500)).astype(np.uint8), rng.integers(0, 2, 500), rng.normal(size=(500, 1))
    tree = boosting.Tree.empty(3)
    tree.feature[[1, 2, 3, 5]], tree.cut[[1, 2, 3, 5]], tree.value[:] = [0, 3, 1, 2], [2, 0, 4, 3], rng.normal(size=16)

    def node(r):  # a leaf keeps its rows
        at = 1
        while tree.feature[at] >= 0:
            at = 2 * at + int(x[tree.feature[at], r] > tree.cut[at])
        return at

    assert tree.nodes(x, 3).tolist() == [node(r) for r in range(500)]
    monkeypatch.setattr(boosting, "CHUNK", 64)
    g, h = boosting.gradients(margin, y)
    got = boosting.histograms(margin, x, y, [tree], 2, 6)
    want = np.zeros((2, 4, 4, 6))
    for r in range(500):
        if node(r) >= 4:
            at = node(r) if node(r) < 8 else node(r) // 2
            for f in range(4):
                want[:, at - 4, f, x[f, r]] += g[r, 0], h[r, 0]
    assert np.allclose(got[0], want, atol=1e-12)
    assert np.allclose(boosting.added(margin, x, [[tree]], 3)[:, 0], margin[:, 0] + [tree.value[node(r)] for r in range(500)])


def test_boosting_keeps_one_vector_for_rows_alike(spark, monkeypatch):
    """A pass goes over different vectors of bins and label, however many rows they stand for."""
    import numpy as np
    df = spark.range(200_000, numPartitions=3).select(
        (F.col("id") % 9).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("b"), ((F.col("id") % 9 + F.col("id") % 5) > 7).cast("int").alias("label"))
    held, cut = [], boosting.cut_lineage

    def spied(rows):
        if "labels" in rows.columns:
            held.append(rows)
        return cut(rows)
    monkeypatch.setattr(boosting, "cut_lineage", spied)
    model = boosting.fit(df, ["a", "b"], rounds=3, depth=2, bins=50)
    assert sum(len(r.labels) // 4 for r in held[0].collect()) == 45
    got = boosting.with_probabilities(model, df.distinct(), "p").select("a", "b", F.col("p")[1].alias("p")).collect()
    every = np.array([(i % 9, i % 5) for i in range(45)])
    n = np.array([len(range(i, 200_000, 45)) for i in range(45)])
    x = np.repeat(every, n, axis=0)
    y = (x.sum(axis=1) > 7).astype(int)
    want = dict(zip(map(tuple, x.tolist()), plain_boosting(x, y, 2, 3, 2, 0.05)[:, 0].tolist()))
    assert len(got) == 45 and all(abs(r.p - want[(r.a, r.b or 0)]) < 1e-9 for r in got)


def test_boosting_sums_of_bundles_are_those_of_their_features():
    import numpy as np
    rng = np.random.default_rng(4)
    widths = [40, 3, 200, 2, 7, 30]
    x = np.stack([rng.integers(0, w, 700) for w in widths]).astype(np.uint8)
    y, margin, counts = rng.integers(0, 3, 700), rng.normal(size=(700, 3)), rng.integers(1, 9, 700)
    tree = boosting.Tree.empty(2)
    tree.feature[[1, 3]], tree.cut[[1, 3]] = [2, 0], [90, 11]
    groups = boosting.bundles(widths)
    assert sorted(f for g in groups for f in g) == list(range(6)) and len(groups) < 6
    assert all(np.prod([widths[f] for f in g]) <= boosting.CELLS for g in groups)
    for level in (0, 1):
        got = boosting.histograms(margin, x, y, [tree] * 3, level, 200, counts, (groups, widths, boosting.bundled(x, groups, widths)))
        many = np.repeat(np.arange(700), counts)
        assert np.allclose(got, boosting.histograms(margin[many], x[:, many], y[many], [tree] * 3, level, 200), atol=1e-9)


def test_split_is_the_same_with_cells_first(spark):
    rows = spark.range(3000).select((F.col("id") % 900).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 2).cast("int").alias("label"))
    one, other = (ml.stratified_split(rows, ["k"], cells_first=c) for c in (False, True))
    assert one.columns == other.columns
    assert one.groupBy("label", "split").count().exceptAll(other.groupBy("label", "split").count()).count() == 0
    unique = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("label"))
    one, other = (ml.stratified_split(unique, ["k"], cells_first=c) for c in (False, True))
    assert one.count() == 3000 and one.exceptAll(other).count() == 0


def test_kmeans_passes_use_all_cores(spark, monkeypatch):
    """Rows that come in one partition are dealt out over the cores, with the same clusters."""
    rows = spark.range(3000).coalesce(1).select(F.col("id").alias("k"), (F.col("id") % 3 * 10.0).alias("x"), (F.col("id") % 3 * -5.0).alias("y"))
    parts, cut = [], clusters.cut_lineage

    def spied(df):
        parts.append(df.rdd.getNumPartitions())
        return cut(df)
    monkeypatch.setattr(clusters, "cut_lineage", spied)
    found = clusters.fit_kmeans(rows, "k", ["x", "y"])
    cores = spark.sparkContext.defaultParallelism
    assert parts == [cores] and cores > 1
    assert sorted(map(tuple, found.centres)) == [(0.0, 0.0), (10.0, -5.0), (20.0, -10.0)] and found.cost == 0
    assert clusters.silhouette(clusters.assign(rows, found, ["x", "y"]), "k", ["x", "y"]) == 1.0
