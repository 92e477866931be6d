"""History that grows: row sets, exact numbers, buckets and filters, points in time, refused readings, deep trees."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from airgauge import standin as st
from airgauge.functions.columns import number_text
from airgauge.operators import bucketed as b
from airgauge.operators import history as h
from airgauge.operators import multi_active as ma
from airgauge.operators import reshape as rs
from airgauge.operators.asof import as_of_join
from airgauge.operators.hierarchy import resolve_paths
from airgauge.plans import vault
from airgauge.plans.catalog import HUB, LINK, SATELLITE
from airgauge.streaming import incremental as inc


def ts(n):
    return F.lit(f"2026-01-{n:02d}").cast("timestamp")


# --- several rows per key ---------------------------------------------------------------


def ops(spark, data):
    return spark.createDataFrame(data, "k string, a string, b double")


def state(df):
    return sorted((r.k or "-", r.a or "-", r.b or 0, r.copias, r.snap_valid_from.day, r.snap_valid_to.day if r.snap_valid_to else 0) for r in df.collect())


def test_snapshot_keeps_every_row_of_a_key(spark):
    one = ops(spark, [("1", "x", 3.0), ("1", "x", 5.0), ("1", "x", 5.0), ("2", None, 1.0), (None, "n", 1.0), ("3", "gone", 1.0)])
    two = ops(spark, [("1", "x", 3.0), ("1", "x", 5.0), ("1", "y", 7.0), ("2", None, 1.0), (None, "n", 2.0)])
    s1 = ma.snapshot_rows(one, None, ["k"], ts(1))
    s2 = ma.snapshot_rows(two, s1, ["k"], ts(2))
    assert state(s2) == sorted(
        [
            ("1", "x", 3.0, 1, 1, 0), ("1", "x", 5.0, 2, 1, 2), ("1", "x", 5.0, 1, 2, 0), ("1", "y", 7.0, 1, 2, 0),
            ("2", "-", 1.0, 1, 1, 0), ("-", "n", 1.0, 1, 1, 2), ("-", "n", 2.0, 1, 2, 0), ("3", "gone", 1.0, 1, 1, 0),
        ]
    )
    assert state(ma.snapshot_rows(two, s2, ["k"], ts(3))) == state(s2)  # a rerun adds nothing
    assert s2.select(h.SNAP_ID).distinct().count() == 8
    assert ma.snapshot_rows_current(s2).count() == 6
    s3 = ma.snapshot_rows(one, s2, ["k"], ts(3))  # and back: rows that were closed open again
    assert ma.snapshot_rows_current(s3).select("k", "a", "b", "copias").exceptAll(ma.snapshot_rows_current(s1).select("k", "a", "b", "copias")).count() == 0
    only_a = ma.snapshot_rows(ops(spark, [("1", "x", 9.0)]), ma.snapshot_rows(ops(spark, [("1", "x", 1.0)]), None, ["k"], ts(1), ["a"]), ["k"], ts(2), ["a"])
    assert only_a.count() == 1


def test_row_sets_are_versions(spark):
    def load(stored, data, day):
        new = ma.new_set_rows(ops(spark, data), ["k"], ["a", "b"], stored, ts(day), "t")
        return new if stored is None else stored.unionByName(new)

    many = [("hot", f"r{i % 900}", float(i % 900)) for i in range(1800)]
    s = load(None, [("1", "x", 3.0), ("1", "x", 5.0), ("2", "y", 1.0), *many], 1)
    assert s.count() == 903 and s.where("copias = 2").count() == 900
    s = load(s, [("1", "x", 5.0), ("1", "x", 3.0), ("2", "y", 1.0), *many], 2)  # another order of rows is no change
    assert s.count() == 903
    s = load(s, [("1", "x", 5.0), ("2", "y", 1.0), ("2", "y", 1.0), *many[:-1]], 3)  # a row less, a copy more, a copy less
    assert s.count() == 903 + 1 + 1 + 900
    now = {(r.a, r.b, r.copias, r.version_seq) for r in ma.current_set(s).where("a in ('x', 'y')").collect()}
    assert now == {("x", 5.0, 1, 2), ("y", 1.0, 2, 2)}
    then = {(r.a, r.b) for r in ma.set_as_of(s, ts(2)).where("a in ('x', 'y')").collect()}
    assert then == {("x", 3.0), ("x", 5.0), ("y", 1.0)}


# --- numbers ------------------------------------------------------------------------------


def test_every_number_has_one_text(spark):
    r = random.Random(2)
    numbers = [0.1, 1 / 3, 1e-10, 1.0000000001, 1e13, 1e300, -1e300, 5e-324, 2.0**-1022, 1e9, 999999999.999999, 123456.789, 2.0**1023]
    numbers += [r.uniform(-1, 1) * 10.0 ** r.randint(-300, 300) for _ in range(500)] + [2.0**k for k in range(-1074, 1024, 7)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    texts = [x.t for x in df.select("x", number_text(F.col("x")).alias("t")).collect()]
    for x, t in zip(numbers, texts):
        whole, _, power = t.partition("p")
        assert (math.ldexp(int(whole), int(power)) if power else float(t)) == x, t
    assert len(set(texts)) == len(set(numbers))
    assert number_texts(spark, [float("nan"), float("inf"), -0.0, None]) == ["NaN", "Infinity", "0.000000", None]


def number_texts(spark, numbers):
    return [r[0] for r in spark.createDataFrame([(x,) for x in numbers], "x double").select(number_text(F.col("x"))).collect()]


def test_small_and_huge_changes_are_versions(spark):
    stored = None
    for day, x in enumerate((1.0, 1.0000000001, 1e13, 1e300, -1e300, 1.0, 1.0), 1):
        new = h.new_satellite_rows(ops(spark, [("k", "a", x)]), ["k"], ["a", "b"], stored, ts(day), "t")
        stored = new if stored is None else stored.unionByName(new)
    assert stored.count() == 6
    assert h.current_version(stored).first().b == 1.0


# --- buckets ---------------------------------------------------------------------------------


def keyed(spark, first, stop, cut):
    rows = spark.range(first, stop).select(F.md5(F.col("id").cast("string")).alias(h.KEY), "id")
    return rows.withColumns({"anio": F.lit(2026), "semana_nro": (F.col("id") / 100).cast("int")}).withColumn(b.BUCKET, cut.of())


@pytest.mark.parametrize("cut", [b.Buckets(n=8), b.Buckets(by=("anio", "semana_nro"), weeks=1)])
def test_unknown_keys_are_appended_once(spark, tmp_path, cut):
    table = f"{tmp_path}/t"
    loads = [b.append_unknown(keyed(spark, *span, cut), table) for span in ((0, 1000), (500, 1500), (500, 1500), (3000, 3001), (0, 0), (10, 11))]
    rows = b.stored_rows(spark, table)
    assert rows.count() == rows.select("id").distinct().count() == 1501
    assert loads[0].read == [] and loads[2].read == loads[2].touched and loads[4].touched == []
    assert len(loads[5].touched) == len(loads[5].read) == 1
    if cut.by:
        assert len(loads[1].read) == 5 and len(loads[1].touched) == 10 and loads[3].read == []


def test_filters_never_miss_and_seldom_err(spark, tmp_path):
    cut = b.Buckets(n=4)
    filters = b.filter_rows(keyed(spark, 0, 20_000, cut)).unionByName(b.filter_rows(keyed(spark, 20_000, 30_000, cut)))
    assert b.maybe_stored(keyed(spark, 0, 30_000, cut), filters).where("not _quizas").count() == 0
    assert b.maybe_stored(keyed(spark, 100_000, 110_000, cut), filters).where("_quizas").count() < 100


def scanned(df):
    """Folders, files and bytes that the scans of a plan without a shuffle read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    out = []
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        out.append(tuple(metrics.apply(m).value() for m in ("numPartitions", "numFiles", "filesSize")))
    return out


def test_a_load_reads_its_own_buckets_only(spark, tmp_path):
    """Folders and bytes of the second load's scan, by Spark's own metrics."""
    table, cut = f"{tmp_path}/t", b.Buckets(by=("anio", "semana_nro"), weeks=1)
    b.append_unknown(keyed(spark, 0, 5000, cut), table)
    [(_, _, everything)] = scanned(b.stored_rows(spark, table).select(h.KEY))
    touched = b.buckets_of(keyed(spark, 4900, 5000, cut))
    [(folders, _, size)] = scanned(b.stored_rows(spark, table, touched).select(h.KEY))
    assert (len(touched), folders) == (1, 1) and size < everything / 20


def test_history_in_buckets_equals_whole_tables(spark, sf, tmp_path):
    """Two batches through the bucketed loads give the rows that whole-table loads give."""
    for name in ("entidad_orden_trabajo", "relacion_medicion", "detalle_ot_ejecucion"):
        spec = (HUB | LINK | SATELLITE)[name]
        assert spec.buckets
        rows = vault.hub_rows if name in HUB else vault.link_rows if name in LINK else vault.satellite_rows
        whole = None
        for n, day in ((1, 1), (2, 2), (2, 3)):
            sources = st.history_sources(spark, sf, n)
            one = {s: sources[s] for s in (spec.sources if name in HUB else (spec.source,))}
            new = rows(name, one, whole, ts(day))
            whole = new if whole is None else whole.unionByName(new)
            path = f"{tmp_path}/{name}"
            if name in SATELLITE:
                src = one[spec.source]
                vault.append_versions(spec, src.where(spec.where) if spec.where else src, path, ts(day))
            else:
                vault.append_keys(spec, rows(name, one, None, ts(day)), path)
        cols = [c for c in whole.columns if not c.startswith("_silver")]
        got = b.stored_rows(spark, f"{tmp_path}/{name}").select(*cols)
        assert got.count() == whole.count(), name
        assert got.exceptAll(whole.select(*cols)).count() == 0, name


# --- points in time -------------------------------------------------------------------------------


@pytest.mark.parametrize(("parts", "batch", "seed"), [(4, 10_000, 1), (60, 7, 2), (200, 2, 3)])
def test_as_of_join_against_plain_search(spark, parts, batch, seed):
    """A hot key cut over many partitions, ties, NULL keys and moments, repeated facts, keys without versions."""
    r, day = random.Random(seed), datetime(2020, 1, 1)
    key = lambda: r.choice([1] * 6 + [2, 3, 4, None])
    facts = [(i, key(), None if r.random() < 0.03 else day + timedelta(days=r.randint(0, 60))) for i in range(400)]
    facts += [facts[0]] * 3 + [(1000, 77, day)]
    versions = [(key() if r.random() < 0.9 else 9, day + timedelta(days=r.randint(5, 60)), i, f"v{i}") for i in range(60)]
    f = spark.createDataFrame(facts, "id int, k int, at timestamp_ntz")
    v = spark.createDataFrame(versions, "k int, since timestamp_ntz, n int, val string")
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")}
    for c, x in zip(old, (parts, batch, "false")):
        spark.conf.set(c, x)
    try:
        got = sorted((x.id, x.val or "") for x in as_of_join(f, v, ["k"], "at", "since", ["val", "n"], ["n"]).collect())
    finally:
        for c, x in old.items():
            spark.conf.set(c, x)

    def best(k, at):
        known = [(since, n, val) for kk, since, n, val in versions if k is not None and kk == k and at is not None and since <= at]
        return max(known)[2] if known else ""

    assert got == sorted((i, best(k, at)) for i, k, at in facts)


def test_as_of_join_of_nothing(spark):
    f = spark.createDataFrame([(1, 1)], "id int, k int").withColumn("at", ts(1))
    v = spark.createDataFrame([(1, "a")], "k int, val string").withColumn("since", ts(2))
    assert [tuple(r)[:2] + (r.val,) for r in as_of_join(f, v, ["k"], "at", "since", ["val"]).collect()] == [(1, 1, None)]
    assert as_of_join(f.limit(0), v, ["k"], "at", "since", ["val"]).collect() == []
    assert as_of_join(f, v.limit(0), ["k"], "at", "since", ["val"]).first().val is None


# --- refused readings --------------------------------------------------------------------------------


def test_no_reading_vanishes(spark, tmp_path):
    """Shuffled files: what comes in is taken or refused, and a replayed batch changes nothing."""
    r, day, schema = random.Random(4), datetime(2024, 3, 4), "ts timestamp_ntz, kind string, value double"
    rows = [(day + timedelta(hours=r.randint(0, 24 * 60)), r.choice("ab"), r.choice([0.5, 1.25, 1e40, None])) for _ in range(600)] + [(None, "a", 1.0)] * 3
    for i in range(4):
        spark.createDataFrame(rows[i::4], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = inc.read_files(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
        inc.stream_counted(stream, "ts", "value", ["kind"], f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    newest, taken, refused = None, {}, []
    for i in range(4):
        own = rows[i::4]
        for t, kind, value in own:
            week = (t - timedelta(days=t.weekday())).date() if t else None
            late = t is not None and newest is not None and datetime.combine(week, datetime.min.time()) + timedelta(days=7) <= newest - timedelta(days=7)
            if t is None or late or value == 1e40:
                refused.append("sin_hora" if t is None else "tardia" if late else "fuera_de_rango")
            else:
                taken.setdefault((week, kind), []).append(value)
        newest = max([t for t, _, _ in own if t] + ([newest] if newest else []))
    got = {(x.fecha_inicio_semana, x.kind): (x.n, x.suma) for x in inc.counted_windows(spark, f"{tmp_path}/out", ["kind"]).collect()}
    assert got == {k: (len(v), sum(x for x in v if x is not None) if any(x is not None for x in v) else None) for k, v in taken.items()}
    out = spark.read.parquet(f"{tmp_path}/out/rechazos")
    assert sorted(x.motivo_rechazo for x in out.collect()) == sorted(refused) and {"tardia", "sin_hora", "fuera_de_rango"} == set(refused)
    counts = spark.read.parquet(f"{tmp_path}/out/conteo").agg(F.sum("aceptadas"), F.sum("rechazadas")).first()
    assert counts[0] + counts[1] == len(rows) and counts[1] == len(refused)


# --- sheets and trees ----------------------------------------------------------------------------------


def test_150_columns_over_three_years(spark):
    weeks = ([*range(1, 53)] + [*range(1, 54)] + [*range(1, 46)])[:150]
    weeks[30] = 29  # a slip of the pen
    names = [f"column{i:02d}" for i in range(1, 151)]
    rows = [("P", "Semanas", *map(str, weeks)), ("P", "Punto", *["1.0"] * 150)]
    sheet = spark.createDataFrame(rows, ["planta", rs.LABEL, *names])
    got = {rs_number(r._col_posicion): (r.anio, r.semana_nro) for r in rs.melt_sheet(sheet).collect()}
    want = {i + 1: (2025 + (i >= 52) + (i >= 105), w) for i, w in enumerate(weeks)}
    assert got == want
    tail = sheet.select("planta", rs.LABEL, *names[60:])  # the first columns are missing
    assert {r.anio for r in rs.melt_sheet(tail).collect()} == {2026, 2027}


def rs_number(name):
    return int(name.removeprefix("column"))


def test_deep_tree_and_circles(spark):
    rows = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(11)]
    rows += [("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("o", "outside"), ("o2", "o"), ("self", "self"), (None, "c1")]
    got = {r.a: (r.raiz, r.profundidad, r.en_ciclo) for r in resolve_paths(spark.createDataFrame(rows, "a string, b string"), "a", "b").collect()}
    assert {got[f"c{i}"] for i in range(11)} == {("c0", i, False) for i in range(11)}
    assert got["o"] == ("outside", 1, False) and got["o2"] == ("outside", 2, False)
    assert all(got[x] == (None, None, True) for x in ("x", "y", "z", "w", "self")) and len(got) == 18
    assert resolve_paths(spark.createDataFrame([], "a string, b string"), "a", "b").collect() == []


# --- entry -------------------------------------------------------------------------------------------


def test_entry_survives_a_missing_library(monkeypatch):
    whole = set(entry.queries())

    def absent(name):
        raise ModuleNotFoundError("No module named 'xxhash'")

    monkeypatch.setattr(entry.importlib, "import_module", absent)
    assert set(entry.queries()) <= whole and not any(q.startswith("op") and q[2].isdigit() for q in entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
