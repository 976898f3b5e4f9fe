"""Radix medians, state histories, pinned snapshots, idempotent audit rows, scopes."""

import math
import random
import struct
from collections import defaultdict
from datetime import date, datetime, timedelta
from pathlib import Path
from statistics import median

import pytest
from pyspark.sql import functions as F

from quotewright import session
from quotewright.operators.fingerprint import content_digest
from quotewright.operators.history import as_of, state_history
from quotewright.operators.quantile import grouped_median, ordered_image
from quotewright.schemas import LOAD_LOG
from quotewright.sources.exports import SourceChangedError, pinned_snapshot
from quotewright.sources.warehouse import Warehouse


def bits(v):
    n = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
    return -n if v < 0 else n


def test_image_is_the_bits_of_a_double(spark):
    r = random.Random(2)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, math.inf, -math.inf, 1 / 3]
    for e in range(-1074, 1024, 7):
        p = 2.0**e
        values += [p, -p, math.nextafter(p, 0), math.nextafter(p, math.inf)]
    values += [struct.unpack("<d", struct.pack("<q", r.getrandbits(63)))[0] for _ in range(3000)]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [(r.v, r.x) for r in df.select("v", ordered_image(F.col("v")).alias("x")).collect()]
    assert all(x == bits(v) for v, x in got)
    nan = spark.createDataFrame([(math.nan,)], "v double").select(ordered_image(F.col("v"))).first()[0]
    assert nan == 2**63 - 1


def test_median_of_values_closer_than_any_cell(spark):
    """A million different values within 1/4096 of an interval that an outlier stretches."""
    n = 1_000_000
    df = spark.range(n + 1).select(
        F.lit(None).cast("string").alias("k"),
        F.when(F.col("id") == n, 1e9).otherwise(1.0 + F.col("id") * 1e-13).alias("v"),
        F.lit(1).alias("w"),
    )
    got = grouped_median(df, ["k"], "v", "w").collect()
    assert [(r.k, r.median_v) for r in got] == [(None, 1.0 + 500_000 * 1e-13)]
    x = df.select(ordered_image(F.col("v")).alias("x"))
    for shift in (48, 32, 16):
        cells = x.select(F.shiftright("x", shift).alias("p")).groupBy(F.shiftright("p", 16)).agg(F.countDistinct("p").alias("n"))
        assert cells.agg(F.max("n")).first()[0] <= 65_536


def test_median_of_signs_weights_and_extremes(spark):
    r = random.Random(4)
    groups = {
        "mixed": [r.choice([-1, 1]) * 10.0 ** r.uniform(-300, 300) for _ in range(400)],
        "around zero": [-5e-324, 5e-324, 0.0, -0.0], "pair": [-2.0, 3.0], "far": [-math.inf, 1.0, math.inf],
    }
    rows = [(k, v, 1 + i % 3) for k, vs in groups.items() for i, v in enumerate(vs)] + [("none", None, 1)]
    got = {x.k: x.median_v for x in grouped_median(spark.createDataFrame(rows, "k string, v double, w int"), ["k"], "v", "w").collect()}
    assert got == {k: median([v for i, v in enumerate(vs) for _ in range(1 + i % 3)]) for k, vs in groups.items()}


def plain_history(rows):
    days = sorted({d for _, d, *_ in rows if d is not None})
    state = defaultdict(dict)
    low = lambda s: tuple((x is not None, x or "") for x in s)
    for k, d, *s in rows:
        if d is not None and (d not in state[k] or low(s) > low(state[k][d])):
            state[k][d] = s
    out = []
    for k, seen in state.items():
        version = 0
        for i, d in enumerate(days):
            if d not in seen:
                continue
            if i == 0 or days[i - 1] not in seen or seen[days[i - 1]] != seen[d]:
                version += 1
                out.append([k, *seen[d], version, d, None, True, 0])
            out[-1][-1] += 1
            later = days[i + 1] if i + 1 < len(days) else None
            out[-1][-3], out[-1][-2] = later, later is None
    return sorted(map(str, map(tuple, out)))


def test_history_against_plain_python(spark):
    r = random.Random(8)
    first = date(2024, 1, 1)
    rows = []
    for k in [None, 1, 2, 3, 4, 5]:
        s = ["x", None]
        for t in range(0, 40, 2):
            if r.random() < 0.25:
                s = [r.choice(["x", "y", None]), r.choice([None, "p"])]
            if r.random() < 0.8:
                rows += [(k, first + timedelta(t), *s)] * r.choice([1, 1, 3])
    rows += [(9, None, "x", "x"), (1, first, "z", None), (1, first, "z", "p")] + [(7, first + timedelta(4), "hot", None)] * 3000
    df = spark.createDataFrame(rows, "k int, day date, a string, b string")
    history = state_history(df, ["k"], "day", ["a", "b"])
    assert sorted(str(tuple(x)) for x in history.collect()) == plain_history(rows)
    on = first + timedelta(4)
    assert {x.k for x in as_of(history, on).collect()} == {k for k, d, *_ in rows if d == on}
    assert state_history(df.limit(0), ["k"], "day", ["a", "b"]).count() == 0


def test_pinned_snapshot_refuses_a_source_that_changes(spark, tmp_path, monkeypatch):
    from quotewright.sources import exports

    paths = {n: str(tmp_path / n) for n in "ab"}
    for path in paths.values():
        spark.range(50).write.parquet(path)
    copies = pinned_snapshot(spark, paths)
    assert {n: c.count() for n, c in copies.items()} == {"a": 50, "b": 50}
    spark.range(5).write.mode("append").parquet(paths["a"])
    assert copies["a"].count() == 50
    made = []
    monkeypatch.setattr(exports, "new_folder", lambda s: made.append(session.new_folder(s)) or made[-1])

    def change_between(actions):
        out = []
        for a in actions:
            out.append(a())
            if len(out) == 1:
                spark.range(5).write.mode("append").parquet(paths["b"])
        return out

    monkeypatch.setattr(exports, "together", change_between)
    with pytest.raises(SourceChangedError, match="b: "):
        pinned_snapshot(spark, paths)
    assert made and not any(Path(f.removeprefix("file:")).exists() for f in made)


def test_audit_rows_of_a_run_are_recorded_once(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "tm_")
    wh.create({}, "a", "b")
    rows = lambda run, n: spark.range(n).select(
        *(F.lit(run).alias(f.name) if f.name == "run_id" else F.lit(None).cast(f.dataType).alias(f.name) for f in LOAD_LOG)
    )
    for run, n in (("one", 3), ("two", 2), ("one", 3), ("two", 4)):
        wh.record(rows(run, n), "load_log", run)
    got = {r.run_id: r["count"] for r in wh.table("mart", "load_log").groupBy("run_id").count().collect()}
    assert got == {"one": 3, "two": 4}


def test_a_run_stopped_while_publishing_mixes_nothing(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"), "tc_")
    wh.create({}, "a", "b")
    assert wh.committed() == {} and wh.catch_up() == []

    def run(run_id, at, n):
        staged = {("mart", t): wh.stage(spark.range(n).withColumn("t", F.lit(t)), run_id, "mart", t) for t in "xyz"}
        wh.commit(staged, run_id, datetime(2024, 1, at))

    def sizes(tables):
        return {t: df.count() for t, df in tables.items()}

    run("one", 1, 1)
    assert sorted(wh.catch_up()) == ["tc_mart.x", "tc_mart.y", "tc_mart.z"] and wh.catch_up() == []
    old = wh.committed()
    for t in "xyz":  # stopped before its commit: nothing of it is seen
        wh.stage(spark.range(7), "lost", "mart", t)
    assert sizes(wh.committed()) == {("mart", t): 1 for t in "xyz"}

    run("two", 2, 2)
    publish, calls = wh.publish, []

    def stops(staged, run_id, layer, table):
        calls.append(table)
        if len(calls) == 2:
            raise RuntimeError("lost")
        publish(staged, run_id, layer, table)

    monkeypatch.setattr(wh, "publish", stops)
    with pytest.raises(RuntimeError, match="lost"):
        wh.catch_up()
    assert sizes(wh.committed()) == {("mart", t): 2 for t in "xyz"}
    assert sizes(old) == {("mart", t): 1 for t in "xyz"}
    monkeypatch.undo()
    assert len(wh.catch_up()) == 2
    assert {t: wh.table("mart", t).count() for t in "xyz"} == {"x": 2, "y": 2, "z": 2}


def test_digest_of_content(spark, tmp_path):
    schema = "a string, b string, c array<int>, d map<string,int>, e double"
    rows = [("x", "p", [1], {"k": 1, "l": 2}, 0.5), ("y", "q", None, {}, None), ("y", "q", None, {}, None), (None, "", [], None, 1.0)]
    digest = lambda data, cols=schema: tuple(content_digest(spark.createDataFrame(data, cols)).first())
    base = digest(rows)
    assert base[0] == 4 and len(base[1]) == 64
    spark.createDataFrame(rows[::-1], schema).repartition(3).write.parquet(str(tmp_path / "t"))
    assert tuple(content_digest(spark.read.parquet(str(tmp_path / "t"))).first()) == base
    swapped = [("x", "q", *rows[0][2:]), ("y", "p", *rows[1][2:]), *rows[2:]]
    changed = [swapped, rows[:3], [*rows, rows[1]], [*rows[:3], ("", "", [], None, 1.0)], [*rows[:3], (None, None, [], None, 1.0)]]
    assert len({base, *map(digest, changed)}) == 6
    # two equal rows cancel in an exclusive or, not in a sum
    assert digest([rows[0], *rows[3:]])[1] != base[1]
    assert digest([], schema)[0] == 0


def test_keep_restores_the_setting_and_scopes_clean_up(spark):
    name = session._CLEANUP
    before = spark.conf.get(name, None)
    session.together((lambda i=i: session.keep(spark.range(i + 1)) for i in range(12)), 6)
    assert spark.conf.get(name, None) == before and not session._writers

    made = []

    def make():
        kept = session.together([lambda: session.keep(spark.range(3)), lambda: session.keep(spark.range(4))])
        inner = session.finished(spark, lambda: session.keep(spark.range(5)).withColumn("x", F.lit(1)))
        made.extend(f for d in (*kept, inner) for f in d.inputFiles())
        return kept[0].unionAll(inner.select("id"))

    out = session.finished(spark, make)
    assert out.count() == 8
    assert made and not any(Path(f.removeprefix("file://")).exists() for f in made)
    with pytest.raises(ZeroDivisionError):
        session.finished(spark, lambda: [made.append(session.keep(spark.range(2)).inputFiles()[0]), 1 // 0])
    assert not Path(made[-1].removeprefix("file://")).exists()
