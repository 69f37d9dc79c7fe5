"""Orphans, incremental summaries, cast losses, contents of tables, and the arrival gate, on fixed rows."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from lamina.functions import any_match, code_int, decimal_comma, row_count, staging_table
from lamina.operators import child_rollup, enrich
from lamina.operators.guards import ExpectationError
from lamina.operators.incremental import matches, merged_states, state_changes
from lamina.operators.losses import WatchedCasts
from lamina.operators.orphans import drop_orphans, key_filter
from lamina.plans import ledger, registry
from lamina.schemas import raw_schema
from lamina.session import session_setting
from lamina.sinks import change_rollup, read_rollup, staging_name, write_run
from lamina.sources import read_detected
from lamina.streaming import run_gate, stream_to_table
from lamina.streaming.gate import STATE_STORE
from tests.test_runs import COMPANY_LINES, PARTNER_LINES, put_archive

# --- orphans ----------------------------------------------------------------------------------------


def test_no_child_of_a_parent_is_dropped(spark):
    parents = spark.range(0, 300_000, 3).withColumnRenamed("id", "k")
    children = spark.range(600_000).selectExpr("CAST(id AS INT) AS k", "id % 2 AS v")
    built = key_filter(parents, children, "k")
    assert built.many == 64 and 0 < built.fill < 0.2
    kept = drop_orphans(children, parents, "k")
    assert kept.columns == ["k", "v"]
    assert kept.join(parents, "k", "left_semi").count() == 100_000
    # Two bits of a filter that is an eighth full: few orphans pass.
    assert kept.count() < 100_000 + 500_000 * 0.05


def test_orphans_of_odd_keys(spark, rows):
    parents = spark.createDataFrame([("a", 1), (None, 1), ("é", 2), ("a", 1)], "k string, j int")
    children = spark.createDataFrame([("a", 1, 0), (None, 1, 1), ("é", 2, 2), ("b", 9, 3), ("a", None, 4)], "k string, j int, v int")
    assert {("a", 1, 0), ("é", 2, 2)} <= set(rows(drop_orphans(children, parents, ["k", "j"])))
    assert (None, 1, 1) not in rows(drop_orphans(children, parents, ["k", "j"]))
    assert drop_orphans(children, parents.limit(0), "k").count() == 0
    doubles = children.withColumn("k", F.lit(0.0))
    assert drop_orphans(doubles, parents.withColumn("k", F.lit(-0.0)), "k") is doubles


def test_a_full_filter_is_left_out(spark):
    parents, children = spark.range(200_000), spark.range(10)
    assert key_filter(parents, children, "id", most_blocks=2).fill > 0.5
    assert drop_orphans(children, parents, "id", most_blocks=2) is children


def test_orphans_go_before_the_partial_aggregate(spark):
    parents, children = spark.range(0, 1000, 10), spark.range(100_000)
    options = {"aggregates": {"n": row_count()}, "defaults": {"n": 0}}
    pruned = enrich(parents, children, "id", many_orphans=True, **options)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("partial_count") :]
    assert "BroadcastHashJoin [_block" in below and "getbit" in below
    assert "partial_count" not in plan[plan.index("BroadcastHashJoin [_block") :]
    plain = enrich(parents, children, "id", **options)
    assert sorted(pruned.collect()) == sorted(plain.collect())


# --- summaries kept up to date ----------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_rollup_follows_its_changes(spark, tmp_path, seed):
    draw, root = random.Random(seed), str(tmp_path / "t")
    live: list[tuple] = []
    for batch in range(4):
        added = [(draw.choice([None, *"abcdefgh"]), draw.choice([None, 1, 3])) for _ in range(20)]
        gone = [live.pop(draw.randrange(len(live))) for _ in range(min(len(live), 25 if batch == 2 else 8))]
        live += added
        rows = [(*r, 1) for r in added] + [(*r, -1) for r in gone]
        changes = spark.createDataFrame(rows, "k string, v int, s int")
        for _ in range(draw.choice((1, 2))):
            change_rollup(spark, root, changes, "k", batch, F.col("s"), buckets=4, n_three=matches(F.col("v") == 3), total=F.col("v"))
        expected = defaultdict(lambda: [0, 0, 0])
        for k, v in live:
            for i, x in enumerate((1, v == 3, v or 0)):
                expected[k][i] += x
        found = {r["k"]: [r["n_rows"], r["n_three"], r["total"]] for r in read_rollup(spark, root).collect()}
        assert found == dict(expected)
        whole = child_rollup(spark.createDataFrame(live, "k string, v int"), "k", n=row_count(), flag=any_match(F.col("v") == 3))
        assert {r["k"]: (r["n"], r["flag"]) for r in whole.collect()} == {k: (x[0], x[1] > 0) for k, x in found.items()}


def test_a_state_knows_its_batches(spark, rows):
    stored = spark.createDataFrame([("a", 2, 5), ("b", 1, 3)], "k string, n_rows long, _batch long")
    changes = state_changes(spark.createDataFrame([("a", 1), ("b", -1), ("c", 1)], "k string, s int"), "k", F.col("s"))
    assert rows(merged_states(stored, changes, "k", 4)) == [("a", 2, 5), ("b", 0, 4), ("c", 1, 4)]


# --- casts, contents, names -------------------------------------------------------------------------


def test_losses_are_counted_and_limited(spark, tmp_path):
    raw = spark.createDataFrame([("1,5", "7"), ("x", " "), (None, "12.7"), ("", "1e3"), ("2", "8")], "a string, b string")
    watched = WatchedCasts(raw, {"a": decimal_comma("a"), "b": code_int("b")})
    assert write_run(watched.rows, str(tmp_path / "t")) == 5
    losses = watched.losses()
    assert losses.set == {"a": 3, "b": 4} and losses.lost == {"a": 1, "b": 2}
    assert losses.require(0.5) is losses and losses.require({"a": 0.4}) is losses
    with pytest.raises(ExpectationError, match="2 of 4"):
        losses.require({"b": 0.4})
    assert [(f.name, f.dataType.simpleString()) for f in watched.rows.schema] == [("a", "double"), ("b", "int")]


def test_a_run_stops_at_too_many_losses(spark, tmp_path):
    put_archive(tmp_path / "raw" / "r" / "Empresas.zip", "K.CSV", COMPANY_LINES)
    put_archive(tmp_path / "raw" / "r" / "Socios.zip", "S.CSV", PARTNER_LINES)
    root = str(tmp_path)
    with pytest.raises(ExpectationError, match="capital_social"):
        registry.run(spark, root, "r", most_lost=0.1)
    lost = {(r["entity"], r["column"]): (r["n_set"], r["n_lost"]) for r in registry.cast_losses(spark, root, "r").collect()}
    assert lost["empresas", "capital_social"] == (3, 1) and lost["socios", "tipo_socio"] == (4, 0)
    assert ledger.pending_stages(spark, f"{root}/ledger", "r") == ["silver", "gold", "load"]
    assert registry.run(spark, root, "r", most_lost={"capital_social": 0.5, "tipo_socio": 0}) == ["silver", "gold", "load"]


def test_fingerprints_tell_contents(spark, tmp_path):
    def taken(df, **options):
        return write_run(df, str(tmp_path / "t"), fingerprint=True, **options).fingerprint

    df = spark.range(100).selectExpr("id", "id % 7 AS v", "'f' AS _file")
    same = taken(df.orderBy(F.desc("id")).repartition(3))
    assert taken(df) == same and taken(df.withColumn("_file", F.lit("g")), but=("_file",)) == taken(df, but=("_file",))
    others = [df.filter("id > 0"), df.union(df.limit(1)), df.union(df.limit(2)), df.withColumn("v", F.col("v") + 1), df.limit(0)]
    assert len({same, *map(taken, others)}) == 6


def test_only_changed_contents_are_done_again(spark, tmp_path):
    raw, root = tmp_path / "raw" / "r", str(tmp_path)
    put_archive(raw / "Empresas.zip", "K.CSV", COMPANY_LINES)
    put_archive(raw / "Socios.zip", "S.CSV", PARTNER_LINES)
    registry.run(spark, root, "r")
    for lines, redone in ((PARTNER_LINES[::-1], []), (PARTNER_LINES[:-1], ["silver", "gold"]), (PARTNER_LINES[1:-1], ["silver", "gold", "load"])):
        put_archive(raw / "Socios.zip", "S.CSV", lines)
        assert registry.run(spark, root, "r", stages=["bronze"], again=True) == ["bronze"]
        # A partner without a company changes the typed table, but not the result.
        assert registry.run(spark, root, "r") == redone
        assert registry.run(spark, root, "r") == []


def test_ledgers_without_fingerprints(spark, tmp_path):
    """Rows that an earlier version has written count by their time."""
    path = str(tmp_path / "ledger")
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    old = [("r", s, "SUCCESS", 1, at + timedelta(hours=i)) for i, s in enumerate(("ingest", "bronze", "silver", "gold", "load"))]
    spark.createDataFrame(old, "run_id string, stage string, status string, rows long, at timestamp").write.parquet(path)
    assert ledger.pending_stages(spark, path, "r") == []
    ledger.record_stage(spark, path, "r", "silver", 5, written="x")
    assert ledger.pending_stages(spark, path, "r") == ["gold", "load"]
    ledger.record_stage(spark, path, "r", "gold", 5, read="y", written="z")
    assert ledger.pending_stages(spark, path, "r") == ["gold", "load"]
    ledger.record_stage(spark, path, "r", "gold", 5, read="x", written="z")
    assert ledger.pending_stages(spark, path, "r") == ["load"]


def test_staging_names_as_a_column(spark):
    cases = [("t", "2024-01"), ("s.t", "a-b_c"), ("t x", "1"), ("t", "1;"), ("", "1"), ("t", None), (None, "1"), ("t\n", "1"), ("t", "1\n")]
    found = [r[0] for r in spark.createDataFrame(cases, "t string, r string").select(staging_table("t", "r")).collect()]
    for (t, r), name in zip(cases, found):
        try:
            assert name == (None if t is None or r is None else staging_name(t, r))
        except ValueError:
            assert name is None


def test_separators_by_agreement(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("1;a,b,c\n\n2;d\n3;\"e;f\",g,h\n")
    (tmp_path / "b.csv").write_text("x|1,2\ny|2,3\nz|3,4\n")
    (tmp_path / "c.csv").write_text("one\ntwo\n")
    (tmp_path / "d.csv").write_text("")
    got = read_detected(spark, str(tmp_path), schema=raw_schema(2), agreement=1.0)
    assert rows(got.filter("_file NOT LIKE '%b.csv'").drop("_file")) == [
        ("1", "a,b,c"), ("2", "d"), ("3", '"e;f",g,h'), ("one", None), ("two", None),
    ]
    # Both candidates agree in all lines of b.csv and have as many fields: the earlier one wins.
    assert rows(got.filter("_file LIKE '%b.csv'").drop("_file")) == [("x", "1,2"), ("y", "2,3"), ("z", "3,4")]


# --- arrival gate -----------------------------------------------------------------------------------

START = datetime(2024, 1, 1)


def hour(n):
    return None if n is None else START + timedelta(hours=n)


def decided(spark, tmp_path, expected, batches):
    """{run: verdict} after each batch of (run, name, hour) arrivals."""
    table = spark.createDataFrame([(r, n, hour(h)) for r, n, h in expected], "run_id string, name string, due timestamp")
    schema = "run_id string, name string, at timestamp"
    out = []
    for batch in batches:
        rows = spark.createDataFrame([(r, n, hour(h)) for r, n, h in batch], schema)
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        arrivals = spark.readStream.schema(schema).parquet(str(tmp_path / "in")).withWatermark("at", "0 seconds")
        with session_setting(spark, "spark.sql.streaming.stateStore.providerClass", STATE_STORE):
            stream_to_table(run_gate(arrivals, table), str(tmp_path / "out"), str(tmp_path / "check"))
        out.append({r["run_id"]: tuple(r)[1:] for r in spark.read.parquet(str(tmp_path / "out")).collect()})
    return out


def test_gate(spark, tmp_path):
    expected = [("a", "x", 5), ("a", "y", 5), ("a", "y", 4), ("b", "x", 2), ("b", "z", 2), ("c", "x", 9), (None, "x", 1), ("d", None, 1), ("e", "x", 1)]
    batches = [
        [("a", "x", 1), ("a", "x", 1), ("z", "x", 1), (None, "x", 1), ("b", None, 1), ("b", "x", None)],
        [("b", "x", 2), ("b", "z", 3), ("a", "other", 3)],
        [("a", "y", 5), ("c", "x", 4), ("e", "x", 4)],
        [("z", "end", 99)],
        [("b", "z", 99), ("a", "y", 99)],
    ]
    first, second, third, fourth, last = decided(spark, tmp_path, expected, batches)
    assert first == {}
    # The one name of b that came too late does not count, though the time of b is known to be over only afterwards.
    assert second.get("b", ("expired", 2, 1)) == ("expired", 2, 1)
    assert third["a"] == ("complete", 2, 0) and third["c"] == ("complete", 1, 0)
    assert fourth == last == {"a": ("complete", 2, 0), "b": ("expired", 2, 1), "c": ("complete", 1, 0), "e": ("expired", 1, 1)}


def test_gate_of_a_run_of_many_names(spark, tmp_path):
    expected = [("big", str(i), 50) for i in range(3000)] + [(f"r{i}", "x", 50) for i in range(30)]
    arrived = [("big", str(i), 1) for i in range(3000)]
    found = decided(spark, tmp_path, expected, [arrived[:2000], arrived[1000:] + [("r1", "x", 2)], [("", "end", 99)]])
    assert found[0] == {} and found[1] == {"big": ("complete", 3000, 0), "r1": ("complete", 1, 0)}
    assert len(found[2]) == 31 and found[2]["r2"] == ("expired", 1, 1)
