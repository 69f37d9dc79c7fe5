"""Joins, aggregates, guards and upserts on rows with duplicate, NULL and hot keys."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from lamina.functions import any_match, row_count, target_rule
from lamina.operators import (
    child_rollup,
    coerce_schema,
    duplicate_keys,
    enrich,
    keyed_upsert,
    latest_per_key,
    left_enrich,
    missing_from,
    positional_rename,
    require_columns,
    require_rows,
    require_unique_key,
    split_rows,
)
from lamina.operators.guards import ExpectationError, require_set_key

COMPANIES = [
    ("1", "A", "03"),
    ("1", "A2", "03"),
    ("2", "B", None),
    ("3", "C", "03"),
    (None, "N", "03"),
    ("4", "D", "01"),
]
PARTNERS = [("1", 2), ("1", 3), ("2", None), ("2", 2), (None, 3), ("9", 3), ("4", 1), ("4", 1)]


def enriched(spark, companies=COMPANIES, partners=PARTNERS):
    parent = spark.createDataFrame(companies, "cnpj string, name string, cod_porte string")
    child = spark.createDataFrame(partners, "cnpj string, tipo_socio int")
    joined = enrich(
        parent,
        child,
        "cnpj",
        {"qtde_socios": row_count(), "flag": any_match(F.col("tipo_socio") == 3)},
        {"qtde_socios": 0, "flag": False},
    )
    return joined.withColumn("doc_alvo", target_rule("cod_porte", "03", "qtde_socios"))


def test_enrichment(spark, rows):
    assert rows(enriched(spark)) == sorted(
        [
            ("1", "A", "03", 2, True, True),
            ("1", "A2", "03", 2, True, True),
            ("2", "B", None, 2, False, False),
            ("3", "C", "03", 0, False, False),
            ("4", "D", "01", 2, False, False),
            (None, "N", "03", 0, False, False),
        ],
        key=repr,
    )


def test_enrichment_equals_two_separate_aggregates(spark, rows):
    parent = spark.createDataFrame(COMPANIES, "cnpj string, name string, cod_porte string")
    child = spark.createDataFrame(PARTNERS, "cnpj string, tipo_socio int")
    counts = child_rollup(child, "cnpj", qtde_socios=row_count())
    flags = child_rollup(child, "cnpj", flag=any_match(F.col("tipo_socio") == 3))
    twice = left_enrich(left_enrich(parent, counts, "cnpj", {"qtde_socios": 0}), flags, "cnpj", {"flag": False})
    twice = twice.withColumn("doc_alvo", target_rule("cod_porte", "03", "qtde_socios"))
    assert rows(twice) == rows(enriched(spark))


def test_rollup_keeps_the_null_group(spark, rows):
    child = spark.createDataFrame(PARTNERS, "cnpj string, tipo_socio int")
    assert (None, 1) in rows(child_rollup(child, "cnpj", n=row_count()))


def test_enrichment_is_one_aggregate_over_pruned_columns(spark):
    parent = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    child = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumnRenamed("o_custkey", "c_custkey")
    out = enrich(parent, child, "c_custkey", {"n": row_count(), "f": any_match(F.col("o_orderstatus") == "F")}, {"n": 0})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("HashAggregate") == 2
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in plan
    assert "IsNotNull(o_custkey)" in plan


@pytest.fixture
def split_early(settings):
    """Joins by shuffle only, and skew from 64 KB on."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__shuffle__partitions="16",
    )


def hot_tables(spark):
    """A third of the parents share a key and a third have none; a third of the children share it."""
    ids = spark.range(0, 200_000, 1, 16)
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 2, F.col("id"))
    parent = ids.select(key.cast("long").alias("k"), F.repeat(F.col("id").cast("string"), 5).alias("pad"))
    child = ids.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("k"))
    return parent, child


def test_hot_and_null_parents_are_split(spark, split_early):
    parent, child = hot_tables(spark)
    out = enrich(parent, child, "k", {"n": row_count()}, {"n": 0})
    by_n = {r["n"]: r["c"] for r in out.groupBy("n").agg(F.count("*").alias("c")).collect()}
    assert by_n == {66_668: 66_667, 0: 66_667, 1: 66_666}
    collected = out.collect()
    assert len(collected) == 200_000
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()


def test_hot_and_null_expected_rows_are_split(spark, split_early):
    parent, child = hot_tables(spark)
    out = missing_from(parent, child.filter("k <> 7"), "k")
    collected = out.collect()
    assert len(collected) == 66_667 * 2 and {r["k"] for r in collected} == {7, None}
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()


def test_missing_from_ignores_repeats(spark, rows):
    expected = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    present = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert rows(missing_from(expected, present, "k")) == sorted([(1, "a"), (1, "b"), (None, "d")], key=repr)


def test_upsert(spark, rows):
    target = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    source = spark.createDataFrame([(2, 20), (3, 30)], "k int, v int")
    once = keyed_upsert(target, source, "k")
    assert rows(once) == [(1, 1), (2, 20), (3, 30)]
    assert rows(keyed_upsert(once, source, "k")) == rows(once)


@pytest.mark.parametrize("bad", [[(2, 20), (2, 21)], [(None, 1)]])
def test_upsert_rejects_duplicate_and_null_keys(spark, bad):
    target = spark.createDataFrame([(1, 1)], "k int, v int")
    with pytest.raises(ExpectationError):
        keyed_upsert(target, spark.createDataFrame(bad, "k int, v int"), "k")


def test_upsert_takes_the_latest_when_told_the_order(spark, rows):
    target = spark.createDataFrame([(1, 1, 0)], "k int, v int, t int")
    source = spark.createDataFrame([(2, 20, 1), (2, 21, 2), (1, 5, 9)], "k int, v int, t int")
    assert rows(keyed_upsert(target, source, "k", order_by="t")) == [(1, 5, 9), (2, 21, 2)]
    with pytest.raises(ExpectationError):
        keyed_upsert(target, spark.createDataFrame([(None, 1, 1)], "k int, v int, t int"), "k", order_by="t")


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.dictionaries(st.integers(0, 9), st.integers(), max_size=8),
    source=st.dictionaries(st.integers(0, 9), st.integers(), max_size=8),
)
def test_upsert_agrees_with_dictionaries(spark, target, source):
    def frame(d):
        return spark.createDataFrame([(k, v % 1000) for k, v in d.items()], "k long, v long")

    out = {r["k"]: r["v"] for r in keyed_upsert(frame(target), frame(source), "k").collect()}
    assert out == {k: v % 1000 for k, v in {**target, **source}.items()}


def test_latest_per_key_breaks_ties_the_same_way(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), ("b", None, "q")], "k string, t int, v string")
    assert rows(latest_per_key(df, "k", "t")) == [("a", 1, "y"), ("b", None, "q")]
    assert rows(latest_per_key(df.repartition(5), "k", "t")) == [("a", 1, "y"), ("b", None, "q")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_aggregates_before_the_shuffle(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan(latest_per_key(events, "user_id", "ts"))
    assert "Window" not in text and text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_max")


def test_missing_from_reduces_the_present_keys_before_the_shuffle(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    left = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    right = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").withColumnRenamed("l_orderkey", "o_orderkey")
    text = plan(missing_from(left, right, "o_orderkey"))
    assert "LeftAnti" in text and text.count("HashAggregate") == 2
    assert "ReadSchema: struct<o_orderkey:bigint>" in text or "struct<l_orderkey:bigint>" in text


def test_a_small_source_leaves_the_target_unshuffled(spark):
    target = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(keyed_upsert(target, target.filter("o_orderkey < 10"), "o_orderkey"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


@pytest.mark.parametrize(
    "left, right, parents, children",
    [
        ("int", "long", [1, 2], [1, 1]),
        ("string", "int", ["1", "2"], [1, 1]),
        ("double", "double", [0.0, 2.0], [-0.0, 0.0]),
        ("date", "timestamp", [date(2020, 1, 1), date(2020, 1, 2)], [datetime(2020, 1, 1), datetime(2020, 1, 1)]),
        ("decimal(10,2)", "decimal(12,4)", [Decimal("1"), Decimal("2")], [Decimal("1"), Decimal("1")]),
        ("string collate utf8_lcase", "string collate utf8_lcase", ["A", "b"], ["a", "A"]),
    ],
)
def test_keys_that_are_equal_but_stored_differently_match(spark, left, right, parents, children):
    parent = spark.createDataFrame([(k,) for k in parents], f"k {left}")
    child = spark.createDataFrame([(k,) for k in children], f"k {right}")
    out = enrich(parent, child, "k", {"n": row_count()}, {"n": 0})
    assert sorted(r["n"] for r in out.select("n").collect()) == [0, 2]


def test_enrichment_by_two_columns(spark, rows):
    parent = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, m string")
    child = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, m string")
    out = enrich(parent, child, ["k", "m"], {"n": row_count()}, {"n": 0})
    assert rows(out) == sorted([(1, "a", 2), (1, "b", 0), (2, None, 0)], key=repr)


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(duplicate_keys(df, "k")) == [(1, 2)]


def test_positional_rename(spark, rows):
    df = spark.createDataFrame([("a", "f", "b", "c")], "_c0 string, _file string, _c1 string, _c2 string")
    assert rows(positional_rename(df, ["x", "y"])) == [("a", "b")]
    with pytest.raises(ValueError, match="3 columns, 4"):
        positional_rename(df, ["x", "y", "z", "w"])


def test_coerce_schema(spark, rows):
    schema = StructType(
        [StructField("b", BooleanType()), StructField("i", IntegerType()), StructField("d", DoubleType())]
    )
    df = spark.createDataFrame([("1.5", "x", "true", "drop")], "d string, i string, b string, extra string")
    out = coerce_schema(df, schema)
    assert out.schema == schema and rows(out) == [(True, None, 1.5)]
    with pytest.raises(ExpectationError, match=r"\['i'\]"):
        coerce_schema(df.drop("i"), schema)


def test_split_rows(spark, rows):
    df = spark.createDataFrame([(1, "a , b\t,,c|d"), (2, None)], "i int, v string")
    assert rows(split_rows(df, "v", "piece")) == [(1, ""), (1, "a"), (1, "b"), (1, "c|d")]
    assert rows(split_rows(df, "v", "piece", "|")) == [(1, "a , b\t,,c"), (1, "d")]


def test_guards(spark):
    df = spark.createDataFrame([(1, None)], "k int, n int")
    assert require_rows(df, "none") is df and require_columns(df, ["k"]) is df
    assert require_unique_key(df, "k") is df and require_set_key(df, "k") is df
    with pytest.raises(ExpectationError, match="empty source"):
        require_rows(df.filter("k > 1"), "empty source")
    with pytest.raises(ExpectationError):
        require_set_key(df, ["k", "n"])


KEYS = st.one_of(st.none(), st.integers(0, 4))


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parents=st.lists(KEYS, max_size=12), children=st.lists(st.tuples(KEYS, st.integers(1, 4)), max_size=20))
def test_enrichment_agrees_with_counting(spark, parents, children):
    """Every parent stays; counts add up to the children each parent row has."""
    parent = spark.createDataFrame([(k, i) for i, k in enumerate(parents)], "k long, i long")
    child = spark.createDataFrame(children, "k long, t long")
    out = enrich(parent, child, "k", {"n": row_count(), "f": any_match(F.col("t") == 3)}, {"n": 0, "f": False})
    got = {r["i"]: (r["n"], r["f"]) for r in out.collect()}
    mine = [[t for c, t in children if k is not None and c == k] for k in parents]
    assert got == {i: (len(t), 3 in t) for i, t in enumerate(mine)}
