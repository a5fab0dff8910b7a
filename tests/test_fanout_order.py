"""Fan-out forecasts against the joins themselves, and proofs of written orders."""

import random

import pytest
from pyspark.sql import functions as F

from revcast.operators.fanout import assert_growth, fanout_forecast
from revcast.operators.joins import DeriveSpec, JoinSpec, enrich
from revcast.plans.pipeline import check_growth, driver_run, write_forecasts
from revcast.sources.sinks import assert_ordered, order_proof, write_layer, write_ordered

from conftest import SF001, rows


def real_counts(fact, catalog, chain):
    out, df, step = [], fact, 0
    for spec in chain:
        before = df.count()
        df = enrich(df, catalog, [spec])
        if isinstance(spec, JoinSpec):
            step += 1
            out.append((step, spec.right, before, df.count()))
    return out


def test_forecast_equals_the_joins(spark):
    """Null keys that meet null keys, duplicate keys, names that get suffixes, keys that
    come from earlier steps and derivations."""
    rng = random.Random(9)

    def table(n, names, values):
        return spark.createDataFrame([tuple(rng.choice(values) for _ in names) for _ in range(n)],
                                     ", ".join(f"{c} long" for c in names))

    values = [None, None, 1, 2, 3, 4]
    fact = table(60, ["k", "id", "other"], values)
    catalog = {"a": table(8, ["id", "k2", "other"], values), "b": table(7, ["k2", "id"], values), "c": table(5, ["x", "y"], values)}
    chain = (JoinSpec("a", "k", "id", ("_f", "_a")), JoinSpec("b", "k2", "k2", ("_x", "_y")),
             DeriveSpec(lambda df: df.withColumn("key", F.coalesce("other_a", "id_a")), "key", ("other_a", "id_a")),
             JoinSpec("c", "key", "x", null_safe=False), JoinSpec("a", ["k", "y"], ["id", "k2"], ("_1", "_2")))
    want = real_counts(fact, catalog, chain)
    assert any(r[3] > 2 * r[2] for r in want)
    assert rows(fanout_forecast(fact, catalog, chain), "step", "right_table", "rows_in", "rows_out") == want
    # Without being told what a derivation reads, everything is carried.
    unknown = tuple(DeriveSpec(s.fn) if isinstance(s, DeriveSpec) else s for s in chain)
    assert rows(fanout_forecast(fact, catalog, unknown), "step", "right_table", "rows_in", "rows_out") == want
    assert rows(fanout_forecast(fact.where("false"), catalog, chain), "rows_out") == [(0,)] * 4
    assert fanout_forecast(fact, catalog, ()).count() == 0


def test_only_keys_are_read(spark):
    wide = spark.range(20).select((F.col("id") % 3).alias("k"), F.lit("wide").alias("text"), F.lit(1).alias("n"))
    right = spark.range(3).select(F.col("id").alias("key"), F.lit("also wide").alias("text"))
    got = fanout_forecast(wide, {"r": right}, (JoinSpec("r", "k", "key"),))
    assert rows(got) == [(1, "r", 20, 20)]


def test_growth_guard_of_a_run(spark, tmp_path):
    run = driver_run(spark, SF001)
    check_growth(run, 2.0)
    doubled = driver_run(spark, SF001)
    doubled.crm_refs["Ref_Acct"] = doubled.crm_refs["Ref_Acct"].unionAll(doubled.crm_refs["Ref_Acct"])
    with pytest.raises(ValueError, match=r"step 5 \(Ref_Acct\) \d+ -> \d+"):
        write_forecasts(doubled, str(tmp_path), "2020-01-31", max_growth=1.5)
    assert not list(tmp_path.iterdir())
    assert_growth(spark.createDataFrame([(1, "r", 10, 15)], "step int, right_table string, rows_in long, rows_out long"), 1.5)


# --- orders --------------------------------------------------------------

def proof(spark, path, cols):
    return [(r.in_file, r.after) for r in order_proof(spark, path, cols).orderBy("part").collect()]


def test_written_orders_are_proved(spark, tmp_path):
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), i) for i in range(400)]
    df = spark.createDataFrame(data, "a b int, c string, d int".replace("a b", "`a b`")).repartition(7)
    for cols in (["a b"], ["-a b"], ["a b", "-c"], ["-c", "a b", "d"], ["d"]):
        path = write_ordered(df, str(tmp_path / "-".join(cols).replace(" ", "_")), cols)
        assert all(x and y for x, y in proof(spark, path, cols)), cols
        assert_ordered(spark, path, cols)
        assert spark.read.parquet(path).count() == 400
    with pytest.raises(ValueError, match="not in the order"):
        assert_ordered(spark, str(tmp_path / "d"), ["-d"])


def test_disorder_inside_and_between_files_is_found(spark, tmp_path):
    def files(*parts):
        path = str(tmp_path / str(len(list(tmp_path.iterdir()))))
        for number, keys in parts:
            one = str(tmp_path / "one")
            spark.createDataFrame([(k,) for k in keys], "k int").coalesce(1).write.mode("overwrite").parquet(one)
            (part,) = (p for p in (tmp_path / "one").iterdir() if p.suffix == ".parquet")
            (tmp_path / path.rsplit("/", 1)[-1]).mkdir(exist_ok=True)
            part.rename(f"{path}/part-{number:05d}-x.parquet")
        return path

    assert proof(spark, files((0, [1, 2, 2]), (1, [2, 5])), ["k"]) == [(True, True)] * 2
    assert proof(spark, files((0, [1, 3, 2]), (1, [4])), ["k"]) == [(False, True), (True, True)]  # inside a file
    assert proof(spark, files((0, [1, 5]), (1, [4, 9])), ["k"]) == [(True, True), (True, False)]  # over files
    gap = files((0, [1, 5]), (3, [4, 9]), (7, [10]))  # and over skipped numbers
    assert proof(spark, gap, ["k"]) == [(True, True), (True, False), (True, True)]
    assert proof(spark, files((0, [None, 1]), (2, [None])), ["k"]) == [(True, True), (True, False)]


def test_layers_of_a_run_are_written_in_their_orders(spark, tmp_path):
    from revcast.plans.orders import EXTRACT_ORDER

    run = driver_run(spark, SF001)
    frames = {n: run.order_sources[n] for n in EXTRACT_ORDER}
    paths = write_layer(frames, str(tmp_path), "source", order=EXTRACT_ORDER)
    for name, path in paths.items():
        assert_ordered(spark, path, EXTRACT_ORDER[name])
        assert spark.read.parquet(path).count() == frames[name].count()


def test_a_key_for_one_lookup_alone_is_counted_ahead(spark):
    """A product that only serves a lookup nobody reads keeps no rows of an order apart."""
    from revcast.operators import fanout

    rng = random.Random(3)
    fact = spark.createDataFrame([(rng.choice([None, 1, 2]), rng.choice([None, *range(50)])) for _ in range(300)],
                                 "head long, product long")
    catalog = {"h": spark.createDataFrame([(None, 5), (1, 6), (1, None)], "head_id long, opp long"),
               "p": spark.sql("select cast(p as long) product, name from values (null, 'a'), (null, 'b'), (7, 'c'), (8, 'd'), "
                              "(8, 'e') t(p, name)"),
               "o": spark.createDataFrame([(5,), (5,), (None,)], "opp long")}
    for safe in (True, False):
        chain = (JoinSpec("h", "head", "head_id"), JoinSpec("p", "product", "product", null_safe=safe), JoinSpec("o", "opp", "opp"))
        frames = fanout._frames(fact, catalog, chain)
        counted = fanout._counted(frames, fanout._needs(frames, chain), catalog, chain, 1 << 30)
        assert set(counted) == {1}
        assert fanout._needs(frames, chain, counted)[0] == {"head"}
        assert rows(fanout_forecast(fact, catalog, chain), "step", "right_table", "rows_in", "rows_out") == real_counts(
            fact, catalog, chain)
        # Beyond the ceiling the key is carried as before.
        assert rows(fanout_forecast(fact, catalog, chain, 0)) == rows(fanout_forecast(fact, catalog, chain))
    # A key that a derivation may change, or that another step reads, is carried.
    late = (DeriveSpec(lambda df: df.withColumn("product", F.lit(8).cast("long")), "d", ()), *chain[1:2])
    assert rows(fanout_forecast(fact, catalog, late), "rows_out") == [(600,)]
