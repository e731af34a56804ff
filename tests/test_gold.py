"""Dimensions, facts, measures and layout: invariants, plans, and small exact cases."""

import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.functions import zcurve
from asfalto.operators import keys, layout, quality, reshape
from asfalto.plans import dashboard, dims, facts, medallion, star
from asfalto.plans.silver import operator_names, silver
from asfalto.sources.accidents import raw_rows
from asfalto.session import new_folder
from tests.conftest import SMALL

FACTS = list(medallion.FACTS)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_keys_are_dense_and_unique(lake):
    for table, key in (
        ("gold_dim_concessionaria", "id_concessionaria"),
        ("gold_dim_rodovia", "id_rodovia"),
        ("gold_dim_tipo_acidente", "id_tipo_acidente"),
        ("gold_dim_veiculo", "id_veiculo"),
        ("gold_dim_tipo_vitima", "id_tipo_vitima"),
    ):
        ids = sorted(r[0] for r in lake[table].select(key).collect())
        assert ids == list(range(1, len(ids) + 1)), table
    dates = lake["gold_dim_data"]
    assert dates.count() == dates.select("id_data").distinct().count()


def test_numbers_follow_key_order(spark, lake):
    members = dims.members(lake["silver_acidentes"], ["uf", "rodovia", "data"])
    order = ["uf", "rodovia", "data"]
    numbered = keys.surrogate_key(members, order, "id").orderBy("id").collect()
    expected = members.orderBy(*order).collect()
    assert len(numbered) > 1000
    assert [(n + 1, *row) for n, row in enumerate(expected)] == [tuple(r) for r in numbered]


def test_rebuilding_dimensions_gives_the_same_rows(lake):
    again = dims.dim_rodovia(lake["silver_acidentes"])
    assert again.exceptAll(lake["gold_dim_rodovia"]).count() == 0


def test_facts_keep_every_accident_and_every_person(lake):
    rows = lake["silver_acidentes"]
    totals = rows.agg(F.count("*"), F.sum("total_veiculos"), F.sum("total_vitimas")).first()
    accidents = lake[star.ACCIDENTS]
    assert accidents.agg(F.count("*"), F.sum("total_veiculos"), F.sum("total_vitimas")).first() == totals
    assert lake[star.VEHICLES].agg(F.sum("quantidade")).first()[0] == totals[1]
    assert lake[star.VICTIMS].agg(F.sum("quantidade")).first()[0] == totals[2]


def test_every_known_key_resolves(lake):
    accidents = lake[star.ACCIDENTS]
    for fact, key, dimension in star.RELATIONSHIPS:
        lost = lake[fact].filter(F.col(key).isNotNull()).join(lake[dimension], key, "left_anti")
        assert lost.count() == 0, (fact, key)
    without = lake["silver_acidentes"].filter("data IS NULL").count()
    assert without > 0
    assert accidents.filter("id_data IS NULL AND ano IS NULL").count() == without
    assert accidents.filter("id_concessionaria IS NULL").count() == 0


def test_there_are_twelve_relationships():
    assert len(star.RELATIONSHIPS) == len(set(star.RELATIONSHIPS)) == 12


def test_table_schemas(lake):
    for table, (schema, _) in S.TABLES.items():
        stored = {f.name: f.dataType for f in lake.spark.read.parquet(lake.path(table)).schema}
        assert stored == {f.name: f.dataType for f in schema}, table


def test_unpivot_drops_zero_null_and_negative(spark):
    wide = spark.createDataFrame(
        [(1, 2, 0, None), (2, None, None, None), (3, -1, 4, 1), (4, -5, 0, 2)], "id int, a int, b int, c int"
    )
    got = reshape.unpivot_counts(wide, ["id"], ["a", "b", "c"], "tipo")
    assert sorted(map(tuple, got.collect())) == [(1, "a", 2), (3, "b", 4), (3, "c", 1), (4, "c", 2)]


def test_null_state_matches_no_road(spark):
    roads = spark.createDataFrame([(1, "BR-1", "SP")], S.DIM_RODOVIA)
    rows = spark.createDataFrame([("BR-1", "SP"), ("BR-1", None), ("BR-2", "SP")], "rodovia string, uf string")
    got = keys.resolve_key(rows, roads, ["rodovia", "uf"], "id_rodovia").collect()
    assert sorted((r["uf"] or "", r["id_rodovia"]) for r in got if r["rodovia"] == "BR-1") == [("", None), ("SP", 1)]
    assert len(got) == 3


# --- plans -----------------------------------------------------------------------------


def test_facts_are_built_without_shuffling_rows(lake):
    for table, build in medallion.FACTS.items():
        plan = plan_of(build(lake["silver_acidentes"], lake))
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan, table
        assert "BroadcastHashJoin" in plan


def test_operator_lookup_is_broadcast_by_its_known_size(spark):
    plan = plan_of(silver(raw_rows(spark, SMALL)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "LocalTableScan" in plan
    assert operator_names(spark).count() == 35


def test_a_dimension_past_the_threshold_is_not_broadcast(spark, lake):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        fact = facts.fato_acidente(lake["silver_acidentes"], lake)
        assert "BroadcastHashJoin" not in plan_of(fact)
        ours = fact.drop("id_acidente")
        assert ours.exceptAll(lake[star.ACCIDENTS].drop("id_acidente")).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_year_slicer_prunes_directories_and_needs_no_dimension(lake):
    plan = plan_of(star.ask(lake, ["total_acidentes", "total_mortos"], ["ano"], {"ano": [1997]}))
    assert "PartitionFilters: [isnotnull(ano" in plan or "PartitionFilters: [(ano" in plan
    assert "Join" not in plan


def test_reports_read_only_their_columns(lake):
    plan = plan_of(star.ask(lake, ["total_mortos"], ["ano"]))
    assert "ReadSchema: struct<mortos:int>" in plan


# --- measures --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tiny(spark):
    """Three accidents in two years, one of them without a date."""
    day = [(20200101, date(2020, 1, 1), 2020, 1, 1, 1, 4, "January", False),
           (20210301, date(2021, 3, 1), 2021, 3, 1, 1, 2, "March", False)]
    accident = lambda i, day, sev, dead, road: (
        i, day, None if day is None else day // 10000, 1, road, 1, 1.0, 5, "Norte", "Com Vítima", sev, 2, 3,
        dead, 0, 0, 0, 0,
    )
    return {
        "gold_dim_data": spark.createDataFrame(day, S.DIM_DATA),
        "gold_dim_concessionaria": spark.createDataFrame([(1, "CRO")], S.DIM_CONCESSIONARIA),
        "gold_dim_rodovia": spark.createDataFrame([(1, "BR-1", "SP")], S.DIM_RODOVIA),
        "gold_dim_tipo_acidente": spark.createDataFrame([(1, "Choque")], S.DIM_TIPO_ACIDENTE),
        "gold_dim_veiculo": dims.dim_veiculo(spark),
        "gold_dim_tipo_vitima": dims.dim_tipo_vitima(spark),
        star.ACCIDENTS: spark.createDataFrame(
            [accident(1, 20200101, "Fatal", 2, 1), accident(2, 20210301, "Leve", 0, None),
             accident(3, None, "Fatal", 1, 1)], S.FATO_ACIDENTE),
        star.VEHICLES: spark.createDataFrame([(1, 20200101, 2020, 1, 1, 3, 2)], S.FATO_VEICULO),
        star.VICTIMS: spark.createDataFrame([(2, 20210301, 2021, 1, None, 5, 7)], S.FATO_VITIMA),
    }


def answer(tiny, *args, **kwargs):
    return {tuple(r) for r in star.ask(tiny, *args, **kwargs).collect()}


def test_fatal_count_replaces_the_severity_slicer(tiny):
    got = answer(tiny, ["total_acidentes", "acidentes_fatais"], [], {"severidade": ["Leve"]})
    assert got == {(1, 2)}


def test_fatal_count_ignores_grouping_by_severity(tiny):
    got = answer(tiny, ["total_acidentes", "acidentes_fatais"], ["severidade"])
    assert got == {("Fatal", 2, 2), ("Leve", 1, 2)}
    by_year = answer(tiny, ["acidentes_fatais"], ["ano", "severidade"])
    assert by_year == {(2020, "Fatal", 1), (2021, "Leve", 0), (None, "Fatal", 1)}


def test_ratio_is_taken_at_the_level_of_the_answer(tiny):
    assert answer(tiny, ["taxa_mortalidade", "media_veiculos"]) == {(1.0, 2.0)}
    assert answer(tiny, ["taxa_mortalidade"], ["ano"]) == {(2020, 2.0), (2021, 0.0), (None, 1.0)}


def test_ratio_over_nothing_is_zero(tiny):
    got = answer(tiny, ["total_acidentes", "taxa_mortalidade"], [], {"ano": [1900]})
    assert got == {(0, 0.0)}


def test_blank_member_is_a_group_and_can_be_chosen(tiny):
    assert answer(tiny, ["total_acidentes"], ["uf"]) == {("SP", 2), (None, 1)}
    assert answer(tiny, ["total_acidentes"], [], {"uf": [None]}) == {(1,)}
    assert answer(tiny, ["total_acidentes"], [], {"uf": ["SP", None]}) == {(3,)}
    assert answer(tiny, ["total_acidentes"], [], {"ano": [None, 2020]}) == {(2,)}


def test_severity_slicer_restricts_no_other_fact(tiny):
    got = answer(tiny, ["total_acidentes", "total_veiculos"], [], {"severidade": ["Leve"]})
    assert got == {(1, 2)}


def test_facts_meet_under_a_shared_dimension(tiny):
    got = answer(tiny, ["total_veiculos", "vitimas_detalhado"], ["ano", "uf"])
    assert got == {(2020, "SP", 2, None), (2021, None, None, 7)}


def test_unknown_attribute_is_an_error(tiny):
    with pytest.raises(ValueError):
        star.ask(tiny, ["total_acidentes"], ["estado"])
    with pytest.raises(ValueError):
        star.ask(tiny, ["total_veiculos"], ["severidade"])


def test_top_breaks_ties_by_name(spark):
    frame = spark.createDataFrame([("c", 1), ("b", 2), ("a", 2)], "k string, n int")
    assert [r["k"] for r in dashboard.top(frame, "n", 2, "k").collect()] == ["a", "b"]


def test_distribution_is_descending(lake):
    counts = [r["registros"] for r in quality.distribution(lake["silver_acidentes"], "severidade").collect()]
    assert counts == sorted(counts, reverse=True)


def test_verdicts():
    base = {"linhas": 3, "datas_validas": 3, "nulos_km": 0}
    assert quality.verdict(base) == "OK"
    assert quality.verdict({**base, "nulos_km": 1}) == "ALERTA"
    assert quality.verdict({**base, "linhas": 0}) == "ERRO"


# --- layout ----------------------------------------------------------------------------


def test_bits_are_interleaved(spark):
    frame = spark.createDataFrame([(0b11, 0b00), (0b00, 0b11), (0b10, 0b01)], "a int, b int")
    got = [r[0] for r in frame.select(zcurve.interleave([F.col("a"), F.col("b")], 2)).collect()]
    assert got == [0b0101, 0b1010, 0b0110]


def test_buckets_match_a_linear_count(spark):
    bounds = [3, 7, 20]
    frame = spark.createDataFrame([(v,) for v in (None, 1, 3, 6, 7, 19, 20, 99)], "v int")
    got = [r[0] for r in frame.select(zcurve.bucket_of(F.col("v"), bounds)).collect()]
    assert got == [0, 0, 1, 1, 2, 2, 3, 3]


def test_zorder_keeps_rows_and_narrows_files(spark, lake):
    source, target = new_folder(spark, "t-flat"), new_folder(spark, "t-z")
    columns = medallion.CLUSTERING[star.ACCIDENTS]
    lake[star.ACCIDENTS].repartition(16).write.parquet(source)
    _, stored = layout.file_stats(spark, source)
    done = layout.zorder(spark, source, target, columns, tie_break=["id_acidente"], target_bytes=stored // 15)
    assert done.complete
    before, after = spark.read.parquet(source), spark.read.parquet(target)
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0

    def files_to_read(df, column):
        middle = lake[star.ACCIDENTS].select(F.percentile_approx(column, 0.4)).first()[0]
        ranges = df.groupBy(F.input_file_name()).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        return ranges.filter((F.col("lo") <= middle) & (F.col("hi") >= middle)).count(), ranges.count()

    for column in columns:
        hit, files = files_to_read(after, column)
        assert hit < files, column
        assert files_to_read(before, column)[0] == 16


def test_rows_with_equal_curve_position_are_split(spark):
    source, target = new_folder(spark, "t-hot"), new_folder(spark, "t-hot-z")
    spark.range(20_000).selectExpr("1 as a", "1 as b", "id").write.parquet(source)
    _, stored = layout.file_stats(spark, source)
    layout.zorder(spark, source, target, ["a", "b"], tie_break=["id"], target_bytes=stored // 8)
    assert layout.file_stats(spark, target)[0] >= 6


def test_compact_merges_files(spark, lake):
    source, target = new_folder(spark, "t-many"), new_folder(spark, "t-few")
    lake[star.ACCIDENTS].repartition(40).write.partitionBy("ano").parquet(source)
    done = layout.compact(spark, source, target, ["ano"])
    assert done.complete
    assert layout.file_stats(spark, target)[0] < layout.file_stats(spark, source)[0] / 10
    back = layout.read_table(spark, target, S.FATO_ACIDENTE)
    assert back.exceptAll(lake[star.ACCIDENTS]).count() == 0


def test_a_hot_directory_is_written_by_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    try:
        path = new_folder(spark, "t-hot-dir")
        hot = spark.range(200_000).selectExpr("id", "uuid() as texto", "if(id % 3 = 0, 1, id % 50) as ano")
        layout.write_table(hot, path, partitions=["ano"])
        files = spark.read.parquet(path).filter("ano = 1").select(F.input_file_name()).distinct().count()
        assert files > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_append_counts_only_its_own_rows(spark):
    path = new_folder(spark, "t-append")
    first = layout.write_table(spark.range(5), path, mode="append")
    second = layout.write_table(spark.range(3), path, mode="append")
    assert (first.written, second.written) == (5, 3) and first.complete and second.complete


def test_append_check_reads_only_its_own_files(spark, tmp_path, monkeypatch):
    """Old files are not opened: one of them is no Parquet file at all. A concurrent writer's rows do not count."""
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    old = next((tmp_path / "t").glob("part-*.parquet"))
    old.write_bytes(b"not a table")
    (tmp_path / "t" / f".{old.name}.crc").unlink(missing_ok=True)
    os.utime(old, (1, 1))
    plain = layout._appended

    def beside_another(spark, path, *rest):
        spark.range(7).write.mode("append").parquet(path)
        return plain(spark, path, *rest)

    monkeypatch.setattr(layout, "_appended", beside_another)
    done = layout.write_table(spark.range(5), path, mode="append")
    assert (done.written, done.read_back) == (5, 5)
    again = layout.write_table(spark.range(5), path, mode="append")
    assert again.complete


def test_append_check_sees_lost_rows(spark, tmp_path, monkeypatch):
    path, plain = str(tmp_path / "t"), layout._appended

    def after_a_loss(spark, path, *rest):
        next((tmp_path / "t").glob("part-*.parquet")).unlink()
        return plain(spark, path, *rest)

    monkeypatch.setattr(layout, "_appended", after_a_loss)
    done = layout.write_table(spark.range(100).repartition(4), path, mode="append")
    assert done.written == 100 and not done.complete


# --- accident cards


def test_cards_multiply_nothing(lake):
    cards = star.accident_cards(lake)
    rows = cards.select(
        F.size("acidentes").alias("n"),
        F.expr("aggregate(acidentes, 0L, (s, a) -> s + a.total_veiculos)").alias("veiculos"),
        F.expr("aggregate(veiculos, 0L, (s, v) -> s + v.quantidade)").alias("soma_veiculos"),
        F.expr("aggregate(acidentes, 0L, (s, a) -> s + a.total_vitimas)").alias("vitimas"),
        F.expr("aggregate(vitimas, 0L, (s, v) -> s + v.quantidade)").alias("soma_vitimas"), "colisao",
    )
    assert rows.where("veiculos <> soma_veiculos or vitimas <> soma_vitimas or colisao").count() == 0
    assert rows.agg(F.sum("n")).first()[0] == lake[star.ACCIDENTS].count()
    assert cards.count() == lake["silver_acidentes"].select(
        "data", "concessionaria", "km", "hora", "tipo_de_acidente").distinct().count()


def test_cards_of_some_accidents(lake):
    ids = lake[star.ACCIDENTS].where("severidade = 'Fatal' and total_veiculos = 0").limit(3)
    cards = star.accident_cards(lake, ids).collect()
    assert {c.id_acidente for c in cards} == {r.id_acidente for r in ids.collect()}
    assert all(c.veiculos is not None and c.vitimas for c in cards)


def test_accidents_that_share_an_id_are_told_apart(lake):
    """Two accidents of different columns under one id: two cards, marked, each with all children of the id."""
    fact = lake[star.ACCIDENTS].where("total_veiculos > 0 and km is not null").limit(2).withColumn(
        "id_acidente", F.lit(7).cast("long"))
    rows = fact.withColumn("km", F.monotonically_increasing_id().cast("double"))
    child = lake[star.VEHICLES].limit(1).withColumn("id_acidente", F.lit(7).cast("long"))
    tables = {t: lake[t] for t in lake} | {star.ACCIDENTS: rows.cache(), star.VEHICLES: child.cache()}
    cards = star.accident_cards(tables).collect()
    assert len(cards) == 2 and all(c.colisao and len(c.veiculos) == 1 and len(c.acidentes) == 1 for c in cards)
    assert all(c.vitimas == [] for c in cards)


# --- file index, curve bits, compaction in place


@pytest.fixture(scope="module")
def clustered(spark, lake):
    root = new_folder(spark, "clustered-test")
    medallion.optimize(lake, root, target_bytes=1 << 13)
    return medallion.ClusteredLake(lake, root)


def test_clustered_copies_give_the_same_answers(lake, clustered):
    names = ["total_acidentes", "total_mortos", "acidentes_fatais", "total_veiculos", "vitimas_detalhado"]
    for where in (
        {"ano": [1997], "concessionaria": ["VIA040"], "rodovia": ["BR-101"]}, {"uf": ["SP", None]}, {},
        {"severidade": ["Grave"], "concessionaria": ["VIA040"]}, {"rodovia": ["no such road"]}, {"ano": [None, 1996]},
    ):
        plain = star.ask(lake, names, ["ano", "uf"], where)
        assert sorted(map(tuple, star.ask(clustered, names, ["ano", "uf"], where).collect()), key=str) == sorted(
            map(tuple, plain.collect()), key=str)


def test_filters_choose_files_by_the_index(lake, clustered):
    known = lake["silver_acidentes"].where("ano = 1997 and rodovia is not null and uf is not null")
    one = known.orderBy("concessionaria", "rodovia").first()
    where = {"ano": [1997], "concessionaria": [one["concessionaria"]], "rodovia": [one["rodovia"]]}
    for fact in (star.ACCIDENTS, star.VEHICLES):
        every = len(lake.spark.read.parquet(clustered.path(fact)).inputFiles())
        chosen = star.restrict(clustered, fact, where).inputFiles()
        read = {f for f in chosen if f"/{fact}/" in f}
        assert every >= 9 and 0 < len(read) < every / 3
        # and among the files of the year, the operator alone rules some out
        year = {f for f in star.restrict(clustered, fact, {"ano": [1997]}).inputFiles() if f"/{fact}/" in f}
        assert read <= year


def test_bits_follow_the_number_of_files():
    assert zcurve.bits_for(1, 3) == 2 and zcurve.bits_for(1 << 15, 3) == 7
    assert zcurve.bits_for(1 << 60, 3) == 20 and zcurve.bits_for(0, 1) == 6


def test_buckets_past_the_old_limit(spark):
    bounds = list(range(0, 10_000, 3))
    frame = spark.range(-5, 10_010)
    got = frame.select(zcurve.bucket_of(F.col("id"), bounds).alias("b"), "id").collect()
    assert all(r.b == sum(x <= r.id for x in bounds[max(0, r.b - 3) : r.b + 3]) + max(0, r.b - 3) for r in got)


def files_of(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_only_crowded_directories_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4000).select("id", (F.col("id") % 4).cast("int").alias("ano"))
    rows.where("ano < 3").coalesce(1).write.partitionBy("ano").parquet(path)
    null = rows.where("ano = 3").withColumn("ano", F.lit(None).cast("int"))
    for part in (rows.where("ano = 3"), null):
        part.repartition(6).write.mode("append").partitionBy("ano").parquet(path)
    before, want = files_of(path), sorted(map(tuple, spark.read.parquet(path).collect()), key=str)
    changed = layout.compact_partitions(spark, path, ["ano"], target_bytes=1 << 20)
    after = files_of(path)
    assert sorted(f.rsplit("=", 1)[1] for f in changed) == ["3", "__HIVE_DEFAULT_PARTITION__"]
    kept = {p for p in before if "ano=0" in str(p) or "ano=1" in str(p) or "ano=2" in str(p)}
    assert {p: before[p] for p in kept} == {p: t for p, t in after.items() if p in kept}
    assert len(after) == len(kept) + 2
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == want
    assert layout.compact_partitions(spark, path, ["ano"], target_bytes=1 << 20) == []


def test_merged_files_are_about_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200_000).select(F.xxhash64("id").alias("v"), F.lit(1).alias("ano"))
    rows.repartition(40).write.partitionBy("ano").parquet(path)
    stored = sum(p.stat().st_size for p in files_of(path))
    layout.compact_partitions(spark, path, ["ano"], target_bytes=stored // 4)
    sizes = [p.stat().st_size for p in files_of(path)]
    assert 4 <= len(sizes) <= 5 and stored / 8 < sum(sizes) / len(sizes) < stored / 2


def test_silver_write_takes_the_quality_metrics_along(spark):
    lake = medallion.Lake(spark, new_folder(spark, "t-lake"))
    raw = raw_rows(spark, SMALL)
    done = medallion.build_silver(lake, raw)
    gate = {r["verificacao"]: r["valor"] for r in quality.dq_gate(silver(raw, audit=True)).collect()}
    assert done.complete and done.metrics.pop("veredito") == "ALERTA"
    assert done.metrics == gate


def test_optimize_keeps_every_fact(spark, lake):
    done = medallion.optimize(lake, new_folder(spark, "t-optimized"))
    assert set(done) == set(FACTS) and all(w.complete for w in done.values())


def test_published_tables_answer_sql(lake):
    lake.publish()
    got = lake.spark.sql("SELECT count(*) FROM gold_fato_acidente").first()[0]
    assert got == lake[star.ACCIDENTS].count()




def test_few_directories_are_written_without_a_shuffle(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 3).withColumn("ano", (F.col("id") % 4).cast("int"))
    done = layout.write_table(rows, str(tmp_path / "t"), partitions=["ano"], gather=False)
    assert done.complete and done.written == 3000
    assert all(len(list(d.glob("*.parquet"))) == 3 for d in (tmp_path / "t").glob("ano=*"))


def test_cards_shuffle_each_fact_once(lake):
    """One exchange a fact; grouping by more columns, the collision flag and the joins need no other."""
    cards = star.accident_cards(lake)
    plan = cards._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 3, plan


def test_few_bounds_are_compared_and_give_the_same_buckets(spark):
    bounds = list(range(0, 200, 2))
    values = spark.createDataFrame([(v,) for v in [None, *range(-3, 205)]], "v int")
    for some in (bounds[:1], bounds[:7], bounds[:64], bounds):
        got = values.select("v", zcurve.bucket_of(F.col("v"), some).alias("b")).collect()
        assert all(r.b == (0 if r.v is None else sum(r.v >= x for x in some)) for r in got)
    assert "aggregate" not in str(zcurve.bucket_of(F.col("v"), bounds[:7]))


def test_accident_ids_meet_in_bounded_parts(spark, monkeypatch):
    from asfalto.registry import queries

    expected = queries.accident_id(spark, SMALL).collect()
    monkeypatch.setattr(queries, "MEETING_ROWS", 1_000)
    counted = queries.accident_id(spark, SMALL)
    assert counted.collect() == expected
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    rows = expected[0]["linhas"]
    assert plan.count("RepartitionByExpression [id_acidente") == 3 and f", {-(-rows // 1_000)}" in plan
