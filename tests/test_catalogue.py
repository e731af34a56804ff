"""Tables by name: the pipeline through the catalogue, statistics in plans, and staged folders."""

import re

import pytest

from asfalto import schemas as S
from asfalto.operators.layout import stage
from asfalto.plans import catalogue, medallion, star
from asfalto.session import new_folder, remove_staged, shared_root
from asfalto.sources.accidents import raw_rows
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def named(spark):
    lake = catalogue.NamedLake(spark, new_folder(spark, "named"), "named_lake_test")
    done = medallion.run(lake, raw_rows(spark, SMALL))
    assert all(w.complete for w in done.values())
    yield lake
    spark.sql("DROP DATABASE named_lake_test CASCADE")


def test_pipeline_reads_and_writes_by_name(named, lake):
    for table in S.TABLES:
        assert named[table].schema.names == lake[table].schema.names
        assert named[table].exceptAll(lake[table]).count() == 0 == lake[table].exceptAll(named[table]).count()
    where = {"ano": [1997, None], "uf": ["SP"]}
    names = ["total_acidentes", "total_veiculos"]
    assert sorted(map(tuple, star.ask(named, names, ["ano"], where).collect()), key=str) == sorted(
        map(tuple, star.ask(lake, names, ["ano"], where).collect()), key=str)


def test_plan_knows_row_counts(spark, named):
    own = catalogue.with_statistics(spark)
    rows = named["gold_fato_acidente"].count()
    (plan,) = own.sql(f"EXPLAIN COST SELECT * FROM {named.name('gold_fato_acidente')}").first()
    counted = re.search(r"rowCount=([0-9.]+)(E\+(\d+))?", plan)
    assert round(float(counted[1]) * 10 ** int(counted[3] or 0), -2) == round(rows, -2)
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"


def test_partition_filter_lists_only_its_directories(spark, named):
    plan = spark.table(named.name("gold_fato_acidente")).where("ano = 1997")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and "CatalogFileIndex" in plan or "(1 paths)" in plan


def test_listing_follows_a_rewrite(named):
    table = "gold_dim_veiculo"
    named.save(table, stage(named[table].limit(3), "three"))
    assert {r["tabela"]: r["linhas"] for r in named.listing().collect()}[table] == 3


def test_staged_folders_can_be_removed(spark, monkeypatch, tmp_path):
    from asfalto import session

    monkeypatch.setattr(session, "shared_root", lambda spark: str(tmp_path))
    kept = tmp_path / "other"
    kept.mkdir()
    spark.range(3).write.parquet(new_folder(spark, "x"))
    assert list((tmp_path / "asfalto").iterdir())
    remove_staged(spark)
    assert kept.exists() and not list((tmp_path / "asfalto").iterdir())
    assert shared_root(spark) != str(tmp_path)
