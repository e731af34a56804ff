"""Report pages against their visuals one by one, and subtotals against plain groupings."""

import re

import pytest
from pyspark.sql import functions as F

from asfalto.plans import dashboard, pages, star
from asfalto.registry.queries import SLICES

SLICERS = [{}, SLICES["slicer_severidade"], SLICES["slicer_uf"], SLICES["slicers_combined"], {"ano": [1800]}]


def cells_of(lake, visual, slicers):
    """A visual by itself, as the cells a page shows."""
    measures, by, within, _ = dashboard.VISUALS[visual]
    found = []
    for row in dashboard.visual(lake, visual, slicers).collect():
        labels = [str(row[c]).lower() if isinstance(row[c], bool) else None if row[c] is None else str(row[c]) for c in by]
        for n, measure in enumerate(measures):
            share = row[dashboard.SHARE] if within is not None and n == 0 else None
            value = None if row[measure] is None else float(row[measure])
            found.append((visual, *([*labels, None, None][:2]), measure, value, share))
    return found


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("slicers", SLICERS, ids=str)
@pytest.mark.parametrize("name", list(pages.PAGES))
def test_page_equals_its_visuals(lake, name, slicers):
    got = ordered(map(tuple, pages.report(lake, name, slicers).collect()))
    assert got == ordered(c for v in pages.PAGES[name] for c in cells_of(lake, v, slicers))


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        df.sparkSession.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name, facts", [
    ("page_1", {star.ACCIDENTS}), ("page_2", {star.ACCIDENTS}), ("page_3", {star.ACCIDENTS}),
    ("page_4", {star.ACCIDENTS, star.VEHICLES, star.VICTIMS}),
])
def test_page_scans_each_fact_once(lake, name, facts):
    plan = plan_of(pages.report(lake, name, SLICES["slicers_combined"]))
    found = re.findall(r"Location: \w+ ?\[\S*?/(gold_fato_\w+)", plan)
    assert sorted(found) == sorted(facts)


def test_year_slicer_prunes_directories_of_a_page(lake):
    plan = plan_of(pages.report(lake, "page_1", {"ano": [1997]}))
    assert re.search(r"PartitionFilters: \[.*ano#\d+ = 1997", plan)


def test_cards_show_without_rows(lake):
    rows = {r.medida: r.valor for r in pages.report(lake, "page_1", {"ano": [1800]}).collect()}
    assert rows == {"total_acidentes": 0, "acidentes_fatais": 0, "taxa_mortalidade": 0, "total_mortos": None,
                    "total_vitimas": None}


def test_grouping_by_a_fixed_column_is_refused(lake, monkeypatch):
    monkeypatch.setitem(dashboard.VISUALS, "odd", (["acidentes_fatais"], ["severidade"], None, None))
    with pytest.raises(ValueError, match="fixes"):
        pages.page(lake, ["odd"])
    with pytest.raises(ValueError, match="fixes"):
        star.ask(lake, ["acidentes_fatais"], ["ano", "severidade"], totals=True)


# --- subtotals


def test_levels_equal_plain_groupings(lake):
    names = ["total_acidentes", "taxa_mortalidade", "media_veiculos", "total_veiculos"]
    rows = star.ask(lake, names, ["uf", "ano"], totals=True)
    for level, by in enumerate([[], ["uf"], ["uf", "ano"]]):
        plain = star.ask(lake, names, by)
        own = rows.where(F.col("nivel") == level).select(*by, *names)
        assert ordered(map(tuple, own.collect())) == ordered(map(tuple, plain.collect()))


def test_group_without_a_member_is_no_subtotal(lake):
    rows = star.ask(lake, ["total_acidentes"], ["uf", "ano"], totals=True).collect()
    whole = [r for r in rows if r.nivel == 0]
    blank = [r for r in rows if r.uf is None and r.nivel == 1]
    assert len(whole) == 1 and len(blank) == 1 and 0 < blank[0].total_acidentes < whole[0].total_acidentes
    assert whole[0].total_acidentes == sum(r.total_acidentes for r in rows if r.nivel == 1)


def test_a_ratio_is_no_mean_of_ratios(lake):
    rows = star.ask(lake, ["taxa_mortalidade", "total_mortos", "total_acidentes"], ["ano"], totals=True).collect()
    (whole,) = [r for r in rows if r.nivel == 0]
    assert whole.taxa_mortalidade == whole.total_mortos / whole.total_acidentes
