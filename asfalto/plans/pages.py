"""Report pages: all visuals of a page, under the slicers they share, from one scan of each fact.

The rows of a fact are combined once per key and column that any of the page's visuals needs. Grouping sets over
these few rows give the groups of all visuals together, and the grouping id of a group says which visuals
it belongs to. So a page costs what its widest visual costs.

A measure that fixes a column (fatal accidents) must not see the slicer on it, while its neighbours must. Such a
slicer therefore filters no rows; it becomes a condition inside the other measures' aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asfalto.functions.rows import safe_ratio
from asfalto.plans import star as model
from asfalto.plans.dashboard import SHARE, VISUALS
from asfalto.plans.star import MEASURES, Filters, Measure, Ratio, Star

# Page -> its visuals; the five cards of the first page are one visual.
PAGES = {
    "page_1": ["v_kpis", "v_tendencia_anual", "v_por_ocorrencia", "v_por_severidade", "v_por_sentido"],
    "page_2": ["v_por_mes", "v_por_dia_semana", "v_fim_de_semana", "v_por_hora"],
    "page_3": ["v_por_uf", "v_top15_rodovias", "v_por_concessionaria"],
    "page_4": ["v_veiculos", "v_vitimas", "v_severidade_por_tipo"],
}
CELLS = ["visual", "grupo", "subgrupo", "medida", "valor", SHARE]


def _bases(names: Sequence[str]) -> dict[str, Measure]:
    """Additive measures that the named ones are made of."""
    return {base: MEASURES[base] for name in names for base in model.bases(name)}


def _fact_of(visual: str) -> str:
    facts = {m.fact for m in _bases(VISUALS[visual][0]).values()}
    if len(facts) != 1:
        raise ValueError(f"{visual} takes measures of several facts")
    return facts.pop()


def _label(column: str | None) -> Column:
    return F.lit(None).cast("string") if column is None else F.col(column).cast("string")


def _cells(visual: str) -> list[Column]:
    """A struct per measure of a group of this visual."""
    names, by, within, rows = VISUALS[visual]
    columns = [*by, None, None][:2]
    found = []
    for n, name in enumerate(names):
        measure = MEASURES[name]
        if isinstance(measure, Ratio):
            value = safe_ratio(F.col(measure.numerator), F.col(measure.denominator))
        else:
            value = F.col(name)
        found.append(F.struct(
            F.lit(visual).alias("visual"), _label(columns[0]).alias("grupo"), _label(columns[1]).alias("subgrupo"),
            F.lit(name).alias("medida"), value.cast("double").alias("valor"),
            # what the hundred per cent of a share are taken over, and how many rows a ranking keeps
            F.lit(within is not None and n == 0).alias("_shared"),
            _label(within[0] if within else None).alias("_whole"),
            F.lit(rows if n == 0 else None).cast("int").alias("_rows"),
        ))
    return found


def _fact_cells(star: Star, fact: str, visuals: Sequence[str], slicers: Filters) -> DataFrame:
    """Cells of all visuals of one fact: one scan, one aggregation of its rows."""
    measures = _bases([m for v in visuals for m in VISUALS[v][0]])
    fixed = {c for m in measures.values() for c in m.replaced(list(slicers))}
    for visual in visuals:
        for measure in _bases(VISUALS[visual][0]).values():
            if measure.replaced(VISUALS[visual][1]):
                raise ValueError(f"{visual} is grouped by a column that one of its measures fixes")
    frame = model.restrict(star, fact, {c: v for c, v in slicers.items() if c not in fixed})
    # the slicers on fixed columns, and whether a row is in the report at all
    inside = reduce(lambda a, b: a & b, [model.matches(c, slicers[c]) for c in sorted(fixed)], F.lit(True))

    def partial(measure: Measure) -> Column:
        free = [model.matches(c, slicers[c]) for c in sorted(fixed - set(measure.context))]
        return measure.partial(reduce(lambda a, b: a & b, free, F.lit(True)))

    wanted = list(dict.fromkeys(c for v in visuals for c in VISUALS[v][1]))
    dimensions, own = model.split_grouping(star, fact, wanted)
    sums = frame.groupBy(*own, *[key for _, key in dimensions]).agg(
        F.count(F.when(inside, F.lit(1))).alias("_in"), *[partial(m).alias(n) for n, m in measures.items()])
    for (dimension, key), columns in dimensions.items():
        sums = sums.join(star[dimension].select(key, *columns), key, "left")
    # grouping sets of no rows have no group at all, but cards show then too
    nothing = frame.sparkSession.range(1).select(F.lit(0).cast("long").alias("_in"))
    sums = sums.unionByName(nothing, allowMissingColumns=True)
    totals = [F.sum("_in").alias("_in")] + [
        (F.coalesce(F.sum(n), F.lit(0)) if m.column is None else F.sum(n)).alias(n) for n, m in measures.items()]
    sets = list(dict.fromkeys(tuple(VISUALS[v][1]) for v in visuals))
    if wanted:
        grouped = sums.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in wanted]).agg(
            F.grouping_id().alias("_set"), *totals)
    else:
        grouped = sums.agg(F.lit(0).cast("long").alias("_set"), *totals)
    # grouping_id has a bit for every column that a set leaves out, the first column in the highest
    number = {s: sum(1 << (len(wanted) - 1 - n) for n, c in enumerate(wanted) if c not in s) for s in sets}
    routed = reduce(
        lambda so_far, s: so_far.when(F.col("_set") == number[s], F.array(
            *[cell for v in visuals if tuple(VISUALS[v][1]) == s for cell in _cells(v)])),
        sets, F.when(F.lit(False), None),
    )
    # a card shows even when nothing is left; a group with no row under the slicers is no group
    shown = grouped.where((F.col("_in") > 0) | (F.col("_set") == number.get((), -1)))
    return shown.select(F.explode(routed).alias("_cell")).select("_cell.*")


def page(star: Star, visuals: Sequence[str], slicers: Filters | None = None) -> DataFrame:
    """Every visual's cells under the slicers: visual, grupo, subgrupo, medida, valor, participacao.

    `grupo` and `subgrupo` are the members of the visual's grouping as text, NULL for rows without a member and where
    it has none. A visual that shows shares has them beside its first measure; one that ranks keeps its rows.
    """
    by_fact: dict[str, list[str]] = {}
    for visual in visuals:
        by_fact.setdefault(_fact_of(visual), []).append(visual)
    cells = reduce(DataFrame.unionByName, [
        _fact_cells(star, fact, own, dict(slicers or {})) for fact, own in by_fact.items()])
    whole = F.sum("valor").over(Window.partitionBy("visual", "medida", "_whole"))
    place = F.row_number().over(Window.partitionBy("visual", "medida").orderBy(F.desc("valor"), F.asc("grupo")))
    shared = cells.withColumns({SHARE: F.when(F.col("_shared"), safe_ratio(F.col("valor"), whole)), "_place": place})
    return shared.where(F.col("_rows").isNull() | (F.col("_place") <= F.col("_rows"))).select(*CELLS)


def report(star: Mapping[str, DataFrame], name: str, slicers: Filters | None = None) -> DataFrame:
    return page(star, PAGES[name], slicers)
