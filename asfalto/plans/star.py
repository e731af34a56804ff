"""Measures under a grouping and filters, over the constellation schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.functions.rows import safe_ratio

ACCIDENTS = "gold_fato_acidente"
VEHICLES = "gold_fato_veiculo_acidente"
VICTIMS = "gold_fato_vitima_acidente"

# The relationships, dimension 1 -> * fact: (fact, foreign key, dimension).
RELATIONSHIPS = [
    *[
        (fact, key, dimension)
        for fact in (ACCIDENTS, VEHICLES, VICTIMS)
        for key, dimension in (
            ("id_data", "gold_dim_data"),
            ("id_concessionaria", "gold_dim_concessionaria"),
            ("id_rodovia", "gold_dim_rodovia"),
        )
    ],
    (ACCIDENTS, "id_tipo_acidente", "gold_dim_tipo_acidente"),
    (VEHICLES, "id_veiculo", "gold_dim_veiculo"),
    (VICTIMS, "id_tipo_vitima", "gold_dim_tipo_vitima"),
]

# Attribute -> dimension that holds it. Others are columns of the accident fact.
# `ano` is in every fact too, as the partition column, and follows from the date key: grouping
# and filtering on it need no join, and the filter prunes directories.
ATTRIBUTES = {
    **{c: "gold_dim_data" for c in ("data", "mes", "dia", "trimestre", "dia_semana", "nome_mes",
                                    "fim_de_semana")},
    "concessionaria": "gold_dim_concessionaria",
    "rodovia": "gold_dim_rodovia",
    "uf": "gold_dim_rodovia",
    "tipo_de_acidente": "gold_dim_tipo_acidente",
    "tipo_veiculo": "gold_dim_veiculo",
    "tipo_vitima": "gold_dim_tipo_vitima",
}


@dataclass(frozen=True)
class Measure:
    """An additive aggregate of one fact: a row count, or the sum of a column.

    `context` fixes fact columns whatever the query says of them: a filter or grouping on
    those columns does not reach the measure.
    """

    fact: str
    column: str | None = None
    context: Mapping[str, str] = field(default_factory=dict)

    def partial(self, condition: Column | None = None) -> Column:
        """The aggregate over fact rows, or over those that `condition` holds for."""
        value = F.lit(1) if self.column is None else F.col(self.column)
        if condition is not None:
            value = F.when(condition, value)
        for column, fixed in self.context.items():
            value = F.when(F.col(column) == fixed, value)
        return F.count(value) if self.column is None else F.sum(value)

    def replaced(self, touched: Sequence[str]) -> dict[str, str]:
        """The fixed columns that the query also filters or groups by."""
        return {c: v for c, v in self.context.items() if c in touched}


@dataclass(frozen=True)
class Ratio:
    """Quotient of two additive measures, taken at the level of the answer; 0 when empty."""

    numerator: str
    denominator: str


MEASURES: dict[str, Measure | Ratio] = {
    "total_acidentes": Measure(ACCIDENTS),
    "total_mortos": Measure(ACCIDENTS, "mortos"),
    "total_vitimas": Measure(ACCIDENTS, "total_vitimas"),
    "soma_veiculos": Measure(ACCIDENTS, "total_veiculos"),
    "acidentes_fatais": Measure(ACCIDENTS, context={"severidade": S.FATAL}),
    "taxa_mortalidade": Ratio("total_mortos", "total_acidentes"),
    "media_veiculos": Ratio("soma_veiculos", "total_acidentes"),
    "total_veiculos": Measure(VEHICLES, "quantidade"),
    "vitimas_detalhado": Measure(VICTIMS, "quantidade"),
}

LEVEL = "nivel"  # of a row with subtotals: by how many columns it is grouped

Filters = Mapping[str, Sequence]
Star = Mapping[str, DataFrame]


def bases(name: str) -> list[str]:
    """The additive measures that a measure is made of."""
    measure = MEASURES[name]
    return [measure.numerator, measure.denominator] if isinstance(measure, Ratio) else [name]


def _link(fact: str, dimension: str) -> str | None:
    return next((k for f, k, d in RELATIONSHIPS if (f, d) == (fact, dimension)), None)


def _columns(star: Star, fact: str) -> Sequence[str]:
    """Columns of a fact; of a clustered copy without opening it, which would list all its files."""
    return S.TABLES[fact][0].names if hasattr(star, "narrowed") else star[fact].columns


def matches(column: str, values: Sequence) -> Column:
    known = [v for v in values if v is not None]
    hit = F.col(column).isin(known)
    return hit if len(known) == len(values) else hit | F.col(column).isNull()


def restrict(star: Mapping[str, DataFrame], fact: str, where: Filters) -> DataFrame:
    """Fact rows left by the filters.

    A dimension filter flows to the fact through its key as a semi-join; one that the fact
    has no relationship for does not reach it, and neither does another fact's column.
    A NULL among the wanted values also lets in rows without a dimension member.
    """
    columns = _columns(star, fact)
    own = {c: matches(c, v) for c, v in where.items() if c in columns and c not in ATTRIBUTES}
    by_dimension: dict[str, dict] = {}
    for column, values in where.items():
        if column not in own and column in ATTRIBUTES and _link(fact, ATTRIBUTES[column]):
            by_dimension.setdefault(ATTRIBUTES[column], {})[column] = values
    members = {
        d: reduce(lambda rows, f: rows.filter(matches(*f)), filters.items(), star[d]).select(_link(fact, d))
        for d, filters in by_dimension.items()
    }
    blank = {d for d, filters in by_dimension.items() if all(None in values for values in filters.values())}
    if narrowed := getattr(star, "narrowed", None):
        # a clustered copy: rows without a member can be in any file
        frame = narrowed(fact, {_link(fact, d): m for d, m in members.items() if d not in blank}, own)
    else:
        frame = star[fact]
    for condition in own.values():
        frame = frame.filter(condition)
    for dimension, wanted in members.items():
        key = _link(fact, dimension)
        if dimension in blank:
            flagged = frame.join(wanted.withColumn("_hit", F.lit(True)), key, "left")
            frame = flagged.filter(F.col("_hit") | F.col(key).isNull()).drop("_hit")
        else:
            frame = frame.join(wanted, key, "left_semi")
    return frame


def split_grouping(
    star: Star, fact: str, by: Sequence[str]
) -> tuple[dict[tuple[str, str], list[str]], list[str]]:
    """Grouping columns of dimensions, by (dimension, foreign key), and those the fact has itself."""
    dimensions: dict[tuple[str, str], list[str]] = {}
    for column in by:
        dimension = ATTRIBUTES.get(column)
        if dimension and (key := _link(fact, dimension)):
            dimensions.setdefault((dimension, key), []).append(column)
        elif dimension or column not in _columns(star, fact):
            raise ValueError(f"{fact} cannot be grouped by {column}")
    return dimensions, [c for c in by if c not in ATTRIBUTES]


def _aggregate(
    star: Mapping[str, DataFrame], fact: str, measures: Mapping[str, Measure],
    by: Sequence[str], where: Filters, totals: bool = False,
) -> DataFrame:
    """Measures of one fact under one context; with `totals`, also of every leading part of `by`.

    Rows are first combined per foreign key, where map-side aggregation absorbs hot keys, and
    only the combined rows meet the dimensions and are rolled up.
    """
    frame = restrict(star, fact, where)
    dimensions, own = split_grouping(star, fact, by)
    keys = [key for _, key in dimensions]
    sums = frame.groupBy(*own, *keys).agg(*[m.partial().alias(n) for n, m in measures.items()])
    if not dimensions and not totals:
        return sums
    for (dimension, key), columns in dimensions.items():
        sums = sums.join(star[dimension].select(key, *columns), key, "left")
    values = [F.sum(n).alias(n) for n in measures]
    if not totals:
        return sums.groupBy(*by).agg(*values)
    # grouping_id has a bit for each column rolled up: as many ones as columns are missing
    level = (F.lit(len(by)) - F.bit_count(F.grouping_id())).cast("int").alias(LEVEL)
    return sums.rollup(*by).agg(level, *values)


def _combine(left: DataFrame, right: DataFrame, by: Sequence[str], shared: Sequence[str]) -> DataFrame:
    """Put the measures of two aggregates side by side; NULL is a group like any other."""
    added = [c for c in right.columns if c not in by]
    if list(shared) == list(by):
        values = [c for c in (*left.columns, *right.columns) if c not in by]
        stacked = left.unionByName(right, allowMissingColumns=True)
        return stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in values])
    if not shared:  # the right side is one row
        return left.withColumns({c: right.select(c).scalar() for c in added})
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in shared])
    return left.join(right, same, "left").select(*[left[c] for c in left.columns], *added)


def ask(
    star: Mapping[str, DataFrame],
    measures: Sequence[str],
    by: Sequence[str] = (),
    where: Filters | None = None,
    totals: bool = False,
) -> DataFrame:
    """Evaluate measures per group of `by`, under filters `where` (column -> allowed values).

    With `totals` the answer also has a row for every leading part of `by`, down to none. The column LEVEL tells how many
    columns a row is grouped by, so a subtotal differs from the group of rows without a member. Additive
    measures are added up level by level, and ratios divided at the level they are shown at. No rows
    have no totals.
    """
    where = dict(where or {})
    for column in (*by, *where):
        if column not in ATTRIBUTES and column not in S.FATO_ACIDENTE.names:
            raise ValueError(f"no attribute named {column}")
    needed: dict[str, Measure] = {}
    for name in measures:
        needed |= {base: MEASURES[base] for base in bases(name)}
    if all(any(c in m.context for c in by) for m in needed.values()):
        needed["total_acidentes"] = MEASURES["total_acidentes"]  # only to list the groups
    # Measures of a fact share one scan, except those whose context replaces part of the query.
    parts: dict[tuple, dict[str, Measure]] = {}
    for name, measure in needed.items():
        replaced = measure.replaced([*by, *where])
        if totals and measure.replaced(by):
            raise ValueError(f"{name} fixes a column of the grouping, so it has no subtotals over it")
        parts.setdefault((measure.fact, tuple(replaced.items())), {})[name] = measure
    answer = None
    # parts under the whole query come first: they fix the groups of the answer
    for (fact, replaced), members in sorted(parts.items(), key=lambda p: len(p[0][1])):
        fixed = dict(replaced)
        shared = [c for c in by if c not in fixed]
        filters = {c: v for c, v in where.items() if c not in fixed} | {c: [v] for c, v in fixed.items()}
        part = _aggregate(star, fact, members, shared, filters, totals)
        if totals:
            answer = part if answer is None else _combine(answer, part, [*by, LEVEL], [*shared, LEVEL])
        else:
            answer = part if answer is None else _combine(answer, part, by, shared)
    columns = []
    for name in measures:
        measure = MEASURES[name]
        if isinstance(measure, Ratio):
            value = safe_ratio(F.col(measure.numerator), F.col(measure.denominator))
        else:  # no rows: a count is 0, a sum has no value
            value = F.col(name) if measure.column else F.coalesce(F.col(name), F.lit(0))
        columns.append(value.alias(name))
    return answer.select(*by, *([LEVEL] if totals else []), *columns)


def drill_through(star: Mapping[str, DataFrame], accident_ids: DataFrame) -> dict[str, DataFrame]:
    """Rows of the given accidents in each fact.

    The frames stay apart: the id is not unique, so joining facts on it would multiply rows.
    """
    ids = accident_ids.select("id_acidente").distinct()
    return {fact: star[fact].join(ids, "id_acidente", "left_semi") for fact in (ACCIDENTS, VEHICLES, VICTIMS)}


def accident_cards(star: Star, accident_ids: DataFrame | None = None) -> DataFrame:
    """One row per accident (all, or those of the given ids) with what the three facts say of it, nested.

    The id is a hash of five columns and no key, so an accident here is what these five say: date, operator, kilometre,
    hour and type. `acidentes` has a struct for each row of the accident fact; `veiculos` and `vitimas` one
    per type with its quantity. Each fact is folded to a row per accident before they meet, so nothing multiplies.
    Children know only the id: if two accidents share one by collision, both show its children, and
    `colisao` is true.
    """
    frames = {f: star[f] for f in (ACCIDENTS, VEHICLES, VICTIMS)}
    if accident_ids is not None:
        frames = drill_through(star, accident_ids)
    five = ["data", "concessionaria", "km", "hora", "tipo_de_acidente"]
    told = ["sentido", "tipo_de_ocorrencia", "severidade", "total_veiculos", "total_vitimas", "mortos"]
    named = frames[ACCIDENTS]
    for dimension in ("gold_dim_data", "gold_dim_concessionaria", "gold_dim_tipo_acidente", "gold_dim_rodovia"):
        key = _link(ACCIDENTS, dimension)
        own = [c for c in star[dimension].columns if c not in named.columns or c == key]
        named = named.join(star[dimension].select(*own), key, "left")
    row = F.struct("rodovia", "uf", *told)
    # each fact is shuffled once, by the id: groups that hold more columns, the window and the joins all follow it
    named = named.select("id_acidente", *five, "rodovia", "uf", *told)
    cards = named.repartition("id_acidente").groupBy("id_acidente", *five).agg(
        F.sort_array(F.collect_list(row)).alias("acidentes"))
    cards = cards.withColumn("colisao", F.count(F.lit(1)).over(Window.partitionBy("id_acidente")) > 1)
    for fact, dimension, label, name in (
        (VEHICLES, "gold_dim_veiculo", "tipo_veiculo", "veiculos"),
        (VICTIMS, "gold_dim_tipo_vitima", "tipo_vitima", "vitimas"),
    ):
        key = _link(fact, dimension)
        rows = frames[fact].select("id_acidente", key, "quantidade").repartition("id_acidente")
        sums = rows.groupBy("id_acidente", key).agg(F.sum("quantidade").alias("quantidade"))
        typed = sums.join(star[dimension], key, "left").select("id_acidente", F.struct(label, "quantidade").alias("_r"))
        folded = typed.groupBy("id_acidente").agg(F.sort_array(F.collect_list("_r")).alias(name))
        cards = cards.join(folded, "id_acidente", "left")
    empty = {n: F.coalesce(n, F.array().cast(cards.schema[n].dataType)).alias(n) for n in ("veiculos", "vitimas")}
    return cards.select("id_acidente", *five, "acidentes", empty["veiculos"], empty["vitimas"], "colisao")
