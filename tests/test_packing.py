"""What goes through a shuffle is narrow, and comes out as it went in."""

import re

from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.functions.packing import pack_ranges, pack_small, unpack_small
from asfalto.operators import layout
from asfalto.plans.silver import REJECTS, gathered, silver
from asfalto.session import new_folder
from asfalto.sources.accidents import raw_rows
from tests.conftest import SMALL

EXTREMES = "a int, b bigint, c smallint, d int, e bigint, f int"


def test_ranges_are_packed_and_unpacked(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    rows = [
        (-(1 << 31), low, -5, 7, low, None), ((1 << 31) - 1, high, None, 7, low + 9, None), (None, 0, 0, None, None, None),
    ]
    frame = spark.createDataFrame(rows, EXTREMES)
    ends = frame.agg(*[f(c).alias(f"{c}{n}") for c in frame.columns for n, f in enumerate((F.min, F.max))]).first()
    ranges = {f.name: (ends[f"{f.name}0"], ends[f"{f.name}1"], f.dataType.simpleString()) for f in frame.schema}
    words, unpacked = pack_ranges(ranges, "w")
    assert set(unpacked) == set(frame.columns) - {"b"} and len(words) == 1
    sent = frame.select("b", *[word.alias(name) for name, word in words.items()])
    back = sent.select(*[unpacked.get(c, F.col(c)).alias(c) for c in frame.columns])
    assert back.collect() == frame.collect()
    assert back.schema.simpleString() == frame.schema.simpleString()


def test_small_numbers_share_a_long_and_others_an_array(spark):
    names = ["a", "b", "c"]
    rows = [(0, 14, None), (None, None, None), (15, 0, 1), (-1, 2, None), (3, None, 2_000_000_000)]
    frame = spark.createDataFrame(rows, "a int, b int, c int")
    word, rest = pack_small(names, 4)
    sent = frame.select(word.alias("w"), rest.alias("r"))
    assert [r.w is None for r in sent.collect()] == [False, False, True, True, True]
    back = sent.select(*[v.alias(c) for c, v in unpack_small(F.col("w"), F.col("r"), names, 4).items()])
    assert [tuple(r) for r in back.collect()] == rows


def test_gathered_silver_is_silver(spark):
    plain = {c: "0" for c in S.RAW_COLUMNS} | {"data": "15/03/2022", "horario": "14:30:00", "trecho": "BR-1/SP"}
    odd = [
        {}, {"mortos": "2000000000", "ilesos": "15"}, {"automovel": "-3"}, {"data": None}, {"data": "x"},
        {"horario": "99:00:00"}, {"km": "n/d", "moto": "n/d"}, {c: None for c in S.RAW_COLUMNS}, {"sentido": "SUL"},
        {"tipo_de_ocorrencia": "ac03", "mortos": "14"}, {c: "n/d" for c in S.COUNTS}, {},
    ]
    rows = [tuple((plain | o).values()) + ("demostrativo_acidentes_af.csv",) for o in odd]
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in [*plain, S.FILE_COLUMN]))
    for source in (raw, raw_rows(spark, SMALL)):
        wanted, got = silver(source, audit=True), gathered(source)
        assert got.schema.simpleString() == wanted.schema.simpleString()
        assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_silver_goes_narrow_through_its_shuffle(spark):
    plan = gathered(raw_rows(spark, SMALL))._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "RebalancePartitions":
        plan = plan.children().head()
    names = {plan.output().apply(n).name() for n in range(plan.output().size())}
    assert not names & {"total_veiculos", "total_vitimas", "severidade", "mes", "hora", *S.COUNTS, *REJECTS}
    assert {"ano", "concessionaria", "data", "km"} <= names


def test_small_files_are_cut_by_tasks_not_by_the_shuffle(spark):
    source, target = new_folder(spark, "t-cut"), new_folder(spark, "t-cut-z")
    columns = ["cast(id * 7919 % 1000 as int) as a", "cast(id * 104729 % 997 as int) as b"]
    frame = spark.range(200_000).selectExpr("id", *columns, "if(id % 11 = 0, null, id % 3) as p")
    frame.write.parquet(source)
    _, stored = layout.file_stats(spark, source)
    tasks = 2 * spark.sparkContext.defaultParallelism
    files = layout.LEAST_CUTS * tasks
    done = layout.zorder(spark, source, target, ["a", "b"], ["p"], ["id"], target_bytes=stored // files)
    assert done.complete and done.written == 200_000
    after = layout.read_table(spark, target, frame.schema)
    assert frame.exceptAll(after).isEmpty() and after.exceptAll(frame).isEmpty()
    sizes = after.groupBy(F.input_file_name().alias("file")).count().collect()
    assert files <= len(sizes) <= files + tasks * 4 + 4
    assert max(r["count"] for r in sizes) <= -(-200_000 // files) + 1
    assert len({re.search(r"part-(\d+)", r["file"])[1] for r in sizes}) <= tasks
    # each file holds a small part of the curve
    index = spark.read.parquet(layout.index_path(target))
    narrow = index.where("hi_a - lo_a < 500 or hi_b - lo_b < 500").count()
    assert narrow > len(sizes) / 2
