"""Raw files: charset, quoting, faulty rows, column order, and reading in parts."""

import pytest
from pyspark.sql import functions as F

from asfalto import schemas as S
from asfalto.plans import medallion
from asfalto.sources import csv_files as C
from asfalto.sources import landing
from asfalto.streaming import landing_stream as stream

NAMES = S.RAW_COLUMNS
NAME = "demostrativo_acidentes_{}.csv"


def line(**fields):
    return ";".join(fields.get(c, "0") for c in NAMES)


def put(folder, key, lines, names=NAMES):
    text = "\n".join([";".join(names), *lines]) + "\n"
    (folder / NAME.format(key)).write_bytes(text.encode("cp1252"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_charset_quotes_and_line_breaks(spark, tmp_path):
    put(tmp_path, "af", [
        line(tipo_de_acidente="Colisão – lateral"),
        line(tipo_de_acidente='"duas\nlinhas; e ponto"'),
        line(tipo_de_acidente=""),
        line(tipo_de_acidente="NA"),
    ])
    got = C.fitting(C.read_folder(spark, str(tmp_path)))
    assert {r[0] for r in got.select("tipo_de_acidente").collect()} == {
        "Colisão – lateral", "duas\nlinhas; e ponto", None, "NA",
    }
    assert all(r[0].endswith(NAME.format("af")) for r in got.select(S.FILE_COLUMN).collect())


def test_surplus_rows_are_set_apart_and_short_rows_kept(spark, tmp_path):
    put(tmp_path, "af", [
        line(horario="01:00"), line(horario="02:00") + ";x", ";".join(["01/01/2020", "03:00"]),
        line(horario="04:00") + ";", line(horario="05:00") + ";;y;z", line(horario="06:00") + ";;",
        '"um; dois";"07:00"',
    ])
    scanned = C.read_folder(spark, str(tmp_path))
    apart = C.surplus(scanned)
    assert apart.count() == 2
    assert {r[C.RECORD] for r in apart.collect()} == {line(horario="02:00") + ";x", line(horario="05:00") + ";;y;z"}
    assert {r[C.REASON] for r in apart.collect()} == {C.TOO_LONG}
    kept = {r["horario"]: r for r in C.fitting(scanned).collect()}
    assert set(kept) == {"01:00", "03:00", "04:00", "06:00", "07:00"} and kept["07:00"]["data"] == "um; dois"
    assert kept["03:00"]["mortos"] is None and kept["03:00"]["data"] == "01/01/2020"


def test_files_are_aligned_by_column_name(spark, tmp_path):
    put(tmp_path, "af", [line(km="1,5", mortos="2")])
    turned = NAMES[::-1]
    put(tmp_path, "als", [";".join({"km": "2,5", "mortos": "3"}.get(c, "0") for c in turned)], turned)
    shouted = [c.upper() for c in NAMES]
    put(tmp_path, "aps", [line(km="3,5", mortos="4", sentido="N")], shouted)
    put(tmp_path, "arb", [])  # header only
    got = C.fitting(C.read_folder(spark, str(tmp_path))).select("km", "mortos", "sentido")
    assert rows_of(got) == [("1,5", "2", "0"), ("2,5", "3", "0"), ("3,5", "4", "N")]


def test_a_missing_column_is_an_error(spark, tmp_path):
    put(tmp_path, "af", ["1"], NAMES[1:])
    with pytest.raises(ValueError, match="af.csv: sem coluna data"):
        C.read_folder(spark, str(tmp_path))


def test_odd_quotes_and_blank_lines_lose_no_row(spark, tmp_path):
    notes = ["um", 'poste 5" caido', "tres", '"a\nb"', '"c\\"d"', "seis", "sete"]
    put(tmp_path, "af", [x for k, n in enumerate(notes) for x in (line(data=str(k), tipo_de_acidente=n), "")])
    got = C.fitting(C.read_folder(spark, str(tmp_path))).where("mortos is not null")
    assert {r["data"]: r["tipo_de_acidente"] for r in got.collect()} == {
        "0": "um", "1": 'poste 5" caido', "2": "tres", "3": "a\nb", "4": 'c"d', "5": "seis", "6": "sete",
    }


def test_files_without_line_breaks_are_not_read_whole(spark, tmp_path):
    put(tmp_path, "af", [line(tipo_de_acidente='"entre aspas"')])
    put(tmp_path, "als", [line(tipo_de_acidente='"a\nb"')])
    seen = {r["file"].rsplit("_", 1)[1]: r["multi_line"] for r in C.describe_files(spark, str(tmp_path)).collect()}
    assert seen == {"af.csv": False, "als.csv": True}


def test_manifest_and_sizes(spark, tmp_path):
    put(tmp_path, "af", [line()])
    put(tmp_path, "novanova", [line()])
    (tmp_path / NAME.format("als")).write_bytes(b"")
    found = landing.landed(spark, str(tmp_path))
    status = {r["filename"]: r["status"] for r in landing.manifest(landing.catalogue(spark), found).collect()}
    assert len(status) == 35 and NAME.format("novanova") not in status
    assert status[NAME.format("af")] == "skip"
    assert status[NAME.format("als")] == "pendente"  # empty
    assert status[NAME.format("aps")] == "pendente"
    forced = landing.manifest(landing.catalogue(spark), found, force=True)
    assert {r["status"] for r in forced.collect()} == {"pendente"}
    report = {r["status"]: r for r in landing.report(landing.catalogue(spark), found).collect()}
    assert report["erro"]["com_erro"] == NAME.format("novanova") and report["skip"]["arquivos"] == 1
    assert report["pendente"]["arquivos"] == 34
    put(tmp_path, "afl", [line()] * 50_000)
    put(tmp_path, "arb", [line()] * 9, NAMES[1:])
    found = landing.landed(spark, str(tmp_path))
    report = {r["status"]: r for r in landing.report(
        landing.catalogue(spark), found, landing.unreadable(spark, str(tmp_path))).collect()}
    failed = [NAME.format("arb"), NAME.format("novanova")]
    unknown = {"novanova", "afl", "arb"} - set(S.OPERATOR_NAMES)
    assert sum(r["arquivos"] for r in report.values()) == 35 + len(unknown)
    assert all(f in report["erro"]["com_erro"] for f in failed) and "sem coluna data" in report["erro"]["com_erro"]
    stored = sum(p.stat().st_size for p in tmp_path.glob("*.csv"))
    assert stored > 2 << 20 and abs(sum(r["total_mb"] for r in report.values()) - stored / 1024**2) <= 0.15
    names = [r["filename"] for r in landing.sizes(found).collect()]
    assert names == sorted(names)


def test_whole_records_can_be_mended_and_parsed_again(spark, tmp_path):
    turned = NAMES[::-1]
    put(tmp_path, "af", [line(km="1") + ";x", '"duas\nlinhas"' + line(km="2")[1:] + ";x;y"])
    put(tmp_path, "als", [";".join({"km": "3"}.get(c, "0") for c in turned) + ";;x"], turned)
    records = C.surplus(C.read_folder(spark, str(tmp_path)))
    assert {r["km"] for r in C.parsed(records).collect()} == {"1", "2", "3"}
    assert C.fitting(C.parsed(records)).count() == 0
    mended = records.withColumn(C.RECORD, F.regexp_replace(C.RECORD, "(;+[xy])+$", ""))
    rows = C.fitting(C.parsed(mended)).select("km", "data", "mortos", S.FILE_COLUMN)
    assert {(r[0], r[1], r[2]) for r in rows.collect()} == {("1", "0", "0"), ("2", "duas\nlinhas", "0"), ("3", "0", "0")}


def test_replay_gives_what_a_clean_load_gives(spark, tmp_path):
    days = [line(data=f"0{n}/02/2020", trecho="BR-1/SP") for n in range(1, 6)]
    for name, tail in (("clean", ""), ("faulty", ";x")):
        (tmp_path / name).mkdir()
        put(tmp_path / name, "af", [days[0], *(d + tail for d in days[1:])])
    lakes = {n: medallion.Lake(spark, str(tmp_path / f"lake-{n}")) for n in ("clean", "faulty")}
    for name, lake in lakes.items():
        medallion.build_silver(lake, C.read_folder(spark, str(tmp_path / name)))
    lake = lakes["faulty"]
    held = spark.read.parquet(lake.path(medallion.QUARANTINE))
    assert held.count() == 4
    # one record is not mended well, one is not looked at
    record = F.col(C.RECORD)
    fixed = F.when(record.startswith("02"), F.concat(record, F.lit(";y"))).otherwise(F.regexp_replace(record, ";x$", ""))
    mended = held.where(~record.startswith("03")).withColumns({"_original": record, C.RECORD: fixed})
    assert medallion.replay(lake, mended).written == 2
    left = spark.read.parquet(lake.path(medallion.QUARANTINE))
    assert {r[C.RECORD][:2] + r[C.RECORD][-4:] for r in left.collect()} == {"02;x;y", "03;0;x"}
    record = F.col(C.RECORD)
    again = left.withColumns({"_original": record, C.RECORD: F.regexp_replace(record, ";x(;y)?$", "")})
    medallion.replay(lake, again)
    assert rows_of(lake[medallion.SILVER]) == rows_of(lakes["clean"][medallion.SILVER])
    assert spark.read.parquet(lake.path(medallion.QUARANTINE)).count() == 0


def test_files_without_a_column_have_failed(spark, tmp_path):
    put(tmp_path, "af", [line()])
    put(tmp_path, "als", ["1"], NAMES[2:])
    faulty = landing.unreadable(spark, str(tmp_path))
    assert rows_of(faulty) == [(NAME.format("als"), "sem coluna data, horario")]
    found = landing.landed(spark, str(tmp_path))
    rows = landing.manifest(landing.catalogue(spark), found, faulty).collect()
    status = {r["filename"]: (r["status"], r["motivo"]) for r in rows}
    assert status[NAME.format("af")] == ("skip", None) and status[NAME.format("aps")] == ("pendente", None)
    assert status[NAME.format("als")] == ("erro", "sem coluna data, horario")


@pytest.fixture
def landing_place(spark, tmp_path):
    source, target, mark = (tmp_path / n for n in ("in", "out", "mark"))
    source.mkdir()
    return source, mark, lambda: stream.take_new_files(spark, str(source), str(target), str(mark)), (
        lambda table=stream.ROWS: stream.landed(spark, str(target), table))


def test_stream_takes_each_file_once(landing_place):
    source, _, run, table = landing_place
    run()
    assert table().count() == 0
    put(source, "af", [line(), line()])
    run()
    assert table().count() == 2
    run()
    assert table().count() == 2
    put(source, "als", [line()])
    run()
    assert table().count() == 3
    assert table().select(S.FILE_COLUMN).distinct().count() == 2


def test_stream_aligns_by_name_and_sets_long_records_apart(landing_place):
    source, _, run, table = landing_place
    put(source, "af", [line(km="1,5"), line(km="2,5") + ";x"])
    turned = NAMES[::-1]
    put(source, "als", [";".join({"km": "3,5", "mortos": "7"}.get(c, "0") for c in turned)], turned)
    put(source, "aps", ["1"], NAMES[1:])
    put(source, "arb", [line(tipo_de_acidente='"a\nb"', km="4,5")], [c.upper() for c in NAMES])
    run()
    assert rows_of(table().select("km", "mortos", "tipo_de_acidente")) == [
        ("1,5", "0", "0"), ("3,5", "7", "0"), ("4,5", "0", "a\nb")]
    assert [r[C.RECORD] for r in table(stream.QUARANTINE).collect()] == [line(km="2,5") + ";x"]
    refused = table(stream.REFUSED).collect()
    assert [(r[S.FILE_COLUMN][-6:], r[C.REASON]) for r in refused] == [("ps.csv", "sem coluna data")]


def test_a_batch_that_runs_again_leaves_one_copy(landing_place):
    source, mark, run, table = landing_place
    put(source, "af", [line(), line() + ";x"])
    run()
    # as if the driver had been lost after the batch wrote its rows and before it was noted as done
    for file in (mark / "commits").iterdir():
        file.unlink()
    run()
    assert table().count() == 1 and table(stream.QUARANTINE).count() == 1


# --- replacing what one operator sent


def silver_files(lake):
    return {r["path"]: r["modificationTime"] for r in lake.spark.read.format("binaryFile").option(
        "recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(
        lake.path(medallion.SILVER)).select("path", "modificationTime").collect()}


def test_landing_an_operator_again_replaces_its_rows_alone(spark, tmp_path):
    def load(name, af, others):
        folder = tmp_path / name
        folder.mkdir()
        put(folder, "af", af)
        for key, lines in others.items():
            put(folder, key, lines)
        return C.read_folder(spark, str(folder))

    day = lambda date, **more: line(data=date, trecho="BR-1/SP", **more)
    others = {"als": [day("01/02/2019"), day("01/02/2020")], "novanova": [day("05/05/2020"), day("bad date")]}
    old = [day("01/02/2018"), day("02/02/2019"), day("bad date"), day("03/02/2020", mortos="1")]
    new = [day("02/02/2019", mortos="2"), day("03/02/2020"), day("04/02/2020"), day("07/07/2021")]
    lake = medallion.Lake(spark, str(tmp_path / "lake"))
    medallion.build_silver(lake, load("first", old, others))
    before = silver_files(lake)
    done = medallion.replace_operators(lake, load("second", new, {}))
    assert done.complete and done.written == len(new)
    rebuilt = medallion.Lake(spark, str(tmp_path / "rebuilt"))
    medallion.build_silver(rebuilt, load("whole", new, others))
    assert rows_of(lake[medallion.SILVER]) == rows_of(rebuilt[medallion.SILVER])
    after = silver_files(lake)
    own = "concessionaria=AUTOPISTA FLUMINENSE"
    assert {p: t for p, t in before.items() if own not in p} == {p: t for p, t in after.items() if own not in p}
    assert not any("2018" in p or "HIVE_DEFAULT" in p for p in after if own in p)


@pytest.mark.parametrize("text", ["a;b", "", "Ação; É"])
def test_header_names(text):
    assert C._names(text + "\r") == tuple(n.strip().lower() for n in text.split(";"))


def test_a_clean_run_clears_the_quarantine(spark, tmp_path):
    lake = medallion.Lake(spark, str(tmp_path / "lake"))
    for name, tail in (("one", ";x"), ("two", "")):
        source = tmp_path / name
        source.mkdir()
        put(source, "af", [line(data="01/02/2020", trecho="BR-1/SP"), line(data="02/02/2020") + tail])
        medallion.build_silver(lake, C.read_folder(spark, str(source)))
        assert spark.read.parquet(lake.path(medallion.QUARANTINE)).count() == bool(tail)


def test_exit_status(spark, tmp_path, monkeypatch):
    from asfalto import __main__ as command

    monkeypatch.setattr(command, "session", lambda: spark)
    (tmp_path / "raw").mkdir()
    put(tmp_path / "raw", "af", [line(data="no date")])
    run = ["--raw", str(tmp_path / "raw"), "--root", str(tmp_path / "lake")]
    assert command.main(run) == command.BROKEN
    assert not (tmp_path / "lake" / "gold_dim_data").exists()
    put(tmp_path / "raw", "af", [line(data="01/02/2020", trecho="BR-1/SP")])
    assert command.main(run) == 0


def test_pipeline_sets_long_rows_apart(spark, tmp_path):
    source = tmp_path / "raw"
    source.mkdir()
    put(source, "af", [line(data="01/02/2020", trecho="BR-1/SP"), line(data="02/02/2020") + ";x"])
    lake = medallion.Lake(spark, str(tmp_path / "lake"))
    done = medallion.run(lake, C.read_folder(spark, str(source)))
    assert all(w.complete for w in done.values())
    silver = done[medallion.SILVER]
    assert silver.written == 1 and silver.metrics["excedentes"] == 1 and silver.metrics["veredito"] == "ALERTA"
    kept_out = spark.read.parquet(lake.path(medallion.QUARANTINE)).collect()
    assert [r[C.RECORD] for r in kept_out] == [line(data="02/02/2020") + ";x"]
    fact = lake["gold_fato_acidente"].collect()
    assert [(r["id_data"], r["ano"], r["id_rodovia"]) for r in fact] == [(20200201, 2020, 1)]


def test_plain_records_are_split_without_a_parser(spark, monkeypatch):
    records = ["a;b;c", "a;b;c;;", "a;b;c;;x", "a", "", ";;;;", "a;b;c;" + ";" * 70 + "x"]
    schema = f"{C.RECORD} string, {C.COLUMNS} string, `{S.FILE_COLUMN}` string"
    wide = [";".join("7" for _ in NAMES) + end for end in ("", ";", ";;x")]
    held = spark.createDataFrame([(r, ";".join(NAMES), "f") for r in wide], schema)
    plain = spark.createDataFrame([(r,) for r in records], "r string").repartition(2)
    judge = lambda: rows_of(plain.select("r", C._surplus(F.col("r"), 3)))
    with monkeypatch.context() as patch:
        patch.setattr(C, "_plain", lambda record: F.lit(False))
        expected = judge(), rows_of(C.parsed(held))
    fields = C._fields

    def refuse(record, count):
        return fields(F.when(record.isNotNull(), F.raise_error("parsed")).cast("string"), count)

    monkeypatch.setattr(C, "_fields", refuse)
    assert (judge(), rows_of(C.parsed(held))) == expected
