import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

import wavemeld as wm
from wavemeld.operators.matching import match_columns
from wavemeld.plans import audit, report
from wavemeld.sources import staging
from wavemeld.sources.manifest import group_files, named, read_manifest, scan
from wavemeld.sources.readers import check_extension, read_raw
from wavemeld.sources.scratch import scratch_dir

CSV_2021 = "IO_Kjonn,Alder,Siv,Junk\n2,40,1,a\n1,50,2,b\n1,50,2,b\nNA,,,\n"
CSV_2022 = "IO_Kjonn,Alder,Siv,Junk\n2,41,D,a\n0,51,3,b\n"
TSV_2023 = "Alder\tAntpers\n60\t99\n61\t2\n"


@pytest.fixture()
def files(tmp_path):
    out = []
    for name, text in (("w2021.csv", CSV_2021), ("w2022.csv", CSV_2022), ("w2023.tsv", TSV_2023)):
        (tmp_path / name).write_text(text)
        out.append((str(tmp_path / name), int(name[1:5])))
    return out


def test_delimited_types(spark, tmp_path):
    path = tmp_path / "a b.csv"
    path.write_text("i,l,d,s,b,n,m\n1,3000000000,1.5,x,TRUE,,1\n-2, 7 ,1e3,,false,NA,TRUE\nNA,1,2,NA,NA,,2\n")
    df = read_raw(spark, str(path))
    assert dict(df.dtypes) == {"i": "int", "l": "bigint", "d": "double", "s": "string", "b": "boolean",
                               "n": "boolean", "m": "string"}
    assert [tuple(r) for r in df.collect()] == [
        (1, 3000000000, 1.5, "x", True, None, "1"), (-2, 7, 1000.0, None, False, None, "TRUE"),
        (None, 1, 2.0, None, None, None, "2")]


def test_dispatch(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported file type: .xyz"):
        check_extension("a.xyz")
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    for ext in ("parquet", "orc", "json"):
        path = str(tmp_path / f"t.{ext}")
        df.write.format(ext).save(path)
        assert [tuple(r) for r in read_raw(spark, path).collect()] == [(1, "x")]


def test_manifest(spark, files, tmp_path):
    entries = read_manifest(files)
    groups = group_files(spark, entries)
    assert sorted(len(g.entries) for g in groups) == [1, 1, 1]  # Siv is text in one file
    rows = scan(spark, groups[0]).groupBy("dataset").count().collect()
    assert [tuple(r) for r in rows] == [("w2021.csv", 4)]
    with pytest.raises(ValueError, match="Two files are named"):
        read_manifest([("a/x.csv", 1), ("b/x.csv", 2)])
    frame = spark.createDataFrame([("p/q.csv", None), ("r.csv", 3)], "path string, year_tag int")
    assert [(e.dataset, e.year) for e in read_manifest(frame)] == [("q.csv", None), ("r.csv", 3)]


def test_same_schema_is_one_plan(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f {i}+x.csv").write_text(f"Alder,Siv\n{i},1\n")
    groups = group_files(spark, read_manifest([(str(tmp_path / f"f {i}+x.csv"), i) for i in range(3)]))
    assert len(groups) == 1
    rows = {(r["dataset"], r["Alder"]) for r in named(scan(spark, groups[0]), groups[0]).collect()}
    assert rows == {(f"f {i}+x.csv", i) for i in range(3)}


def test_whole_job(spark, spec, files, tmp_path):
    log_dir, out = str(tmp_path / "logs"), str(tmp_path / "merged")
    done = wm.run_pipeline(spark, files, spec, log_dir, out, apply_missing=True, merge=True)
    merged = done.merged()
    assert merged.columns == ["year", "kjonn", "alder", "siv", "antpers"]
    assert dict(merged.dtypes) == {"year": "int", "kjonn": "int", "alder": "int", "siv": "string", "antpers": "int"}
    rows = {tuple(r) for r in merged.collect()}
    assert rows == {(2021, 2, 40, "1", None), (2021, 1, 50, "2", None), (2022, 2, 41, "D", None),
                    (2022, 2, 51, "3", None), (2023, None, 60, None, None), (2023, None, 61, None, 2)}
    assert merged.count() == 6
    back = spark.read.csv(out, header=True)
    assert back.count() == 6 and back.columns == merged.columns
    issues = {(r["dataset"], r["variable"]): r["detail"] for r in done.issues.collect()}
    assert issues == {("w2022.csv", "siv"): "Target: integer. 1 value(s) -> NA: D. Column kept as character."}
    assert dict(done.tables["w2021.csv"].dtypes)["siv"] == "int"
    assert done.tables["w2023.tsv"].columns == ["alder", "antpers", "year"]
    # audit files
    folder = os.path.join(log_dir, "per_dataset")
    assert sorted(f for f in os.listdir(folder) if f.startswith("log=")) == [
        "log=issues_w2022_csv", "log=match_log_w2021_csv", "log=match_log_w2022_csv", "log=match_log_w2023_tsv"]
    log = spark.read.csv(f"{folder}/log=match_log_w2021_csv", header=True, sep=";").collect()
    assert log[0]["method"] == "unmatched" and log[0]["action"] == "DROPPED — not in canonical set"
    assert [r["method"] for r in log] == ["unmatched", "keyword [kjonn]", "exact", "exact"]
    # master log: running one file again replaces only its rows
    master = audit.read_master_log(spark, log_dir)
    assert master.count() == 10
    wm.run_pipeline(spark, files[:1], spec, log_dir, logged_at="2030-01-01 00:00:00")
    again = audit.read_master_log(spark, log_dir)
    assert again.count() == 10
    assert {r["dataset"] for r in again.filter("logged_at like '2030%'").collect()} == {"w2021.csv"}
    summary = wm.summarise_master_log(spark, log_dir)
    assert {r["method"]: r["n"] for r in summary.by_method.collect()} == {"exact": 6, "keyword [kjonn]": 2, "unmatched": 2}
    assert summary.n_review.first()[0] == 4 and summary.predicted.count() == 2
    assert [r["year"] for r in summary.review_counts.collect()] == [2021, 2022]
    tables = report.report_tables(again)
    assert tables["kpis"].first().asDict() == {"n_total": 10, "n_exact": 6, "n_fuzzy": 0, "n_predicted": 2,
                                               "n_unmatched": 2, "n_review": 4, "n_datasets": 3}
    assert [r["badge"] for r in tables["method_counts"].collect()] == ["Exact", "Predicted", "Unmatched"]
    assert [r["badge"] for r in tables["review_checklist"].collect()] == ["Predicted"] * 2 + ["Unmatched"] * 2
    assert {r["raw_name"] for r in tables["unmatched"].collect()} == {"junk"}


def test_separate_outputs(spark, spec, files, tmp_path):
    out = str(tmp_path / "out")
    done = wm.run_pipeline(spark, files[:2] + [(files[2][0], None)], spec, output_path=out)
    assert sorted(f for f in os.listdir(out) if f.startswith("dataset=")) == [
        "dataset=w2021_csv_clean", "dataset=w2022_csv_clean", "dataset=w2023_tsv_clean"]
    assert done.tables["w2023.tsv"].columns == ["alder", "antpers"]
    assert done.summary is None
    missing, _ = done.validation()["w2023.tsv"]
    assert {r["variable"]: r["pct_missing"] for r in missing.collect()} == {"alder": 0.0, "antpers": 0.0}


def logged(spark, folder):
    """What readers of the log folder see: rows of the master log, lines of the files."""
    master = spark.read.schema(audit.MASTER_SCHEMA).parquet(audit.master_path(folder))
    lines = spark.read.text(f"{folder}/per_dataset").select("value", "log")
    return ({tuple(r) for r in master.select("dataset", "raw_name", "method", "logged_at").collect()},
            {tuple(r) for r in lines.collect()})


def two_runs(spark, spec):
    """Matches of two runs; the second holds a dataset of the first and a new one."""
    schema = "dataset string, ordinal bigint, raw_name string"
    first = match_columns(spark.createDataFrame([("a", 0, "kjonn"), ("b", 0, "town")], schema), spec)
    second = match_columns(spark.createDataFrame([("a", 0, "alder"), ("a", 1, "zip"), ("c", 0, "siv")], schema), spec)
    return first, second


def issue_rows(spark, rows=(("a", "siv", "coercion", 1, "old"),)):
    df = spark.createDataFrame(list(rows), "dataset string, variable string, issue_type string, n bigint, detail string")
    return df.withColumn("bad_values", F.array("detail"))


def test_log_that_fails_leaves_the_old_one(spark, spec, tmp_path):
    first, second = two_runs(spark, spec)
    folder = str(tmp_path / "logs")
    wm.export_match_log(first, folder, issue_rows(spark), logged_at="2020-01-01 00:00:00")
    before = logged(spark, folder)
    broken = issue_rows(spark).withColumn("detail", F.raise_error(F.lit("the second write fails")))
    with pytest.raises(Exception, match="the second write fails"):
        wm.export_match_log(second, folder, broken, logged_at="2030-01-01 00:00:00")
    assert logged(spark, folder) == before
    assert sorted(os.listdir(folder)) == ["match_log_MASTER", "per_dataset"]


@pytest.mark.parametrize("moves", range(5))
def test_log_that_dies_while_moving_is_finished(spark, spec, tmp_path, monkeypatch, moves):
    first, second = two_runs(spark, spec)
    folder, whole = str(tmp_path / "logs"), str(tmp_path / "whole")
    for place in (folder, whole):
        wm.export_match_log(first, place, issue_rows(spark), logged_at="2020-01-01 00:00:00")
    new = issue_rows(spark, [("c", "siv", "coercion", 2, "new")])
    wm.export_match_log(second, whole, new, logged_at="2030-01-01 00:00:00")
    move, done = staging._replace, []

    def dies(fs, source, target):
        if len(done) == moves:
            if fs.exists(target):
                fs.delete(target, True)  # the old partition is gone, the new one not there
            raise SystemExit
        done.append(target)
        move(fs, source, target)

    monkeypatch.setattr(staging, "_replace", dies)
    with pytest.raises(SystemExit):
        wm.export_match_log(second, folder, new, logged_at="2030-01-01 00:00:00")
    monkeypatch.undo()
    log = audit.read_master_log(spark, folder)
    assert {r["dataset"] for r in log.collect()} == {"a", "b", "c"}
    assert logged(spark, folder) == logged(spark, whole)
    assert sorted(os.listdir(folder)) == ["match_log_MASTER", "per_dataset"]


def test_scratch_goes_with_the_jvm(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\n"
        "from wavemeld.sources.scratch import scratch_dir\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', {str(tmp_path)!r}).getOrCreate()\n"
        "path = scratch_dir(s, 'x')\n"
        "s.range(5).write.parquet(path)\n"
        "print('rows', s.read.parquet(path).count())\n"
        "s.stop()\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert "rows 5" in done.stdout, done.stderr
    for _ in range(100):  # the JVM ends a little after its driver
        if not os.listdir(tmp_path / "wavemeld"):
            break
        time.sleep(0.2)
    assert os.listdir(tmp_path / "wavemeld") == []


def test_no_master_log(spark, tmp_path, capsys):
    assert wm.summarise_master_log(spark, str(tmp_path / "none")) is None
    assert "No master log found" in capsys.readouterr().out


def test_export_switches(spark, spec, tmp_path):
    cat = spark.createDataFrame([("d", 0, "kjonn"), ("d", 1, "town")], "dataset string, ordinal bigint, raw_name string")
    result = match_columns(cat, spec)
    log = wm.export_match_log(result, str(tmp_path), append_master=False, canonical_names=["town"])
    assert {r["raw_name"]: r["action"] for r in log.collect()} == {
        "kjonn": "Renamed to canonical", "town": "Kept — already canonical"}
    assert os.listdir(tmp_path) == ["per_dataset"]


def test_empty_rows_with_a_year(spark, spec, tmp_path):
    (tmp_path / "a.csv").write_text(CSV_2021)
    manifest = [(str(tmp_path / "a.csv"), 2021)]
    assert wm.run_pipeline(spark, manifest, spec).merged().count() == 2
    assert wm.run_pipeline(spark, manifest, spec, year_counts_as_value=True).merged().count() == 3
    assert wm.run_pipeline(spark, manifest, spec, dedupe=False).merged().count() == 3


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(f"{shared}/wavemeld/x-") and first != second


def test_names_and_cells_as_written(spark, tmp_path):
    (tmp_path / "q.csv").write_text('Q1,q1,"a ""b"", c"\n1,2,"x ""y"", z"\n5,6,"a\n7,8"\n')
    df = read_raw(spark, str(tmp_path / "q.csv"))
    assert df.columns == ["Q1", "q1", 'a "b", c']
    assert [tuple(r) for r in df.collect()] == [(1, 2, 'x "y", z'), (5, 6, "a\n7,8")]
    spec = wm.Spec.from_dict({"q1": {"type": "integer", "colnames": ["q1"]}, "other": {"type": "integer", "colnames": ["q1_1"]},
                              "q10": {"type": "integer", "colnames": ["q10"]}})
    done = wm.run_pipeline(spark, [(str(tmp_path / "q.csv"), None)], spec)
    assert {r["raw_name"] for r in done.match.log.collect()} == {"q1", "q1_1"}
    assert {tuple(r) for r in done.merged().select("q1", "other").collect()} == {(1, 2), (5, 6)}


def test_no_file_is_lost(spark, spec, tmp_path):
    (tmp_path / "b.CSV").write_text("Alder\n40\n")
    (tmp_path / "part-x.csv").write_text("Alder,dataset,year\n41,q,r\n")
    (tmp_path / "only header.csv").write_text("Alder\n")
    folder = tmp_path / "f.csv"
    folder.mkdir()
    for i in (1, 2):
        (folder / f"part-{i}.csv").write_text(f"Alder\n{50 + i}\n")
    paths = [str(tmp_path / n) for n in ("b.CSV", "part-x.csv", "only header.csv", "f.csv")]
    done = wm.run_pipeline(spark, [(p, 2000) for p in paths], spec)
    got = {(r["dataset"], r["alder"]) for r in done.merged(keep_dataset=True).collect()}
    assert got == {("b.CSV", 40), ("part-x.csv", 41), ("f.csv", 51), ("f.csv", 52)}
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_validation_is_written(spark, spec, files, tmp_path):
    wm.run_pipeline(spark, files, spec, log_dir=str(tmp_path / "logs"))
    missing = spark.read.csv(str(tmp_path / "logs" / "validation_missing"), header=True).collect()
    assert {r["dataset"] for r in missing} == {"w2021.csv", "w2022.csv", "w2023.tsv"}
    codes = spark.read.csv(str(tmp_path / "logs" / "validation_codes"), header=True, escape='"').collect()
    assert all(r["passed"] == "false" for r in codes)


def test_outputs_that_would_meet_are_refused():
    with pytest.raises(ValueError, match="one folder"):
        read_manifest([("x/a b.csv", 1), ("x/a_b.csv", 2)])


def test_files_outside_the_listing_are_refused():
    from wavemeld.sources.readers import owners
    assert owners(["file:///d/a%20b.csv/part-0.csv", "hdfs://h/d/c.csv"], ["/d/a b.csv", "hdfs://h/d/c.csv"]) == {
        "file:///d/a%20b.csv/part-0.csv": "/d/a b.csv", "hdfs://h/d/c.csv": "hdfs://h/d/c.csv"}
    with pytest.raises(ValueError, match="belongs to none"):
        owners(["file:///d/e.csv"], ["/d/c.csv"])


# -- separators, and records of another width ------------------------------------------

def texts(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return [(str(tmp_path / f"{n}.csv"), 2000) for n in files]


@pytest.mark.parametrize("text,columns", [
    ("a;b;c\n1,5;2;x\n2,5;3;y,z\n", ["a", "b", "c"]), ("a|b\n1|2\n", ["a", "b"]), ("a\tb\n1\t2,3\n", ["a", "b"]),
    ('"x;y",b\n"1;2;3",4\n"5;6",7\n', ["x;y", "b"]), ("only\n1\n2\n", ["only"]), ("a;b\n", ["a", "b"]),
    ("name, age;sex\nx;1\ny;2\n", ["name, age", "sex"]), ("a b c\n1 2 3\n4 5 6\n", ["a", "b", "c"]),
    ("first name\nanna\nbo\n", ["first name"]), ("a,b\n1,2\n\n3\n4,5,6\n", ["a", "b"]),
    ('a;b\n1;"two\nlines, here"\n3;"more, and\nmore, still"\n', ["a", "b"]), ('t\n"x, y"\n"z, w"\n', ["t"]),
    ('"a\nb";c\n1;2\n', ["a\nb", "c"]),
])
def test_separator_of_a_file(spark, tmp_path, text, columns):
    (tmp_path / "f.csv").write_text(text)
    assert read_raw(spark, str(tmp_path / "f.csv")).columns == columns


@pytest.mark.parametrize("text", ["a,b,c\n1;2;3\n4;5;6\n", "title\n1;2\n3;4\n5;6\n"])
def test_no_separator_fits(spark, spec, tmp_path, text):
    (tmp_path / "f.csv").write_text(text)
    with pytest.raises(ValueError, match="f.csv: no separator splits both"):
        read_raw(spark, str(tmp_path / "f.csv"))
    with pytest.raises(ValueError, match="give sep"):
        wm.run_pipeline(spark, [(str(tmp_path / "f.csv"), None)], spec)
    assert read_raw(spark, str(tmp_path / "f.csv"), sep=";").count() > 0


def test_manifest_of_many_separators(spark, spec, tmp_path):
    rows = [("IO_Kjonn", "Alder", "Junk"), ("2", "40", "a"), ("1", "50", "b")]
    manifest = texts(tmp_path, **{n: "\n".join(s.join(r) for r in rows) + "\n"
                                  for n, s in (("comma", ","), ("semi", ";"), ("bar", "|"), ("tab", "\t"))})
    done = wm.run_pipeline(spark, manifest, spec)
    got = {}
    for r in done.merged(keep_dataset=True).collect():
        got.setdefault(r["dataset"], set()).add((r["kjonn"], r["alder"]))
    assert got == {f"{n}.csv": {(2, 40), (1, 50)} for n in ("comma", "semi", "bar", "tab")}
    assert done.issues.count() == 0 and done.malformed.count() == 0


def test_separator_given(spark, spec, tmp_path):
    manifest = texts(tmp_path, a="IO_Kjonn;Alder\n2;40\n", b="IO_Kjonn;Alder\n1;41,5\n")
    done = wm.run_pipeline(spark, manifest, spec, sep=";")
    assert {(r["kjonn"], r["alder"]) for r in done.merged().collect()} == {(2, "40"), (1, "41,5")}
    wide = texts(tmp_path, c="IO_Kjonn||Alder\n2||40\n")
    assert wm.run_pipeline(spark, wide, spec, sep="||").merged().first()["alder"] == 40


def test_records_of_another_width(spark, spec, tmp_path):
    manifest = texts(tmp_path, a='IO_Kjonn,Alder,Junk\n2,30,x,EXTRA\n1,40\n1,50,y\n\n2,60,"p, q"\n2,70,"a","b, c"\n',
                     b="IO_Kjonn,Alder,Junk\n1,20,z\n",
                     c='IO_Kjonn;Alder;Junk\n1;21;"two\nlines";more\n2;22;"x\ny"\n1\n')
    done = wm.run_pipeline(spark, manifest, spec, log_dir=str(tmp_path / "logs"))
    merged = {(r["dataset"], r["kjonn"], r["alder"]) for r in done.merged(keep_dataset=True).collect()}
    assert merged == {("a.csv", 2, 30), ("a.csv", 1, 40), ("a.csv", 1, 50), ("a.csv", 2, 60), ("a.csv", 2, 70),
                      ("b.csv", 1, 20), ("c.csv", 1, 21), ("c.csv", 2, 22), ("c.csv", 1, None)}
    found = {(r["dataset"], r["issue_type"]): (r["variable"], r["n_bad"]) for r in done.issues.collect()}
    assert found == {("a.csv", "extra_cells"): ("(file)", 2), ("a.csv", "missing_cells"): ("(file)", 1),
                     ("c.csv", "extra_cells"): ("(file)", 1), ("c.csv", "missing_cells"): ("(file)", 1)}
    records = {(r["dataset"], r["kind"], r["cells"], r["columns"], r["record"].strip()) for r in done.malformed.collect()}
    assert records == {("a.csv", "extra_cells", 4, 3, "2,30,x,EXTRA"), ("a.csv", "missing_cells", 2, 3, "1,40"),
                       ("a.csv", "extra_cells", 4, 3, '2,70,"a","b, c"'),
                       ("c.csv", "extra_cells", 4, 3, '1;21;"two\nlines";more'), ("c.csv", "missing_cells", 1, 3, "1")}
    written = spark.read.csv(str(tmp_path / "logs" / "malformed_rows"), header=True, escape='"', multiLine=True)
    assert written.count() == 5 and written.filter("record LIKE '%EXTRA'").count() == 1
    assert {r for r in os.listdir(tmp_path / "logs" / "per_dataset") if "issues" in r} == {"log=issues_a_csv", "log=issues_c_csv"}


def test_a_file_without_a_match_is_reported(spark, spec, tmp_path):
    manifest = texts(tmp_path, a="IO_Kjonn,Alder\n2,30\n", b="town,street\nx,y\n")
    with pytest.warns(UserWarning, match=r"\[b.csv\] No column matches"):
        done = wm.run_pipeline(spark, manifest, spec)
    assert [(r["dataset"], r["issue_type"]) for r in done.issues.collect()] == [("b.csv", "no_match")]


def test_plan_does_not_grow_with_the_files(spark, tmp_path):
    """A row finds its dataset by a join: ten thousand files make the plan of ten."""
    sizes = {}
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", 16)
    for n in (10, 10_000):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"f{i}.csv").write_text(f"Alder;Siv\n{i};1\n")
        groups = group_files(spark, read_manifest([(str(folder / f"f{i}.csv"), i) for i in range(n)]))
        assert len(groups) == 1
        df = scan(spark, groups[0])
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        sizes[n] = len([x for x in plan.splitlines()]), plan.count(".csv")
        assert df.filter(F.concat(F.lit("f"), "_c0", F.lit(".csv")) == F.col("dataset")).count() == n
    spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    assert sizes[10][0] == sizes[10_000][0] and sizes[10_000][1] <= sizes[10][1] + 30


def scans_of(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len([line for line in plan.splitlines() if " Relation [" in line and line.endswith(" csv")])


def test_bad_columns_make_no_plans(spark, spec, tmp_path):
    """Files of one header differ in types, lost casts and years; they are still read by one scan."""
    cells = {"siv": ["1", "D", "2.5"], "alder": ["40", "x", "3000000000"], "antpers": ["q", "99", ""]}
    manifest, want, i = [], {}, 0
    for a in cells["siv"]:
        for b in cells["alder"]:
            for c in cells["antpers"]:
                path = tmp_path / f"f{i}.csv"
                path.write_text(f"Siv,Alder,Antpers\n{a},{b},{c}\n1,50,2\n1,50,2\n,,\n")
                manifest.append((str(path), 2000 + i % 3 if i % 5 else None))
                want[path.name], i = (a, b, c), i + 1
    done = wm.run_pipeline(spark, manifest, spec, apply_missing=True)
    assert len(done.parts) == 1
    for df in (done.merged(), done.cells, done.codes):
        assert scans_of(df) == 1
    assert all(scans_of(t) == 1 for part in done.parts for t in part.tables())
    for path, year in manifest[::13]:  # as the file by itself
        one = wm.run_pipeline(spark, [(path, year)], spec, apply_missing=True)
        name = os.path.basename(path)
        assert one.tables[name].dtypes == done.tables[name].dtypes
        assert sorted(map(str, one.tables[name].collect())) == sorted(map(str, done.tables[name].collect()))
        for found in ("issues", "cells", "codes"):
            mine = getattr(done, found).filter(F.col("dataset") == name).collect()
            assert sorted(map(str, mine)) == sorted(map(str, getattr(one, found).collect()))
    merged = done.merged(keep_dataset=True)
    assert dict(merged.dtypes) == {"year": "int", "siv": "string", "alder": "string", "antpers": "string",
                                   "dataset": "string"}
    rows = {(r["dataset"], r["year"], r["siv"], r["alder"], r["antpers"]) for r in merged.collect()}
    for path, year in manifest:
        name = os.path.basename(path)
        a, b, c = want[name]
        plain = ["1", "50", "2"]
        assert (name, year, *plain) in rows
        kept = {"": None, "99": None, "2.5": "2"}
        assert (name, year, *(kept.get(x, x) for x in (a, b, c))) in rows
    assert len(rows) == 2 * len(manifest)


def test_written_tables_have_their_own_types(spark, spec, tmp_path):
    manifest = texts(tmp_path, a="Siv,Alder\n1,40\n", b="Siv,Alder\nD,41\n", c="Siv,Alder\nE,x\n")
    done = wm.run_pipeline(spark, manifest, spec, output_path=str(tmp_path / "out"), format="parquet")
    types = {f: dict(spark.read.parquet(str(tmp_path / "out" / f"dataset={f}_csv_clean")).dtypes) for f in "abc"}
    assert {f: (t["siv"], t["alder"]) for f, t in types.items()} == {
        "a": ("int", "int"), "b": ("string", "int"), "c": ("string", "string")}
    assert {tuple(r) for r in done.merged().select("siv", "alder").collect()} == {("1", "40"), ("D", "41"), ("E", "x")}


def test_a_logical_variable_that_some_files_keep_as_text(spark, tmp_path):
    """Its codes are judged as they are in each file, also where the types of all are stacked."""
    spec = wm.Spec.from_dict({"smokes": {"colnames": ["smokes"], "type": "logical", "value": {1: "Yes"}}})
    manifest = texts(tmp_path, a="smokes\nTRUE\nFALSE\n", b="smokes\nTRUE\nmaybe\n")
    done = wm.run_pipeline(spark, manifest, spec)
    codes = {(r["dataset"], r["value"]) for r in done.codes.collect()}
    assert codes == {("a.csv", "0")} | {c for c in codes if c[0] == "b.csv"}
    [(_, report)] = done.validation().values()
    assert [r["n_bad"] for r in report.filter("dataset = 'a.csv'").collect()] == [1]
    assert {r[0] for r in done.merged().select("smokes").collect()} == {"TRUE", "FALSE", "maybe"}
