import random
import re

import pytest
from pyspark.sql import functions as F

import brute
from wavemeld.functions.names import normalise, safe_label, unique_header
from wavemeld.operators.catalogue import header_catalogue, unique_names
from wavemeld.operators.matching import (contenders, fuzzy_candidates, keyword_candidates, match_columns, match_report,
                                         match_report_lines, name_candidates, settle_claims)
from wavemeld.operators.running import running_rank, running_total
from wavemeld.spec import Spec


def catalogue(spark, headers):
    rows = [(d, i, n) for d, names in headers.items() for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "dataset string, ordinal bigint, raw_name string")


def matched(spark, headers, spec, **kw):
    out = {d: {} for d in headers}
    for r in match_columns(catalogue(spark, headers), spec, **kw).log.collect():
        layer = "keyword" if r["method"].startswith("keyword") else r["method"]
        out[r["dataset"]][r["raw_name"]] = (r["canonical"], layer)
    return out


def test_normalise(spark):
    df = spark.createDataFrame([("IO_Kjonn",), ("My Col!",), ("__a--b__",), ("Kjønn",), ("!!",)], "n string")
    assert [r[0] for r in df.select(normalise("n")).collect()] == ["io_kjonn", "my_col", "a_b", "kj_nn", ""]
    df = spark.createDataFrame([("wave 1.csv",)], "n string")
    assert df.select(safe_label("n")).first()[0] == "wave_1_csv"


def test_unique_header():
    assert unique_header(["a", "a"]) == ["a", "a_1"]
    assert unique_header(["a", "a", "a_1", "a"]) == ["a", "a_2", "a_1", "a_3"]


@pytest.mark.parametrize("slice_size", [2, 7, 32768])
def test_unique_names_is_the_same_rule(spark, slice_size):
    rng = random.Random(3)
    headers = {f"d{k}": [rng.choice(["a", "b", "a_1", "a_2", "b_3", "a_1_1", "c"]) for _ in range(n)]
               for k, n in enumerate([0, 1, 5, 20, 60])}
    headers["hot"] = ["a"] * 40 + ["a_3", "a_3", "a_40", "a_41"] + ["a"] * 20
    got = {}
    for r in unique_names(catalogue(spark, headers), slice_size).orderBy("dataset", "ordinal").collect():
        got.setdefault(r["dataset"], []).append(r["raw_name"])
    for d, names in headers.items():
        assert got.get(d, []) == brute.make_unique(names) == unique_header(names)


def test_unique_names_shuffle_the_columns_once(spark):
    """Numbers that are taken, also twice or by a name without a base, and rows without a dataset; one shuffle by name."""
    headers = {"d": ["a", "a_2", "a", "a_1", "a", "a_2", "a_7", "b_1", "b_1", "c_", "c_", "c__1", "a"], "e": ["a", "a"], None: ["a", "a", "a_1"]}
    named = unique_names(catalogue(spark, headers))
    got = {}
    for r in named.orderBy("ordinal").collect():
        got.setdefault(r["dataset"], []).append(r["raw_name"])
    assert got.pop(None) == ["a", "a_1", "a_1"]  # rows without a dataset are numbered, nothing is taken among them
    assert got == {d: unique_header(headers[d]) for d in got} and set(got) == {"d", "e"}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = named._jdf.queryExecution().executedPlan().toString().splitlines()
        assert sum(bool(re.search(r"- Exchange hashpartitioning", line)) for line in lines) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_running_total_over_slices(spark):
    df = spark.createDataFrame([("k" if i % 3 else "m", i, i % 5) for i in range(200)], "key string, pos bigint, v bigint")
    rows = running_total(df, ["key"], "pos", "v", "t", slice_size=8).orderBy("pos").collect()
    sums = {}
    for r in rows:
        sums[r["key"]] = sums.get(r["key"], 0) + r["v"]
        assert r["t"] == sums[r["key"]]
    ranks = running_rank(df, ["key"], "pos", "rk", slice_size=16).groupBy("key").agg(F.max("rk"), F.count("*")).collect()
    assert all(r[1] == r[2] for r in ranks)


def test_layers_on_one_header(spark, spec):
    got = matched(spark, {"d": ["io_kjonn", "alderr", "siv", "xyz_totally_unknown_abc"]}, spec)["d"]
    assert got == {"io_kjonn": ("kjonn", "keyword"), "alderr": ("alder", "fuzzy"), "siv": ("siv", "exact")}


def test_each_canonical_once(spark, spec):
    got = matched(spark, {"d": ["kjonn", "io_kjonn", "sex"]}, spec)["d"]
    assert got == {"kjonn": ("kjonn", "exact")}


def test_methods_and_unmatched(spark, spec):
    result = match_columns(catalogue(spark, {"d": ["kjonn", "alderr", "io_siv", "zzzzzz"]}), spec)
    rows = {r["raw_name"]: r for r in result.log.collect()}
    assert rows["io_siv"]["method"] == "keyword [siv]" and rows["io_siv"]["confidence"] == "low"
    assert rows["alderr"]["confidence"] == "medium" and rows["alderr"]["needs_review"]
    assert not rows["kjonn"]["needs_review"]
    assert [r["raw_name"] for r in result.unmatched.collect()] == ["zzzzzz"]
    assert {r["raw_name"] for r in result.renames.collect()} == {"alderr", "io_siv"}


def test_keyword_patterns(spark, spec):
    df = spark.createDataFrame([("io_kjonn",), ("kjonn",), ("kjonnstudie",), ("my_age_sex",)], "n string")
    got = [r[0] for r in df.select(keyword_candidates(F.col("n"), spec)).collect()]
    assert got == [["kjonn"], ["kjonn"], [], ["kjonn", "alder"]]


def test_longest_keyword_is_named(spark):
    spec = Spec.from_dict({"v": {"keywords": ["age", "ageyrs", "a+b"]}})
    with pytest.warns(UserWarning):
        log = match_columns(catalogue(spark, {"d": ["x_ageyrs"], "e": ["x_age_ageyrs"], "f": ["x_A+b"]}), spec).log
    assert {r["dataset"]: r["method"] for r in log.collect()} == {
        "d": "keyword [ageyrs]", "e": "keyword [ageyrs]", "f": "keyword [a+b]"}


def test_fuzzy_is_a_substring_search(spark):
    spec = Spec.from_dict({"alder": {"colnames": ["age_yrs"]}, "k": {"colnames": ["Kjonn"]}})
    names = ["age", "io_kjonn", "kjon", "x", "age_yrz", "ageyrs", "", "kjønn", "age_years_long"]
    got = {r["raw_name"]: r["fuzzy"] for r in fuzzy_candidates(
        spark.createDataFrame([(n,) for n in names], "raw_name string"), spec).collect()}
    assert got == {n: f for n in names if (f := brute.fuzzy(n, spec.aliases))}
    assert got["age"] == "alder" and "io_kjonn" not in got and got["x"] == "alder"


def test_fuzzy_against_brute_force(spark):
    rng = random.Random(11)
    spec = Spec.from_dict({f"c{i}": {"colnames": ["".join(rng.choice("abc_") for _ in range(rng.randint(1, 14)))]}
                           for i in range(12)})
    names = {"".join(rng.choice("abc_") for _ in range(rng.randint(1, 18))) for _ in range(400)}
    got = {r["raw_name"]: r["fuzzy"] for r in fuzzy_candidates(
        spark.createDataFrame([(n,) for n in names], "raw_name string"), spec).collect()}
    want = {n: f for n in names if (f := brute.fuzzy(n, spec.aliases))}
    assert got == want


def test_fuzzy_with_whole_edits_against_brute_force(spark):
    """More edits than letters, too, where pieces are empty."""
    rng = random.Random(12)
    spec = Spec.from_dict({f"c{i}": {"colnames": ["".join(rng.choice("ab_") for _ in range(rng.randint(1, 9)))]}
                           for i in range(8)})
    names = {"".join(rng.choice("ab_") for _ in range(rng.randint(1, 12))) for _ in range(150)}
    for edits in (1, 2, 3):
        got = {r["raw_name"]: r["fuzzy"] for r in fuzzy_candidates(
            spark.createDataFrame([(n,) for n in names], "raw_name string"), spec, edits).collect()}
        assert got == {n: f for n in names if (f := brute.fuzzy(n, spec.aliases, edits=edits))}


def test_size_of_the_pieces_decides_the_join(spark):
    """No hint: the optimizer knows how large the index is."""
    spec = Spec.from_dict({"alder": {"colnames": ["age_yrs"]}, "k": {"colnames": ["Kjonn"]}})
    names = spark.createDataFrame([("age",), ("kjon",), ("zzzzzzzz",)], "raw_name string")
    few = fuzzy_candidates(names, spec)
    assert "BroadcastHashJoin [piece" in few._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 500)
    many = fuzzy_candidates(names, spec)
    assert "SortMergeJoin [piece" in many._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) == [("age", "alder"), ("kjon", "k")]


def test_claims_against_brute_force(spark):
    rng = random.Random(5)
    words = ["sex", "age", "home", "town", "pay"]
    spec = Spec.from_dict({
        "a": {"colnames": ["sexx"], "keywords": ["sex", "age"]},
        "b": {"colnames": ["agee", "home_x"], "keywords": ["age", "home", "sex"]},
        "c": {"colnames": ["townn"], "keywords": ["town", "home"]},
        "d": {"colnames": ["pay_long_name"], "keywords": ["pay", "town", "sex"]},
    })
    pool = ["sexx", "agee", "home_x", "townn", "sexy", "ageee", "tow"] + [f"{a}_{b}" for a in words for b in words]
    headers = {f"d{i}": [rng.choice(pool) for _ in range(rng.randint(1, 25))] for i in range(60)}
    headers["hot"] = [rng.choice(pool) + f"_{i}" for i in range(3000)] + ["sexx", "agee"]
    got = matched(spark, headers, spec)
    for d, names in headers.items():
        assert got[d] == brute.match(names, spec), d


def test_contenders_are_few(spark):
    spec = Spec.from_dict({"a": {"keywords": ["age"], "colnames": ["qqqqqq"]}, "b": {"keywords": ["age"]}})
    cols = catalogue(spark, {"hot": [f"age_{i}" for i in range(5000)]})
    kept = contenders(name_candidates(cols, spec), 2)
    assert kept.count() <= 3 * 2 * 2
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_claims_of_a_thousand_variables(spark):
    rng = random.Random(7)
    spec = Spec.from_dict({f"v{i:03d}": {"colnames": [f"col_{i:03d}"]} for i in range(1000)})
    layers = ("exact", "fuzzy", "keyword")
    rows = []
    for d, n in [("hot", 6000), ("small", 40), ("none", 3)]:
        for i in range(n):
            wish = [[f"v{rng.randint(0, 999) if rng.random() < .5 else rng.randint(0, 30):03d}"
                     for _ in range(rng.choice(sizes))] for sizes in ((0, 0, 1), (0, 1), (0, 2, 30))]
            rows.append((d, i, f"c{i}", *([list(dict.fromkeys(w)) for w in wish] if d != "none" else [[]] * 3)))
    rng.shuffle(rows)
    schema = "dataset string, ordinal bigint, raw_name string, " + ", ".join(f"{x} array<string>" for x in layers)
    winners = settle_claims(spark.createDataFrame(rows, schema).repartition(7), len(spec.variables))
    got = {(r["dataset"], r["ordinal"]): (r["canonical"], r["layer"]) for r in winners.collect()}
    want, taken = {}, set()
    for at, layer in enumerate(layers):
        for d, ordinal, _, *wishes in sorted(rows, key=lambda r: r[1]):
            free = [c for c in wishes[at] if (d, c) not in taken]
            if free and (d, ordinal) not in want:
                want[d, ordinal] = free[0], layer
                taken.add((d, free[0]))
    assert got == want and sum(d == "hot" for d, _ in got) > 900
    plan = winners._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan


def test_report(spark, spec):
    result = match_columns(catalogue(spark, {"d": ["kjonn", "io_siv", *[f"zz{i}qqqq" for i in range(7)]]}), spec)
    assert {r["tier"]: r["n"] for r in match_report(result).collect()} == {"exact": 1, "keyword": 1, "unmatched": 7}
    lines = {(r["tier"], r["line"]): r["text"] for r in match_report_lines(result).collect()}
    assert lines["exact", 1] == "kjonn -> kjonn"
    assert lines["keyword", 1] == "io_siv -> siv matched by keyword [siv]"
    assert lines["unmatched", 1] == "zz0qqqq, zz1qqqq, zz2qqqq, zz3qqqq, zz4qqqq"
    assert lines["unmatched", 2] == "zz5qqqq, zz6qqqq"


def test_lines_are_put_together_in_their_slice(spark, spec):
    """Lines over the border of two slices are whole, and only lines that are not full are dealt by line."""
    headers = {"d": [f"zz{i}qqqq" for i in range(32_770)], "e": ["zz1qqqq", "kjonn"]}
    cols = catalogue(spark, headers).withColumn("ordinal", F.expr("ordinal + if(dataset = 'd', 32768 - 17, 0)"))
    lines = match_report_lines(match_columns(cols, spec))
    got = {(r["dataset"], r["tier"], r["line"]): r["text"] for r in lines.collect()}
    assert got.pop(("e", "exact", 1)) == "kjonn -> kjonn" and got.pop(("e", "unmatched", 1)) == "zz1qqqq"
    names = headers["d"]
    assert got == {("d", "unmatched", i // 5 + 1): ", ".join(names[i:i + 5]) for i in range(0, len(names), 5)}
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[dataset#\d+, tier#\d+, _slice#\d+L, line", plan)


def test_header_catalogue(spark):
    rows = header_catalogue(spark, {"d": ["A b", "a_b", "C!"]}).orderBy("ordinal").collect()
    assert [r["raw_name"] for r in rows] == ["a_b", "a_b_1", "c"]


def test_columns_are_shuffled_once_for_matching(spark, spec):
    """Neither the fuzzy layer, nor a year that the catalogue brings along, nor a report without positions moves the columns again."""
    from wavemeld.operators.catalogue import first_positions
    from wavemeld.plans.audit import audit_log
    from wavemeld.plans.report import unmatched
    rows = [(f"d{i % 3}", i, f"name{i % 40}", 2000 + i % 3) for i in range(300)] + [("d0", 300, "kjon", 2000)]
    cols = spark.createDataFrame(rows, "dataset string, ordinal bigint, raw_name string, year int").repartition(3)
    log = audit_log(match_columns(cols, spec), None, "now")
    plain = audit_log(match_columns(cols.drop("year"), spec), cols.select("dataset", "year").distinct(), "now")
    assert sorted(map(str, log.collect())) == sorted(map(str, plain.collect()))
    assert [r["canonical"] for r in log.filter("raw_name = 'kjon'").collect()] == ["kjonn"]
    first = first_positions(cols)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for frame in (log.select("*"), unmatched(log)):
            assert "Exchange hashpartitioning(raw_name" not in frame._jdf.queryExecution().executedPlan().toString()
        both = first.select("dataset", "raw_name").union(first.filter("ordinal > 3").select("dataset", "raw_name"))
        assert "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_columns_are_dealt_once_whatever_is_read(spark, spec):
    """Neither tests that the optimizer adds to the fuzzy layer, nor columns that a report leaves out make a second shuffle of
    all columns, and no task of the scan keeps a table of them."""
    from wavemeld.plans.audit import audit_log
    rows = [(f"d{i % 3}", i, f"name{i % 40}", 2000 + i % 3) for i in range(300)] + [("d0", 300, "kjon", 2000)]
    cols = spark.createDataFrame(rows, "dataset string, ordinal bigint, raw_name string, year int")
    log = audit_log(match_columns(cols, spec), None, "now")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for frame in (log, log.select("dataset", "raw_name", "method"), log.groupBy("method").count()):
            lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
            dealt = [i for i, line in enumerate(lines) if re.search(r"- Exchange hashpartitioning\(dataset#\d+, raw_name#\d+,", line)]
            assert len(dealt) == 2  # the columns, and the few winners
            assert not any("HashAggregate" in lines[i + 1] for i in dealt)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_master_files_match_once(spark, tmp_path, monkeypatch):
    """Both updates of the master log read the rows that one matching has written."""
    from wavemeld.plans import audit
    from wavemeld.queries import registry
    docs = spark.createDataFrame([(1, "en", "the tion was", 12), (2, "de", "der was http", 12)],
                                 "doc_id bigint, lang string, text string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plans = []
    update = audit.update_master_log
    monkeypatch.setattr(audit, "update_master_log", lambda log, folder: (
        plans.append(log._jdf.queryExecution().optimizedPlan().toString()), update(log, folder)))
    rows = registry.audit_master_files(spark, str(tmp_path)).collect()
    assert len(plans) == 2 and not any("Generate" in p or "Join" in p for p in plans)
    assert {(r["dataset"], r["logged_at"]) for r in rows} == {("en", registry.NEW_STAMP), ("de", registry.OLD_STAMP)}
    assert {r["raw_name"] for r in rows} == {"1/the", "1/tion", "1/was", "2/der", "2/was", "2/http"}


def test_repeats_near_each_other_are_not_shuffled(spark, spec):
    """A word that a file repeats goes once a batch to the shuffle of the columns, with its first position; no row is lost."""
    from wavemeld.operators.catalogue import first_positions
    rows = [("d0", i, f"name{i % 5}", 2000) for i in range(400, 0, -1)] + [("d1", 7, "name0", None), ("d1", 3, "name0", None),
            (None, 1, "name0", 2000), ("d0", 0, None, 2000)]
    cols = spark.createDataFrame(rows, "dataset string, ordinal bigint, raw_name string, year int").repartition(1)
    first = first_positions(cols)
    assert sorted(map(tuple, first.select("dataset", "raw_name", "ordinal", "year").collect()), key=str) == sorted(
        [("d0", f"name{i % 5}", i, 2000) for i in range(1, 6)] + [("d1", "name0", 3, None)], key=str)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = first_positions(cols)._jdf.queryExecution().executedPlan()
        plan.execute().count()
        metrics = {}
        todo = [plan]
        while todo:
            node = todo.pop()
            if "REPARTITION_BY_COL" in node.simpleString(200):
                metrics["written"] = node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
        assert metrics["written"] == 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_names_are_asked_once(spark, spec):
    """However many datasets have a name, it is held against the map once; the rows are those of a lazy match of unique columns."""
    rng = random.Random(21)
    pool = ["kjonn", "kjon", "io_kjonn", "sex", "alder", "alderr", "x", "age_yrs", "siv", "zzqq", "", "my_age_sex"] + [
        f"other_{i}_name" for i in range(30)]
    rows = [(f"d{d}", i, n, 2000 + d % 3) for d in range(40) for i, n in enumerate(rng.sample(pool, rng.randint(1, len(pool))))]
    cols = spark.createDataFrame(rows, "dataset string, ordinal bigint, raw_name string, year int")
    more = cols.unionByName(cols.withColumn("ordinal", F.col("ordinal") + 100)).unionByName(
        spark.createDataFrame([(None, 1, "sex", 2000), ("d0", 99, None, 2000)], cols.schema))
    lazy, done = match_columns(cols, spec, unique=True), match_columns(more, spec)
    for want, got in ((lazy.log, done.log), (lazy.unmatched, done.unmatched)):
        assert got.columns == want.columns and want.count() > 40
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert "levenshtein" in want._jdf.queryExecution().optimizedPlan().toString()
        assert "levenshtein" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_names_in_normal_form_stay(spark):
    from wavemeld.functions.names import normalise, normalise_text
    names = ["ab1", "A b", "_x_", "", "--", "a__b", "Kelvin", "Øl 2", "x\ny"]
    df = spark.createDataFrame([(n,) for n in [*names, None]], "n string")
    assert [r[0] for r in df.select(normalise("n")).collect()] == [*map(normalise_text, names), None]


def test_report_has_counts_and_entries(spark, spec):
    """The report names the columns of each tier beside their number, as the one that the reference prints."""
    result = match_columns(catalogue(spark, {"d": ["kjonn", "io_siv", *[f"zz{i}qqqq" for i in range(7)]], "e": ["alderr"]}), spec)
    assert sorted(map(tuple, match_report(result).collect())) == [
        ("d", "exact", 1, 1, "kjonn -> kjonn"), ("d", "keyword", 1, 1, "io_siv -> siv matched by keyword [siv]"),
        ("d", "unmatched", 7, 1, "zz0qqqq, zz1qqqq, zz2qqqq, zz3qqqq, zz4qqqq"), ("d", "unmatched", 7, 2, "zz5qqqq, zz6qqqq"),
        ("e", "fuzzy", 1, 1, "alderr -> alder")]
