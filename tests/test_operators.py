"""Rules, sheets, project questions, counts, joins, DE: the documented edge cases."""

import pytest
from pyspark.sql import functions as F

from readloom.functions import text as T
from readloom.functions.ranking import number_rows
from readloom.operators import counts as C
from readloom.operators import de as D
from readloom.operators import joins as J
from readloom.operators import project as P
from readloom.operators import queries as Q
from readloom.operators import rules as R
from readloom.operators import sample_qc as S
from readloom.operators import sheets as M
from readloom.operators import validation as V


@pytest.fixture
def metric(spark):
    def make(unique, assign):
        return spark.createDataFrame([("s", unique, assign)],
                                     "sample_id string, uniquely_mapped_pct double, assignment_rate double")
    return make


@pytest.mark.parametrize("unique,assign,status,issues", [
    (93.57, 78.34, "PASS", []),
    (36.18, 6.74, "FAIL", [("critical", "Low uniquely mapped rate: 36.2%"), ("critical", "Low assignment rate: 6.7%")]),
    (60.0, 80.0, "WARN", [("warning", "Low uniquely mapped rate: 60.0%")]),
    (70.0, 50.0, "PASS", []),
    (49.9, 80.0, "FAIL", [("critical", "Low uniquely mapped rate: 49.9%")]),
    (None, 80.0, "FAIL", [("critical", "Low uniquely mapped rate: 0.0%")]),
])
def test_sample_status(metric, unique, assign, status, issues):
    df = metric(unique, assign)
    assert S.sample_status(df).first().status == status
    got = [(r.severity, r.message) for r in S.sample_issues(df).collect()]
    assert sorted(got) == sorted(issues)
    assert len(df.select(S.issue_array().alias("i")).first().i) == len(issues)


def test_severity_is_monotone(spark):
    values = [(float(i), 60.0) for i in range(0, 101, 5)]
    df = spark.createDataFrame(values, "uniquely_mapped_pct double, assignment_rate double")
    got = [r[0] for r in df.select(R.severity(R.SAMPLE_RULES)).collect()]
    assert got == sorted(got, reverse=True)


def test_assay_profiles_take_the_worst(spark):
    df = spark.createDataFrame([("s", 0.001, 10.0, 1.0)], "sample_id string, frip double, peak_count double, nsc double")
    assert R.verdict(df, R.CHIP_RULES).first().status == "FAIL"
    long = df.unpivot("sample_id", ["frip", "peak_count", "nsc"], "metric", "value")
    assert sorted((r.code, r.severity) for r in R.apply_rules(long, R.CHIP_RULES).collect()) == [
        ("frip", 2), ("nsc", 1), ("peak_count", 1)]
    wgs = spark.createDataFrame([("s", 35.0, 95.0, 2.0)], "sample_id string, mean_coverage double, pct_20x double, ti_tv_ratio double")
    assert R.verdict(wgs, R.WGS_RULES).first().status == "PASS"


def test_recommendations_and_steps(spark):
    df = spark.createDataFrame([(s,) for s in ["PASS", "WARN", "FAIL", "UNKNOWN"]], "status string")
    got = {r.status: (r.r, r.n) for r in df.select(
        "status", S.recommendations(F.col("status"), F.array(F.lit("m"))).alias("r"), S.next_steps(F.col("status")).alias("n")).collect()}
    assert got["PASS"][0] == ["Sample quality is sufficient for downstream analysis"]
    assert got["WARN"][0][-1] == "m" and len(got["FAIL"][0]) == 4
    assert got["UNKNOWN"][1] == ["review_outputs"]


@pytest.mark.parametrize("name,ok", [("a-b_9", True), ("a\n", False), ("a b", False), ("x" * 100, True), ("x" * 101, False), ("", False), ("../a", False)])
def test_identifiers(spark, name, ok):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(T.valid_identifier(F.col("n"))).first()[0] is ok


def test_names_and_numbers(spark):
    df = spark.createDataFrame([("pairs: 52,280 (1%)", "12.5%", "out/s1/Aligned.sortedByCoord.out.bam", "x.bam", "a/b.bam/c", "r_1.fastq")],
                               "n string, p string, a string, b string, c string, f string")
    got = df.select(
        T.first_number(F.col("n")), T.percent(F.col("p")), T.matrix_sample(F.col("a")), T.matrix_sample(F.col("b")),
        T.matrix_sample(F.col("c")), T.second_mate_path(F.col("f")), T.readable_size(F.lit(1536)), T.readable_size(F.lit(2**60))).first()
    assert tuple(got) == (52280, 12.5, "s1", "x", "c", "r_2.fastq", "1.5KB", "1024.0PB")


@pytest.mark.parametrize("sid,want", [("x_WT", "wildtype"), ("nMonTg1", "non_stimulated"), ("MonTg1", "transgenic"), ("Ctrl_3", "wildtype"),
                                      ("KO_T", "treatment"), ("zzz", "unknown"), ("x_h", "unknown")])
def test_infer_condition(spark, sid, want):
    assert spark.createDataFrame([(sid,)], "s string").select(M.infer_condition(F.col("s"))).first()[0] == want


def test_metadata_maps(spark):
    df = spark.createDataFrame([("s", "", 0, float("nan"), "0", 2.0)],
                               "sample_id string, condition string, batch int, age double, notes string, replicate double")
    fields = ["condition", "batch", "age", "notes", "replicate"]
    assert M.manifest_metadata(df, fields).first().sample_metadata == {"notes": "0", "replicate": "2.0"}
    assert M.manifest_metadata(df, fields, drop_falsy=False).first().sample_metadata["batch"] == "0"
    assert M.sheet_metadata(df, ["replicate", "notes"]).first().sheet_metadata == {"replicate": "2", "notes": "0"}


def test_sheet_value_blocks_fallback(spark, rows):
    sheet = spark.createDataFrame([("a", "tissue", ""), ("a", "sex", "F")], "sample_id string, axis string, value string")
    manifest = spark.createDataFrame([("a", "tissue", "liver"), ("a", "age", "3"), ("b", "tissue", "skin")], "sample_id string, axis string, value string")
    merged = P.merge_metadata(sheet, manifest)
    assert rows(merged) == [("a", "age", "3"), ("a", "sex", "F"), ("a", "tissue", ""), ("b", "tissue", "skin")]
    assert rows(P.sample_axes(merged)) == [("age", "3", "a"), ("sex", "F", "a"), ("tissue", "skin", "b")]


@pytest.fixture
def small(spark):
    axes = spark.createDataFrame([
        ("condition", "wt", "a"), ("condition", "wt", "b"), ("condition", "het", "c"), ("condition", "het", "d"),
        ("tissue", "HPC", "a"), ("tissue", "PFC", "b"), ("tissue", "HPC", "c"), ("tissue", "PFC", "d")],
        "axis string, value string, sample_id string")
    metrics = spark.createDataFrame([("a", 90.0, 70.0, "PASS"), ("b", 80.0, 60.0, "WARN"), ("c", 40.0, 20.0, "FAIL")],
                                    "sample_id string, uniquely_mapped_pct double, assignment_rate double, status string")
    return axes, metrics


def test_questions(small, rows):
    axes, metrics = small
    got = {r.value: (r.n_samples, r.mean_uniquely_mapped, r.passed, r.failed) for r in Q.compare_axis(axes, metrics, "condition").collect()}
    assert got == {"wt": (2, 85.0, 1, 1), "het": (2, 40.0, 0, 1)}
    got = rows(Q.compare_axis(axes, metrics, "condition", {"tissue": "pfc"}), "value", "n_samples")
    assert got == [("wt", 1)]  # d has no metrics, so its group is dropped
    assert rows(Q.filter_samples(axes, {"tissue": "hpc", "condition": "HET"})) == [("c",)]
    assert rows(Q.filter_samples(axes, {"Tissue": "HPC"})) == []
    assert rows(Q.filter_samples(axes, {"tissue": "none"})) == []
    assert rows(Q.failed(metrics)) == [("b",), ("c",)]
    groups = axes.where("axis = 'condition'").withColumnRenamed("value", "condition")
    assert rows(Q.compare(groups, metrics)) == [("het", 2, 40.0, 20.0, 0, 1), ("wt", 2, 85.0, 65.0, 1, 1)]
    assert Q.status(metrics, "p").first().pass_rate == "33.33%"


def test_filter_takes_one_spelling(spark, rows):
    axes = spark.createDataFrame([("sex", "Male", "a"), ("sex", "male", "b")], "axis string, value string, sample_id string")
    assert rows(Q.filter_samples(axes, {"sex": "MALE"})) == [("a",)]


def test_group_sets_equal_single_axes(small, rows):
    axes, metrics = small
    wide = axes.groupBy("sample_id").pivot("axis", ["condition", "tissue"]).agg(F.first("value")).join(metrics, "sample_id")
    one = Q.compare_columns(wide, ["condition", "tissue"])
    assert rows(one, "axis", "value", "mean_uniquely_mapped") == [
        ("condition", "het", 40.0), ("condition", "wt", 85.0), ("tissue", "HPC", 65.0), ("tissue", "PFC", 80.0)]


def test_empty_project(spark):
    none = spark.createDataFrame([], "sample_id string, status string, uniquely_mapped_pct double, assignment_rate double, total_reads bigint")
    got = P.status_summary(none).first()
    assert (got.total_samples, got.pass_rate) == (0, 0.0)


def test_counts(spark, rows):
    df = spark.createDataFrame([("g1", "a", 10000), ("g2", "a", 10001), ("g3", "a", 20000), ("g1", "b", 0), ("g2", "b", 0), ("g4", "b", 0)],
                               "gene_id string, sample_id string, count bigint")
    assert rows(C.highly_expressed(df), "sample_id", "gene_id", "rank") == [("a", "g2", 2), ("a", "g3", 1)]
    z = C.zero_genes(df).first()
    assert (z.n_genes, z.n_zero_genes, z.zero_pct, z.warn) == (4, 1, 25.0, False)
    v = {r.gene_id: r.variance for r in C.gene_variance(df).collect()}
    assert v["g1"] == 25_000_000.0 and v["g3"] == 0.0
    assert {r.gene_id: r.variance for r in C.gene_variance(df, 2).collect()}["g3"] == 100_000_000.0
    assert rows(C.to_wide(df, ["b", "a"])) == [("g1", 0, 10000), ("g2", 0, 10001), ("g3", 0, 20000), ("g4", 0, 0)]
    assert rows(C.lookup_genes(df, ["G4"]), "gene_id") == [("g4",)]
    from readloom.sources.matrix import long_counts

    back = long_counts(C.to_wide(df, ["a", "b"]), skip=1).where("count > 0")
    assert rows(back) == rows(df.where("count > 0"))


def test_variance_of_big_counts_is_exact(spark):
    df = spark.createDataFrame([("g", str(i), 4_000_000_000 + i) for i in range(4)], "gene_id string, sample_id string, count bigint")
    assert C.gene_variance(df).first().variance == 1.25


def test_numbering_is_exact_for_any_split(spark):
    data = [("hot", f"s{i:05d}") for i in range(3000)] + [(f"g{i % 7}", f"t{i:04d}") for i in range(300)]
    for parts, ranges in [(1, 4), (5, 64), (17, 1)]:
        df = spark.createDataFrame(data, "g string, k string").repartition(parts)
        got = {(r.g, r.k): r.n for r in number_rows(df, ["g"], ["k"], "n", ranges).collect()}
        for g in ["hot", "g0", "g6"]:
            keys = sorted(k for h, k in data if h == g)
            assert [got[g, k] for k in keys] == list(range(1, len(keys) + 1))
        assert got == {(r.g, r.k): r.n for r in number_rows(df, ["g"], ["k"], "n").collect()}


def test_match_names(spark, rows):
    known = spark.createDataFrame([("Control",), ("D1",), ("D3",)], "name string")
    names = spark.createDataFrame([("control",), ("1D",), ("3d",), ("XYZ",), ("D1",)], "name string")
    assert rows(J.match_names(names, known), "name", "match") == [("1D", "D1"), ("3d", "D3"), ("D1", "D1"), ("XYZ", None), ("control", "Control")]


def conditions(spark, names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "condition string, first_seen int")


@pytest.mark.parametrize("names,control", [(["D1", "Control", "D3"], "Control"), (["A", "B"], "A"), (["x", "Wild Type", "ctrl"], "Wild Type"), (["x", "mock-2"], "mock-2")])
def test_pick_control(spark, names, control):
    df = conditions(spark, names)
    assert D.pick_control(df).first().control == control
    pairs = D.pairwise_comparisons(df).orderBy("first_seen").collect()
    assert [(p.treatment, p.control) for p in pairs] == [(n, control) for n in names if n != control]


def test_significance(spark, rows):
    data = [("p", "g1", 1.0, 0.05), ("p", "g2", 1.0, 0.049), ("p", "g3", -1.0, 0.01), ("p", "g4", 0.5, 0.01), ("p", "g5", 2.0, None), ("q", "g1", None, 0.01)]
    df = spark.createDataFrame(data, "pair string, gene string, log2FoldChange double, padj double")
    assert rows(D.significant_counts(df, 0.05, 0.5)) == [("p", 2, 1, 1), ("q", 0, 0, 0)]
    assert rows(D.result_warnings(D.significant_counts(df)), "pair", "warning") == [("p", "few"), ("q", "none")]
    conf = spark.createDataFrame([("p",), ("z",)], "pair string")
    assert D.result_status(conf, df).first().status == "partial"
    assert rows(D.missing_pairs(conf, df)) == [("z",)]
    assert D.result_status(conf.where("pair = 'p'"), df).first().status == "success"
    assert D.result_status(conf.where("false"), df).first().status == "error"


def test_readiness(spark, rows):
    counts = spark.createDataFrame([("g", s, 1) for s in ["a", "b", "c", "d", "extra"]], "gene_id string, sample_id string, count bigint")
    meta = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("d", "y"), ("gone", "Z"), ("more", "Z")], "sample_id string, condition string")
    pairs = spark.createDataFrame([("x", "z"), ("y", "x")], "treatment string, control string")
    found = D.readiness_findings(counts, meta, pairs)
    assert rows(found) == [
        ("condition", "z", "error"), ("group_size", "Z", "warning"), ("group_size", "y", "error"), ("group_size", "y", "warning"),
        ("only_in_counts", "extra", "warning"), ("only_in_metadata", "gone", "error"), ("only_in_metadata", "more", "error")]
    assert D.readiness(found).first().status == "error"
    assert D.readiness(found.where("false")).first().status == "ok"
    fixes = D.check_conditions(pairs, meta)
    assert rows(D.apply_corrections(pairs, fixes)) == [("x", "Z", True), ("y", "x", False)]


def test_validation(spark):
    sheet = spark.createDataFrame([
        ("p", "a", "x", "y", "1", "paired-end", "1"), ("p", "a", "x", " ", "two", "odd", None), ("p", "b", None, "", "3", "", "2"), ("q", "c", "z", "z", "1", None, "1")],
        "project_id string, sample_id string, fastq_1 string, fastq_2 string, replicate string, read_type string, surprise string")
    listing = spark.createDataFrame([("x",), ("z",)], "path string")
    got = {(r.level, r.code) for r in V.validate(sheet, listing, "p").collect()}
    assert got == {("warning", "unknown_column"), ("warning", "project"), ("error", "null"), ("error", "blank"), ("error", "duplicate"),
                   ("warning", "non_numeric"), ("warning", "bad_value"), ("error", "missing_file")}
    assert V.missing_columns(sheet.drop("fastq_1")) == ["fastq_1"]
    assert V.validate(sheet, None, "nobody").where("code = 'project' and level = 'error'").count() == 1
    assert V.duplicate_rows(sheet).count() == 2


def test_converters(spark, rows):
    sheet = spark.createDataFrame([
        ("p", "a", "A", "wt", "1", "RNA-seq", "paired-end", "a_1", "a_2", "human", "GRCh38", "n1"),
        ("p", "b", "B", "wt", "2", "rna-SEQ", "single-end", "b_1", None, "human", "", None),
        ("p", "w", "W", "wt", "1", "WGS", "single-end", "w_1", "", "human", "", "")],
        "project_id string, sample_id string, sample_name string, condition string, replicate string, library_type string, read_type string, "
        "fastq_1 string, fastq_2 string, species string, genome_build string, notes string")
    assert rows(M.to_workflow_sheet(sheet, "snakemake")) == [("a", "wt", "1", "a_1", "a_2", "n1"), ("b", "wt", "2", "b_1", "", "")]
    assert M.to_workflow_sheet(sheet, "wdl").first().sample == '{"sample_id":"w","fastq_1":"w_1","read_type":"single-end"}'
    with pytest.raises(ValueError):
        M.require_rows(M.to_workflow_sheet(sheet, "nextflow"), "No samples found")
    with pytest.raises(ValueError):
        M.to_workflow_sheet(sheet.drop("species"), "snakemake")


def test_id_conflicts(spark, rows):
    df = spark.createDataFrame([("X_HPC_78M_W", "Female"), ("X_HPC_1F_H", "Female"), ("plain", "Male")], "sample_id string, sex string")
    assert rows(M.id_conflicts(df)) == [("X_HPC_78M_W", "Male", "Female")]
