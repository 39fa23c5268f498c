"""FastQC reports: parsing and verdicts on a good and a bad report."""

import pytest

from readloom.operators import fastqc_checks as E
from readloom.sources.fastqc import parse_fastqc, read_fastqc, read_multiqc

GOOD = """##FastQC\t0.12.1
stray\tline
>>Basic Statistics\tpass
#Measure\tValue
Total Sequences\t6,120,400
%GC\t45
>>END_MODULE
between\tmodules
>>Per base sequence quality\tpass
#Base\tMean\tMedian\tLQ\tUQ\tP10\tP90
1\t36.1\t37.0\t34.0\t38.0\t31.0\t39.0
2-74\t35.4\t36.0\t33.0\t38.0\t30.0\t39.0
75\t33.9\t34.0\t31.0\t36.0\t28.0\t38.0
>>END_MODULE
>>Per tile sequence quality\tfail
>>END_MODULE
>>Per sequence quality scores\tpass
#Quality\tCount
31\t2000400.0
36\t4120000.0
>>END_MODULE
>>Per base sequence content\tfail
>>END_MODULE
>>Per base N content\tpass
#Base\tN-Count
1\t0.4
75\t0.6
>>END_MODULE
>>Sequence Duplication Levels\tfail
>>END_MODULE
>>Overrepresented sequences\tfail
>>END_MODULE
>>Adapter Content\twarn
#Position\tUniversal\tOther
1\t0.2\t
40\t1.9\t0.1
64\t4.4\t0.2
>>END_MODULE
"""
BAD = """##FastQC\t0.12.1
>>Basic Statistics\tfail
Total Sequences\t91345
%GC\t26
>>END_MODULE
>>Per base sequence quality\tfail
1\t31.0\t32.0\t29.0\t34.0\t26.0\t36.0
40\t18.2\t18.5\t14.0\t21.0\t9.0\t24.0
75\t14.7\t15.0\t11.0\t18.0\t7.0\t21.0
>>END_MODULE
>>Per sequence quality scores\tfail
14\t41345.0
22\t50000.0
>>END_MODULE
>>Per base N content\tfail
1\t2.5
75\t11.4
>>END_MODULE
>>Adapter Content\tfail
1\t6.0
64\t31.7
>>END_MODULE
>>Bare Module
>>END_MODULE
"""


@pytest.fixture
def reports(spark, tmp_path):
    for name, text in [("g1", GOOD), ("g2", GOOD), ("g3", GOOD), ("b1", BAD), ("b2", BAD)]:
        d = tmp_path / f"{name}_fastqc"
        d.mkdir()
        (d / "fastqc_data.txt").write_text(text)
    return read_fastqc(spark, str(tmp_path)).cache()


@pytest.fixture
def samples(spark):
    return spark.createDataFrame([(s,) for s in ["g1", "g2", "g3", "b1", "b2", "lost"]], "sample_id string")


def found(df, sample, severity):
    return sorted(r.message for r in df.where(f"sample_id = '{sample}' and severity = {severity}").collect())


def test_rows(reports):
    good = reports.where("sample_id = 'g1'")
    assert good.where("module = 'Basic Statistics'").count() == 2
    assert good.where("get(cells, 0) in ('stray', 'between')").count() == 0
    assert good.where("module = 'Per tile sequence quality'").first().status == "fail"
    assert reports.where("module = 'Bare Module'").first().status == "unknown"


def test_untrimmed(reports, samples):
    got = {r.sample_id: r.status for r in E.report_status(reports, samples).collect()}
    assert got == {"g1": "PASS", "g2": "PASS", "g3": "PASS", "b1": "FAIL", "b2": "FAIL", "lost": "ERROR"}
    counts = {r.status: r.n for r in E.status_counts(E.report_status(reports, samples)).collect()}
    assert counts == {"PASS": 3, "FAIL": 2, "ERROR": 1}


def test_bad_findings(reports):
    f = E.report_findings(reports)
    assert found(f, "b1", 2) == [
        "Critical: High N content: 11.4% (max allowed: 10.0%)",
        "Critical: Low quality at positions: 40 (Q18.5), 75 (Q15.0)",
        "GC content out of range: 26% (expected: 30-70%)",
        "Total Sequences too low: 91,345 (minimum: 1,000,000)"]
    assert found(f, "b1", 1) == [
        "Adapter content: 31.70% - Trimming recommended",
        "Low Q30+ reads: 0.0% (expected: >75%)",
        "Module FAIL: Basic Statistics", "Module FAIL: Per base N content",
        "Module FAIL: Per base sequence quality", "Module FAIL: Per sequence quality scores"]
    assert found(f, "g1", 1) == found(f, "g1", 2) == []


def test_trimmed(reports, samples):
    f = E.report_findings(reports, trimmed=True)
    assert found(f, "g1", 2) == ["Adapter content after trimming: 4.40% (should be <1.0%)"]
    assert "Adapter content after trimming: 31.70% (should be <1.0%)" in found(f, "b1", 2)
    assert "Module FAIL: Adapter Content (should pass after trimming)" in found(f, "b1", 1)
    assert len(found(f, "b1", 2)) == 5 and len(found(f, "b1", 1)) == 6


def test_config_bounds(reports, samples):
    got = E.report_status(reports, samples, **E.CONFIG_BOUNDS)
    assert got.where("sample_id = 'g1'").first().status == "PASS"
    assert got.where("sample_id = 'g1'").first().recommendation.startswith("GOOD")


def test_order(reports, samples):
    out = E.report_order(E.report_status(reports, samples)).collect()
    assert [r.sample_id for r in out] == ["b1", "b2", "g1", "g2", "g3", "lost"]


@pytest.mark.parametrize(
    "median,lower,grade", [(20.0, 30.0, 1), (28.0, 10.0, 0), (19.9, 30.0, 2), (30.0, 9.0, 2), (25.0, 9.0, 1)])
def test_position_branches(spark, median, lower, grade):
    df = spark.createDataFrame([("s", 1, "1", median, lower)],
                               "sample_id string, row_no int, position string, median double, lower_quartile double")
    assert E.grade_positions(df).first().grade == grade


@pytest.mark.parametrize("pct,severity", [(5.0, None), (5.1, 1), (10.0, 1), (10.1, 2)])
def test_n_bounds(spark, pct, severity):
    df = spark.createDataFrame([("s", pct)], "sample_id string, n_pct double")
    got = E.check_n_content(df).collect()
    assert [r.severity for r in got] == ([] if severity is None else [severity])


def test_all_positions_are_named_or_the_first_shown(spark):
    df = spark.createDataFrame([("s", i, str(i), 10.0, 5.0) for i in range(1, 9)],
                               "sample_id string, row_no int, position string, median double, lower_quartile double")
    row = E.check_base_quality(df).first()
    assert row.message.count("(Q") == 8 and row.value == 8.0
    assert E.check_base_quality(df, shown=5).first().message.endswith(" 4 (Q10.0), 5 (Q10.0)")


def test_repeated_module_and_blank_adapter(spark):
    text = ">>Basic Statistics\tpass\n%GC\t40\n%GC\t50\n>>Adapter Content\tpass\n1\t\t\n2\t\t3.5\t"
    rows = parse_fastqc(spark.createDataFrame([("s", text)], "sample_id string, text string"))
    assert E.basic_stats(rows).first().gc == 50
    assert E.basic_stats(rows).first().total_sequences is None
    assert E.check_basic_stats(E.basic_stats(rows)).count() == 0
    assert {r.position: r.adapter_pct for r in E.adapter_rows(rows).collect()}["2"] == 3.5


def test_multiqc(spark, tmp_path):
    d = tmp_path / "a" / "multiqc_report_data"
    d.mkdir(parents=True)
    (d / "multiqc_fastqc.txt").write_text(
        "Sample\tFilename\t%GC\tbasic_statistics\tadapter_content\tper_sequence_gc_content\n"
        "s1\tx\t40\tpass\tfail\tfail\ns2\tx\t40\tfail\tpass\twarn\ns3\tx\t40\t\tpass\twarn\n")
    wide = read_multiqc(spark, str(tmp_path))
    got = {r.sample_id: (r.overall_pass, r.expected_fails)
           for r in E.multiqc_check_verdict(E.multiqc_checks(wide)).collect()}
    assert got == {"s1": (True, "adapter_content,per_sequence_gc_content"), "s2": (False, ""), "s3": (True, "")}
