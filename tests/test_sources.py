"""Readers on small invented files."""

import gzip
import hashlib
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from readloom.operators import artifacts as A
from readloom.operators import sample_qc as Q
from readloom.sources import de, documents, files, logs, matrix, sheets
from readloom.sources.text import number_lines, read_lines

ALIGN = """                          Number of input reads |\t1000
                    Average input read length |\t202
                                 UNIQUE READS:
                   Uniquely mapped reads number |\t900
                        Uniquely mapped reads % |\t90.00%
                      Mismatch rate per base, % |\t0.31%
        Number of reads mapped to multiple loci |\t50
             % of reads mapped to multiple loci |\t5.00%
        Number of reads unmapped: too short |\t40
             % of reads unmapped: too short |\t4.00%
   Number of input reads | twice | 7
"""


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_trim_logs(spark, tmp_path):
    write(tmp_path / "s1.log", "Total read pairs processed:   52,280,544\nPairs that were too short: 1,000 (0.0%)\n"
          "Pairs written (passing filters): 5\nPairs written (passing filters): 52,279,544\nTotal basepairs processed: 9 bp\n")
    write(tmp_path / "s2.log", "nothing here\nTotal read pairs processed: none\n")
    got = {r.sample_id: r for r in logs.read_trim_logs(spark, str(tmp_path)).collect()}
    assert tuple(got["s1"])[1:] == (52280544, 1000, 52279544, 9)
    assert got["s2"].total_pairs is None
    rate = Q.trim_rates(logs.read_trim_logs(spark, str(tmp_path))).where("sample_id = 's1'").first()
    assert rate.pass_rate == pytest.approx(100 * 52279544 / 52280544)


def test_align_logs(spark, tmp_path):
    write(tmp_path / "a" / "Log.final.out", ALIGN)
    write(tmp_path / "zero" / "Log.final.out", ALIGN.replace("reads |\t1000", "reads |\t0"))
    write(tmp_path / "part" / "Log.final.out", "\n".join(ALIGN.split("\n")[3:4]))
    got = {r.sample_id: r for r in logs.read_align_logs(spark, str(tmp_path)).collect()}
    assert got["a"].total_reads == 1000 and got["a"].total_mapped_reads == 950
    assert got["a"].total_mapped_pct == 95.0 and got["a"].mismatch_rate == 0.31
    assert got["zero"].total_mapped_pct is None
    assert got["part"].uniquely_mapped_reads == 900 and got["part"].total_mapped_reads is None
    report = logs.read_align_logs(spark, str(tmp_path), "report").where("sample_id = 'a'").first()
    assert (report.unique_mapped, report.unique_mapped_pct, report.unmapped_short) == (900, 90.0, 40)
    monitor = logs.read_align_logs(spark, str(tmp_path), "monitor").where("sample_id = 'a'").first()
    assert (monitor.uniquely_mapped_pct, monitor.total_reads) == ("90.00%", "1000")


def test_assignment_summary(spark, tmp_path):
    head = "\t".join(["Status"] + [f"out/aligned/{s}/Aligned.sortedByCoord.out.bam" for s in ["Cont_1", "Cont_10"]])
    write(tmp_path / "m.summary", head + "\nAssigned\t80\t0\nUnassigned_NoFeatures\t10\t0\n"
          "Unassigned_MultiMapping\t5\t0\nUnassigned_Ambiguity\t5\t0\nUnassigned_Unmapped\t100\t0\n")
    long = matrix.read_assignment_summary(spark, str(tmp_path / "m.summary"))
    rate = lambda basis: {r[0]: r[1] for r in Q.assignment_rate(long, basis).collect()}
    assert rate("four") == {"Cont_1": 80.0, "Cont_10": 0.0}
    assert rate("all") == {"Cont_1": 40.0, "Cont_10": 0.0}


def test_count_matrix(spark, tmp_path, rows):
    write(tmp_path / "c.txt", "# Program:x\nGeneid\tChr\tStart\tEnd\tStrand\tLength\tr/s1/Aligned.sortedByCoord.out.bam\tplain.bam\n"
          "g1\t1\t1\t2\t+\t1\t10\t0\ng2\t1\t1\t2\t+\t1\t7\t3\n")
    long = matrix.read_counts(spark, str(tmp_path / "c.txt"))
    assert rows(long) == [("g1", "plain", 0), ("g1", "s1", 10), ("g2", "plain", 3), ("g2", "s1", 7)]
    clean = matrix.clean_columns(matrix.read_tsv(spark, str(tmp_path / "c.txt")))
    assert clean.columns == ["Geneid", "s1", "plain"]
    assert [tuple(r) for r in clean.collect()] == [("g1", "10", "0"), ("g2", "7", "3")]


def test_sheets(spark, tmp_path, rows):
    write(tmp_path / "m.csv", "project_id,sample_id,fastq_1,read2\np,a,x_1,x_2\nq,b,y_1,y_2\n")
    got = sheets.read_sample_sheet(spark, str(tmp_path / "m.csv"), "p")
    assert rows(got, "sample_id", "fastq_r1", "fastq_r2") == [("a", "x_1", "x_2")]
    with pytest.raises(ValueError):
        sheets.read_sample_sheet(spark, str(tmp_path / "m.csv"), "nobody")
    write(tmp_path / "t.tsv", "# note\nsample_id\t tissue \tage\n\n# more\n a \told\t>10w\nb\tx\tS17\n\ty\tz\na\tnew \t\n")
    got = sheets.read_sheet_with_comments(spark, str(tmp_path / "t.tsv"))
    assert rows(got, "sample_id", "tissue") == [("a", "new"), ("b", "x")]


def manifest(sample, status="PASS", **extra):
    return {"sample_id": sample, "project_id": "p", "pipeline_type": "rna-seq",
            "sample_metadata": {"condition": "wt", "batch": 1},
            "final_outputs": {"bam": {"path": "b", "size_bytes": 3}},
            "qc_metrics": {"overall_status": status, "alignment": {"uniquely_mapped_pct": 91.5},
                           "issues": [{"severity": "critical", "category": "alignment", "message": "low"}]}, **extra}


def test_manifests(spark, tmp_path, rows):
    for s, status in [("a", "PASS"), ("b", "FAIL"), ("c", "WARN")]:
        write(tmp_path / s / "rna-seq" / "final_outputs" / "manifest.json", json.dumps(manifest(s, status), indent=1))
    write(tmp_path / "d" / "rna-seq" / "final_outputs" / "manifest.json", "{broken")
    write(tmp_path / "e" / "manifest.json", json.dumps(manifest("e")))
    docs = documents.read_manifests(spark, str(tmp_path)).cache()
    good, bad = documents.split_corrupt(docs)
    assert rows(good, "sample_id") == [("a",), ("b",), ("c",)]
    assert bad.count() == 1
    meta = documents.manifest_metadata_long(good)
    assert ("a", "batch", "1") in rows(meta)
    from readloom.operators import project as P

    qc = documents.manifest_qc(good)
    assert rows(P.status_summary(qc)) == [(3, 1, 2, 33.33)]
    assert rows(P.project_issues(qc)) == [("b", "critical", "low")]
    stats = P.aggregate_stats(qc).first()
    assert stats.mean_uniquely_mapped_pct == 91.5 and stats.mean_assignment_rate == 0


def test_evaluation(spark, tmp_path, rows):
    write(tmp_path / "e.json", json.dumps({"samples": [
        {"sample": "a", "status": "WARN", "metrics": {"x": 1.5}, "issues": [], "warnings": ["w"]}],
        "thresholds": {"t": 2}}, indent=1))
    got = documents.read_evaluation(spark, str(tmp_path / "e.json")).first()
    assert (got.sample_id, got.metrics["x"], got.warnings, got.thresholds["t"]) == ("a", 1.5, ["w"], 2.0)


def test_de_results_and_terms(spark, tmp_path, rows):
    base = tmp_path / "pairwise"
    write(base / "A_vs_B" / "final_de_results.csv", ',symbol,log2FoldChange,padj\ng1,S1,1.5,0.01\ng2,S2,-2,NA\n')
    write(base / "C_vs_B" / "final_de_results.csv", ',symbol,log2FoldChange,padj\ng1,S1,0.5,0.2\n')
    write(base / "A_vs_B" / "go_enrichment_up_BP.csv",
          '"","ID","Description","p.adjust","Count"\n"1","GO:1","cell, cycle",0.012345,7\n"2","GO:2",x,0.5,\n')
    write(base / "A_vs_B" / "go_enrichment_down_BP.csv", '""\n')
    write(base / "C_vs_B" / "go_enrichment_up_BP.csv", "")
    got = de.read_de_results(spark, str(tmp_path))
    assert rows(got) == [("A_vs_B", "g1", "S1", 1.5, 0.01), ("A_vs_B", "g2", "S2", -2.0, None), ("C_vs_B", "g1", "S1", 0.5, 0.2)]
    terms = de.read_go(spark, str(tmp_path))
    from readloom.operators.de import top_terms

    assert rows(top_terms(terms)) == [
        ("A_vs_B", "up", 1, "cell, cycle", 0.0123, 7), ("A_vs_B", "up", 2, "x", 0.5, 0)]
    write(tmp_path / "c.csv", "Geneid,s1,s2\ng,1,2\n")
    write(tmp_path / "m.csv", "sample_id,group\ns1,a\n")
    counts, meta = de.read_de_inputs(spark, str(tmp_path / "c.csv"), str(tmp_path / "m.csv"))
    assert rows(counts) == [("g", "s1", 1), ("g", "s2", 2)] and meta.columns == ["sample_id", "group"]


def test_listing_and_checksums(spark, tmp_path, rows):
    write(tmp_path / "d" / "a.txt", "alpha")
    write(tmp_path / "d" / "b.txt", "beta" * 100)
    listing = files.list_artifacts(spark, str(tmp_path / "d"))
    assert sorted(r.size for r in listing.collect()) == [5, 400]
    want = {n: hashlib.md5(t.encode()).hexdigest() for n, t in [("a.txt", "alpha"), ("b.txt", "beta" * 100)]}
    got = {r.name: r.md5 for r in files.file_checksums(spark, str(tmp_path / "d")).collect()}
    assert got == want
    write(tmp_path / "sums.tsv", f"filename\tsize\tmd5\turl\na.txt\t5\t{want['a.txt']}\tu\nb.txt\t400\tbad\tu\nc.txt\t1\tN/A\tu\nshort\n")
    sums = files.read_checksums(spark, str(tmp_path / "sums.tsv"))
    assert [r.name for r in sums.where("not valid").collect()] == ["short"]
    actual = files.file_checksums(spark, str(tmp_path / "d"))
    assert rows(A.checksum_audit(actual, sums.where("valid"))) == [("a.txt", "OK"), ("b.txt", "MISMATCH"), ("c.txt", "SKIP")]


def test_checksums_of_odd_names(spark, tmp_path):
    names = ["a b.txt", "c%20d.txt", "e#f.txt", "é.txt"]
    for n in names:
        write(tmp_path / "x y" / n, n * 3)
    got = {r.name: (r.md5, r.error) for r in files.file_checksums(spark, str(tmp_path / "x y")).collect()}
    assert got == {n: (hashlib.md5((n * 3).encode()).hexdigest(), None) for n in names}
    found = next(files._digests(iter([pd.DataFrame({"path": [f"file:{tmp_path}/gone"], "size": [1]})])))
    assert found.md5[0] is None and "gone" in found.error[0]


def test_logs_by_rule_and_sample(spark, tmp_path):
    for f in ["star/s1.log", "star/s10.log", "trim/s1.log", "trim/x.txt"]:
        write(tmp_path / f, f"{f}\nerror here\n")
    n = lambda **k: logs.read_logs(spark, str(tmp_path), **k).select("file").distinct().count()
    assert (n(), n(rule="star"), n(sample_id="s1"), n(rule="trim", sample_id="s1")) == (3, 2, 3, 1)


def test_line_numbers(spark, tmp_path):
    write(tmp_path / "x.log", "\n".join(f"line {i}" for i in range(500)) + "\n")
    with gzip.open(tmp_path / "y.log.gz", "wt") as f:
        f.write("a\nb\n")
    got = number_lines(read_lines(spark, str(tmp_path)))
    assert {r.line: r.line_no for r in got.where("file like '%x.log'").collect()} == {f"line {i}": i for i in range(500)}
    assert got.where("file like '%gz'").agg(F.max("line_no")).first()[0] == 1
