"""Fixed values the results depend on. Operators take them as defaults only."""

# FastQC modules whose failure is expected in RNA-seq, and one that is ignored.
TOLERATED_MODULES = [
    "Per base sequence content",
    "Sequence Duplication Levels",
    "Overrepresented sequences",
    "Adapter Content",
]
IGNORED_MODULES = ["Per tile sequence quality"]
TRIM_SENSITIVE_MODULE = "Adapter Content"

# MultiQC FastQC table, columns that are not checks and checks expected to fail.
NOT_A_CHECK = [
    "Sample", "Filename", "File type", "Encoding", "Total Sequences", "Total Bases",
    "Sequences flagged as poor quality", "Sequence length", "%GC",
    "total_deduplicated_percentage", "avg_sequence_length", "median_sequence_length",
]
EXPECTED_FAIL_CHECKS = [
    "per_base_sequence_content",
    "sequence_duplication_levels",
    "adapter_content",
    "per_sequence_gc_content",
]

# Assignment categories.
ASSIGNED = "Assigned"
MULTI_MAPPING = "Unassigned_MultiMapping"
NO_FEATURES = "Unassigned_NoFeatures"
AMBIGUITY = "Unassigned_Ambiguity"
FOUR_CATEGORIES = [ASSIGNED, MULTI_MAPPING, NO_FEATURES, AMBIGUITY]

# Recommendation texts per report status.
REPORT_RECOMMENDATION = {
    "FAIL": "REVIEW REQUIRED - 심각한 문제 발견. 재시퀀싱 또는 제외 고려",
    "WARN": "CHECK RECOMMENDED - 경미한 문제 있음. 리포트 확인 권장",
    "PASS": "GOOD - 분석 사용 가능",
}

# Recommendation lists and next steps per sample status.
SAMPLE_RECOMMENDATIONS = {
    "PASS": ["Sample quality is sufficient for downstream analysis"],
    "WARN": [
        "Review QC report for detailed metrics",
        "Consider sample in analysis with caution",
    ],
    "FAIL": [
        "Sample quality is below acceptable thresholds",
        "Consider excluding from analysis",
        "May require resequencing",
    ],
}
NEXT_STEPS = {
    "PASS": ["differential_expression", "pathway_analysis", "gene_set_enrichment"],
    "WARN": ["review_qc_report", "conditional_differential_expression"],
    "FAIL": ["exclude_from_analysis", "consider_resequencing"],
}
NEXT_STEPS_OTHER = ["review_outputs"]

# Sheet columns.
SHEET_REQUIRED = ["project_id", "sample_id", "fastq_1", "fastq_2"]
SHEET_OPTIONAL = [
    "sample_name", "condition", "replicate", "sequencing_platform", "library_type",
    "read_type", "species", "genome_build", "batch", "tissue", "treatment",
    "time_point", "notes",
]
CONVERTER_REQUIRED = [
    "project_id", "sample_id", "sample_name", "condition", "replicate",
    "library_type", "read_type", "fastq_1", "species", "genome_build",
]
SHEET_ALLOWED = {
    "read_type": ["single-end", "paired-end"],
    "library_type": ["RNA-seq", "ChIP-seq", "WGS", "WES", "ATAC-seq"],
}
MANIFEST_FIELDS = [
    "sample_name", "condition", "replicate", "sequencing_platform", "library_type",
    "read_type", "species", "genome_build", "batch", "tissue", "treatment",
    "time_point", "notes",
]
BACKFILL_FIELDS = [
    "condition", "replicate", "tissue", "age", "sex", "sequencing_platform",
    "library_type", "read_type", "species", "genome_build", "batch", "treatment",
    "time_point", "notes",
]
TECHNICAL_COLUMNS = [
    "sample_id", "fastq_r1", "fastq_r2", "fastq_r1_2", "fastq_r2_2", "notes",
    "comments", "replicate", "read1", "read2", "r1", "r2",
]
FASTQ_ALIASES = {
    "fastq_r1": ["fastq_r1", "fastq_1", "r1", "read1"],
    "fastq_r2": ["fastq_r2", "fastq_2", "r2", "read2"],
}
DE_METADATA_COLUMNS = ["sample_id", "condition", "replicate"]
DE_OPTIONAL_COLUMNS = ["tissue", "sex", "age", "treatment", "time_point"]

# Condition names guessed from sample ids, in order of precedence.
CONDITION_SUFFIXES = [
    ("wildtype", ["_W", "_WT", "_wt", "_wildtype", "_Ctrl", "_ctrl", "_control"]),
    ("heterozygous", ["_H", "_Het", "_het", "_heterozygous", "_KO", "_ko"]),
    ("treatment", ["_T", "_Treat", "_treat", "_treatment"]),
]
CONDITION_PREFIXES = [
    ("non_stimulated", ["nMonTg", "nTg", "NonTg", "non_tg"]),
    ("wildtype", ["WT", "Wt", "Wild", "Ctrl", "Control", "MonWT"]),
    ("transgenic", ["MonTg", "Tg", "TG"]),
    ("heterozygous", ["Het", "HET", "KO", "ko"]),
    ("treatment", ["Treat", "treat", "STIM", "Stim"]),
]
UNKNOWN_CONDITION = "unknown"

# Words that mark a control condition.
CONTROL_WORDS = [
    "wildtype", "wild_type", "wt", "control", "ctrl", "normal", "vehicle", "mock",
    "untreated", "scramble", "sham", "naive",
]

# Identifiers parsed as a last resort.
TISSUE_IN_ID = r"(?i)_(HPC|PFC|CTX|CER|STR|AMY)_"
SEX_IN_ID = r"(?i)_\d+([MF])_"
GENOTYPE_IN_ID = r"(?i)_(W|H)$"

# Log keywords and run stages in order.
ERROR_WORDS = ["error", "exception", "failed", "killed", "oom"]
RUN_STAGES = [
    "cutadapt", "fastqc_raw", "star_align", "featurecounts_quant",
    "generate_manifest", "multiqc",
]
SETUP_STEPS = [
    "fastq_detected", "config_created", "sample_sheet_created", "pipeline_started",
    "pipeline_done", "de_prepared", "de_done", "viewer_done",
]

# Adapters and trimming defaults.
ADAPTER_R1 = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA"
# The sequence looked for when adapter content is measured.
ADAPTER_SEARCH = "AGATCGGAAGAG"
ADAPTER_R2 = "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT"
QUALITY_CUTOFF = 20
MIN_READ_LENGTH = 20

# Expressed-gene bands per species, (normal from, caution from).
EXPRESSION_BANDS = {"mouse": (15000, 10000), "human": (15000, 12000)}
