"""Line sectioning, carried state and the ordered rewrite rules.

The rule list below is the workbook-script cleaning list of the tool this library
re-creates, kept as test data (fixed values, in their original order). The golden
results come from its generated-scripts test.
"""

from pyspark.sql import functions as F

from lineage_spark.operators import ordering, textlines
from lineage_spark.operators.textlines import Rule

# Script-cleaning rules in their original order (names of the platform's own calls are
# replaced by neutral ones).
SCRIPT_RULES = [
    Rule(1, "graphicsFile", "state", '"{state}.png"', target="graphicsFile", state="fn"),
    Rule(2, "createDataFrame", "substitute", ""),
    Rule(3, "localFilePaths <- ", "state", 'localFilePaths <- readRDS("./rds_output/{state}")', target="^.*$",
         state="var_input"),
    Rule(4, r"\$fileSystem\(\)", "comment"),
    Rule(5, r" <- fs\w*\$", "comment"),
    Rule(6, r"platform_path\(", "substitute", "normalizePath("),
    Rule(7, "<- readRDS", "state", "<- {state}", target="<-.*", state="input_var"),
    Rule(8, r"return\(NULL\)", "comment"),
    Rule(9, r"saveRDS\(", "capture", "return($1)", target=r"[(](\S+)[,]"),
    Rule(10, r"\$upload\(", "comment"),
    Rule(11, r"htmlwidgets::saveWidget\(", "state", '$1 "{state}" $2',
         target=r"(htmlwidgets::saveWidget\([^,]+,)[^,]+(,.+\))", state="fn"),
    Rule(12, r"stop\('Input data not properly imported into Workbook'\)", "replace",
         r"input.dat <- input[grepl('\\.h5$', input)]; input.tcr <- input[grepl('\\.csv$', input)]; "
         "input=c(input.dat,input.tcr);"),
    Rule(13, r'stop\("Input should be Seurat object in rds file format', "comment"),
    Rule(14, "orthology_table %>% SparkR::withColumnRenamed", "substitute",
         'orthology_table %>% dplyr::rename("orthology_reference" = orthology_reference_column) %>%',
         target="orthology_table %>% SparkR::withColumnRenamed"),
    Rule(15, "SparkR::`%in%`", "substitute", "", target="SparkR::"),
    Rule(16, "SparkR::", "substitute", "dplyr::"),
    Rule(17, "library.PlatformSpark", "replace", "library(dplyr)"),
    Rule(18, r"output_fs\$open", "substitute", "file"),
    Rule(19, r"\$get_path", "substitute", "file", target=r"output_fs\$get_path"),
    Rule(20, "new.output()", "comment"),
    Rule(21, "install.packages|WrapObjects", "drop"),
]
SCRIPT_DEFAULT = Rule(0, "", "substitute", "list(value=", target=r"WrappedObject\(")

SCRIPT = [
    "@transform_pandas(",
    "Process_1_1 <- function(Dataset_1) {",
    "print('graphicsFile')",
    "print('SparkR::`%in%`')",
    "print('SparkR::')",
    "library(PlatformSpark)",
    "    print('new.output()')",
    "install.packages('x')",
    "fs <- Dataset_1$fileSystem()",
    "obj <- readRDS(path)",
    "out <- WrappedObject(obj)",
    "saveRDS(out, file='x.rds')",
    "}",
    "@transform_pandas(",
    "Process_2 <- function(Process_1) {",
    "htmlwidgets::saveWidget(w, 'old.html', selfcontained = TRUE)",
    "print('graphicsFile')",
    "p <- platform_path('x')",
    "}",
]


def script_lines(spark):
    rows = [(1, i + 1, line) for i, line in enumerate(SCRIPT)]
    return spark.createDataFrame(rows, "doc_id long, line_no int, line string")


def with_state(lines):
    marker = F.col("line").rlike("^@").cast("int")
    lines = ordering.ordered_scan(lines, ["doc_id"], ["line_no"], sums={"section": marker}).drop("__pos", "__start")
    fn = F.nullif(F.regexp_extract("line", r"^(\S+) <- function", 1), F.lit(""))
    lines = textlines.carry_forward(lines, "doc_id", "line_no", fn, "fn")
    iv = F.nullif(F.regexp_extract("line", r"<-\s*(\S+)\$fileSystem\(\)", 1), F.lit(""))
    lines = textlines.carry_forward(lines, "doc_id", "line_no", iv, "input_var")
    return lines.withColumn("var_input", F.lit("var_Dataset_1.rds"))


def rewritten(spark):
    out = textlines.rewrite(with_state(script_lines(spark)), SCRIPT_RULES, default=SCRIPT_DEFAULT)
    return {r["line_no"]: r["line"] for r in out.collect()}


def test_golden_rewrites(spark):
    got = rewritten(spark)
    assert got[3] == "print('\"Process_1_1.png\"')"
    assert got[4] == "print('`%in%`')"
    assert got[5] == "print('dplyr::')"
    assert got[6] == "library(dplyr)"
    assert got[7] == "# auto removed:     print('new.output()')"


def test_later_rules(spark):
    got = rewritten(spark)
    assert 8 not in got  # install.packages dropped
    assert got[9] == "# auto removed: fs <- Dataset_1$fileSystem()"
    assert got[10] == "obj <- Dataset_1"  # carried input name
    assert got[11] == "out <- list(value=obj)"  # default substitution
    assert got[12] == "return(out)"
    assert got[16] == "htmlwidgets::saveWidget(w, \"Process_2\" , selfcontained = TRUE)"
    assert got[17] == "print('\"Process_2.png\"')"
    assert got[18] == "p <- normalizePath('x')"


def test_rule_order_matters(spark):
    lines = spark.createDataFrame([(1, 1, "SparkR::`%in%` x")], "doc_id long, line_no int, line string")
    first = textlines.rewrite(lines, [Rule(1, "SparkR::`%in%`", "substitute", "", target="SparkR::"),
                                      Rule(2, "SparkR::", "substitute", "dplyr::")]).first()["line"]
    swapped = textlines.rewrite(lines, [Rule(2, "SparkR::`%in%`", "substitute", "", target="SparkR::"),
                                        Rule(1, "SparkR::", "substitute", "dplyr::")]).first()["line"]
    assert first == "`%in%` x" and swapped == "dplyr::`%in%` x"


def test_sections_first_match_and_body(spark):
    lines = with_state(script_lines(spark))
    sec = {r["line_no"]: r["section"] for r in lines.collect()}
    assert sec[1] == 1 and sec[13] == 1 and sec[14] == 2
    sig = textlines.first_match(lines, ["doc_id", "section"], "line_no", F.col("line").contains("<- function"), "line")
    assert {r["section"]: r["line"] for r in sig.collect()} == {
        1: "Process_1_1 <- function(Dataset_1) {", 2: "Process_2 <- function(Process_1) {"}
    body = textlines.section_body(lines.filter("section = 2"), ["doc_id", "section"], "line_no", "line").first()
    assert body["body"].split("\n")[0] == "@transform_pandas(" and body["body"].endswith("}")


def test_rules_from_frame_and_state_escaping(spark):
    rules = textlines.rules_from_frame(spark.createDataFrame(
        [(1, "x", "state", "[{state}]")], "pos int, pattern string, action string, replacement string"))
    lines = spark.createDataFrame([(1, 1, "a x b", "$1\\z")], "doc_id long, line_no int, line string, st string")
    out = textlines.rewrite(lines, rules, state_col="st").first()["line"]
    assert out == "a [$1\\z] b"
