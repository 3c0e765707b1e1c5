"""Stand-ins: the driver's tables in the roles the reference's data plays.

The reference reads a Java code base, prompt/label/completion tables, build
outcomes and a node/edge graph.  The test tables hold none of these, so each
role is derived from them by a fixed rule that the SQL oracle repeats
word for word (see ``plans/oracle.py``).  Every stand-in grows with the tables.

* corpus files  <- ``documents``: each document is rendered as a Java-like
  source file (package line, import line, block comment, one method per text
  line, each with a line comment; a document holding ``|`` also declares a
  method without a body, one with an even id members that hold blocks, calls
  and an anonymous class).  Every fifth file has CRLF line ends.  ``path = source/lang/doc_id/<Name>.java``,
  module = ``source``; a document whose text mentions "test" plays a unit-test
  file (``<Name>Test.java``).
* label/completion pairs <- consecutive lines of ``documents`` and
  user -> next assistant turn of ``conversations``.
* build outcomes <- ``labels`` (built = quality 1, error/failure counts from toxic).
* build logs <- ``events`` (error events are failing tests).
* graph <- ``lineitem`` supplier-part edges, ``part``/``supplier`` nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holecard.functions.text import normalize_newlines
from holecard.sources.tables import read_table, spread

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --- fixed values: rendering rule of the stand-in corpus (mirrored in SQL) ---
METHOD_TEMPLATE = "    void m() {\n        // line\n        $1\n    }"
ABSTRACT_LINE = "    abstract void pending();\n"
TYPED_LINES = """    @Named(value = "pick") public java.util.List<String> pick(int a) {
        if (a > max(a, 1)) {
            go();
        }
        return java.util.Collections.<String>emptyList();
    }
    Object held = new Object(1 > max(1, 2)) {
        String shown(int a) {
            return "x";
        }
    };
    static class Held extends Object {
        Held first = new Held(1);
        Held(int a) {
            super();
            go(a);
        }
        Held(int a, int b) { this(a); }
        Held copy() {
            return new Held(2);
        }
    }
"""
TEST_MARK = r"[Tt][Ee][Ss][Tt]"
NAME_WORD = r"^[^A-Za-z]*([A-Za-z]*)"


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus table ``(path, file_name, module, text)`` rendered from documents."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), waves=4)
    word = F.regexp_extract("text", NAME_WORD, 1)
    base = F.when(word == "", F.lit("Doc")).otherwise(word)
    is_test = F.col("text").rlike(TEST_MARK)
    cls = F.concat(base, F.when(is_test, F.lit("Test")).otherwise(F.lit("")))
    body = F.regexp_replace(normalize_newlines("text"), r"([^\n]+)", METHOD_TEMPLATE)
    # a document holding '|' also declares a method without a body
    tail = F.when(F.col("text").contains("|"), F.lit(ABSTRACT_LINE)).otherwise(F.lit(""))
    text = F.concat(
        F.lit("package "), F.col("source"), F.lit(";\n\nimport java.util."), F.col("lang"),
        F.lit(";\n\n/*\n * "), cls, F.lit("\n */\npublic class "), cls, F.lit(" {\n"),
        F.when(F.col("doc_id") % 2 == 0, F.lit(TYPED_LINES)).otherwise(F.lit("")),
        body, F.lit("\n"), tail, F.lit("}\n"))
    line_end = F.when(F.col("doc_id") % 5 == 1, F.lit("\r\n")).otherwise(F.lit("\n"))
    text = F.replace(text, F.lit("\n"), line_end)
    file_name = F.concat(cls, F.lit(".java"))
    return docs.select(
        F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"), file_name).alias("path"),
        file_name.alias("file_name"),
        F.col("source").alias("module"),
        text.alias("text"),
    )


def completion_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label/completion pairs ``(prompt_id, kind, label, completion)``.

    * ``lines``: line i of a document is the label, line i+1 the completion
      (row-local: the pairs come out of one array per document, no shuffle);
    * ``turns``: a user turn is the label, the next turn, when it is the
      assistant's, the completion.  Turns are matched by an equi-join on
      ``(conv_id, turn + 1)``, which spreads even one very long conversation
      over many partitions (a ``lead`` window would sort it in one task).
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), waves=4)
    lines = F.split(normalize_newlines("text"), "\n", -1)
    n = F.greatest(F.size(lines) - 1, F.lit(0))
    doc_pairs = docs.select(
        "doc_id", F.posexplode(F.zip_with(F.slice(lines, 1, n), F.slice(lines, 2, n),
                                          lambda a, b: F.struct(a.alias("a"), b.alias("b")))))
    doc_pairs = doc_pairs.select(
        F.concat_ws(":", F.lit("line"), F.col("doc_id").cast("string"), F.col("pos").cast("string"))
        .alias("prompt_id"),
        F.lit("lines").alias("kind"),
        F.col("col.a").alias("label"), F.col("col.b").alias("completion"))
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    users = conv.where(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("user_turn"),
        F.col("text").alias("label"))
    replies = conv.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.col("text").alias("completion"))
    turn_pairs = users.join(replies, ["conv_id", "turn"], "inner").select(
        F.concat_ws(":", F.lit("turn"), F.col("conv_id").cast("string"),
                    F.col("user_turn").cast("string")).alias("prompt_id"),
        F.lit("turns").alias("kind"), "label", "completion")
    return doc_pairs.unionByName(turn_pairs)


def with_matches(pairs: DataFrame) -> DataFrame:
    """Stand-in syntax and data-flow matches of a pair, from its label's length."""
    size = F.length("label")
    return pairs.withColumn("syntax_match", size % 11 / 10.0).withColumn("dataflow_match", size % 7 / 6.0)


def build_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build files ``(project, text)``: a module entry for every line of a
    document, one that is commented out, and a second block."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = F.regexp_replace(normalize_newlines("text"), r"([^\n]+)", r"  <module>$1</module>")
    return docs.select(F.col("doc_id").alias("project"), F.concat(
        F.lit("<project>\n<modules>\n"), items, F.lit("\n  <!-- <module>old</module> -->\n</modules>\n"
              "<modules>\n  <module>other</module>\n</modules>\n</project>\n")).alias("text"))


def build_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build logs ``(build_id, line_no, line)`` from ``events``: one build per
    user, one line per event in event order; signups open a failure block,
    errors name failed tests, purchases carry the test counts."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    v = F.floor("value").cast("long").cast("string")
    line = (F.when(F.col("event_type") == "signup", F.lit("[ERROR] Failures: "))
            .when(F.col("event_type") == "error",
                  F.concat(F.lit("[ERROR]   Test"), F.col("event_id").cast("string"),
                           F.lit(".check:"), v, F.lit(" expected")))
            .when(F.col("event_type") == "purchase",
                  F.concat(F.lit("[ERROR] Tests run: "), F.col("event_id").cast("string"),
                           F.lit(", Failures: "), v, F.lit(", Errors: "),
                           F.floor(F.col("value") / 10).cast("long").cast("string")))
            .otherwise(F.concat(F.lit("[INFO] "), F.col("event_type"), F.lit(" "), F.col("props"))))
    return ev.select(F.col("user_id").alias("build_id"), F.col("event_id").alias("line_no"),
                     line.alias("line"))


def builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Builds ``(build_id, exit_code)``: a build fails when its log has errors."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type")
    return ev.groupBy(F.col("user_id").alias("build_id")).agg(
        F.when(F.sum((F.col("event_type") == "error").cast("int")) > 0, 1).otherwise(0)
        .alias("exit_code"))


# --- fixed values: stand-in failed-test words ---
FAILED_TEST_WORD = r"[A-Za-z]*[Tt][Ee][Ss][Tt][A-Za-z]*"


def response_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per labelled document: ``built`` = quality 1, ``error_count`` = toxic,
    failed tests = distinct words containing "test"."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    tests = F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(FAILED_TEST_WORD), 0)))
    return labels.join(docs, "doc_id", "inner").select(
        "doc_id", F.col("source").alias("module"), "lang",
        (F.col("quality") == 1).alias("built"),
        F.col("toxic").cast("int").alias("error_count"),
        F.size(tests).alias("failure_count"),
        tests.alias("failed_tests"))


def module_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline per module: the outcome of its first labelled document."""
    out = response_outcomes(spark, sf_dir)
    first = out.groupBy("module").agg(F.min_by(
        F.struct("built", "error_count", "failure_count", "failed_tests"), F.col("doc_id")).alias("b"))
    return first.select("module", "b.*")


def graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Supplier-part graph: nodes ``(id, kind, size)`` and edges
    ``(src, dst, n_lines)`` = distinct supplier-part pairs of ``lineitem``."""
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
        F.lit("part").alias("kind"), F.col("p_size").cast("int").alias("size"))
    sups = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"),
        F.lit("supplier").alias("kind"), F.col("s_nationkey").cast("int").alias("size"))
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    edges = li.groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n_lines")).select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"), "n_lines")
    return parts.unionByName(sups), edges
