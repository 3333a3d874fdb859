"""Secret scans over an incremental ledger of blobs, with DataFrame operations only.

Each version of each path is addressed by the SHA-256 of its text. The ledger folder holds three tables,
one partition a load: ``paths`` (path, blob), ``findings`` (blob, rule, span) and ``marks`` (blob, the
rule versions it has been scanned with). A load scans a blob once, whatever number of paths hold it, and
only with the rule versions that it was never scanned with; findings are joined back to all paths.

Findings and marks are only ever added to, whatever becomes of the paths of the load that added them: a
blob's findings under a rule version depend on its text alone. Marks are written last, so what a failed load
left unmarked is scanned again; findings that it had written are then there twice and count once. A load
that is repeated replaces its own paths. A report or redaction is stored in a folder of its own, so that it stays as
it was when others follow.

Cases: a NULL text is the empty text and has no findings; paths may be NULL or repeat, and each row is
reported; an empty table makes an empty load; a very long text is one blob and is matched whole. Columns other than the path and the text are not stored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridsight.llm.common import kept

#: Unseen blobs of a load that are broadcast, 32 bytes each, to leave out all other texts.
MAX_BROADCAST = 500_000


class Rule(NamedTuple):
    """A kind of secret: all leftmost matches of the pattern that do not overlap, of which those whose
    ``group`` is shorter than ``least`` are dropped."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: Kinds in the order of their spans. A run that is too short cannot hold one that is long enough, so for
#: runs of one alphabet the least length stands in the pattern.
BASE_RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
_FORGE = Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}")
#: The rules where a private key is found by its BEGIN line alone.
LINE_RULES = (*BASE_RULES, Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"), _FORGE)

#: What parts the lines of a key: white space, also as written in strings, and the marks of quoted lines.
_GAP = r"""(?:[\s>#*|"',;]|\\[rn])"""
#: A private key from its BEGIN line to the END line of the same name, with no other BEGIN or END between;
#: else to the end of the base64 run behind the BEGIN line and the key's own fields, of which the last
#: line may be short; else the BEGIN line. Possessive, so that a long text needs no deep stack.
_KEY = (
    r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?)-----"
    r"(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END \1-----"
    rf"|(?:{_GAP}*+(?:Proc-Type|DEK-Info|Version|Comment|Charset|MessageID|Hash): [^\n\\]*+(?=[\n\\]))*+"
    rf"(?:{_GAP}{{0,16}}+[A-Za-z0-9+/]{{16,}}+={{0,2}}+)++"
    rf"(?:{_GAP}{{1,16}}+(?:[A-Za-z0-9+/]{{1,15}}+={{1,2}}+|=[A-Za-z0-9+/]{{4}}(?![A-Za-z0-9+/=])))*+"
    rf"(?:(?:\r?\n|\\n)[ \t>#*|]*+[A-Za-z0-9+/]{{1,15}}+(?=[ \t]*+(?:\r?\n|\\n|[\"']|\z)))?+)?+"
)
RULES = (*BASE_RULES, Rule("pem", 2, _KEY), _FORGE)

_MARKS = "blob binary, rules array<string>, load string"
_FINDINGS = "blob binary, rule string, start bigint, end bigint, load string"


def _folder(ledger: str, table: str, load: str) -> str:
    return f"{ledger}/{table}/load={load}"


def _marks(spark: SparkSession, ledger: str) -> DataFrame:
    spark.createDataFrame([], _MARKS).drop("load").limit(0).write.mode("ignore").parquet(_folder(ledger, "marks", "0"))
    return spark.read.schema(_MARKS).parquet(f"{ledger}/marks")


def blob(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(column, F.lit("")), 256))


def spans(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, rule, start, end) of every match in ``text`` of the rules named in ``rules``, in code
    points. A match begins after the gaps and matches before it, summed over a window of one text's
    matches."""

    def marks(rule: Rule) -> Column:
        def mark(match: Column) -> Column:
            long = F.length(F.regexp_extract(match, rule.pattern, rule.group)) >= rule.least if rule.least else F.lit(True)
            return F.struct(F.length(match).alias("len"), long.alias("ok"))

        return F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)), mark)

    found = []
    for rule in rules:
        gaps = F.transform(F.split("text", rule.pattern, -1), lambda gap: F.length(gap))
        wanted = F.array_contains("rules", rule.name) & F.col("text").rlike(rule.pattern)
        found.append(F.when(
            wanted, F.struct(F.lit(rule.name).alias("rule"), gaps.alias("gaps"), marks(rule).alias("marks"))))
    runs = blobs.select("blob", F.explode(F.array_compact(F.array(*found))).alias("run"))
    steps = runs.select(
        "blob", F.col("run.rule").alias("rule"),
        F.posexplode(F.arrays_zip(F.slice("run.gaps", F.lit(1), F.size("run.marks")).alias("gap"), F.col("run.marks").alias("mark")))
        .alias("nth", "step"))
    before = Window.partitionBy("blob", "rule").orderBy("nth")
    size = F.col("step.mark.len")
    end = F.sum((F.col("step.gap") + size).cast("bigint")).over(before)
    return steps.select(
        "blob", "rule", (end - size).alias("start"), end.alias("end"), F.col("step.mark.ok").alias("ok")
    ).where("ok").drop("ok")


def scan_load(
    docs: DataFrame, ledger: str, load: str, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> None:
    """Add a load of (path, text) versions to the ledger, scanning what no load has scanned."""
    spark = docs.sparkSession
    seen = _marks(spark, ledger)
    versions = docs.select(F.col(path).alias("path"), F.coalesce(text, F.lit("")).alias("text")).select("*", blob("text").alias("blob"))
    paths, marks, findings = (_folder(ledger, t, load) for t in ("paths", "marks", "findings"))
    versions.select("path", "blob").write.mode("overwrite").parquet(paths)
    known = seen.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("known"))
    every = F.array(*(F.lit(r.name) for r in rules))
    todo = F.array_except(every, F.coalesce("known", F.array().cast("array<string>")))
    fresh = spark.read.parquet(paths).select("blob").distinct().join(known, "blob", "left").select("blob", todo.alias("rules"))
    unseen = kept(fresh.where(F.size("rules") > 0), "unseen")
    spans(unseen_texts(versions, unseen), rules).write.mode("append").parquet(findings)
    unseen.write.mode("append").parquet(marks)


def unseen_texts(versions: DataFrame, unseen: DataFrame, most: int = MAX_BROADCAST) -> DataFrame:
    """(blob, text, rules) of the unseen blobs. Where ``most`` or fewer are unseen, the other versions' texts go
    before the shuffle; else each task sends one text of every blob it has."""
    few = unseen.limit(most + 1).count() <= most
    wanted = versions.join(F.broadcast(unseen.select("blob")), "blob", "left_semi") if few else versions
    return wanted.groupBy("blob").agg(F.first("text").alias("text")).join(unseen, "blob")


def _found(spark: SparkSession, ledger: str, rules: tuple[Rule, ...], load: str | None) -> DataFrame:
    """Findings under the rules given: those of the load's blobs, whichever load found them, or all."""
    found = spark.read.schema(_FINDINGS).parquet(f"{ledger}/findings").where(F.col("rule").isin([r.name for r in rules]))
    if load is None:
        return found
    return found.join(spark.read.parquet(_folder(ledger, "paths", load)).select("blob"), "blob", "left_semi")


def report(spark: SparkSession, ledger: str, load: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, blob, spans) of every path of a load; spans (start, nth, kind, end) of the rules given, by
    start and then rule order, from whichever load found them."""
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)))
    found = _found(spark, ledger, rules, load)
    span = F.struct("start", order[F.col("rule")].alias("nth"), F.substring_index("rule", "@", 1).alias("kind"), "end")
    by_blob = found.groupBy("blob").agg(F.sort_array(F.collect_set(span)).alias("spans"))
    stored = kept(by_blob, "report")
    none = F.array().cast(by_blob.schema["spans"].dataType)
    return spark.read.parquet(_folder(ledger, "paths", load)).join(stored, "blob", "left").select(
        "path", "blob", F.coalesce("spans", none).alias("spans"))


def listed(found: Column | str) -> Column:
    """Spans as comma-joined kind:start:end."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(
    docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[secret]",
    length: str | None = None, load: str | None = None,
) -> DataFrame:
    """The documents with every span of their blob's findings, of any load, replaced by a mark;
    overlapping spans by one. The column ``length``, if named, follows the changed texts. ``load``, if
    named, is one that holds all the documents: findings of other blobs are then left aside."""
    found = _found(docs.sparkSession, ledger, rules, load)
    by_blob = found.groupBy("blob").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    spans_of = kept(by_blob, "redaction")
    body = F.col("_doc").getField(text)
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(
        "spans", empty,
        lambda done, s: F.when(s["end"] <= done["at"], done).otherwise(F.struct(
            s["end"].alias("at"),
            F.when(s["start"] < done["at"], done["out"]).otherwise(F.concat(
                done["out"], F.substring(body, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")), F.lit(mark)))
            .alias("out"))),
        lambda done: F.concat(done["out"], F.substring(body, (done["at"] + 1).cast("int"), F.length(body))))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"))
    joined = rows.withColumn("blob", blob(body)).join(spans_of, "blob", "left")
    changed = F.col("_doc").withField(text, rest)
    if length:
        changed = changed.withField(length, F.length(rest).cast(docs.schema[length].dataType))
    return joined.select(
        F.when(F.col("spans").isNull(), F.col("_doc")).otherwise(changed).alias("_doc")).select("_doc.*")
