"""The checks of a release in one table, and reports of small tables as Markdown."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import schemas
from evidentia.functions import text as T
from evidentia.functions.urls import in_domains
from evidentia.operators import audit as A

CHECK = "check string, record_id string, detail string"


def _rows(df: DataFrame, check: str, record, detail) -> DataFrame:
    return df.select(F.lit(check).alias("check"), record.cast("string").alias("record_id"), detail.cast("string").alias("detail"))


def schema_problems(tables: dict[str, DataFrame]) -> DataFrame:
    """``(check, record_id, detail)``: missing tables, and records that break their schema."""
    spark = next(iter(tables.values())).sparkSession
    lost = spark.createDataFrame([("missing_table", None, n) for n in schemas.KEYS if n not in tables and n != "candidates"], CHECK)
    found = [_rows(schemas.record_problems(df, name), f"schema_{name}", F.col("record_id"), F.col("rule")) for name, df in tables.items()]
    return reduce(DataFrame.union, found, lost)


def reference_problems(tables: dict[str, DataFrame]) -> DataFrame:
    """References without a target: of entities, facts and chunks to sources, of answerable questions to sources and facts."""
    s = tables["sources"]
    asked = tables["questions"].filter("not unanswerable")
    many = lambda c: asked.select("question_id", F.explode(c).alias("ref"))
    parts = [
        A.orphans(tables["entities"], "entity_id", F.col("canonical_source_id"), s, "source_id", "entity_source"),
        A.orphans(tables["facts"], "fact_id", F.col("evidence_source_id"), s, "source_id", "fact_source"),
        A.orphans(tables["chunks"], "chunk_id", F.col("source_id"), s, "source_id", "chunk_source"),
        A.orphans(many("evidence_source_ids"), "question_id", F.col("ref"), s, "source_id", "question_source"),
        A.orphans(many("evidence_fact_ids"), "question_id", F.col("ref"), tables["facts"], "fact_id", "question_fact"),
        _rows(asked.filter(F.size("evidence_source_ids") == 0), "question_without_source", F.col("question_id"), F.lit("")),
    ]
    return reduce(DataFrame.union, parts)


def content_problems(tables: dict[str, DataFrame], restricted: list[str]) -> DataFrame:
    """Repeated source ids and addresses, chunks that repeat the text of one with a lesser id, personal fields, open text against its source's policy or domain."""
    sources, facts, chunks = tables["sources"], tables["facts"], tables["chunks"]
    ids = A.duplicates(sources, ["source_id"], "source_id").union(A.duplicates(sources, ["url"], "url"))
    known = chunks.join(sources.select("source_id"), "source_id", "left_semi").select("chunk_id", F.sha2("text", 256).alias("sha"))
    first = known.groupBy("sha").agg(F.min("chunk_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = known.join(first, "sha").filter("chunk_id <> first")
    own = sources.select("source_id", F.col("release_policy").alias("s_policy"), "raw_text_release", "domain")
    open_text = chunks.filter("chunk_kind = 'open_text'").join(own, "source_id")
    parts = [
        _rows(ids, "duplicate_source", F.col("value"), F.col("check")),
        _rows(facts.filter(T.has_personal_field(F.col("evidence_text"))), "personal_field", F.col("fact_id"), F.lit("")),
        _rows(again, "duplicate_chunk_text", F.col("chunk_id"), F.col("first")),
        _rows(open_text.filter(~F.col("raw_text_release") | ~F.col("s_policy").isin(*schemas.OPEN)), "open_text_policy", F.col("chunk_id"), F.col("source_id")),
        _rows(open_text.filter(in_domains(F.col("domain"), restricted)), "open_text_domain", F.col("chunk_id"), F.col("domain")),
    ]
    return reduce(DataFrame.union, parts)


def validate(tables: dict[str, DataFrame], restricted: list[str], tracked: list[str] = ()) -> DataFrame:
    """``(check, record_id, detail)`` of everything that is wrong with a release; empty if it may go out.

    ``tables``: sources, entities, facts, chunks and questions. Problems of the schema come alone, as the other checks need it. ``tracked``
    are paths of raw files under version control, which must not be there.
    """
    broken = schema_problems(tables)
    if not broken.isEmpty():
        return broken
    spark = broken.sparkSession
    leaked = spark.createDataFrame([("tracked_raw_file", p, "") for p in tracked if not p.endswith(".gitkeep")], CHECK)
    return reference_problems(tables).union(content_problems(tables, restricted)).union(leaked)


def markdown_table(df: DataFrame, rows: int = 1000) -> str:
    """A small result table as a Markdown table, in its own order; a longer one says how many rows are left out."""
    found = df.limit(rows + 1).collect()
    shown = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else ", ".join(map(str, v)) if isinstance(v, list) else str(v)
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join(shown(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |" for r in found[:rows]]
    return "\n".join(lines + ([f"\nMore than {rows} rows; the rest is not shown."] if len(found) > rows else []))


def markdown_report(title: str, sections: dict[str, DataFrame], facts: dict[str, object] | None = None) -> str:
    """A report: single values first, then a table for each section."""
    lines = [f"# {title}", ""] + [f"- {k}: **{v}**" for k, v in (facts or {}).items()]
    for name, df in sections.items():
        lines += ["", f"## {name}", "", markdown_table(df)]
    return "\n".join(lines) + "\n"


def validation_report(problems: DataFrame) -> str:
    """Status and counts by check, then the problems."""
    counts = problems.groupBy("check").agg(F.count("*").alias("n")).orderBy("check")
    status = "PASS" if problems.isEmpty() else "FAIL"
    return markdown_report("Release validation", {"Problems by check": counts, "Problems": problems.orderBy("check", "record_id", "detail")}, {"Status": status})


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One text as a file of a folder; the committer makes it all or nothing."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_json(spark: SparkSession, value: object, path: str) -> None:
    write_text(spark, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, default=str), path)


def read_json(spark: SparkSession, path: str, default: object = None) -> object:
    """A JSON document, or the default where there is none."""
    from evidentia.sources.release import exists

    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if exists(spark, path) else default


AUDIT_FIELDS = ("audit_id", "record_type", "record_id", "record_snapshot", "snapshot_sha256", "review_label", "error_type", "correction_result", "review_notes", "reviewed_at", "review_method", "source_ids")
# What a reviewer attests by checking a fact or a question.
FACT_REVIEWED = "Reviewer checked the released relation against its exact registered evidence."
QUESTION_REVIEWED = "Reviewer checked the question, expected answer, evidence facts, and source URLs."
FACT_SNAPSHOT = ("fact_id", "subject", "predicate", "object", "evidence_source_id", "evidence_url", "evidence_text")
QUESTION_SNAPSHOT = ("question_id", "question", "answer", "answer_type", "evidence_fact_ids", "evidence_source_ids", "difficulty", "unanswerable")


def audit_samples(facts: DataFrame, questions: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """Audit rows of all manually checked facts and questions, and corrections (AUDIT_FIELDS), a row for each audit id.

    A snapshot is the compact key-sorted JSON of a record; a question's hash is that of its review.
    """
    from evidentia.functions import ids

    note = lambda key: T.note_value(F.col("notes"), key)
    method = lambda key, other: F.when(note(key) != "", note(key)).otherwise(other)

    def rows(df: DataFrame, kind: str, key: str, fields: tuple[str, ...], sha, told: str, by, sources) -> DataFrame:
        snapshot = ids.sorted_json(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))
        return df.filter("manual_checked").select(
            F.concat(F.lit(f"audit_{kind}_"), key).alias("audit_id"), F.lit(kind).alias("record_type"), F.col(key).alias("record_id"), snapshot.alias("record_snapshot"), (sha if sha is not None else F.sha2(snapshot, 256)).alias("snapshot_sha256"),
            F.lit("accepted").alias("review_label"), F.lit("none").alias("error_type"), F.lit("accepted_without_change").alias("correction_result"), F.lit(told).alias("review_notes"), note("reviewed_at").alias("reviewed_at"), by.alias("review_method"), sources.alias("source_ids"),
        )

    out = rows(facts, "fact", "fact_id", FACT_SNAPSHOT, None, FACT_REVIEWED, method("manual_review_id", "manual_fact_review"), F.array("evidence_source_id"))
    out = out.unionByName(rows(questions, "qa", "question_id", QUESTION_SNAPSHOT, ids.qa_sha256(), QUESTION_REVIEWED, method("qa_manual_review_id", "manual_qa_review"), F.col("evidence_source_ids")))
    return out if corrections is None else out.unionByName(corrections.select(*AUDIT_FIELDS))
