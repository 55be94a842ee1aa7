"""Readers of reviewed tables and configurations in YAML: small documents that the driver reads and turns into tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.operators.validate import AUDIT_FIELDS
from evidentia.sources.release import exists

HEADER = "review_id string, reviewed_at string, reviewer_role string, review_method string, source_id string, title string, publisher string, parent_page_url string, attachment_url string, attachment_sha256 string, raw_path string, region array<string>, topic array<string>, batch string, expected_rows int, catalog_kind string, level string, publication_status string, proposed_concept string, excluded_fields array<string>"
PROJECT_ROW = "review_id string, sequence int, source_sequence int, project_number string, project_name string, canonical_project_name string, category string, circulation_area string, level string, inheritors array<string>"
INHERITOR_ROW = "review_id string, sequence int, project_name string, person_name string, project_level string"
MUSEUM_ROW = "review_id string, source_id string, exhibit_id int, name string, category string, period string, museum string, material string"


def read_yaml(spark: SparkSession, path: str, default: object = None) -> object:
    """A YAML document from any store that Spark reads, or the default where there is none."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("a YAML library is needed to read reviewed documents") from e
    if not exists(spark, path):
        if default is None:
            raise FileNotFoundError(path)
        return default
    return yaml.safe_load(spark.read.text(path, wholetext=True).first()[0])


def _rows(spark: SparkSession, records: list[dict], shape: str, strict: bool = True) -> DataFrame:
    """A table of records; text is trimmed, and with ``strict`` an unknown field is an error."""
    names = [c.split()[0] for c in shape.split(", ")]
    unknown = sorted({k for r in records for k in r} - set(names)) if strict else []
    if unknown:
        raise ValueError(f"unknown fields: {', '.join(unknown)}")
    kinds = dict(c.split() for c in shape.split(", "))

    def value(record: dict, name: str):
        v = record.get(name)
        if v is None:
            return [] if kinds[name].startswith("array") else None
        if kinds[name] == "string":
            return str(v).strip()
        return [str(x).strip() for x in v] if kinds[name].startswith("array") else v

    return spark.createDataFrame([tuple(value(r, n) for n in names) for r in records], shape)


def reviewed_catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(header, rows)`` of a reviewed catalog of projects or, by its ``catalog_kind``, of inheritors."""
    document = dict(read_yaml(spark, path))
    rows = [{"review_id": document["review_id"]} | r for r in document.pop("rows")]
    document = {"catalog_kind": "project", "publication_status": "final"} | document
    document["reviewed_at"] = str(document["reviewed_at"])
    return _rows(spark, [document], HEADER), _rows(spark, rows, INHERITOR_ROW if document["catalog_kind"] == "inheritor" else PROJECT_ROW)


def museum_review(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """``(header, rows)`` of a museum review; the header tells the expected numbers of sources and facts."""
    document = dict(read_yaml(spark, path))
    rows = [{"review_id": document["review_id"]} | r for r in document.pop("rows")]
    return document | {"reviewed_at": str(document["reviewed_at"])}, _rows(spark, rows, MUSEUM_ROW)


def corrections(spark: SparkSession, path: str) -> DataFrame:
    """Audit rows of recorded corrections, with the hash of their snapshot; none where there is no document."""
    document = read_yaml(spark, path, {}) or {}
    own = {"reviewed_at": str(document.get("reviewed_at", "")), "review_method": str(document.get("review_method", ""))}
    shape = ", ".join(f"{c} {'array<string>' if c == 'source_ids' else 'string'}" for c in AUDIT_FIELDS)
    rows = _rows(spark, [{c: "" for c in AUDIT_FIELDS if c != "source_ids"} | r | own for r in document.get("records", [])], shape, strict=False)
    return rows.withColumn("snapshot_sha256", F.sha2("record_snapshot", 256))


def attachments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, sha256)`` of the attachments that are there, hashed by executors."""
    files = [spark.read.format("binaryFile").load(p).select(F.lit(p).alias("path"), F.sha2("content", 256).alias("sha256")) for p in paths if exists(spark, p)]
    return reduce(DataFrame.union, files, spark.createDataFrame([], "path string, sha256 string"))
