"""Record schemas: closed domains, ranges and cross-field rules of each table, as violations instead of exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, MapType, StringType, StructField, StructType

# The closed domains of the tables' columns.
SOURCE_TYPES = (
    "national_official_database",
    "provincial_government",
    "provincial_culture_tourism_department",
    "municipal_or_county_government",
    "museum_or_scenic_spot_official",
    "restricted_reference",
    "other",
)
LICENSES = ("open", "government_public", "unclear", "restricted", "forbidden")
POLICIES = ("full_text_allowed", "government_public", "short_excerpt_only", "metadata_and_facts_only", "local_only", "exclude")
CRAWL_STATES = ("pending", "fetched", "parsed", "failed", "skipped")
REVIEW_STATES = ("pending", "approved", "rejected")
CONFIDENCES = ("high", "medium", "low")
ENTITY_TYPES = ("ICH_PROJECT", "REGION", "CATEGORY", "PERSON", "ORGANIZATION", "ETHNIC_GROUP", "SCENIC_SPOT", "FESTIVAL_EVENT", "MUSEUM_OBJECT", "MATERIAL", "HISTORICAL_PERIOD", "CONCEPT")
PREDICATES = (
    "belongs_to_category",
    "located_in",
    "declared_by",
    "protected_by",
    "inherited_by",
    "associated_with_ethnic_group",
    "related_to_festival",
    "mentioned_in_source",
    "has_level",
    "related_to_concept",
    "held_by",
    "created_in_period",
    "made_of",
)
METHODS = ("rule", "table_parse", "llm_assisted", "manual_seed", "manual_review")
CHUNK_KINDS = ("open_text", "synthetic_fact")
ANSWER_TYPES = ("single_fact", "multi_hop", "regional_aggregation", "comparison", "unanswerable")
DIFFICULTIES = ("easy", "medium", "hard")
DISCOVERIES = ("ihchina_catalog", "ihchina_inheritor_catalog", "whlyt_search", "guide_tourism", "tibetan_museum_exhibit", "manual")
#: Policies that forbid the release of whole texts, and those that allow it.
CLOSED = ("metadata_and_facts_only", "local_only", "exclude", "short_excerpt_only")
OPEN = ("full_text_allowed", "government_public")


_KINDS = {"string": StringType(), "boolean": BooleanType(), "int": IntegerType(), "array<string>": ArrayType(StringType()), "map<string,string>": MapType(StringType(), StringType())}


def schema(text: str) -> StructType:
    """A schema from ``name kind, name kind, ...``; unlike Spark's own reader it needs no session."""
    return StructType([StructField(*(c.split()[0], _KINDS[c.split()[1]])) for c in text.split(", ")])


SCHEMAS = {
    "sources": schema("source_id string, title string, publisher string, source_type string, url string, domain string, language string, province string, region array<string>, topic array<string>, retrieved_at string, license_status string, release_policy string, raw_text_release boolean, crawl_status string, content_sha256 string, notes string"),
    "candidates": schema("candidate_id string, source_id string, title string, publisher string, source_type string, url string, domain string, province string, region array<string>, topic array<string>, license_status string, release_policy string, raw_text_release boolean, discovery_method string, discovered_at string, review_status string, catalog_metadata map<string,string>, notes string"),
    "entities": schema("entity_id string, name string, type string, aliases array<string>, description string, province string, regions array<string>, canonical_source_id string, confidence string, notes string"),
    "facts": schema("fact_id string, subject string, subject_type string, predicate string, object string, object_type string, evidence_source_id string, evidence_url string, evidence_text string, extraction_method string, verified boolean, confidence string, manual_checked boolean, notes string"),
    "chunks": schema("chunk_id string, doc_id string, source_id string, text string, char_start int, char_end int, topic_labels array<string>, region_labels array<string>, entity_mentions array<string>, license_status string, release_policy string, source_url string, retrieved_at string, chunk_kind string, notes string"),
    "questions": schema("question_id string, question string, answer string, answer_type string, evidence_fact_ids array<string>, evidence_source_ids array<string>, required_entities array<string>, difficulty string, unanswerable boolean, manual_checked boolean, notes string"),
}
KEYS = {"sources": "source_id", "candidates": "candidate_id", "entities": "entity_id", "facts": "fact_id", "chunks": "chunk_id", "questions": "question_id"}
#: Columns that may be null; of all others a null is a violation.
NULLABLE = {"evidence_text"}


def is_date(value: Column) -> Column:
    """Whether a text is a calendar day in ISO form."""
    return F.coalesce(value.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(value, "yyyy-MM-dd").isNotNull(), F.lit(False))


def _one_of(column: str, domain: tuple[str, ...]) -> Column:
    return F.col(column).isin(list(domain))


def rules(name: str) -> dict[str, Column]:
    """What has to hold for each record of a table, by the name of the rule."""
    common = {"license_status": _one_of("license_status", LICENSES), "release_policy": _one_of("release_policy", POLICIES)}
    if name == "sources":
        return common | {"source_type": _one_of("source_type", SOURCE_TYPES), "crawl_status": _one_of("crawl_status", CRAWL_STATES), "retrieved_at": is_date(F.col("retrieved_at")), "closed_policy_releases_text": ~(_one_of("release_policy", CLOSED) & F.col("raw_text_release"))}
    if name == "candidates":
        return common | {"source_type": _one_of("source_type", SOURCE_TYPES), "discovery_method": _one_of("discovery_method", DISCOVERIES), "review_status": _one_of("review_status", REVIEW_STATES), "discovered_at": is_date(F.col("discovered_at"))}
    if name == "entities":
        return {"type": _one_of("type", ENTITY_TYPES), "confidence": _one_of("confidence", CONFIDENCES)}
    if name == "facts":
        return {"predicate": _one_of("predicate", PREDICATES), "extraction_method": _one_of("extraction_method", METHODS), "confidence": _one_of("confidence", CONFIDENCES), "evidence_source_required": F.col("evidence_source_id") != ""}
    if name == "chunks":
        return common | {"chunk_kind": _one_of("chunk_kind", CHUNK_KINDS), "offsets": (F.col("char_start") >= 0) & (F.col("char_end") >= F.col("char_start")), "policy_allows_text": _one_of("release_policy", OPEN)}
    if name == "questions":
        answerable = (F.size("evidence_fact_ids") > 0) & (F.size("evidence_source_ids") > 0)
        return {"answer_type": _one_of("answer_type", ANSWER_TYPES), "difficulty": _one_of("difficulty", DIFFICULTIES), "evidence_or_unanswerable": F.when(F.col("unanswerable"), F.col("answer_type") == "unanswerable").otherwise(answerable)}
    raise ValueError(f"no such table: {name}")


def trimmed(df: DataFrame) -> DataFrame:
    """String columns without white space at their ends, as records are loaded."""
    return df.withColumns({c: F.trim(c) for c, t in df.dtypes if t == "string"})


def record_problems(df: DataFrame, name: str, defaults: dict[str, Column] | None = None) -> DataFrame:
    """``(record_id, rule)``: unknown and missing columns (record null), null values, and each rule that a record breaks.

    Missing columns that have a default are filled with it; rules that need a column that isn't there can't hold.
    """
    spark, known = df.sparkSession, SCHEMAS[name]
    extra = [(None, f"unknown column {c}") for c in df.columns if c not in known.fieldNames()]
    full = df.withColumns({c: v for c, v in (defaults or {}).items() if c not in df.columns})
    lost = [c for c in known.fieldNames() if c not in full.columns and c not in NULLABLE]
    out = spark.createDataFrame(extra + [(None, f"missing column {c}") for c in lost], "record_id string, rule string")
    full = trimmed(full.withColumns({c: F.lit(None).cast(known[c].dataType) for c in lost}))
    checks = {f"null {c}": F.col(c).isNotNull() for c in known.fieldNames() if c not in lost and c not in NULLABLE and c in full.columns}
    checks |= rules(name)
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)) for rule, ok in checks.items())))
    return out.union(full.select(F.col(KEYS[name]).cast("string"), F.explode(broken)))
