"""Source candidates from stored catalog payloads; the network is left to whoever stores them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions import ids, urls
from evidentia.functions import text as T
from evidentia.operators.merge import keep_last

PROVINCE = "青海省"
CATALOG_ITEM = "id string, num string, auto_id string, title string, type string, rx_time string, cate string, province string, protect_unit string, day string, sex string, nation string, project_num string, project string, unit string"
EXHIBIT = "exhibit_id string, exhibit_name string, museum_id string, museum_name string, cate_id string, cate_name string, year_name string, texture_name string, three_url string, content string"
CATALOG = f"list array<struct<{CATALOG_ITEM.replace(' string', ':string')}>>"
EXHIBITS = f"status int, msg string, data struct<count:int,list:array<struct<{EXHIBIT.replace(' string', ':string')}>>>"
DETAIL = f"status int, msg string, data struct<{EXHIBIT.replace(' string', ':string')}>"


def _text(c: str | Column) -> Column:
    return F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))


def _items(payloads: DataFrame, schema: str, path: str) -> DataFrame:
    """Items of payloads ``(ordinal, payload)``, in the order of payloads and of their lists."""
    parsed = payloads.select("ordinal", F.from_json("payload", schema).alias("p"))
    return parsed.select("ordinal", "p", F.posexplode(f"p.{path}").alias("at", "item")).withColumn("order", F.struct("ordinal", "at"))


def _candidates(items: DataFrame, prefix: str, remote: Column, url: Column, title: Column, regions: Column, topics: Column, method: str, metadata: dict[str, Column], publisher: Column, kind: str) -> DataFrame:
    flat = F.create_map(*(x for k, v in metadata.items() for x in (F.lit(k), v)))
    out = items.select(
        ids.candidate_id(url).alias("candidate_id"), F.concat(F.lit(prefix), remote).alias("source_id"), title.alias("title"), publisher.alias("publisher"), F.lit(kind).alias("source_type"), url.alias("url"),
        urls.domain(url).alias("domain"), regions.alias("region"), topics.alias("topic"), F.lit("unclear").alias("license_status"), F.lit("metadata_and_facts_only").alias("release_policy"), F.lit(False).alias("raw_text_release"),
        F.lit(method).alias("discovery_method"), F.lit("pending").alias("review_status"), flat.alias("catalog_metadata"), "order",
    )
    return keep_last(out, ["source_id"], "order").drop("order")


def _regions(applicant: Column) -> Column:
    return F.when((applicant != "") & (applicant != PROVINCE), F.array(F.lit(PROVINCE), applicant)).otherwise(F.array(F.lit(PROVINCE)))


def project_candidates(payloads: DataFrame, detail_base: str) -> DataFrame:
    """Candidates of national projects; items without id or title are passed over, the last of an id counts."""
    i = lambda k: _text(f"item.{k}")
    rows = _items(payloads, CATALOG, "list").filter((i("id") != "") & (i("title") != ""))
    url = F.concat(F.lit(detail_base + "/"), i("id"), F.lit(".html"))
    meta = {"remote_id": i("id"), "project_number": i("num"), "project_sequence": i("auto_id"), "category": i("type"), "publication_batch": T.without_breaks(i("rx_time")), "entry_type": i("cate"), "applicant": i("province"), "protection_unit": i("protect_unit")}
    topics = F.filter(F.array(F.lit("非遗"), i("type")), lambda x: x != "")
    return _candidates(rows, "src_ihchina_", i("id"), url, i("title"), _regions(i("province")), topics, "ihchina_catalog", meta, F.lit("中国非物质文化遗产网"), "national_official_database")


def inheritor_candidates(payloads: DataFrame, detail_base: str) -> DataFrame:
    """Candidates of national inheritors; the applicant is the province, or the unit where that is empty."""
    i = lambda k: _text(f"item.{k}")
    rows = _items(payloads, CATALOG, "list").filter((i("id") != "") & (i("title") != "") & (i("project") != ""))
    url = F.concat(F.lit(detail_base + "/"), i("id"), F.lit(".html"))
    applicant = F.coalesce(F.nullif(i("province"), F.lit("")), i("unit"))
    meta = {"remote_id": i("id"), "inheritor_number": i("num"), "person": i("title"), "gender": i("sex"), "ethnic_group": i("nation"), "birth_date": i("day"), "category": i("type"), "project_number": i("project_num"), "project": i("project"), "recognition_batch": T.without_breaks(i("rx_time")), "applicant": applicant, "unit": i("unit")}
    topics = F.filter(F.array(F.lit("非遗"), F.lit("代表性传承人"), i("type")), lambda x: x != "")
    return _candidates(rows, "src_ihchina_inheritor_", i("id"), url, i("title"), _regions(applicant), topics, "ihchina_inheritor_catalog", meta, F.lit("中国非物质文化遗产网"), "national_official_database")


def exhibit_candidates(payloads: DataFrame, detail_base: str, publisher: str) -> DataFrame:
    """Candidates of museum objects; a payload with another status than 1 fails the query."""
    i = lambda k: _text(f"item.{k}")
    items = _items(payloads, EXHIBITS, "data.list")
    ok = F.when(F.coalesce(F.col("p.status"), F.lit(0)) == 1, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("museum API returned unsuccessful status: "), F.coalesce("p.msg", F.lit("")))).cast("boolean"))
    rows = items.filter(ok).filter((i("exhibit_id") != "") & (i("exhibit_name") != ""))
    url = F.concat(F.lit(detail_base + "?exhibit_id="), i("exhibit_id"), F.lit("&p=w"))
    meta = {"exhibit_id": i("exhibit_id"), "museum_id": i("museum_id"), "museum_name": i("museum_name"), "category_id": i("cate_id"), "category": i("cate_name"), "period": i("year_name"), "texture": i("texture_name"), "has_3d": F.when(i("three_url") != "", "true").otherwise("false")}
    topics = F.filter(F.array(*map(F.lit, ("博物馆与文化场馆", "民族文化", "馆藏文物")), i("cate_name")), lambda x: x != "")
    regions = F.array(F.lit(PROVINCE), F.lit("西宁市"))
    return _candidates(rows, "src_tibetan_museum_exhibit_", i("exhibit_id"), url, i("exhibit_name"), regions, topics, "tibetan_museum_exhibit", meta, F.lit(publisher), "museum_or_scenic_spot_official")


def exhibit_details(payloads: DataFrame, publisher: str) -> DataFrame:
    """``(ordinal, exhibit_id, text, problem)`` of detail payloads ``(ordinal, payload, expected_id)``: the labelled text, or why there is none."""
    parsed = payloads.select("ordinal", "expected_id", F.from_json("payload", DETAIL).alias("p"))
    d = lambda k: _text(f"p.data.{k}")
    problem = (
        F.when(F.coalesce(F.col("p.status"), F.lit(0)) != 1, "unsuccessful status")
        .when(F.col("expected_id").isNotNull() & (F.col("expected_id") != d("exhibit_id")), "exhibit id mismatch")
        .when(d("museum_name") != publisher, "unexpected owner")
        .when(d("exhibit_name") == "", "missing name")
    )
    content = F.btrim(F.regexp_replace(F.regexp_replace(d("content"), "<[^>]*>", "\n"), r"\s*\n\s*", "\n"), F.lit(" \n"))
    fields = [("文物名称", d("exhibit_name")), ("馆藏机构", d("museum_name")), ("文物类别", d("cate_name")), ("年代", d("year_name")), ("质地", d("texture_name")), ("馆藏说明", content)]
    text = F.concat_ws("\n", *(F.when(v != "", F.concat(F.lit(f"{k}："), v)) for k, v in fields))
    return parsed.select("ordinal", d("exhibit_id").alias("exhibit_id"), F.when(problem.isNull(), text).alias("text"), problem.alias("problem"))


def to_sources(candidates: DataFrame) -> DataFrame:
    """Candidates as registry rows that wait for collection."""
    return candidates.select("source_id", "title", "publisher", "source_type", "url", "domain", "region", "topic", "license_status", "release_policy", "raw_text_release", F.lit("pending").alias("crawl_status"), F.lit("").alias("notes"))


def best_by_title(candidates: DataFrame, *order: Column) -> DataFrame:
    """The best candidate of each title key in the given order."""
    keyed = candidates.withColumn("_key", T.text_key(F.col("title")))
    rank = F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    return keyed.withColumn("_n", rank).filter("_n = 1").drop("_n", "_key")
