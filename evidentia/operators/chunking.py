"""Text chunks: splitting at sentence boundaries with overlap, labels, and summaries of facts."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.operators.names import finder
from evidentia.operators.policy import may_release_text
from evidentia.operators.retrieval import counted
from evidentia.plans.shared import written

BOUNDARY = re.compile(r"[。！？；\n]+")
# Sentence ends, topic terms, and what a relation says of its object.
TOPIC_TERMS = ("非遗", "民族文化", "生态旅游", "博物馆", "传统美术", "传统技艺")
STATEMENTS = {
    "belongs_to_category": "所属类别为“{object}”",
    "located_in": "所在地为“{object}”",
    "declared_by": "申报地区或单位为“{object}”",
    "protected_by": "保护单位为“{object}”",
    "inherited_by": "代表性传承人为“{object}”",
    "associated_with_ethnic_group": "相关民族为“{object}”",
    "related_to_festival": "相关节庆或活动为“{object}”",
    "mentioned_in_source": "相关来源或概念为“{object}”",
    "has_level": "项目级别为“{object}”",
    "related_to_concept": "相关概念为“{object}”",
    "held_by": "馆藏机构为“{object}”",
    "created_in_period": "年代为“{object}”",
    "made_of": "质地为“{object}”",
}


def spans(text: str, size: int = 500, overlap: int = 80) -> Iterator[tuple[int, int, str]]:
    """``(start, end, chunk)`` of a text without outer white space; offsets refer to that text.

    A chunk ends at the last boundary within ``size``, else at ``size``; the next starts at the last boundary before the
    overlap, else at the overlap. A chunk no longer than the overlap is not overlapped.
    """
    if not 0 <= overlap < size:
        raise ValueError("size must exceed overlap, which must not be negative")
    text = text.strip()
    stops = [m.end() for m in BOUNDARY.finditer(text)]

    def last_stop(after: int, upto: int) -> int | None:
        i = bisect_right(stops, upto)
        return stops[i - 1] if i and stops[i - 1] > after else None

    at = 0
    while at < len(text):
        reach = min(at + size, len(text))
        end = reach if reach == len(text) else last_stop(at, reach) or reach
        piece = text[at:end]
        bare = piece.strip()
        if bare:
            lead = len(piece) - len(piece.lstrip())
            yield at + lead, at + lead + len(bare), bare
        if end == len(text):
            return
        if end - at <= overlap:
            at = end
        else:
            back = max(end - overlap, at + 1)
            at = last_stop(at, back) or back


def split_documents(documents: DataFrame, size: int = 500, overlap: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, char_start, char_end, text)``: the chunks of each document, Arrow batch by batch on the map side."""
    if not 0 <= overlap < size:
        raise ValueError("size must exceed overlap, which must not be negative")
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *s) for i, t in zip(batch["id"], batch["text"], strict=True) if t for s in spans(t, size, overlap)]
            yield pd.DataFrame(rows, columns=["doc_id", "char_start", "char_end", "text"])

    return documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"doc_id {kind}, char_start int, char_end int, text string")


def infer_labels(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """``chunks`` with entity mentions, region and topic labels: names and aliases found in the text, and fixed topic terms.

    Substrings of a chunk that may be names (``names.finder``) meet the entities by equality, so the entity table may be of any size.
    Chunks are written once with what was found, under a number of their own; chunks that are equal stay apart.
    """
    spelled = entities.select("name", "type", F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("_mention")).filter("_mention <> ''").distinct()
    spelled = counted(spelled)
    found = finder(spelled, "_mention")
    marked = written(chunks.withColumns({"_found": found(F.col("text")), "_number": F.monotonically_increasing_id()}), "chunks")
    met = marked.select("_number", F.explode("_found").alias("_mention")).join(spelled, "_mention")
    hits = met.groupBy("_number").agg(F.collect_set(F.struct("name", "type")).alias("_hit"))
    both = marked.join(hits, "_number", "left").withColumn("_hit", F.coalesce("_hit", F.array().cast(hits.schema["_hit"].dataType)))
    of = lambda kind: F.transform(F.filter("_hit", lambda e: e["type"] == kind), lambda e: e["name"])
    terms = F.array_compact(F.array(*(F.when(F.contains("text", F.lit(t)), F.lit(t)) for t in TOPIC_TERMS)))
    tidy = lambda c: F.array_sort(F.array_distinct(c))
    labels = {"topics": tidy(F.concat(of("CATEGORY"), terms)), "regions": tidy(of("REGION")), "entity_mentions": tidy(F.transform("_hit", lambda e: e["name"]))}
    return both.withColumns(labels).drop("_number", "_found", "_hit")


def open_chunks(documents: DataFrame, sources: DataFrame, entities: DataFrame, size: int = 500, overlap: int = 80) -> DataFrame:
    """Chunks of the documents whose source may release text, with labels joined to the source's own."""
    allowed = sources.filter(may_release_text(F.col("release_policy"), F.col("raw_text_release"))).select("source_id", "topic", "region", "release_policy")
    docs = documents.join(allowed, "source_id")
    pieces = split_documents(docs.select(F.struct("doc_id", "source_id", "topic", "region").alias("key"), "text"), size, overlap, "key").select("doc_id.*", "char_start", "char_end", "text")
    out = infer_labels(pieces, entities)
    labels = lambda a, b: F.array_sort(F.array_distinct(F.array_union(a, b)))
    return out.select(ids.chunk_id(F.col("doc_id"), F.col("char_start"), F.col("char_end"), F.col("text")).alias("chunk_id"), "doc_id", "source_id", "char_start", "char_end", "text", labels("topic", "topics").alias("topic_labels"), labels("region", "regions").alias("region_labels"), "entity_mentions")


def synthetic_chunks(facts: DataFrame, sources: DataFrame, opening: str = "以下是根据已核验结构化事实生成的中性摘要，并非来源原文：") -> DataFrame:
    """One summary of a subject's publishable facts for each of its registered sources, in the order of fact ids."""
    good = facts.filter(F.col("verified") & F.col("confidence").isin("high", "medium"))
    said = F.coalesce(*(F.when(F.col("predicate") == p, F.replace(F.lit(t), F.lit("{object}"), F.col("object"))) for p, t in STATEMENTS.items()))
    items = F.array_sort(F.collect_list(F.struct("fact_id", said.alias("said"))))
    grouped = good.groupBy("subject", F.col("evidence_source_id").alias("source_id")).agg(F.array_join(F.transform(items, lambda x: x["said"]), "；").alias("said"), F.array_sort(F.array_distinct(F.concat(F.collect_set("subject"), F.collect_set("object")))).alias("entity_mentions"))
    known = grouped.join(sources.select("source_id"), "source_id", "left_semi")
    text = F.concat(F.lit(f"{opening}关于"), "subject", F.lit("，"), "said", F.lit("。依据来源编号 "), "source_id", F.lit("。"))
    out = known.select(ids.synthetic_document_id(F.col("subject"), F.col("source_id")).alias("doc_id"), "source_id", text.alias("text"), "entity_mentions")
    return out.select(ids.chunk_id(F.col("doc_id"), F.lit(0), F.char_length("text"), F.col("text")).alias("chunk_id"), "*")
