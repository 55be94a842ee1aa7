"""Candidates and article checks from stored listing pages: elements come from an HTML parser, rules are expressions."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions import ids, urls
from evidentia.operators.merge import keep_last
from evidentia.plans.shared import dealt

#: Elements that a worker holds at a time, and somewhat more: a page's stay together.
ELEMENTS_AT_ONCE = 10_000
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Phrases that forbid reprinting, and title words of topics.
RESTRICTIONS = ("未经许可不得转载", "严禁转载", "禁止转载", "禁止复制")
KEYWORD_TOPICS = {
    "非遗": ["非遗", "非物质文化遗产"],
    "民族文化": ["民族", "藏族", "回族", "土族", "蒙古族", "撒拉族"],
    "景区与文化地点": ["景区", "景点", "旅游线路", "公园", "古城", "遗址", "寺"],
    "博物馆与文化场馆": ["博物馆", "文化馆", "展览馆", "非遗馆", "保护中心"],
    "生态旅游": ["生态", "湿地", "地质公园", "自然保护区", "黄河", "青海湖"],
    "文旅政策": ["政策", "规划", "条例", "办法", "通知", "公示", "实施方案"],
}


class _Elements(HTMLParser):
    """Each element with its place, its parent's place, attributes and whole text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs) -> None:
        a = {k: v or "" for k, v in attrs}
        self.found.append({"tag": tag, "parent": self.open[-1] if self.open else -1, "attrs": a, "text": []})
        if tag not in VOID:
            self.open.append(len(self.found) - 1)

    def handle_endtag(self, tag) -> None:
        if any(self.found[i]["tag"] == tag for i in self.open):
            while self.found[self.open.pop()]["tag"] != tag:
                pass

    def handle_data(self, data) -> None:
        for i in self.open:
            self.found[i]["text"].append(data)


def elements(pages: DataFrame, id_col: str = "page", html_col: str = "html") -> DataFrame:
    """``(page, at, parent, tag, classes, attrs, text)``: every element of every page, in order; text with single spaces.

    Pages are dealt to tasks by their number. Nothing tells Spark how many elements come out, so joins of them are hinted.
    """
    columns = ["page", "at", "parent", "tag", "classes", "attrs", "text"]
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, html in zip(batch["page"], batch["html"], strict=True):
                parser = _Elements()
                parser.feed(html or "")
                parser.close()
                rows += [(key, i, e["parent"], e["tag"], e["attrs"].get("class", "").split(), e["attrs"], " ".join(" ".join(p.strip() for p in e["text"]).split())) for i, e in enumerate(parser.found)]
                if len(rows) >= ELEMENTS_AT_ONCE:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    shape = f"page {kind}, at int, parent int, tag string, classes array<string>, attrs map<string,string>, text string"
    return dealt(pages.select(F.col(id_col).alias("page"), F.col(html_col).alias("html"))).mapInPandas(run, shape)


def _attr(name: str) -> Column:
    return F.coalesce(F.try_element_at("attrs", F.lit(name)), F.lit(""))


def inspect_articles(pages: DataFrame, publisher: str) -> DataFrame:
    """``(page, body, eligible, reasons)``: whether an article may be released whole: own source, no author, no restriction in its body."""
    e = elements(pages)
    meta = lambda n: F.max(F.when((F.col("tag") == "meta") & (_attr("name") == n), F.trim(_attr("content"))))
    body = F.min_by(F.when(F.array_contains("classes", "app-content-body"), F.col("text")), F.when(F.array_contains("classes", "app-content-body"), F.col("at")))
    found = e.groupBy("page").agg(meta("ContentSource").alias("source"), meta("Author").alias("a"), meta("ArticleAuthor").alias("b"), body.alias("body"))
    text = F.coalesce("body", F.lit(""))
    author = F.coalesce(F.nullif("a", F.lit("")), F.col("b"), F.lit(""))
    stop = F.lit(False)
    for phrase in RESTRICTIONS:
        stop = stop | F.contains(text, F.lit(phrase))
    rules = {"missing_article_body": text == "", "third_party_or_missing_content_source": F.coalesce("source", F.lit("")) != publisher, "signed_article": author != "", "page_specific_restriction": stop}
    reasons = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))
    return found.select("page", text.alias("body"), (F.size(reasons) == 0).alias("eligible"), reasons.alias("reasons"))


def search_candidates(pages: DataFrame, origin: str) -> DataFrame:
    """Candidates of search result pages: items with a title whose last path segment has a digit; the number in the path, or a hash, names them."""
    e = elements(pages)
    items = e.filter((F.col("tag") == "a") & F.array_contains("classes", "app-article-item") & (_attr("href") != ""))
    items = items.select("page", "at", _attr("href").alias("href"), _attr("cid").alias("column_id"), _attr("contentid").alias("search_content_id"))
    inner = e.select("page", F.col("parent").alias("at"), F.when(F.array_contains("classes", "app-article-title"), F.col("text")).alias("t"), F.when(F.array_contains("classes", "app-article-date"), F.col("text")).alias("d"))
    inner = inner.filter("t is not null or d is not null")
    met = items.join(inner.hint("merge"), ["page", "at"], "left").groupBy("page", "at", "href", "column_id", "search_content_id").agg(F.first("t", True).alias("title"), F.first("d", True).alias("published_at"))
    path = F.regexp_replace(F.regexp_extract("href", r"^(?:[a-z]+:)?(?://[^/]*)?([^?#]*)", 1), "/+$", "")
    url = F.concat(F.lit(origin), path)
    number = F.regexp_extract(path, r"^/content/(\d+)$", 1)
    suffix = F.when(number != "", number).otherwise(ids.digest(url, length=12))
    good = met.filter(F.coalesce("title", F.lit("")) != "").filter(F.substring_index(path, "/", -1).rlike(r"\d"))
    out = good.select(ids.candidate_id(url).alias("candidate_id"), F.concat(F.lit("src_whlyt_content_"), suffix).alias("source_id"), "title", url.alias("url"), F.coalesce("published_at", F.lit("")).alias("published_at"), "column_id", "search_content_id", F.struct("page", "at").alias("order"))
    return keep_last(out, ["source_id"], "order").drop("order")


def search_totals(pages: DataFrame) -> DataFrame:
    """``(page, reported_total, total_pages)`` of search result pages."""
    e = elements(pages)
    total = F.max(F.when(F.array_contains("classes", "total"), F.replace(F.regexp_extract("text", r"([\d,]+)", 1), F.lit(","), F.lit(""))))
    last = F.max(F.when(F.col("tag") == "a", F.expr("try_cast(regexp_extract(attrs['href'], '[?&]page=([0-9]+)', 1) as int)")))
    return e.groupBy("page").agg(F.coalesce(total.try_cast("int"), F.lit(0)).alias("reported_total"), F.greatest(F.lit(1), F.coalesce(last, F.lit(1))).alias("total_pages"))


def county_totals(pages: DataFrame) -> DataFrame:
    """``(page, reported_total, total_pages)`` of a county portal's listing pages: of its first total; 0 and 1 where there is none."""
    e = elements(pages)
    inside = e.filter(F.array_contains("classes", "page")).select("page", F.col("at").alias("parent"))
    total = e.filter(F.array_contains("classes", "total")).join(inside.hint("merge"), ["page", "parent"], "left_semi").groupBy("page").agg(F.min_by("text", "at").alias("text"))
    number = lambda k: F.regexp_extract(F.coalesce("text", F.lit("")), r"共\s*(\d+)\s*条信息\s*/\s*共\s*(\d+)\s*页", k).try_cast("int")
    found = pages.select("page").distinct().join(total.hint("merge"), "page", "left")
    return found.select("page", F.coalesce(number(1), F.lit(0)).alias("reported_total"), F.coalesce(number(2), F.lit(1)).alias("total_pages"))


def page_numbers(totals: DataFrame, max_pages: int | None = None) -> DataFrame:
    """``(section, number)`` of the pages to collect for sections ``(section, total_pages)``: all of them, or the first ``max_pages``."""
    if max_pages is not None and max_pages <= 0:
        raise ValueError("max_pages must be positive")
    last = F.greatest(F.col("total_pages"), F.lit(1))
    return totals.select("section", F.explode(F.sequence(F.lit(1), F.least(last, F.lit(max_pages)) if max_pages else last)).alias("number"))


def page_url(base: Column, section: Column, number: Column) -> Column:
    """The address of a section's page: the first has no number."""
    return F.concat(base, F.lit("/"), section, F.when(number == 1, "").otherwise(F.concat(F.lit("_"), number.cast("string"))))


def topics_of(title: Column, own: list[str]) -> Column:
    """The section's topics, then those whose words stand in the title."""
    extra = []
    for topic, words in KEYWORD_TOPICS.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(title, F.lit(w))
        extra.append(F.when(hit, F.lit(topic)))
    return F.array_distinct(F.concat(F.array(*map(F.lit, own)), F.array_compact(F.array(*extra))))


def county_candidates(pages: DataFrame, section: str, section_topics: list[str], origin: str) -> DataFrame:
    """Candidates of a county portal's section: content links on the portal's own host, title and date from the link's title attribute."""
    e = elements(pages).filter((F.col("tag") == "a") & F.contains(_attr("href"), F.lit(f"/gdly/{section}/content_")))
    href, note = _attr("href"), _attr("title")
    host = F.when(href.rlike("^[a-z]+://"), urls.domain(href)).otherwise(F.lit(origin.split("://")[1].removeprefix("www.")))
    path = F.regexp_extract(href, r"^(?:[a-z]+://[^/]*)?([^?#]*)", 1)
    number = F.regexp_extract(path, r"/content_(\d+)$", 1)
    # How a link's title attribute tells the article's title and date.
    named = F.trim(F.regexp_extract(note, r"(?s)标题：(.*?)(?:点击数：|发表时间：|$)", 1))
    title = F.when(note.rlike("标题："), F.btrim(named, F.lit(" \r\n\t"))).otherwise(F.col("text"))
    url = F.concat(F.lit(origin), path)
    good = e.filter((number != "") & (title != "") & (host == origin.split("://")[1].removeprefix("www.")))
    out = good.select(ids.candidate_id(url).alias("candidate_id"), F.concat(F.lit("src_guide_content_"), number).alias("source_id"), title.alias("title"), url.alias("url"), topics_of(title, section_topics).alias("topic"), F.btrim(F.regexp_extract(note, r"发表时间：([^\r\n]+)", 1)).alias("published_at"), F.struct("page", "at").alias("order"))
    return keep_last(out, ["source_id"], "order").drop("order")
