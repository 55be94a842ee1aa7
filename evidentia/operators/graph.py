"""The property graph of facts and retrieval over its k-hop neighbourhoods, for many questions at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.operators.retrieval import DIGITS, characters, counted, ranked
from evidentia.plans.shared import written

# Words in a question that ask for a relation, in the order in which relations win ties.
CUES = {
    "declared_by": ("申报", "申报方", "申报地区", "申报单位"),
    "belongs_to_category": ("类别", "分类", "哪一类", "属于"),
    "inherited_by": ("传承人", "传承者", "谁传承"),
    "associated_with_ethnic_group": ("民族", "族群"),
    "has_level": ("级别", "等级", "国家级"),
    "held_by": ("馆藏", "收藏", "哪个馆", "博物馆"),
    "created_in_period": ("年代", "时期", "朝代"),
    "made_of": ("质地", "材质", "材料", "制成"),
    "located_in": ("位于", "所在地", "哪里"),
}
CONFIDENCE = {"high": 1.0, "medium": 0.75, "low": 0.4}


def build_graph(entities: DataFrame, facts: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes, edges)``: entity and source nodes, ends of facts that no entity names; a fact edge, and a provenance edge if its source is registered.

    ``entities``: (name, type); ``facts`` with ``subject_name`` and ``object_name`` as canonical names.
    """
    node = lambda kind, name: ids.entity_node_id(F.col(kind), F.col(name))
    own = entities.select(node("type", "name").alias("node"), F.lit("entity").alias("kind"), "name")
    ends = facts.select(node("subject_type", "subject_name").alias("node"), F.col("subject").alias("name")).union(facts.select(node("object_type", "object_name"), "object"))
    implied = ends.groupBy("node").agg(F.min("name").alias("name")).join(own.select("node"), "node", "left_anti").select("node", F.lit("entity").alias("kind"), "name")
    registered = sources.select(F.concat(F.lit("source:"), "source_id").alias("node"), F.lit("source").alias("kind"), F.col("title").alias("name"))
    edges = facts.select(node("subject_type", "subject_name").alias("u"), node("object_type", "object_name").alias("v"), "predicate", "fact_id")
    proof = facts.join(sources.select(F.col("source_id").alias("evidence_source_id")), "evidence_source_id", "left_semi")
    proof = proof.select(node("subject_type", "subject_name").alias("u"), F.concat(F.lit("source:"), "evidence_source_id").alias("v"), F.lit("supported_by").alias("predicate"), "fact_id")
    return own.union(implied).union(registered), edges.union(proof)


def mentions(questions: DataFrame, entities: DataFrame) -> DataFrame:
    """``(qid, node, mention)``: entities whose name or alias stands in the question, less those within a longer mention.

    Each question's substrings of the lengths that names have are its keys, and meet the names by equality: rows grow with the length of
    the questions, not with entities times questions. The lengths are read first; no question has more of them than characters.
    """
    names = entities.select(ids.entity_node_id(F.col("type"), F.col("name")).alias("node"), F.explode(F.array_union(F.array("name"), "aliases")).alias("mention")).filter("mention <> ''")
    longest = questions.agg(F.max(F.char_length("question"))).first()[0] or 0
    n = F.char_length("mention")
    lengths = [r[0] for r in names.select(n.alias("n")).filter(F.col("n") <= longest).distinct().collect()]
    sized = questions.select("qid", "question", F.explode(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>")).alias("n")).filter(F.col("n") <= F.char_length("question"))
    placed = sized.withColumn("at", F.explode(F.sequence(F.lit(1), F.char_length("question") - F.col("n") + 1)))
    keys = placed.select("qid", F.substring(F.col("question"), F.col("at"), F.col("n")).alias("mention")).distinct()
    found = names.join(counted(keys), "mention")
    longest = found.groupBy("qid", "node").agg(F.max_by("mention", F.struct(F.char_length("mention"), F.col("mention"))).alias("mention"))
    all_of = longest.groupBy("qid").agg(F.collect_set("mention").alias("all_mentions"))
    both = longest.join(all_of, "qid")
    inner = F.exists("all_mentions", lambda o: (o != F.col("mention")) & F.contains(o, F.col("mention")))
    return both.filter(~inner).select("qid", "node", "mention")


def khop(seeds: DataFrame, edges: DataFrame, hops: int) -> DataFrame:
    """``(qid, node, distance)`` of all nodes within ``hops`` undirected steps of a question's seeds: all searches at once.

    Questions are numbered, and a node has the set of those that have reached it as 64-bit words, a row for each word that isn't zero. A hop
    passes words over edges and combines them by bits; questions that meet at a node travel on together. Bits that were there before are not new. What
    the last hop reaches isn't written, as nothing but the result reads it.
    """
    seeds = written(seeds.select("qid", "node").distinct(), "seeds")
    both = written(edges.select("u", "v").union(edges.select("v", "u")).distinct(), "steps")
    asked = _numbered(seeds, both)
    word, bit = F.expr("number div 64").alias("word"), F.expr("cast(number % 64 as int)").alias("bit")
    words = seeds.join(counted(asked), "qid").groupBy("node", word).agg(F.bit_or(F.expr("shiftleft(1L, cast(number % 64 as int))")).alias("bits"))
    visited = frontier = written(words.withColumn("distance", F.lit(0)), "khop")
    for step in range(1, hops + 1):
        fresh = _fresh(frontier, visited, both).withColumn("distance", F.lit(step))
        frontier = written(fresh, "khop") if step < hops else fresh
        visited = visited.union(frontier)
    members = asked.groupBy(word).agg(F.collect_list(F.struct(bit, "qid")).alias("members"))
    told = visited.join(counted(members), "word").select("node", "distance", "bits", F.inline("members"))
    return told.filter("shiftrightunsigned(bits, bit) & 1L = 1L").select("qid", "node", "distance")


#: Words that pass an edge for each edge of the graph, from which on they are combined where the edges lie.
WORDS_AN_EDGE = 2
#: Words that a task passes over its edges.
WORDS_A_TASK = 1 << 20


def _fresh(frontier: DataFrame, visited: DataFrame, both: DataFrame) -> DataFrame:
    """``(node, word, bits)``: the questions that reach a node by one step from the frontier, and have not been there.

    Where hubs send many words over each edge, the edges are dealt by the node they lead to and meet the frontier there, so edges are shuffled and
    not what passes them. Nodes that the same hubs reach follow each other, as they have the same questions, which a file then holds in less room.
    """
    sent = both.groupBy("u").agg(F.count("*").alias("n")).join(frontier.select(F.col("node").alias("u")), "u")
    passed = sent.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    few = counted(frontier.select(F.col("node").alias("u"), F.col("word").alias("w"), "bits"))
    if passed <= WORDS_AN_EDGE * both.count():
        grown = both.join(few, "u").groupBy(F.col("v").alias("node"), F.col("w").alias("word")).agg(F.bit_or("bits").alias("bits"))
        seen = visited.groupBy("node", "word").agg(F.bit_or("bits").alias("seen"))
        return grown.join(seen, ["node", "word"], "left").select("node", "word", F.expr("bits & ~coalesce(seen, 0L)").alias("bits")).filter("bits <> 0")
    none = F.lit(None)
    steps = both.join(counted(few.select("u").distinct()), "u", "left_semi").select(F.col("v").alias("node"), "u", none.cast("long").alias("word"), none.cast("long").alias("seen"))
    dealt = steps.union(visited.select("node", none.cast("string"), "word", "bits")).repartition(max(both.sparkSession.sparkContext.defaultParallelism, -(-passed // WORDS_A_TASK)), "node")
    met = dealt.withColumn("kin", F.bit_xor(F.xxhash64("u")).over(Window.partitionBy("node"))).join(few, "u", "left").filter("bits is not null or seen is not null")
    grown = met.groupBy("node", F.coalesce("w", "word").alias("word")).agg(F.bit_or("bits").alias("bits"), F.bit_or("seen").alias("seen"), F.max("kin").alias("kin"))
    grown = grown.select("node", "word", F.expr("bits & ~coalesce(seen, 0L)").alias("bits"), "kin").filter("bits <> 0")
    return grown.sortWithinPartitions("kin", "node", "word").drop("kin")


def _numbered(seeds: DataFrame, both: DataFrame) -> DataFrame:
    """``(qid, number)`` in the order of the nodes next to a question's seeds: questions that travel on together share words, and a node has few words that aren't full."""
    near = seeds.join(both, F.col("node") == F.col("u"), "left").groupBy("qid").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.bit_xor(F.xxhash64("v")).alias("all"))
    return written(near.orderBy("low", "high", "all", "qid").select("qid", F.monotonically_increasing_id().alias("number")), "asked")


def predicate_bonus(question: Column, predicate: Column, cues: dict = CUES) -> Column:
    """0.2 if the question has a cue of the predicate."""
    hit = F.lit(False)
    for name, words in cues.items():
        for w in words:
            hit = hit | ((predicate == name) & F.contains(question, F.lit(w)))
    return F.when(hit, 0.2).otherwise(0.0)


def cue_rank(question: Column, predicate: Column, cues: dict = CUES) -> Column:
    """Where the question first asks for the predicate: (position, order) folded in one number; null if it doesn't."""
    out = F.lit(None).cast("long")
    for order, (name, words) in enumerate(cues.items()):
        at = F.array_min(F.array_compact(F.array(*(F.nullif(F.instr(question, F.lit(w)), F.lit(0)) for w in words))))
        out = F.when(predicate == name, at.cast("long") * 1000 + order).otherwise(out)
    return out


def graph_retrieve(questions: DataFrame, entities: DataFrame, facts: DataFrame, sources: DataFrame, k: int = 10, hops: int = 2, cues: dict = CUES) -> DataFrame:
    """Evidence ``(qid, fact_id, predicate, source_id, distance, score, rank, text, source_url, source_title, confidence)``: facts with an end within reach of a mentioned entity.

    Reach is one step beyond ``hops``. The score adds nearness, confidence, overlap of the question with the relation's text and a bonus for
    an asked relation; the nearest of subject, object and source counts. For each asked relation its best fact
    comes first, in the order of the question; ties by fact id.

    Facts are scored by kinds (an end, a relation, a confidence), nearest first, and only those whose bound reaches the k-th score of the question so far,
    or the first of an asked relation; a question that nothing farther can change takes no further step. Facts of a kind whose texts have the same
    characters of questions score alike and are scored as one, of which the first k by id count. So hubs cost their number of such groups.
    """
    entities = written(entities.select("name", "type", "aliases"), "entities")
    asked = counted(questions.select("qid", "question", characters(F.col("question")).alias("own")))
    letters = sorted(r[0] for r in asked.select(F.explode("own")).distinct().collect())
    told = _told(facts, sources, letters)
    both = reduce(DataFrame.union, (told.select(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in ("uv", "vu", "uw", "wu"))).filter("u is not null and v is not null")
    alike = _alike(told, k)
    kinds = written(alike.groupBy("node", "predicate", "sure").agg(F.sum("n").alias("n")), "kinds")
    asks = _asks(asked, alike, letters, cues)
    order = [F.desc("score"), F.asc("fact_id")]
    best = frontier = visited = None
    for distance in range(hops + 2):
        if frontier is None:
            frontier = visited = counted(mentions(questions, entities).select("qid", "node").distinct())
        else:
            open_ = asks.join(floors, ["qid", "predicate"]).filter(_bound(distance, F.lit(1.0)) >= F.col("least")).select("qid").distinct()
            step = counted(frontier.join(counted(open_), "qid")).join(both, F.col("node") == F.col("u")).select("qid", F.col("v").alias("node")).distinct()
            frontier = counted(step.join(visited, ["qid", "node"], "left_anti"))
            visited = visited.union(frontier)
        near = frontier.join(kinds, "node").join(asks.select("qid", "predicate", "bonus", "cued", "share"), ["qid", "predicate"])
        near = written(near.select("qid", "node", "predicate", "sure", "n", "cued", _bound(distance, F.col("sure")).alias("most")), "near")
        # First the kinds that may score best and have rows enough, of a question and of each relation it asks for; then all whose bound reaches what was found.
        sooner = lambda *by: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(F.desc("most"), "node", "predicate", "sure").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        turns = near.withColumns({"any": sooner("qid"), "own": sooner("qid", "predicate")})
        first = counted(turns.filter((F.col("any") < ENDS * k) | (F.col("cued") & (F.col("own") < ENDS * k))).select("qid", "node", "predicate", "sure"))
        best = _kept(best, first, alike, asks, distance, k, order)
        floors = _floors(best, asks, k)
        rest = near.join(first, ["qid", "node", "predicate", "sure"], "left_anti")
        rest = rest.join(floors, ["qid", "predicate"]).filter(F.col("most") >= F.col("least"))
        best = _kept(best, rest, alike, asks, distance, k, order)
        floors = _floors(best, asks, k)
    titles = sources.select(F.col("source_id").alias("evidence_source_id"), F.col("title").alias("source_title"))
    rows = facts.select("fact_id", "evidence_source_id", F.col("evidence_url").alias("source_url"), "confidence", _text().alias("text"))
    met = counted(best).join(rows, "fact_id").join(counted(questions.select("qid", "question")), "qid").join(titles, "evidence_source_id", "left")
    scored = met.withColumns({"cue": cue_rank(F.col("question"), F.col("predicate"), cues), "source_title": F.coalesce("source_title", "evidence_source_id")})
    return select_graph(scored, k)


#: Nodes that touch a fact: subject, object and source.
ENDS = 3
#: What a bound may be off by rounding.
SLACK = 2e-6


def _bound(distance: int, sure: Column) -> Column:
    """No fact of a relation at this distance scores above it, whatever its text."""
    return F.least(F.lit(1.0), F.lit(0.5 / (1 + distance)) + 0.3 * sure + 0.2 * F.col("share") + F.col("bonus"))


def _text() -> Column:
    """A fact as a text."""
    return F.concat("subject", F.lit(" — "), "predicate", F.lit(" — "), "object")


def _marks(chars: str, letters: list[str]) -> Column:
    """The letters among the characters of an array column, a bit for each, 64 to a word. Letters are word characters, so they stand in SQL as they are."""
    parts = ["".join(letters[i : i + 64]) for i in range(0, len(letters), 64)]
    word = "aggregate(array_intersect({0}, split('{1}', '')), 0L, (bits, c) -> bits | shiftleft(1L, greatest(instr('{1}', c) - 1, 0)))"
    return F.array(*(F.expr(word.format(chars, part)) for part in parts)).cast("array<bigint>")


def _shared(a: str, b: str) -> Column:
    """How many letters two columns of ``_marks`` share."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda n, x: n + x)


def _told(facts: DataFrame, sources: DataFrame, letters: list[str]) -> DataFrame:
    """``(fact_id, predicate, marks, u, v, w, sure)``: each fact once, with the letters of its text, the nodes of subject and object and that of its source if it is registered."""
    sure = F.coalesce(*(F.when(F.col("confidence") == c, F.lit(x)) for c, x in CONFIDENCE.items()), F.lit(0.5))
    node = lambda kind, name: ids.entity_node_id(F.col(kind), F.col(name))
    ends = {"u": node("subject_type", "subject_name"), "v": node("object_type", "object_name"), "w": F.concat(F.lit("source:"), "source")}
    known = sources.select(F.col("source_id").alias("evidence_source_id"), F.col("source_id").alias("source")).distinct()
    met = facts.join(known, "evidence_source_id", "left").withColumn("chars", F.array_distinct(F.split(_text(), "")))
    rows = met.select("fact_id", "predicate", _marks("chars", letters).alias("marks"), *(c.alias(name) for name, c in ends.items()), sure.alias("sure"))
    return written(rows.groupBy("fact_id", "predicate", "marks", *ends).agg(F.max("sure").alias("sure")), "told")


def _alike(told: DataFrame, k: int) -> DataFrame:
    """``(node, predicate, sure, marks, ids, n)``: facts that touch a node and that no question can tell apart but by id; the first k ids."""
    touched = told.select(F.explode(F.array_distinct(F.array_compact(F.array("u", "v", "w")))).alias("node"), "predicate", "sure", "marks", "fact_id")
    by = ["node", "predicate", "sure", "marks"]
    first = ranked(touched, k, by, F.asc("fact_id")).groupBy(*by).agg(F.collect_set("fact_id").alias("ids"))
    return written(first.withColumn("n", F.size("ids")), "alike")


def _asks(asked: DataFrame, alike: DataFrame, letters: list[str], cues: dict) -> DataFrame:
    """``(qid, predicate, own, size, bonus, cued, share)``: each question with each relation, its letters, and the greatest share of them that a text of the relation may have."""
    words = range(-(-len(letters) // 64))
    bits = alike.groupBy("predicate", "marks").agg(F.lit(1).alias("one")).select("predicate", "marks", F.aggregate("marks", F.lit(0), lambda n, x: n + F.bit_count(x)).alias("size"))
    every = bits.groupBy("predicate").agg(F.max("size").alias("most"), F.array(*(F.bit_or(F.col("marks")[i]) for i in words)).cast("array<bigint>").alias("marks"))
    met = asked.select("qid", "question", _marks("own", letters).alias("bits"), F.size("own").alias("size")).crossJoin(F.broadcast(every))
    share = F.least(F.col("most"), _shared("bits", "marks")) / F.greatest(F.col("size"), F.lit(1))
    question, predicate = F.col("question"), F.col("predicate")
    return counted(met.select("qid", "predicate", F.col("bits").alias("own"), "size", predicate_bonus(question, predicate, cues).alias("bonus"), cue_rank(question, predicate, cues).isNotNull().alias("cued"), share.alias("share")))


def _kept(best: DataFrame | None, chosen: DataFrame, alike: DataFrame, asks: DataFrame, distance: int, k: int, order: list[Column]) -> DataFrame:
    """``best`` with the facts of the chosen kinds (qid, node, predicate, sure), scored: of each question and relation the first k.

    How many facts have how many letters of a question tells the scores and which of them can be among the first; only the ids of those are looked at.
    """
    met = alike.join(counted(chosen.select("qid", "node", "predicate", "sure")), ["node", "predicate", "sure"]).join(asks.select("qid", "predicate", "own", "size", "bonus"), ["qid", "predicate"])
    like = ["qid", "predicate", "sure", "shared"]
    counts = met.groupBy("qid", "predicate", "sure", _shared("own", "marks").alias("shared"), "size", "bonus").agg(F.sum("n").alias("n"))
    share = F.col("shared") / F.greatest(F.col("size"), F.lit(1))
    score = F.round(F.least(F.lit(1.0), F.lit(0.5 / (1 + distance)) + 0.3 * F.col("sure") + 0.2 * share + F.col("bonus")), DIGITS)
    counts = written(counts.select(*like, score.alias("score"), "n"), "scores")
    turn = Window.partitionBy("qid", "predicate").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    sooner = counts.groupBy("qid", "predicate", "score").agg(F.sum("n").alias("n")).withColumn("sooner", F.coalesce(F.sum("n").over(turn), F.lit(0)))
    open_ = counted(counts.join(sooner.filter(F.col("sooner") < ENDS * k).select("qid", "predicate", "score"), ["qid", "predicate", "score"]).select(*like, "score"))
    scored = met.select("qid", "predicate", "sure", _shared("own", "marks").alias("shared"), "ids").join(open_, like)
    scored = scored.select("qid", "predicate", F.explode("ids").alias("fact_id"), "score", F.lit(distance).alias("distance"))
    top = ranked(scored, ENDS * k, ["qid", "predicate"], *order).drop("rank")
    every = (top if best is None else top.unionByName(best)).groupBy("qid", "predicate", "fact_id").agg(F.max("score").alias("score"), F.min("distance").alias("distance"))
    return written(ranked(every, k, ["qid", "predicate"], *order).drop("rank"), "best")


def _floors(best: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """``(qid, predicate, least)``: what a fact of a relation has to score: as the k-th of the question, or as the first of a relation that is asked for."""
    kth = best.groupBy("qid").agg(F.get(F.sort_array(F.collect_list("score"), False), F.lit(k - 1)).alias("kth"))
    first = best.groupBy("qid", "predicate").agg(F.max("score").alias("first"))
    met = asks.select("qid", "predicate", "cued").join(kth, "qid", "left").join(first, ["qid", "predicate"], "left")
    low = lambda c: F.coalesce(c, F.lit(float("-inf")))
    least = F.when(F.col("cued"), F.least(low("kth"), low("first"))).otherwise(low("kth"))
    return counted(met.select("qid", "predicate", (least - SLACK).alias("least")))


def select_graph(scored: DataFrame, k: int) -> DataFrame:
    """The k rows of each question: one reserved for each asked relation, then by score."""
    first = ranked(scored.filter("cue is not null"), 1, ["qid", "predicate"], F.desc("score"), F.asc("fact_id")).select("qid", "fact_id", F.lit(True).alias("reserved"))
    best = ranked(scored, k, ["qid"], F.desc("score"), F.asc("fact_id")).drop("rank")
    held = scored.join(first, ["qid", "fact_id"]).drop("reserved")
    pool = best.join(held.select("qid", "fact_id"), ["qid", "fact_id"], "left_anti").withColumn("turn", F.lit(1 << 40)).unionByName(held.withColumn("turn", F.col("cue")))
    out = ranked(pool, k, ["qid"], F.asc("turn"), F.desc("score"), F.asc("fact_id"))
    return out.select("qid", "fact_id", "predicate", F.col("evidence_source_id").alias("source_id"), "distance", "score", "rank", "text", "source_url", "source_title", "confidence")


def save_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes and edges as two Parquet tables below a folder."""
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def load_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges")


def node_link_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(value)``: the graph as JSON lines, a node or a link each, for tools that read node-link data."""
    node = nodes.select(F.to_json(F.struct(F.lit("node").alias("record"), F.col("node").alias("id"), "kind", "name")).alias("value"))
    link = edges.select(F.to_json(F.struct(F.lit("link").alias("record"), F.col("u").alias("source"), F.col("v").alias("target"), F.col("fact_id").alias("key"), "predicate", "fact_id")).alias("value"))
    return node.union(link)
