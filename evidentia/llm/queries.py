"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm.classifier import score_quality
from evidentia.llm.collocations import collocations
from evidentia.llm.common import discard, shared_dir, table
from evidentia.llm.decontam import find_leaks
from evidentia.llm.funnels import Funnel, count_funnels
from evidentia.llm.htmltext import extract
from evidentia.llm.language import identify
from evidentia.llm.lattice import score_texts
from evidentia.llm.linededup import dedup_lines
from evidentia.llm.packing import pack
from evidentia.llm.quality import judge
from evidentia.llm.sharding import next_version, records, shard
from evidentia.llm.simhash import simhash_components
from evidentia.llm.tokens import count_tokens


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_adaptive_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), with_text=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op4_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op5_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "score", "question_overlap", "answer_overlap")


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map's first version is made for the documents without their last tenth by hash, its second, which places all, edits that."""
    versions = f"{shared_dir(spark)}/evidentia/{spark.sparkContext.applicationId}/slot-map-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    early = records(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(10)) != 9))
    next_version(early, 8, map_path=versions)
    discard(early)
    placed = shard(docs, shards=8, map_path=versions)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("part").alias("virtual_slot"))


def op7_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return score_texts(table(spark, sf_dir, "documents"), held_out, tokenizer_file("piece_bpe_32k.model"))


def op8_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")


def op9_fourier_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op11_bitmap_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


#: The funnels that are counted: steps, and what ends an attempt.
FUNNELS = {
    "A": Funnel(("view", "click", "view", "purchase"), "error"),
    "B": Funnel(("signup", "view", "click", "purchase"), "error"),
    "C": Funnel(("click", "click", "purchase", "view"), "signup"),
}


def op12_ordinal_funnels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_funnels(table(spark, sf_dir, "clicks"), FUNNELS)


def op13_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 4 == 2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_adaptive_thresholds": op1_adaptive_thresholds,
    "op2_simhash_pigeonring": op2_simhash_pigeonring,
    "op3_token_counts": op3_token_counts,
    "op4_min_bin_slack": op4_min_bin_slack,
    "op5_block_max_wand": op5_block_max_wand,
    "op6_virtual_slots": op6_virtual_slots,
    "op7_subword_lattice": op7_subword_lattice,
    "op8_line_windows": op8_line_windows,
    "op9_fourier_ridge": op9_fourier_ridge,
    "op10_page_differencing": op10_page_differencing,
    "op11_bitmap_collocations": op11_bitmap_collocations,
    "op12_ordinal_funnels": op12_ordinal_funnels,
    "op13_byte_language": op13_byte_language,
}

#: The operators that SQL can express; the others are compared with brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op8_line_windows": r"""
WITH cut AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '(\n|[.!?] )', '\1' || chr(1), 'g'), chr(1)) AS units FROM documents),
lines AS (SELECT doc_id, unnest(units) AS unit, generate_subscripts(units, 1) - 1 AS line FROM cut),
worded AS (SELECT doc_id, line, trim(unit, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS k, count(*) OVER (PARTITION BY doc_id) AS n
  FROM lines WHERE regexp_matches(unit, '[^\x20\x09-\x0D]')),
windows AS (SELECT doc_id, k, n, bare AS b0, lead(bare, 1) OVER w AS b1, lead(bare, 2) OVER w AS b2 FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
placed AS (SELECT *, row_number() OVER (PARTITION BY b0, b1, b2 ORDER BY doc_id, k) AS r FROM windows WHERE k <= greatest(n - 2, 1)),
covered AS (SELECT DISTINCT doc_id, line, k FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS k FROM placed WHERE r > 1) JOIN worded USING (doc_id, k)),
runs AS (SELECT doc_id, line, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS run FROM covered),
spans AS (SELECT doc_id, min(line) AS a, max(line) AS z FROM runs GROUP BY doc_id, run),
gone AS (SELECT l.doc_id, l.line FROM lines l JOIN spans s ON s.doc_id = l.doc_id AND l.line BETWEEN s.a AND s.z),
left_ AS (SELECT doc_id, string_agg(unit, '' ORDER BY line) AS text FROM lines ANTI JOIN gone USING (doc_id, line) GROUP BY doc_id),
n_gone AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN g.n > 0 THEN coalesce(l.text, '') ELSE d.text END AS text, coalesce(g.n, 0) AS n_removed
FROM documents d LEFT JOIN n_gone g USING (doc_id) LEFT JOIN left_ l USING (doc_id)""",
    "op11_bitmap_collocations": r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9), 'abcdefghijklmnopqrstuvwxyz '), '[.,;:!?
-
]')) AS piece FROM documents),
listed AS (SELECT lang, row_number() OVER () AS p, string_split(piece, ' ') AS ws FROM pieces),
words AS (SELECT lang, p, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM listed),
runs AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM words WHERE w1 <> '' WINDOW o AS (PARTITION BY p ORDER BY i)),
f1 AS (SELECT lang, w1, count(*) AS a FROM runs GROUP BY ALL), f2 AS (SELECT lang, w1, w2, count(*) AS a FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS a FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM f1 GROUP BY lang),
score2 AS (SELECT f.lang, f.w1 || ' ' || f.w2 AS phrase, f.a, x.a AS l, y.a AS r, 1000000::HUGEINT * f.a * f.a // (x.a::HUGEINT * y.a) AS score FROM f2 f JOIN f1 x ON x.lang = f.lang AND x.w1 = f.w1 JOIN f1 y ON y.lang = f.lang AND y.w1 = f.w2
  WHERE f.a >= 10 AND NOT EXISTS (SELECT 1 FROM f3 g WHERE g.lang = f.lang AND 100 * g.a >= 50 * f.a AND (g.w1 = f.w1 AND g.w2 = f.w2 OR g.w2 = f.w1 AND g.w3 = f.w2))),
cut3 AS (SELECT f.lang, f.w1 || ' ' || f.w2 || ' ' || f.w3 AS phrase, f.a, a.a AS l1, b.a AS r1, c.a AS l2, d.a AS r2, 1000000::HUGEINT * f.a * f.a // (a.a::HUGEINT * b.a) AS s1, 1000000::HUGEINT * f.a * f.a // (c.a::HUGEINT * d.a) AS s2
  FROM f3 f JOIN f1 a ON a.lang = f.lang AND a.w1 = f.w1 JOIN f2 b ON b.lang = f.lang AND b.w1 = f.w2 AND b.w2 = f.w3 JOIN f2 c ON c.lang = f.lang AND c.w1 = f.w1 AND c.w2 = f.w2 JOIN f1 d ON d.lang = f.lang AND d.w1 = f.w3),
scored AS (SELECT * FROM score2 UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cut3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
    "op12_ordinal_funnels": r"""
WITH c AS (SELECT DISTINCT client_id, kind, ts FROM clicks WHERE client_id IS NOT NULL AND kind IS NOT NULL AND ts IS NOT NULL),
nexts AS (SELECT *, min(ts) FILTER (kind = 'view') OVER later AS view_, min(ts) FILTER (kind = 'click') OVER later AS click_, min(ts) FILTER (kind = 'purchase') OVER later AS purchase_,
    min(ts) FILTER (kind = 'error') OVER later AS error_, min(ts) FILTER (kind = 'signup') OVER later AS signup_
  FROM c WINDOW later AS (PARTITION BY client_id ORDER BY ts RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING)),
funnels(funnel, k1, k2, k3, k4, ends) AS (VALUES ('A', 'view', 'click', 'view', 'purchase', 'error'), ('B', 'signup', 'view', 'click', 'purchase', 'error'), ('C', 'click', 'click', 'purchase', 'view', 'signup')),
hops AS (SELECT DISTINCT client_id, ts, k AS kind, ends, CASE k WHEN 'view' THEN view_ WHEN 'click' THEN click_ WHEN 'purchase' THEN purchase_ END AS nx, CASE ends WHEN 'error' THEN error_ ELSE signup_ END AS stop
  FROM nexts, (VALUES ('view'), ('click'), ('purchase')) t(k), (VALUES ('error'), ('signup')) e(ends)),
good AS (SELECT * FROM hops WHERE nx IS NOT NULL AND nx - ts <= INTERVAL 60 MINUTE AND (stop IS NULL OR stop > nx)),
tries AS (SELECT f.funnel, c.client_id, c.ts AS s1, g2.nx AS s2, g3.nx AS s3, g4.nx AS s4 FROM c JOIN funnels f ON c.kind = f.k1
  LEFT JOIN good g2 ON g2.client_id = c.client_id AND g2.ts = c.ts AND g2.kind = f.k2 AND g2.ends = f.ends
  LEFT JOIN good g3 ON g3.client_id = c.client_id AND g3.ts = g2.nx AND g3.kind = f.k3 AND g3.ends = f.ends
  LEFT JOIN good g4 ON g4.client_id = c.client_id AND g4.ts = g3.nx AND g4.kind = f.k4 AND g4.ends = f.ends),
spent AS (SELECT funnel, client_id, epoch_us(s2) - epoch_us(s1) AS d2, epoch_us(s3) - epoch_us(s2) AS d3, epoch_us(s4) - epoch_us(s3) AS d4 FROM tries),
agg AS (SELECT funnel, client_id, count(*) AS n1, count(d2) AS n2, count(d3) AS n3, count(d4) AS n4, list_sort(list(d2) FILTER (d2 IS NOT NULL)) AS l2, list_sort(list(d3) FILTER (d3 IS NOT NULL)) AS l3, list_sort(list(d4) FILTER (d4 IS NOT NULL)) AS l4
  FROM spent GROUP BY funnel, client_id),
deep AS (SELECT *, CASE WHEN n4 > 0 THEN 4 WHEN n3 > 0 THEN 3 WHEN n2 > 0 THEN 2 ELSE 1 END AS deepest FROM agg)
SELECT funnel, client_id, n1, n2, n3, n4, deepest, l2[(90 * n2 + 99) // 100] AS t2, l3[(90 * n3 + 99) // 100] AS t3, l4[(90 * n4 + 99) // 100] AS t4,
  count(*) OVER (PARTITION BY funnel, deepest) AS same_depth FROM deep""",
}
