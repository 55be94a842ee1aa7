"""Queries over Han text: the words of ``documents`` and ``benchmark`` with a Han character for each Latin letter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import segment
from evidentia.operators import retrieval as R
from evidentia.plans.views import table

LETTERS, HAN = "abcdefghijklmnopqrstuvwxyz", "山水日月金木火土天地人王大小上下左右中东西南北春秋冬"


def _han(text: Column) -> Column:
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), LETTERS, HAN)


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select("doc_id", _han(F.col("text")).alias("text"))
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), _han(F.col("text")).alias("question"))
    return docs, asked


def _segmenter(docs: DataFrame, asked: DataFrame):
    """Words of the documents; the first word of each question is a name."""
    return segment.segmenter(segment.learn_dictionary(docs, asked.select(F.regexp_extract("question", "([一-鿿]+)", 1).alias("name"))))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, asked = _tables(spark, sf_dir)
    tokens = _segmenter(docs, asked)(F.col("text"))
    return docs.select("doc_id", F.size(tokens).alias("n_tokens"), F.sha2(F.array_join(tokens, " "), 256).alias("sha"))


def sparse_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, asked = _tables(spark, sf_dir)
    return R.bm25(docs, asked, 5, id_col="doc_id", tokens=_segmenter(docs, asked)).select("qid", F.col("doc").alias("doc_id"), "score", "rank")


QUERIES = {"r1_segments": segments, "tk2_han_topk": sparse_topk}

_WORDS = rf"""
han_docs AS (SELECT doc_id, translate(lower(coalesce(text, '')), '{LETTERS}', '{HAN}') AS text FROM documents),
han_asked AS (SELECT item_id AS qid, translate(lower(coalesce(text, '')), '{LETTERS}', '{HAN}') AS text FROM benchmark),
runs AS (SELECT run, count(*) AS times FROM (SELECT unnest(regexp_extract_all(text, '[一-鿿]+')) AS run FROM han_docs) GROUP BY run),
counted AS (SELECT substr(run, i, k) AS word, sum(times)::BIGINT AS freq FROM (SELECT run, times, k, unnest(range(1, length(run) - k + 2)) AS i FROM runs, range(1, 5) t(k)) GROUP BY 1 HAVING sum(times) >= 5),
total AS (SELECT sum(freq) AS n FROM counted WHERE length(word) = 1),
cuts AS (SELECT word, freq, unnest(range(1, length(word))) AS k FROM counted),
learned AS (SELECT c.word, any_value(c.freq) AS freq FROM cuts c JOIN counted a ON a.word = substr(c.word, 1, k) JOIN counted b ON b.word = substr(c.word, k + 1), total GROUP BY c.word HAVING bool_and(c.freq::HUGEINT * n >= a.freq::HUGEINT * b.freq * 4)),
names AS (SELECT DISTINCT regexp_extract(text, '[一-鿿]+') AS word FROM han_asked),
dictionary AS (SELECT word, max(freq) AS freq FROM (SELECT * FROM learned UNION ALL SELECT * FROM counted WHERE length(word) = 1
  UNION ALL SELECT word, coalesce(freq, 5) FROM names LEFT JOIN counted USING (word) WHERE length(word) > 1) GROUP BY word),
priced AS (SELECT word, round(ln(n / freq) * 1000000)::BIGINT AS cost FROM dictionary, (SELECT sum(freq) AS n FROM dictionary)),
single AS (SELECT round(ln(sum(freq)) * 1000000)::BIGINT AS cost FROM dictionary),
every AS (SELECT run FROM runs UNION SELECT unnest(regexp_extract_all(text, '[一-鿿]+')) FROM han_asked),
spots AS (SELECT run, unnest(range(1, length(run) + 1)) AS pos FROM every),
longest AS (SELECT max(length(word)) AS m FROM dictionary),
pieces AS (SELECT run, pos, unnest(range(1, least(m, length(run) - pos + 1) + 1)) AS n FROM spots, longest),
choices AS (SELECT run, pos, list((n, c)) AS cs FROM (SELECT run, pos, n, coalesce(p.cost, CASE WHEN n = 1 THEN s.cost END) AS c FROM pieces LEFT JOIN priced p ON p.word = substr(run, pos, n), single s) WHERE c IS NOT NULL GROUP BY run, pos),
paths AS (SELECT run, length(run) AS pos, [0::BIGINT] AS best, []::BIGINT[] AS takes FROM every
  UNION ALL SELECT run, pos - 1, list_prepend(pick[1], best), list_prepend(-pick[2], takes)
  FROM (SELECT s.run, s.pos, s.best, s.takes, list_sort(list_transform(cs, lambda x: [x[2] + s.best[x[1]], -x[1]]))[1] AS pick FROM paths s JOIN choices c ON c.run = s.run AND c.pos = s.pos)),
walk AS (SELECT run, takes, 1::BIGINT AS pos FROM paths WHERE pos = 0 UNION ALL SELECT run, takes, pos + takes[pos] FROM walk WHERE pos <= length(run)),
words AS (SELECT run, pos, takes[pos] AS n FROM walk WHERE pos <= length(run)),
cut AS (SELECT run, pos, 9 AS kind, 0 AS i, substr(run, pos, n) AS word FROM words
  UNION ALL SELECT run, pos, g, i, word FROM (SELECT run, pos, g, i, substr(run, pos + i, g) AS word FROM (SELECT run, pos, n, g, unnest(range(0, n - g + 1)) AS i FROM words, (VALUES (2), (3)) t(g) WHERE n > g)) SEMI JOIN priced USING (word)),
run_tokens AS (SELECT run, list(word ORDER BY pos, kind, i) AS tokens FROM cut GROUP BY run)"""


def _tokens(name: str, source: str, key: str) -> str:
    """A CTE with the token list of each row of ``source``."""
    return rf"""{name}_spans AS (SELECT {key}, unnest(spans) AS span, generate_subscripts(spans, 1) AS i FROM (SELECT {key}, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+') AS spans FROM {source})),
{name}_parts AS (SELECT {key}, i, unnest(parts) AS part, generate_subscripts(parts, 1) AS j FROM (SELECT {key}, i, regexp_extract_all(span, '[一-鿿]+|[^一-鿿]+') AS parts FROM {name}_spans)),
{name} AS (SELECT {key}, flatten(list(coalesce(tokens, [part]) ORDER BY i, j)) AS words FROM {name}_parts LEFT JOIN run_tokens ON run = part GROUP BY {key})"""


ORACLE_SQL = {
    "r1_segments": f"""WITH RECURSIVE {_WORDS}, {_tokens("doc_words", "han_docs", "doc_id")}
SELECT doc_id, coalesce(len(words), 0)::INT AS n_tokens, sha256(coalesce(array_to_string(words, ' '), '')) AS sha FROM documents LEFT JOIN doc_words USING (doc_id)""",
    "tk2_han_topk": f"""WITH RECURSIVE {_WORDS}, {_tokens("doc_words", "han_docs", "doc_id")}, {_tokens("asked_words", "han_asked", "qid")},
posts AS (SELECT doc_id, term, count(*) AS tf, any_value(len) AS len FROM (SELECT doc_id, len(words) AS len, unnest(words) AS term FROM doc_words) GROUP BY doc_id, term),
stats AS (SELECT (SELECT count(*) FROM documents) AS n, sum(len(words)) / (SELECT count(*) FROM documents) AS mean FROM doc_words),
terms AS (SELECT term, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM posts, stats GROUP BY term),
asked AS (SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest(words) AS term FROM asked_words) GROUP BY qid, term),
bm25 AS (SELECT qid, doc_id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / greatest(mean, 1e-9)))), 6) AS score FROM asked JOIN posts USING (term) JOIN terms USING (term), stats GROUP BY qid, doc_id)
SELECT * FROM (SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM bm25 WHERE score > 0) WHERE rank <= 5""",
}
