"""Identity functions: stable ids from SHA-256 prefixes, bit-exact in SQL and DataFrames."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NUL = "\0"


def digest(*parts: Column, length: int, sep: str = NUL) -> Column:
    """The first ``length`` hex digits of the SHA-256 of the parts, joined by NUL (or ``sep``)."""
    return F.substring(F.sha2(F.concat_ws(sep, *(p.cast("string") for p in parts)), 256), 1, length)


def _prefixed(prefix: str, *parts: Column, length: int = 12, sep: str = NUL) -> Column:
    return F.concat(F.lit(prefix), digest(*parts, length=length, sep=sep))


def entity_id(kind: Column, name: Column) -> Column:
    return _prefixed("ent_", kind, name)


def entity_node_id(kind: Column, name: Column) -> Column:
    return _prefixed("entity:", kind, name, length=16)


def fact_id(subject: Column, predicate: Column, obj: Column, source: Column) -> Column:
    return _prefixed("fact_", subject, predicate, obj, source)


def chunk_id(doc: Column, start: Column, end: Column, text: Column) -> Column:
    return _prefixed("chk_", doc, start, end, text)


def document_id(source: Column, text: Column) -> Column:
    return _prefixed("doc_", source, text)


def synthetic_document_id(subject: Column, source: Column) -> Column:
    return _prefixed("doc_synthetic_", subject, source, sep="")


def question_id(question: Column) -> Column:
    return _prefixed("q_", question)


def source_id(url: Column) -> Column:
    return _prefixed("src_", url)


def candidate_id(url: Column) -> Column:
    return _prefixed("candidate_", url)


def template_variant(key: Column, n: Column | int) -> Column:
    """The SHA-256 of the key, read as one big number, modulo ``n``: folded digit by digit."""
    size = F.lit(n) if isinstance(n, int) else n
    hexes = F.sha2(key, 256)
    digits = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.instr(F.lit("0123456789abcdef"), F.substring(hexes, i, F.lit(1))) - 1)
    return F.aggregate(digits, F.lit(0), lambda acc, d: F.pmod(acc * 16 + d, size).cast("int"))


def _sorted_dump(compact: bool):
    separators = (",", ":") if compact else (", ", ": ")
    return lambda text: json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True, separators=separators)


def sorted_json(value: Column) -> Column:
    """The compact key-sorted dump of a JSON object string."""
    dump = _sorted_dump(compact=True)

    @F.pandas_udf("string")
    def dumped(rows: pd.Series) -> pd.Series:
        return rows.map(lambda text: None if text is None else dump(text))

    return dumped(value)


def json_sha256(compact: bool):
    """A pandas UDF from a JSON object string to the SHA-256 of its key-sorted dump; ``compact`` has no spaces."""
    dump = _sorted_dump(compact)

    @F.pandas_udf("string")
    def hashed(rows: pd.Series) -> pd.Series:
        return rows.map(lambda text: None if text is None else hashlib.sha256(dump(text).encode()).hexdigest())

    return hashed


#: The fields of a question that its review hash covers.
QA_HASHED = ("question_id", "question", "answer", "answer_type", "evidence_fact_ids", "evidence_source_ids", "required_entities", "difficulty", "unanswerable")


def qa_sha256() -> Column:
    return json_sha256(compact=False)(F.to_json(F.struct(*QA_HASHED), {"ignoreNullFields": "false"}))


def files_fingerprint(paths: list[str]) -> str:
    """SHA-256 over sorted paths: each path, then its bytes where the file exists."""
    total = hashlib.sha256()
    for path in sorted(map(str, paths)):
        total.update(path.encode())
        if Path(path).exists():
            total.update(Path(path).read_bytes())
    return total.hexdigest()
