"""Landed payload files.

A payload is what one request returned: one JSON document, below folders
that carry the request's parameters, for example
``<landing>/term_report/brand_id=b1/run=2026-05-19/part.json``. The folder names
become columns (text), the document becomes the column ``data``. Files named ``.json`` hold one document; files
of lines (``.jsonl``, ``.ndjson`` or ``.txt``) hold one in each line, can be split and so read by many tasks. Other files are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "_corrupt_record"
#: Names of files that hold one document, and of files with a document in every line.
WHOLE = "*.{json,json.gz}"
LINES = "*.{jsonl,jsonl.gz,ndjson,ndjson.gz,txt,txt.gz}"


def file_name() -> Column:
    """The file a row was read from, as Spark names it."""
    return F.col("_metadata.file_path")


def payload_schema(schema: StructType, parameters: Sequence[str] = ()) -> StructType:
    """The document's schema with the corrupt-record column and the request parameters."""
    full = StructType(list(schema.fields)).add(CORRUPT, StringType())
    for name in parameters:
        full = full.add(name, StringType())
    return full


def read_payloads(
    spark: SparkSession, path: str, schema: StructType, parameters: Sequence[str] = ("brand_id",), named: bool = False
) -> DataFrame:
    """Payload files below ``path``: the request parameters, ``data`` and ``_corrupt_record``.

    ``named`` adds the ``file`` of each document.
    """
    def documents(names: str, whole: bool) -> DataFrame:
        return (
            spark.read.schema(payload_schema(schema, parameters))
            .option("multiLine", whole).option("mode", "PERMISSIVE").option("pathGlobFilter", names)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path)
        )

    found = [documents(WHOLE, True), documents(LINES, False)]
    if named:
        found = [part.withColumn("file", file_name()) for part in found]
    return found[0].unionByName(found[1])


def parse_payloads(df: DataFrame, schema: StructType, text: str = "payload") -> DataFrame:
    """The same from payloads held as JSON text in a column (other columns stay)."""
    parsed = F.from_json(
        F.col(text), payload_schema(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    others = [c for c in df.columns if c != text]
    # As a generator the parse runs once per document; as a plain column Spark would repeat
    # it in every later filter that is pushed below this projection.
    return df.select(*others, F.inline(F.array(parsed)))


def all_have(entries: Column, *fields: str) -> Column:
    """Whether every entry of a list has a value in each field; NULL for a missing list."""
    return F.forall(entries, lambda e: reduce(and_, [e[f].isNotNull() for f in fields]))


def complete(endpoint: str) -> Column:
    """Whether a payload has the lists and ids its flatteners rely on.

    The lists of brands, search terms and topics must be there; a report may lack its list.
    """
    if endpoint == "brands":
        return F.coalesce(all_have(F.col("data.brands"), "id", "name"), F.lit(False))
    if endpoint == "search_terms":
        return F.coalesce(all_have(F.col("data.searchTerms"), "id"), F.lit(False))
    if endpoint == "topics":
        return F.coalesce(all_have(F.col("data.topics"), "id", "name"), F.lit(False))
    if endpoint == "term_report":
        terms = F.col("data.searchTerms")
        texts = F.forall(terms, lambda t: F.coalesce(all_have(t["answerTexts"], "executionId"), F.lit(True)))
        return F.coalesce(all_have(terms, "searchTermId") & texts, F.lit(True))
    return F.lit(True)


def split_corrupt(payloads: DataFrame, endpoint: str = "") -> tuple[DataFrame, DataFrame]:
    """Payloads that can be flattened, and those to quarantine.

    Quarantined are unreadable documents, documents without ``data`` and, when the
    ``endpoint`` is named, incomplete ones; ``_corrupt_record`` then holds their content.
    """
    good = F.col(CORRUPT).isNull() & F.col("data").isNotNull() & complete(endpoint)
    bad = payloads.where(~good).withColumn(CORRUPT, F.coalesce(CORRUPT, F.to_json("data"), F.lit("")))
    return payloads.where(good).drop(CORRUPT), bad
