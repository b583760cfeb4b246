"""Joins of facts with dimensions, and name normalisation.

No join here is forced to broadcast: Spark broadcasts a dimension whose size is
below ``spark.sql.autoBroadcastJoinThreshold`` (also at run time, from shuffle
sizes) and otherwise shuffles both sides, splitting hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged

# Spelling found in answers -> canonical brand name.
BRAND_SPELLINGS = {
    "MONETA": "MONETA Money Bank",
    "Moneta": "MONETA Money Bank",
    "Moneta Money Bank": "MONETA Money Bank",
    "MONETA Bank": "MONETA Money Bank",
    "KB": "Komerční banka",
    "Komerční banky": "Komerční banka",
    "UniCredit": "UniCredit Bank",
    "airbank": "Air Bank",
    "mbank": "mBank",
    "ČS": "Česká spořitelna",
    "Spořitelna": "Česká spořitelna",
}


def with_dimension(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str | Column]) -> DataFrame:
    """Left join: every fact row stays, ``columns`` of the dimension are added.

    The dimension must be unique on ``key``.
    """
    side = dim.select(F.col(key).alias("_dim_key"), *columns)
    return fact.join(side, F.col(key) == F.col("_dim_key"), "left").drop("_dim_key")


def canonical_name(name: Column, spellings: Mapping[str, str] = BRAND_SPELLINGS) -> Column:
    """Canonical brand name from a small fixed map; unknown names stay as they are."""
    pairs = [F.lit(text) for pair in spellings.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)


def normalise_names(
    df: DataFrame, name: str, spellings: DataFrame, variant: str, canonical: str, out: str
) -> DataFrame:
    """Canonical name by lookup in a table of spellings (unique on ``variant``).

    The spellings are written first, so their size is known when the join is planned: a
    short list is broadcast, and rows are not shuffled by names that are few and uneven.
    """
    side = staged(
        spellings.select(F.col(variant).alias("_variant"), F.col(canonical).alias("_canonical")), "spellings"
    )
    joined = df.join(side, F.col(name) == F.col("_variant"), "left")
    return joined.withColumn(out, F.coalesce("_canonical", name)).drop("_variant", "_canonical")


#: Names that differ in case, accents, combining marks or ligatures (``ß`` and ``ss``) alone are equal under it.
LENIENT = "UNICODE_CI_AI"


def brand_ids(
    df: DataFrame, name: str, brands: DataFrame, key: Column | None = None, collation: str | None = None
) -> DataFrame:
    """Add ``brand_id`` looked up by (normalised) name; NULL for brands not monitored.

    ``brands`` has ``brand_id`` and ``name``. Should two brands share a name, the
    smallest id is taken, so no row is multiplied. The names are written first, as in
    :func:`normalise_names`. Under a ``collation`` (such as :data:`LENIENT`) names match in any script and any
    spelling that it holds equal, composed or not; the names themselves stay as they are.
    """
    alike = (lambda c: c) if collation is None else (lambda c: F.collate(c, collation))
    # Collated names are grouped but stored plain: one spelling of each stands for all.
    single = brands.groupBy(alike(F.col("name")).alias("_name")).agg(F.min("brand_id").alias("brand_id"))
    side = staged(single.withColumn("_name", F.col("_name").cast("string")), "brand-names")
    match = alike(F.col(name) if key is None else key) == alike(F.col("_name"))
    return df.drop("brand_id").join(side, match, "left").drop("_name")
