"""Text, JSON text and keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Engine prefix -> provider, where the provider is not the prefix itself.
ENGINE_PROVIDERS = {"bing": "microsoft"}

# Accented letters and the plain letters sentiment payloads use instead.
ACCENTED = "áäčďéěíĺľňóôöřŕšťúůüýžÁÄČĎÉĚÍĹĽŇÓÔÖŘŔŠŤÚŮÜÝŽ"
PLAIN = "aacdeeillnooorrstuuuyzAACDEEILLNOOORRSTUUUYZ"


def first_or_blank(items: Column) -> Column:
    """First element of a list, ``''`` for a missing or empty list."""
    return F.when(F.size(items) > 0, F.get(items, F.lit(0))).otherwise(F.lit(""))


def json_text_array(items: Column) -> Column:
    """A list of strings as JSON text, ``["a", "b"]``; a missing list is ``[]``."""
    quoted = F.transform(items, lambda item: F.regexp_replace(F.to_json(F.array(item)), r"^\[|\]$", ""))
    return F.coalesce(F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")), F.lit("[]"))


def parse_tags(tags: Column) -> Column:
    """JSON text to an array of strings; NULL when it is not a JSON list."""
    return F.from_json(tags, "array<string>")


def business_key(*parts: Column) -> Column:
    """MD5 over ``a|b|c``; a missing part counts as the text ``None``."""
    texts = [F.coalesce(part.cast("string"), F.lit("None")) for part in parts]
    return F.md5(F.concat_ws("|", *texts))


def row_uuid() -> Column:
    """A random row id of 32 hex digits."""
    return F.regexp_replace(F.expr("uuid()"), "-", "")


def run_id(term: Column, week: Column) -> Column:
    """``<term>_<ISO week>``."""
    return F.concat(term, F.lit("_"), week)


def engine_provider(engine: Column) -> Column:
    """Provider of an engine id: its prefix, renamed where the company name differs."""
    prefix = F.split(engine, "_")[0]
    provider = prefix
    for known, company in ENGINE_PROVIDERS.items():
        provider = F.when(prefix == known, F.lit(company)).otherwise(provider)
    return provider


def ascii_key(name: Column) -> Column:
    """Join key that ignores accents."""
    return F.translate(name, ACCENTED, PLAIN)


def url_domain(url: Column) -> Column:
    """Host of an http(s) URL, ``''`` when there is none."""
    return F.regexp_extract(url, r"^https?://([^/?#]+)", 1)
