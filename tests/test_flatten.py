import json

import pytest
from pyspark.sql import functions as F

import samples
from citelight import schemas
from citelight.operators.latest import latest_per_key
from citelight.plans.reports import mean_sentiment
from citelight.sources import flatten
from citelight.sources.payloads import parse_payloads, read_payloads, split_corrupt


def parsed(spark, schema, *documents, **columns):
    rows = [(f"b{i}", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents, 1)]
    df = spark.createDataFrame(rows, "brand_id string, payload string")
    return parse_payloads(df.withColumns({k: F.lit(v) for k, v in columns.items()}), schema)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_brands_and_embedded_terms(spark):
    payload = parsed(spark, schemas.BRANDS, samples.BRANDS)
    assert values(flatten.brands(payload), "brand_id", "domain", "is_own_brand") == [
        ("b1", "https://one.example", True), ("b2", None, True)]
    terms = flatten.embedded_terms(payload)
    assert terms.count() == 2
    newest = latest_per_key(terms, ["search_term_id"], [F.desc_nulls_last("added_at")])
    assert values(newest, "brand_id", "search_term_id", "query") == [("b1", "t1", "best bank?")]


def test_search_terms(spark):
    rows = flatten.search_terms(parsed(spark, schemas.SEARCH_TERMS, samples.TERMS_B1))
    assert values(rows, "search_term_id", "engine", "topic_id", "tags", "status", "executions_amount") == [
        ("t1", "chatgpt_gui", "p1", '["north", " top funnel "]', "active", 3),
        ("t2", "", None, "[]", "inactive", None), ("t3", "", None, '["dup", "dup"]', None, None)]
    assert str(rows.first().last_execution_time) == "2026-04-21 06:00:00"


def test_snapshots(spark):
    payload = parsed(spark, schemas.TERM_REPORT, samples.REPORT_B1)
    rows = flatten.brand_snapshots(payload)
    assert values(rows, "search_term_id", "engine", "topic_id", "brand_name", "is_own_brand", "visibility_score", "latest_rank") == [
        ("t1", "chatgpt_gui", "p1", "Bank One", True, 30.0, None), ("t1", "chatgpt_gui", "p1", "Rival", False, 60.0, 1),
        ("t1", "chatgpt_gui", "p1", "Other", False, 10.0, None), ("t2", "", None, "Rival", False, 0.0, None),
        ("t3", "", None, "", True, 5.0, None)]
    assert str(flatten.latest_payload_snapshot(payload).first().payload_max) == "2026-04-21 06:05:46.608000"


def test_dated_snapshots(spark):
    rows = flatten.dated_brand_snapshots(
        parsed(spark, schemas.TERM_REPORT, samples.REPORT_B1), F.lit("2027-01-01").cast("date"))
    got = values(rows.where("search_term_id <> 't2'"), "brand_name", "brand_id", "owning_brand_id", "snapshot_week")
    assert got == [("Bank One", "b1", "b1", "2026-17"), ("Rival", None, "b1", "2026-17"),
                   ("Other", None, "b1", "2026-17"), ("unknown", "b1", "b1", "2026-53")]


def test_answers(spark):
    rows = flatten.answer_texts(parsed(spark, schemas.TERM_REPORT, samples.REPORT_B1, {"data": {}}))
    assert values(rows, "brand_id", "execution_id", "answer_text") == [
        ("b1", "x1", "Rival and Bank One. Rival!"), ("b1", "x2", "Other")]


def test_variations(spark):
    rows = flatten.name_variations(parsed(spark, schemas.TERM_REPORT, samples.REPORT_B1, samples.REPORT_B2))
    assert values(rows, "brand_name", "variant", "appearances") == [("Rival", "RIVAL", 1), ("Rival", "Rvl", 3)]
    more = rows.union(rows.where("variant = 'Rvl'").withColumns({"brand_name": F.lit("Else"), "appearances": F.lit(9)}))
    assert sorted(values(flatten.spelling_map(more), "variant", "brand_name")) == [("RIVAL", "Rival"), ("Rvl", "Else")]


def test_citations(spark):
    payload = parsed(spark, schemas.CITATIONS, samples.CITATIONS_B1, {"data": {}})
    assert values(flatten.citations(payload), "search_term_id", "query", "engine", "domain", "url", "occurrences") == [
        ("t1", "best bank", "chatgpt_gui", "a.example", "https://a.example/1", 4),
        ("t1", "best bank", "chatgpt_gui", "a.example", "https://a.example/2", 0),
        ("t1", "best bank", "chatgpt_gui", "b.example", None, 7),
        ("t1", "best bank", "chatgpt_gui", "c.example", None, 0),
        (None, "", "", "", None, 2)]
    dated = flatten.dated_citations(payload, F.lit("2026-04-22").cast("date"))
    assert {r.snapshot_week for r in dated.collect()} == {"2026-17"} and "query" not in dated.columns
    assert sorted(values(flatten.domain_rollups(payload), "scope", F.coalesce("member", F.lit("")), "domain", "url_count")) == [
        ("competitor", "Rival", "r.example", 0), ("engine", "chatgpt_gui", "a.example", 0), ("overall", "", "a.example", 1)]
    assert values(flatten.capped_citations(payload), "brand_id", "returned_count", "total_count") == [("b1", 5000, 7000)]


def test_topics(spark):
    rows = flatten.active_topics(parsed(spark, schemas.TOPICS, samples.TOPICS_B1))
    assert values(rows, "topic_id", F.col("created_at").cast("string"), "updated_at") == [
        ("p1", "2026-01-27 06:49:03.58", None)]


@pytest.mark.parametrize("period", ["weekly", "daily", "monthly", "hourly"])
def test_report_uses_the_first_filled_period(spark, period):
    document = samples.report(["2026-04-07", "2026-04-14"], [10.0], {"Rival": [1.0, 2.0]}, period, own_name=None)
    payload = parsed(spark, schemas.REPORT, document, brand_name="Fallback", topic_id="p1", topic_name="Loans")
    rows = flatten.report_rows(payload)
    got = values(rows, "brand_name", "is_own_brand", F.col("snapshot_date").cast("string"), "visibility_score", "mentions")
    assert got == [
        ("Fallback", True, "2026-04-07", 10.0, None), ("Fallback", True, "2026-04-14", None, None),
        ("Rival", False, "2026-04-07", 1.0, 1), ("Rival", False, "2026-04-14", 2.0, 1)]
    assert len({r.unique_row_id for r in rows.collect()}) == 4


def test_report_prefers_weekly_and_keys_missing_names(spark):
    import hashlib

    document = samples.report(["2026-04-07"], [10.0], {"Rival": [1.0]}, "weekly")
    document["data"]["ownBrandMetrics"]["historicalData"]["daily"] = {
        "timestamps": ["2026-04-01T00:00:00Z"], "visibilityScore": [99]}
    document["data"]["competitorTimeSeriesData"]["weekly"]["competitors"].append({"isOwnBrand": True})
    payload = parsed(spark, schemas.REPORT, document, {"data": {}}, brand_name="x", topic_id="p1", topic_name="Loans")
    rows = flatten.report_rows(payload).collect()
    assert [(r.brand_name, r.is_own_brand, r.visibility_score) for r in rows] == [
        ("Bank One", True, 10.0), ("Rival", False, 1.0), (None, True, None)]
    assert rows[2].business_key == hashlib.md5(b"b1|p1|None|2026-04-07").hexdigest()


def test_report_sections(spark):
    document = samples.report(["2026-04-07", "2026-04-14"], [10.0, 11.0], {})
    payload = parsed(spark, schemas.REPORT, document)
    rows = flatten.breakdown_rows(payload, "topic")
    assert values(rows, "member_id", "member_name", F.col("snapshot_date").cast("string"), "mentions") == [
        ("p1", "Loans", "2026-04-07", 7), ("p1", "Loans", "2026-04-14", None)]
    assert flatten.breakdown_rows(payload, "engine").isEmpty()
    assert sorted(values(flatten.brand_gaps(payload), F.col("snapshot_date").cast("string"), "brand_not_found")) == [
        ("2026-04-07", True), ("2026-04-14", False)]
    assert values(flatten.competitor_summary(payload), "brand_name", "is_own_brand", "latest_rank") == [("Bank One", True, 4.2)]


def test_sentiment(spark):
    payload = parsed(spark, schemas.SENTIMENT, samples.SENTIMENT_B1)
    words = flatten.sentiment_keywords(payload)
    assert sorted(values(words, "source", F.coalesce("engine", F.lit("")), "polarity", "keyword", "count")) == [
        ("all", "", "negative", "fees", 1), ("all", "", "positive", "fast app", 3),
        ("web", "chatgpt_gui", "neutral", "loan", 1)]
    occurrences = flatten.keyword_occurrences(words).where("keyword = 'fast app'")
    assert values(occurrences, "execution_id", F.col("at").cast("string")) == [
        ("x1", "2026-04-21 06:00:00"), ("x1", "2026-04-21 07:00:00")]
    scores = mean_sentiment(flatten.engine_sentiment(payload), ["brand_name", "engine"])
    assert sorted(values(scores, "engine", "mean_sentiment")) == [("chatgpt_gui", 70.0), ("idle", None)]
    totals = mean_sentiment(flatten.sentiment_totals(payload), ["brand_name"])
    assert sorted(values(totals, "brand_name", "mean_sentiment")) == [("Bank One", 70.0), ("Rival", None)]


def test_unreadable_documents(spark):
    payload = parsed(spark, schemas.TERM_REPORT, samples.REPORT_B1, '{"data": {"searchTerms": [', "{}", "not json")
    good, bad = split_corrupt(payload)
    assert [r.brand_id for r in good.collect()] == ["b1"]
    assert sorted(r.brand_id for r in bad.collect()) == ["b2", "b3", "b4"]


def test_documents_are_parsed_once(spark, plan_of):
    good, _ = split_corrupt(parsed(spark, schemas.TERM_REPORT, samples.REPORT_B1))
    assert plan_of(flatten.brand_snapshots(good)).count("from_json") == 1


def test_flatteners_do_not_shuffle(spark, plan_of, tmp_path):
    samples.land_all(str(tmp_path))
    read = lambda endpoint, schema: read_payloads(spark, str(tmp_path / endpoint), schema)
    for rows in (
        flatten.brand_snapshots(read("term_report", schemas.TERM_REPORT)),
        flatten.answer_texts(read("term_report", schemas.TERM_REPORT)),
        flatten.citations(read("citations", schemas.CITATIONS)),
        flatten.search_terms(read("search_terms", schemas.SEARCH_TERMS)),
    ):
        assert "Exchange" not in plan_of(rows)
    assert {r.brand_id for r in flatten.search_terms(read("search_terms", schemas.SEARCH_TERMS)).collect()} == {"b1", "b2"}


def _report_document():
    return samples.report(["2026-05-04", "2026-05-11"], [10.0, 20.0], {"Rival": [1.0, 2.0]})


@pytest.mark.parametrize("whole, part, document, flattened", [
    (schemas.TERM_REPORT, schemas.SNAPSHOTS, samples.REPORT_B1, flatten.brand_snapshots),
    (schemas.TERM_REPORT, schemas.SNAPSHOTS, samples.REPORT_B1,
     lambda p: flatten.dated_brand_snapshots(p, F.lit("2027-01-01").cast("date"))),
    (schemas.TERM_REPORT, schemas.SNAPSHOT_MARKS, samples.REPORT_B1, flatten.latest_payload_snapshot),
    (schemas.TERM_REPORT, schemas.VARIATIONS, samples.REPORT_B1, flatten.name_variations),
    (schemas.TERM_REPORT, schemas.ANSWERS, samples.REPORT_B1, flatten.answer_texts),
    (schemas.CITATIONS, schemas.CITED_URLS, samples.CITATIONS_B1, flatten.citations),
    (schemas.CITATIONS, schemas.DOMAIN_ROLLUPS, samples.CITATIONS_B1, flatten.domain_rollups),
    (schemas.CITATIONS, schemas.CITATION_PAGES, samples.CITATIONS_B1, flatten.capped_citations),
    (schemas.REPORT, schemas.TIMELINES, None, lambda p: flatten.report_rows(p).drop("unique_row_id")),
    (schemas.REPORT, schemas.BREAKDOWNS["engine"], None, lambda p: flatten.breakdown_rows(p, "engine")),
    (schemas.REPORT, schemas.BREAKDOWNS["topic"], None, lambda p: flatten.breakdown_rows(p, "topic")),
    (schemas.REPORT, schemas.BRAND_GAPS, None, flatten.brand_gaps),
    (schemas.REPORT, schemas.COMPETITORS, None, flatten.competitor_summary),
])
def test_a_part_of_the_schema_gives_the_same_rows(spark, whole, part, document, flattened):
    document = document or _report_document()
    more = {"brand_name": "x", "topic_id": "p1", "topic_name": "Loans"} if whole is schemas.REPORT else {}
    one, other = (flattened(parsed(spark, schema, document, {"data": {}}, **more)) for schema in (whole, part))
    assert one.schema == other.schema
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_only():
    assert schemas.only(schemas.CITATIONS, "data") == schemas.CITATIONS
    part = schemas.only(schemas.CITATIONS, "data.domainSummary.topDomainsByQuery.engines.engineId", "data.paginationInfo")
    assert part.simpleString() == (
        "struct<data:struct<domainSummary:struct<topDomainsByQuery:array<struct<engines:array<struct<engineId:string>>>>>,"
        "paginationInfo:struct<totalCount:bigint,returnedCount:bigint,citationsCapped:boolean,brandsCapped:boolean,"
        "maxCitations:bigint,maxBrands:bigint>>>"
    )
    with pytest.raises(KeyError):
        schemas.only(schemas.CITATIONS, "data.nothing")


def test_what_is_not_asked_for_is_not_checked(spark):
    broken = {"data": {**samples.CITATIONS_B1["data"], "paginationInfo": "none"}}
    whole, part = (parsed(spark, schema, broken) for schema in (schemas.CITATIONS, schemas.CITED_URLS))
    assert split_corrupt(whole)[0].count() == 0
    assert flatten.citations(split_corrupt(part)[0]).count() == flatten.citations(
        parsed(spark, schemas.CITED_URLS, samples.CITATIONS_B1)).count()
