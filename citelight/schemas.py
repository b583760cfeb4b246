"""Explicit schemas: payloads as landed, landing tables, built tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructType,
    TimestampType,
)

STRING, LONG, DOUBLE, BOOLEAN = StringType(), LongType(), DoubleType(), BooleanType()
_KINDS = {
    "string": STRING, "bigint": LONG, "double": DOUBLE, "boolean": BOOLEAN,
    "date": DateType(), "timestamp": TimestampType(),
}


def _struct(**fields: DataType) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema


def _table(columns: str) -> StructType:
    """``"a string, b bigint"`` as a schema."""
    return _struct(**{name: _KINDS[kind] for name, kind in (c.split() for c in columns.split(","))})


def _payload(**data: DataType) -> StructType:
    return _struct(data=_struct(**data))


# --- payloads -----------------------------------------------------------------------------

TEXTS = ArrayType(STRING)
_NAMED = {"id": STRING, "name": STRING}
_STAMP = _struct(_seconds=LONG, _nanoseconds=LONG)

BRANDS = _payload(brands=ArrayType(_struct(
    **_NAMED, url=STRING,
    operationalSearchTerms=ArrayType(_struct(searchTermId=STRING, query=STRING, addedAt=STRING)),
)))

SEARCH_TERMS = _payload(searchTerms=ArrayType(_struct(
    id=STRING, term=STRING, aiSearchEngines=TEXTS, status=STRING, executionsAmount=LONG, interval=STRING,
    region=STRING, createdAt=STRING, lastExecutionTime=STRING, nextScheduledExecutionTime=STRING,
    searchTermTopicRef=_struct(**_NAMED), tags=TEXTS,
)))

_MEASURES = {
    "name": STRING, "visibilityScore": DOUBLE, "avgSentiment": DOUBLE, "avgRank": DOUBLE, "latestRank": LONG,
    "detectionRate": DOUBLE, "top3": DOUBLE, "citationCount": LONG, "appearances": LONG,
}
_BRAND = _struct(**_MEASURES, variations=ArrayType(_struct(**_MEASURES)))

TERM_REPORT = _payload(searchTerms=ArrayType(_struct(
    searchTermId=STRING, query=STRING, aiSearchEngines=TEXTS, topic=_struct(**_NAMED), lastSnapshotAt=STRING,
    ownBrand=_BRAND, competitors=ArrayType(_BRAND),
    answerTexts=ArrayType(_struct(executionId=STRING, executedAt=STRING, engine=STRING, answerText=STRING)),
)))

_DOMAINS = ArrayType(_struct(
    domain=STRING, occurrences=LONG, urls=ArrayType(_struct(url=STRING, occurrences=LONG))
))
_ENGINE_DOMAINS = ArrayType(_struct(engineId=STRING, domains=_DOMAINS))

CITATIONS = _payload(
    domainSummary=_struct(
        topDomainsOverall=_DOMAINS,
        topDomainsByEngine=_ENGINE_DOMAINS,
        topDomainsByQuery=ArrayType(_struct(query=STRING, searchTermIds=TEXTS, engines=_ENGINE_DOMAINS)),
        topDomainsByOwnBrandCitations=_DOMAINS,
        topDomainsByCompetitor=ArrayType(_struct(brandName=STRING, occurrences=LONG, domains=_DOMAINS)),
    ),
    paginationInfo=_struct(
        totalCount=LONG, returnedCount=LONG, citationsCapped=BOOLEAN, brandsCapped=BOOLEAN, maxCitations=LONG,
        maxBrands=LONG,
    ),
)

TOPICS = _payload(topics=ArrayType(_struct(**_NAMED, searchTermIds=TEXTS, createdAt=_STAMP, updatedAt=_STAMP)))

_DOUBLES, _LONGS = ArrayType(DOUBLE), ArrayType(LONG)
_SERIES_FIELDS = {
    "visibilityScore": _DOUBLES, "sentiment": _DOUBLES, "avgPosition": _DOUBLES, "detectionRate": _DOUBLES,
    "top3": _DOUBLES, "mentions": _LONGS, "citations": _LONGS, "brandNotFound": ArrayType(BOOLEAN),
    "timestamps": TEXTS,
}
_SERIES = _struct(**_SERIES_FIELDS)


def _periods(kind: DataType) -> StructType:
    return _struct(weekly=kind, daily=kind, monthly=kind, hourly=kind)


REPORT = _payload(
    ownBrandMetrics=_struct(
        name=STRING,
        historicalData=_periods(_SERIES),
        topicMetricsData=_periods(ArrayType(_struct(topicId=STRING, topicName=STRING, **_SERIES_FIELDS))),
        engineMetricsData=_periods(ArrayType(_struct(engineId=STRING, engineName=STRING, **_SERIES_FIELDS))),
    ),
    competitorMetrics=ArrayType(_struct(
        name=STRING, isOwnBrand=BOOLEAN, latestValue=DOUBLE, trend=DOUBLE, variations=TEXTS,
        visibilityScore=DOUBLE, latestRank=DOUBLE, avgRank=DOUBLE, avgSentiment=DOUBLE, appearances=LONG,
        citationCount=LONG, detectionRate=DOUBLE, top3=DOUBLE,
    )),
    competitorTimeSeriesData=_periods(_struct(
        timestamps=TEXTS, competitors=ArrayType(_struct(name=STRING, isOwnBrand=BOOLEAN, metrics=_SERIES)),
    )),
)

_KEYWORDS = MapType(STRING, _struct(count=LONG, executionIds=TEXTS, timestamps=TEXTS))
_POLAR = {"positive": _KEYWORDS, "neutral": _KEYWORDS, "negative": _KEYWORDS}
_SOURCE_KEYWORDS = _struct(**_POLAR, byEngine=MapType(STRING, _struct(**_POLAR)))
_ENGINE_SENTIMENT = MapType(STRING, _struct(sum=LONG, count=LONG, avg=DOUBLE))

SENTIMENT = _payload(brandSentiments=ArrayType(_struct(
    name=STRING, isOwnBrand=BOOLEAN, totalSentimentScore=LONG, sentimentCount=LONG, executionCount=LONG,
    nameVariations=TEXTS, positiveKeywords=_KEYWORDS, neutralKeywords=_KEYWORDS, negativeKeywords=_KEYWORDS,
    webGroundingKeywords=_SOURCE_KEYWORDS, trainingDataKeywords=_SOURCE_KEYWORDS,
    webGroundingSentimentByEngine=_ENGINE_SENTIMENT, trainingDataSentimentByEngine=_ENGINE_SENTIMENT,
)))

# --- parts of payloads --------------------------------------------------------------------


def only(kind: DataType, *paths: str) -> DataType:
    """The parts of a schema that ``paths`` name, in the schema's order.

    Points lead down, also into the entries of lists; a name stands for all that is below it. JSON read
    with such a schema is skipped over where it is not asked for: neither built nor checked.
    """
    if "" in paths:
        return kind
    if isinstance(kind, ArrayType):
        return ArrayType(only(kind.elementType, *paths))
    below: dict[str, list[str]] = {}
    for path in paths:
        name, _, rest = path.partition(".")
        below.setdefault(name, []).append(rest)
    unknown = below.keys() - set(kind.names)
    if unknown:
        raise KeyError(f"no {sorted(unknown)} in {kind.names}")
    return _struct(**{f.name: only(f.dataType, *below[f.name]) for f in kind.fields if f.name in below})


def _part(payload: StructType, *paths: str) -> StructType:
    return only(payload, *[f"data.{path}" for path in paths])


# What each flattener reads.
SNAPSHOT_MARKS = _part(TERM_REPORT, "searchTerms.lastSnapshotAt")
SNAPSHOTS = _part(
    TERM_REPORT, *[f"searchTerms.{name}" for name in ("searchTermId", "aiSearchEngines", "topic", "lastSnapshotAt")],
    *[f"searchTerms.{brand}.{name}" for brand in ("ownBrand", "competitors") for name in _MEASURES],
)
VARIATIONS = _part(
    TERM_REPORT, "searchTerms.searchTermId", "searchTerms.competitors.name", "searchTerms.competitors.variations"
)
ANSWERS = _part(TERM_REPORT, "searchTerms.searchTermId", "searchTerms.answerTexts")
CITED_URLS = _part(CITATIONS, "domainSummary.topDomainsByQuery")
DOMAIN_ROLLUPS = _part(CITATIONS, *[
    f"domainSummary.topDomains{name}" for name in ("Overall", "ByEngine", "ByOwnBrandCitations", "ByCompetitor")
])
CITATION_PAGES = _part(CITATIONS, "paginationInfo")
TIMELINES = _part(REPORT, "ownBrandMetrics.name", "ownBrandMetrics.historicalData", "competitorTimeSeriesData")
BREAKDOWNS = {by: _part(REPORT, f"ownBrandMetrics.{by}MetricsData") for by in ("topic", "engine")}
BRAND_GAPS = _part(REPORT, "ownBrandMetrics.historicalData")
COMPETITORS = _part(REPORT, "competitorMetrics")

# --- landing tables -----------------------------------------------------------------------

RAW_BRANDS = _table(
    "brand_id string, name string, domain string, is_own_brand boolean, etl_loaded_at timestamp"
)
RAW_SEARCH_TERMS = _table(
    "brand_id string, search_term_id string, query string, engine string, topic_id string, topic_name string,"
    " region string, interval string, tags string, status string, created_at timestamp,"
    " last_execution_time timestamp, next_execution_time timestamp, executions_amount bigint,"
    " etl_loaded_at timestamp"
)
RAW_BRAND_SNAPSHOTS = _table(
    "brand_id string, search_term_id string, engine string, topic_id string, topic_name string,"
    " last_snapshot_at timestamp, brand_name string, is_own_brand boolean, visibility_score double,"
    " avg_sentiment double, avg_rank double, latest_rank bigint, detection_rate double, top3_rate double,"
    " citation_count bigint, appearances bigint, etl_loaded_at timestamp"
)
RAW_ANSWER_TEXTS = _table(
    "brand_id string, search_term_id string, execution_id string, executed_at timestamp, engine string,"
    " answer_text string, etl_loaded_at timestamp"
)
RAW_CITATIONS = _table(
    "brand_id string, search_term_id string, query string, engine string, domain string, url string,"
    " occurrences bigint, etl_loaded_at timestamp"
)
REPORT_TABLE = _table(
    "unique_row_id string, business_key string, owning_brand_id string, topic_id string, topic_name string,"
    " snapshot_time timestamp, snapshot_date date, brand_name string, is_own_brand boolean,"
    " visibility_score double, sentiment double, avg_position double, detection_rate double, top3 double,"
    " mentions bigint, citations bigint, etl_loaded_at timestamp"
)

RAW_TABLES = {
    "raw_brands": RAW_BRANDS,
    "raw_search_terms": RAW_SEARCH_TERMS,
    "raw_brand_snapshots": RAW_BRAND_SNAPSHOTS,
    "raw_answer_texts": RAW_ANSWER_TEXTS,
    "raw_citations": RAW_CITATIONS,
    "l0_report": REPORT_TABLE,
}

# --- built tables -------------------------------------------------------------------------

_METRICS = (
    "visibility_score double, avg_sentiment double, avg_rank double, latest_rank bigint, detection_rate double,"
    " top3_rate double, citation_count bigint, appearances bigint"
)

L1_DIM_BRANDS = _table(
    "brand_id string, name string, domain string, is_own_brand boolean, is_active boolean, updated_at timestamp"
)
L1_DIM_SEARCH_TERMS = _table(
    "search_term_id string, brand_id string, query string, engine string, topic_id string, topic_name string,"
    " tags string, region string, interval string, is_active boolean, created_at timestamp,"
    " last_execution_time timestamp, next_execution_time timestamp, updated_at timestamp"
)
L1_FACT_SNAPSHOTS = _table(
    "snapshot_week string, snapshot_date date, search_term_id string, brand_name string, brand_id string,"
    f" is_own_brand boolean, topic_id string, engine string, {_METRICS}, ai_share_of_voice double"
)
L1_FACT_CITATIONS = _table(
    "snapshot_week string, snapshot_date date, search_term_id string, brand_id string, engine string,"
    " domain string, url string, occurrences bigint"
)
L1_FACT_ANSWER_TEXTS = _table(
    "execution_id string, search_term_id string, snapshot_week string, executed_at timestamp, engine string,"
    " answer_text string"
)
L2_SNAPSHOTS = _table(
    "snapshot_week string, snapshot_date date, search_term_id string, query string, region string,"
    " refresh_interval string, is_search_term_active boolean, last_execution_time timestamp,"
    " next_execution_time timestamp, topic_id string, topic_name string, tags string, engine string,"
    f" owning_brand_id string, brand_name string, brand_id string, is_own_brand boolean, {_METRICS},"
    " ai_share_of_voice double"
)
L2_SEARCH_TERM_TAGS = _table(
    "search_term_id string, brand_id string, topic_id string, topic_name string, engine string, query string,"
    " tag string"
)
L2_CITATIONS = _table(
    "snapshot_week string, snapshot_date date, search_term_id string, query string, topic_id string,"
    " topic_name string, tags string, brand_id string, brand_name string, engine string, domain string,"
    " url string, occurrences bigint"
)
L2_ANSWER_TEXTS = _table(
    "execution_id string, snapshot_week string, executed_at timestamp, search_term_id string, query string,"
    " topic_id string, topic_name string, tags string, engine string, answer_text string"
)

DIMENSIONS = {
    "l1_dim_brands": L1_DIM_BRANDS,
    "l1_dim_search_terms": L1_DIM_SEARCH_TERMS,
    "l2_search_term_tags": L2_SEARCH_TERM_TAGS,
    "l1_report": REPORT_TABLE,
}
# Stored by snapshot_week.
FACTS = {
    "l1_fact_snapshots": L1_FACT_SNAPSHOTS,
    "l1_fact_citations": L1_FACT_CITATIONS,
    "l1_fact_answer_texts": L1_FACT_ANSWER_TEXTS,
    "l2_snapshots": L2_SNAPSHOTS,
    "l2_citations": L2_CITATIONS,
    "l2_answer_texts": L2_ANSWER_TEXTS,
}
TABLES = {**RAW_TABLES, **DIMENSIONS, **FACTS}

# --- tables loaded by date ----------------------------------------------------------------

DATED_BRAND_SNAPSHOTS = _table(
    "snapshot_date date, snapshot_week string, search_term_id string, owning_brand_id string,"
    f" brand_name string, is_own_brand boolean, brand_id string, {_METRICS}, engine string, topic_id string,"
    " last_snapshot_at timestamp, loaded_at timestamp"
)
DATED_CITATIONS = _table(
    "snapshot_date date, snapshot_week string, brand_id string, search_term_id string, engine string,"
    " domain string, url string, occurrences bigint, loaded_at timestamp"
)
DATED_ANSWER_TEXTS = _table(
    "execution_id string, search_term_id string, executed_at timestamp, engine string, answer_text string,"
    " loaded_at timestamp"
)
CURRENT_BRANDS = _table(
    "brand_id string, name string, domain string, is_own_brand boolean, is_active boolean, loaded_at timestamp"
)
CURRENT_SEARCH_TERMS = _table(
    "search_term_id string, brand_id string, query string, topic_id string, topic_name string, engine string,"
    " region string, interval string, tags string, is_active boolean, loaded_at timestamp"
)

# Columns that must never be NULL (checked by plans.quality).
REQUIRED = {
    "brand_snapshots": ("snapshot_date", "snapshot_week", "search_term_id", "brand_name", "is_own_brand"),
    "citations": ("snapshot_date", "snapshot_week", "brand_id", "engine", "domain", "occurrences"),
    "answer_texts": ("execution_id", "search_term_id", "executed_at"),
}
