"""Payload documents with the irregularities real ones have."""

import json
import os


def brand(name, visibility=None, **more):
    return {"name": name, "visibilityScore": visibility, **more}


BRANDS = {"data": {"brands": [
    {"id": "b1", "name": "Bank One", "url": "https://one.example",
     "operationalSearchTerms": [
         {"searchTermId": "t1", "query": "best bank", "addedAt": "2026-01-01T00:00:00.000Z"},
         {"searchTermId": "t1", "query": "best bank?", "addedAt": "2026-02-01T00:00:00.000Z"},
     ]},
    {"id": "b2", "name": "Bank Two"},
]}}

TERMS_B1 = {"data": {"searchTerms": [
    {"id": "t1", "term": "best bank", "aiSearchEngines": ["chatgpt_gui", "x"], "status": "active",
     "executionsAmount": 3, "interval": "weekly", "region": "cz", "createdAt": "2026-01-01T00:00:00.000Z",
     "lastExecutionTime": "2026-04-21T06:00:00.000Z",
     "searchTermTopicRef": {"id": "p1", "name": "Loans"}, "tags": ["north", " top funnel "]},
    {"id": "t2", "term": "loan", "aiSearchEngines": [], "status": "inactive", "tags": []},
    {"id": "t3", "term": "card", "tags": ["dup", "dup"]},
]}}
TERMS_B2 = {"data": {"searchTerms": [
    {"id": "t9", "term": "cards", "aiSearchEngines": ["bing_copilot_gui"], "status": "active"}]}}

REPORT_B1 = {"data": {"searchTerms": [
    {"searchTermId": "t1", "aiSearchEngines": ["chatgpt_gui"], "topic": {"id": "p1", "name": "Loans"},
     "lastSnapshotAt": "2026-04-21T06:05:46.608Z",
     "ownBrand": brand("Bank One", 30, latestRank=None, appearances=1),
     "competitors": [
         brand("Rival", 60, latestRank=1, appearances=2,
               variations=[brand("RIVAL", 10, appearances=1), brand("Rvl", 5, appearances=3)]),
         brand("Other", 10),
     ],
     "answerTexts": [
         {"executionId": "x1", "executedAt": "2026-04-21T06:05:00.000Z", "engine": "chatgpt_gui",
          "answerText": "Rival and Bank One. Rival!"},
         {"executionId": "x2", "executedAt": "2026-04-14T06:05:00.000Z", "engine": "chatgpt_gui",
          "answerText": "Other"},
     ]},
    {"searchTermId": "t2", "aiSearchEngines": [], "lastSnapshotAt": "2026-04-20T06:00:00Z",
     "competitors": [brand("Rival", 0)], "answerTexts": None},
    {"searchTermId": "t3", "ownBrand": brand("", 5)},
]}}
REPORT_B2 = {"data": {"searchTerms": [
    {"searchTermId": "t9", "aiSearchEngines": ["bing_copilot_gui"], "lastSnapshotAt": "2026-04-21T07:00:00.000Z",
     "ownBrand": brand("Bank Two", 80), "competitors": []}]}}

CITATIONS_B1 = {"data": {"domainSummary": {
    "topDomainsByQuery": [
        {"query": "best bank", "searchTermIds": ["t1", "t5"], "engines": [
            {"engineId": "chatgpt_gui", "domains": [
                {"domain": "a.example", "occurrences": 9, "urls": [
                    {"url": "https://a.example/1", "occurrences": 4}, {"url": "https://a.example/2"}]},
                {"domain": "b.example", "occurrences": 7, "urls": []},
                {"domain": "c.example"}]}]},
        {"searchTermIds": [], "engines": [{"domains": [{"occurrences": 2, "urls": None}]}]},
        {"query": "nothing", "searchTermIds": ["t2"]},
    ],
    "topDomainsOverall": [{"domain": "a.example", "occurrences": 9, "urls": [{"url": "u", "occurrences": 1}]}],
    "topDomainsByEngine": [{"engineId": "chatgpt_gui", "domains": [{"domain": "a.example", "occurrences": 9}]}],
    "topDomainsByCompetitor": [
        {"brandName": "Rival", "occurrences": 3, "domains": [{"domain": "r.example", "occurrences": 3}]}],
}, "paginationInfo": {"returnedCount": 5000, "totalCount": 7000, "citationsCapped": True, "brandsCapped": False,
                      "maxCitations": 5000, "maxBrands": 50}}}

TOPICS_B1 = {"data": {"topics": [
    {"id": "p1", "name": "Loans", "searchTermIds": ["t1", "t2"],
     "createdAt": {"_seconds": 1769496543, "_nanoseconds": 580000000}},
    {"id": "p2", "name": "Empty", "searchTermIds": []},
    {"id": "p3", "name": "Missing"},
]}}


def report(days, own, rivals, period="weekly", own_name="Bank One"):
    stamps = [f"{day}T00:00:00.000Z" for day in days]
    metrics = {"name": own_name, "historicalData": {
        "weekly": {"timestamps": []}, period: {"timestamps": stamps, "visibilityScore": own,
                                              "brandNotFound": [True, False][: len(days)]}},
        "topicMetricsData": {"weekly": [
            {"topicId": "p1", "topicName": "Loans", "timestamps": stamps, "mentions": [7]}], "daily": []},
        "engineMetricsData": {"weekly": [], "daily": []}}
    if own_name is None:
        del metrics["name"]
    return {"data": {"ownBrandMetrics": metrics, "competitorMetrics": [
        {"name": "Bank One", "isOwnBrand": True, "latestRank": 4.2, "variations": ["Bank One"]}],
        "competitorTimeSeriesData": {"weekly": {"timestamps": []}, period: {
            "timestamps": stamps, "competitors": [
                {"name": name, "metrics": {"visibilityScore": values, "mentions": [1] * len(values)}}
                for name, values in rivals.items()]}}}}


SENTIMENT_B1 = {"data": {"brandSentiments": [
    {"name": "Bank One", "isOwnBrand": True, "totalSentimentScore": 700, "sentimentCount": 10,
     "positiveKeywords": {"fast app": {
         "count": 3, "executionIds": ["x1", "x1"],
         "timestamps": ["2026-04-21T06:00:00.000Z", "2026-04-21T07:00:00.000Z"]}},
     "negativeKeywords": {"fees": {"count": 1, "executionIds": ["x2"], "timestamps": ["2026-04-21T06:00:00.000Z"]}},
     "webGroundingKeywords": {"positive": {}, "byEngine": {"chatgpt_gui": {"neutral": {
         "loan": {"count": 1, "executionIds": ["x1"], "timestamps": ["2026-04-21T06:00:00.000Z"]}}}}},
     "webGroundingSentimentByEngine": {"chatgpt_gui": {"sum": 140, "count": 2, "avg": 70.0},
                                       "idle": {"sum": 0, "count": 0, "avg": None}}},
    {"name": "Rival", "totalSentimentScore": 0, "sentimentCount": 0},
]}}


def land(root, endpoint, document, **parameters):
    """Write one payload file below the folders of its request parameters."""
    folder = os.path.join(root, endpoint, *[f"{k}={v}" for k, v in parameters.items()])
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{len(os.listdir(folder))}.json")
    with open(path, "w", encoding="utf-8") as out:
        out.write(document if isinstance(document, str) else json.dumps(document, indent=2, ensure_ascii=False))
    return path


def land_all(root, **run):
    """Payloads of every endpoint, all below the folder of ``run`` if one is given."""
    land(root, "brands", BRANDS, **run)
    land(root, "search_terms", TERMS_B1, brand_id="b1", **run)
    land(root, "search_terms", TERMS_B2, brand_id="b2", **run)
    land(root, "term_report", REPORT_B1, brand_id="b1", **run)
    land(root, "term_report", REPORT_B2, brand_id="b2", **run)
    land(root, "citations", CITATIONS_B1, brand_id="b1", **run)
    land(root, "topics", TOPICS_B1, brand_id="b1", **run)
    land(root, "report", report(["2026-04-07", "2026-04-14"], [10, 20], {"Rival": [30, 40]}),
         brand_id="b1", topic_id="p1", **run)
    land(root, "report", report(["2026-04-07"], [1], {}), brand_id="b1", topic_id="p2", **run)
