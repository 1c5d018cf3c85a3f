from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions import answers as A
from sitefacts.functions import hits as R
from sitefacts.operators import enrichment, profiles, responses

FULL = {
    "domain": "other.example.net",
    "company_name": "Acme",
    "company_overview": "Acme is a cloud platform for scaling software easily.",
    "target_audience_icp": "Backend engineers.",
    "contact_points": ["HELP@acme.org", "help@acme.org", " sales@acme.org "],
    "key_leadership": [{"name": "  Ada Example ", "role": " CTO ", "linkedin_url": "ada-x"}],
    "data_confidence_score": 0.95,
    "confidence_reasoning": "Complete.",
}


def record(spark, raw: str):
    df = spark.createDataFrame([("acme.example.org", raw)], "domain string, raw_json string")
    return responses.records(df).first()


def changed(**fields):
    data = {**FULL, **fields}
    return json.dumps({k: v for k, v in data.items() if v is not ...})


def test_fenced_answer(spark):
    r = record(spark, "\n    ```json\n" + json.dumps(FULL, indent=4) + "\n    ```\n")
    assert (r.source, r.domain, r.company_name) == ("valid", "acme.example.org", "Acme")
    assert r.contact_points == ["help@acme.org", "sales@acme.org"]
    assert tuple(r.key_leadership[0]) == ("Ada Example", "CTO", "https://www.linkedin.com/in/ada-x")
    assert float(r.rubric_score) == 1.0 and r.data_confidence_score == 0.98


@pytest.mark.parametrize(
    "raw, wanted",
    [
        ("x ```json {1} ``` y ``` z", "{1} ``` y"),
        ("``` {2} ```", "{2}"),
        ("```json {3}", "{3}"),
        ("  {4} ", "{4}"),
        ("``````", ""),
    ],
)
def test_unfence(value, raw, wanted):
    assert value(lambda c: A.unfence(F.col(c)), r=raw) == wanted


@pytest.mark.parametrize(
    "raw, source, score",
    [
        ("{broken", "unparsable", 0.3),
        ("", "unparsable", 0.3),
        ('{"a":1} trailing', "unparsable", 0.3),
        ("[1,2]", "not_object", 0.0),
        ("null", "not_object", 0.0),
        ('"text"', "not_object", 0.0),
    ],
)
def test_answers_that_are_no_record(spark, raw, source, score):
    r = record(spark, raw)
    assert (r.source, r.data_confidence_score, r.contact_points, r.key_leadership) == (source, score, [], [])


@pytest.mark.parametrize(
    "raw, errors",
    [
        (changed(), []),
        (changed(company_overview=...), ["company_overview"]),
        (changed(company_name=None, confidence_reasoning=7), ["company_name", "confidence_reasoning"]),
        (changed(contact_points=None), ["contact_points"]),
        (changed(contact_points=["a", 1]), ["contact_points"]),
        (changed(contact_points=..., key_leadership=...), []),
        (changed(key_leadership=[{"name": " ", "role": "x"}]), ["key_leadership"]),
        (changed(key_leadership=[{"name": "A"}]), ["key_leadership"]),
        (changed(key_leadership=["A"]), ["key_leadership"]),
        (changed(key_leadership=[{"name": "A", "role": "B", "linkedin_url": 5}]), ["key_leadership"]),
        (changed(key_leadership=[{"name": "A", "role": "B", "linkedin_url": None}]), []),
        (changed(data_confidence_score=1.7), ["data_confidence_score"]),
        (changed(data_confidence_score=1), []),
        (changed(data_confidence_score="0.5"), []),
        (changed(data_confidence_score="high"), ["data_confidence_score"]),
        (changed(data_confidence_score=True), ["data_confidence_score"]),
    ],
)
def test_field_checks(spark, raw, errors):
    df = spark.createDataFrame([("a.org", raw)], "domain string, raw_json string")
    r = responses.validate_responses(df).first()
    assert r.error_fields == errors and r.is_valid is (errors == [])


def test_salvaged_record(spark):
    r = record(spark, changed(company_name=..., contact_points=[" A@b.org", 3], data_confidence_score=9))
    assert (r.source, r.company_name, r.contact_points, r.key_leadership) == ("salvaged", "Acme", ["a@b.org"], [])
    assert r.confidence_reasoning == "Partial validation failure: company_name, contact_points, data_confidence_score"
    assert r.data_confidence_score == 0.45


def test_blank_overview_becomes_the_stand_in(spark):
    r = record(spark, changed(company_overview="  "))
    assert r.company_overview == params.OVERVIEW_UNAVAILABLE and float(r.rubric_score) == 0.75 and r.is_placeholder


@pytest.mark.parametrize(
    "url, wanted",
    [
        ("ada-x/", "https://www.linkedin.com/in/ada-x"),
        (" https://www.linkedin.com/in/ada/ ", "https://www.linkedin.com/in/ada"),
        ("https://other.org/ada", "https://other.org/ada"),
        ("  ", None),
        ("null", None),
    ],
)
def test_member_urls(value, url, wanted):
    assert value(lambda c: A.member_url(F.col(c)), u=url) == wanted


@pytest.mark.parametrize(
    "title, wanted",
    [
        ("Bo Sample - CTO at Site | LinkedIn", ("Bo Sample", "CTO at Site")),
        ("Bo Sample | LinkedIn", ("Bo Sample", R.UNKNOWN_ROLE)),
        ("Anne-Marie - CEO - LinkedIn", ("Anne", "Marie")),
        (" - ", ("Acme Founder/CEO", R.UNKNOWN_ROLE)),
    ],
)
def test_title_parsing(value, title, wanted):
    assert tuple(value(lambda c: R.name_and_role(F.col(c), F.lit("Acme")), t=title)) == wanted


def enriched(spark, leaders, hits, **options):
    people = "array<struct<name:string,role:string,linkedin_url:string>>"
    profile = spark.createDataFrame([(1, "Acme", leaders)], f"id int, company_name string, key_leadership {people}")
    found = spark.createDataFrame(hits, "query string, rank int, href string, title string, body string")
    r = enrichment.enrich_leaders(profile, found, "id", **options).first()
    return [tuple(m) for m in r.key_leadership], r.search_fallback_triggered


URL = "https://www.linkedin.com/in/"


def test_missing_urls_are_filled_in_place(spark):
    leaders = [("Ada", "CEO", None), ("Bo", "CTO", URL + "bo"), ("Cy", "CFO", None)]
    hits = [
        ("Ada Acme linkedin", 1, "https://x.org", "t", "none"),
        ("Ada Acme linkedin", 2, "https://x.org", "t", "see https://de.linkedin.com/in/ada_1 now"),
        ("Ada Acme linkedin", 3, URL + "later", "t", ""),
        ("Cy Acme linkedin", 4, URL + "cy", "t", ""),
    ]
    assert enriched(spark, leaders, hits) == (
        [("Ada", "CEO", URL + "ada_1"), ("Bo", "CTO", URL + "bo"), ("Cy", "CFO", None)],
        True,
    )
    assert enriched(spark, leaders, hits, search=False) == (leaders, False)
    assert enriched(spark, leaders, hits, require_name_match=True)[0] == leaders


def test_a_leader_is_added_where_there_was_none(spark):
    hits = [("Acme founder CEO linkedin", 1, URL + "bo", "Bo Sample - CTO | LinkedIn", "")]
    assert enriched(spark, [], hits) == ([("Bo Sample", "CTO", URL + "bo")], True)
    assert enriched(spark, [], [("other", 1, URL + "bo", "t", "")]) == ([], True)
    assert enriched(spark, [("Bo", "CTO", URL + "bo")], hits) == ([("Bo", "CTO", URL + "bo")], False)


def test_fallback(spark):
    failed = spark.createDataFrame([("unreachable.org", "Connection timed out")], "domain string, error_message string")
    r = profiles.fallback_profiles(failed).first()
    assert r.data_confidence_score == 0.0 and "Connection timed out" in r.confidence_reasoning
    assert r.company_name == "Unreachable" and r.metadata.total_tokens == 0


def test_sentences(value):
    text = "First one.  Second\none! Third?"
    assert value(lambda c: profiles.sentences(F.col(c), 2), t=text) == "First one. Second one!"


@pytest.mark.parametrize(
    "raw, whole",
    [('{"a":1}]', False), ('{"a":1}] , [2', False), ('{"a":1}}', False), ('{"a":1},"b":{}', False), ('{"a":[1}', False),
     ("[1,2", False), ('{"a":1} x', False), ("", False), ('{"a":[1]}', True), (' [1, {"b": "]}"}] ', True), ("7", True)],
)
def test_only_one_whole_value_is_json(value, raw, whole):
    assert value(lambda c: A.parse(F.col(c)).isNotNull(), t=raw) is whole
