"""The flow's joins, answers and rules."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from derived_tables import load
from sitefacts.plans import enrich as flow
from sitefacts.plans.skew import salted_join
from sitefacts.plans.wanted import likely_wanted
from sitefacts.sources import seeds

KEY = ["site_id", "n"]
ANSWERS = "domain string, provider string, model_name string, raw_json string, prompt_tokens bigint, completion_tokens bigint"
HITS = "query string, rank int, href string, title string, body string"
PAGES = "site_id bigint, n int, url string, final_url string, status_code int, html string, success boolean, error_message string"


def plan_lines(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def depth(line):
    return len(re.match(r"[\s:+\-|]*", line)[0])


def shuffles_of_html(df):
    """Exchanges of HTML, each with whether a bitmap of wanted keys was applied below it."""
    lines = plan_lines(df)
    found = []
    for i, line in enumerate(lines):
        if re.search(r"[^t]Exchange hashpartitioning", line):
            below = list(_below(lines, i))
            if any("html" in x for x in below[:3]):
                found.append(any("BroadcastHashJoin" in x and "_piece" in x for x in below))
    return found


def _below(lines, i):
    for line in lines[i + 1 :]:
        if depth(line) <= depth(lines[i]):
            return
        yield line


def test_html_of_unwanted_pages_is_not_shuffled(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        site_pages = load(spark, sf, "site_pages")
        sites = seeds.normalized_seeds(load(spark, sf, "seeds").select(F.col("raw_domain").alias("domain")))
        found = shuffles_of_html(flow.homepages(sites, site_pages, KEY))
        assert found and all(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_few_unwanted_rows_pass_and_no_wanted_one_is_lost(spark):
    rows = spark.range(200_000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"), F.lit("x").alias("html"))
    wanted = rows.where("a % 100 = 3").select("a", "b")
    passed = likely_wanted(rows, wanted, ["a", "b"], wanted.count())
    assert passed.columns == rows.columns
    assert passed.join(wanted, ["a", "b"]).count() == wanted.count()
    assert passed.count() < 200_000 * (1 / 100 + 1 / 10)
    tight = likely_wanted(rows, wanted, ["a", "b"], wanted.count(), most_bits=1 << 15)
    assert tight.join(wanted, ["a", "b"]).count() == wanted.count()
    assert likely_wanted(rows, wanted.limit(0), ["a", "b"], 0).count() == 0


def test_only_hot_keys_are_salted(spark):
    many = spark.range(5000).select("id", F.when(F.col("id") % 10 != 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    one = many.select("k").distinct().withColumn("v", F.length("k"))
    for how in ("left", "inner"):
        salted = salted_join(many, one, ["k"], ["id"], how, hot_rows=1000)
        plain = many.join(one, ["k"], how)
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    # The hot key goes to five tasks, and only its row is repeated: 500 cold keys and five copies.
    plan = "\n".join(plan_lines(salted_join(many, one, ["k"], ["id"], hot_rows=1000)))
    assert "_slice" in plan
    counts = many.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    given = salted_join(many, one, ["k"], ["id"], "inner", hot_rows=1000, counts=counts)
    assert given.count() == 5000


def page(site_id, domain, html="<html><head><title>Name - x</title></head><body><p>First sentence here. Second one. Third.</p> info@{0}</body></html>"):
    return (site_id, 0, f"https://{domain}", f"https://{domain}/", 200, html.format(domain), True, None)


def answer(domain, provider, overview, prompt, completion, model="gpt-4o"):
    text = (
        f'{{"domain":"{domain}","company_name":"N","company_overview":"{overview}","target_audience_icp":"Engineers and analysts.",'
        f'"contact_points":["a@{domain}"],"key_leadership":[],"data_confidence_score":0.8,"confidence_reasoning":"r"}}'
    )
    return (domain, provider, model, text if overview else "[1]", prompt, completion)


@pytest.fixture(scope="module")
def batch(spark):
    sites = spark.createDataFrame([("a.org",), ("b.org",), ("c.org",), ("d.org",)], "domain string")
    pages = spark.createDataFrame([page(1, "a.org"), page(2, "b.org"), page(3, "c.org", "")[:6] + (False, "refused")], PAGES)
    answers = [
        answer("a.org", "p1", "", 1000, 10), answer("a.org", "p2", "It builds long and useful data pipelines.", 2000, 20),
        answer("a.org", "p3", "", 4000, 40, "gpt-4o-mini"), answer("c.org", "p1", "Nobody reads this.", 1, 1),
    ]
    hits = spark.createDataFrame([], HITS)
    run = lambda **options: {
        r.domain: r for r in flow.enrich(sites, pages, spark.createDataFrame(answers, ANSWERS), hits, KEY, search=False, **options).collect()
    }
    return run


def test_best_answer_counts_and_all_calls_are_paid(batch):
    rows = batch()
    best = rows["a.org"]
    assert best.company_overview.startswith("It builds") and best.metadata.llm_provider == "p2"
    assert (best.metadata.prompt_tokens, best.metadata.completion_tokens, best.metadata.total_tokens) == (7000, 70, 7070)
    assert best.metadata.estimated_cost_usd == pytest.approx(0.0026 + 0.0052 + 0.000624)
    assert len(rows) == 4 and "No answer stored" in rows["b.org"].company_overview and "refused" in rows["c.org"].company_overview


def test_answers_by_another_rule(batch):
    rows = batch(prefer=[-F.col("prompt_tokens")])
    assert rows["a.org"].metadata.llm_provider == "p3" and rows["a.org"].metadata.total_tokens == 7070


def test_rules_for_unanswered_sites_only(batch):
    rows = batch(rules=True)
    assert rows["b.org"].company_name == "Name" and rows["b.org"].company_overview == "First sentence here. Second one."
    assert rows["b.org"].metadata.llm_provider == "rules" and rows["b.org"].contact_points == ["info@b.org"]
    assert rows["a.org"].metadata.llm_provider == "p2" and "refused" in rows["c.org"].company_overview
    assert "No answer stored" in rows["d.org"].company_overview
