"""Seeds, costs, exports, streams, joins under skew, and the shape of plans."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from derived_tables import load
from sitefacts import params, schemas
from sitefacts.operators import captures, contacts, costs, links, markdown, pages, profiles, responses
from sitefacts.plans import enrich as flow
from sitefacts.plans.skew import salted_join
from sitefacts.sources import seeds, tables
from sitefacts.streaming import costs as stream_costs

USAGE = "domain string, model_name string, prompt_tokens bigint, completion_tokens bigint"


def test_seed_file(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text(" a.org \n\n# no\n #kept\nhttps://B.org/\n", encoding="utf-8")
    found = seeds.read_seed_file(spark, str(tmp_path / "seeds.txt"))
    assert sorted(r.domain for r in found.collect()) == ["#kept", "a.org", "https://B.org/"]


def test_given_seeds(spark):
    assert [r.domain for r in seeds.given_seeds(spark, [" a.org ", " "]).collect()] == ["a.org"]
    assert seeds.given_seeds(spark).count() == len(params.DEFAULT_SEEDS)


@pytest.mark.parametrize(
    "model, prompt, completion, wanted",
    [
        ("gemini-1.5-flash", 1_000_000, 1_000_000, 0.375),
        ("gemini-1.5-flash", 2000, 500, 0.0003),
        ("gemini-3.6-flash", 1950, 317, 0.000241),
        ("gemini-3.6-flash", 5754, 281, 0.000516),
        ("gemini-3.6-flash", 2198, 208, 0.000227),
        ("never heard of", 1_000_000, 1_000_000, 0.75),
        ("gpt-4o", 0, 0, 0.0),
    ],
)
def test_costs(spark, model, prompt, completion, wanted):
    row = costs.usage_costs(spark.createDataFrame([("a.org", model, prompt, completion)], USAGE)).first()
    assert float(row.cost_usd) == wanted and row.total_tokens == prompt + completion


def test_totals_and_report(spark):
    calls = spark.createDataFrame([("a.org", "gemini-1.5-flash", 2000, 500), ("b.org", "gpt-4o", 1, 1)], USAGE)
    total = costs.usage_totals(costs.usage_costs(calls)).first()
    assert tuple(total)[:3] == (2001, 501, 2502) and float(total.cost_usd) == 0.000312 + 0.000001
    report = {r.domain: r for r in costs.cost_report(costs.usage_costs(calls)).collect()}
    assert tuple(report["TOTAL"]) == ("TOTAL", "-", "2,001", "501", "2,502", "$0.000313")
    assert costs.usage_costs(calls, tracking=False).count() == 0
    assert costs.usage_totals(costs.usage_costs(calls, tracking=False)).first().total_tokens == 0


def test_stream_adds_up_to_the_batch_and_goes_on_after_a_restart(spark, tmp_path):
    source, folder = tmp_path / "calls", str(tmp_path / "run")
    calls = [(f"d{i % 3}", "gpt-4o" if i % 2 else "x", i * 7, i) for i in range(60)]
    batch = lambda rows: spark.createDataFrame(rows, USAGE)
    batch(calls[:25]).write.parquet(str(source))
    stream = lambda: spark.readStream.schema(USAGE).parquet(str(source))
    first = stream_costs.final_totals(stream(), folder)
    as_rows = lambda df: sorted(tuple(r) for r in df.select("domain", "model_name", *costs.TOTALS, "cost_usd").collect())
    totals = lambda rows: as_rows(costs.usage_totals(costs.usage_costs(batch(rows)), "domain", "model_name"))
    assert as_rows(first) == totals(calls[:25])
    batch(calls[25:]).write.mode("append").parquet(str(source))
    assert as_rows(stream_costs.final_totals(stream(), folder)) == totals(calls)


def test_stream_keeps_a_store_in_proportion_to_its_keys(spark, tmp_path):
    source, folder = tmp_path / "calls", str(tmp_path / "run")
    calls = [(f"d{i % 7}", "gpt-4o" if i % 2 else "x", i * 7, i) for i in range(240)]
    for i in range(24):
        spark.createDataFrame(calls[i * 10 : i * 10 + 10], USAGE).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(USAGE).option("maxFilesPerTrigger", 1).parquet(str(source))
    found = stream_costs.final_totals(stream, folder, every=4)
    as_rows = lambda df: sorted(tuple(r) for r in df.select("domain", "model_name", *costs.TOTALS, "cost_usd").collect())
    expected = as_rows(costs.usage_totals(costs.usage_costs(spark.createDataFrame(calls, USAGE)), "domain", "model_name"))
    assert as_rows(found) == expected
    stored = stream_costs.stored_totals(spark, folder)
    assert stored.select("slot").distinct().count() == 2 + 4 and stored.count() <= (2 + 4) * 14
    before = as_rows(found)
    again = stored.where("slot = 'change3'")  # the last batch runs again, snapshot and all
    batch = again.first().batch
    stream_costs.store_batch(spark.createDataFrame(again.drop("slot", "batch").collect(), stream_costs.COLUMNS), batch, folder, 4)
    assert as_rows(stream_costs.latest_totals(stream_costs.stored_totals(spark, folder))) == before == expected


def test_stream_of_an_empty_source_has_no_totals(spark, tmp_path):
    source = tmp_path / "none"
    source.mkdir()
    stream = spark.readStream.schema(USAGE).parquet(str(source))
    assert stream_costs.final_totals(stream, str(tmp_path / "run")).count() == 0


@pytest.fixture(scope="module")
def stored(spark, sf):
    return entry_module.stored_profiles(spark, sf).cache()


def test_json_export(spark, stored, tmp_path):
    tables.write_json(stored, str(tmp_path / "j"))
    assert tables.read_json(spark, str(tmp_path / "j")).exceptAll(stored).count() == 0
    line = json.loads(next((tmp_path / "j").glob("*.json")).read_text(encoding="utf-8").splitlines()[0])
    assert list(line) == list(profiles.FIELDS)


def test_reading_an_array_file(spark, tmp_path):
    full = {
        "domain": "example.org", "company_name": "Example", "company_overview": "É.", "target_audience_icp": "D",
        "contact_points": ["a@b.org"], "key_leadership": [{"name": "A", "role": "B", "linkedin_url": None}],
        "data_confidence_score": 0.9, "confidence_reasoning": "r", "metadata": {"total_tokens": 1800},
    }
    (tmp_path / "a.json").write_text(json.dumps([full, full], indent=2, ensure_ascii=False), encoding="utf-8")
    found = tables.read_json(spark, str(tmp_path / "a.json"), array_file=True).collect()
    assert len(found) == 2 and found[0].metadata.total_tokens == 1800 and found[0].company_overview == "É."


def test_array_files_and_bad_records(spark, stored, tmp_path):
    tables.write_json_arrays(stored, str(tmp_path / "a"), rows=2)
    files = list((tmp_path / "a").glob("*/part-*"))
    assert len(files) > 1 and sum(len(json.loads(f.read_text(encoding="utf-8"))) for f in files) == stored.count()
    back = tables.read_json(spark, str(tmp_path / "a"), array_file=True)
    assert back.exceptAll(stored).count() == 0 and back.count() == stored.count()
    (tmp_path / "b.json").write_text('{"domain": "a.org"}\n{"domain": "b.org", "contact_points": 7}\nno json\n', encoding="utf-8")
    bad = tables.read_json(spark, str(tmp_path / "b.json"), bad_records="bad").cache()
    assert bad.count() == 3 and [r.domain for r in bad.where("bad is null").collect()] == ["a.org"]
    assert sorted(r.bad for r in bad.where("bad is not null").collect()) == ["no json", '{"domain": "b.org", "contact_points": 7}']


def test_typed_readers(spark, sf, tmp_path):
    for name, read, schema in (("pages", tables.read_pages, schemas.PAGES), ("responses", tables.read_responses, schemas.RESPONSES), ("hits", tables.read_hits, schemas.HITS)):
        rows = spark.createDataFrame([], schema)
        rows.write.parquet(str(tmp_path / name))
        assert read(spark, str(tmp_path / name)).schema.names == schema.names


def test_csv_export_keeps_quotes_and_line_breaks(spark, stored, tmp_path):
    odd = stored.withColumn("company_overview", F.lit('He said "a, b";\nnext line'))
    tables.write_csv(odd, str(tmp_path / "c"))
    back = tables.read_csv(spark, str(tmp_path / "c"))
    assert back.exceptAll(profiles.flat_profiles(odd)).count() == 0 and back.count() == odd.count()


def test_flat_form(spark):
    row = ("example.org", "E", "o", "D", ["a@b.org", "c@d.org"], [("Ada", "CEO", "https://u/in/ada"), ("Bo", "CTO", None)], 0.9, "r", None)
    flat = profiles.flat_profiles(spark.createDataFrame([row], schemas.PROFILE)).first()
    assert flat.key_leadership == "Ada (CEO) [https://u/in/ada]; Bo (CTO)" and flat.contact_points == "a@b.org; c@d.org"
    assert flat.total_tokens == 0 and flat.estimated_cost_usd == "$0.000000"


def test_confidence_bands(spark):
    df = spark.createDataFrame([(s,) for s in (0.7, 0.69, 0.4, 0.39)], "s double")
    assert [r.b for r in df.select(profiles.confidence_band(F.col("s")).alias("b")).collect()] == ["high", "medium", "medium", "low"]


def test_batch_has_one_row_per_seed_repeats_included(spark, sf):
    given = load(spark, sf, "seeds").select(F.col("raw_domain").alias("domain"))
    # a third of all seeds are one domain, and one site is unknown
    hot = given.limit(1).crossJoin(spark.range(6)).select("domain")
    many = given.unionByName(hot).unionByName(spark.createDataFrame([("nowhere.example.org",)], "domain string"))
    out = flow.enrich(
        many, load(spark, sf, "site_pages"), load(spark, sf, "model_responses").drop("site_id"),
        load(spark, sf, "search_hits").drop("site_id"), ["site_id", "n"],
    ).cache()
    assert out.count() == many.count()
    assert out.where(~F.col("data_confidence_score").between(0, 1)).count() == 0
    wanted = seeds.normalized_seeds(many).groupBy("domain").count()
    assert out.groupBy("domain").count().exceptAll(wanted).count() == 0
    assert "No answer stored" in out.where("domain = 'nowhere.example.org'").first().company_overview


def test_repeated_captures_of_a_url_count_once(spark, sf):
    site_pages = load(spark, sf, "site_pages")
    again = site_pages.unionByName(site_pages.withColumn("site_id", F.col("site_id") + 1000))
    sites = seeds.normalized_seeds(load(spark, sf, "seeds").select(F.col("raw_domain").alias("domain")))
    keys = ["site_id", "n"]
    once = flow.chosen_pages(sites, site_pages, keys).select("domain", "rank", "final_url")
    twice = flow.chosen_pages(sites, again, keys).select("domain", "rank", "final_url")
    assert once.exceptAll(twice).count() == 0 and once.count() == twice.count()


def test_salted_join_is_a_plain_join(spark):
    many = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    one = spark.range(0, 60, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner"):
        plain = many.join(one, ["k"], how)
        salted = salted_join(many, one, ["k"], ["id"], how)
        assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
        keys = salted_join(many, one, ["k"], ["id"], how).select(F.pmod(F.xxhash64("id"), F.lit(16)).alias("s"), "k")
        assert keys.where("k = 0").select("s").distinct().count() == 16 or how == "inner"


def test_repeated_blocks_on_a_busy_host(spark):
    body = "<p>This paragraph is on every page of the host.</p><p>Page {} has a sentence of its own here.</p>"
    rows = [(i, f"https://{'busy' if i < 9 else 'calm'}.org/{i}", body.format(i)) for i in range(11)]
    texts = markdown.main_texts(spark.createDataFrame(rows, "id int, url string, html string"), ["id"])
    for r in texts.collect():
        assert ("every page" in r.main_text) is (r.id >= 9 or r.id == 0) and f"Page {r.id} has" in r.main_text


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_work_needs_no_shuffle(spark, sf):
    given = spark.read.parquet(f"{sf}/pages.parquet")
    for df in (
        pages.pruned_html(given),
        contacts.with_contacts(given),
        links.top_links(given, ["page_id"]),
        markdown.markdown_lines(given, ["page_id"]),
        pages.html_spans(given, ["page_id"]),
        pages.element_texts(given, ["page_id"], params.LINE_TAGS),
        responses.records(load(spark, sf, "model_responses")),
    ):
        assert "Exchange" not in plan(df)


def test_only_small_inputs_are_spread(spark):
    assert tables.spread_small(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 8
    assert "Exchange" not in plan(tables.spread_small(spark.range(0, 100, 1, 9)))


def test_no_python_workers_anywhere(spark, sf):
    for name in ("page_markdown", "site_counters", "usage_totals", "leaders_enriched", "internal_links"):
        text = plan(entry_module.queries()[name](spark, sf))
        assert not re.findall(r"\b(?:\w*(?:InArrow|InPandas)|\w*EvalPython|\w*PythonUDTF)\b", text)


def test_names_of_python_operators_are_told_from_plan_texts(spark):
    """The test above must see a Python worker where there is one."""
    worker = spark.range(1).mapInArrow(lambda batches: batches, "id bigint")
    assert re.findall(r"\b(?:\w*(?:InArrow|InPandas)|\w*EvalPython|\w*PythonUDTF)\b", plan(worker))


def test_only_needed_columns_are_read(spark, sf):
    text = plan(pages.pruned_html(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html")))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in text
    assert "BroadcastHashJoin" in plan(costs.usage_costs(load(spark, sf, "usage")))


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.engine_queries()) <= set(entry_module.oracle_sql())
    assert len(entry_module.engine_queries()) >= 57


def test_outcomes_keep_their_rows(spark, sf):
    raw = load(spark, sf, "captures")
    out = captures.fetch_outcomes(raw)
    assert out.count() == raw.count()
    assert out.where("outcome = 'partial' and (status_code <> 408 or not success or html = '')").count() == 0
    assert out.where("outcome in ('timeout', 'error') and (success or html <> '')").count() == 0


def test_text_is_dealt_out_by_its_bytes(spark):
    """More partitions than cores, one of them with nearly all the text, as a large row group reads."""
    size = F.when(F.col("id") < 100, 1000).otherwise(1).cast("int")
    given = spark.range(0, 1000, 1, 10).select("id", F.repeat(F.lit("x"), size).alias("html"))
    found = tables.spread_text(given, "html", size=10_000)
    held = found.groupBy(F.spark_partition_id()).agg(F.sum(F.length("html")).alias("n")).collect()
    assert len(held) == 11 and max(r.n for r in held) <= 20_000
    assert sorted(found.collect()) == sorted(given.collect())
    assert "Exchange" not in plan(tables.spread_text(given, "html", size=200_000))
    empty = spark.createDataFrame([(1, None)], "id int, html string")
    assert tables.spread_text(empty, "html").collect() == empty.collect()
    assert tables.spread_text(empty.where("id > 1"), "html").count() == 0


def test_no_task_has_more_pages_as_input_grows(spark, tmp_path):
    """Both the pages that sites are made into and the given ones lie in one partition each, and in files of some bytes."""
    sites, pages_ = 20 * params.TASK_ROWS, 12 * params.TASK_BYTES // 100_000
    spark.range(0, sites, 1, 1).select(F.col("id").alias("s_suppkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    html = F.repeat(F.lit("x"), 100_000).alias("html")
    given = spark.range(0, pages_, 1, 1).select(F.col("id").alias("page_id"), F.lit("http://a.org/").alias("url"), html)
    given.write.parquet(str(tmp_path / "pages.parquet"))
    found = entry_module.all_pages(spark, str(tmp_path))
    held = found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("pages"), F.sum(F.octet_length("html")).alias("bytes")).collect()
    assert max(r.pages for r in held) <= 4 * params.TASK_ROWS * 1.1 and max(r.bytes for r in held) <= params.TASK_BYTES * 1.2
    assert sum(r.pages for r in held) == 4 * sites + pages_ == found.select("page").distinct().count()
