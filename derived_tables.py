"""Tables that Spark and DuckDB both derive from the given ones (see FIXTURES.md).

The given tables hold no mail links, profile links, answers or search hits; these queries make them, one
group of rows per supplier or conversation, so their size follows the size of the input. The text of each
query is the same for both engines except for the two short lists of constants.
"""

from __future__ import annotations

from sitefacts.sources import tables

SPARK_LISTS = {
    "{page_kinds}": "lateral view stack(4, 0, '', 1, '/about-us', 2, '/pricing', 3, '/contact') k as n, path",
    "{hit_ranks}": "lateral view explode(array(1, 2, 3, 4)) r as rank",
}
DUCKDB_LISTS = {
    "{page_kinds}": "cross join (values (0, ''), (1, '/about-us'), (2, '/pricing'), (3, '/contact')) k(n, path)",
    "{hit_ranks}": "cross join (values (1), (2), (3), (4)) r(rank)",
}

# Name -> (tables it reads, query)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "seeds": (
        ("supplier",),
        """
select s_suppkey as site_id,
       case s_suppkey % 4 when 0 then concat('  HTTPS://Site', cast(s_suppkey as string), '.example.org/ ')
                          when 1 then concat('http://site', cast(s_suppkey as string), '.example.org')
                          when 2 then concat('site', cast(s_suppkey as string), '.example.org//')
                          else concat('SITE', cast(s_suppkey as string), '.example.org') end as raw_domain,
       concat('site', cast(s_suppkey as string), '.example.org') as domain
from supplier
""",
    ),
    "site_pages": (
        ("seeds",),
        """
select site_id, n,
       concat('https://', domain, path) as url,
       concat('https://', domain, case when n = 0 then '/' else path end) as final_url,
       case when bad = 1 then 500 when n = 0 and site_id % 7 = 0 then 408 else 200 end as status_code,
       case when bad = 1 then '' when n = 0 then home else sub end as html,
       bad = 0 as success,
       case when bad = 1 then 'connection refused'
            when n = 0 and site_id % 7 = 0 then 'Partial content retrieved after timeout' end as error_message
from (
  select s.site_id, s.domain, k.n, k.path,
    case when k.n = 0 and s.site_id % 11 = 0 then 1 when k.n > 0 and (s.site_id + k.n) % 5 = 0 then 1 else 0 end as bad,
    concat('<!DOCTYPE html><html><head><title>', case when s.site_id % 13 = 0 then 'Just a moment...' else concat('Site ', cast(s.site_id as string), ' - Gauge works') end,
      '</title><style>h1{margin:0}</style><script>var t="</p>";ping("px@cdn.test");</script></head><body><header><nav>',
      '<a href="/">Start</a><a href="/about-us">The people here</a><a href="/pricing/">What it costs</a><a href="contact#form">Write to us</a>',
      '<a href="https://social.example.net/s">Social</a><a href="/team.png">Team logo</a><a href="javascript:void(0)">Help desk</a>',
      '<a href="https://docs.', s.domain, '/features?x=1">Features</a><a href="/blog">Blog</a></nav></header>',
      '<!-- note --><div class="consent-note"><div><p>Files are stored.</p></div></div><main><h1>River gauges of site ', cast(s.site_id as string),
      '</h1><p>Gauges &amp; loggers from one workshop. Crews fit them in an hour. Each has a spare.</p><h2>Typical users</h2><p>Weather stations.</p>',
      '<div id="promo-bar"><p>Spring offer</p></div><p aria-hidden="true">Ghost</p><p style="display: none">Unseen</p>',
      '<ul><li>Ada Example - CEO (<a href="https://www.linkedin.com/in/ada-', cast(s.site_id as string), '/?trk=1">profile</a>)</li></ul>',
      '<a href="https://de.linkedin.com/company/site-', cast(s.site_id as string), '">company</a></main>',
      '<footer>Mail <a href="mailto:Sales@', s.domain, '?subject=hi">sales</a> or info@', s.domain, ', caf&eacute;&frac12;&#146;s &Uuml;ber, ask&commat;', s.domain, ' tell&#64;', s.domain, ', user@', s.domain, ', x@example.com, icon@2x.png</footer></body></html>') as home,
    concat('<html><head><title>', k.path, '</title></head><body><h1>', k.path, '</h1><p>Page ', cast(k.n as string), ' of ', s.domain,
      '. Contact help@', s.domain, '.</p><table><tr><td>Plan</td><td>', cast(s.site_id * 10 + k.n as string), '</td></tr></table></body></html>') as sub
  from seeds s {page_kinds}
) x
""",
    ),
    "captures": (
        ("site_pages",),
        """
select site_id, n, url, final_url,
       case when success and status_code = 200 then case when (site_id + n) % 9 = 0 then 404 when (site_id + n) % 8 = 0 then null else 200 end end as http_status,
       status_code = 408 or (not success and n = 1) as timed_out,
       case when not success and n = 1 then '<html>short</html>' else html end as raw_html,
       case when not success and n <> 1 then 'connection refused' end as error
from site_pages
""",
    ),
    "model_responses": (
        ("seeds",),
        """
select site_id, domain, 'stored' as provider,
       case site_id % 3 when 0 then 'gpt-4o-mini' when 1 then 'gemini-1.5-flash' else 'unlisted-model' end as model_name,
       case v when 0 then concat('Here:', chr(10), fence, 'json', chr(10), '{', head, ov, icp, ct, ld, sc, '}', chr(10), fence)
              when 1 then concat('{', head, ov, icp, ct, ld, sc, '}')
              when 2 then concat('{', head, ov, icp)
              when 3 then concat('{', head, icp, ct, ld, sc, '}')
              when 4 then concat('{', head, ov, icp, ct, ld, '"data_confidence_score":1.7,"confidence_reasoning":"r"}')
              when 5 then concat('{', head, ov, icp, ct, '"key_leadership":[{"name":"  ","role":"CEO"}],', sc, '}')
              when 6 then concat('{', head, ov, icp, '"contact_points":null,', ld, sc, '}')
              when 7 then '[1,2]'
              when 8 then concat('{', head, ov, icp, '"contact_points":[],"key_leadership":[],', sc, '}')
              else concat('{', head, ov, icp, '"contact_points":[" INFO@', domain, '","info@', domain, '",""],"key_leadership":[{"name":" Ada Example ","role":" CEO ","linkedin_url":"ada-x/"},{"name":"Bo Sample","role":"CTO","linkedin_url":null}],', sc, '}') end as raw_json,
       1000 + site_id * 7 as prompt_tokens, 100 + site_id % 50 as completion_tokens
from (select site_id, domain, site_id % 10 as v, concat(chr(96), chr(96), chr(96)) as fence,
        concat('"domain":"other.example.net","company_name":"Site ', cast(site_id as string), '",') as head,
        '"company_overview":"It builds data pipelines. Teams load tables fast.",' as ov,
        '"target_audience_icp":"Data engineers and analysts.",' as icp,
        concat('"contact_points":["info@', domain, '"],') as ct,
        concat('"key_leadership":[{"name":"Ada Example","role":"CEO","linkedin_url":"https://www.linkedin.com/in/ada-', cast(site_id as string), '/"}],') as ld,
        '"data_confidence_score":0.75,"confidence_reasoning":"r"' as sc
      from seeds) x
""",
    ),
    "search_hits": (
        ("seeds",),
        """
select s.site_id,
       case when s.site_id % 10 = 8 then concat('Site ', cast(s.site_id as string), ' founder CEO linkedin')
            else concat('Bo Sample Site ', cast(s.site_id as string), ' linkedin') end as query,
       r.rank,
       case when r.rank = 3 and s.site_id % 20 <> 19 then concat('https://de.linkedin.com/in/bo-', cast(s.site_id as string), '/')
            when r.rank = 4 then 'https://www.linkedin.com/in/late' else 'https://www.linkedin.com/in/jobs' end as href,
       case r.rank when 1 then 'Directory' when 2 then 'Bo Sample - CTO at Site | LinkedIn' when 3 then 'Bo Sample | LinkedIn' else 'Late' end as title,
       case when r.rank = 2 and s.site_id % 4 < 2 then concat('see https://linkedin.com/in/bo_', cast(s.site_id as string), ' now') else 'nothing' end as body
from seeds s {hit_ranks}
where s.site_id % 10 >= 8
""",
    ),
    "usage": (
        ("conversations",),
        """
select concat('conv', cast(conv_id as string), '.example.org') as domain,
       case conv_id % 9 when 0 then 'gemini-3.6-flash' when 1 then 'gemini-1.5-flash' when 2 then 'gemini-1.5-pro' when 3 then 'gemini-2.0-flash'
                        when 4 then 'gpt-4o-mini' when 5 then 'gpt-4o' when 6 then 'llama-3.3-70b-versatile' when 7 then 'llama-3.1-8b-instant'
                        else 'unlisted-model' end as model_name,
       cast(sum(case when role <> 'assistant' then length(text) else 0 end) as bigint) as prompt_tokens,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as completion_tokens
from conversations group by conv_id
""",
    ),
}


def query(name: str, lists: dict[str, str]) -> str:
    text = TABLES[name][1]
    for mark, fragment in lists.items():
        text = text.replace(mark, fragment)
    return text


def needed(name: str) -> list[str]:
    """Derived tables behind ``name``, in the order they must be made, itself last."""
    order: list[str] = []
    for source in TABLES[name][0]:
        if source in TABLES:
            order += [t for t in needed(source) if t not in order]
    return [*order, name]


def with_clauses(*names: str) -> str:
    """``name as (query), ...`` for the derived tables a DuckDB query uses."""
    order: list[str] = []
    for name in names:
        order += [t for t in needed(name) if t not in order]
    return ",\n".join(f"{t} as ({query(t, DUCKDB_LISTS)})" for t in order)


def load(spark, sf_dir: str, name: str):
    """A given or derived table as a DataFrame."""
    if name not in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sources, _ = TABLES[name]
    for source in sources:
        rows = load(spark, sf_dir, source)
        # A small table that whole sites are made of: dealt out before, as its few files would be as few tasks.
        rows = tables.spread_rows(rows.select("s_suppkey")) if source == "supplier" else rows
        rows.createOrReplaceTempView(source)
    return spark.sql(query(name, SPARK_LISTS))
