"""Queries over evidence, captures, batches and texts, with their SQL counterparts.

plans.catalogue holds the others and the registry.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from evigrade import engine
from evigrade.functions import html as H
from evigrade.functions import text as T
from evigrade.functions import urls as U
from evigrade.functions import vocab
from evigrade.functions.register import register
from evigrade.operators import batch, capture, evidence, images, planner, quality, render
from evigrade.operators import manifests as M
from evigrade.plans import catalogue
from evigrade.plans import synthetic as S
from evigrade.plans.catalogue import load, query
from evigrade.sources import sinks

# --- evidence ---
_ASKED = """SELECT concat('p', CAST(p_partkey AS STRING)) AS scrape_id, p_partkey, concat('https://shop.example.com/item/', CAST(p_partkey AS STRING)) AS url,
  concat('https://shop.example.com/item/', CAST(p_partkey AS STRING)) AS final_url, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END AS title,
  CASE WHEN p_partkey % 6 = 0 THEN 'https://shop.example.com/c' ELSE '' END AS canonical_url, p_type AS description,
  CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END AS main_text, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE CAST(40000000 + p_partkey AS STRING) END AS ean,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'Shop' END AS requested_retailer_name, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'DE' END AS requested_country_code,
  CASE WHEN p_partkey % 7 = 0 THEN 'seen in search' ELSE '' END AS ai_mode_evidence, '' AS upstream_evidence_notes,
  CASE WHEN p_partkey % 9 = 0 THEN '' ELSE concat('brand price ', p_name) END AS raw_markdown, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE '<p>x</p>' END AS raw_html,
  CASE WHEN p_partkey % 8 = 0 THEN 'access_denied' ELSE 'accessible' END AS access_status, p_partkey % 10 <> 0 AS success, p_partkey % 11 = 0 AS proxy_used,
  CAST(p_partkey % 2 AS INT) AS n_json_ld, CAST(CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS INT) AS n_tables, CAST(0 AS INT) AS n_og, CAST(0 AS INT) AS n_meta, CAST(1 AS INT) AS n_images,
  CAST(CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 70 END AS INT) AS capture_score, CASE WHEN p_partkey % 3 = 1 THEN 'weak' ELSE 'usable' END AS capture_grade, true AS real_scrape_evidence
FROM {part}"""


def _evidence(spark, sf):
    rows = S.make(spark, sf, _ASKED)
    k = F.col("p_partkey")
    table = F.struct(F.lit(1).alias("index"), F.lit("Facts").alias("caption"), F.lit(1).alias("n_rows"), F.lit(1).alias("n_columns"), F.lit("| a |").alias("markdown"))
    seen = F.when(k % 4 == 1, "a toy").otherwise("")
    image = F.struct(F.lit("x/1.jpg").alias("local_path"), F.lit("alt").alias("alt"), F.lit("yes").alias("relevance"), seen.alias("description"))
    item = "array<struct<source_type:string,title:string,url:string,text:string,evidence_id:string,confidence:string>>"
    none = F.array().cast("array<string>")
    rows = rows.withColumns(
        {
            "tables": F.when(k % 3 == 0, F.array(table)).otherwise(F.slice(F.array(table), 1, 0)),
            "images": F.array(image),
            "json_ld": F.when(k % 2 == 1, F.array(F.lit("{}"))).otherwise(none),
            "og": F.from_json(F.lit("{}"), "map<string,string>"),
            "product_meta": F.from_json(F.lit("{}"), "map<string,string>"),
            "candidate_snippets": none,
            "search_evidence": F.array().cast(item),
            "weak_reasons": none,
        }
    )
    return evidence.recovery_report(evidence.build_evidence(evidence.capture_health(rows)))


_HEALTH = f"""
a AS (SELECT *, lower(concat_ws(chr(10), trim(title), raw_markdown, left(raw_html, 20000))) AS t, length(raw_markdown) AS md, length(raw_html) AS hl,
  n_json_ld + n_tables AS st FROM ({S.for_oracle(_ASKED)})),
b AS (SELECT *, {catalogue._count('t', vocab.HEALTH_PRODUCT_TERMS)} AS products, {catalogue._count('t', vocab.HEALTH_BLOCK_TERMS)} AS blocks, title = '' AS generic FROM a),
c AS (SELECT *, concat_ws('; ', CASE WHEN access_status <> 'accessible' THEN 'access_status=' || access_status END, CASE WHEN blocks > 0 THEN 'soft_block_terms_detected' END,
  CASE WHEN st = 0 THEN 'very_low_text_and_no_structured_evidence' END, CASE WHEN generic THEN 'generic_or_missing_title_with_low_text' END,
  CASE WHEN products < 2 AND st = 0 THEN 'few_product_signals' END) AS reasons FROM b),
d AS (SELECT *, success AND access_status = 'accessible' AND CASE WHEN capture_score <> 0 THEN capture_grade <> 'weak' ELSE reasons = '' END AS visible FROM c),
e AS (SELECT *, CASE WHEN visible THEN 'product_visible' WHEN success OR md > 0 THEN 'weak_capture' ELSE 'not_captured' END AS capture_status,
  main_text <> '' OR ean <> '' OR requested_retailer_name <> '' AS asked FROM d)"""


@query(f"""WITH {_HEALTH} SELECT scrape_id, capture_status, visible AS browser_product_visible, products AS product_signal_count, blocks AS block_signal_count,
  generic AS generic_title, st AS structured_signal_count, reasons FROM e""")
def capture_health(spark, sf):
    return _evidence(spark, sf).select(
        "scrape_id", "capture_status", "browser_product_visible", "product_signal_count", "block_signal_count", "generic_title",
        "structured_signal_count", F.array_join("health_reasons", "; ").alias("reasons"),
    )


def _one(name: str, axis: str, scope: str, where: str, attribute: str = "''") -> str:
    return f"SELECT scrape_id, '{name}' AS claim_list, 1 AS position, {attribute} AS attribute, '{axis}' AS axes, '' AS confidence, '{scope}' AS claim_scope FROM e WHERE {where}"


_FACTS = (
    ("product_name", "true", "CASE WHEN main_text <> '' THEN 'I' ELSE 'U' END", "CASE WHEN main_text <> '' THEN 'high' ELSE 'low' END"),
    ("ean_gtin", "ean <> ''", "'I'", "'high'"),
    ("source_url", "true", "'U'", "'high'"),
    ("source_url_identifiers", "false", "''", "''"),
    ("page_title", "title <> ''", "'S,T'", "CASE WHEN visible THEN 'medium' ELSE 'low' END"),
    ("canonical_url", "canonical_url <> ''", "'S'", "'medium'"),
    ("requested_retailer", "requested_retailer_name <> ''", "'I'", "'high'"),
    ("requested_country", "requested_country_code <> ''", "'I'", "'high'"),
)
_CLAIMS = " UNION ALL ".join(
    [
        _one("structured_claims", "S", "", "true"),
        _one("table_claims", "D", "", "p_partkey % 3 = 0", "'Facts'"),
        _one("visual_claims", "V", "", "p_partkey % 4 = 1", "'1.jpg'"),
        _one("upstream_indexed_claims", "A", "", "ai_mode_evidence <> ''"),
        _one("url_derived_claims", "U", "url_provenance_not_browser_text", "true"),
        _one("input_context_claims", "I", "input_context_provenance", "asked"),
        *[
            f"SELECT scrape_id, 'product_identity', {i}, '{key}', CASE WHEN {there} THEN {axis} ELSE '' END, CASE WHEN {there} THEN {sure} ELSE 'missing' END, 'product_identity' FROM e"
            for i, (key, there, axis, sure) in enumerate(_FACTS, 1)
        ],
    ]
)


@query(f"WITH {_HEALTH} {_CLAIMS}")
def claims_exploded(spark, sf):
    rows = evidence.iterate_claims(_evidence(spark, sf))
    return rows.select("scrape_id", "claim_list", "position", "attribute", F.array_join("evidence_axis", ",").alias("axes"), "confidence", "claim_scope")


@query(f"""WITH {_HEALTH} SELECT scrape_id, 2 + CAST(p_partkey % 3 = 0 AS INT) + CAST(p_partkey % 4 = 1 AS INT) + CAST(ai_mode_evidence <> '' AS INT) + CAST(asked AS INT) AS n_claims,
  1 + CAST(asked AS INT) + CAST(ai_mode_evidence <> '' AS INT) AS n_blocks,
  concat_ws(',', CASE WHEN ai_mode_evidence <> '' THEN 'A' END, CASE WHEN p_partkey % 3 = 0 THEN 'D' END, CASE WHEN asked THEN 'I' END, 'S', CASE WHEN title <> '' THEN 'T' END, 'U', CASE WHEN p_partkey % 4 = 1 THEN 'V' END) AS axes,
  CASE WHEN visible THEN 'browser_primary' WHEN proxy_used THEN 'proxy_primary' WHEN ai_mode_evidence <> '' THEN 'upstream_recovery' WHEN p_partkey % 2 = 1 THEN 'metadata_recovery' ELSE 'recovered' END AS recovery_status,
  concat_ws(',', CASE WHEN visible THEN 'browser_rendered_page' END, CASE WHEN proxy_used THEN 'target_country_proxy' END, CASE WHEN md > 0 THEN 'rendered_markdown,html_signal' END, CASE WHEN p_partkey % 2 = 1 THEN 'json_ld' END,
    'image_urls_or_gallery,product_url_input', CASE WHEN ai_mode_evidence <> '' THEN 'upstream_indexed_search_ai_evidence' END) AS recovery_sources,
  true AS recovered, md > 0 OR p_partkey % 2 = 1 OR ai_mode_evidence <> '' OR asked AS recoverable, ean, 7 AS n_noise, CASE WHEN asked THEN 'yes' ELSE 'no' END AS has_context FROM e""")
def evidence_summary(spark, sf):
    rows = _evidence(spark, sf)
    return rows.select(
        "scrape_id",
        evidence.claim_counts()["n_claims"].alias("n_claims"),
        F.size("product_only_text_blocks").alias("n_blocks"),
        F.array_join("evidence_axes_used", ",").alias("axes"),
        "recovery_status",
        F.array_join("recovery_sources", ",").alias("recovery_sources"),
        F.col("product_details_recovered").alias("recovered"),
        evidence.recoverable().alias("recoverable"),
        evidence.identity_value("ean_gtin").alias("ean"),
        F.size(evidence.noise_report()["excluded_categories"]).alias("n_noise"),
        F.when(batch.prompt_block() != "", "yes").otherwise("no").alias("has_context"),
    )


@query(f"""WITH {_HEALTH} SELECT scrape_id, '| Field | Value |' || chr(10) || '| ' || CASE WHEN asked THEN 'Caller' ELSE 'URL' END AS first_cells FROM e""")
def source_views(spark, sf):
    text = render.source_markdown()
    head = F.regexp_extract(text, r"\| 1 \| (\S+?)[- ]", 1)
    made = F.concat(F.lit("| Field | Value |\n| "), head)
    return _evidence(spark, sf).select("scrape_id", made.alias("first_cells"))


@query(f"""WITH {_HEALTH} SELECT scrape_id, 9 AS n_sections, 6 - CAST(p_partkey % 3 = 0 AS INT) - CAST(p_partkey % 4 = 1 AS INT) - CAST(ai_mode_evidence <> '' AS INT) - CAST(asked AS INT) AS n_empty, '| ean_gtin | ' || CASE WHEN ean <> '' THEN ean ELSE '(missing)' END || ' | ' || CASE WHEN ean <> '' THEN 'I' ELSE '' END || ' |' AS ean_row FROM e""")
def evidence_views(spark, sf):
    text = render.evidence_markdown()
    return _evidence(spark, sf).select(
        "scrape_id",
        F.regexp_count(text, F.lit("(?m)^## ")).alias("n_sections"),
        F.regexp_count(text, F.lit("(?m)^\\| Not captured \\|")).alias("n_empty"),
        F.regexp_extract(text, r"(?m)^(\| ean_gtin \| [^|]* \| [^|]*\|)", 1).alias("ean_row"),
    )


@query(f"""WITH {_HEALTH} SELECT scrape_id, 'image' AS kind, 1 AS index, '1.jpg' AS path, 'alt' AS label FROM e
  UNION ALL SELECT scrape_id, 'table', 1, 'tables/table_001.md', 'Facts' FROM e WHERE p_partkey % 3 = 0""")
def manifests(spark, sf):
    rows = _evidence(spark, sf)
    pictures = M.image_manifest(rows, "x").select("scrape_id", F.lit("image").alias("kind"), "index", "path", F.col("alt").alias("label"))
    return pictures.union(M.table_manifest(rows).select("scrape_id", F.lit("table"), "index", "path", "caption"))


@query(f"""WITH {_HEALTH} SELECT scrape_id, CASE WHEN title <> '' THEN title END AS title, n_json_ld AS json_ld_count, capture_grade FROM e""")
def metadata_payloads(spark, sf):
    rows = _evidence(spark, sf).withColumns({"capture_decision": F.lit(""), "fetch_profile": F.lit("standard")})
    made = rows.select("scrape_id", M.metadata_payload().alias("m"))
    return made.select("scrape_id", F.nullif("m.title", F.lit("")).alias("title"), "m.json_ld_count", "m.capture_grade")


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://a.example.com/x/b.jpg' WHEN 1 THEN 'https://a.example.com/b.jpg' WHEN 2 THEN 'https://c.example.com/d' ELSE 'https://a.example.com/x/y?q=1' END AS joined FROM pages""")
def joined_urls(spark, sf):
    register(spark)
    load(spark, sf, "pages").createOrReplaceTempView("evigrade_pages")
    return spark.sql("""SELECT page_id, join_url('https://a.example.com/x/y', CASE page_id % 4 WHEN 0 THEN 'b.jpg' WHEN 1 THEN '/b.jpg'
      WHEN 2 THEN '//c.example.com/d' ELSE '?q=1' END) AS joined FROM evigrade_pages""")


# --- quality gate in full ---
_GATED = f"""WITH g AS (SELECT *, p_partkey % 3 <> 2 AS nm, p_partkey % 3 = 0 AS br, url <> '' AS ur, n_clean > 0 AS vis, n_screenshots > 0 AS sh, product_text_chars >= 80 AS tx, n_structured > 0 AS st, n_axes > 0 AS ax FROM ({S.for_oracle(catalogue._GATE)}))"""


@query(f"""{_GATED} SELECT p_partkey, concat_ws('|', CASE WHEN NOT nm THEN 'product_name_or_title' END, CASE WHEN NOT br THEN 'brand_or_manufacturer_signal' END, CASE WHEN NOT ur THEN 'retailer_url' END, CASE WHEN NOT vis THEN 'visual_product_image' END,
  CASE WHEN NOT tx AND NOT st AND NOT vis THEN 'product_evidence_content' END, CASE WHEN NOT ax THEN 'evidence_axis_tags' END) AS missing,
  concat_ws('|', CASE WHEN n_errors > 0 AND n_downloaded < 3 THEN 'image download success rate is low' END, CASE WHEN NOT vis THEN '{vocab.GATE_WARNINGS[2]}' END, CASE WHEN sh THEN '{vocab.GATE_WARNINGS[3]}' END,
  CASE WHEN n_described = 0 THEN '{vocab.GATE_WARNINGS[4]}' END, CASE WHEN n_tables = 0 THEN '{vocab.GATE_WARNINGS[5]}' END, CASE WHEN NOT real_scrape_evidence THEN '{vocab.GATE_WARNINGS[8]}' END,
  CASE WHEN capture_grade = 'weak' THEN '{vocab.GATE_WARNINGS[9].replace("%s", "weak")}' END, CASE WHEN capture_decision = 'mixed_capture_needs_review' THEN 'capture decision is mixed_capture_needs_review' END) AS warnings,
  concat_ws('|', CASE WHEN NOT nm OR (NOT tx AND NOT st AND NOT vis) THEN '{vocab.GATE_FOLLOWUPS[0]}' END, CASE WHEN NOT vis THEN '{vocab.GATE_FOLLOWUPS[1]}' END, CASE WHEN sh THEN '{vocab.GATE_FOLLOWUPS[2]}' END,
  CASE WHEN n_described = 0 THEN '{vocab.GATE_FOLLOWUPS[3]}' END, '{vocab.GATE_FOLLOWUPS[6]}') AS followups, br AS has_brand_signal, real_scrape_evidence AS access_ok FROM g""")
def quality_report(spark, sf):
    done = quality.quality_gate(S.make(spark, sf, catalogue._GATE))
    return done.select(
        "p_partkey",
        F.array_join("missing_critical_fields", "|").alias("missing"),
        F.array_join("quality_warnings", "|").alias("warnings"),
        F.array_join("recommended_followups", "|").alias("followups"),
        F.col("checks.has_brand_signal").alias("has_brand_signal"),
        F.col("checks.browser_access_ok_or_recovered").alias("access_ok"),
    )


# --- captures ---
@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'standard' WHEN 1 THEN 'load_wait,standard' WHEN 2 THEN 'standard,retry_relaxed,shadow_iframe' ELSE 'standard,full_page_scroll' END AS sequence,
  CASE p_partkey % 4 WHEN 0 THEN 'standard' WHEN 1 THEN 'standard,load_wait' WHEN 2 THEN 'standard,retry_relaxed,shadow_iframe' ELSE 'standard,full_page_scroll' END AS preferred,
  CASE p_partkey % 3 WHEN 0 THEN 'full_page_scroll' WHEN 1 THEN 'retry_relaxed' END AS choice, p_partkey % 4 IN (1, 2) AND p_partkey % 3 <> 0 AS proxy FROM part""")
def profile_plans(spark, sf):
    k = F.col("p_partkey")
    wanted = F.when(k % 4 == 0, "").when(k % 4 == 1, "LOAD_WAIT; standard, load_wait").when(k % 4 == 2, "retry_relaxed shadow_iframe nonsense load_wait").otherwise("full_page_scroll")
    preferred = F.when(k % 4 == 3, "shadow_iframe").otherwise("standard")
    step = lambda name, p: F.struct(F.lit(name).alias("action"), F.lit(p).alias("priority"))
    actions = F.array(step("stop", 0), step("retry_relaxed", 2), step("full_page_scroll", 1), step("extract_gallery_sources", 2))
    used = F.when(k % 3 == 0, F.array().cast("array<string>")).when(k % 3 == 1, F.array(F.lit("full_page_scroll")))
    used = used.otherwise(F.array(*map(F.lit, vocab.PLANNER_ACTIONS)))
    issue = F.when(k % 4 == 1, "geo_restricted").when(k % 4 == 2, "fetch_error").otherwise("none")
    return load(spark, sf, "part").select(
        "p_partkey",
        F.array_join(capture.profile_sequence(wanted, 3), ",").alias("sequence"),
        F.array_join(capture.profile_sequence(wanted, 3, preferred), ",").alias("preferred"),
        capture.planner_choice(actions, used).alias("choice"),
        capture.needs_proxy(issue, F.when(k % 3 == 0, "").otherwise("http://p"), True).alias("proxy"),
    )


_ATTEMPTS = """SELECT CAST(user_id AS STRING) AS scrape_id, 'standard' AS profile, event_id AS attempt_no, 'direct' AS attempt, false AS proxy_used, ' de' AS target_country_code,
  CAST(CASE event_id % 5 WHEN 0 THEN 451 WHEN 1 THEN 429 WHEN 2 THEN 503 ELSE 200 END AS INT) AS status, event_id % 2 = 0 AS success, '' AS raw_html,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS raw_markdown, CASE WHEN event_id % 7 = 0 THEN 'net' ELSE '' END AS error FROM {events}"""


@query(f"""WITH a AS (SELECT *, CASE status WHEN 451 THEN 'geo_restricted' WHEN 429 THEN 'rate_limited' WHEN 503 THEN 'server_error' ELSE CASE WHEN error <> '' AND raw_markdown = '' THEN 'fetch_error' ELSE 'none' END END AS issue,
  status <> 200 OR (NOT success AND raw_markdown = '') AS transient FROM ({S.for_oracle(_ATTEMPTS)}))
SELECT scrape_id, count(*) AS attempts, string_agg(issue || ':' || length(raw_markdown), ',' ORDER BY attempt_no) AS log, count(*) FILTER (transient) AS transient FROM a GROUP BY scrape_id""")
def attempt_logs(spark, sf):
    rows = S.make(spark, sf, _ATTEMPTS)
    log = capture.attempt_log(rows)
    line = F.transform("access_attempts", lambda a: F.concat(a["access_issue_type"], F.lit(":"), a["markdown_chars"]))
    again = rows.groupBy("scrape_id").agg(F.count_if(capture.is_transient(rows)).alias("transient"))
    found = log.select("scrape_id", F.size("access_attempts").cast("long").alias("attempts"), F.array_join(line, ",").alias("log"))
    return found.join(again, "scrape_id")


_PRIMARY = """SELECT concat('p', CAST(p_partkey AS STRING)) AS scrape_id, p_partkey % 2 = 0 AS success, CAST(p_partkey % 3 AS INT) AS status, '' AS error, '' AS final_url,
  CASE p_partkey % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN 'access_denied' ELSE 'accessible' END AS access_status, 'none' AS access_issue_type, false AS geo_restricted, false AS proxy_used,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS title, '' AS description, '' AS canonical_url, concat(p_name, ' text ') AS raw_markdown, '<a>' AS raw_html, 'standard' AS fetch_profile FROM {part}"""
_EXTRA = """SELECT concat('p', CAST(p_partkey AS STRING)) AS scrape_id, true AS success, CAST(200 AS INT) AS status, 'late' AS error, 'https://f' AS final_url,
  CASE WHEN p_partkey % 6 = 0 THEN 'bot_challenge' ELSE 'accessible' END AS access_status, 'x' AS access_issue_type, false AS geo_restricted, true AS proxy_used,
  'other' AS title, 'told' AS description, '' AS canonical_url, CASE p_partkey % 3 WHEN 0 THEN 'text' WHEN 1 THEN ' more ' ELSE '' END AS raw_markdown, '<a>' AS raw_html, 'load_wait' AS fetch_profile FROM {part} WHERE p_partkey % 10 <> 0"""


@query(f"""WITH j AS (SELECT p.*, e.scrape_id IS NOT NULL AS has, e.raw_markdown AS more, e.access_status AS ea, e.success AS es FROM ({S.for_oracle(_PRIMARY)}) p LEFT JOIN ({S.for_oracle(_EXTRA)}) e USING (scrape_id))
SELECT scrape_id, success OR has AS success, CASE WHEN has AND status = 0 THEN 200 ELSE status END AS status, CASE WHEN has THEN 'late' ELSE '' END AS error,
  CASE WHEN has AND ((access_status <> 'accessible' AND ea = 'accessible') OR access_status = 'unknown') THEN ea ELSE access_status END AS access_status,
  has AND ((access_status <> 'accessible' AND ea = 'accessible') OR access_status = 'unknown') AS proxy_used, CASE WHEN has AND title = '' THEN 'other' ELSE title END AS title,
  CASE WHEN has AND trim(more) <> '' AND NOT contains(raw_markdown, more) THEN rtrim(raw_markdown) || chr(10) || chr(10) || '---' || chr(10) || chr(10) || trim(more) ELSE raw_markdown END AS raw_markdown,
  '<a>' AS raw_html, CASE WHEN has THEN 'u1=a,u2=c' ELSE 'u1=a' END AS images, CASE WHEN has THEN 'standard,load_wait' ELSE 'standard' END AS profiles, CASE WHEN has THEN '2' ELSE '1' END AS og FROM j""")
def followup_merge(spark, sf):
    picture = lambda u, a: F.struct(F.lit(u).alias("url"), F.lit(a).alias("alt"))
    none = F.array().cast("array<string>")

    def whole(sql, pictures, og, profiles):
        return S.make(spark, sf, sql).withColumns(
            {"images": F.array(*pictures), "og": F.create_map(F.lit("og:x"), F.lit(og)), "product_meta": F.from_json(F.lit("{}"), "map<string,string>"),
             "json_ld": none, "tables_html": none, "profiles": profiles}
        )

    a = whole(_PRIMARY, [picture("u1", "a")], "1", F.array(F.lit("standard")))
    b = whole(_EXTRA, [picture("u1", "b"), picture("u2", "c")], "2", none)
    merged = planner.merge_followups(a, b)
    shown = F.array_join(F.transform("images", lambda i: F.concat(i["url"], F.lit("="), i["alt"])), ",")
    return merged.select(
        "scrape_id", "success", "status", "error", "access_status", "proxy_used", "title", "raw_markdown", "raw_html", shown.alias("images"),
        F.array_join("profiles", ",").alias("profiles"), F.col("og")["og:x"].alias("og"),
    )


# --- HTML ---
@query("""SELECT p_partkey, 'https://shop.example.com/img/' || p_partkey || '.jpg=' || p_name || ';https://shop.example.com/a/' || p_size || '.png=' || p_name || ';https://shop.example.com/b/' || p_size || '.png=' || p_name
  || ';https://cdn.example.com/z/' || p_size || '.webp?w=1=regex/image-url;https://cdn.example.com/hero=og:image' AS images FROM part""")
def image_union(spark, sf):
    pages = S.make(spark, sf, S.PAGES)
    more = F.concat(F.lit("<!-- https://cdn.example.com/z/"), F.regexp_extract("html", r"/a/(\d+)\.png", 1), F.lit(".webp?w=1 -->"))
    hero = F.lit('<meta property="og:image" content="https://cdn.example.com/hero">')
    pages = pages.withColumn("html", F.concat("html", more, hero))
    shown = F.transform("images", lambda i: F.concat(i["url"], F.lit("="), i["alt"]))
    return H.all_images(pages, "p_partkey").select("p_partkey", F.array_join(shown, ";").alias("images"))


@query("""SELECT p_partkey, p_name AS name, 1 AS n_offers, CAST(p_size AS VARCHAR) AS price, 'EUR' AS currency, 'https://schema.org/InStock' AS availability, '' AS sku FROM part""")
def jsonld_offers(spark, sf):
    found = H.json_ld_offers(S.make(spark, sf, S.PAGES), "p_partkey")
    one = F.get("offers", F.lit(0))
    return found.select(
        "p_partkey", "name", F.size("offers").alias("n_offers"), one["price"].alias("price"), one["priceCurrency"].alias("currency"),
        one["availability"].alias("availability"), one["sku"].alias("sku"),
    )


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'given' ELSE trim(p_name) END AS title, p_type AS description, p_name AS og_title, CASE WHEN p_partkey % 2 = 0 THEN 'kept' END AS og_site, p_brand AS brand FROM part""")
def metadata_overlay(spark, sf):
    given = F.create_map(F.lit("title"), F.lit("given"), F.lit("OG:site"), F.lit("kept"), F.lit("og:title"), F.lit("lost"))
    given = F.when(F.col("p_partkey") % 2 == 0, given).otherwise(F.from_json(F.lit("{}"), "map<string,string>"))
    meta = H.overlay_metadata(given, "html")
    return S.make(spark, sf, S.PAGES).select(
        "p_partkey", meta["title"].alias("title"), meta["description"].alias("description"), meta["og"]["og:title"].alias("og_title"),
        meta["og"]["og:site"].alias("og_site"), meta["product_meta"]["product:brand"].alias("brand"),
    )


# --- images ---
@query("""SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'http 404' WHEN 1 THEN 'non-image response mime=text/html status=200' WHEN 2 THEN 'svg/vector image excluded from final product image set'
  WHEN 3 THEN 'invalid image payload: UnidentifiedImageError' ELSE '' END AS error, CASE doc_id % 7 WHEN 4 THEN '.jpg' WHEN 5 THEN '.png' WHEN 6 THEN '.png' ELSE '' END AS extension, doc_id % 7 = 6 AS converts,
  CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'text/html' WHEN 2 THEN 'image/svg+xml' WHEN 3 THEN 'image/png' WHEN 4 THEN 'image/jpeg' WHEN 5 THEN '' ELSE 'image/png' END AS mime,
  CASE WHEN doc_id % 7 <> 0 THEN left(sha1('pixels ' || doc_id), 8) END AS sha8 FROM documents""")
def payload_checks(spark, sf):
    k = F.col("doc_id") % 7
    rows = load(spark, sf, "documents").select(
        "doc_id",
        F.when(k != 0, F.concat(F.lit("pixels "), "doc_id").cast("binary")).alias("content"),
        F.when(k == 1, "text/html; charset=utf-8").when(k == 2, "image/svg+xml").when(k == 3, "image/png").when(k == 4, "IMAGE/JPEG").when(k == 6, "image/avif").otherwise("").alias("content_type"),
        F.when(k == 0, 404).otherwise(200).alias("status"),
        F.lit("").alias("last_error"),
        F.when(k == 4, "JPEG").when(k == 5, "PNG").when(k == 6, "AVIF").alias("decoded_format"),
    )
    return images.checked_payloads(rows).select("doc_id", "error", "extension", "converts", "mime", "sha8")


@query(f"""WITH c AS (SELECT scrape_id, left(split_part(error, ':', 1), 40) AS bucket, count(*) AS n, min(ordinal) AS f FROM ({S.for_oracle(S.IMAGES)}) WHERE error <> '' GROUP BY ALL)
SELECT scrape_id, CAST(place AS INT) AS place, bucket, n FROM (SELECT *, row_number() OVER (PARTITION BY scrape_id ORDER BY n DESC, f) AS place FROM c) WHERE place <= 3""")
def image_error_top(spark, sf):
    return images.top_errors(S.make(spark, sf, S.IMAGES))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'yes,no,' WHEN 1 THEN ',yes,no' ELSE ',,' END AS verdicts, CASE p_partkey % 3 WHEN 0 THEN 'c' WHEN 1 THEN 'a' ELSE 'a,b,c' END AS retry FROM part""")
def relevance_replies(spark, sf):
    k = F.col("p_partkey") % 3
    reply = F.when(k == 0, "- 1: yes\n* 2) NO\nnothing").when(k == 1, "(3). no\n2. Yes\n2 maybe\n9: yes").otherwise("no idea")
    reply = F.regexp_replace(reply, r"\(3\)\. no", "(3) no")
    found = T.numbered_verdicts(reply, 3)
    names = F.array(*map(F.lit, "abc"))
    again = F.transform(images.retry_batches(names, names, names, found), lambda z: z["ref"])
    return load(spark, sf, "part").select("p_partkey", F.array_join(found, ",").alias("verdicts"), F.array_join(again, ",").alias("retry"))


# --- texts ---
@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE p_name END AS name, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || chr(10) || 'b' ELSE '7' END AS payload,
  CASE WHEN p_partkey % 2 = 0 THEN 'has MARK ' || p_name ELSE 'MARK section' || chr(10) || p_name END AS prepended FROM part""")
def json_replies(spark, sf):
    k, name = F.col("p_partkey"), F.col("p_name")
    inner = F.concat(F.lit('{"name": "'), name, F.lit('"}'))
    reply = F.when(k % 4 == 0, F.concat(F.lit("```json\n"), inner, F.lit("\n```"))).when(k % 4 == 1, inner)
    reply = reply.when(k % 4 == 2, F.concat(F.lit("Here it is: "), inner, F.lit(" done"))).otherwise('["not an object"]')
    payload = F.when(k % 3 == 0, F.concat(F.lit('{"other": 1, "markdown": {"text": "'), name, F.lit('"}}')))
    payload = payload.when(k % 3 == 1, F.concat(F.lit('["'), name, F.lit('", "", "b"]'))).otherwise("7")
    marked = F.when(k % 2 == 0, F.concat(F.lit("has MARK "), name)).otherwise(name)
    return load(spark, sf, "part").select(
        "p_partkey",
        F.try_variant_get(T.json_reply(reply), "$.name", "string").alias("name"),
        T.payload_text(F.try_parse_json(payload)).alias("payload"),
        T.prepend_once(marked, "MARK", "MARK section").alias("prepended"),
    )


@query("""SELECT p_partkey, left(p_type || ' \\| ' || p_name, 40) = left(cell, 40) AS starts, cell, axes, hint FROM (SELECT p_partkey, p_type, p_name, p_type || ' \\| ' || p_name AS cell, 'T,V' AS axes,
  CAST((CASE WHEN p_partkey % 3 = 0 THEN 20 ELSE 0 END) + least(18, 3 * len(list_filter(list_distinct(list_filter(string_split_regex(lower(p_name), '[^a-z0-9]+'), lambda t: length(t) >= 3))[1:24], lambda t: contains(lower(p_name || ' 4711'), t)))) AS INT) AS hint FROM part)""")
def text_cells(spark, sf):
    cell = T.markdown_cell(F.concat(F.lit("  "), "p_type", F.lit("  | \n"), "p_name"), 260)
    ean = F.when(F.col("p_partkey") % 3 == 0, "4711").otherwise("0815")
    return load(spark, sf, "part").select(
        "p_partkey",
        (F.left(F.concat("p_type", F.lit(" \\| "), "p_name"), F.lit(40)) == F.left(cell, F.lit(40))).alias("starts"),
        cell.alias("cell"),
        T.axes_cell(F.array(F.lit("T"), F.lit(""), F.lit("V"))).alias("axes"),
        T.hint_score(F.lower(F.concat("p_name", F.lit(" 4711"))), "p_name", ean).cast("int").alias("hint"),
    )


@query("""SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin, regexp_replace(url, '[?#].*$', '') AS bare, CAST(page_id AS VARCHAR) || '/x.md' AS rel, 'out/' || page_id || '/retailer' AS folder FROM pages""")
def url_parts(spark, sf):
    rows = load(spark, sf, "pages").withColumns({"scrape_id": F.col("page_id").cast("string"), "retailer_label": F.lit("retailer")})
    path = F.concat(F.lit("out/"), "scrape_id", F.lit("/x.md"))
    return rows.select(
        "page_id", U.origin("url").alias("origin"), U.without_query("url").alias("bare"), batch.relative_path(path, "out/").alias("rel"), batch.output_dir("out/").alias("folder")
    )


# --- batches ---
_OUT = {
    "row_number": "CAST(row_number AS VARCHAR)", "input_id": "input_id", "product_url": "product_url", "main_text": "main_text", "ean": "ean", "source_url_role": "source_url_role", "success": "success",
    "artifact_quality": "artifact_quality", "requires_manual_review": "requires_manual_review", "missing_critical_fields": "missing_critical_fields", "access_status": "access_status", "capture_grade": "capture_grade",
    "capture_decision": "capture_decision", "real_scrape_evidence": "real_scrape_evidence", "weak_capture_reasons": "weak_capture_reasons", "has_real_scrape_evidence": "real_scrape_evidence",
    "is_weak_capture": "CAST(is_weak_capture AS VARCHAR)", "is_block_or_challenge": "CAST(is_block_or_challenge AS VARCHAR)", "capture_decision_bucket": "capture_decision_bucket",
    "title": "title", "final_image_count": "final_image_count", "visual_evidence_status": "visual_evidence_status", "error": "error",
}
_ASKED_COLUMNS = ("row_number", "input_id", "product_url", "main_text", "ean", "source_url_role", "error")


def _out_column(name: str) -> str:
    value = _OUT.get(name, "''")
    if name in _ASKED_COLUMNS or name in ("requested_retailer_name", "requested_country_code", "source_retailer_name", "source_country_code",
                                          "source_alignment_status", "source_claim_scope", "requested_retailer_claims_allowed"):
        return f"{value} AS {name}"
    missing = "coalesce(nullif(error, ''), 'row was not created')" if name == "image_failure_reason" else f"'{vocab.NOT_CREATED.get(name, '')}'"
    return f"CASE WHEN made THEN {value} ELSE {missing} END AS {name}"


@query(f"""WITH r AS ({catalogue._FLAGS.replace("SELECT row_number,", "SELECT *,", 1)}), m AS (SELECT *, row_number % 5 <> 0 AS made FROM r)
SELECT {", ".join(_out_column(n) for n in vocab.RESULT_COLUMNS)} FROM m""")
def batch_output(spark, sf):
    rows = S.make(spark, sf, S.RESULTS).drop("artifact_text").withColumn("created", F.col("row_number") % 5 != 0)
    return batch.result_rows(rows)


@query(f"""SELECT count(*) AS total, count(*) FILTER (success = 'true') AS succeeded, (SELECT string_agg(q || '=' || n, ',' ORDER BY q) FROM (SELECT artifact_quality AS q, count(*) AS n FROM ({S.for_oracle(S.RESULTS)}) GROUP BY ALL)) AS qualities
  FROM ({S.for_oracle(S.RESULTS)})""")
def batch_qualities(spark, sf):
    done = batch.batch_summary(S.make(spark, sf, S.RESULTS))
    pairs = F.transform(F.array_sort(F.map_entries("quality_counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return done.select("total", "succeeded", F.array_join(pairs, ",").alias("qualities"))


@query("""SELECT CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE CAST(n_regionkey AS VARCHAR) END AS value, count(*) AS n FROM nation GROUP BY ALL""")
def value_counts(spark, sf):
    rows = load(spark, sf, "nation").select(F.when(F.col("n_nationkey") % 3 != 0, F.col("n_regionkey").cast("string")).alias("k"))
    return batch.value_counts(rows, "k")


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, '' AS segment FROM nation UNION ALL SELECT CAST(c_custkey AS VARCHAR), '', c_mktsegment FROM customer""")
def column_union(spark, sf):
    a = load(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return batch.union_columns(a, load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")))


_WHOLE = catalogue._VALIDATED.replace("v AS (SELECT row_number, ean_match_status, identity_match_status, identity_match_score,", "v AS (SELECT *,")


@query(f"""{_WHOLE}, i AS (SELECT *, visual_evidence_status = 'final_product_images_available' AND CAST(final_image_count AS INT) >= 1 AS fine FROM v)
SELECT row_number, input_id, manual_review_bucket, CASE WHEN fine THEN 'image_ready' WHEN visual_evidence_status = 'screenshot_fallback_only' THEN 'screenshot_fallback_only'
  WHEN row_number % 2 = 0 THEN 'timeout' ELSE 'all_image_downloads_failed' END AS image_failure_bucket,
  CASE WHEN fine THEN 'ready' WHEN visual_evidence_status = 'screenshot_fallback_only' THEN 'manual_review_screenshot_or_retry_image_capture'
  ELSE 'retry_image_capture_with_stronger_profile' END AS image_recovery_action, {catalogue._PRIORITY.replace('CASE b', 'CASE manual_review_bucket')} AS triage_priority FROM i""")
def triage_full(spark, sf):
    rows = S.make(spark, sf, S.RESULTS).withColumns(
        {"scrape_id": F.concat_ws("/", "row_number", "input_id", "product_url"), "image_candidate_count": F.lit(3), "image_downloaded_count": F.lit(0), "screenshot_fallback_used": F.lit(False)}
    )
    shown = rows.select(
        "scrape_id", F.lit(0).alias("ordinal"), F.lit("").alias("local_path"), F.when(F.col("row_number") % 2 == 0, "Read timeout").otherwise("").alias("error"),
        F.array(F.lit("direct:0")).alias("attempts"),
    )
    done = engine.triage(rows, shown.dropDuplicates(["scrape_id"]), ("artifact_text",))
    return done.select("row_number", "input_id", "manual_review_bucket", "image_failure_bucket", "image_recovery_action", "triage_priority")


@query(f"""{_WHOLE}, m AS (SELECT *, {catalogue._any('left(blob, 80000)', vocab.BUSINESS_MARKETPLACE_TERMS)} AS market, concat_ws('; ', CASE WHEN ean_match_status = 'possible_identifier_conflict' THEN 'ean_or_identifier_conflict' END,
  CASE WHEN identity_match_status = 'input_not_found_in_capture' THEN 'input_identity_not_found_in_capture' END, CASE WHEN category THEN 'category_or_search_page_not_product_detail_page' END, CASE WHEN NOT visual THEN 'clean_product_image_missing' END,
  CASE WHEN access_status IN {catalogue._in(vocab.BLOCKED_ACCESS)} THEN 'access_status_' || access_status END, CASE WHEN source IN ('fallback_source_used', 'source_context_mismatch') THEN source END) AS conflicts FROM v)
SELECT row_number, input_id, technical AS technical_success, scrape AS scrape_success, visual AS visual_success, evidence AS evidence_success, detail AS is_product_detail_page, category AS is_category_or_search_page, market AS is_marketplace_page,
  CASE manual_review_bucket WHEN 'READY_FOR_CODING' THEN 'ready' WHEN 'FAILED_TECHNICAL' THEN 'failed' ELSE 'review' END AS business_validation_status, conflicts AS critical_conflicts,
  CASE WHEN conflicts <> '' THEN conflicts ELSE manual_review_bucket END AS manual_review_reason, CASE WHEN identity_match_status IN ('matched_by_ean', 'matched_by_title_tokens') THEN 'aligned_or_not_detected'
  WHEN identity_match_status IN ('weak_match_by_title_tokens', 'partial_token_overlap') THEN 'possible_variant_risk' WHEN identity_match_status = 'input_not_found_in_capture' THEN 'possible_variant_or_wrong_product' ELSE 'not_evaluated' END AS variant_match_status,
  CASE WHEN visual_evidence_status = 'screenshot_fallback_only' THEN 'screenshot_needs_main_product_review' WHEN market THEN 'marketplace_page_needs_seller_scope_review' WHEN detail THEN 'isolated_main_product' ELSE 'not_isolated_or_not_product_page' END AS main_product_isolation_status,
  CASE WHEN identity_match_status = 'matched_by_ean' THEN '' ELSE array_to_string(list_filter(words, lambda w: contains(blob, w)), '; ') END AS identity_match_terms,
  CASE ean_match_status WHEN 'matched' THEN ean WHEN 'possible_identifier_conflict' THEN array_to_string(list_filter(runs, lambda x: x <> ean)[1:8], '; ') ELSE '' END AS ean_conflict_candidates FROM m""")
def business_columns(spark, sf):
    found = catalogue._validated(spark, sf)
    return found.select(
        "row_number", "input_id", "technical_success", "scrape_success", "visual_success", "evidence_success", "is_product_detail_page",
        "is_category_or_search_page", "is_marketplace_page", "business_validation_status", "critical_conflicts", "manual_review_reason",
        "variant_match_status", "main_product_isolation_status", "identity_match_terms", "ean_conflict_candidates",
    )


@query("""SELECT p_partkey, 'a' || p_partkey AS scrape_id, CASE WHEN p_partkey % 2 = 0 THEN 'strong' ELSE 'partial' END AS artifact_quality, 'strong' AS identity_status, p_partkey % 2 = 0 AS ready_for_coding,
  CASE WHEN p_partkey % 2 = 0 THEN 'safe_for_automated_product_coding' ELSE 'code_supported_features_only_and_review_gaps' END AS recommended_downstream_action FROM part""")
def enriched_artifacts(spark, sf):
    key = F.concat(F.lit("a"), "p_partkey").alias("scrape_id")
    base = load(spark, sf, "part").select("p_partkey", key, F.col("p_name").alias("main_text"), F.col("p_name").alias("product_title"), F.lit("").alias("ean"), F.lit("").alias("ean_detected"))
    meta = base.select("scrape_id", F.lit("partial").alias("artifact_quality"), F.lit("").alias("visual_evidence_status"))
    report = base.where("p_partkey % 2 = 0").select("scrape_id", F.lit("strong").alias("artifact_quality"), F.lit(False).alias("requires_manual_review"))
    done = engine.enrich_artifacts(base, meta, report)
    return done.select("p_partkey", "scrape_id", "artifact_quality", "identity_status", "ready_for_coding", "recommended_downstream_action")


@query("""SELECT p_partkey, 'tables/table_001.md' AS path, '# Facts ' || p_size || chr(10) || chr(10) || '<!-- rows=2 cols=2 -->' || chr(10) || chr(10) || '| Size | Brand |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || p_size || ' | ' || trim(p_brand) || ' |' || chr(10) AS text FROM part""")
def table_documents(spark, sf):
    found = H.extract_pages(S.make(spark, sf, S.PAGES), "p_partkey")
    return sinks.table_artifacts(found, "p_partkey")


@query("""SELECT 'o' || o_orderkey AS scrape_id, CASE o_orderstatus WHEN 'F' THEN '_COMPLETE.json' WHEN 'O' THEN '_FAILED.json' ELSE '_IN_PROGRESS.json' END AS path,
  CASE o_orderstatus WHEN 'F' THEN '{"status":"complete","scrape_id":"o' || o_orderkey || '"}' WHEN 'O' THEN '{"status":"failed","scrape_id":"o' || o_orderkey || '","error":"boom"}'
  ELSE '{"status":"in_progress","scrape_id":"o' || o_orderkey || '"}' END AS text FROM orders""")
def terminal_markers(spark, sf):
    status = F.col("o_orderstatus")
    rows = load(spark, sf, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("scrape_id"), F.when(status == "F", True).when(status == "O", False).alias("created"), F.lit("boom").alias("error")
    )
    return sinks.terminal_markers(rows)


@query(f"""WITH v AS (SELECT scrape_id, count(*) AS n, count(*) FILTER (retained) AS k FROM ({S.for_oracle(S.IMAGES)}) GROUP BY scrape_id)
SELECT scrape_id, '| Image candidates found | ' || n || ' |' AS found, '| Images retained | ' || k || ' |' AS kept FROM v""")
def visual_views(spark, sf):
    text = render.visual_markdown()
    rows = images.visual_decision(S.make(spark, sf, S.IMAGES))
    lines = F.split(text, "\n")
    return rows.select("scrape_id", F.get(lines, F.lit(5)).alias("found"), F.get(lines, F.lit(6)).alias("kept"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'inline ' || s_name || chr(10) || chr(10) || 'from file' ELSE 'from file' END AS ai, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 0 END AS n_items,
  CASE WHEN s_suppkey % 3 = 0 THEN 't' || s_suppkey ELSE '' END AS first_title, true AS has_upstream, least(2, s_suppkey % 4) AS n_snippets FROM supplier""")
def upstream_requests(spark, sf):
    k = F.col("s_suppkey")
    items = F.concat(F.lit('{"items":[{"title":"t'), k, F.lit('"},{"text":"x"}]}'))
    rows = load(spark, sf, "supplier").select(
        "s_suppkey",
        k.cast("int").alias("row_number"),
        F.concat(F.lit("https://x.example.com/"), k).alias("url"),
        F.when(k % 2 == 0, F.concat(F.lit("inline "), "s_name")).otherwise("").alias("ai_mode_evidence"),
        F.lit(" from file ").alias("upstream_ai_evidence_file"),
        F.when(k % 3 == 0, items).otherwise("").alias("search_evidence_json"),
        F.when(k % 4 == 0, "").when(k % 4 == 1, "one").when(k % 4 == 2, "one||two").otherwise('["a", "", "b"]').alias("snippets"),
    )
    good, _ = batch.requests_from_rows(rows)
    kept = evidence.bounded_upstream()
    return good.select(
        F.col("row_number").cast("long").alias("s_suppkey"),
        F.col("ai_mode_evidence").alias("ai"),
        F.size("search_evidence").alias("n_items"),
        F.coalesce(F.get("search_evidence", F.lit(0))["title"], F.lit("")).alias("first_title"),
        evidence.has_upstream().alias("has_upstream"),
        F.size(kept["candidate_snippets"]).cast("long").alias("n_snippets"),
    )


@query()
def selected_images(spark, sf):
    """Queue to verdict; the order-dependent near-duplicate step has no SQL, tests compare it on a small fixture."""
    rows = S.make(spark, sf, S.IMAGES).withColumns(
        {
            "sha8": F.when(F.col("retained"), F.substring(F.sha1(F.col("url").cast("binary")), 1, 8)),
            "phash": F.when(F.col("retained"), F.xxhash64("area")),
            "width": F.col("area"),
            "height": F.lit(1),
        }
    ).drop("retained", "area")
    return images.select_images(rows).select("scrape_id", "position", "url", "alt", "duplicate", "described", "kept", "relevance_final")


@query()
def graded_batch(spark, sf):
    """Requests to the 66 columns of the output; tests compare it on a small fixture."""
    asked = load(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("row_number"), F.concat(F.lit("p"), "p_partkey").alias("input_id"),
        F.concat(F.lit("https://shop.example.com/item/"), "p_partkey").alias("url"), F.col("p_name").alias("main_text"), F.lit("Shop").alias("retailer"), F.lit("de").alias("country"),
    )
    good, _ = batch.requests_from_rows(asked)
    none = F.array().cast("array<string>")
    seen = S.make(spark, sf, S.CAPTURES).withColumns(
        {
            "url": F.concat(F.lit("https://shop.example.com/item/"), F.substring("scrape_id", 2, 20)),
            "final_url": F.lit(""),
            "canonical_url": F.lit(""),
            "access_issue_type": F.lit("none"),
            "proxy_used": F.lit(False),
            "json_ld": F.when(F.col("n_json_ld") > 0, F.array(F.lit("{}"))).otherwise(none),
            "og": F.from_json(F.lit("{}"), "map<string,string>"),
            "product_meta": F.from_json(F.lit("{}"), "map<string,string>"),
            "tables": F.array().cast("array<struct<index:int,caption:string,n_rows:int,n_columns:int,markdown:string>>"),
        }
    )
    pictures = S.make(spark, sf, S.IMAGES).withColumn("local_path", F.when(F.col("retained"), F.col("url")).otherwise(""))
    return batch.result_rows(engine.grade(good, seen, pictures))
