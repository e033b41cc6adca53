"""Input rows for the catalogue, made from the driver's tables by SQL that both engines read.

They are stand-ins: the driver has no captures, images or claims of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evigrade.session import load, spread

PROFILES = ("standard", "load_wait", "full_page_scroll", "expand_common_sections", "extract_gallery_sources", "shadow_iframe", "retry_relaxed")

#: A capture of every part under each profile: longer pages for later profiles, block words for some.
CAPTURES = """
SELECT concat('p', CAST(p_partkey AS STRING)) AS scrape_id, t.ordinal AS ordinal, t.profile AS fetch_profile,
       CASE WHEN p_partkey % 11 = 0 THEN 'Access Denied' WHEN p_partkey % 13 = 0 THEN '' ELSE p_name END AS title,
       concat('brand ', p_brand) AS description,
       concat(repeat(concat(p_name, ' product price material '), CAST((p_partkey * 7 + t.ordinal * 31) % 400 AS INT)),
              CASE WHEN (p_partkey + t.ordinal) % 9 = 0 THEN ' captcha robot check' ELSE '' END) AS raw_markdown,
       repeat('<div>x</div>', CAST((p_partkey * 13 + t.ordinal * 97) % 9000 AS INT)) AS raw_html,
       CASE WHEN (p_partkey + t.ordinal) % 17 = 0 THEN 'access_denied' ELSE 'accessible' END AS access_status,
       (p_partkey + t.ordinal) % 19 <> 0 AS success,
       CAST((p_partkey + t.ordinal) % 3 AS INT) AS n_json_ld, CAST(p_partkey % 4 AS INT) AS n_tables,
       CAST(p_partkey % 5 AS INT) AS n_og, CAST(t.ordinal % 2 AS INT) AS n_meta,
       CAST((p_partkey * 3 + t.ordinal) % 16 AS INT) AS n_images
FROM {part} CROSS JOIN (VALUES (0, 'standard'), (1, 'load_wait'), (2, 'full_page_scroll'), (3, 'expand_common_sections'),
  (4, 'extract_gallery_sources'), (5, 'shadow_iframe'), (6, 'retry_relaxed')) AS t(ordinal, profile)
"""

#: A batch result for every line item.
RESULTS = """
SELECT l_orderkey * 10 + l_linenumber AS row_number, concat('sku-', CAST(l_partkey AS STRING)) AS input_id,
       concat('https://shop', CAST(l_suppkey % 20 AS STRING), '.example.com/',
              CASE WHEN l_partkey % 9 = 0 THEN 'search?q=toy' WHEN l_partkey % 14 = 0 THEN 'cart/1' ELSE concat('item/', CAST(l_partkey AS STRING)) END) AS product_url,
       concat('part ', CAST(l_partkey AS STRING)) AS title,
       concat('wooden puzzle horse ', CAST(l_partkey AS STRING)) AS main_text,
       CASE WHEN l_partkey % 4 = 0 THEN CAST(40000000 + l_partkey AS STRING) ELSE '' END AS ean,
       CASE WHEN l_linenumber % 7 = 0 THEN 'false' ELSE 'true' END AS success,
       CASE WHEN l_orderkey % 23 = 0 THEN 'boom' ELSE '' END AS error,
       CASE l_partkey % 6 WHEN 0 THEN 'bot_challenge' WHEN 1 THEN 'fetch_error' ELSE 'accessible' END AS access_status,
       CASE l_suppkey % 5 WHEN 0 THEN 'rich_product_capture' WHEN 1 THEN 'usable_product_capture'
            WHEN 2 THEN 'mixed_capture_needs_review' WHEN 3 THEN 'weak_no_real_product_capture' ELSE 'blocked_shell_capture' END AS capture_decision,
       CASE l_suppkey % 5 WHEN 0 THEN 'strong' WHEN 1 THEN 'usable' WHEN 2 THEN 'mixed_capture' WHEN 3 THEN 'weak' ELSE 'blocked_or_shell' END AS capture_grade,
       CASE WHEN l_suppkey % 5 < 3 THEN 'true' ELSE 'false' END AS real_scrape_evidence,
       CASE WHEN l_suppkey % 5 = 4 THEN 'block_or_challenge_terms' ELSE '' END AS weak_capture_reasons,
       CASE l_linenumber % 4 WHEN 0 THEN 'screenshot_fallback_only' WHEN 1 THEN 'image_recovery_failed' ELSE 'final_product_images_available' END AS visual_evidence_status,
       CAST(l_linenumber % 4 AS STRING) AS final_image_count,
       CASE l_partkey % 3 WHEN 0 THEN 'strong' WHEN 1 THEN 'usable' ELSE 'partial' END AS artifact_quality,
       CASE WHEN l_partkey % 10 = 3 THEN 'retailer_url' ELSE '' END AS missing_critical_fields,
       CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END AS requires_manual_review,
       CASE l_suppkey % 3 WHEN 0 THEN 'primary' WHEN 1 THEN 'global-fallback' ELSE 'unknown' END AS source_url_role,
       concat('brand price material wooden puzzle ', CASE WHEN l_partkey % 2 = 0 THEN 'horse 12345678' ELSE 'age sku' END,
              CASE WHEN l_partkey % 8 = 0 THEN concat(' ', CAST(40000000 + l_partkey AS STRING)) ELSE '' END,
              CASE WHEN l_partkey % 5 = 0 THEN ' sold by' ELSE '' END) AS artifact_text
FROM {lineitem}
"""

#: Images of every part.
IMAGES = """
SELECT concat('p', CAST(p_partkey % 500 AS STRING)) AS scrape_id, p_partkey AS ordinal,
       CASE p_partkey % 7 WHEN 0 THEN 'data:abc' WHEN 1 THEN concat('https://cdn.example.com/logo/', CAST(p_size AS STRING))
            ELSE concat('https://cdn.example.com/', CAST(p_size AS STRING), '.jpg') END AS url,
       concat('alt ', CAST(p_partkey % 3 AS STRING)) AS alt,
       p_partkey % 4 <> 0 AS retained,
       CASE p_partkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE '' END AS relevance,
       CASE WHEN p_partkey % 6 = 0 THEN 'screenshot_fallback' ELSE 'direct' END AS download_source,
       CASE p_partkey % 8 WHEN 0 THEN 'RELATED: yes' WHEN 1 THEN 'RELATED: no' WHEN 2 THEN 'a toy' ELSE '' END AS description,
       CASE p_partkey % 9 WHEN 0 THEN 'HTTP 403' WHEN 1 THEN 'timeout' WHEN 2 THEN 'mime=text' WHEN 3 THEN 'odd' ELSE '' END AS error,
       CAST(p_size * 100 AS BIGINT) AS area, CAST(p_retailprice * 10 AS BIGINT) AS bytes
FROM {part}
"""

#: A product page for every part, with JSON-LD as object, array or graph.
PAGES = """
SELECT p_partkey, concat('https://shop.example.com/p/', CAST(p_partkey AS STRING)) AS url,
  concat('<html><head><title> ', p_name, ' </title><link rel="canonical" href="https://shop.example.com/c/', CAST(p_partkey AS STRING),
    '"><meta property="og:title" content="', p_name, '"><meta name="description" content="', p_type,
    '"><meta property="product:brand" content="', p_brand, '"><script type="application/ld+json">',
    CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN '[' ELSE '{{"@graph":[' END,
    '{{"@type":', CASE WHEN p_partkey % 2 = 0 THEN '"Product"' ELSE '["Thing","Product"]' END, ',"name":"', p_name, '","brand":',
    CASE WHEN p_partkey % 2 = 0 THEN concat('"', p_brand, '"') ELSE concat('{{"name":"', p_brand, '"}}') END,
    ',"sku":"S', CAST(p_partkey AS STRING), '","gtin13":"', CAST(4000000000000 + p_partkey AS STRING),
    '","offers":', CASE WHEN p_partkey % 4 < 2 THEN '[' ELSE '' END, '{{"price":"', CAST(p_size AS STRING), '","priceCurrency":"EUR","availability":"https://schema.org/InStock"}}',
    CASE WHEN p_partkey % 4 < 2 THEN ']' ELSE '' END, '}}',
    CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN ']' ELSE ']}}' END,
    '</script></head><body><table><caption>Facts ', CAST(p_size AS STRING), '</caption><tr><th>Size</th><th>Brand</th></tr><tr><td>',
    CAST(p_size AS STRING), '</td><td> ', p_brand, ' </td></tr></table><table></table><img src="/img/', CAST(p_partkey AS STRING), '.jpg" alt="', p_name,
    '"><img src="/img/', CAST(p_partkey AS STRING), '.jpg"><img srcset="/a/', CAST(p_size AS STRING), '.png 1x, /b/', CAST(p_size AS STRING), '.png 2x"></body></html>') AS html
FROM {part}
"""

#: Claims about every part.
CLAIMS = """
SELECT concat('p', CAST(p_partkey % 300 AS STRING)) AS scrape_id, p_partkey AS claim_no,
       CASE WHEN p_partkey % 5 = 0 THEN 'source_specific_claims' ELSE 'retailer_claims' END AS claim_source,
       CASE p_partkey % 6 WHEN 0 THEN 'brand' WHEN 1 THEN 'recommended age' WHEN 2 THEN '' WHEN 3 THEN 'box' WHEN 4 THEN 'material' ELSE 'warning' END AS attribute,
       CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_type END AS value,
       CASE p_partkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'low' ELSE NULL END AS confidence,
       CASE p_partkey % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'S' ELSE 'V' END AS axis
FROM {part}
"""

#: Files of an artifact for every order.
FILES = """
SELECT concat('a', CAST(o_orderkey AS STRING)) AS scrape_id, f.rel_path AS rel_path,
       CASE WHEN f.rel_path = 'retailer/source.md' AND o_orderkey % 13 = 0 THEN 0 ELSE 10 END AS size,
       CASE WHEN f.rel_path = 'scrape_result.json' THEN concat('{{"visual_evidence_status":"',
              CASE WHEN o_orderkey % 4 = 0 THEN 'no_image_candidates' ELSE 'final_product_images_available' END,
              '","artifact_quality":"', CASE WHEN o_orderkey % 5 = 0 THEN 'partial' ELSE 'strong' END,
              '","requires_manual_review":', CASE WHEN o_orderkey % 6 = 0 THEN 'true' ELSE 'false' END, '}}')
            WHEN f.rel_path = 'retailer/vision.md' THEN CASE WHEN o_orderkey % 17 = 0 THEN '  ' ELSE 'seen' END ELSE '{{}}' END AS text
FROM {orders} CROSS JOIN (VALUES ('request.json'), ('scrape_result.json'), ('retailer/source.md'), ('retailer/product_evidence.json'),
  ('retailer/quality_report.json'), ('retailer/source_alignment_report.json'), ('retailer/vision.md'),
  ('retailer/manifests/artifact_manifest.json'), ('retailer/manifests/image_manifest.json'), ('retailer/manifests/agent_trace.json'),
  ('retailer/images/1.jpg'), ('_COMPLETE.json'), ('_FAILED.json')) AS f(rel_path)
WHERE NOT (f.rel_path = '_COMPLETE.json' AND o_orderkey % 7 = 0) AND NOT (f.rel_path = '_FAILED.json' AND o_orderkey % 14 <> 0)
  AND NOT (f.rel_path = 'retailer/manifests/agent_trace.json' AND o_orderkey % 11 = 0)
"""

#: Requested and found sources.
SOURCES = """
SELECT s.s_suppkey, c.c_custkey, CASE WHEN c.c_custkey % 5 = 0 THEN '' ELSE concat('Shop-', CAST(c.c_custkey % 3 AS STRING)) END AS requested_retailer_name,
       n.n_name AS requested_country_code, concat('shop ', CAST(s.s_suppkey % 3 AS STRING)) AS source_retailer_name,
       CASE WHEN s.s_suppkey % 4 = 0 THEN '' ELSE lower(m.n_name) END AS source_country_code,
       CASE c.c_custkey % 9 WHEN 0 THEN 'Primary' WHEN 1 THEN 'global fallback' WHEN 2 THEN 'fallback-alternate-retailer' ELSE '' END AS source_url_role
FROM {supplier} s JOIN {customer} c ON s.s_suppkey = c.c_custkey % 10
JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {nation} m ON s.s_nationkey = m.n_nationkey
"""

TABLES = ("part", "lineitem", "orders", "supplier", "customer", "nation", "region", "documents", "pages", "events", "benchmark", "embeddings")

SPREAD = ("part", "lineitem", "orders", "documents", "pages", "events")


def make(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of one of the above.  The tables that they are made from are spread first: a row of them makes many."""
    used = {t: load(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **{t: spread(df, heavy=True) if t in SPREAD else df for t, df in used.items()})


def for_oracle(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})
