"""DuckDB text shared by several oracles: the stand-ins and the cleaned tables."""

from __future__ import annotations

REVIEWED = "CASE WHEN l_linenumber % 7 = 0 THEN -l_partkey ELSE l_partkey END"

REVIEWS = f"""
r AS (SELECT {REVIEWED} AS asin, o_custkey AS reviewer_id, (l_quantity - 1) % 5 + 1 AS overall,
             l_shipdate::DATE AS date
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PRODUCTS = """
m AS (SELECT p_partkey AS asin, p_brand AS brand, p_type AS main_cat FROM part)"""

JOINED = f"""{REVIEWS}, {PRODUCTS},
j AS (SELECT r.*, m.brand, m.main_cat FROM r LEFT JOIN m USING (asin)),
b AS (SELECT brand, avg(overall) AS overall_brand FROM j GROUP BY brand),
v AS (SELECT reviewer_id, avg(overall) AS overall_reviewer FROM j GROUP BY reviewer_id)"""


JOINED_REPEATED = JOINED.replace(
    "AS main_cat FROM part)",
    "AS main_cat FROM part UNION ALL SELECT p_partkey, p_brand, lower(p_type) FROM part WHERE p_partkey % 3 = 0)",
)


def decoded(text: str) -> str:
    return f"""replace(replace({text}, '&amp;', '&'), '&quot;', '"')"""


def word_count(text: str) -> str:
    return f"CASE WHEN {text} IS NOT NULL THEN len(regexp_split_to_array({text}, '\\s+')) END"


def capitalised(text: str) -> str:
    """Title case: the Unicode title form of a leading ``ß`` is ``Ss``, which ``upper`` does not give."""
    return (
        f"array_to_string(list_transform(string_split({text}, ' '), "
        "lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || lower(w[2:])), ' ')"
    )


def label(rating: str, average: str) -> str:
    return (
        f"CASE WHEN {rating} > {average} THEN 'better' WHEN {rating} < {average} THEN 'worse' "
        "ELSE 'normal' END"
    )


def json_texts(text: str) -> str:
    return f"CASE WHEN json_valid({text}) THEN CAST(CAST({text} AS JSON) AS VARCHAR[]) END"


def image_links(text: str) -> str:
    kept = f"list_filter({json_texts(text)}, lambda x: x <> '88')"
    return f"CASE WHEN len({kept}) > 0 THEN {kept} END"


SILVER_REVIEWS = f"""
br AS (SELECT CAST(l_partkey AS VARCHAR) AS asin,
         CASE WHEN l_linenumber % 4 = 0 THEN '["88","u' || l_partkey || '"]'
              WHEN l_linenumber % 4 = 1 THEN '["88"]' WHEN l_linenumber = 2 THEN '[]'
              WHEN l_linenumber = 3 THEN 'not json' END AS raw_image,
         (l_quantity - 1) % 5 + 1 AS overall, text AS review_text,
         CAST(o_custkey AS VARCHAR) AS reviewer_id,
         'Ann &amp; &quot;' || o_custkey || '&quot;' AS raw_name, o_orderpriority AS summary,
         l_linestatus = 'F' AS verified,
         CASE WHEN l_linenumber > 3 THEN CAST(l_linenumber AS VARCHAR) END AS vote,
         l_shipdate::DATE AS date, strftime(l_shipdate, '%Y-%m') AS year_month
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN documents ON l_orderkey = doc_id),
sr AS (SELECT DISTINCT asin, {image_links("raw_image")} AS image, overall, review_text, reviewer_id,
         {decoded("raw_name")} AS reviewer_name, summary, verified, vote, date, year_month,
         {word_count("review_text")} AS review_word_count,
         CASE WHEN {word_count("review_text")} = 1 THEN review_text END AS keyword
       FROM br)"""

BRONZE_METADATA = """
bm AS (SELECT CAST(p_partkey // 2 AS VARCHAR) AS asin,
         lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS similar_item,
         [CAST(p_partkey + 1 AS VARCHAR), CAST(p_partkey + 2 AS VARCHAR)] AS also_buy,
         CASE WHEN p_size <= 45 THEN p_brand END AS brand,
         CASE p_size % 3 WHEN 0 THEN [p_type, p_brand] WHEN 1 THEN CAST([] AS VARCHAR[]) END AS category,
         CASE WHEN p_size % 4 IN (0, 3) THEN
                strftime(DATE '2010-01-01' + CAST(p_partkey % 2000 AS INTEGER), '%B %-d, %Y')
              WHEN p_size % 4 = 1 THEN 'Foo' END AS raw_date,
         CASE WHEN p_size % 5 = 0 THEN CAST([] AS VARCHAR[])
              WHEN p_size % 5 < 4 THEN [p_name, p_type] END AS description,
         CASE WHEN p_size % 2 = 0 THEN '{}' ELSE '{"k": 1}' END AS details,
         CASE p_size % 3 WHEN 0 THEN ['', p_type] WHEN 1 THEN [''] END AS feature,
         CASE WHEN p_size % 2 = 0 THEN '' ELSE p_type END AS fit,
         ['i' || p_partkey] AS image,
         CASE p_size % 3 WHEN 0 THEN '<img src="/x.png" alt="' || p_type || ' &amp; '
                                     || lower(p_brand) || '"/>'
              WHEN 1 THEN lower(p_name) END AS main_cat,
         CASE WHEN p_size % 4 < 2 THEN '$' || p_retailprice
              WHEN p_size % 4 = 2 THEN '$' || p_retailprice || ' - $30.00' ELSE '' END AS price,
         CASE WHEN p_size % 5 < 3 THEN
                '[">#' || (p_partkey % 9 + 1) || ',' || lpad(CAST(p_size * 7 AS VARCHAR), 3, '0')
                || ' in ' || p_type || ' (","' || p_size || ' in ' || p_brand || '","none"]'
              WHEN p_size % 5 = 3 THEN 'not json' END AS rank,
         CASE p_size % 5 WHEN 0 THEN '<span>' || p_name WHEN 1 THEN ''
              WHEN 2 THEN p_name || '" />' ELSE p_name || ' &amp; ' || p_type END AS title
       FROM part)"""

_CATEGORY = """CASE WHEN contains(main_cat, 'img src=') THEN
    regexp_extract(main_cat, 'alt=["'']([^"'']*)', 1) ELSE main_cat END"""
_ENTRIES = f"list_transform({json_texts('rank')}, lambda x: replace(x, '>#', ''))"
_NUMBERS = f"list_transform({_ENTRIES}, lambda x: regexp_extract(x, '(\\d{{1,3}}(?:,\\d{{3}})*)', 1))"
_CATEGORIES = f"list_transform({_ENTRIES}, lambda x: regexp_extract(x, 'in\\s+(.+)', 1))"

SILVER_METADATA = f"""{BRONZE_METADATA},
lm AS (SELECT *, try_strptime(raw_date, '%B %d, %Y')::DATE AS date FROM bm
       QUALIFY row_number() OVER (PARTITION BY asin
         ORDER BY try_strptime(raw_date, '%B %d, %Y') DESC NULLS LAST, similar_item DESC) = 1),
sm AS (SELECT asin, similar_item, also_buy, brand, date,
         coalesce(category[1], 'Unknown') AS first_category, description[1] AS description,
         nullif(details, '{{}}') AS details, list_filter(feature, lambda x: x <> '') AS feature,
         nullif(fit, '') AS fit, image,
         {capitalised(f"replace({_CATEGORY}, '&amp;', '&')")} AS main_cat,
         try_cast(regexp_replace(price, '[^0-9.]', '', 'g') AS FLOAT) AS price,
         {_NUMBERS} AS rank_numbers, list_min({_NUMBERS}) AS higher_rank,
         coalesce(array_to_string({_CATEGORIES}, ', '), '') AS rank_cat,
         list_min(list_transform({_NUMBERS},
           lambda x: try_cast(replace(x, ',', '') AS BIGINT))) AS best_rank,
         replace(replace(CASE WHEN title = '' OR starts_with(title, '<') THEN NULL ELSE title END,
                         '" />', ''), '&amp;', '&') AS title
       FROM lm)"""

SILVER_EVENTS = f"""
be AS (SELECT *, event_id % 50 <> 0 AS good,
         CASE event_id % 5 WHEN 0 THEN '["88","e' || event_id || '"]' WHEN 1 THEN '["88"]'
              WHEN 2 THEN 'not json' END AS raw_image,
         CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN event_type || ' ' || props END AS said
       FROM events),
se AS (SELECT event_id AS sequence_number, event_id AS offset_number,
         strftime(ts, '%Y-%m-%d') AS date_utc,
         CASE WHEN good THEN CAST(user_id AS VARCHAR) END AS asin,
         CASE WHEN good THEN {image_links("raw_image")} END AS image,
         CASE WHEN good THEN CAST(CAST(event_id % 5 + 1 AS DOUBLE) AS VARCHAR) END AS overall,
         CASE WHEN good THEN said END AS review_text,
         CASE WHEN good THEN CAST(event_id % 400 AS VARCHAR) END AS reviewer_id,
         CASE WHEN good THEN 'Bo & "' || event_type || '"' END AS reviewer_name,
         CASE WHEN good THEN event_type END AS summary,
         CASE WHEN good THEN CAST(event_id AS VARCHAR) END AS unix_review_time,
         CASE WHEN good THEN CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END END AS verified,
         CASE WHEN good AND event_id % 7 = 0 THEN CAST(event_id % 11 AS VARCHAR) END AS vote,
         CASE WHEN good THEN {word_count("said")} END AS review_word_count,
         CASE WHEN good AND {word_count("said")} = 1 THEN said END AS keyword
       FROM be)"""

SILVER_EVENTS_SELECT = """SELECT sequence_number, offset_number, date_utc, asin,
  array_to_string(image, ',') AS image, overall, review_text, reviewer_id, reviewer_name, summary,
  unix_review_time, verified, vote, CAST(review_word_count AS BIGINT) AS review_word_count, keyword
FROM se"""

GOLD = f"""{SILVER_REVIEWS}, {SILVER_EVENTS}, {SILVER_METADATA},
u AS (SELECT asin, image, overall, review_text, reviewer_id, reviewer_name, summary, verified, vote,
             date FROM sr
      UNION ALL
      SELECT asin, image, try_cast(overall AS DOUBLE), review_text, reviewer_id, reviewer_name,
             summary, try_cast(verified AS BOOLEAN), vote, CAST(date_utc AS DATE) FROM se),
gj AS (SELECT u.*, also_buy, brand, first_category, description, sm.image AS image_met, main_cat,
              price, higher_rank, rank_cat, title
       FROM u LEFT JOIN sm ON u.asin = sm.asin),
gb AS (SELECT brand, avg(overall) AS overall_brand FROM gj GROUP BY brand),
gr AS (SELECT reviewer_id, avg(overall) AS overall_reviewer FROM gj GROUP BY reviewer_id),
g AS (SELECT DISTINCT gj.*, {label("overall", "overall_brand")} AS brand_deviation_text,
        {label("overall", "overall_reviewer")} AS reviewer_deviation_text,
        date_trunc('month', date)::DATE AS year_month
      FROM gj LEFT JOIN gb ON gj.brand = gb.brand LEFT JOIN gr ON gj.reviewer_id = gr.reviewer_id)"""
