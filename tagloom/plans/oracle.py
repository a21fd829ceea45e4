"""DuckDB text computing the expected result of every registered query.

Each oracle is ``PRELUDE`` (the source views and the reference's relations
written in plain SQL, FIXTURES.md section 3) followed by one ``SELECT``. The
pair table here is the literal self-join of tokens, so these texts check the
W1 / W2 rewrites of the Spark plans as well.
"""

from __future__ import annotations

#: USER_TECH of users of whom every third is renamed after the first half of the comments: the first name stays.
_RENAMED = """SELECT t.user_id, CASE WHEN t.user_id % 3 = 1 AND e.user_id IS NULL
               THEN user_name || ' renamed' ELSE user_name END AS user_name, user_website, tech, score, cnt
        FROM user_tech t LEFT JOIN (
          SELECT DISTINCT m.user_id FROM comments m JOIN tag_tokens e ON e.id = m.post_id
          WHERE m.id < (SELECT mid FROM comment_mid)) e ON e.user_id = t.user_id"""

PRELUDE = r"""
WITH posts AS (
  SELECT o_orderkey AS id, t.tags, o_orderdate AS creation_date,
         t.answer_count, t.comment_count, t.favorite_count
  FROM orders LEFT JOIN (
    SELECT l_orderkey, '<' || string_agg(tag, '><' ORDER BY tag) || '>' AS tags,
           CAST(sum(n) AS INT) AS answer_count, CAST(sum(q) AS INT) AS comment_count,
           CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE CAST(sum(s) AS INT) END AS favorite_count
    FROM (SELECT l_orderkey, replace(p_name, ' ', '-') AS tag, count(*) AS n,
                 sum(CAST(l_quantity AS INT)) AS q, sum(p_size) AS s
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
    GROUP BY 1) t ON t.l_orderkey = o_orderkey),
comments AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_quantity AS INT) AS score,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey END AS user_id,
         l_orderkey AS post_id
  FROM lineitem),
users AS (
  SELECT s_suppkey AS id, s_name AS display_name,
         CASE WHEN s_suppkey % 4 = 0 THEN NULL
              ELSE 'http://example.com/u' || s_suppkey END AS website_url
  FROM supplier),
post_tags AS (
  SELECT id, CAST(creation_date AS DATE) AS day,
         CAST(coalesce(answer_count, 0) + coalesce(comment_count, 0)
              + coalesce(favorite_count, 0) AS BIGINT) AS weight,
         trim(replace(replace(replace(tags, '<', ' '), '>', ' '), '  ', ' ')) AS techlist
  FROM posts WHERE tags IS NOT NULL),
tag_tokens AS (
  SELECT id, day, weight, tag FROM (
    SELECT id, day, weight, unnest(string_split(techlist, ' ')) AS tag FROM post_tags)
  WHERE tag <> ''),
tag_pairs AS (
  SELECT a.id, a.day, a.weight, a.tag AS tech1, b.tag AS tech2
  FROM tag_tokens a JOIN tag_tokens b ON a.id = b.id AND a.tag <> b.tag),
tech_rel AS (
  SELECT tech1 AS technode1, tech2 AS technode2,
         CAST(sum(weight) AS BIGINT) AS weight, count(*) AS cnt
  FROM tag_pairs GROUP BY 1, 2),
tech_node AS (
  SELECT tech1 AS technode, CAST(sum(weight) AS BIGINT) AS weight, count(*) AS cnt
  FROM (SELECT DISTINCT tech1, id, weight FROM tag_pairs) GROUP BY 1),
tag_date AS (
  SELECT CAST(year(day) AS INT) AS year, day, tech1 AS tech, count(*) AS app_num
  FROM tag_pairs WHERE day IS NOT NULL GROUP BY 1, 2, 3),
clean_lists AS (
  SELECT id, day, weight,
         trim(regexp_replace(techlist, '[^\x00-\x7F]', '', 'g')) AS techlist FROM post_tags),
tag_list AS (
  SELECT CAST(year(day) AS INT) AS year, day, techlist,
         CAST(sum(weight) AS BIGINT) AS weight, count(*) AS app_num
  FROM clean_lists WHERE day IS NOT NULL GROUP BY 1, 2, 3),
user_tech AS (
  SELECT m.user_id, u.display_name AS user_name, u.website_url AS user_website,
         e.tag AS tech, CAST(sum(m.score) AS BIGINT) AS score, count(*) AS cnt
  FROM comments m JOIN tag_tokens e ON e.id = m.post_id JOIN users u ON u.id = m.user_id
  WHERE m.user_id IS NOT NULL GROUP BY 1, 2, 3, 4),
graph_edges AS (
  SELECT technode1, technode2, weight, cnt, technode1 || '-' || technode2 AS name FROM (
    SELECT *, row_number() OVER (PARTITION BY technode1 ORDER BY weight DESC, technode2) AS rk
    FROM tech_rel) WHERE rk <= 25),
post_mid AS (SELECT (min(id) + max(id)) // 2 AS mid FROM posts),
comment_mid AS (SELECT (min(id) + max(id)) // 2 AS mid FROM comments),
trend AS (
  SELECT date, year, month, 'red-plate' AS tech_label, 'small-widget' AS tech1_label,
         'hot-ring' AS tech2_label, tech, tech1, tech2
  FROM (SELECT CAST(year(day) AS INT) AS year, CAST(month(day) AS INT) AS month,
               year(day) || '-' || month(day) AS date,
               CAST(coalesce(sum(app_num) FILTER (tech = 'red-plate'), 0) AS BIGINT) AS tech,
               CAST(coalesce(sum(app_num) FILTER (tech = 'small-widget'), 0) AS BIGINT) AS tech1,
               CAST(coalesce(sum(app_num) FILTER (tech = 'hot-ring'), 0) AS BIGINT) AS tech2,
               max(year(day) * 12 + month(day)) OVER () AS last_m,
               year(day) * 12 + month(day) AS m
        FROM tag_date WHERE tech IN ('red-plate', 'small-widget', 'hot-ring')
        GROUP BY year(day), month(day))
  WHERE m < last_m),
related AS (
  SELECT a.technode1, a.name AS name1, a.weight AS weight1, b.name AS name2,
         b.weight AS weight2,
         row_number() OVER (ORDER BY b.weight DESC, a.weight DESC, a.technode1) AS rk
  FROM graph_edges a JOIN graph_edges b USING (technode1)
  WHERE a.technode2 = 'red-plate' AND b.technode2 = 'small-widget')
"""

TAILS = {
    "posts_tagged": "SELECT p.id, p.tags, t.day, t.weight FROM posts p JOIN post_tags t USING (id)",
    "max_id": "SELECT max(id) AS max_id FROM posts",
    "rel_count": "SELECT count(*) AS count_num FROM tech_rel",
    "id_batch": """SELECT CAST(lo + w * size AS BIGINT) AS batch_low,
        CAST(lo + (w + 1) * size AS BIGINT) AS batch_high, count(*) AS posts,
        min(id) AS first_id, max(id) AS last_id, CAST(sum(weight) AS BIGINT) AS weight
        FROM (SELECT id, weight, lo, size, (id - lo) // size AS w
              FROM post_tags, (SELECT min(id) AS lo, (max(id) - min(id) + 5) // 5 AS size FROM posts))
        GROUP BY 1, 2""",
    "id_batch_counts": """SELECT CAST(id // 3000 AS BIGINT) AS batch, count(*) AS posts,
        CAST(sum(weight) AS BIGINT) AS weight FROM post_tags GROUP BY 1""",
    "three_batch_union": """SELECT id, day, weight,
        CAST(lo + (id - lo) // size * size AS BIGINT) AS batch_low,
        CAST(lo + ((id - lo) // size + 1) * size AS BIGINT) AS batch_high
        FROM post_tags, (SELECT min(id) AS lo, (max(id) - min(id) + 3) // 3 AS size FROM posts)""",
    "rel_page": "SELECT * FROM tech_rel ORDER BY technode1, technode2 LIMIT 500 OFFSET 1000",
    "rel_page_ranked": "SELECT * FROM tech_rel ORDER BY technode1, technode2 LIMIT 500 OFFSET 1000",
    "posts_commented": """SELECT id, tags FROM posts
        WHERE id IN (SELECT post_id FROM comments WHERE user_id IS NOT NULL)""",
    "users_commenting": """SELECT id, display_name, website_url FROM users
        WHERE id IN (SELECT user_id FROM comments WHERE user_id IS NOT NULL)""",
    "tag_lists": """SELECT id, day, weight, techlist,
        CAST(len(list_filter(string_split(techlist, ' '), lambda x: x <> '')) AS INT) AS n_tags FROM post_tags""",
    "clean_tag_lists": "SELECT id, techlist FROM clean_lists",
    "tag_tokens": "SELECT id, day, weight, tag FROM tag_tokens",
    "tag_pairs": "SELECT id, day, weight, tech1, tech2 FROM tag_pairs",
    "tech_rel": "SELECT technode1, technode2, weight, cnt FROM tech_rel",
    "tech_node": "SELECT technode, weight, cnt FROM tech_node",
    "tag_date": "SELECT year, day, tech, app_num FROM tag_date",
    "tag_list": "SELECT year, day, techlist, weight, app_num FROM tag_list",
    "tag_year_counts": """SELECT year, count(*) AS n_rows, CAST(sum(app_num) AS BIGINT) AS app_num
        FROM tag_date GROUP BY 1""",
    "comments_tagged": """SELECT m.id, m.user_id, u.display_name AS user_name,
        u.website_url AS user_website, p.tags, m.score
        FROM comments m JOIN posts p ON p.id = m.post_id JOIN users u ON u.id = m.user_id
        WHERE m.user_id IS NOT NULL AND p.tags IS NOT NULL""",
    "user_tech": "SELECT user_id, user_name, user_website, tech, score, cnt FROM user_tech",
    "user_tech_list": """SELECT user_id, user_name, user_website,
        string_agg(tech || ':' || score || ':' || cnt, ',' ORDER BY score DESC, tech) AS techs
        FROM user_tech GROUP BY 1, 2, 3""",
    "graph_vertices": "SELECT technode AS name, weight, cnt FROM tech_node",
    "graph_edges": """SELECT technode1, technode2, name, weight, cnt FROM graph_edges
        WHERE technode1 IN (SELECT technode FROM tech_node)
          AND technode2 IN (SELECT technode FROM tech_node)""",
    "graph_edges_joined": """SELECT technode1, technode2, name, weight, cnt FROM graph_edges
        WHERE technode1 IN (SELECT technode FROM tech_node)
          AND technode2 IN (SELECT technode FROM tech_node)""",
    "user_vertices": r"""SELECT DISTINCT user_id AS id,
        regexp_replace(user_name, '[^\x00-\x7F]', '', 'g') AS name,
        coalesce(regexp_replace(user_website, '[^\x00-\x7F]', '', 'g'), '') AS website
        FROM user_tech""",
    "contribute_edges": r"""SELECT user_id, tech, weight, cnt FROM (
        SELECT user_id, regexp_replace(tech, '[^\x00-\x7F]', '', 'g') AS tech,
               score AS weight, cnt, row_number() OVER (
                 PARTITION BY user_id, regexp_replace(tech, '[^\x00-\x7F]', '', 'g')
                 ORDER BY tech) AS rk FROM user_tech)
        WHERE rk = 1 AND tech IN (SELECT technode FROM tech_node)""",
    "repair_user_names": r"""SELECT id,
        CASE WHEN regexp_matches(n, '[()]')
             THEN string_split(regexp_replace(n, '[()"]', '', 'g'), ',')[1] ELSE n END AS name,
        CASE WHEN regexp_matches(n, '[()]')
             THEN coalesce(string_split(regexp_replace(n, '[()"]', '', 'g'), ',')[2], '')
             ELSE coalesce(w, '') END AS website
        FROM (SELECT id, regexp_replace(w0, '[^\x00-\x7F]', '', 'g') AS w,
                     regexp_replace(n0, '[^\x00-\x7F]', '', 'g') AS n
              FROM (SELECT id, website_url AS w0,
                           CASE WHEN id % 3 = 0
                                THEN '("' || display_name || '",' || coalesce(website_url, '')
                                     || ',3)'
                                ELSE display_name END AS n0 FROM users))""",
    "merge_rel": """SELECT technode1, technode2, CAST(sum(weight) AS BIGINT) AS weight,
        CAST(sum(cnt) AS BIGINT) AS cnt FROM (
          SELECT tech1 AS technode1, tech2 AS technode2, sum(weight) AS weight, count(*) AS cnt
          FROM tag_pairs WHERE id < (SELECT mid FROM post_mid) GROUP BY 1, 2
          UNION ALL
          SELECT tech1, tech2, sum(weight), count(*)
          FROM tag_pairs WHERE id >= (SELECT mid FROM post_mid) GROUP BY 1, 2)
        GROUP BY 1, 2""",
    "user_tech_salted": """SELECT u.id AS user_id, u.display_name AS user_name, u.website_url AS user_website,
        e.tag AS tech, CAST(sum(m.score) AS BIGINT) AS score, count(*) AS cnt
        FROM (SELECT score, user_id, CASE WHEN id % 3 = 0 THEN (SELECT min(id) FROM posts) ELSE post_id END AS post_id
              FROM comments) m
        JOIN tag_tokens e ON e.id = m.post_id JOIN users u ON u.id = m.user_id GROUP BY 1, 2, 3, 4""",
    "user_tech_bucketed": "SELECT user_id, user_name, user_website, tech, score, cnt FROM user_tech",
    "id_bounds": "SELECT min(id) AS min_id, max(id) AS max_id, count(*) AS count_num FROM posts",
    "refreshed_edges": "SELECT technode1, technode2, name, weight, cnt FROM graph_edges",
    "run_store_rel": "SELECT technode1, technode2, weight, cnt FROM tech_rel",
    "late_ids_node": "SELECT technode, weight, cnt FROM tech_node",
    "merge_node": "SELECT technode, weight, cnt FROM tech_node",
    "merge_date": "SELECT year, day, tech, app_num FROM tag_date",
    "merge_list": "SELECT year, day, techlist, weight, app_num FROM tag_list",
    "merge_user_tech": "SELECT user_id, user_name, user_website, tech, score, cnt FROM user_tech",
    "renamed_user_list": f"""SELECT user_id, user_name, user_website,
        string_agg(tech || ':' || score || ':' || cnt, ',' ORDER BY score DESC, tech) AS techs
        FROM ({_RENAMED}) GROUP BY 1, 2, 3""",
    "renamed_user_vertices": rf"""SELECT DISTINCT user_id AS id,
        regexp_replace(user_name, '[^\x00-\x7F]', '', 'g') AS name,
        coalesce(regexp_replace(user_website, '[^\x00-\x7F]', '', 'g'), '') AS website
        FROM ({_RENAMED})""",
    "insert_if_absent": """SELECT technode1, technode2, weight, cnt FROM (
        SELECT technode1, technode2, weight, cnt,
               row_number() OVER (PARTITION BY technode1, technode2 ORDER BY b) AS rk
        FROM (SELECT tech1 AS technode1, tech2 AS technode2,
                     CAST(sum(weight) AS BIGINT) AS weight, count(*) AS cnt, b
              FROM (SELECT *, CASE WHEN id < (SELECT mid FROM post_mid) THEN 0 ELSE 1 END AS b
                    FROM tag_pairs)
              GROUP BY technode1, technode2, b))
        WHERE rk = 1""",
    "monthly_trend": "SELECT * FROM trend",
    "trend_extents": """SELECT min(make_date(year, month, 1)) AS first_month,
        max(make_date(year, month, 1)) AS last_month,
        CAST(max(greatest(tech, tech1, tech2)) AS BIGINT) AS max_value FROM trend""",
    "bar_extents": """SELECT rate, max(value) AS max_value FROM (
        SELECT 'weight' AS rate, weight AS value FROM tech_rel
        WHERE technode1 = 'red-plate' AND technode2 IN ('small-widget', 'hot-ring')
        UNION ALL
        SELECT 'count', cnt FROM tech_rel
        WHERE technode1 = 'red-plate' AND technode2 IN ('small-widget', 'hot-ring'))
        GROUP BY rate""",
    "compare_edge": """SELECT e.technode1, e.technode2, e.weight, e.cnt, a.weight AS weight1,
        a.cnt AS cnt1, b.weight AS weight2, b.cnt AS cnt2
        FROM tech_rel e JOIN tech_node a ON a.technode = e.technode1
        JOIN tech_node b ON b.technode = e.technode2
        WHERE e.technode1 = 'red-plate' AND e.technode2 IN ('small-widget', 'hot-ring')""",
    "compare_edge_long": """SELECT 'with ' || technode2 AS category, 'weight' AS rate,
        weight AS value FROM tech_rel
        WHERE technode1 = 'red-plate' AND technode2 IN ('small-widget', 'hot-ring')
        UNION ALL
        SELECT 'with ' || technode2, 'count', cnt FROM tech_rel
        WHERE technode1 = 'red-plate' AND technode2 IN ('small-widget', 'hot-ring')""",
    "common_contributors": """SELECT b.user_id, b.user_name,
        coalesce(b.user_website, '') AS user_web, b.score AS weight, b.cnt
        FROM user_tech a JOIN user_tech b USING (user_id)
        WHERE a.tech = 'red-plate' AND b.tech = 'small-widget'
        ORDER BY b.score DESC, a.score DESC, b.user_id LIMIT 4""",
    "related_techs": """SELECT technode1 AS tech, name1, weight1, name2, weight2
        FROM related WHERE rk <= 10""",
    "related_graph_nodes": """SELECT CAST(0 AS INT) AS id, 'red-plate' AS name
        UNION ALL SELECT CAST(1 AS INT), 'small-widget'
        UNION ALL SELECT CAST(rk + 1 AS INT), technode1 FROM related WHERE rk <= 10""",
    "related_graph_edges": """SELECT CAST(rk + 1 AS INT) AS source, CAST(0 AS INT) AS target,
        name1 AS name FROM related WHERE rk <= 10
        UNION ALL
        SELECT CAST(rk + 1 AS INT), CAST(1 AS INT), name2 FROM related WHERE rk <= 10""",
    "neighbourhood": """SELECT e.technode2 AS name, v.weight AS node_weight, v.cnt AS node_cnt,
        e.name AS edge_name, e.weight, e.cnt
        FROM graph_edges e JOIN tech_node v ON v.technode = e.technode2
        WHERE e.technode1 = 'red-plate'""",
    "tech_rank_in_range": """SELECT tech AS text, value, CAST(rk AS INT) AS rank FROM (
        SELECT tech, CAST(sum(app_num) AS BIGINT) AS value,
               row_number() OVER (ORDER BY sum(app_num) DESC, tech) AS rk
        FROM tag_date WHERE day BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
        GROUP BY tech) WHERE rk <= 10""",
    "rank_by_rollup": """SELECT tech AS text, value, CAST(rk AS INT) AS rank FROM (
        SELECT tech, CAST(sum(app_num) AS BIGINT) AS value,
               row_number() OVER (ORDER BY sum(app_num) DESC, tech) AS rk
        FROM tag_date WHERE day BETWEEN DATE '1993-03-15' AND DATE '1997-10-20'
        GROUP BY tech) WHERE rk <= 10""",
    "tag_rollup": """SELECT year, 'month' AS level, CAST(date_trunc('month', day) AS DATE) AS day, tech,
            CAST(sum(app_num) AS BIGINT) AS app_num FROM tag_date GROUP BY 1, 2, 3, 4
        UNION ALL SELECT year, 'year', CAST(date_trunc('year', day) AS DATE), tech,
            CAST(sum(app_num) AS BIGINT) FROM tag_date GROUP BY 1, 2, 3, 4""",
    "top_users_for_tech": """SELECT user_id, user_name AS name,
        coalesce(user_website, '') AS url_web, score AS value, cnt
        FROM user_tech WHERE tech = 'red-plate' ORDER BY score DESC, user_id LIMIT 10""",
}

TAILS["trend_by_rollup"] = TAILS["monthly_trend"]


def oracle_sql() -> dict[str, str]:
    return {name: PRELUDE + tail for name, tail in TAILS.items()}
