"""DuckDB oracle SQL for the registered queries.

Each statement computes the expected answer straight from the base tables
(``documents``, ``labels``, ``events`` ...) using the stand-in rules, without
any JSON: if the Spark decode/normalise/listing path is wrong, the hashes differ.
Timestamps are built naive (``make_timestamp`` of micros) so the result does
not depend on the DuckDB session time zone.
"""

from __future__ import annotations

E0 = 1704067200

ORACLE: dict[str, str] = {}


def ts(epoch_sql: str) -> str:
    return f"make_timestamp(CAST(round(CAST(({epoch_sql}) AS DOUBLE) * 1000000) AS BIGINT))"


def iso(ts_sql: str) -> str:
    """ISO text with Z; fraction only when non-zero (as the serialiser does)."""
    return (f"CASE WHEN {ts_sql} IS NULL THEN NULL "
            f"WHEN microsecond({ts_sql}) % 1000000 <> 0 THEN strftime({ts_sql}, '%Y-%m-%dT%H:%M:%S.%fZ') "
            f"ELSE strftime({ts_sql}, '%Y-%m-%dT%H:%M:%SZ') END")


POSTS_CTE = f"""
posts_n AS (
  SELECT d.doc_id, 't3_d' || d.doc_id AS fullname, d.source AS subreddit,
         {ts(f"{E0} + 60 * d.doc_id")} AS created,
         CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE d.n_chars % 1000 - 200 END AS score,
         d.n_chars % 50 AS num_comments,
         CAST(0.5 + (d.doc_id % 10) * 0.05 AS DOUBLE) AS upvote_ratio,
         'u' || (d.doc_id % 150) AS author, d.text
  FROM documents d
)"""


def listing(where: str, order: str, limit: int, extra_cte: str = "") -> str:
    return f"""
WITH {POSTS_CTE}{extra_cte},
ranked AS (
  SELECT *, row_number() OVER (ORDER BY {order}, created DESC, fullname ASC) AS rk
  FROM posts_n WHERE {where}
)
SELECT CAST(rk AS BIGINT) AS rank, fullname, subreddit, {iso('created')} AS created_at,
       CAST(score AS BIGINT) AS score
FROM ranked WHERE rk <= {limit}"""


def hot_sql() -> str:
    return ("round(sign(coalesce(score, 0)) * log10(greatest(abs(coalesce(score, 0)), 1)) "
            "+ epoch_us(created) / 1000000.0 / 45000.0, 6)")


ORACLE["normalize_posts"] = f"""
SELECT 'd' || d.doc_id AS id,
       't3_d' || d.doc_id AS fullname,
       'https://www.reddit.com/r/' || d.source || '/comments/d' || d.doc_id || '/p/' AS url,
       CASE WHEN d.doc_id % 4 = 0 THEN NULL
            WHEN d.doc_id % 4 = 1 AND d.doc_id % 3 = 0 THEN ''
            ELSE 'https://ext.example.com/a/' || md5(d.text) END AS link_url,
       d.source AS subreddit, 'r/' || d.source AS subreddit_prefixed,
       'u' || (d.doc_id % 150) AS author,
       CASE WHEN d.doc_id % 9 = 0 THEN NULL ELSE 't2_u' || (d.doc_id % 150) END AS author_fullname,
       substring(d.text, 1, 40) AS title,
       d.text AS text,
       {iso(ts(f"{E0} + 60 * d.doc_id"))} AS created_at,
       CASE WHEN d.doc_id % 3 = 1 THEN {iso(ts(f"{E0} + 60 * d.doc_id + 3600.5"))} END AS edited_at,
       CAST(CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE d.n_chars % 1000 - 200 END AS BIGINT) AS score,
       CAST(round(0.5 + (d.doc_id % 10) * 0.05, 6) AS DOUBLE) AS upvote_ratio,
       CAST(d.n_chars % 50 AS BIGINT) AS num_comments,
       CAST(CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE d.doc_id % 3 END AS BIGINT) AS num_crossposts,
       CASE WHEN l.toxic IS NULL OR d.doc_id % 4 = 3 THEN NULL ELSE l.toxic = 1 END AS over_18,
       (d.doc_id % 6 <> 0 AND d.doc_id % 5 = 1) AS spoiler,
       d.doc_id % 4 = 0 AS is_self,
       false AS is_video,
       coalesce(l.quality = 1, false) AS is_original_content,
       d.doc_id % 17 = 0 AS stickied,
       false AS pinned,
       coalesce(l.toxic = 1, false) AS locked,
       CASE WHEN d.doc_id % 13 = 0 THEN 'moderator' END AS distinguished,
       nullif(d.lang, '') AS flair,
       CASE WHEN d.doc_id % 4 = 0 THEN 'self.' || d.source ELSE 'ext.example.com' END AS domain,
       CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE 'default' END AS thumbnail,
       CAST(CASE WHEN d.doc_id % 5 = 2 AND NOT (d.doc_id % 4 = 1 AND d.doc_id % 3 = 0)
                 THEN 1 ELSE 0 END AS BIGINT) AS media_count,
       CAST(d.doc_id % 4 AS BIGINT) AS total_awards,
       CASE WHEN d.doc_id % 19 = 0 THEN 'moderator' END AS removed,
       '2024-06-01T00:00:00Z' AS captured_at
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""

ORACLE["community_listing_new"] = listing("lower(subreddit) = 'src3'", "created DESC", 20)
ORACLE["community_listing_top"] = listing(
    f"lower(subreddit) = 'src5' AND created > {ts(E0 + 86400)} - INTERVAL 1 DAY "
    f"AND created <= {ts(E0 + 86400)}", "score DESC NULLS LAST", 15)
ORACLE["community_listing_hot"] = listing("lower(subreddit) = 'src7'", f"{hot_sql()} DESC", 15)
ORACLE["community_listing_rising"] = listing(
    f"lower(subreddit) = 'src9' AND created > {ts(E0 + 43200)} - INTERVAL 1 DAY "
    f"AND created <= {ts(E0 + 43200)}",
    f"round((coalesce(score, 0) + coalesce(num_comments, 0)) / "
    f"pow((epoch_us({ts(E0 + 43200)}) - epoch_us(created)) / 3600000000.0 + 2.0, 1.5), 6) DESC", 15)

_UPS = ("CASE WHEN upvote_ratio <> 0.5 THEN round(coalesce(score, 0) * upvote_ratio / "
        "(2.0 * upvote_ratio - 1)) END")
_DOWNS = f"(({_UPS}) - coalesce(score, 0))"
ORACLE["community_listing_controversial"] = listing(
    "lower(subreddit) = 'src11'",
    f"round(CASE WHEN ({_UPS}) > 0 AND {_DOWNS} > 0 THEN pow(({_UPS}) + {_DOWNS}, "
    f"least(({_UPS}), {_DOWNS}) / greatest(({_UPS}), {_DOWNS})) ELSE 0.0 END, 6) DESC", 15)
ORACLE["combined_listing"] = listing(
    f"lower(subreddit) IN ('src1', 'src2', 'src4') AND created >= {ts(E0 + 7200)} "
    f"AND created <= {ts(E0 + 34200)}", "created DESC", 30)


# ---------------------------------------------------------------- paged runs
_RUN_N = "CAST(coalesce(nullif(regexp_extract(run_id, '([0-9]+)$', 1), ''), '0') AS BIGINT)"
PAGED_CTE = f"""
prm AS (
  SELECT run_id, n,
         CASE WHEN n = 13 THEN 0 WHEN n % 4 = 0 THEN 5 WHEN n % 4 = 1 THEN 15
              WHEN n % 4 = 2 THEN 40 END AS lim,
         CASE WHEN n % 3 = 1 THEN {ts(E0 + 60 * 600)} WHEN n % 3 = 2 THEN {ts(E0 + 60 * 300)} END AS since,
         CASE WHEN n % 5 = 3 THEN {ts(E0 + 60 * 900)} END AS until,
         CASE WHEN n % 6 = 5 THEN 2 ELSE 100 END AS budget
  FROM (SELECT run_id, {_RUN_N} AS n FROM (SELECT DISTINCT source AS run_id FROM documents))
),
rk AS (
  SELECT source AS run_id, 't3_d' || doc_id AS fullname, {ts(f"{E0} + 60 * doc_id")} AS created,
         row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS r,
         count(*) OVER (PARTITION BY source) AS n_rows
  FROM documents
),
seen AS (  -- first-seen page of each rank: the repeated row is first seen at the end of the earlier page
  SELECT rk.*, prm.lim, prm.since, prm.until, prm.budget, prm.n,
         CASE WHEN (r - 1) % 9 = 0 AND r > 1 THEN (r - 1) // 9 ELSE (r - 1) // 9 + 1 END AS fp,
         CASE WHEN (r - 1) % 9 = 0 AND r > 1 THEN 9 ELSE (r - 1) % 9 END AS fpos,
         (prm.since IS NOT NULL AND created < prm.since) AS is_old,
         (prm.until IS NOT NULL AND created > prm.until) AS is_new
  FROM rk JOIN prm USING (run_id)
),
pg AS (
  SELECT prm.run_id, p.page_no, prm.lim, prm.budget, prm.since, prm.n
  FROM prm JOIN (SELECT run_id, generate_series AS page_no FROM
                 (SELECT run_id, max((r - 1) // 9 + 1) AS np FROM rk GROUP BY run_id),
                 generate_series(1, np)) p USING (run_id)
),
pagefacts AS (
  SELECT pg.*, (SELECT max((r - 1) // 9 + 1) FROM rk WHERE rk.run_id = pg.run_id) AS np,
         coalesce((SELECT count(*) FROM seen s WHERE s.run_id = pg.run_id AND s.fp = pg.page_no
                   AND NOT s.is_old AND NOT s.is_new), 0) AS n_kept,
         coalesce((SELECT bool_or(s.is_old) FROM seen s WHERE s.run_id = pg.run_id
                   AND s.fp = pg.page_no), false) AS has_old
  FROM pg
),
cum AS (
  SELECT *, coalesce(sum(n_kept) OVER (PARTITION BY run_id ORDER BY page_no
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM pagefacts
),
ev AS (
  SELECT *, CASE WHEN page_no > budget THEN 'max_requests'
                 WHEN n % 7 = 4 AND page_no = 3 THEN 'rate_limited'
                 WHEN lim IS NOT NULL AND before + n_kept >= lim THEN 'limit'
                 WHEN has_old THEN 'since_crossed'
                 WHEN page_no = np THEN 'end' END AS event
  FROM cum
),
stop AS (
  SELECT run_id, arg_min(page_no, page_no) AS stop_page, arg_min(event, page_no) AS event,
         arg_min(before, page_no) AS stop_before, arg_min(page_no < np, page_no) AS has_after
  FROM ev WHERE event IS NOT NULL GROUP BY run_id
),
kept AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.run_id ORDER BY s.r) AS seq, st.stop_page, st.event
  FROM seen s JOIN stop st USING (run_id)
  WHERE NOT s.is_old AND NOT s.is_new
),
items AS (
  SELECT * FROM kept
  WHERE coalesce(lim, 1) > 0
    AND (fp < stop_page OR (fp = stop_page AND event NOT IN ('max_requests', 'rate_limited')))
    AND (lim IS NULL OR seq <= lim)
)"""

ORACLE["paged_run_items"] = f"""
WITH {PAGED_CTE}
SELECT run_id, CAST(seq AS BIGINT) AS seq, fullname, {iso('created')} AS created_at FROM items
"""

ORACLE["paged_run_audit"] = f"""
WITH {PAGED_CTE},
hit AS (  -- the rank that meets the limit, and whether an unseen row follows on its page
  SELECT i.run_id, max(i.r) AS hit_r FROM items i JOIN stop USING (run_id)
  WHERE stop.event = 'limit' GROUP BY i.run_id
),
facts AS (
  SELECT prm.run_id, prm.lim, prm.since,
         st.stop_page, st.event, st.has_after,
         (SELECT count(*) FROM items i WHERE i.run_id = prm.run_id) AS n_items,
         (SELECT min(created) FROM items i WHERE i.run_id = prm.run_id) AS oldest,
         (SELECT max(created) FROM items i WHERE i.run_id = prm.run_id) AS newest,
         coalesce((SELECT bool_or(s.is_old) FROM seen s WHERE s.run_id = prm.run_id
                   AND (s.fp < st.stop_page OR (s.fp = st.stop_page
                        AND st.event NOT IN ('max_requests', 'rate_limited')
                        AND (h.hit_r IS NULL OR s.r <= h.hit_r)))), false) AS old_read,
         coalesce((SELECT count(*) > 0 FROM rk WHERE rk.run_id = prm.run_id
                   AND rk.r > h.hit_r AND ((rk.r - 1) // 9 + 1 = st.stop_page
                        OR ((rk.r - 1) % 9 = 0 AND (rk.r - 1) // 9 = st.stop_page))), false) AS unseen_after
  FROM prm JOIN stop st USING (run_id) LEFT JOIN hit h USING (run_id)
),
audit AS (
  SELECT run_id,
         CAST(CASE WHEN lim = 0 THEN 0 ELSE n_items END AS BIGINT) AS items,
         CASE WHEN lim = 0 THEN 'limit_reached'
              WHEN event = 'limit' THEN CASE WHEN has_after OR unseen_after THEN 'limit_reached'
                                             ELSE 'listing_exhausted' END
              WHEN event = 'end' THEN CASE WHEN n_items = 0 THEN 'no_matches' ELSE 'listing_exhausted' END
              ELSE event END AS stop_reason,
         CAST(CASE WHEN lim = 0 THEN 0 WHEN event IN ('max_requests', 'rate_limited') THEN stop_page - 1
                   ELSE stop_page END AS BIGINT) AS requests_made,
         CASE WHEN lim = 0 THEN false ELSE old_read OR (event = 'end' AND since IS NOT NULL) END
           AS since_target_crossed,
         since IS NOT NULL AS since_given,
         CASE WHEN lim = 0 THEN NULL ELSE oldest END AS oldest,
         CASE WHEN lim = 0 THEN NULL ELSE newest END AS newest
  FROM facts
)
SELECT run_id, items, stop_reason, requests_made, since_target_crossed,
       CAST(CASE WHEN since_given AND NOT since_target_crossed THEN 7
                 WHEN stop_reason = 'rate_limited' THEN 3 ELSE 0 END AS BIGINT) AS status,
       {iso('oldest')} AS oldest, {iso('newest')} AS newest,
       items || ' posts, range ' || coalesce({iso('oldest')}, 'none') || '..' ||
       coalesce({iso('newest')}, 'none') || ', stop reason: ' || stop_reason ||
       ', budget unknown/unknown' AS summary
FROM audit
"""


# ---------------------------------------------------------------- comment forests
def _heap_depth(k: str) -> str:
    parts, bound = [], 3
    for d in range(0, 30):
        parts.append(f"WHEN {k} <= {bound} THEN {d}")
        bound = bound * 3 + 3
    return "CASE " + " ".join(parts) + " END"


def _ancestor(k: str, j: str) -> str:
    return f"CAST(floor(({k} - (pow(3, {j}) - 1) / 2) / pow(3, {j})) AS BIGINT)"


FOREST_CTE = f"""
ev AS (
  SELECT e.*, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events e
),
f0 AS (
  SELECT ev.*, {_heap_depth('k')} AS depth, CAST(floor((k - 1) / 3) AS BIGINT) AS parent_k,
         CASE WHEN user_id % 5 = 0 THEN 2 ELSE 40 END AS cut
  FROM ev
),
f AS (
  SELECT f0.*, 't3_d' || f0.user_id AS thread_id, 't1_e' || f0.event_id AS fullname,
         list_transform(range(f0.depth, -1, -1),
                        lambda j: CAST(({_ancestor('f0.k', 'j')} - 1) % 3 AS INTEGER)) AS path,
         p.event_id AS parent_event_id
  FROM f0 LEFT JOIN ev p ON p.user_id = f0.user_id AND p.k = f0.parent_k
),
capd AS (
  SELECT user_id, k, CASE WHEN event_id % 10 = 3 THEN 0 ELSE depth END AS cap_depth
  FROM f WHERE parent_k = 0
  UNION ALL
  SELECT f.user_id, f.k, CASE WHEN f.event_id % 10 = 3 THEN capd.cap_depth ELSE f.depth END
  FROM f JOIN capd ON f.user_id = capd.user_id AND f.parent_k = capd.k
),
vis AS (
  SELECT f.*, capd.cap_depth FROM f JOIN capd USING (user_id, k) WHERE f.k <= f.cut
),
hid AS (
  SELECT user_id, thread_id, cut, n,
         list_filter(list_transform(range(1, depth + 2), lambda j: {_ancestor('k', 'j')}),
                     lambda a: a <= cut)[1] AS anc_k
  FROM f WHERE k > cut
),
ptr AS (
  SELECT h.thread_id, h.anc_k, count(*) AS ptr_count,
         coalesce(a.path, []::INTEGER[]) AS parent_path,
         CAST(CASE WHEN h.anc_k = 0 THEN least(3, least(h.cut, h.n))
                   ELSE greatest(0, least(3, least(h.cut, h.n) - 3 * h.anc_k)) END AS INTEGER) AS sib_pos,
         CASE WHEN h.anc_k = 0 THEN h.thread_id ELSE a.fullname END AS ptr_parent_id,
         CASE WHEN h.anc_k = 0 THEN 0 ELSE a.depth + 1 END AS ptr_depth
  FROM hid h LEFT JOIN f a ON a.user_id = h.user_id AND a.k = h.anc_k
  GROUP BY h.thread_id, h.anc_k, h.cut, h.n, a.path, a.fullname, a.depth
),
nodes AS (
  SELECT thread_id, 't1' AS kind, path, path[1:len(path) - 1] AS parent_path, path[len(path)] AS sib_pos,
         depth, fullname,
         CASE WHEN parent_k = 0 THEN thread_id ELSE 't1_e' || parent_event_id END AS parent_fullname,
         NULL::VARCHAR AS ptr_parent_id, NULL::BIGINT AS ptr_count, NULL::BIGINT AS ptr_depth,
         cap_depth, event_id, user_id, ts, value, event_type, props
  FROM vis
  UNION ALL
  SELECT thread_id, 'more', list_append(parent_path, sib_pos), parent_path, sib_pos,
         len(parent_path), NULL, ptr_parent_id, ptr_parent_id, ptr_count, ptr_depth,
         NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM ptr
)"""


def _path(col: str = "path") -> str:
    return f"array_to_string({col}, '.')"


# Captures that hold every comment: nothing is hidden, so there are no pointers.
FULL_CTE = FOREST_CTE.replace("CASE WHEN user_id % 5 = 0 THEN 2 ELSE 40 END AS cut", "n AS cut")

ORACLE["normalize_comments"] = f"""
WITH RECURSIVE {FULL_CTE},
mc AS (SELECT thread_id, parent_path AS path, sum(ptr_count) AS more_count FROM ptr GROUP BY 1, 2)
SELECT v.thread_id, 'e' || v.event_id AS id, v.fullname,
       'https://www.reddit.com/r/src' || (v.user_id % 20) || '/comments/d' || v.user_id || '/p/e'
         || v.event_id || '/' AS permalink,
       't3_d' || v.user_id AS post_id, 'src' || (v.user_id % 20) AS subreddit,
       CASE WHEN v.parent_k = 0 THEN 't3_d' || v.user_id ELSE 't1_e' || v.parent_event_id END AS parent_id,
       'u' || (v.event_id % 150) AS author, 't2_u' || (v.event_id % 150) AS author_fullname,
       v.event_type || ' ' || v.props AS text,
       {iso('v.ts')} AS created_at, NULL::VARCHAR AS edited_at,
       CAST(floor(v.value) - 5 AS BIGINT) AS score,
       CAST(CASE WHEN v.event_id % 10 = 3 THEN NULL ELSE v.depth END AS BIGINT) AS depth,
       v.event_id % 150 = v.user_id % 150 AS is_submitter,
       v.event_type = 'signup' AS stickied,
       CASE WHEN v.event_type = 'purchase' THEN 'moderator' END AS distinguished,
       CAST(v.event_id % 2 AS BIGINT) AS controversiality,
       v.value > 45 AS collapsed, false AS score_hidden,
       CAST(v.event_id % 3 AS BIGINT) AS total_awards,
       CAST(v.depth AS BIGINT) AS tree_depth,
       CAST(mc.more_count AS BIGINT) AS more_count,
       '2024-06-01T00:00:00Z' AS captured_at
FROM vis v LEFT JOIN mc ON mc.thread_id = v.thread_id AND mc.path = v.path
"""

ORACLE["forest_flatten"] = f"""
WITH RECURSIVE {FULL_CTE}
SELECT thread_id, kind, {_path()} AS path, CAST(depth AS BIGINT) AS depth,
       CASE WHEN kind = 't1' THEN parent_fullname
            WHEN len(parent_path) = 0 THEN thread_id ELSE ptr_parent_id END AS parent_fullname,
       fullname, CAST(ptr_count AS BIGINT) AS ptr_count, CAST(ptr_depth AS BIGINT) AS ptr_depth
FROM nodes
"""

ORACLE["forest_preorder"] = f"""
WITH RECURSIVE {FULL_CTE}
SELECT thread_id, fullname,
       CAST(row_number() OVER (PARTITION BY thread_id ORDER BY path) AS BIGINT) AS display_rank
FROM nodes WHERE kind = 't1'
"""

ORACLE["forest_depth_counts"] = f"""
WITH RECURSIVE {FULL_CTE}
SELECT thread_id, CAST(depth AS BIGINT) AS depth,
       CAST(sum(CASE WHEN kind = 't1' THEN 1 ELSE 0 END) AS BIGINT) AS comments,
       CAST(sum(CASE WHEN kind = 'more' THEN 1 ELSE 0 END) AS BIGINT) AS pointers,
       CAST(sum(coalesce(ptr_count, 0)) AS BIGINT) AS hidden
FROM nodes GROUP BY thread_id, depth
"""

ORACLE["forest_subtree_weight"] = f"""
WITH RECURSIVE {FULL_CTE}
SELECT a.thread_id, a.fullname,
       CAST(sum(CASE WHEN b.kind = 't1' THEN 1 ELSE 0 END) AS BIGINT) AS comments_below,
       CAST(sum(CASE WHEN b.kind = 't1' THEN 1 ELSE b.ptr_count END) AS BIGINT) AS weight
FROM nodes a JOIN nodes b ON a.thread_id = b.thread_id AND b.path[1:len(a.path)] = a.path
WHERE a.kind = 't1'
GROUP BY a.thread_id, a.fullname
"""

ORACLE["forest_pointers"] = f"""
WITH RECURSIVE {FOREST_CTE},
r AS (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY path) AS display_rank FROM nodes)
SELECT thread_id, {_path()} AS path, ptr_parent_id, CAST(ptr_count AS BIGINT) AS ptr_count,
       CAST(ptr_depth AS BIGINT) AS ptr_depth, CAST(display_rank AS BIGINT) AS display_rank
FROM r WHERE kind = 'more'
"""


def _cap_sql(keep_pred: str) -> str:
    return f"""
WITH RECURSIVE {FULL_CTE},
t1r AS (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY path) AS r FROM nodes WHERE kind = 't1'),
kept_t1 AS (SELECT thread_id, path, fullname, cap_depth FROM t1r WHERE {keep_pred}),
marked AS (
  SELECT n.*, k.path IS NOT NULL AS kept, (len(n.parent_path) = 0 OR kp.path IS NOT NULL) AS parent_kept
  FROM nodes n
  LEFT JOIN kept_t1 k ON k.thread_id = n.thread_id AND k.path = n.path
  LEFT JOIN kept_t1 kp ON kp.thread_id = n.thread_id AND kp.path = n.parent_path
),
cutpos AS (
  SELECT thread_id, parent_path, min(sib_pos) AS cut_pos FROM marked
  WHERE kind = 't1' AND NOT kept AND parent_kept GROUP BY 1, 2
),
m2 AS (
  SELECT m.*, (m.kept OR (m.kind = 'more' AND m.parent_kept
                          AND (c.cut_pos IS NULL OR m.sib_pos < c.cut_pos))) AS keep
  FROM marked m LEFT JOIN cutpos c ON c.thread_id = m.thread_id AND c.parent_path = m.parent_path
),
om AS (
  SELECT o.thread_id, o.path, CASE WHEN o.kind = 't1' THEN 1 ELSE o.ptr_count END AS w,
         coalesce(max(len(k.path)), 0) AS alen
  FROM m2 o LEFT JOIN kept_t1 k ON k.thread_id = o.thread_id AND len(k.path) < len(o.path)
       AND o.path[1:len(k.path)] = k.path
  WHERE NOT o.keep
  GROUP BY o.thread_id, o.path, o.kind, o.ptr_count
),
rem AS (
  SELECT thread_id, path[1:alen] AS anc, sum(w) AS omitted FROM om GROUP BY 1, 2
),
lastpos AS (SELECT thread_id, parent_path AS anc, max(sib_pos) AS last FROM m2 WHERE keep GROUP BY 1, 2),
synth AS (
  SELECT r.thread_id, 'more' AS kind,
         list_append(r.anc, CAST(coalesce(l.last + 1, 0) AS INTEGER)) AS path, NULL::VARCHAR AS fullname,
         coalesce(k.fullname, r.thread_id) AS ptr_parent_id, r.omitted AS ptr_count,
         CASE WHEN len(r.anc) = 0 THEN 0 ELSE k.cap_depth END AS ptr_depth, true AS synthetic
  FROM rem r LEFT JOIN kept_t1 k ON k.thread_id = r.thread_id AND k.path = r.anc
  LEFT JOIN lastpos l ON l.thread_id = r.thread_id AND l.anc = r.anc
)
SELECT thread_id, kind, {_path()} AS path, fullname, ptr_parent_id, CAST(ptr_count AS BIGINT) AS ptr_count,
       CAST(ptr_depth AS BIGINT) AS ptr_depth, false AS synthetic
FROM m2 WHERE keep
UNION ALL
SELECT thread_id, kind, {_path()}, fullname, ptr_parent_id, CAST(ptr_count AS BIGINT),
       CAST(ptr_depth AS BIGINT), synthetic FROM synth
"""


ORACLE["forest_cap"] = _cap_sql("r <= 20")
ORACLE["forest_depth_cap"] = _cap_sql("depth <= 1")

def _anchor_sql(event_type: str, context: int, upper_ids: bool) -> str:
    cid = "upper('e' || event_id)" if upper_ids else "'e' || event_id"
    return f"""
WITH RECURSIVE {FULL_CTE},
anchors AS (SELECT 't3_d' || user_id AS thread_id, {cid} AS comment_id FROM events
            WHERE event_type = '{event_type}'),
hit AS (
  SELECT a.thread_id, a.comment_id, v.path FROM anchors a
  LEFT JOIN vis v ON v.thread_id = a.thread_id AND 'e' || v.event_id = lower(a.comment_id)
),
roots AS (SELECT thread_id, comment_id, path[1:greatest(1, len(path) - {context})] AS root FROM hit
          WHERE path IS NOT NULL)
SELECT r.comment_id, true AS found, r.thread_id, n.kind, {_path('n.path')} AS path, n.fullname
FROM roots r JOIN nodes n ON n.thread_id = r.thread_id AND n.path[1:len(r.root)] = r.root
UNION ALL
SELECT comment_id, false, thread_id, NULL, NULL, NULL FROM hit WHERE path IS NULL
"""


ORACLE["forest_context"] = _anchor_sql("signup", 3, False)

ORACLE["forest_anchor"] = _anchor_sql("purchase", 1, True)


def _wilson(u: str, d: str) -> str:
    z = 1.96
    n = f"({u} + {d})"
    p = f"({u} / {n})"
    return (f"round(CASE WHEN {n} > 0 THEN ({p} + {z * z} / (2 * {n}) - {z} * sqrt(({p} * (1 - {p}) + "
            f"{z * z} / (4 * {n})) / {n})) / (1 + {z * z} / {n}) ELSE 0.0 END, 6)")


def _controversy(u: str, d: str) -> str:
    return (f"round(CASE WHEN {u} > 0 AND {d} > 0 THEN pow({u} + {d}, least({u}, {d}) / greatest({u}, {d})) "
            f"ELSE 0.0 END, 6)")


def _comment_sort_sql(key: str) -> str:
    return f"""
WITH RECURSIVE {FULL_CTE},
c AS (
  SELECT thread_id, path, parent_path, sib_pos, fullname, ts AS created,
         CAST(floor(value) - 5 AS BIGINT) AS score, CAST(floor(value) AS DOUBLE) AS ups,
         CAST(event_id % 7 AS DOUBLE) AS downs, event_id % 150 = user_id % 150 AS is_submitter
  FROM nodes WHERE kind = 't1'
),
s AS (
  SELECT *, row_number() OVER (PARTITION BY thread_id, parent_path
                               ORDER BY {key}, created DESC, fullname ASC, sib_pos) - 1 AS new_pos
  FROM c
),
np AS (
  SELECT a.thread_id, a.path, list(b.new_pos ORDER BY len(b.path)) AS sorted_path
  FROM s a JOIN s b ON a.thread_id = b.thread_id AND a.path[1:len(b.path)] = b.path
  GROUP BY a.thread_id, a.path
)
SELECT s.thread_id, s.fullname, CAST(s.new_pos AS BIGINT) AS sibling_rank,
       CAST(row_number() OVER (PARTITION BY s.thread_id ORDER BY np.sorted_path) AS BIGINT) AS display_rank
FROM s JOIN np ON np.thread_id = s.thread_id AND np.path = s.path
"""


ORACLE["comment_sort_confidence"] = _comment_sort_sql(f"{_wilson('ups', 'downs')} DESC")
ORACLE["comment_sort_top"] = _comment_sort_sql("score DESC NULLS LAST")
ORACLE["comment_sort_new"] = _comment_sort_sql("created DESC NULLS LAST")
ORACLE["comment_sort_old"] = _comment_sort_sql("created ASC NULLS LAST")
ORACLE["comment_sort_controversial"] = _comment_sort_sql(f"{_controversy('ups', 'downs')} DESC")
ORACLE["comment_sort_qa"] = _comment_sort_sql(f"is_submitter DESC, {_wilson('ups', 'downs')} DESC")


# ---------------------------------------------------------------- identifiers
ORACLE["resolve_identifiers"] = r"""
WITH p AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS lang,
         'K' || hex(page_id) AS pid FROM pages
),
x AS (
  SELECT page_id, pid, lang, page_id % 8 AS r,
         lang || '_' || page_id AS sub1,
         lang || 'x+grp' || page_id || CASE WHEN page_id % 3 = 0 THEN '+' ELSE '' END AS grp,
         lang || 'x' AS c4
  FROM p
)
SELECT page_id,
       CASE r WHEN 0 THEN 'subreddit' WHEN 1 THEN 'subreddit' WHEN 2 THEN 'subreddit_group'
              WHEN 3 THEN 'user' WHEN 4 THEN 'post' WHEN 5 THEN 'comment' WHEN 6 THEN 'subreddit'
              ELSE 'post' END AS resolver,
       CASE WHEN r = 1 AND regexp_full_match(sub1, '[A-Za-z0-9_]{3,21}') THEN 'subreddit'
            WHEN r = 2 AND page_id % 3 <> 0 AND regexp_full_match(lang || 'x', '[A-Za-z0-9_]{3,21}')
                 THEN 'subreddits'
            WHEN r = 3 THEN 'user'
            WHEN r = 4 AND regexp_full_match(c4, '[A-Za-z0-9_]{3,21}') THEN 'post'
            WHEN r = 5 AND regexp_full_match(c4, '[A-Za-z0-9_]{3,21}') THEN 'comment'
            WHEN r = 7 THEN 'post' END AS kind,
       CASE WHEN r = 1 AND regexp_full_match(sub1, '[A-Za-z0-9_]{3,21}') THEN sub1
            WHEN r = 2 AND page_id % 3 <> 0 AND regexp_full_match(lang || 'x', '[A-Za-z0-9_]{3,21}') THEN grp
            WHEN r = 3 THEN 'u_' || page_id
            WHEN r IN (4, 5) AND regexp_full_match(c4, '[A-Za-z0-9_]{3,21}') THEN c4 END AS community,
       CASE WHEN r IN (4, 5) AND regexp_full_match(c4, '[A-Za-z0-9_]{3,21}') THEN lower(pid)
            WHEN r = 7 THEN lower(pid) END AS post_id,
       CASE WHEN r = 5 AND regexp_full_match(c4, '[A-Za-z0-9_]{3,21}') THEN lower('C' || hex(page_id)) END
         AS comment_id,
       CASE WHEN r = 0 THEN 'expected a subreddit URL'
            WHEN r = 1 AND NOT regexp_full_match(sub1, '[A-Za-z0-9_]{3,21}') THEN 'invalid subreddit name'
            WHEN r = 2 AND (page_id % 3 = 0 OR NOT regexp_full_match(lang || 'x', '[A-Za-z0-9_]{3,21}'))
                 THEN 'invalid subreddit name'
            WHEN r IN (4, 5) AND NOT regexp_full_match(c4, '[A-Za-z0-9_]{3,21}') THEN 'invalid subreddit name'
            WHEN r = 6 THEN 'URLs must not contain credentials' END AS error
FROM x
"""

# ---------------------------------------------------------------- redaction
ORACLE["redact_raw"] = """
WITH e AS (SELECT event_id, event_type, props, repeat(event_type || ' ', 1 + event_id % 9) AS s FROM events)
SELECT CAST(event_id AS BIGINT) AS event_id, '[REDACTED]' AS api_key,
       CASE WHEN length(s) <= 40 THEN s
            ELSE substring(s, 1, 40) || '...[redacted ' || (length(s) - 40) || ' more chars]' END AS selftext,
       '[REDACTED]' AS profile_dir, event_type AS title, '[REDACTED]' AS session,
       '[REDACTED]' AS item_token, props AS item_note, repeat('b', 50) AS body
FROM e
"""

ORACLE["redact_all"] = """
WITH e AS (SELECT event_id, event_type, props, repeat(event_type || ' ', 1 + event_id % 9) AS s FROM events)
SELECT CAST(event_id % 7 AS BIGINT) AS id, '[REDACTED]' AS api_key,
       CASE WHEN length(s) <= 40 THEN s
            ELSE substring(s, 1, 40) || '...[redacted ' || (length(s) - 40) || ' more chars]' END AS selftext,
       event_type AS title, '[REDACTED]' AS item_token, props AS item_note,
       repeat('b', 40) || '...[redacted 10 more chars]' AS body
FROM e
"""

_NAME = (r"(?:api[ _-]?key|access[_-]?token|token|secret|password|cookie|authorization|"
         r"proxy[_-]?authorization|session(?:[_-]?(?:id|token))?|csrf(?:[_-]?token)?)")
_W = r"\pL\pN_"


def _scrub(x: str) -> str:
    s = (f"regexp_replace({x}, '(?i)(\\bbearer\\s+|{_NAME}\\s*[=:]\\s*(?:bearer\\s+)?|[?&]{_NAME}=)"
         f"[^\\s,;&#]+', '\\1[REDACTED]', 'g')")
    s = (f"regexp_replace({s}, '(^|[^{_W}/])(?:~|/(?:Users|home|var|private|tmp|opt|Library))"
         f"(?:/[^\\s,;]*)?', '\\1[REDACTED]', 'g')")
    s = f"regexp_replace({s}, '(^|[^{_W}])[A-Za-z]:[\\\\/][^\\s,;]*', '\\1[REDACTED]', 'g')"
    s = f"regexp_replace({s}, '(^|[^{_W}])\\\\\\\\[^\\\\/\\s]+[\\\\/][^\\s,;]*', '\\1[REDACTED]', 'g')"
    return s


ORACLE["scrub_text"] = f"""
WITH t AS (
  SELECT 'doc:' || doc_id AS key, text FROM documents
  UNION ALL
  SELECT 'conv:' || conv_id || ':' || turn, text || ' token=' || conv_id || 'abc path /home/u' || turn
         || '/x and C:\\Users\\u' || turn || ' Bearer t' || conv_id || ' ?session_id=q' || turn || '&x=1'
  FROM conversations
),
s AS (SELECT key, {_scrub('text')} AS scrubbed FROM t)
SELECT key, scrubbed,
       CASE WHEN length(scrubbed) > 80 THEN '[REDACTED diagnostic text: ' || length(scrubbed) || ' chars]'
            ELSE scrubbed END AS bounded
FROM s
"""

# ---------------------------------------------------------------- PII scan
_TOKENS_CTE = r"""
tok AS (
  SELECT doc_id, t, row_number() OVER () AS tid FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9+/_=\-]{32,}')) AS t FROM documents)
),
ch AS (
  SELECT tid, c, count(*) AS n FROM (SELECT tid, unnest(string_split(t, '')) AS c FROM tok)
  GROUP BY tid, c
),
ent AS (
  SELECT tok.doc_id, tok.tid, tok.t,
         -sum((ch.n / length(tok.t)) * log2(ch.n / length(tok.t))) AS e
  FROM tok JOIN ch USING (tid) GROUP BY tok.doc_id, tok.tid, tok.t
),
tk AS (
  SELECT *, len(list_intersect(string_split_regex(lower(t), '[^a-z0-9]+'),
                               ['dummy', 'example', 'fake', 'fixture', 'sample', 'synthetic', 'test'])) > 0
              AS synthetic,
         CAST(regexp_matches(t, '[a-z]') AS INT) + CAST(regexp_matches(t, '[A-Z]') AS INT)
         + CAST(regexp_matches(t, '[0-9]') AS INT) + CAST(regexp_matches(t, '[+/=_\-]') AS INT) AS classes
  FROM ent
)"""

ORACLE["pii_findings"] = rf"""
WITH {_TOKENS_CTE},
flags AS (
  SELECT d.doc_id,
         regexp_matches(d.text, '[A-Za-z0-9._%+\-]+@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]{{0,61}}[A-Za-z0-9])?\.)+[A-Za-z]{{2,63}}([^A-Za-z0-9.\-]|$)') AS email,
         regexp_matches(d.text, '(^|[^\pL\pN_])(?:\+\d{{1,3}}[ .-])?(?:\(\d{{2,4}}\)|\d{{2,4}})[ .-]\d{{3,4}}[ .-]\d{{3,4}}($|[^\pL\pN_])') AS phone,
         regexp_matches(d.text, '\beyJ[A-Za-z0-9_\-]{{16,}}\.[A-Za-z0-9_\-]{{16,}}(?:\.[A-Za-z0-9_\-]{{8,}})?\b')
           OR EXISTS (SELECT 1 FROM tk WHERE tk.doc_id = d.doc_id AND NOT tk.synthetic
                      AND tk.classes >= 3 AND tk.e >= 4.0) AS secret
  FROM documents d
),
cats AS (
  SELECT doc_id, 'email' AS category, 0 AS pri FROM flags WHERE email
  UNION ALL SELECT doc_id, 'phone', 1 FROM flags WHERE phone
  UNION ALL SELECT doc_id, 'high-entropy-secret', 2 FROM flags WHERE secret
)
SELECT doc_id, category,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pri) - 1 AS BIGINT) AS ord
FROM cats
"""

ORACLE["pii_entropy"] = f"""
WITH {_TOKENS_CTE}
SELECT doc_id, CAST(count(*) AS BIGINT) AS tokens, round(max(e), 6) AS max_entropy,
       CAST(sum(CASE WHEN synthetic THEN 1 ELSE 0 END) AS BIGINT) AS synthetic
FROM tk GROUP BY doc_id
"""

# ---------------------------------------------------------------- budget audit
BUDGET_CTE = f"""
ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events),
b AS (
  SELECT user_id AS client, seq, ts, event_id,
         CASE WHEN event_type = 'error' AND value > 45 THEN 429 ELSE 200 END AS status,
         (seq - 1) % 100 + 1 AS used0, 600 - (seq * 6) % 600 AS reset0,
         NOT (event_id % 13 = 0 OR event_id % 17 = 0) AS valid
  FROM ev
),
p AS (
  SELECT *, CASE WHEN valid THEN CAST(100 - used0 AS DOUBLE) END AS remaining,
         CASE WHEN valid THEN CAST(reset0 AS DOUBLE) END AS reset,
         CASE WHEN valid THEN CAST(used0 AS DOUBLE) END AS used
  FROM b
),
d AS (
  SELECT *, CASE WHEN status = 429 THEN 'stop' WHEN NOT valid THEN 'continue'
                 WHEN remaining <> 0 THEN 'continue'
                 WHEN reset >= 0 AND reset <= 300 THEN 'wait' ELSE 'stop' END AS decision
  FROM p
)"""

ORACLE["budget_advice"] = f"""
WITH {BUDGET_CTE},
j AS (
  SELECT d.*, coalesce(pr.valid AND pr.decision <> 'wait', false) AS pv,
         pr.remaining AS pr_rem, pr.reset AS pr_reset, pr.used AS pr_used
  FROM d LEFT JOIN d pr ON pr.client = d.client AND pr.seq = d.seq - 1
)
SELECT CAST(client AS BIGINT) AS client, CAST(seq AS BIGINT) AS seq, status, remaining, reset, used,
       round(CASE WHEN pv AND pr_rem > 0 AND pr_rem <= pr_used THEN greatest(1.0, pr_reset / pr_rem)
                  ELSE 1.0 END, 6) AS advised_delay,
       coalesce(pv AND pr_rem = 0, false) AS blocked, decision,
       CASE WHEN valid THEN {iso('(ts + to_seconds(CAST(reset AS BIGINT)))')} END AS reset_at,
       CASE WHEN valid THEN CAST(remaining AS VARCHAR) || '/' || CAST(used AS VARCHAR)
            ELSE 'unknown/unknown' END AS budget_text
FROM j
"""

ORACLE["budget_windows"] = f"""
WITH {BUDGET_CTE}
SELECT CAST(client AS BIGINT) AS client, {iso("time_bucket(INTERVAL '10 minutes', ts)")} AS window_start,
       CAST(count(*) AS BIGINT) AS requests,
       CAST(sum(CASE WHEN status = 429 OR remaining = 0 THEN 1 ELSE 0 END) AS BIGINT) AS limited,
       min(remaining) AS min_remaining
FROM d GROUP BY client, time_bucket(INTERVAL '10 minutes', ts)
"""


# ---------------------------------------------------------------- communities, users, lookups
COMM_CTE = """
comm AS (
  SELECT source, count(*) AS n_docs, min(lang) AS lang,
         CAST(coalesce(nullif(regexp_extract(source, '([0-9]+)$', 1), ''), '0') AS BIGINT) AS n
  FROM documents GROUP BY source
)"""

ORACLE["normalize_communities"] = f"""
WITH {COMM_CTE}
SELECT 's' || n AS id, 't5_s' || n AS fullname, source AS name, 'r/' || source AS prefixed,
       'Community ' || source || ' about ' || lang AS title,
       'Posts in ' || lang || ' and more' AS public_description,
       'A ' || lang || ' board with ' || n_docs || ' posts' AS description,
       CAST(n_docs AS BIGINT) AS subscribers, {iso(ts(f"{E0} - 86400 * (n + 1)"))} AS created_at,
       CASE WHEN n % 3 = 0 THEN true WHEN n % 3 = 1 THEN false END AS over_18,
       CASE WHEN n % 4 = 1 THEN 'restricted' ELSE 'public' END AS subreddit_type,
       'https://www.reddit.com/r/' || source || '/' AS url, nullif(lang, '') AS lang,
       CASE WHEN n % 2 = 0 THEN 'https://img.example.com/' || source || '.png'
            ELSE 'https://icon.example.com/' || source || '.png' END AS icon_url,
       n % 7 = 6 AS quarantine, '2024-06-01T00:00:00Z' AS captured_at
FROM comm
"""

ORACLE["normalize_users"] = f"""
SELECT 'c' || c_custkey AS id, 't2_c' || c_custkey AS fullname,
       CASE WHEN c_custkey % 7 = 0 THEN 'u_user_' || c_custkey ELSE 'user_' || c_custkey END AS name,
       {iso(ts(f"{E0} - 3600 * c_custkey"))} AS created_at,
       CAST(floor(c_acctbal) AS BIGINT) AS link_karma, CAST(c_nationkey * 10 AS BIGINT) AS comment_karma,
       CAST(floor(c_acctbal) + c_nationkey * 10 AS BIGINT) AS total_karma,
       c_mktsegment = 'AUTOMOBILE' AS is_gold, c_mktsegment = 'BUILDING' AS is_mod, false AS is_employee,
       c_custkey % 3 = 0 AS verified, c_custkey % 2 = 0 AS has_verified_email,
       CASE WHEN c_custkey % 2 = 0 THEN 'https://snoo.example.com/' || c_custkey || '.png'
            ELSE 'https://icon.example.com/u' || c_custkey || '.png' END AS icon_url,
       true AS accept_followers, '2024-06-01T00:00:00Z' AS captured_at
FROM customer
"""

ORACLE["lookup_communities"] = f"""
WITH {COMM_CTE}
SELECT source AS request, CASE WHEN n % 6 = 5 THEN 'drift' ELSE 'found' END AS verdict,
       CASE WHEN n % 6 = 5 THEN NULL ELSE 't5_s' || n END AS fullname,
       CAST(CASE WHEN n % 6 = 5 THEN NULL ELSE n_docs END AS BIGINT) AS subscribers
FROM comm
UNION ALL
SELECT source || '_gone', 'not_found', NULL, NULL FROM comm
"""

ORACLE["lookup_users"] = """
SELECT 'user_' || c_custkey AS request, CASE WHEN c_custkey % 25 = 24 THEN 'drift' ELSE 'found' END AS verdict,
       CASE WHEN c_custkey % 25 = 24 THEN NULL
            WHEN c_custkey % 7 = 0 THEN 'u_user_' || c_custkey ELSE 'user_' || c_custkey END AS name,
       CAST(CASE WHEN c_custkey % 25 = 24 THEN NULL ELSE floor(c_acctbal) + c_nationkey * 10 END AS BIGINT)
         AS total_karma
FROM customer
UNION ALL
SELECT 'ghost_' || c_custkey, 'not_found', NULL, NULL FROM customer
"""


# ---------------------------------------------------------------- search and related
def _toks(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^\\pL\\pN]+'), lambda t: t <> '')"


def _bm25(terms: list[str], where: str = "true") -> str:
    tfs = ", ".join(f"len(list_filter(toks, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(terms))
    dfs = ", ".join(f"sum(CASE WHEN tf{i} > 0 THEN 1 ELSE 0 END) AS df{i}" for i in range(len(terms)))
    score = " + ".join(
        f"CASE WHEN tf{i} > 0 THEN ln(1.0 + (g.n - g.df{i} + 0.5) / (g.df{i} + 0.5)) * tf{i} * 2.2 / "
        f"(tf{i} + 1.2 * (0.25 + 0.75 * dl / g.avgdl)) ELSE 0.0 END" for i in range(len(terms)))
    matched = " + ".join(f"CAST(tf{i} > 0 AS INTEGER)" for i in range(len(terms)))
    return f"""
WITH {POSTS_CTE},
tt AS (SELECT fullname, created, subreddit, {_toks("substring(text, 1, 40) || ' ' || text")} AS toks
       FROM posts_n WHERE {where}),
s AS (SELECT *, len(toks) AS dl, {tfs} FROM tt),
g AS (SELECT count(*) AS n, avg(dl) AS avgdl, {dfs} FROM s),
sc AS (SELECT s.*, round({score}, 6) AS relevance, {matched} AS matched FROM s, g)"""


ORACLE["search_posts_relevance"] = _bm25(["the", "and"]) + """
SELECT CAST(rk AS BIGINT) AS rank, fullname, relevance, CAST(matched AS BIGINT) AS matched FROM (
  SELECT *, row_number() OVER (ORDER BY relevance DESC, created DESC, fullname) AS rk FROM sc WHERE matched > 0)
WHERE rk <= 25
"""

ORACLE["search_posts_new"] = _bm25(["der", "die"], "lower(subreddit) = 'src6'") + f"""
SELECT CAST(rk AS BIGINT) AS rank, fullname, {iso('created')} AS created_at FROM (
  SELECT *, row_number() OVER (ORDER BY created DESC, fullname) AS rk FROM sc WHERE matched > 0)
WHERE rk <= 20
"""

# The index gives what the scan gives.
ORACLE["search_index_relevance"] = ORACLE["search_posts_relevance"]
ORACLE["search_index_new"] = ORACLE["search_posts_new"]


def _named(fields_sql: str, terms: list[str], order: str, limit: int, base: str, cols: str) -> str:
    arr = "[" + ", ".join(f"'{t}'" for t in terms) + "]"
    return f"""
WITH {COMM_CTE},
base AS ({base}),
m AS (SELECT *, len(list_intersect(list_distinct({fields_sql}), {arr})) AS matched FROM base),
r AS (SELECT *, row_number() OVER (ORDER BY matched DESC, {order}) AS rk FROM m WHERE matched > 0)
SELECT CAST(rk AS BIGINT) AS rank, {cols} FROM r WHERE rk <= {limit}
"""


_COMM_BASE = ("SELECT source AS name, 'Community ' || source || ' about ' || lang AS title, "
              "'A ' || lang || ' board with ' || n_docs || ' posts' AS description, "
              "'Posts in ' || lang || ' and more' AS public_description, n_docs AS subscribers FROM comm")

ORACLE["search_communities"] = _named(
    f"list_concat({_toks('name')}, {_toks('title')}, {_toks('description')})", ["fr", "board"],
    "name", 50, _COMM_BASE, "name, CAST(matched AS BIGINT) AS matched")
ORACLE["discover_communities"] = _named(
    f"list_concat({_toks('name')}, {_toks('title')}, {_toks('public_description')})", ["en", "posts"],
    "subscribers DESC, name", 10, _COMM_BASE, "name, CAST(subscribers AS BIGINT) AS subscribers")
ORACLE["search_users"] = _named(
    _toks("name"), ["user", "77"], f"{ts(f'{E0} - 3600 * c_custkey')} DESC, fullname", 20,
    "SELECT c_custkey, 't2_c' || c_custkey AS fullname, CASE WHEN c_custkey % 7 = 0 THEN "
    "'u_user_' || c_custkey ELSE 'user_' || c_custkey END AS name FROM customer",
    "fullname, name, CAST(matched AS BIGINT) AS matched")

_LINKED = f"""
WITH {POSTS_CTE},
lk AS (
  SELECT fullname, subreddit, created, num_comments, 'https://ext.example.com/a/' || md5(text) AS k
  FROM posts_n WHERE doc_id % 4 <> 0 AND NOT (doc_id % 4 = 1 AND doc_id % 3 = 0)
)"""

ORACLE["related_posts"] = _LINKED + """,
pairs AS (
  SELECT a.fullname, b.fullname AS related,
         row_number() OVER (PARTITION BY a.fullname ORDER BY b.num_comments DESC NULLS LAST,
                            b.created DESC, b.fullname) AS rk
  FROM lk a JOIN lk b ON a.k = b.k AND a.fullname <> b.fullname
)
SELECT fullname, CAST(rk AS BIGINT) AS rank, related FROM pairs WHERE rk <= 5
"""

ORACLE["related_crossposts"] = _LINKED + """,
pairs AS (
  SELECT a.fullname, b.fullname AS related, b.subreddit AS related_subreddit,
         row_number() OVER (PARTITION BY a.fullname ORDER BY b.created DESC, b.fullname) AS rk
  FROM lk a JOIN lk b ON a.k = b.k AND a.fullname <> b.fullname AND a.subreddit <> b.subreddit
)
SELECT fullname, CAST(rk AS BIGINT) AS rank, related, related_subreddit FROM pairs WHERE rk <= 5
"""


# ---------------------------------------------------------------- user activity, profile
def _activity(where: str, order: str) -> str:
    return f"""
WITH RECURSIVE {FULL_CTE}, {POSTS_CTE},
items AS (
  SELECT 't3' AS kind, fullname, created, CAST(score AS BIGINT) AS score FROM posts_n WHERE author = 'u7'
  UNION ALL
  SELECT 't1', fullname, ts, CAST(floor(value) - 5 AS BIGINT) FROM vis WHERE 'u' || (event_id % 150) = 'u7'
),
r AS (SELECT *, row_number() OVER (ORDER BY {order}, created DESC, fullname) AS rk FROM items WHERE {where})
SELECT CAST(rk AS BIGINT) AS rank, kind, fullname, {iso('created')} AS created_at, score FROM r WHERE rk <= 25
"""


ORACLE["user_overview"] = _activity("true", "created DESC")
ORACLE["user_submitted"] = _activity("kind = 't3'", "created DESC")
ORACLE["user_comments"] = _activity("kind = 't1'", "created DESC")
ORACLE["user_top"] = _activity("true", "score DESC NULLS LAST")

ORACLE["author_profile"] = f"""
WITH RECURSIVE {FULL_CTE}, {POSTS_CTE},
items AS (
  SELECT author, 1 AS p, 0 AS c, score, created FROM posts_n
  UNION ALL
  SELECT 'u' || (event_id % 150), 0, 1, CAST(floor(value) - 5 AS BIGINT), ts FROM vis
)
SELECT sha256(author) AS author_key, CAST(sum(p) AS BIGINT) AS posts, CAST(sum(c) AS BIGINT) AS comments,
       CAST(sum(coalesce(score, 0)) AS BIGINT) AS score_sum,
       {iso('min(created)')} AS first_seen, {iso('max(created)')} AS last_seen
FROM items GROUP BY author
"""

# ---------------------------------------------------------------- media, drift, responses, schema
ORACLE["post_media"] = """
WITH p AS (SELECT page_id, url FROM pages),
m AS (
  SELECT page_id, 0 AS ord, 'gallery' AS kind, url || '?x=1&y=2' AS url, 640 AS width, 480 AS height
  FROM p WHERE page_id % 5 = 0
  UNION ALL SELECT page_id, 1, 'gallery', url || '#c', 320, 200 FROM p WHERE page_id % 5 = 0
  UNION ALL SELECT page_id, 0, 'video', url || '/video.mp4', 0, 720 FROM p WHERE page_id % 5 = 1
  UNION ALL SELECT page_id, 0, 'embed', url, 400, 300 FROM p WHERE page_id % 5 = 2
  UNION ALL SELECT page_id, 0, 'embed', url, NULL, NULL FROM p WHERE page_id % 5 = 3
  UNION ALL SELECT page_id, 0, 'image', url, 1024, 768 FROM p WHERE page_id % 5 = 4 AND page_id % 10 <> 9
)
SELECT page_id, CAST(ord AS BIGINT) AS ord, kind, url, CAST(width AS BIGINT) AS width,
       CAST(height AS BIGINT) AS height FROM m
"""

ORACLE["envelope_drift"] = """
SELECT doc_id,
       CASE doc_id % 12 WHEN 1 THEN 'response' WHEN 2 THEN 'response' WHEN 3 THEN 'response.kind'
            WHEN 4 THEN 'response.data' WHEN 5 THEN 'response.data.children'
            WHEN 6 THEN 'response.data.after' WHEN 7 THEN 'response.data.children[0]'
            WHEN 8 THEN 'response.data.children[0].kind' WHEN 9 THEN 'response.data.children[0].data'
            WHEN 10 THEN 'response.data.children[0].kind' END AS path,
       CASE doc_id % 12 WHEN 1 THEN 'a JSON body' WHEN 2 THEN 'a Listing object' WHEN 3 THEN 'Listing'
            WHEN 4 THEN 'an object' WHEN 5 THEN 'a list' WHEN 6 THEN 'a string or null'
            WHEN 7 THEN 'a thing object' WHEN 8 THEN 't1, t2, t3, t5, or more' WHEN 9 THEN 'an object'
            WHEN 10 THEN 'an allowed kind for this query' END AS expected,
       CAST(CASE WHEN doc_id % 12 IN (0, 11) THEN 1 ELSE 0 END AS BIGINT) AS items
FROM documents
"""

ORACLE["classify_responses"] = """
SELECT event_id,
       CASE WHEN event_type = 'click' OR event_id % 11 = 0 THEN 'rate_limited'
            WHEN event_type = 'purchase' THEN 'challenge'
            WHEN event_type = 'view' AND event_id % 5 = 0 THEN 'challenge'
            WHEN (event_type = 'error' AND event_id % 2 = 1) OR (event_type = 'view' AND event_id % 5 = 1)
                 THEN 'not_found'
            WHEN (event_type = 'error' AND event_id % 2 = 0) OR (event_type = 'signup' AND event_id % 2 = 0)
                 THEN 'unavailable'
            WHEN event_type = 'signup' THEN 'challenge'
            ELSE 'ok' END AS outcome
FROM events
"""

ORACLE["schema_conformance"] = """
SELECT 't3_d' || doc_id AS record_id,
       CASE doc_id % 6 WHEN 1 THEN 'title' WHEN 2 THEN 'extra' WHEN 3 THEN 'score' WHEN 4 THEN 'over_18'
            ELSE 'media' END AS field,
       CASE doc_id % 6 WHEN 1 THEN 'missing' WHEN 2 THEN 'extra' ELSE 'type' END AS rule
FROM documents
WHERE doc_id % 6 IN (1, 2, 4, 5) OR (doc_id % 6 = 3 AND doc_id % 11 <> 0)
"""


# ---------------------------------------------------------------- expansion and verdicts
EXPAND_CTE = """
hid_full AS (
  SELECT f.*, list_filter(list_transform(range(1, f.depth + 2), lambda j: CAST(floor((f.k - (pow(3, j) - 1) / 2)
           / pow(3, j)) AS BIGINT)), lambda a: a <= f.cut)[1] AS anc_k
  FROM f WHERE f.k > f.cut
),
anc_ev AS (SELECT user_id, k AS anc_k, event_id AS anc_event FROM f),
ptr2 AS (
  SELECT p.*, a.anc_event FROM ptr p
  LEFT JOIN (SELECT DISTINCT h.thread_id, h.anc_k, a.anc_event FROM hid_full h
             JOIN anc_ev a ON a.user_id = h.user_id AND a.anc_k = h.anc_k) a
    ON a.thread_id = p.thread_id AND a.anc_k = p.anc_k
),
merged AS (
  SELECT thread_id, 't1' AS kind, fullname, path, NULL::BIGINT AS ptr_count, NULL::VARCHAR AS ptr_parent_id FROM vis
  UNION ALL
  SELECT h.thread_id, 't1', h.fullname, h.path, NULL, NULL FROM hid_full h
  JOIN anc_ev a ON a.user_id = h.user_id AND a.anc_k = h.anc_k
  WHERE h.anc_k > 0 AND a.anc_event % 7 <> 3
  UNION ALL
  SELECT thread_id, 'more', NULL, list_append(parent_path, sib_pos), ptr_count, ptr_parent_id FROM ptr2
  WHERE anc_k = 0 OR anc_event % 7 = 3
)"""

ORACLE["forest_expand"] = f"""
WITH RECURSIVE {FOREST_CTE}, {EXPAND_CTE}
SELECT thread_id, kind, fullname, CAST(ptr_count AS BIGINT) AS ptr_count,
       CAST(row_number() OVER (PARTITION BY thread_id ORDER BY path) AS BIGINT) AS display_rank
FROM merged
"""

# requests in display order of their pointers; dead ends cost one too
_REQUESTS = """
req AS (
  SELECT *, row_number() OVER w AS r, coalesce(sum(added) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT thread_id, anc_k, ptr_count, anc_event % 7 = 3 AS dead, CASE WHEN anc_event % 7 = 3 THEN 0 ELSE ptr_count END AS added,
               list_append(parent_path, sib_pos) AS ptr_path FROM ptr2 WHERE anc_k > 0)
  WINDOW w AS (PARTITION BY thread_id ORDER BY ptr_path)
)"""

ORACLE["forest_expand_budget"] = f"""
WITH RECURSIVE {FOREST_CTE}, {EXPAND_CTE}, {_REQUESTS},
made AS (SELECT * FROM req WHERE r <= 3 AND NOT dead),
now AS (
  SELECT thread_id, 't1' AS kind, fullname, path, NULL::BIGINT AS ptr_count FROM vis
  UNION ALL
  SELECT h.thread_id, 't1', h.fullname, h.path, NULL FROM hid_full h JOIN made m ON m.thread_id = h.thread_id AND m.anc_k = h.anc_k
  UNION ALL
  SELECT p.thread_id, 'more', NULL, list_append(p.parent_path, p.sib_pos), p.ptr_count FROM ptr2 p
  LEFT JOIN made m ON m.thread_id = p.thread_id AND m.anc_k = p.anc_k WHERE m.r IS NULL
)
SELECT thread_id, kind, fullname, CAST(ptr_count AS BIGINT) AS ptr_count,
       CAST(row_number() OVER (PARTITION BY thread_id ORDER BY path) AS BIGINT) AS display_rank
FROM now
"""

ORACLE["forest_expand_limit"] = f"""
WITH RECURSIVE {FOREST_CTE}, {EXPAND_CTE}, {_REQUESTS},
base AS (SELECT thread_id, count(*) AS shown, max(user_id) % 5 + 1 AS answered FROM vis GROUP BY thread_id),
total AS (SELECT thread_id, count(*) AS n FROM f GROUP BY thread_id),
done AS (SELECT req.* FROM req JOIN base USING (thread_id) WHERE r + 1 <= 9 AND shown + before < 50 AND r + 1 <= answered),
per AS (
  SELECT b.thread_id, b.answered, b.shown + coalesce((SELECT sum(added) FROM done d WHERE d.thread_id = b.thread_id), 0) AS got,
         1 + (SELECT count(*) FROM done d WHERE d.thread_id = b.thread_id) AS requests,
         (SELECT count(*) FROM req q WHERE q.thread_id = b.thread_id) AS all_requests,
         (SELECT count(*) FROM done d WHERE d.thread_id = b.thread_id AND d.dead) AS dead_ends,
         (SELECT count(*) FROM ptr2 p WHERE p.thread_id = b.thread_id AND p.anc_k = 0) AS t3
  FROM base b
)
SELECT per.thread_id,
       CASE WHEN got > 50 THEN 'comment_limit'
            WHEN t3 + dead_ends + all_requests - (requests - 1) = 0 THEN 'tree_complete'
            WHEN all_requests = requests - 1 AND t3 > 0 THEN 'comment_limit'
            WHEN all_requests = requests - 1 THEN 'depth_capped'
            WHEN got >= 50 THEN 'comment_limit'
            WHEN requests < 9 AND requests >= answered THEN 'rate_limited'
            ELSE 'max_requests' END AS verdict,
       CAST(least(got, 50) AS BIGINT) AS comments, CAST(n - least(got, 50) AS BIGINT) AS hidden, CAST(requests AS BIGINT) AS requests_made
FROM per JOIN total USING (thread_id)
"""

ORACLE["forest_verdict"] = f"""
WITH RECURSIVE {FOREST_CTE}, {EXPAND_CTE},
per AS (
  SELECT thread_id, sum(CASE WHEN kind = 't1' THEN 1 ELSE 0 END) AS comments,
         sum(CASE WHEN kind = 'more' THEN 1 ELSE 0 END) AS pointers,
         max(CASE WHEN kind = 'more' AND ptr_parent_id LIKE 't3_%' THEN 1 ELSE 0 END) AS t3p
  FROM merged GROUP BY thread_id
),
req AS (SELECT thread_id, count(DISTINCT anc_k) AS n FROM ptr WHERE anc_k > 0 GROUP BY thread_id)
SELECT per.thread_id,
       CASE WHEN pointers = 0 THEN 'tree_complete' WHEN t3p = 1 THEN 'comment_limit'
            ELSE 'depth_capped' END AS verdict,
       CAST(comments AS BIGINT) AS comments, CAST(1 + coalesce(req.n, 0) AS BIGINT) AS requests_made,
       '1 post' || CASE WHEN comments > 0 THEN ', ' || comments || ' comment'
                        || CASE WHEN comments = 1 THEN '' ELSE 's' END ELSE '' END
       || ', stop reason: ' || CASE WHEN pointers = 0 THEN 'tree_complete' WHEN t3p = 1 THEN 'comment_limit'
                                    ELSE 'depth_capped' END AS summary
FROM per LEFT JOIN req USING (thread_id)
"""

ORACLE["forest_verdict_depth"] = f"""
WITH RECURSIVE {FOREST_CTE},
per AS (
  SELECT thread_id, sum(CASE WHEN kind = 't1' THEN 1 ELSE 0 END) AS comments,
         sum(CASE WHEN kind = 'more' THEN 1 ELSE 0 END) AS pointers,
         max(CASE WHEN kind = 'more' AND ptr_parent_id LIKE 't3_%' THEN 1 ELSE 0 END) AS t3p
  FROM nodes GROUP BY thread_id
)
SELECT thread_id, CASE WHEN pointers = 0 THEN 'tree_complete' WHEN t3p = 1 THEN 'comment_limit'
                       ELSE 'depth_capped' END AS verdict, CAST(comments AS BIGINT) AS comments
FROM per
"""

ORACLE["forest_signature"] = f"""
WITH RECURSIVE {FULL_CTE},
k AS (
  SELECT thread_id,
         {_path()} || '|' || CASE WHEN kind = 't1' THEN fullname
              ELSE 'more|' || ptr_parent_id || '|' || ptr_count || '|' || coalesce(CAST(ptr_depth AS VARCHAR), 'null')
              END AS key
  FROM nodes
)
SELECT thread_id, CAST(sum(CAST(('0x' || substring(md5(key), 1, 15)) AS BIGINT)) AS VARCHAR) AS signature,
       CAST(count(*) AS BIGINT) AS nodes
FROM k GROUP BY thread_id
"""


# ---------------------------------------------------------------- streaming
ORACLE["stream_ingest"] = f"""
SELECT 't3_d' || doc_id AS fullname, source AS subreddit,
       CAST(CASE WHEN doc_id % 11 = 0 THEN NULL ELSE n_chars % 1000 - 200 END AS BIGINT) AS score,
       {iso(ts(f"{E0} + 60 * doc_id"))} AS created_at
FROM documents
"""
ORACLE["stream_dedup"] = "SELECT DISTINCT props FROM events"
ORACLE["stream_rate_state"] = ORACLE["budget_windows"]


# ---------------------------------------------------------------- structural PII scan
ORACLE["pii_capture_scan"] = r"""
WITH rk0 AS (
  SELECT source, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS r FROM documents
),
rk AS (  -- every string of a post that can hold PII: its text and its outbound link
  SELECT source, doc_id, text, r FROM rk0
  UNION ALL
  SELECT source, doc_id, 'https://ext.example.com/a/' || md5(text), r FROM rk0
  WHERE doc_id % 4 <> 0 AND NOT (doc_id % 4 = 1 AND doc_id % 3 = 0)
),
member AS (
  SELECT source, (r - 1) // 9 + 1 AS p, text FROM rk
  UNION ALL SELECT source, (r - 1) // 9, text FROM rk WHERE (r - 1) % 9 = 0 AND r > 1
),
tok AS (
  SELECT source, p, t, row_number() OVER () AS tid FROM (
    SELECT source, p, unnest(regexp_extract_all(text, '[A-Za-z0-9+/_=\-]{32,}')) AS t FROM member)
),
ch AS (SELECT tid, c, count(*) AS n FROM (SELECT tid, unnest(string_split(t, '')) AS c FROM tok) GROUP BY tid, c),
ent AS (
  SELECT tok.source, tok.p, tok.t, -sum((ch.n / length(tok.t)) * log2(ch.n / length(tok.t))) AS e
  FROM tok JOIN ch USING (tid) GROUP BY tok.source, tok.p, tok.tid, tok.t
),
sec AS (
  SELECT DISTINCT source, p FROM ent
  WHERE len(list_intersect(string_split_regex(lower(t), '[^a-z0-9]+'),
                           ['dummy', 'example', 'fake', 'fixture', 'sample', 'synthetic', 'test'])) = 0
    AND CAST(regexp_matches(t, '[a-z]') AS INT) + CAST(regexp_matches(t, '[A-Z]') AS INT)
        + CAST(regexp_matches(t, '[0-9]') AS INT) + CAST(regexp_matches(t, '[+/=_\-]') AS INT) >= 3
    AND e >= 4.0
),
flags AS (
  SELECT source, p,
         bool_or(regexp_matches(text, '[A-Za-z0-9._%+\-]+@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,63}([^A-Za-z0-9.\-]|$)')) AS email,
         bool_or(regexp_matches(text, '(^|[^\pL\pN_])(?:\+\d{1,3}[ .-])?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}($|[^\pL\pN_])')) AS phone,
         bool_or(regexp_matches(text, '\beyJ[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{16,}(?:\.[A-Za-z0-9_\-]{8,})?\b')) AS jwt
  FROM member GROUP BY source, p
),
posts AS (
  SELECT f.source || ':' || f.p AS response_id, f.email, f.phone, (f.jwt OR s.p IS NOT NULL) AS secret
  FROM flags f LEFT JOIN sec s ON s.source = f.source AND s.p = f.p
),
cats AS (
  SELECT response_id, 'email' AS category, 0 AS pri FROM posts WHERE email
  UNION ALL SELECT response_id, 'phone', 1 FROM posts WHERE phone
  UNION ALL SELECT response_id, 'high-entropy-secret', 2 FROM posts WHERE secret
  UNION ALL SELECT response_id, 'non-synthetic-username', 3 FROM posts
  UNION ALL
  SELECT DISTINCT 'search:user:' || CASE WHEN (r - 1) % 9 = 0 AND r > 1 THEN (r - 1) // 9 ELSE (r - 1) // 9 + 1 END,
         'non-synthetic-username', 3
  FROM (SELECT row_number() OVER (ORDER BY c_custkey) AS r FROM customer)
)
SELECT response_id, category, CAST(row_number() OVER (PARTITION BY response_id ORDER BY pri) - 1 AS BIGINT) AS ord
FROM cats
"""


ORACLE["capture_files"] = """
SELECT doc_id, doc_id % 12 <> 1 AS valid FROM documents
"""

ORACLE["silver_listing"] = listing(
    f"lower(subreddit) IN ('src8', 'src12') AND created >= {ts(E0 + 10800)} "
    f"AND created <= {ts(E0 + 2 * 86400 + 43200)}", "created DESC", 40)

ORACLE["resolve_groups"] = """
WITH g AS (
  SELECT doc_id, doc_id % 12 + 1 AS n,
         array_to_string(list_transform(range(0, CAST(doc_id % 12 AS BIGINT) + 1), lambda k: source || 'x' || k), '+')
           || CASE WHEN doc_id % 13 = 0 THEN '++z9z' ELSE '' END AS raw
  FROM documents
)
SELECT doc_id,
       CASE WHEN n + CASE WHEN doc_id % 13 = 0 THEN 2 ELSE 0 END > 10 OR doc_id % 13 = 0 THEN NULL
            ELSE 'subreddits' END AS kind,
       CASE WHEN n + CASE WHEN doc_id % 13 = 0 THEN 2 ELSE 0 END > 10 OR doc_id % 13 = 0 THEN NULL
            ELSE raw END AS community,
       CASE WHEN n + CASE WHEN doc_id % 13 = 0 THEN 2 ELSE 0 END > 10 THEN 'too many subreddits in a combined listing'
            WHEN doc_id % 13 = 0 THEN 'invalid subreddit name' END AS error
FROM g
"""

ORACLE["forest_dead_ends"] = f"""
WITH RECURSIVE {FOREST_CTE}
SELECT DISTINCT p.thread_id, p.ptr_parent_id AS parent,
       CASE WHEN a.event_id % 7 = 3 THEN 'dead_end' ELSE 'expanded' END AS outcome
FROM ptr p JOIN f a ON a.thread_id = p.thread_id AND a.k = p.anc_k
WHERE p.anc_k > 0
"""


def _nested_json_sql(max_depth: int = 8) -> str:
    head = (
        "rtrim(CAST(json_object("
        "'id', 'e' || v.event_id, 'fullname', v.fullname, "
        "'permalink', 'https://www.reddit.com/r/src' || (v.user_id % 20) || '/comments/d' || v.user_id "
        "|| '/p/e' || v.event_id || '/', "
        "'post_id', 't3_d' || v.user_id, 'subreddit', 'src' || (v.user_id % 20), "
        "'parent_id', CASE WHEN v.parent_k = 0 THEN 't3_d' || v.user_id ELSE 't1_e' || v.parent_event_id END, "
        "'author', 'u' || (v.event_id % 150), 'author_fullname', 't2_u' || (v.event_id % 150), "
        "'text', v.event_type || ' ' || v.props, "
        f"'created_at', {iso('v.ts')}, 'edited_at', NULL::VARCHAR, "
        "'score', CAST(floor(v.value) - 5 AS BIGINT), "
        "'depth', CAST(CASE WHEN v.event_id % 10 = 3 THEN NULL ELSE v.depth END AS BIGINT), "
        "'is_submitter', v.event_id % 150 = v.user_id % 150, 'stickied', v.event_type = 'signup', "
        "'distinguished', CASE WHEN v.event_type = 'purchase' THEN 'moderator' END, "
        "'controversiality', CAST(v.event_id % 2 AS BIGINT), 'collapsed', v.value > 45, "
        "'score_hidden', false, 'total_awards', CAST(v.event_id % 3 AS BIGINT)) AS VARCHAR), '}') "
        "|| ',\"replies\":['")
    tail = ("'],\"more_count\":' || coalesce(CAST(mc.more_count AS VARCHAR), 'null') "
            "|| ',\"captured_at\":\"2024-06-01T00:00:00Z\"}'")
    ctes = [f"""
base AS (
  SELECT v.thread_id, v.path, v.depth, {head} AS head,
         {tail} AS tail
  FROM vis v LEFT JOIN (SELECT thread_id, parent_path AS path, sum(ptr_count) AS more_count FROM ptr
                        GROUP BY 1, 2) mc ON mc.thread_id = v.thread_id AND mc.path = v.path
)"""]
    prev = None
    for d in range(max_depth, -1, -1):
        kids = (f"LEFT JOIN (SELECT thread_id, path[1:len(path) - 1] AS pp, "
                f"string_agg(json, ',' ORDER BY path[len(path)]) AS kids FROM {prev} GROUP BY 1, 2) c "
                f"ON c.thread_id = b.thread_id AND c.pp = b.path" if prev else "")
        kid_text = "coalesce(c.kids, '')" if prev else "''"
        ctes.append(f"""
lvl{d} AS (
  SELECT b.thread_id, b.path, b.head || {kid_text} || b.tail AS json
  FROM base b {kids} WHERE b.depth = {d}
)""")
        prev = f"lvl{d}"
    body = ",".join(ctes)
    return f"""
WITH RECURSIVE {FULL_CTE},{body}
SELECT thread_id, CAST(path[1] AS BIGINT) AS position, json FROM lvl0
"""


ORACLE["thread_nested_json"] = _nested_json_sql()

ORACLE["stream_budget_alerts"] = f"""
WITH {BUDGET_CTE}
SELECT CAST(client AS BIGINT) AS client, CAST(count(*) AS BIGINT) AS low_responses,
       CAST(min(seq) AS BIGINT) AS first_low_seq, CAST(max(seq) AS BIGINT) AS last_low_seq
FROM p WHERE valid AND remaining <= 50 GROUP BY client
"""


def _thread_items_sql() -> str:
    cap = _cap_sql("r <= 20")
    return f"""
WITH capped AS ({cap}),
k AS (SELECT thread_id, kind, string_split(path, '.') AS parts, fullname, ptr_count FROM capped),
r AS (
  SELECT thread_id, kind, coalesce(fullname, 'more:' || ptr_count) AS item,
         row_number() OVER (PARTITION BY thread_id
                            ORDER BY list_transform(parts, lambda x: CAST(x AS INTEGER))) AS position
  FROM k
)
SELECT thread_id, CAST(position AS BIGINT) AS position, kind, item FROM r
UNION ALL
SELECT DISTINCT thread_id, CAST(0 AS BIGINT), 't3', thread_id FROM capped
"""


ORACLE["thread_items"] = _thread_items_sql()


ORACLE["paged_run_chain"] = """
WITH d AS (SELECT source AS run_id, count(*) AS n, (count(*) - 1) // 9 + 1 AS pages,
                  substr(md5(source), 1, 1) < '8' AND (count(*) - 1) // 9 + 1 >= 4 AS back
           FROM documents WHERE source IS NOT NULL GROUP BY source)
SELECT run_id, CAST(CASE WHEN back THEN 28 ELSE least(n, 901) END AS BIGINT) AS items,
       CASE WHEN back THEN 'drift' WHEN pages > 100 THEN 'max_requests' ELSE 'listing_exhausted' END AS stop_reason,
       CAST(CASE WHEN back THEN 4 ELSE least(pages, 100) END AS BIGINT) AS requests_made, CAST(CASE WHEN back THEN 4 ELSE 0 END AS BIGINT) AS status
FROM d
"""

ORACLE["stream_quarantine"] = f"""
SELECT CASE WHEN path IS NULL THEN 't3_d' ELSE 'drift:' END || doc_id AS record, CASE WHEN path IS NULL THEN 'post' ELSE 'drift' END AS reason,
       path, expected
FROM ({ORACLE["envelope_drift"]}) WHERE doc_id % 12 <> 1
UNION ALL SELECT 'drift:' || doc_id, 'challenge', NULL, NULL FROM documents WHERE doc_id % 12 = 1
UNION ALL SELECT 'event:' || event_id, outcome, NULL, NULL FROM (
SELECT event_id,
       CASE WHEN event_type = 'click' THEN 'rate_limited'
            WHEN event_type = 'purchase' THEN 'challenge'
            WHEN event_type = 'view' AND event_id % 5 = 0 THEN 'challenge'
            WHEN (event_type = 'error' AND event_id % 2 = 1) OR (event_type = 'view' AND event_id % 5 = 1) THEN 'not_found'
            WHEN (event_type = 'error' AND event_id % 2 = 0) OR (event_type = 'signup' AND event_id % 2 = 0) THEN 'unavailable'
            WHEN event_type = 'signup' THEN 'challenge' ELSE 'ok' END AS outcome
FROM events) WHERE outcome <> 'ok'
"""

_DRIFTS = """
SELECT doc_id,
       CASE doc_id % 13 WHEN 1 THEN 'response' WHEN 2 THEN 'response' WHEN 3 THEN 'response[0].kind'
            WHEN 4 THEN 'response[0].data.children' WHEN 5 THEN 'response[0].data.children' WHEN 6 THEN 'response[1].data.children[0].kind'
            WHEN 7 THEN 'forest0.data.replies' WHEN 8 THEN 'forest0.data.replies' WHEN 9 THEN 'forest0.0.data.replies'
            WHEN 10 THEN '{ten}' WHEN 11 THEN '{eleven}' WHEN 12 THEN {twelve} END AS path,
       CASE doc_id % 13 WHEN 1 THEN 'a two-element array' WHEN 2 THEN 'a two-element array' WHEN 3 THEN 'Listing'
            WHEN 4 THEN 'exactly one t3 thing' WHEN 5 THEN 'exactly one t3 thing' WHEN 6 THEN 't1 or more'
            WHEN 7 THEN 'an empty string or a Listing' WHEN 8 THEN 'an empty string or a Listing' WHEN 9 THEN 'an empty string or a Listing'
            WHEN 10 THEN '{ten_x}' WHEN 11 THEN '{eleven_x}' WHEN 12 THEN {twelve_x} END AS expected,
       CAST(CASE WHEN doc_id % 13 = 0 THEN 1 WHEN doc_id % 13 = 12 THEN {nodes} ELSE 0 END AS BIGINT) AS nodes
FROM documents
"""
_ONE = ("response[1].data.children", "exactly one t1 thing")
ORACLE["drift_post_responses"] = _DRIFTS.format(
    ten="forest1.data.parent_id", ten_x="a t1_ or t3_ fullname", eleven="forest1.data.count", eleven_x="an integer", twelve="NULL", twelve_x="NULL", nodes=2)
ORACLE["drift_subtrees"] = _DRIFTS.format(
    ten=_ONE[0], ten_x=_ONE[1], eleven=_ONE[0], eleven_x=_ONE[1], twelve=f"'{_ONE[0]}'", twelve_x=f"'{_ONE[1]}'", nodes=0)


ORACLE["search_typed"] = f"""
SELECT 't5' AS kind, rank, matched FROM ({ORACLE["search_communities"]})
UNION ALL SELECT 't2', rank, matched FROM ({ORACLE["search_users"]})
"""

ORACLE["resolve_permalinks"] = """
WITH p AS (SELECT doc_id, doc_id % 8 AS r, coalesce(source, 'none') AS sub, lower(hex(doc_id)) AS pid FROM documents)
SELECT doc_id, CASE r WHEN 0 THEN 'post' WHEN 1 THEN 'comment' END AS kind, CASE WHEN r < 2 THEN sub END AS community,
       CASE WHEN r < 2 THEN 'k' || pid END AS post_id, CASE WHEN r = 1 THEN 'c' || pid END AS comment_id,
       CASE r WHEN 2 THEN 'URLs must not contain credentials' WHEN 3 THEN 'URL host must be an allowed site host'
              WHEN 4 THEN 'expected a post permalink' WHEN 5 THEN 'invalid post id' WHEN 6 THEN 'invalid comment permalink'
              WHEN 7 THEN 'a permalink must be a site URL' END AS error
FROM p
"""

ORACLE["scrub_values"] = """
SELECT doc_id, 'run ' || replace(replace(coalesce(source, 'none'), 'src12', '[REDACTED]'), 'src1', '[REDACTED]')
       || ' in [REDACTED] with token=[REDACTED]' AS scrubbed
FROM documents
"""

_POST_MEDIA = "(doc_id % 5 = 2 AND NOT (doc_id % 4 = 1 AND doc_id % 3 = 0))"
ORACLE["schema_conformance_all"] = f"""
WITH RECURSIVE {FULL_CTE}, {COMM_CTE},
cm AS (SELECT thread_id || '#' || path[1] AS record_id, event_id, value, event_type,
              list_aggregate(list_prepend('', list_transform(path[2:], lambda p: '/replies/' || p)), 'string_agg', '') AS path
       FROM vis),
bad AS (
  SELECT 't3_d' || doc_id AS record_id, CASE WHEN doc_id % 6 = 1 THEN 'Media' ELSE 'Post' END AS record,
         CASE WHEN doc_id % 6 = 1 THEN '/media/0' ELSE '' END AS path,
         CASE doc_id % 6 WHEN 1 THEN 'kind' WHEN 2 THEN 'created_at' WHEN 3 THEN 'media' WHEN 4 THEN 'spoiler' ELSE 'extra' END AS field,
         CASE doc_id % 6 WHEN 1 THEN 'type' WHEN 2 THEN 'format' WHEN 3 THEN 'type' WHEN 4 THEN 'missing' ELSE 'extra' END AS rule
  FROM documents WHERE doc_id % 6 > 1 OR (doc_id % 6 = 1 AND {_POST_MEDIA})
  UNION ALL SELECT record_id, 'Comment', path, 'controversiality', 'type' FROM cm WHERE event_id % 2 = 1 AND value > 45
  UNION ALL SELECT record_id, 'Comment', path, 'distinguished', 'missing' FROM cm WHERE event_type = 'purchase'
  UNION ALL SELECT record_id, 'Comment', path, 'pinned', 'extra' FROM cm WHERE event_type = 'signup'
  UNION ALL SELECT 't5_s' || n, 'Subreddit', '', 'subscribers', 'type' FROM comm WHERE n_docs % 2 = 1
  UNION ALL SELECT 't2_c' || c_custkey, CASE WHEN c_custkey % 11 = 3 THEN 'User' END, '',
                   CASE WHEN c_custkey % 11 = 3 THEN 'total_karma' END,
                   CASE c_custkey % 11 WHEN 3 THEN 'type' WHEN 5 THEN 'not_object' ELSE 'not_json' END
            FROM customer WHERE c_custkey % 11 IN (3, 5, 6)
),
roots AS (
  SELECT 't3_d' || doc_id AS record_id, 'Post' AS record FROM documents
  UNION ALL SELECT record_id, 'Comment' FROM cm WHERE path = ''
  UNION ALL SELECT 't5_s' || n, 'Subreddit' FROM comm
  UNION ALL SELECT 't2_c' || c_custkey, 'User' FROM customer
)
SELECT record_id, record, path, field, rule FROM bad
UNION ALL
SELECT record_id, record, '', NULL, 'ok' FROM roots WHERE record_id NOT IN (SELECT record_id FROM bad)
"""


ORACLE["json_array_sink"] = f"""
WITH {POSTS_CTE}
SELECT row_number() OVER (ORDER BY created DESC, fullname) AS n, fullname, md5(text) AS text_md5, CAST(score AS BIGINT) AS score FROM posts_n
"""

ORACLE["capture_roundtrip"] = """
WITH p AS (
  SELECT page_id, html, url, page_id % 7 AS r, 'page-' || lpad(CAST(page_id AS VARCHAR), 12, '0') AS stem FROM pages
),
named AS (
  SELECT page_id % 5 <> 0 AS valid, r IN (0, 5, 6) AS good,
         CASE r WHEN 1 THEN '../' || stem WHEN 2 THEN '.' || stem WHEN 3 THEN stem || '..json' WHEN 4 THEN repeat(stem, 6)
                ELSE stem || '.json' END AS name,
         CASE WHEN page_id % 5 = 0 THEN md5(html) ELSE md5(CAST(json_object('url', url, 'html', html) AS VARCHAR)) END AS body_md5
  FROM p
)
SELECT row_number() OVER (ORDER BY name) AS seq, name, valid, body_md5 FROM named WHERE good
UNION ALL SELECT NULL, name, NULL, NULL FROM named WHERE NOT good
"""


# Hidden comments are added, their pointers removed, every 17th visible comment edited, all above these changed below.
ORACLE["forest_diff"] = f"""
WITH RECURSIVE {FOREST_CTE},
up AS (
  SELECT user_id, parent_k AS k FROM f WHERE parent_k > 0 AND (k > cut OR event_id % 17 = 0)
  UNION SELECT f.user_id, f.parent_k FROM up JOIN f ON f.user_id = up.user_id AND f.k = up.k WHERE f.parent_k > 0
),
res AS (
  SELECT thread_id, fullname AS node, depth, path,
         CASE WHEN f.k > cut THEN 'added' WHEN event_id % 17 = 0 THEN 'edited' ELSE 'below' END AS change
  FROM f LEFT JOIN up ON up.user_id = f.user_id AND up.k = f.k
  WHERE f.k > cut OR event_id % 17 = 0 OR up.k IS NOT NULL
  UNION ALL SELECT thread_id, 'more:' || ptr_parent_id, depth, path, 'removed' FROM nodes WHERE kind = 'more'
),
was AS (SELECT res.thread_id, res.node, count(*) AS size FROM res JOIN nodes g
        ON g.thread_id = res.thread_id AND g.path[1:len(res.path)] = res.path GROUP BY 1, 2),
now AS (SELECT res.thread_id, res.node, count(*) AS size FROM res JOIN f g
        ON g.thread_id = res.thread_id AND g.path[1:len(res.path)] = res.path GROUP BY 1, 2)
SELECT res.thread_id, res.node, CAST(res.depth AS BIGINT) AS depth, change,
       CASE WHEN change <> 'added' THEN was.size END AS size_before, CASE WHEN change <> 'removed' THEN now.size END AS size_after
FROM res LEFT JOIN was USING (thread_id, node) LEFT JOIN now USING (thread_id, node)
"""


_MIXED_CTE = f"""
th AS (
  SELECT source AS run_id, 't3_d' || doc_id AS fullname, -doc_id AS o, {ts(f"{E0} + 60 * doc_id")} AS created, 1 AS post FROM documents
  UNION ALL
  SELECT 'src' || (user_id % 20), 't1_e' || event_id, event_id + 1, {ts("floor(epoch(ts))")}, 0 FROM events
),
rk AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY o, fullname) AS r FROM th),
runs AS (
  SELECT run_id, n, total, (total - 1) // 9 + 1 AS pages, CASE n % 4 WHEN 0 THEN 5 WHEN 1 THEN 15 WHEN 2 THEN 40 END AS lim,
         CASE WHEN n % 6 = 5 THEN 2 ELSE 30 END AS most
  FROM (SELECT run_id, count(*) AS total, {_RUN_N} AS n FROM rk GROUP BY run_id)
),
need AS (
  SELECT *, CASE WHEN lim <= total THEN greatest(1, CAST(ceil((lim - 1) / 9.0) AS BIGINT)) ELSE pages END AS wanted FROM runs
),
done AS (
  SELECT *, least(wanted, most) AS requests,
         CASE WHEN wanted > most THEN 'max_requests' WHEN lim < total THEN 'limit_reached' ELSE 'listing_exhausted' END AS reason,
         CASE WHEN wanted > most THEN least(total, 9 * most + 1) ELSE least(coalesce(lim, total), total) END AS items
  FROM need
)"""
ORACLE["run_summaries"] = f"""
WITH {_MIXED_CTE},
got AS (
  SELECT d.run_id, sum(post) AS posts, sum(1 - post) AS comments, min(created) AS oldest, max(created) AS newest
  FROM done d JOIN rk ON rk.run_id = d.run_id AND rk.r <= d.items GROUP BY 1
),
txt AS (
  SELECT d.run_id, d.requests, d.reason, oldest, newest,
         concat_ws(', ', CASE WHEN posts > 0 THEN posts || CASE WHEN posts = 1 THEN ' post' ELSE ' posts' END END,
                   CASE WHEN comments > 0 THEN comments || CASE WHEN comments = 1 THEN ' comment' ELSE ' comments' END END) AS counts,
         CASE WHEN n % 5 = 2 OR requests % 4 = 3 THEN 'unknown/unknown' ELSE (600 - requests) || '.0/' || requests || '.0' END AS budget
  FROM done d JOIN got USING (run_id)
)
SELECT run_id, counts, budget, CAST(requests AS BIGINT) AS requests_made,
       counts || ', range ' || {iso('oldest')} || '..' || {iso('newest')} || ', stop reason: ' || reason || ', budget ' || budget AS summary
FROM txt
"""

ORACLE["paged_run_counts"] = f"""
WITH {_MIXED_CTE},
p AS (SELECT run_id, total, unnest(range(1, requests + 1)) AS page_no FROM done)
SELECT run_id, CAST(page_no AS BIGINT) AS page_no, CAST(CASE WHEN page_no = 1 THEN 0 ELSE least(total, 9 * (page_no - 1) + 1) END AS BIGINT) AS seen FROM p
"""
