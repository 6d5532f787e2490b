"""DuckDB statements that state each query independently, over the same tables.

Pairs are built one by one here, windows run over the pairs, and words are stripped per token,
so the statements share no shortcut with the Spark code.
"""

from __future__ import annotations

from postlytics.functions.stopwords import STOP_WORDS
from postlytics.plans.fixtures import EPOCH, SEEDS

_SPACE = r"[ \t\n\x0B\f\r]"
_SEEDS = ", ".join(f"'{s}'" for s in SEEDS)
_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)

# common table expressions by name, in order of dependence
_CTES = {
    "posts": rf"""
        SELECT doc_id AS post_id, text, lang AS language,
               list_filter(string_split_regex(text, '{_SPACE}'),
                           lambda x: regexp_full_match(x, '[A-Z][A-Za-z]*')) AS hashtags,
               list_transform(list_filter(string_split_regex(text, '{_SPACE}'),
                           lambda x: regexp_full_match(x, '[A-Z][A-Za-z]*')), lambda x: lower(x)) AS tags,
               (doc_id * 7919) % 5000 AS followers,
               CASE WHEN (doc_id * 7919) % 5000 <= 300 THEN 'Small'
                    WHEN (doc_id * 7919) % 5000 <= 1800 THEN 'Medium' ELSE 'Large' END AS follower_group,
               CASE WHEN doc_id % 7 = 0 THEN NULL ELSE n_name END AS country,
               doc_id + {EPOCH} AS sec
        FROM documents LEFT JOIN nation ON doc_id % 25 = n_nationkey""",
    "split": f"""
        SELECT *, list_filter(tags, lambda x: x IN ({_SEEDS})) AS seed_tags,
               list_filter(tags, lambda x: x NOT IN ({_SEEDS})) AS other_tags FROM posts""",
    "pairs": """
        SELECT post_id, sec, seed_tag, unnest(other_tags) AS other_tag
        FROM (SELECT post_id, sec, other_tags, unnest(seed_tags) AS seed_tag FROM split)""",
    "tag_buckets": "SELECT other_tag AS tag, sec, count(*) AS n FROM pairs GROUP BY ALL",
    "seed_buckets": "SELECT seed_tag AS tag, sec, count(*) AS n FROM pairs GROUP BY ALL",
    "total_buckets": "SELECT sec, count(*) AS n FROM pairs GROUP BY ALL",
    "tag_windows": """
        SELECT tag, sec, CAST(sum(n) OVER (PARTITION BY tag ORDER BY sec
               RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM tag_buckets""",
    "seed_windows": """
        SELECT tag, sec, CAST(sum(n) OVER (PARTITION BY tag ORDER BY sec
               RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM seed_buckets""",
    "total_windows": """
        SELECT sec, CAST(sum(n) OVER (ORDER BY sec
               RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM total_buckets""",
    "window_shares": """
        SELECT t.tag, sec, t.n, s.n AS pair_total, t.n::DOUBLE / s.n::DOUBLE AS share
        FROM tag_windows t JOIN total_windows s USING (sec)""",
    "overall_shares": """
        SELECT other_tag AS tag, count(*) AS n, (SELECT count(*) FROM pairs) AS pair_total,
               count(*)::DOUBLE / (SELECT count(*) FROM pairs)::DOUBLE AS share
        FROM pairs GROUP BY other_tag""",
    "last_shares": """
        SELECT tag, n, n::DOUBLE / (sum(n) OVER ())::DOUBLE AS share FROM (
            SELECT other_tag AS tag, count(*) AS n FROM pairs
            WHERE sec > (SELECT max(sec) FROM posts) - 300 GROUP BY other_tag)""",
    # promotion as of each post that has no seed tag: pairs of the 300 seconds up to it
    "post_tags": """
        SELECT DISTINCT post_id, sec, tag FROM (
            SELECT post_id, sec, unnest(other_tags) AS tag FROM split WHERE len(seed_tags) = 0)""",
    "promoted_posts": """
        WITH instants AS (
            SELECT tag, sec, CAST(sum(n) OVER (PARTITION BY tag ORDER BY sec
                   RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS BIGINT) AS n
            FROM (SELECT tag, sec, sum(n) AS n FROM (
                    SELECT * FROM tag_buckets UNION ALL SELECT DISTINCT tag, sec, 0 FROM post_tags)
                  GROUP BY ALL)),
        totals AS (
            SELECT sec, CAST(sum(n) OVER (ORDER BY sec
                   RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS BIGINT) AS n
            FROM (SELECT sec, sum(n) AS n FROM (
                    SELECT * FROM total_buckets UNION ALL SELECT DISTINCT sec, 0 FROM posts)
                  GROUP BY ALL))
        SELECT DISTINCT p.post_id, p.sec
        FROM post_tags p JOIN instants i ON p.tag = i.tag AND p.sec = i.sec
        JOIN totals t ON p.sec = t.sec
        WHERE i.n::DOUBLE / nullif(t.n, 0)::DOUBLE >= 0.0025""",
    "accepted": """
        SELECT post_id, 'seed' AS match_kind FROM split WHERE len(seed_tags) > 0
        UNION ALL SELECT post_id, 'promoted' FROM promoted_posts""",
    "plain": rf"""
        SELECT post_id, word FROM (
            SELECT post_id, regexp_replace(unnest(string_split_regex(lower(text), '{_SPACE}')),
                                           '[^A-Za-z0-9]', '', 'g') AS word FROM posts)
        WHERE word <> ''""",
    "clean": f"SELECT * FROM plain WHERE word NOT IN ({_STOP})",
    "word_stats": """
        SELECT word, count(*) AS n, count(DISTINCT post_id) AS df FROM clean GROUP BY word""",
    "word_topics": """
        SELECT word, CAST(t AS INTEGER) AS topic,
               CAST((length(word) * (t + 3) + ascii(word) * (t + 1)) % 97 AS DOUBLE) AS weight
        FROM (SELECT word FROM word_stats WHERE df >= 4), range(10) r(t)""",
    "ranked_words": """
        SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, word) AS rank,
               word, weight FROM word_topics""",
    "labels10": """
        SELECT topic, string_agg(word, ', ' ORDER BY rank) AS label
        FROM ranked_words WHERE rank <= 10 GROUP BY topic""",
    "known": """
        SELECT post_id, topic, sum(weight) AS score FROM clean JOIN word_topics USING (word)
        GROUP BY ALL""",
    "best": """
        SELECT p.post_id, b.topic FROM posts p LEFT JOIN (
            SELECT post_id, topic FROM known WHERE score > 0
            QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY score DESC, topic) = 1) b
        USING (post_id)""",
}


def _sql(body: str, *needs: str) -> str:
    """`body` behind the named expressions and everything they build on."""
    wanted, queue = set(), list(needs)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            text = _CTES[name]
            queue += [n for n in _CTES if n != name and _mentions(text, n)]
    parts = ",\n".join(f"{n} AS ({_CTES[n]})" for n in _CTES if n in wanted)
    return f"WITH {parts}\n{body}" if parts else body


def _mentions(text: str, name: str) -> bool:
    return any(
        f"{word} {name}{end}" in text + " "
        for word in ("FROM", "JOIN")
        for end in (" ", ")", "\n")
    )


_CREATED = f"strftime(make_timestamp((doc_id + {EPOCH}) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


def statements() -> dict[str, str]:
    created = _CREATED.replace("doc_id", "post_id")
    event_windows = """
            SELECT tag, sec, CAST(sum(n) OVER (PARTITION BY tag ORDER BY sec
                   RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS BIGINT) AS n
            FROM (SELECT event_type AS tag, CAST(floor(epoch(ts)) AS BIGINT) AS sec, count(*) AS n
                  FROM events GROUP BY ALL)"""
    typed_posts = _sql(
        """SELECT CAST(post_id AS VARCHAR) AS key, language, sec, country, follower_group,
           array_to_string(tags, ' ') AS tags FROM posts""", "posts")
    return {
        "s1_stream_source": typed_posts,
        "s2_stream_sink": _sql(
            """SELECT CAST(post_id AS VARCHAR) AS key, language, md5(text) AS text_md5 FROM split
               WHERE language = 'en' AND len(seed_tags) > 0""", "split"),
        "w3_stream_window_counts": event_windows,
        "w4_stream_feedback": _sql(
            """SELECT CAST(post_id AS VARCHAR) AS key, match_kind, topic, label
               FROM accepted JOIN best USING (post_id) LEFT JOIN labels10 USING (topic)""",
            "accepted", "best", "labels10"),
        "w4_wrong_dates": _sql(
            """SELECT CAST(post_id AS VARCHAR) AS key, match_kind, topic, label
               FROM accepted JOIN best USING (post_id) LEFT JOIN labels10 USING (topic)""",
            "accepted", "best", "labels10"),
        "w4_out_of_order": _sql(
            """SELECT CAST(post_id AS VARCHAR) AS key, match_kind, topic, label
               FROM accepted JOIN best USING (post_id) LEFT JOIN labels10 USING (topic)""",
            "accepted", "best", "labels10"),
        "s3_collection_scan": "SELECT conv_id, turn, role, length(text) AS length FROM conversations",
        "s4_corpus_append": _sql(
            """SELECT CAST(post_id AS VARCHAR) AS key, coalesce(w.n, 0) AS words, sec * 1000 AS ingested_ms,
               CAST(CASE WHEN language = 'en' THEN 0 ELSE 1 END AS BIGINT) AS batch_id
               FROM posts LEFT JOIN (SELECT post_id, count(*) AS n FROM clean GROUP BY ALL) w USING (post_id)""",
            "posts", "clean"),
        "s5_word_topics_replace": _sql("SELECT * FROM word_topics", "word_topics"),
        "s6_topics_replace": _sql("SELECT * FROM labels10", "labels10"),
        "s7_view_append": _sql(
            """SELECT (sec // 60 + 1) * 60 AS ts, country AS region, follower_group AS "followerGroup",
               language AS topic, CAST(count(*) AS INTEGER) AS count
               FROM split WHERE len(seed_tags) > 0 GROUP BY ALL""", "split"),
        "s8_seed_list": _sql("SELECT DISTINCT unnest(tags) AS tag FROM posts", "posts"),
        "s9_retention": """SELECT event_id, epoch_us(ts) // 1000 AS ingested_ms FROM events
            WHERE epoch_us(ts) // 1000 % 3 <> 1""",
        "s10_row_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS collection, count(*) AS documents FROM {t}"
            for t in ("documents", "conversations", "events", "labels", "nation")),
        "p1_parse_messages": _sql(
            f"""SELECT CAST(post_id AS VARCHAR) AS key, country IS NULL AS bad,
                CASE WHEN country IS NOT NULL THEN language END AS language,
                CASE WHEN country IS NOT NULL THEN len(tags) END AS tags,
                CASE WHEN country IS NOT NULL THEN follower_group END AS follower_group,
                CASE WHEN country IS NOT NULL THEN {created} END AS created FROM posts""", "posts"),
        "p1_good_posts": typed_posts,
        "p1_bad_dates": """
            SELECT CAST(doc_id AS VARCHAR) AS key, doc_id % 5 IN (1, 2) AS bad,
                   CASE doc_id % 5 WHEN 1 THEN 'date' WHEN 2 THEN 'future' END AS reason FROM documents""",
        "p2_record_json": _sql(
            """SELECT post_id, md5(text) AS text_md5, language, follower_group, country AS full_name,
               CAST(NULL AS VARCHAR) AS topic FROM posts""", "posts"),
        "p3_status_record": _sql(
            f"""SELECT post_id, array_to_string(hashtags, ' ') AS hashtags, {created} AS created, language,
                CASE WHEN post_id % 3 <> 0 THEN CAST(post_id % 120 - 60 AS DOUBLE) END AS latitude,
                CASE WHEN post_id % 3 <> 0 THEN CAST(post_id % 300 - 150 AS DOUBLE) END AS longitude,
                upper(country[1:2]) AS country_code, follower_group FROM posts""", "posts"),
        "p4_follower_group": _sql("SELECT post_id, followers, follower_group FROM posts", "posts"),
        "p5_polygon_corners": _sql(
            """SELECT post_id, c AS corner,
               CAST(post_id % 120 - 60 + (CASE WHEN c >= 2 THEN 1 ELSE 0 END) AS DOUBLE) AS latitude,
               CAST(post_id % 300 - 150 + (CASE WHEN c IN (1, 2) THEN 1 ELSE 0 END) AS DOUBLE) AS longitude
               FROM posts, range(4) r(c) WHERE country IS NOT NULL""", "posts"),
        "p6_country": _sql("SELECT post_id, country FROM posts", "posts"),
        "p7_message_key": "SELECT conv_id, turn, sha256(text) AS key FROM conversations",
        "p8_column_drop": "SELECT doc_id, lang, source FROM documents",
        "p9_pair_sides": _sql(
            """SELECT 'seed' AS side, seed_tag AS tag, count(*) AS n FROM pairs GROUP BY ALL
               UNION ALL SELECT 'other', other_tag, count(*) FROM pairs GROUP BY ALL""", "pairs"),
        "f1_seed_membership": _sql(
            "SELECT post_id, len(seed_tags) AS seed_tags, len(other_tags) AS other_tags FROM split", "split"),
        "f2_promoted_membership": _sql(
            """SELECT p.post_id, count(s.tag) AS promoted_tags
               FROM posts p LEFT JOIN (SELECT post_id, unnest(tags) AS tag FROM posts) t ON p.post_id = t.post_id
               LEFT JOIN (SELECT tag FROM overall_shares WHERE share >= 0.0025) s ON t.tag = s.tag
               GROUP BY p.post_id""", "posts", "overall_shares"),
        "f3_with_tags": _sql("SELECT post_id, len(tags) AS tags FROM posts WHERE len(tags) > 0", "posts"),
        "f4_seed_accept": _sql(
            "SELECT post_id, language, follower_group FROM split WHERE len(seed_tags) > 0", "split"),
        "f5_promoted_accept": _sql("SELECT post_id, sec FROM promoted_posts", "promoted_posts"),
        "f6_tracked_posts": _sql(
            """SELECT post_id, language FROM posts WHERE language = 'en'
               AND list_has_any(tags, ['and', 'die', 'is'])""", "posts"),
        "f7_share_threshold": _sql(
            "SELECT tag, sec, share FROM window_shares WHERE share >= 0.0025", "window_shares"),
        "f8_funnel": _sql(
            """SELECT count(*) AS posts, count(*) FILTER (len(tags) = 0) AS without_tags,
               count(*) FILTER (len(tags) > 0 AND len(seed_tags) = 0) AS without_seed,
               count(*) FILTER (len(seed_tags) > 0) AS with_seed,
               (SELECT count(*) FROM accepted) AS with_seed_or_promoted,
               (SELECT count(*) FROM promoted_posts) AS accepted_promoted FROM split""",
            "split", "accepted", "promoted_posts"),
        "f8_stream_funnel": _sql(
            """SELECT count(*) AS posts, count(*) FILTER (len(tags) = 0) AS without_tags,
               count(*) FILTER (len(tags) > 0 AND len(seed_tags) = 0) AS without_seed,
               count(*) FILTER (len(seed_tags) > 0) AS with_seed,
               (SELECT count(*) FROM accepted) AS with_seed_or_promoted,
               (SELECT count(*) FROM promoted_posts) AS accepted_promoted FROM split""",
            "split", "accepted", "promoted_posts"),
        "f9_ingest_counts": _sql(
            """SELECT count(*) AS posts, count(*) FILTER (len(tags) > 0) AS with_tags,
               count(*) FILTER (len(tags) = 0) AS without_tags FROM posts""", "posts"),
        "j1_tag_pairs": _sql(
            "SELECT seed_tag, other_tag, count(*) AS n FROM pairs GROUP BY ALL", "pairs"),
        "j1_post_pairs": _sql(
            "SELECT post_id, seed_tag, other_tag, count(*) AS n FROM pairs GROUP BY ALL", "pairs"),
        "j2_known_words": _sql(
            """SELECT p.post_id, coalesce(k.n, 0) AS known_words FROM posts p LEFT JOIN (
               SELECT post_id, count(*) AS n FROM clean WHERE word IN (SELECT word FROM word_topics)
               GROUP BY ALL) k USING (post_id)""", "posts", "clean", "word_topics"),
        "j3_topic_labels": _sql(
            "SELECT post_id, topic, label FROM best LEFT JOIN labels10 USING (topic)", "best", "labels10"),
        "j4_window_totals": _sql("SELECT tag, sec, n, pair_total FROM window_shares", "window_shares"),
        "j5_accepted_union": _sql("SELECT post_id, match_kind FROM accepted", "accepted"),
        "a1_seed_window_counts": _sql("SELECT * FROM seed_windows", "seed_windows"),
        "a2_tag_window_counts": _sql("SELECT * FROM tag_windows", "tag_windows"),
        "a2_event_window_counts": event_windows,
        "a3_window_total": _sql("SELECT * FROM total_windows", "total_windows"),
        "a4_window_shares": _sql("SELECT tag, sec, share FROM window_shares", "window_shares"),
        "a4_overall_shares": _sql("SELECT * FROM overall_shares", "overall_shares"),
        "a5_promoted_now": _sql("SELECT * FROM last_shares WHERE share >= 0.0025", "last_shares"),
        "a6_topic_counts": _sql(
            """SELECT country AS region, follower_group, language AS topic, count(*) AS count
               FROM split WHERE len(seed_tags) > 0 GROUP BY ALL""", "split"),
        "a7_topic_view": _sql(
            """SELECT (sec // 60 + 1) * 60 AS ts, country AS region, follower_group, label AS topic,
               count(*) AS count
               FROM accepted JOIN posts USING (post_id) JOIN best USING (post_id)
               LEFT JOIN labels10 USING (topic) GROUP BY ALL""",
            "accepted", "posts", "best", "labels10"),
        "a7_late_rows": _sql(
            """SELECT (sec // 60 + 1) * 60 AS ts, count(*) AS posts, count(*) FILTER (post_id % 7 <> 3) AS shown,
               count(*) FILTER (post_id % 7 = 3) AS late
               FROM accepted JOIN posts USING (post_id) GROUP BY ALL""",
            "accepted", "posts"),
        "a7_late_corrections": _sql(
            """SELECT (sec // 60 + 1) * 60 AS ts, country AS region, follower_group, label AS topic,
               count(*) AS count
               FROM accepted JOIN posts USING (post_id) JOIN best USING (post_id)
               LEFT JOIN labels10 USING (topic) GROUP BY ALL""",
            "accepted", "posts", "best", "labels10"),
        "a7_stream_view": _sql(
            """SELECT (sec // 60 + 1) * 60 AS ts, country AS region, follower_group, label AS topic,
               count(*) AS count
               FROM accepted JOIN posts USING (post_id) JOIN best USING (post_id)
               LEFT JOIN labels10 USING (topic) GROUP BY ALL""",
            "accepted", "posts", "best", "labels10"),
        "s9_corpus_switch": """
            SELECT event_id, epoch_us(ts) // 1000 AS ingested_ms, event_id % 3 AS batch_id FROM events
            WHERE event_id % 3 = 2 OR epoch_us(ts) // 1000 % 3 <> 1""",
        "s9_tombstones": """
            SELECT event_id, ms AS ingested_ms, event_id % 5 AS batch_id
            FROM (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
            WHERE NOT (event_id % 5 <= 1 AND ms % 3 = 1) AND NOT (event_id % 5 <= 2 AND ms % 4 = 2)
              AND NOT (event_id % 5 <= 3 AND ms % 2 = 1) AND ms % 5 <> 3""",
        "s9_emptied_corpus": """
            SELECT event_id, epoch_us(ts) // 1000 AS ingested_ms, CAST(1 AS BIGINT) AS batch_id
            FROM events WHERE event_id % 2 = 1""",
        "s4_compaction": """
            SELECT event_id, epoch_us(ts) // 1000 AS ingested_ms, event_id % 50 AS batch_id,
                   CAST(31 AS BIGINT) AS folders FROM events""",
        "a8_topic_scores": _sql(
            """SELECT p.post_id, CAST(t AS INTEGER) AS topic, coalesce(k.score, 0.0) AS score
               FROM (SELECT post_id, t FROM posts, range(10) r(t)) p
               LEFT JOIN known k ON p.post_id = k.post_id AND p.t = k.topic""", "posts", "known"),
        "a9_best_topic": _sql("SELECT post_id, topic FROM best", "best"),
        "a9_best_topic_positional": _sql(
            """SELECT p.post_id, coalesce(b.topic, 0) AS topic FROM posts p LEFT JOIN (
               SELECT post_id, topic FROM known WHERE topic > 0 AND score > 0
               QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY score * (10 - topic) DESC, topic) = 1) b
               USING (post_id)""", "posts", "known"),
        "a10_top_words": _sql(
            "SELECT topic, CAST(rank AS INTEGER) AS rank, word, weight FROM ranked_words WHERE rank <= 10",
            "ranked_words"),
        "a11_weights_by_word": _sql(
            """SELECT word, string_agg(topic || ':' || CAST(weight AS BIGINT), ' ' ORDER BY topic) AS entries
               FROM word_topics GROUP BY word""", "word_topics"),
        "a12_top_shares": _sql(
            "SELECT tag, share FROM last_shares ORDER BY share DESC, tag LIMIT 10", "last_shares"),
        "a13_follower_terciles": _sql(
            """SELECT CASE WHEN k >= n * 2 // 3 THEN 'big' WHEN k >= n // 3 THEN 'medium' ELSE 'small' END AS tercile,
               count(*) AS n, avg(followers) AS average, min(followers) AS lowest, max(followers) AS highest
               FROM (SELECT followers, row_number() OVER (ORDER BY followers) AS k, count(*) OVER () AS n FROM posts)
               GROUP BY 1""", "posts"),
        "a14_location_counts": _sql(
            """SELECT CASE WHEN post_id % 3 = 0 THEN 'null' ELSE
               CAST(post_id % 120 - 60 AS DOUBLE) || ',' || CAST(post_id % 300 - 150 AS DOUBLE) END AS location,
               count(*) AS count FROM posts GROUP BY ALL""", "posts"),
        "a14_place_counts": _sql(
            "SELECT coalesce(country, 'null') AS place, count(*) AS count FROM posts GROUP BY ALL", "posts"),
        "t1_tokens": _sql(
            rf"""SELECT token, count(*) AS n FROM (
                SELECT unnest(CASE WHEN text <> '' AND kept = '' THEN [] ELSE string_split_regex(kept, '{_SPACE}') END) AS token
                FROM (SELECT text, regexp_replace(lower(text), '{_SPACE}+$', '') AS kept FROM posts))
                GROUP BY ALL""", "posts"),
        "t2_stripped_tokens": _sql("SELECT word, count(*) AS n FROM plain GROUP BY ALL", "plain"),
        "t3_nonempty_words": _sql(
            """SELECT post_id, coalesce(w.n, 0) AS words FROM posts
               LEFT JOIN (SELECT post_id, count(*) AS n FROM plain GROUP BY ALL) w USING (post_id)""",
            "posts", "plain"),
        "t4_stop_words": rf"""
            SELECT conv_id, turn, len(list_filter(w, lambda x: x NOT IN ({_STOP}))) AS kept,
                   len(list_filter(w, lambda x: x IN ({_STOP}))) AS removed
            FROM (SELECT conv_id, turn, list_filter(list_transform(string_split_regex(lower(text), '{_SPACE}'),
                  lambda x: regexp_replace(x, '[^A-Za-z0-9]', '', 'g')), lambda x: x <> '') AS w FROM conversations)""",
        "t5_clean_words": _sql("SELECT word, count(*) AS n FROM clean GROUP BY ALL", "clean"),
        "t5_conversation_words": rf"""
            SELECT word, count(*) AS n FROM (
                SELECT regexp_replace(unnest(string_split_regex(lower(text), '{_SPACE}')), '[^A-Za-z0-9]', '', 'g') AS word
                FROM conversations) WHERE word <> '' AND word NOT IN ({_STOP}) GROUP BY ALL""",
        "t6_sentences": rf"""
            SELECT post_id, md5(s) AS md5, length(s) AS length FROM (
                SELECT doc_id AS post_id, array_to_string(list_filter(list_transform(
                       string_split_regex(lower(text), '{_SPACE}'),
                       lambda x: regexp_replace(x, '[^A-Za-z0-9]', '', 'g')),
                       lambda x: x <> '' AND x NOT IN ({_STOP})), ' ') AS s FROM documents)""",
        "t7_vocabulary": _sql(
            "SELECT word, n, df FROM word_stats WHERE df >= 4", "word_stats"),
        "t8_topic_fit": _sql(
            """SELECT CAST(t AS INTEGER) AS topic, n AS words, n AS different, n AS known
               FROM range(10) r(t), (SELECT least(10, count(*)) AS n FROM word_stats WHERE df >= 4)""", "word_stats"),
        "t12_evaluation": _sql(
            """SELECT count(*) AS tokens, true AS below_zero FROM clean JOIN word_stats USING (word)
               WHERE df >= 4 AND CAST('0x' || substr(md5(post_id || '1'), 1, 8) AS BIGINT) % 5 = 0""",
            "clean", "word_stats"),
        "t9_topic_mass": _sql(
            """SELECT CAST(t AS INTEGER) AS topic, (SELECT count(*) FROM word_stats WHERE df >= 4) AS terms,
               CAST(1 AS DOUBLE) AS mass FROM range(10) r(t)""", "word_stats"),
        "t10_topic_labels": _sql("SELECT * FROM labels10", "labels10"),
        "t11_idf": _sql(
            """SELECT word, df, round(ln(((SELECT count(*) FROM posts) + 1) / (df + 1)), 9) AS idf
               FROM word_stats""", "word_stats", "posts"),
        "t12_split": """
            SELECT doc_id AS post_id,
                   CASE WHEN CAST('0x' || substr(md5(doc_id || '1'), 1, 8) AS BIGINT) % 5 = 0
                        THEN 'validation' ELSE 'train' END AS part FROM documents""",
        "t13_topic_mixture": _sql(
            """SELECT post_id, CAST(10 AS BIGINT) AS topics,
               CAST(max(CASE WHEN df >= 4 THEN 1 ELSE 0 END) AS DOUBLE) AS total
               FROM clean JOIN word_stats USING (word) GROUP BY post_id""",
            "clean", "word_stats"),
        "t14_weights_json": _sql("SELECT * FROM word_topics", "word_topics"),
        "t15_conflicting_labels": """
            SELECT source AS topic, count(DISTINCT lang) AS labels FROM documents
            GROUP BY source HAVING count(DISTINCT lang) > 1""",
        "t15_repeated_weights": """
            SELECT role AS word, turn AS topic, count(*) AS entries FROM conversations
            GROUP BY ALL HAVING count(*) > 1""",
    }
