"""DuckDB SQL twins of the registered queries.

Only the raw tables are registered on the oracle side, so the derived views
go in as CTEs.  Dialect notes: DuckDB's ``sum`` of integers is HUGEINT (cast
to BIGINT), a double -> int cast rounds (so ``trunc`` first), and epoch
seconds come from ``floor(epoch(ts))``.
"""

from __future__ import annotations

from fundlens.functions.text import ENGLISH_STOP_WORDS


def _epoch(x: str) -> str:
    return f"CAST(floor(epoch({x})) AS BIGINT)"


CAMPAIGNS_CTE = f"""
l_agg AS (
  SELECT l_orderkey, min(l_shipdate) AS mn, max(l_shipdate) AS mx, count(*) AS n_lines,
    min(l_partkey) AS l_partkey
  FROM lineitem GROUP BY l_orderkey),
campaigns AS (
  SELECT concat('kk', CAST(o_orderkey AS VARCHAR)) AS project_id,
    c_name AS name,
    CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE p_name END AS descr,
    CASE WHEN p_partkey IS NOT NULL THEN concat_ws('-', p_brand, p_type) END AS keywords,
    CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' WHEN o_orderkey % 101 = 0 THEN NULL
         ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS goal,
    CASE WHEN o_orderkey % 331 = 0 THEN 'True' ELSE 'False' END AS disable_communication,
    CASE WHEN o_orderkey % 53 = 0 THEN 'False' WHEN o_orderkey % 89 = 0 THEN NULL
         ELSE concat('C', CAST(c_nationkey % 10 AS VARCHAR)) END AS country,
    CASE WHEN o_orderkey % 53 = 0 THEN concat('C', CAST(c_nationkey % 10 AS VARCHAR))
         WHEN o_orderkey % 71 = 0 THEN 'True' WHEN o_orderkey % 113 = 0 THEN NULL
         WHEN c_nationkey % 3 = 0 THEN 'USD' WHEN c_nationkey % 3 = 1 THEN 'EUR'
         ELSE 'GBP' END AS currency,
    CAST({_epoch('mx')} + (o_orderkey * 11) % 86400 AS VARCHAR) AS deadline,
    CAST({_epoch('mx')} + 5 AS VARCHAR) AS state_changed_at,
    CAST({_epoch('o_orderdate')} + (o_orderkey * 37) % 86400 AS VARCHAR) AS created_at,
    CAST({_epoch('mn')} + (o_orderkey * 53) % 86400 AS VARCHAR) AS launched_at,
    CAST(n_lines AS VARCHAR) AS backers_count,
    CASE WHEN o_orderkey % 211 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN '1'
         WHEN o_orderstatus = 'O' THEN '0' ELSE '2' END AS final_status
  FROM orders JOIN customer ON c_custkey = o_custkey
  LEFT JOIN l_agg ON l_orderkey = o_orderkey
  LEFT JOIN part ON p_partkey = l_partkey)"""

CAST_CTE = """
cast_ AS (
  SELECT project_id, name, descr, keywords, TRY_CAST(goal AS INTEGER) AS goal,
    disable_communication, country, currency,
    TRY_CAST(deadline AS INTEGER) AS deadline,
    TRY_CAST(state_changed_at AS INTEGER) AS state_changed_at,
    TRY_CAST(created_at AS INTEGER) AS created_at,
    TRY_CAST(launched_at AS INTEGER) AS launched_at,
    TRY_CAST(backers_count AS INTEGER) AS backers_count,
    TRY_CAST(final_status AS INTEGER) AS final_status
  FROM campaigns)"""

LOC_CTE = """
loc AS (
  SELECT project_id, name, descr, keywords, goal, deadline, created_at, launched_at,
    final_status,
    CASE WHEN country = 'False' THEN currency ELSE country END AS country2,
    CASE WHEN length(currency) = 3 THEN currency END AS currency2
  FROM cast_)"""


def _status_cte(policy: str = "recode") -> str:
    status = ("CASE WHEN final_status IS NULL THEN NULL WHEN final_status = 1 THEN 1 ELSE 0 END"
              if policy == "recode" else "final_status")
    return f"""
st AS (
  SELECT * FROM (
    SELECT project_id, name, descr, keywords, goal, deadline, created_at, launched_at,
      country2, currency2, {status} AS final_status FROM loc) s
  WHERE final_status IN (0, 1))"""


def _hours(start: str, end: str = "launched_at") -> str:
    return f"CAST(trunc(({end} - {start}) / 3.6) AS INTEGER) / 1000.0"


def _days(end: str, start: str) -> str:
    return f"(CAST(floor({end} / 86400.0) AS INTEGER) - CAST(floor({start} / 86400.0) AS INTEGER))"


DUR_CTE = f"""
dur AS (
  SELECT *, {_days('deadline', 'launched_at')} AS days_campaign,
    {_hours('created_at')} AS hours_prepa
  FROM st)"""

REPAIR_CTE = f"""
rep AS (
  SELECT project_id, lower(name) AS name, lower(descr) AS descr, lower(keywords) AS keywords,
    goal, final_status, country2, currency2, days_campaign,
    {_hours('CASE WHEN hours_prepa < 0 THEN launched_at ELSE created_at END')} AS hours_prepa,
    concat_ws(' ', lower(name), lower(descr), lower(keywords)) AS text
  FROM dur)"""

FILL_CTE = """
prep AS (
  SELECT project_id, name, descr, coalesce(goal, -1) AS goal, keywords, final_status,
    coalesce(country2, 'unknown') AS country2, coalesce(currency2, 'unknown') AS currency2,
    coalesce(days_campaign, -1) AS days_campaign, coalesce(hours_prepa, -1.0) AS hours_prepa,
    text
  FROM rep)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


PREP_CTES = (CAMPAIGNS_CTE, CAST_CTE, LOC_CTE, _status_cte("recode"), DUR_CTE, REPAIR_CTE, FILL_CTE)
PREP_DROP_CTES = (CAMPAIGNS_CTE, CAST_CTE, LOC_CTE, _status_cte("drop"), DUR_CTE, REPAIR_CTE, FILL_CTE)

VOTES_CTE = """
votes AS (
  SELECT c_custkey AS voter_id,
    concat('S', CAST((c_custkey * 3 + c_nationkey * 1) % 17 AS VARCHAR)) AS choice_1,
    concat('S', CAST((c_custkey * 5 + c_nationkey * 2) % 17 AS VARCHAR)) AS choice_2,
    concat('S', CAST((c_custkey * 7 + c_nationkey * 3) % 17 AS VARCHAR)) AS choice_3,
    concat('S', CAST((c_custkey * 9 + c_nationkey * 4) % 17 AS VARCHAR)) AS choice_4,
    concat('S', CAST((c_custkey * 11 + c_nationkey * 5) % 17 AS VARCHAR)) AS choice_5
  FROM customer)"""

VOTE_TALLY_SQL = with_ctes(VOTES_CTE) + """
SELECT choice_rank, sponsor, count(*) AS count FROM (
  SELECT 1 AS choice_rank, choice_1 AS sponsor FROM votes UNION ALL
  SELECT 2, choice_2 FROM votes UNION ALL
  SELECT 3, choice_3 FROM votes UNION ALL
  SELECT 4, choice_4 FROM votes UNION ALL
  SELECT 5, choice_5 FROM votes) u
GROUP BY choice_rank, sponsor"""

STOP_WORDS_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"

WORDS_SQL = "SELECT unnest(string_split(text, ' ')) AS word FROM documents"


def _prep(select: str, drop: bool = False) -> str:
    return with_ctes(*(PREP_DROP_CTES if drop else PREP_CTES)) + "\n" + select


def _upto(n: int, select: str) -> str:
    return with_ctes(*PREP_CTES[:n]) + "\n" + select


ORACLE: dict[str, str] = {
    # step 1: word counts
    "word_count": f"SELECT word, count(*) AS count FROM ({WORDS_SQL}) w GROUP BY word",
    "word_count_lower": f"SELECT lower(word) AS word, count(*) AS count FROM ({WORDS_SQL}) w GROUP BY lower(word)",
    "top_words": f"SELECT word, count(*) AS count FROM ({WORDS_SQL}) w GROUP BY word ORDER BY count DESC, word LIMIT 10",
    "top_words_lower": f"SELECT lower(word) AS word, count(*) AS count FROM ({WORDS_SQL}) w GROUP BY lower(word) ORDER BY count DESC, word LIMIT 10",
    "line_and_token_totals": f"""
SELECT count(*) AS n_rows,
  CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines,
  CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS n_words,
  (SELECT count(DISTINCT word) FROM ({WORDS_SQL}) w) AS n_distinct_words
FROM documents""",
    # step 2: preparation stages
    "campaign_cast": _upto(3, "SELECT * FROM cast_"),
    "campaign_country": _upto(3, """SELECT project_id, country, currency,
  CASE WHEN country = 'False' THEN currency ELSE country END AS country2 FROM cast_"""),
    "campaign_currency": _upto(3, """SELECT project_id, currency,
  CASE WHEN length(currency) = 3 THEN currency END AS currency2 FROM cast_"""),
    "campaign_status_recode": with_ctes(CAMPAIGNS_CTE, CAST_CTE, LOC_CTE, _status_cte("recode"))
        + "\nSELECT project_id, final_status FROM st",
    "campaign_status_drop": with_ctes(CAMPAIGNS_CTE, CAST_CTE, LOC_CTE, _status_cte("drop"))
        + "\nSELECT project_id, final_status FROM st",
    "campaign_durations": _upto(5, """SELECT project_id, deadline, launched_at, created_at,
  strftime(make_timestamp(CAST(launched_at AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS launched_on,
  strftime(make_timestamp(CAST(deadline AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS deadline_on,
  days_campaign, hours_prepa FROM dur"""),
    "campaign_prep_repair": _upto(5, f"""SELECT project_id, created_at, launched_at,
  hours_prepa AS hours_before,
  {_hours('CASE WHEN hours_prepa < 0 THEN launched_at ELSE created_at END')} AS hours_prepa FROM dur"""),
    "campaign_text": _upto(6, "SELECT project_id, name, descr, keywords, text FROM rep"),
    "campaign_fill": _prep("SELECT project_id, goal, country2, currency2, days_campaign, hours_prepa FROM prep"),
    "campaign_prepare": _prep("SELECT * FROM prep"),
    "campaign_prepare_drop": _prep("SELECT * FROM prep", drop=True),
    # step 3: profiles
    "status_counts": _upto(3, "SELECT final_status, count(*) AS count FROM cast_ GROUP BY final_status"),
    "country_currency_counts": _upto(3, "SELECT country, currency, count(*) AS count FROM cast_ GROUP BY country, currency"),
    **{f"{name}_counts": _upto(3, f"SELECT {col}, count(*) AS count FROM cast_ GROUP BY {col}")
       for name, col in [("disable_communication", "disable_communication"), ("country", "country"),
                         ("currency", "currency"), ("backers", "backers_count"),
                         ("state_changed", "state_changed_at")]},
    "flag_counts": _upto(3, "SELECT final_status > 1 AS status_above_1, count(*) AS count FROM cast_ GROUP BY 1"),
    "negative_prep_counts": _upto(6, """
SELECT hours_prepa < 0 AS negative_prep, count(*) AS count, 'before' AS stage FROM dur GROUP BY 1
UNION ALL
SELECT hours_prepa < 0 AS negative_prep, count(*) AS count, 'after' AS stage FROM rep GROUP BY 1"""),
    "false_country_currencies": _upto(3, "SELECT currency, count(*) AS count FROM cast_ WHERE country = 'False' GROUP BY currency"),
    "describe_numeric": _upto(3, """
SELECT 'goal' AS column_name, count(goal) AS count, round(avg(goal), 6) AS mean,
  round(stddev_samp(goal), 6) AS stddev, CAST(min(goal) AS DOUBLE) AS min, CAST(max(goal) AS DOUBLE) AS max FROM cast_
UNION ALL
SELECT 'backers_count', count(backers_count), round(avg(backers_count), 6), round(stddev_samp(backers_count), 6),
  CAST(min(backers_count) AS DOUBLE), CAST(max(backers_count) AS DOUBLE) FROM cast_
UNION ALL
SELECT 'final_status', count(final_status), round(avg(final_status), 6), round(stddev_samp(final_status), 6),
  CAST(min(final_status) AS DOUBLE), CAST(max(final_status) AS DOUBLE) FROM cast_"""),
    "null_audit": _prep("""
SELECT count_if(days_campaign IS NULL) AS days_campaign_nulls, count_if(hours_prepa IS NULL) AS hours_prepa_nulls,
  count_if(goal IS NULL) AS goal_nulls, count_if(country2 IS NULL) AS country2_nulls,
  count_if(currency2 IS NULL) AS currency2_nulls, 'before_fill' AS stage FROM rep
UNION ALL
SELECT count_if(days_campaign IS NULL), count_if(hours_prepa IS NULL), count_if(goal IS NULL),
  count_if(country2 IS NULL), count_if(currency2 IS NULL), 'after_fill' FROM prep"""),
    "distinct_deadlines": _upto(3, "SELECT DISTINCT deadline FROM cast_"),
    "largest_goals": _upto(3, "SELECT project_id, goal, final_status FROM cast_ ORDER BY goal DESC NULLS LAST, project_id LIMIT 30"),
    "class_balance": _prep("""
SELECT final_status, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 9) AS share
FROM prep GROUP BY final_status"""),
    "first_campaigns": _prep("SELECT * FROM prep ORDER BY project_id LIMIT 20"),
    "one_campaign": _prep("SELECT * FROM prep WHERE project_id = 'kk1'"),
    "vote_tally": VOTE_TALLY_SQL,
}

# --- steps 4-5: text features, categories, evaluation ------------------------

TOKENS_CTE = f"""
tok AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda x: length(x) >= 1) AS tokens
  FROM documents),
filt AS (
  SELECT doc_id, tokens, list_filter(tokens, lambda x: NOT list_contains({STOP_WORDS_SQL}, x)) AS filtered
  FROM tok),
tc AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(filtered) AS term FROM filt) u
  GROUP BY doc_id, term)"""

INDEX_CTE = """
cat_counts AS (
  SELECT column_name, value, count(*) AS count FROM (
    SELECT 'country2' AS column_name, country2 AS value FROM prep UNION ALL
    SELECT 'currency2', currency2 FROM prep) u
  WHERE value IS NOT NULL GROUP BY column_name, value),
cat_index AS (
  SELECT column_name, value, count,
    CAST(row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value) - 1 AS INTEGER) AS idx
  FROM cat_counts),
cat_size AS (SELECT column_name, count(*) - 1 AS size FROM cat_index GROUP BY column_name)"""

LABELLED_CTE = """
lab AS (
  SELECT d.doc_id, l.quality, CAST(d.n_chars >= 500 AS INTEGER) AS prediction
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
conf AS (SELECT quality, prediction, count(*) AS count FROM lab GROUP BY quality, prediction),
pc AS (
  SELECT a.cls, a.support, a.tp, coalesce(p.n_pred, 0) AS n_pred,
    CASE WHEN coalesce(p.n_pred, 0) > 0 THEN a.tp / p.n_pred ELSE 0.0 END AS prec,
    a.tp / a.support AS rec
  FROM (SELECT quality AS cls, sum(count) AS support,
               sum(CASE WHEN quality = prediction THEN count ELSE 0 END) AS tp
        FROM conf GROUP BY quality) a
  LEFT JOIN (SELECT prediction AS cls, sum(count) AS n_pred FROM conf GROUP BY prediction) p
    ON a.cls = p.cls)"""

ORACLE.update({
    "tokens": with_ctes(TOKENS_CTE) + "\nSELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS token_text FROM filt",
    "tokens_no_stop": with_ctes(TOKENS_CTE) + "\nSELECT doc_id, CAST(len(filtered) AS INTEGER) AS n_filtered, array_to_string(filtered, ' ') AS filtered_text FROM filt",
    "term_counts": with_ctes(TOKENS_CTE) + "\nSELECT doc_id, term, tf FROM tc",
    "tfidf": with_ctes(TOKENS_CTE) + """
SELECT tc.doc_id, tc.term, tc.tf, d.df,
  round(ln(((SELECT count(*) FROM documents) + 1.0) / (d.df + 1.0)), 9) AS idf,
  round(tc.tf * ln(((SELECT count(*) FROM documents) + 1.0) / (d.df + 1.0)), 9) AS tfidf
FROM tc JOIN (SELECT term, count(*) AS df FROM tc GROUP BY term) d ON tc.term = d.term""",
    "category_index": _prep("SELECT 1") .replace("\nSELECT 1", "," + INDEX_CTE + "\nSELECT column_name, value, count, idx FROM cat_index"),
    "one_hot": _prep("SELECT 1").replace("\nSELECT 1", "," + INDEX_CTE + """
SELECT p.project_id, p.country2, p.currency2,
  a.idx AS country2_idx, CASE WHEN a.idx < sa.size THEN a.idx END AS country2_hot, CAST(sa.size AS INTEGER) AS country2_size,
  b.idx AS currency2_idx, CASE WHEN b.idx < sb.size THEN b.idx END AS currency2_hot, CAST(sb.size AS INTEGER) AS currency2_size
FROM prep p
JOIN cat_index a ON a.column_name = 'country2' AND a.value = p.country2
JOIN cat_size sa ON sa.column_name = 'country2'
JOIN cat_index b ON b.column_name = 'currency2' AND b.value = p.currency2
JOIN cat_size sb ON sb.column_name = 'currency2'"""),
    "split_counts": """
SELECT CASE WHEN ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 < 1 THEN 'test' ELSE 'train' END AS split,
  count(*) AS n, CAST(sum(quality) AS BIGINT) AS n_quality, CAST(sum(toxic) AS BIGINT) AS n_toxic
FROM labels GROUP BY 1""",
    "confusion": with_ctes(LABELLED_CTE) + "\nSELECT quality, prediction, count FROM conf",
    "f1": with_ctes(LABELLED_CTE) + """
SELECT round(sum(support * CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END) / sum(support), 9) AS f1 FROM pc""",
    "accuracy": with_ctes(LABELLED_CTE) + "\nSELECT round(avg(CASE WHEN quality = prediction THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM lab",
})

# --- steps 7-8: streams and round trips --------------------------------------

EVENT_SUMMARY_SQL = """
SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_ids, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS sum_value
FROM events GROUP BY event_type"""

ORACLE.update({
    "stream_replay": EVENT_SUMMARY_SQL,
    "stream_resume": EVENT_SUMMARY_SQL,
    "stream_heartbeat": """
SELECT event_id, 'message ecrit le ' || strftime(ts, '%H:%M:%S:') || strftime(ts, '%f') || '000' AS value
FROM events""",
    "csv_roundtrip": "SELECT * FROM customer",
    "text_roundtrip": """
SELECT word, count(*) AS count FROM (
  SELECT unnest(string_split(line, ' ')) AS word FROM (
    SELECT unnest(string_split(text, chr(10))) AS line FROM documents) l) w
GROUP BY word""",
    "single_file_export": "SELECT sponsor, count, choice_rank, 1 AS files_in_rank FROM (" + VOTE_TALLY_SQL + ") t",
    "udf_clean": ORACLE["campaign_currency"],
    "campaign_csv_prepare": ORACLE["campaign_prepare"].replace("SELECT * FROM prep", "SELECT * RENAME (descr AS \"desc\") FROM prep"),
})

# --- variants of the preparation, typed user functions --------------------------

ORACLE.update({
    "campaign_cast_truncating": """
SELECT o_orderkey, CAST(trunc(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)) AS INTEGER) AS goal FROM orders""",
    "campaign_prepare_drop_negative": with_ctes(
        CAMPAIGNS_CTE, CAST_CTE, LOC_CTE, _status_cte("recode"), DUR_CTE, """
rep AS (
  SELECT project_id, lower(name) AS name, lower(descr) AS descr, lower(keywords) AS keywords,
    goal, final_status, country2, currency2, days_campaign, hours_prepa,
    concat_ws(' ', lower(name), lower(descr), lower(keywords)) AS text
  FROM dur WHERE NOT coalesce(hours_prepa < 0, false))""", FILL_CTE) + "\nSELECT * FROM prep",
    "shortest_preparations": _upto(5, """SELECT project_id, hours_prepa FROM dur
WHERE hours_prepa IS NOT NULL ORDER BY hours_prepa, project_id LIMIT 30"""),
    "filled_counts": _prep("""SELECT count_if(currency2 = 'unknown') AS currency2_filled,
  count_if(country2 = 'unknown') AS country2_filled, count_if(days_campaign = -1) AS days_campaign_filled,
  count_if(hours_prepa = -1) AS hours_prepa_filled, count_if(goal = -1) AS goal_filled FROM prep"""),
    "udf_types": """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_id + 9007199254740993 END AS big,
  CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events""",
})

# --- step 6: what SQL can say of the text models --------------------------------

_BUCKET = "('0x' || substr(md5({}), 1, 8))::BIGINT % 10"
MODEL_CTE = f"""
lab AS (
  SELECT d.doc_id, d.text, d.lang, d.source, l.quality,
    {_BUCKET.format("CAST(d.doc_id AS VARCHAR)")} AS bucket,
    {_BUCKET.format("CAST(d.doc_id AS VARCHAR) || '-validation'")} AS inner_bucket
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
terms AS (
  SELECT doc_id, bucket, inner_bucket, unnest(list_distinct(list_filter(
    regexp_split_to_array(lower(text), '\\W+'),
    lambda x: length(x) >= 1 AND NOT list_contains({STOP_WORDS_SQL}, x)))) AS term FROM lab),
seen AS (
  SELECT * FROM lab t WHERE bucket < 1
    AND lang IN (SELECT lang FROM lab WHERE bucket >= 1)
    AND source IN (SELECT source FROM lab WHERE bucket >= 1))"""
MODEL_MIN_DF = 5
GRID_REG = (1e-7, 1e-5, 1e-3, 1e-1)
GRID_MIN_DF = (0.02, 0.05, 0.1)

ORACLE.update({
    "train_score": with_ctes(MODEL_CTE) + f"""
SELECT quality, count(*) AS n_scored, CAST(0 AS BIGINT) AS n_disagree,
  (SELECT count(*) FROM (SELECT term FROM terms WHERE bucket >= 1 GROUP BY term HAVING count(*) >= {MODEL_MIN_DF}) v)
  + 1 + (SELECT count(DISTINCT lang) - 1 + count(DISTINCT source) - 1 FROM lab WHERE bucket >= 1) AS feature_size
FROM seen GROUP BY quality""",
    "model_reload": with_ctes(MODEL_CTE) + """
SELECT quality, count(*) AS n_scored, CAST(0 AS BIGINT) AS n_different FROM seen GROUP BY quality""",
    "grid_search": with_ctes(MODEL_CTE) + ",\n" + f"""
fits AS (SELECT count(*) AS n_fit FROM lab WHERE bucket >= 1 AND inner_bucket >= 3),
vals AS (SELECT count(*) AS n_validation FROM lab WHERE bucket >= 1 AND inner_bucket < 3),
dfs AS (SELECT term, count(*) AS df FROM terms WHERE bucket >= 1 AND inner_bucket >= 3 GROUP BY term)
SELECT r.reg_param, m.min_df, n_fit, n_validation,
  (SELECT count(*) FROM dfs WHERE df >= m.min_df * n_fit) AS vocabulary
FROM (VALUES {", ".join(f"(CAST({r} AS DOUBLE))" for r in GRID_REG)}) r(reg_param),
  (VALUES {", ".join(f"(CAST({m} AS DOUBLE))" for m in GRID_MIN_DF)}) m(min_df), fits, vals""",
})

# --- large rankings, the profile in one scan --------------------------------------

VOCABULARY_SIZE = 5000
ORACLE.update({
    "category_index_large": """
SELECT 'word' AS column_name, value, count, row_number() OVER (ORDER BY count DESC, value) - 1 AS idx
FROM (SELECT value, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS value FROM documents) w
  GROUP BY value) c""",
    "vocabulary_bounded": with_ctes(TOKENS_CTE) + f"""
SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df FROM tc GROUP BY term HAVING count(*) >= 2
ORDER BY total DESC, term LIMIT {VOCABULARY_SIZE}""",
    "profile_all": _upto(3, "\nUNION ALL\n".join(
        f"SELECT '{name}' AS profile, CAST({a} AS VARCHAR) AS key, CAST({b} AS VARCHAR) AS second_key, count(*) AS count "
        f"FROM cast_ {where} GROUP BY ALL" for name, a, b, where in [
            ("final_status", "final_status", "NULL", ""), ("country", "country", "NULL", ""),
            ("currency", "currency", "NULL", ""), ("disable_communication", "disable_communication", "NULL", ""),
            ("backers_count", "backers_count", "NULL", ""), ("state_changed_at", "state_changed_at", "NULL", ""),
            ("country, currency", "country", "currency", ""), ("status_above_1", "final_status > 1", "NULL", ""),
            ("country is False, currency", "currency", "NULL", "WHERE country = 'False'")])),
})

# --- checks of the fitted models -------------------------------------------------

ORACLE.update({
    "model_stationarity": with_ctes(MODEL_CTE) + f"""
SELECT 'tfidf' AS block, count(*) AS n_features, true AS stationary FROM (
  SELECT term FROM terms WHERE bucket >= 1 GROUP BY term HAVING count(*) >= {MODEL_MIN_DF}) v
UNION ALL SELECT 'n_chars', 1, true
UNION ALL SELECT 'lang', count(DISTINCT lang) - 1, true FROM lab WHERE bucket >= 1
UNION ALL SELECT 'source', count(DISTINCT source) - 1, true FROM lab WHERE bucket >= 1
UNION ALL SELECT 'intercept', 1, true""",
    "model_confusion": with_ctes(MODEL_CTE) + """
SELECT quality, count(*) AS n_scored, CAST(0 AS BIGINT) AS n_different, CAST(0 AS BIGINT) AS n_apart
FROM seen GROUP BY quality""",
    # fixed values: the pipeline's parameters, its vocabulary bound and the grid's minDF
    "model_parameters": f"""
SELECT * FROM (VALUES (2, 'CountVectorizerModel', 'minDF', '{GRID_MIN_DF[-1]}'),
  (2, 'CountVectorizerModel', 'vocabSize', '262144'),
  (4, 'StringIndexerModel', 'handleInvalid', 'skip'), (5, 'StringIndexerModel', 'handleInvalid', 'skip'),
  (6, 'OneHotEncoderModel', 'dropLast', 'true'), (6, 'OneHotEncoderModel', 'handleInvalid', 'error'),
  (7, 'VectorAssembler', 'handleInvalid', 'error'),
  (8, 'LogisticRegressionModel', 'thresholds', '[0.7,0.3]'), (8, 'LogisticRegressionModel', 'tol', '1.0E-6'),
  (8, 'LogisticRegressionModel', 'maxIter', '20'), (8, 'LogisticRegressionModel', 'elasticNetParam', '0.0')
) p(stage, stage_class, parameter, value)""",
})

# --- feeds, consumers, observed writes, bad records, persisted words --------------

#: Unix second of the feed's first message.
FEED_START = 1_700_000_000
ORACLE.update({
    "stream_feed": f"""
SELECT event_id, event_type,
  'message ecrit le ' || strftime(make_timestamp(({FEED_START} + event_id) * 1000000), '%H:%M:%S') || ':000000000' AS value
FROM events""",
    "stream_consumers": f"SELECT 'first' AS consumer, * FROM ({EVENT_SUMMARY_SQL}) a\nUNION ALL\n"
                        f"SELECT 'second', * FROM ({EVENT_SUMMARY_SQL}) b",
    "csv_inferred": """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
  CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_name || ' says "yes, no"' || chr(10) || 'and more' AS note, false AS broken
FROM customer
UNION ALL SELECT CAST(c_custkey AS BIGINT), NULL, NULL, NULL, true FROM customer WHERE c_custkey % 50 = 0""",
    "prepare_observed": _prep("""SELECT count(*) AS n_rows, count_if(final_status = 1) AS n_successful,
  count_if(currency2 = 'unknown') AS currency2_filled, count_if(country2 = 'unknown') AS country2_filled,
  count_if(goal = -1) AS goal_filled FROM prep"""),
    "word_count_cached": ORACLE["word_count"],
})
