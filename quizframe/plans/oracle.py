"""An independent SQL text per query, for any engine with the given tables as views.

Every text is a chain of named parts; a part is written once and pulled in with
all parts it builds on.
"""

from __future__ import annotations

import re

# Batches of the attempt numbers 0, 1, 2-3, ...: enough for 2,048 answers of one learner.
ELO_ROUNDS = 12

_ELO_KEYS = {"assessmentItemID": "elo_assessment", "testId": "elo_test", "KnowledgeTag": "elo_tag"}
_FRAME = "split, userID, Timestamp, row_id"
_FRAME_DESC = "split DESC, userID DESC, Timestamp DESC, row_id DESC"

PARTS: dict[str, str] = {}

PARTS["ans"] = """
  SELECT userID, concat(testId, item_no) AS assessmentItemID, testId,
         CASE WHEN userID % 10 = 0 AND rn = 1 THEN -1 ELSE raw_code END AS answerCode,
         Timestamp, KnowledgeTag,
         CASE WHEN userID % 10 = 0 THEN 1 ELSE 0 END AS split, row_id
  FROM (
    SELECT CAST(user_id AS INT) AS userID,
           concat('A0', CAST(1 + (k % 10) % 9 AS VARCHAR), '00000',
                  lpad(CAST(k % 10 AS VARCHAR), 2, '0')) AS testId,
           lpad(CAST(k // 10 AS VARCHAR), 3, '0') AS item_no,
           CASE WHEN event_type IN ('view','click','purchase') THEN 1 ELSE 0 END AS raw_code,
           ts AS Timestamp, k % 7 AS KnowledgeTag, event_id AS row_id,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM (SELECT event_id, ts, user_id, event_type,
                 CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events))
"""

PARTS["line"] = """
  SELECT CAST(o_custkey AS INT) AS userID,
         concat('A0', CAST(1 + l_suppkey % 9 AS VARCHAR),
                lpad(CAST(l_suppkey % 100000 AS VARCHAR), 5, '0')) AS testId,
         concat('A0', CAST(1 + l_suppkey % 9 AS VARCHAR),
                lpad(CAST(l_suppkey % 100000 AS VARCHAR), 5, '0'),
                lpad(CAST(l_partkey % 10 AS VARCHAR), 3, '0')) AS assessmentItemID,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS answerCode,
         l_shipdate AS Timestamp, CAST(l_partkey % 25 AS INT) AS KnowledgeTag,
         0 AS split,
         concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(l_extendedprice AS DECIMAL(18,2))) AS row_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def _log_parts(log: str, p: str) -> None:
    """Timed log and running features on top of the log part ``log``."""
    PARTS[f"{p}coded"] = f"""
      SELECT *, substring(testId, 3, 1) AS category_high, right(assessmentItemID, 3) AS problem_num,
             CAST(hour(Timestamp) AS INT) AS hour, CAST(weekofyear(Timestamp) AS INT) AS weekofyear
      FROM {log}"""
    PARTS[f"{p}diffs"] = f"""
      SELECT *, coalesce(date_diff('microsecond',
                  lag(Timestamp) OVER (PARTITION BY userID, testId ORDER BY Timestamp, row_id), Timestamp), 0) AS diff_us
      FROM {p}coded"""
    PARTS[f"{p}thr"] = f"SELECT quantile_cont(CAST(diff_us AS DOUBLE), 0.99) AS t FROM {p}diffs"
    PARTS[f"{p}sess"] = f"""
      SELECT *, CAST(sum(CASE WHEN diff_us < (SELECT t FROM {p}thr) THEN 0 ELSE 1 END)
               OVER (PARTITION BY userID, testId ORDER BY Timestamp, row_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session
      FROM {p}diffs"""
    PARTS[f"{p}el"] = f"""
      SELECT *, elapsed_us / 1e6 AS elapsed FROM (
        SELECT *, coalesce(date_diff('microsecond',
                    lag(Timestamp) OVER (PARTITION BY userID, testId, session ORDER BY Timestamp, row_id),
                    Timestamp), 0) AS elapsed_us
        FROM {p}sess)"""
    PARTS[f"{p}run"] = f"""
      SELECT *, problem_correct_per_user / problem_solved_per_user AS cum_answerRate_per_user,
             acc_us / 1e6 AS acc_elapsed_per_user
      FROM (SELECT *, CAST(sum(answerCode) OVER w AS BIGINT) AS problem_correct_per_user,
                   row_number() OVER w AS problem_solved_per_user,
                   CAST(sum(elapsed_us) OVER w AS BIGINT) AS acc_us
            FROM {p}el
            WINDOW w AS (PARTITION BY userID ORDER BY Timestamp, row_id ROWS UNBOUNDED PRECEDING))"""
    PARTS[f"{p}cat"] = f"""
      SELECT *, correct_answer_per_cat / nullif(acc_count_per_cat, 0) AS acc_answerRate_per_cat
      FROM (SELECT *, CAST(coalesce(sum(answerCode) OVER (PARTITION BY userID, category_high
                     ORDER BY Timestamp, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
                     AS correct_answer_per_cat,
                   row_number() OVER (PARTITION BY category_high ORDER BY {_FRAME}) - 1 AS acc_count_per_cat
            FROM {p}run)"""


_log_parts("ans", "")
_log_parts("line", "l_")

PARTS["delta"] = """
  SELECT c.*, (c.elapsed_us - m.med) / 1e6 AS timeDelta_userAverage
  FROM cat c JOIN (SELECT userID, quantile_cont(CAST(elapsed_us AS DOUBLE), 0.5) AS med
                   FROM el GROUP BY userID) m USING (userID)"""
PARTS["woy"] = f"""
  SELECT *, problem_correct_per_woy / problem_solved_per_woy AS cum_answerRate_per_woy
  FROM (SELECT *, CAST(sum(answerCode) OVER w AS BIGINT) AS problem_correct_per_woy,
               row_number() OVER w AS problem_solved_per_woy
        FROM delta WINDOW w AS (PARTITION BY weekofyear ORDER BY {_FRAME} ROWS UNBOUNDED PRECEDING))"""
PARTS["lags"] = (
    "SELECT *, "
    + ", ".join(f"coalesce(lag(answerCode, {k}) OVER w, 1) AS timestep_{k}" for k in range(1, 6))
    + " FROM woy WINDOW w AS (PARTITION BY userID ORDER BY Timestamp, row_id)"
)


# ---- Elo: the batches unrolled ------------------------------------------------------


def _elo_parts(key: str, p: str, formula: str, source: str) -> None:
    sig = "1 / (1 + exp(-(coalesce(t.v, 0) - coalesce(b.v, 0))))"
    prob = sig if formula == "logistic" else f"1 + {sig}"
    PARTS[f"{p}rows"] = f"""
      SELECT userID, {key} AS ik, answerCode, n_u, n_i,
             CASE WHEN n_u = 0 THEN 0 ELSE CAST(floor(log2(n_u + 0.5)) AS INT) + 1 END AS batch
      FROM (SELECT *, row_number() OVER (PARTITION BY userID ORDER BY Timestamp, row_id) - 1 AS n_u,
                   row_number() OVER (PARTITION BY {key} ORDER BY Timestamp, row_id) - 1 AS n_i
            FROM {source})"""
    for r in range(ELO_ROUNDS):
        t_join = f"LEFT JOIN {p}t{r - 1} t ON r.userID = t.id" if r else "LEFT JOIN (SELECT 0 AS id, 0.0 AS v) t ON false"
        b_join = f"LEFT JOIN {p}b{r - 1} b ON r.ik = b.id" if r else "LEFT JOIN (SELECT 0 AS id, 0.0 AS v) b ON false"
        PARTS[f"{p}m{r}"] = f"""
          SELECT userID, ik, lt * miss AS dt, -lb * miss AS db, lt * s * (1 - s) AS wt, lb * s * (1 - s) AS wb
          FROM (SELECT r.userID, r.ik, {sig} AS s, r.answerCode - ({prob}) AS miss,
                       greatest(0.3::DOUBLE / (1 + 0.01::DOUBLE * r.n_u), 0.04::DOUBLE) AS lt,
                       1::DOUBLE / (1 + 0.05::DOUBLE * r.n_i) AS lb
                FROM {p}rows r {t_join} {b_join} WHERE r.batch = {r})"""
        for short, col, d, w in (("t", "userID", "dt", "wt"), ("b", "ik", "db", "wb")):
            old = f"UNION ALL SELECT id, v FROM {p}{short}{r - 1}" if r else ""
            PARTS[f"{p}{short}{r}"] = (
                f"SELECT id, sum(v) AS v FROM (SELECT {col} AS id, sum({d}) / (1 + sum({w}) - max({w})) AS v "
                f"FROM {p}m{r} GROUP BY 1 {old}) GROUP BY id"
            )


_LAST = ELO_ROUNDS - 1
for _key, _out in _ELO_KEYS.items():
    _elo_parts(_key, f"e_{_out}_", "logistic", "sc")
_elo_parts("assessmentItemID", "e_written_", "as_written", "ans")


def _elo_final(key: str, p: str, out: str) -> str:
    return (
        f"SELECT row_id, round(th, 6) AS theta, round(be, 6) AS beta, round(th - be, 6) AS difference, "
        f"round(1 / (1 + exp(-(th - be))), 6) AS {out} "
        f"FROM (SELECT a.row_id, coalesce(t.v, 0) AS th, coalesce(b.v, 0) AS be "
        f"FROM ans a LEFT JOIN {p}t{_LAST} t ON a.userID = t.id LEFT JOIN {p}b{_LAST} b ON a.{key} = b.id)"
    )


PARTS["sc"] = "SELECT * FROM ans WHERE answerCode >= 0"
PARTS["elo_rows"] = (
    "SELECT x.*, "
    + ", ".join(f"{out}.{out}" for out in _ELO_KEYS.values())
    + " FROM lags x "
    + " ".join(
        f"JOIN ({_elo_final(key, f'e_{out}_', out)}) {out} ON x.row_id = {out}.row_id"
        for key, out in _ELO_KEYS.items()
    )
)

# ---- dependency levels of answers ------------------------------------------------

PARTS["lv_rows"] = """
  SELECT row_id, lag(row_id) OVER (PARTITION BY userID ORDER BY Timestamp, row_id) AS pu,
         lag(row_id) OVER (PARTITION BY assessmentItemID ORDER BY Timestamp, row_id) AS pi FROM sc"""
PARTS["lv_1"] = "SELECT row_id, 1 AS level FROM lv_rows WHERE pu IS NULL AND pi IS NULL"
for _n in range(2, 7):
    PARTS[f"lv_{_n}"] = f"""
      SELECT row_id, level FROM lv_{_n - 1} UNION ALL
      SELECT row_id, {_n} FROM lv_rows r WHERE NOT EXISTS (SELECT 1 FROM lv_{_n - 1} x WHERE x.row_id = r.row_id)
        AND (pu IS NULL OR EXISTS (SELECT 1 FROM lv_{_n - 1} x WHERE x.row_id = r.pu))
        AND (pi IS NULL OR EXISTS (SELECT 1 FROM lv_{_n - 1} x WHERE x.row_id = r.pi))"""

# ---- splits ----------------------------------------------------------------------

PARTS["parted"] = """
  SELECT *, CASE WHEN answerCode < 0 THEN 'test' WHEN rn = 1 THEN 'valid' ELSE 'train' END AS part
  FROM (SELECT *, row_number() OVER (PARTITION BY userID, answerCode >= 0
                                     ORDER BY Timestamp DESC, row_id DESC) AS rn FROM {src})"""


def _parted(src: str) -> str:
    return PARTS["parted"].replace("{src}", src)


PARTS["parts"] = _parted("ans")
PARTS["full"] = _parted("elo_rows")
del PARTS["parted"]
PARTS["ctx"] = f"""
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY userID, assessmentItemID
                              ORDER BY {_FRAME_DESC}) AS rn FROM sc) WHERE rn = 1"""
PARTS["last3"] = f"""
  SELECT row_id FROM (SELECT *, row_number() OVER (PARTITION BY userID, assessmentItemID ORDER BY {_FRAME_DESC}) AS r2
    FROM (SELECT *, row_number() OVER (PARTITION BY userID ORDER BY {_FRAME_DESC}) AS r1 FROM ctx) WHERE r1 <= 3)
  WHERE r2 = 1"""
PARTS["dedup"] = f"""
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY userID, assessmentItemID
                              ORDER BY {_FRAME_DESC}) AS rn FROM ans) WHERE rn = 1"""
PARTS["mx"] = f"""
  SELECT *, CASE WHEN split = 0 THEN 'train' WHEN row_number() OVER (PARTITION BY split, userID
                      ORDER BY {_FRAME_DESC}) = 1 THEN 'eval' ELSE 'test' END AS part
  FROM (SELECT *, row_number() OVER (PARTITION BY split, userID, assessmentItemID
                              ORDER BY {_FRAME_DESC}) AS rn FROM ans)
  WHERE rn = 1 AND (split = 0 OR answerCode >= 0)"""

# ---- aggregate grains --------------------------------------------------------------

_MED = "quantile_cont(CAST({c} AS DOUBLE), 0.5){f} / 1e6"


def _median(filter_: str = "") -> str:
    return _MED.format(c="elapsed_us", f=f" FILTER (WHERE {filter_})" if filter_ else "")


def _user(src: str) -> str:
    return f"""SELECT userID, avg(answerCode) AS answerRate_per_user, count(answerCode) AS answer_cnt_per_user,
      count(assessmentItemID) AS assessment_solved_per_user, {_median()} AS elapsed_time_median_per_user
      FROM {src} GROUP BY userID"""


def _item(src: str) -> str:
    return f"""SELECT assessmentItemID, avg(answerCode) AS answerRate_per_item, count(answerCode) AS answer_cnt_per_item,
      {_median()} AS elapsed_time_median_per_item, {_median('answerCode = 0')} AS wrong_users_median_elapsed,
      {_median('answerCode = 1')} AS correct_users_median_elapsed FROM {src} GROUP BY assessmentItemID"""


def _tag(src: str) -> str:
    return f"""SELECT KnowledgeTag, count(userID) AS tag_exposed, sum(answerCode) / count(*) AS answerRate_per_tag
      FROM {src} GROUP BY KnowledgeTag"""


def _grain(src: str, key: str, suffix: str) -> str:
    return f"""SELECT {key}, sum(answerCode) / count(*) AS answerRate_per_{suffix},
      {_median()} AS elapsed_median_per_{suffix} FROM {src} GROUP BY {key}"""


_ROW_FEATURES = (
    "userID assessmentItemID KnowledgeTag elapsed category_high problem_num cum_answerRate_per_user "
    "acc_elapsed_per_user problem_correct_per_user problem_solved_per_user correct_answer_per_cat "
    "acc_count_per_cat acc_answerRate_per_cat timeDelta_userAverage timestep_1 timestep_2 timestep_3 "
    "timestep_4 timestep_5 hour weekofyear problem_correct_per_woy problem_solved_per_woy cum_answerRate_per_woy"
).split()
_GRAIN_FEATURES = (
    "answerRate_per_user answer_cnt_per_user elapsed_time_median_per_user assessment_solved_per_user "
    "answerRate_per_item answer_cnt_per_item elapsed_time_median_per_item wrong_users_median_elapsed "
    "correct_users_median_elapsed tag_exposed answerRate_per_tag elapsed_median_per_test answerRate_per_test "
    "elapsed_median_per_cat answerRate_per_cat elapsed_median_per_problem_num answerRate_per_problem_num"
).split()


def _table(base: str, target: str, label: bool = True) -> str:
    columns = ["row_id", *(["answerCode"] if label else []), *_ROW_FEATURES, *_GRAIN_FEATURES, *_ELO_KEYS.values()]
    src = f"(SELECT * FROM full_rows WHERE {base})"
    return f"""SELECT {', '.join(columns)} FROM (SELECT * FROM full_rows WHERE {target}) x
      LEFT JOIN ({_user(src)}) USING (userID) LEFT JOIN ({_item(src)}) USING (assessmentItemID)
      LEFT JOIN ({_tag(src)}) USING (KnowledgeTag) LEFT JOIN ({_grain(src, 'testId', 'test')}) USING (testId)
      LEFT JOIN ({_grain(src, 'category_high', 'cat')}) USING (category_high)
      LEFT JOIN ({_grain(src, 'problem_num', 'problem_num')}) USING (problem_num)"""


PARTS["full_rows"] = PARTS.pop("full")

# ---- segments, consumed time, sequence table -----------------------------------------


def _segments(src: str, n: int) -> str:
    return f"""SELECT *, CAST((rn - 1) // {n} AS INT) AS chunk, concat(userID, 'a', (rn - 1) // {n}) AS segment_id
      FROM (SELECT *, row_number() OVER (PARTITION BY userID ORDER BY Timestamp, row_id) AS rn FROM {src})"""


def _consumed(src: str, by: str = "segment_id") -> str:
    epoch = "CAST(floor(epoch(Timestamp)) AS BIGINT)"
    return f"""SELECT *, coalesce(lag(answerCode) OVER w + 1, 0) AS beforeCorrect,
        CASE WHEN testId = lag(testId) OVER w THEN {epoch} - lag({epoch}) OVER w ELSE 0 END AS consumedTime
      FROM {src} WINDOW w AS (PARTITION BY {by} ORDER BY Timestamp, row_id)"""


PARTS["seg"] = _segments("sc", 20)
PARTS["seqr"] = _consumed("seg")
PARTS["quart"] = """
  SELECT assessmentItemID, quantile_cont(CAST(consumedTime AS DOUBLE), 0.25) AS Q1,
         quantile_cont(CAST(consumedTime AS DOUBLE), 0.5) AS Q2,
         quantile_cont(CAST(consumedTime AS DOUBLE), 0.75) AS Q3 FROM seqr GROUP BY assessmentItemID"""
PARTS["clean"] = """
  SELECT s.* EXCLUDE (consumedTime),
         CASE WHEN consumedTime > Q3 + 1.5 * (Q3 - Q1) THEN Q2 ELSE CAST(consumedTime AS DOUBLE) END AS consumedTime
  FROM seqr s JOIN quart USING (assessmentItemID)"""
PARTS["counted"] = """
  SELECT *, count(*) OVER (PARTITION BY assessmentItemID) AS vi, count(*) OVER (PARTITION BY testId) AS vt FROM clean"""
PARTS["scaled"] = """
  SELECT * EXCLUDE (consumedTime),
         (consumedTime - (SELECT avg(consumedTime) FROM counted)) / (SELECT coalesce(nullif(stddev_pop(consumedTime), 0), 1) FROM counted) AS consumedTime,
         (vi - (SELECT avg(vi) FROM counted)) / (SELECT coalesce(nullif(stddev_pop(vi), 0), 1) FROM counted) AS value_counts_assessmentItemID,
         (vt - (SELECT avg(vt) FROM counted)) / (SELECT coalesce(nullif(stddev_pop(vt), 0), 1) FROM counted) AS value_counts_testId
  FROM counted"""

# ---- dictionaries ------------------------------------------------------------------------

_DICT = ["assessmentItemID", "testId", "KnowledgeTag"]


def _ordinal(src: str, columns: list[str]) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value FROM {src} UNION ALL SELECT '{c}', 'unknown'" for c in columns
    )
    return f"""SELECT field, value, row_number() OVER (PARTITION BY field ORDER BY value) - 1 AS idx
      FROM (SELECT DISTINCT field, value FROM ({cells}))"""


def _ordinal_codes(dictionary: str, columns: list[str], src: str, keep: list[str]) -> str:
    """Rows of ``src`` with codes; unseen values get the code of ``unknown``."""
    joins = " ".join(
        f"LEFT JOIN {dictionary} d{i} ON d{i}.field = '{c}' AND d{i}.value = CAST(x.{c} AS VARCHAR)"
        for i, c in enumerate(columns)
    )
    spare = "(SELECT idx FROM {d} WHERE field = '{c}' AND value = 'unknown')"
    codes = ", ".join(
        f"CAST(coalesce(d{i}.idx, {spare.format(d=dictionary, c=c)}) AS INT) AS {c}" for i, c in enumerate(columns)
    )
    return f"SELECT {', '.join('x.' + k for k in keep)}, {codes} FROM {src} x {joins}"


PARTS["dict_all"] = _ordinal("ans", _DICT)
PARTS["tr"] = "SELECT * FROM ans WHERE split = 0"
PARTS["te"] = "SELECT * FROM ans WHERE split = 1"
PARTS["dict_seen"] = _ordinal("tr", ["userID", *_DICT])
PARTS["tr_coded"] = "SELECT * FROM coded WHERE split = 0"
PARTS["dict_train"] = _ordinal("tr", _DICT)
_TEXT = ["assessmentItemID", "testId", "category_high", "problem_num"]
PARTS["dict_text"] = _ordinal("tr_coded", _TEXT)
_SEQ_CATS = ["beforeCorrect", "KnowledgeTag", "testId", "assessmentItemID"]
PARTS["dict_seq"] = _ordinal("seqr", _SEQ_CATS)


def _first_seen(src: str, columns: list[str]) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value, {_FRAME} FROM {src}" for c in columns
    )
    return f"""SELECT field, value, row_number() OVER (PARTITION BY field ORDER BY {_FRAME}) - 1 AS idx
      FROM (SELECT *, row_number() OVER (PARTITION BY field, value ORDER BY {_FRAME}) AS rn FROM ({cells})) WHERE rn = 1"""


def _context(src: str) -> str:
    return f"""SELECT *, CAST(substring(testId, 3, 1) AS INT) AS grade,
        CAST(right(assessmentItemID, 3) AS INT) AS assessmentItemNumber,
        CASE WHEN hour(Timestamp) < 6 THEN 'dawn' WHEN hour(Timestamp) < 12 THEN 'morning'
             WHEN hour(Timestamp) < 18 THEN 'after_noon' ELSE 'evening' END AS timeDivide,
        row_number() OVER (PARTITION BY userID, KnowledgeTag ORDER BY Timestamp, row_id) AS tagCount
      FROM {src}"""


PARTS["ctx_train"] = _context("ctx")
PARTS["ctx_test"] = _context("(SELECT * FROM ans WHERE answerCode = -1)")
_CTX = ["userID", "assessmentItemID", "KnowledgeTag", "timeDivide", "grade", "assessmentItemNumber", "tagCount"]
PARTS["dict_ctx"] = f"{_first_seen('sc', _CTX[:2])} UNION ALL ({_first_seen('ctx_train', _CTX[2:])})"
PARTS["ctx_all"] = (
    f"SELECT row_id, 'train' AS part, {', '.join(_CTX)}, answerCode FROM ctx_train UNION ALL "
    f"SELECT row_id, 'test', {', '.join(_CTX)}, answerCode FROM ctx_test"
)

# ---- sequences ---------------------------------------------------------------------------

PARTS["seg50"] = _segments("ans", 50)
PARTS["con_user"] = _consumed("ans", "userID")
PARTS["code_user"] = f"""
  SELECT y.userID, y.Timestamp, y.answerCode, y.consumedTime, c.* FROM con_user y
  JOIN ({_ordinal_codes('dict_all', _DICT, 'con_user', ['row_id'])}) c USING (row_id)"""
PARTS["last20"] = """
  SELECT *, count(*) OVER (PARTITION BY userID) AS size
  FROM (SELECT *, row_number() OVER (PARTITION BY userID ORDER BY Timestamp DESC, row_id DESC) AS back FROM code_user)
  WHERE back <= 20"""
# Every learner has 20 places; a place without a row holds 0.
PARTS["places"] = """
  SELECT userID, 20 - back AS pos, assessmentItemID + 1 AS i, testId + 1 AS t, KnowledgeTag + 1 AS g,
         consumedTime AS c, answerCode AS a, 1 AS m FROM last20
  UNION ALL
  SELECT userID, p AS pos, 0, 0, 0, 0, 0, 0
  FROM (SELECT userID, max(size) AS size FROM last20 GROUP BY userID), range(0, 20) r(p) WHERE p < 20 - size"""


def _line(expr: str, order: str = "pos") -> str:
    return f"string_agg(CAST({expr} AS VARCHAR), ',' ORDER BY {order})"


# ---- metrics -----------------------------------------------------------------------------

PARTS["rated"] = """
  SELECT answerCode AS y, avg(answerCode) OVER (PARTITION BY assessmentItemID) AS p FROM sc"""
PARTS["by_score"] = "SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM rated GROUP BY p"
PARTS["auc"] = """
  SELECT sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM by_score)"""
PARTS["kinds"] = "SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS label FROM (SELECT DISTINCT event_type FROM events)"
PARTS["shares"] = """
  SELECT user_id, label, (coalesce(c, 0) + 1) / (sum(coalesce(c, 0)) OVER (PARTITION BY user_id) + count(*) OVER (PARTITION BY user_id)) AS share
  FROM (SELECT u.user_id, k.label, k.event_type FROM (SELECT DISTINCT user_id FROM events) u, kinds k)
  LEFT JOIN (SELECT user_id, event_type, count(*) AS c FROM events GROUP BY 1, 2) USING (user_id, event_type)"""
PARTS["own"] = """
  SELECT user_id, label, share AS mine,
         (SELECT count(*) FROM shares o WHERE o.user_id = s.user_id
            AND (o.share > s.share OR (o.share = s.share AND o.label > s.label))) AS better
  FROM shares s"""
PARTS["owned"] = "SELECT mine, better FROM events JOIN kinds USING (event_type) JOIN own USING (user_id, label)"

_US = "date_diff('microsecond', TIMESTAMP '1970-01-01', Timestamp) AS ts_us"
_RUN = "row_id, problem_correct_per_user, problem_solved_per_user, cum_answerRate_per_user, acc_elapsed_per_user"

def _centered(src: str) -> str:
    cells = f"SELECT userID, assessmentItemID, avg(answerCode) AS v FROM {src} GROUP BY 1, 2"
    return f"""SELECT userID, assessmentItemID, round(v, 6) AS value, round(v - m, 6) AS centered,
      round(0.5 - m, 6) AS row_default
      FROM ({cells})
      JOIN (SELECT userID, avg(coalesce(v, 0.5)) AS m FROM
              (SELECT u.userID, i.assessmentItemID, c.v
               FROM (SELECT DISTINCT userID FROM {src}) u, (SELECT DISTINCT assessmentItemID FROM {src}) i
               LEFT JOIN ({cells}) c
                 ON c.userID = u.userID AND c.assessmentItemID = i.assessmentItemID) GROUP BY userID) USING (userID)"""


# The sequence columns of the segments, not rounded; and the fits of the train log for new rows.
PARTS["seq_full"] = f"""
  SELECT c.*, x.segment_id, x.Timestamp, x.answerCode, x.consumedTime, x.value_counts_assessmentItemID, x.value_counts_testId,
    {', '.join(f'm{i}.a AS mean_{k}_answerCode, m{i}.t AS mean_{k}_consumedTime' for i, k in enumerate(_DICT))}
  FROM scaled x JOIN ({_ordinal_codes('dict_seq', _SEQ_CATS, 'seqr', ['row_id'])}) c USING (row_id)
  {' '.join(f'JOIN (SELECT {k}, avg(answerCode) AS a, avg(consumedTime) AS t FROM scaled GROUP BY 1) m{i} ON m{i}.{k} = x.{k}' for i, k in enumerate(_DICT))}"""
_SEQ_NUMS = [*[f"mean_{k}_{t}" for t in ("answerCode", "consumedTime") for k in _DICT], "consumedTime", "value_counts_assessmentItemID", "value_counts_testId"]
PARTS["f_sc"] = "SELECT * FROM sc WHERE split = 0"
PARTS["f_seg"] = _segments("f_sc", 20)
PARTS["f_seqr"] = _consumed("f_seg")
for _name in ("quart", "clean", "counted", "scaled"):
    PARTS[f"f_{_name}"] = re.sub(r"\b(seqr|quart|clean|counted)\b", r"f_\1", PARTS[_name])
PARTS["f_dict"] = _ordinal("f_seqr", _SEQ_CATS)
PARTS["new_rows"] = _consumed("te", "userID")
PARTS["new_clean"] = """
  SELECT n.* EXCLUDE (consumedTime),
         CASE WHEN consumedTime > Q3 + 1.5 * (Q3 - Q1) THEN Q2 ELSE CAST(consumedTime AS DOUBLE) END AS consumedTime
  FROM new_rows n LEFT JOIN f_quart USING (assessmentItemID)"""


def _scaled(value: str, column: str) -> str:
    return (
        f"({value} - (SELECT avg({column}) FROM f_counted)) / "
        f"(SELECT coalesce(nullif(stddev_pop({column}), 0), 1) FROM f_counted)"
    )


def _padded_list(value: str, pad: str = "0") -> str:
    return (
        f"array_to_string(list_concat(list_transform(range(0, 20 - count(*)), lambda z: '{pad}'), "
        f"list(coalesce(CAST({value} AS VARCHAR), 'NULL') ORDER BY Timestamp, row_id)), ',')"
    )


# Label means of earlier rows in a random order for training rows, of all training rows for the others.
PARTS["turned"] = """
  SELECT *, (SELECT avg(answerCode) FROM parts WHERE part = 'train') AS prior, md5(concat(row_id, '|42')) AS turn
  FROM parts WHERE answerCode >= 0"""


def _targets(columns: list[str]) -> str:
    earlier = ", ".join(
        f"round((coalesce(sum(answerCode) OVER (PARTITION BY {c} ORDER BY turn, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + prior)"
        f" / (row_number() OVER (PARTITION BY {c} ORDER BY turn, row_id) - 1 + 1), 9) AS target_{c}"
        for c in columns
    )
    fitted = ", ".join(
        f"round((coalesce((SELECT sum(answerCode) FROM turned t WHERE t.part = 'train' AND t.{c} = x.{c}), 0) + prior)"
        f" / (coalesce((SELECT count(*) FROM turned t WHERE t.part = 'train' AND t.{c} = x.{c}), 0) + 1), 9) AS target_{c}"
        for c in columns
    )
    return (
        f"SELECT row_id, part, {earlier} FROM turned WHERE part = 'train' UNION ALL "
        f"SELECT row_id, part, {fitted} FROM turned x WHERE part = 'valid'"
    )


_SUBMISSION = f"""SELECT row_number() OVER (ORDER BY {_FRAME}) - 1 AS id, coalesce(p, 0.5) AS prediction
      FROM (SELECT * FROM ans WHERE answerCode = -1)
      LEFT JOIN (SELECT assessmentItemID, avg(answerCode) AS p FROM sc GROUP BY 1) USING (assessmentItemID)"""

FINALS: dict[str, str] = {
    "answers": f"SELECT userID, assessmentItemID, testId, answerCode, {_US}, KnowledgeTag, split, row_id FROM ans",
    "lineitem_answers": f"SELECT userID, assessmentItemID, testId, answerCode, {_US}, KnowledgeTag, split, row_id FROM line",
    "union_logs": "SELECT row_id, userID, answerCode, split FROM ans",
    "scored_rows": "SELECT row_id, userID, answerCode FROM sc",
    "unscored_rows": "SELECT row_id, userID, answerCode FROM ans WHERE answerCode = -1",
    "submission_rows": _SUBMISSION,
    "template_round_trip": _SUBMISSION,
    "calendar_codes": """SELECT row_id, category_high, problem_num, CAST(category_high AS INT) AS grade,
      CAST(problem_num AS INT) AS assessmentItemNumber, hour, weekofyear FROM coded""",
    "time_divide": """SELECT row_id, CASE WHEN hour < 6 THEN 'dawn' WHEN hour < 12 THEN 'morning'
      WHEN hour < 18 THEN 'after_noon' ELSE 'evening' END AS timeDivide FROM coded""",
    "epoch_seconds": "SELECT row_id, CAST(floor(epoch(Timestamp)) AS BIGINT) AS epoch FROM ans",
    "user_features": _user("el"),
    "item_features": _item("el"),
    "lineitem_user_features": _user("l_el"),
    "lineitem_item_features": _item("l_el"),
    "tag_features": _tag("ans"),
    "test_features": _grain("el", "testId", "test"),
    "category_features": _grain("el", "category_high", "cat"),
    "problem_num_features": _grain("el", "problem_num", "problem_num"),
    "percentile_rate": "SELECT testId, split, sum(answerCode) / count(*) AS answerRate FROM ans GROUP BY testId, split",
    "log_stats": """SELECT split, count(DISTINCT userID) AS n_users, max(userID) AS max_user,
      count(DISTINCT assessmentItemID) AS n_items, count(*) AS n_records FROM ans GROUP BY split""",
    "dict_sizes": "SELECT field, count(*) AS size FROM dict_train GROUP BY field",
    "field_dims": " UNION ALL ".join(f"SELECT '{c}' AS field, count(DISTINCT {c}) AS dim FROM ctx_train" for c in _CTX),
    "freq_encoding": """SELECT assessmentItemID AS key, count(*) AS value, 'item' AS grain FROM ans GROUP BY 1
      UNION ALL SELECT testId, count(*), 'test' FROM ans GROUP BY 1""",
    "target_encoding": " UNION ALL ".join(
        f"SELECT 'mean_{c}_answerCode' AS asset, CAST({c} AS VARCHAR) AS key, 'value' AS stat, avg(answerCode) AS value "
        f"FROM sc GROUP BY {c}" for c in _DICT
    ),
    "time_encoding": " UNION ALL ".join(
        f"SELECT 'mean_{c}_consumedTime' AS asset, CAST({c} AS VARCHAR) AS key, 'value' AS stat, avg(consumedTime) AS value "
        f"FROM seqr GROUP BY {c}" for c in _DICT
    ),
    "item_quartiles": "SELECT assessmentItemID AS key, Q1, Q2, Q3 FROM quart",
    "user_item_cells": "SELECT userID, assessmentItemID, avg(answerCode) AS value FROM mx WHERE part = 'train' GROUP BY 1, 2",
    "user_item_centered": _centered("sc"),
    "user_item_centered_train": _centered("(SELECT * FROM mx WHERE part = 'train')"),
    "matrix_parts": "SELECT row_id, userID, answerCode, part FROM mx",
    "time_diff": "SELECT row_id, diff_us, diff_us / 1e6 AS diff FROM diffs",
    "session_elapsed": "SELECT row_id, session, elapsed FROM el",
    "lineitem_session_elapsed": "SELECT row_id, session, elapsed FROM l_el",
    "user_running": f"SELECT {_RUN} FROM run",
    "user_running_strict": """SELECT row_id, problem_correct_per_user - answerCode AS problem_correct_per_user,
      problem_solved_per_user - 1 AS problem_solved_per_user,
      (problem_correct_per_user - answerCode) / nullif(problem_solved_per_user - 1, 0) AS cum_answerRate_per_user,
      (acc_us - elapsed_us) / 1e6 AS acc_elapsed_per_user FROM run""",
    "lineitem_user_running": f"SELECT {_RUN} FROM l_run",
    "category_running": "SELECT row_id, correct_answer_per_cat, acc_count_per_cat, acc_answerRate_per_cat FROM cat",
    "lineitem_category_running": "SELECT row_id, correct_answer_per_cat, acc_count_per_cat, acc_answerRate_per_cat FROM l_cat",
    "week_running": """SELECT row_id, weekofyear, problem_correct_per_woy, problem_solved_per_woy, cum_answerRate_per_woy
      FROM woy""",
    "time_delta_user": "SELECT row_id, elapsed, timeDelta_userAverage FROM delta",
    "answer_lags": "SELECT row_id, timestep_1, timestep_2, timestep_3, timestep_4, timestep_5 FROM lags",
    "tag_occurrence": """SELECT row_id, row_number() OVER (PARTITION BY split, userID, KnowledgeTag
      ORDER BY Timestamp, row_id) AS tagCount FROM ans""",
    "sliding_segments": "SELECT row_id, chunk, segment_id FROM seg",
    "consumed_time": "SELECT row_id, segment_id, beforeCorrect, consumedTime FROM seqr",
    "dedupe_last": "SELECT row_id, userID, assessmentItemID, answerCode FROM dedup",
    "split_last": "SELECT row_id, part FROM parts",
    "split_last3": """SELECT row_id, CASE WHEN row_id IN (SELECT row_id FROM last3) THEN 'valid' ELSE 'train' END AS part
      FROM ctx""",
    "split_random": """SELECT userID, CASE WHEN CAST(concat('0x', substring(md5(concat(userID, '|42')), 1, 8)) AS BIGINT)
      % 1000 < 200 THEN 'valid' ELSE 'train' END AS part FROM (SELECT DISTINCT userID FROM ans)""",
    "context_rows": "SELECT row_id, userID, assessmentItemID, answerCode FROM ctx",
    "held_out_removed": """SELECT row_id, userID FROM parts WHERE part = 'train'""",
    "encode_ordinal": _ordinal_codes("dict_all", _DICT, "ans", ["row_id"]),
    "encode_ordinal_unseen": _ordinal_codes("dict_seen", ["userID", *_DICT], "te", ["row_id"]),
    "encode_table": _ordinal_codes("dict_text", _TEXT, "coded", ["row_id"]),
    "encode_first_seen": _first_seen("sc", _DICT),
    "lookup_apply": """SELECT row_id, testId, coalesce(r, 0.5) AS test_rate, coalesce(u, 0.5) AS user_rate FROM te
      LEFT JOIN (SELECT testId, avg(answerCode) AS r FROM sc WHERE split = 0 GROUP BY 1) USING (testId)
      LEFT JOIN (SELECT userID, avg(answerCode) AS u FROM sc WHERE split = 0 GROUP BY 1) USING (userID)""",
    "encoders_apply": """SELECT a.row_id, vi AS value_counts_assessmentItemID, vt AS value_counts_testId,
        mi AS mean_assessmentItemID_answerCode, mt AS mean_testId_answerCode, mg AS mean_KnowledgeTag_answerCode
      FROM ans a
      LEFT JOIN (SELECT assessmentItemID, CAST(count(*) AS DOUBLE) AS vi, avg(answerCode) AS mi FROM tr GROUP BY 1) USING (assessmentItemID)
      LEFT JOIN (SELECT testId, CAST(count(*) AS DOUBLE) AS vt, avg(answerCode) AS mt FROM tr GROUP BY 1) USING (testId)
      LEFT JOIN (SELECT KnowledgeTag, avg(answerCode) AS mg FROM tr GROUP BY 1) USING (KnowledgeTag)
      WHERE a.split = 1""",
    "target_statistics": _targets(["userID", *_DICT]),
    "outlier_replace": "SELECT row_id, consumedTime FROM clean",
    "outlier_replace_elapsed": """SELECT row_id,
        CASE WHEN elapsed_us > q3 + 1.5 * (q3 - q1) THEN q2 ELSE CAST(elapsed_us AS DOUBLE) END AS elapsed_us
      FROM el JOIN (SELECT assessmentItemID, quantile_cont(CAST(elapsed_us AS DOUBLE), 0.25) AS q1,
        quantile_cont(CAST(elapsed_us AS DOUBLE), 0.5) AS q2, quantile_cont(CAST(elapsed_us AS DOUBLE), 0.75) AS q3
        FROM el GROUP BY 1) USING (assessmentItemID)""",
    "scaler_fit": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM seqr"
        for c in ("consumedTime", "answerCode", "beforeCorrect")
    ),
    "scaler_apply": "SELECT row_id, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM seqr)) / (SELECT stddev_pop({c}) FROM seqr), 6) AS {c}"
        for c in ("consumedTime", "answerCode", "beforeCorrect")
    )
    + " FROM seqr",
    "user_sequences": "SELECT userID, chunk, "
    + ", ".join(
        f"{_line(c, 'Timestamp, row_id')} AS {c}_seq" for c in ("testId", "assessmentItemID", "KnowledgeTag", "answerCode")
    )
    + " FROM seg50 GROUP BY userID, chunk",
    "padded_sequences": f"""SELECT userID, {_line('i')} AS assessmentItemID_seq, {_line('t')} AS testId_seq,
      {_line('g')} AS KnowledgeTag_seq, {_line('c')} AS consumedTime_seq, {_line('a')} AS answerCode_seq,
      {_line('m')} AS mask FROM places GROUP BY userID""",
    "interaction_seq": f"""SELECT userID, {_line('inter')} AS interaction_seq, {_line('m')} AS mask
      FROM (SELECT *, coalesce(lag((a + 1) * m) OVER (PARTITION BY userID ORDER BY pos), 0) AS inter FROM places)
      GROUP BY userID""",
    "graph_nodes": """SELECT CAST(userID AS VARCHAR) AS id, 'user' AS kind, row_number() OVER (ORDER BY userID) - 1 AS idx
      FROM (SELECT DISTINCT userID FROM ans)
      UNION ALL SELECT assessmentItemID, 'item',
        row_number() OVER (ORDER BY assessmentItemID) - 1 + (SELECT count(DISTINCT userID) FROM ans)
      FROM (SELECT DISTINCT assessmentItemID FROM ans)""",
    "graph_edges": """SELECT u.idx AS src, i.idx + (SELECT count(DISTINCT userID) FROM ans) AS dst, answerCode AS label
      FROM dedup JOIN (SELECT userID, row_number() OVER (ORDER BY userID) - 1 AS idx
                       FROM (SELECT DISTINCT userID FROM ans)) u USING (userID)
      JOIN (SELECT assessmentItemID, row_number() OVER (ORDER BY assessmentItemID) - 1 AS idx
            FROM (SELECT DISTINCT assessmentItemID FROM ans)) i USING (assessmentItemID)""",
    **{out: _elo_final(key, f"e_{out}_", out) for key, out in _ELO_KEYS.items()},
    "elo_assessment_as_written": _elo_final("assessmentItemID", "e_written_", "elo_assessment"),
    "answer_levels": "SELECT row_id, level FROM lv_6",
    "boosting_table": _table("answerCode >= 0", "answerCode >= 0"),
    "features_valid": _table("part = 'train'", "part = 'valid'"),
    "features_test": _table("answerCode >= 0", "part = 'test'", label=False),
    "context_table": "SELECT x.row_id, x.part, "
    + ", ".join(f"CAST(d{i}.idx AS INT) AS {c}" for i, c in enumerate(_CTX))
    + ", x.answerCode FROM ctx_all x "
    + " ".join(
        f"LEFT JOIN dict_ctx d{i} ON d{i}.field = '{c}' AND d{i}.value = CAST(x.{c} AS VARCHAR)" for i, c in enumerate(_CTX)
    ),
    "sequence_table": f"""SELECT c.*, x.segment_id, x.answerCode,
        {', '.join(f'round(m{i}.a, 6) AS mean_{k}_answerCode, round(m{i}.t, 6) AS mean_{k}_consumedTime' for i, k in enumerate(_DICT))},
        round(x.consumedTime, 6) AS consumedTime,
        round(x.value_counts_assessmentItemID, 6) AS value_counts_assessmentItemID,
        round(x.value_counts_testId, 6) AS value_counts_testId
      FROM scaled x JOIN ({_ordinal_codes('dict_seq', _SEQ_CATS, 'seqr', ['row_id'])}) c USING (row_id)
      {' '.join(f'JOIN (SELECT {k}, avg(answerCode) AS a, avg(consumedTime) AS t FROM scaled GROUP BY 1) m{i} ON m{i}.{k} = x.{k}' for i, k in enumerate(_DICT))}""",
    "sequence_padded": "SELECT segment_id, "
    + ", ".join(f"{_padded_list(f'{c} + 1')} AS {c}_seq" for c in _SEQ_CATS)
    + f", {_padded_list('answerCode')} AS answerCode_seq, "
    + ", ".join(f"{_padded_list(f'CAST(round({c} * 10000) AS BIGINT)')} AS {c}_seq" for c in _SEQ_NUMS)
    + f", {_padded_list('1')} AS mask FROM seq_full GROUP BY segment_id",
    "sequence_test": f"""SELECT c.*, x.userID, x.answerCode,
        {', '.join(f'round(m{i}.a, 6) AS mean_{k}_answerCode, round(m{i}.t, 6) AS mean_{k}_consumedTime' for i, k in enumerate(_DICT))},
        round({_scaled('x.consumedTime', 'consumedTime')}, 6) AS consumedTime,
        round({_scaled('vi', 'vi')}, 6) AS value_counts_assessmentItemID,
        round({_scaled('vt', 'vt')}, 6) AS value_counts_testId
      FROM new_clean x JOIN ({_ordinal_codes('f_dict', _SEQ_CATS, 'new_rows', ['row_id'])}) c USING (row_id)
      LEFT JOIN (SELECT assessmentItemID, count(*) AS vi FROM f_clean GROUP BY 1) i ON i.assessmentItemID = x.assessmentItemID
      LEFT JOIN (SELECT testId, count(*) AS vt FROM f_clean GROUP BY 1) t ON t.testId = x.testId
      {' '.join(f'LEFT JOIN (SELECT {k}, avg(answerCode) AS a, avg(consumedTime) AS t FROM f_scaled GROUP BY 1) m{i} ON m{i}.{k} = x.{k}' for i, k in enumerate(_DICT))}""",
    "csv_round_trip": """SELECT userID, assessmentItemID, testId, answerCode, CAST(floor(epoch(Timestamp)) AS BIGINT) AS epoch,
      KnowledgeTag, split, row_number() OVER (PARTITION BY userID ORDER BY Timestamp, row_id) AS nth FROM tr""",
    "assets_round_trip": "SELECT 'value_counts_testId' AS asset, testId AS key, 'value' AS stat, CAST(count(*) AS DOUBLE) AS value FROM sc GROUP BY testId UNION ALL "
    + " UNION ALL ".join(
        f"SELECT 'mean_{c}_answerCode', CAST({c} AS VARCHAR), 'value', avg(answerCode) FROM sc GROUP BY {c}" for c in _DICT
    ),
    "dictionary_round_trip": "SELECT field, value, idx FROM dict_train",
    "lineitem_session_elapsed_blocks": "SELECT row_id, session, elapsed FROM l_el",
    "lineitem_user_running_blocks": f"SELECT {_RUN} FROM l_run",
    "metrics": """SELECT round(avg(CAST((CASE WHEN p >= 0.5 THEN 1 ELSE 0 END = y) AS INT)), 6) AS accuracy,
      round((SELECT auc FROM auc), 6) AS auc, round(sqrt(avg(pow(p - y, 2)) + 1e-6), 6) AS rmse,
      round(avg(greatest(p * 4 - 2, 0) - (p * 4 - 2) * y + ln(1 + exp(-abs(p * 4 - 2)))), 6) AS bce FROM rated""",
    "metrics_multiclass": "SELECT round(avg(-ln(mine)), 6) AS nll FROM owned",
    "top_k_accuracy": """SELECT round(avg(CAST(better < 1 AS INT)), 6) AS top_1,
      round(avg(CAST(better < 3 AS INT)), 6) AS top_3 FROM owned""",
}


def _needed(sql: str, found: dict[str, None]) -> None:
    for name in PARTS:
        if name not in found and re.search(rf"\b(?:FROM|JOIN|,)\s*{name}\b", sql):
            _needed(PARTS[name], found)
            found[name] = None


def oracle(name: str) -> str:
    """The full text of one query: its parts in order, then the query."""
    found: dict[str, None] = {}
    _needed(FINALS[name], found)
    if not found:
        return FINALS[name]
    # Read more than once, so computed once.
    parts = ",\n".join(f"{part} AS MATERIALIZED ({PARTS[part]})" for part in found)
    return f"WITH {parts}\n{FINALS[name]}"
