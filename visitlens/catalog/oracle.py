"""SQL counterparts of the queries, for an independent engine over the same tables."""

from __future__ import annotations

from visitlens.catalog.queries import HELD_OUT_MONTHS
from visitlens.plans.recipes import RECIPES
from visitlens.sources.roles import TABLES, TRAIN_BEFORE

ROLES = f"""
reg AS (
  SELECT o_orderkey AS row_id, o_custkey AS "Patient_ID",
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS "Health_Camp_ID",
         o_orderdate AS "Registration_Date",
         o_custkey % 97 AS "Var1", CAST(floor(o_totalprice / 100) AS BIGINT) AS "Var2",
         o_orderkey % 13 AS "Var4", CAST(floor(o_totalprice) AS BIGINT) AS "Var5",
         o_orderdate < TIMESTAMP '{TRAIN_BEFORE} 00:00:00' AS is_train
  FROM orders),
o AS (SELECT *, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS camp FROM orders),
camp AS (
  SELECT camp AS "Health_Camp_ID", min(o_orderdate) AS "CD_Camp_Start_Date", max(o_orderdate) AS "CD_Camp_End_Date",
         CASE camp % 3 WHEN 0 THEN 'First' WHEN 1 THEN 'Second' ELSE 'Third' END AS "CD_Category1",
         first(o_orderpriority ORDER BY o_orderdate, o_orderkey) AS "CD_Category2",
         camp % 2 AS "CD_Category3"
  FROM o GROUP BY camp),
patient AS (
  SELECT c_custkey AS "Patient_ID",
         TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS "PD_First_Interaction",
         c_mktsegment AS "PD_Segment", c_acctbal AS "PD_Balance"
  FROM customer),
a1 AS (
  SELECT o_custkey AS "Patient_ID", camp AS "Health_Camp_ID", round(avg(o_totalprice) / 1e6, 6) AS "F_Health_Score"
  FROM o WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2),
a2 AS (
  SELECT o_custkey AS "Patient_ID", camp AS "Health_Camp_ID", round(avg(o_totalprice) / 1e6, 6) AS "S_Health_Score"
  FROM o WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' GROUP BY 1, 2),
a3 AS (
  SELECT o_custkey AS "Patient_ID", camp AS "Health_Camp_ID",
         CAST(count(l.l_orderkey) AS BIGINT) AS "T_Number_of_stall_visited"
  FROM o LEFT JOIN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 45) l ON l.l_orderkey = o_orderkey
  WHERE o_orderstatus = 'P' GROUP BY 1, 2),
dims AS (SELECT * FROM reg LEFT JOIN camp USING ("Health_Camp_ID") LEFT JOIN patient USING ("Patient_ID")),
train AS (
  SELECT d.*, "F_Health_Score", "S_Health_Score", "T_Number_of_stall_visited",
         CASE WHEN "F_Health_Score" IS NOT NULL OR "S_Health_Score" IS NOT NULL
                OR coalesce("T_Number_of_stall_visited" >= 1, false) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS target
  FROM dims d
  LEFT JOIN a1 USING ("Patient_ID", "Health_Camp_ID")
  LEFT JOIN a2 USING ("Patient_ID", "Health_Camp_ID")
  LEFT JOIN a3 USING ("Patient_ID", "Health_Camp_ID")
  WHERE is_train),
stacked AS (
  SELECT * FROM train
  UNION ALL BY NAME
  SELECT * FROM dims WHERE NOT is_train)
"""

DAY = 86400000000.0


def days(start: str, end: str) -> str:
    return f"(date_diff('microsecond', {start}, {end}) / {DAY})"


def _roles(select: str, more: str = "") -> str:
    return f"WITH {ROLES}{', ' + more if more else ''} {select}"


PATIENT = 'PARTITION BY "Patient_ID"'
BY_TIME = 'ORDER BY "Registration_Date", row_id'
REG = '"Registration_Date"'


def _count(within: str, order: str = BY_TIME) -> str:
    return f"CAST(row_number() OVER (PARTITION BY {within} {order}) - 1 AS BIGINT)"


def _since(window: str) -> str:
    return f"round(coalesce({days(f'lag({REG}) OVER ({window})', REG)}, 0.0), 6)"


def _score(column: str, level: str, k: int) -> str:
    lagged = f'lag("{column}", {k}) OVER (PARTITION BY "Patient_ID", "CD_Category1" ORDER BY row_id)'
    return f"CASE WHEN \"CD_Category1\" = '{level}' THEN {lagged} END"


CLEAN_2 = "nullif(\"CD_Category2\", '2-HIGH')"
CLEAN_3 = 'nullif("CD_Category3", 1)'

HISTORY = {
    "time_since_last_visit": _since(f"{PATIENT} {BY_TIME}"),
    "time_since_first_visit": f"round({days(f'min({REG}) OVER ({PATIENT})', REG)}, 6)",
    "time_since_last_visit_in_this_camp_today": _since(
        'ORDER BY "Patient_ID", "Health_Camp_ID", "Registration_Date", row_id'
    ),
    "time_since_last_visit_in_this_camp": _since('ORDER BY "Patient_ID", "Health_Camp_ID", row_id'),
    "number_of_visits_in_this_camp": _count('"Health_Camp_ID", "Patient_ID"'),
    "number_of_visits_in_this_camp_type1": _count('"Patient_ID", "CD_Category1"'),
    "number_of_visits_in_this_camp_type2": f"CASE WHEN {CLEAN_2} IS NOT NULL THEN "
    + _count(f'"Patient_ID", {CLEAN_2}')
    + " END",
    "number_of_visits_in_this_camp_type3": f"CASE WHEN {CLEAN_3} IS NOT NULL THEN "
    + _count(f'"Patient_ID", {CLEAN_3}')
    + " END",
    "last1_score_camp1": _score("F_Health_Score", "First", 1),
    "last1_score_camp2": _score("S_Health_Score", "Second", 1),
    "last2_score_camp1": _score("F_Health_Score", "First", 2),
    "last2_score_camp2": _score("S_Health_Score", "Second", 2),
    "number_of_visits_today": _count('"Registration_Date", "Patient_ID"', "ORDER BY row_id"),
    "visits_till_now": _count('"Patient_ID"'),
    "number_of_camps_attended": _count('"Patient_ID"'),
    "last_1_target": f"lag(target, 1) OVER ({PATIENT} ORDER BY row_id)",
    "last_2_target": f"lag(target, 2) OVER ({PATIENT} ORDER BY row_id)",
    "Registration_Date_lead": f"lag({REG}, 1) OVER ({PATIENT} ORDER BY row_id)",
    "Registration_Date_lag": f"lead({REG}, 11) OVER ({PATIENT} ORDER BY row_id)",
}

DELTAS = {
    "time_since_interaction": days('"PD_First_Interaction"', REG),
    "time_since_camp_start": days('"CD_Camp_Start_Date"', REG),
    "time_before_camp_ends": days(REG, '"CD_Camp_End_Date"'),
}

NEXT = """
bounds AS (
  SELECT "Health_Camp_ID",
         first("CD_Camp_Start_Date" ORDER BY row_id) FILTER ("CD_Camp_Start_Date" IS NOT NULL) AS start_date,
         last("CD_Camp_End_Date" ORDER BY row_id) FILTER ("CD_Camp_End_Date" IS NOT NULL) AS end_date
  FROM dims GROUP BY 1),
following AS (
  SELECT *, lead(start_date) OVER (ORDER BY start_date, "Health_Camp_ID") AS next_start FROM bounds),
per_camp AS (SELECT "Health_Camp_ID", count(DISTINCT "Patient_ID") AS n_camp FROM reg GROUP BY 1),
per_day AS (SELECT "Registration_Date", count(DISTINCT "Patient_ID") AS n_day FROM reg GROUP BY 1)
"""


def _history(*names: str, source: str = "reg") -> str:
    return _roles(f"SELECT row_id, {', '.join(f'{HISTORY[n]} AS {chr(34)}{n}{chr(34)}' for n in names)} FROM {source}")


def _part(column: str, part: str) -> str:
    derive = {"month": "month", "year": "year", "day": "day"}
    expr = f'isodow("{column}") - 1' if part == "weekday" else f'{derive[part]}("{column}")'
    return f"CAST({expr} AS BIGINT)"


DATES = ["Registration_Date", "CD_Camp_Start_Date", "CD_Camp_End_Date", "PD_First_Interaction"]
PARTS = ("month", "year", "day", "weekday")


def _feature_table(name: str) -> str:
    recipe = RECIPES[name]
    rare = {
        v: f'CASE WHEN count("{v}") OVER (PARTITION BY "{v}") = 1 THEN NULL ELSE "{v}" END'
        for v in ("Var1", "Var2", "Var4", "Var5")
    }
    span = ('"CD_Camp_End_Date"', '"CD_Camp_Start_Date"')
    camp_time = days(*span) if recipe.camp_time_from_end else days(*reversed(span))
    made = {
        **HISTORY,
        **DELTAS,
        "camp_time": camp_time,
        "num_people_in_camp": "n_camp",
        "num_people_in_camp_today": "n_day",
        "next_camp_in": f"({DELTAS['time_before_camp_ends']} + {days('end_date', 'next_start')})",
    }
    numeric = {**rare, "CD_Category3": CLEAN_3, "PD_Balance": '"PD_Balance"'}
    dates = [*DATES]
    inner = "*"
    if recipe.shifted_dates:
        dates += ["Registration_Date_lead", "Registration_Date_lag"]
        inner = "*, " + ", ".join(f'{HISTORY[c]} AS "{c}"' for c in dates[-2:])
    numeric |= {f"{c}_{p}": _part(c, p) for c in dates for p in PARTS}
    numeric |= {f: made[f] for f in recipe.features}
    filled = [f'round(coalesce(CAST({e} AS DOUBLE), -9999.0), 6) AS "{c}"' for c, e in numeric.items()]
    levels = {"CD_Category1": '"CD_Category1"', "CD_Category2": CLEAN_2, "PD_Segment": '"PD_Segment"'}
    named = [f"coalesce({e}, 'Is Null') AS \"{c}\"" for c, e in levels.items()]
    keys = 'row_id, "Patient_ID", "Health_Camp_ID", "Registration_Date", is_train, target'
    return _roles(
        f"SELECT {keys}, {', '.join([*filled, *named])} FROM wide",
        NEXT
        + f""", wide AS (SELECT {inner} FROM stacked
            LEFT JOIN following USING ("Health_Camp_ID")
            LEFT JOIN per_camp USING ("Health_Camp_ID")
            LEFT JOIN per_day USING ("Registration_Date"))""",
    )


def _feature_map(name: str) -> str:
    """Slots of the vector: numeric columns in table order, then the levels of each categorical column in order."""
    numeric = ["Var1", "Var2", "Var4", "Var5", "CD_Category3", "PD_Balance"]
    numeric += [f"{c}_{p}" for c in DATES for p in PARTS] + list(RECIPES[name].features)
    levels = ("CD_Category1", "CD_Category2", "PD_Segment")
    listed = ", ".join(f"'{c}'" for c in numeric)
    union = " UNION ".join(f"SELECT {i} AS n, '{c}' AS c, \"{c}\" AS level FROM f" for i, c in enumerate(levels))
    return f"""
        WITH f AS ({_feature_table(name)}),
        slots AS (SELECT 0 AS part, generate_subscripts([{listed}], 1) AS n, '' AS level, unnest([{listed}]) AS feature
                  UNION ALL SELECT 1, n, level, c || '_hot_' || level FROM ({union}))
        SELECT CAST(row_number() OVER (ORDER BY part, n, level) - 1 AS BIGINT) AS position, feature, 'q' AS type FROM slots"""


def _repeated_attendance() -> str:
    """Ids are the order's key times the product of the most records per pair, plus the copy's number."""
    pair = '"Patient_ID", "Health_Camp_ID"'
    records = f"""
        r1 AS (SELECT *, row_number() OVER (PARTITION BY {pair} ORDER BY "F_Health_Score") - 1 AS c1 FROM (
          SELECT o_custkey AS "Patient_ID", camp AS "Health_Camp_ID", round(o_totalprice / 1e6, 6) AS "F_Health_Score"
          FROM o WHERE o_orderstatus = 'F')),
        r2 AS (SELECT *, row_number() OVER (PARTITION BY {pair} ORDER BY "S_Health_Score") - 1 AS c2 FROM (
          SELECT o_custkey AS "Patient_ID", camp AS "Health_Camp_ID", round(o_totalprice / 1e6, 6) AS "S_Health_Score"
          FROM o WHERE o_orderstatus = 'O')),
        most AS (SELECT (SELECT max(c1) + 1 FROM r1) AS m1, (SELECT max(c2) + 1 FROM r2) AS m2)"""
    attended = '"F_Health_Score" IS NOT NULL OR "S_Health_Score" IS NOT NULL OR coalesce("T_Number_of_stall_visited" >= 1, false)'
    return _roles(
        f"""SELECT row_id * m1 * m2 + coalesce(c1, 0) * m2 + coalesce(c2, 0) AS row_id, {pair}, is_train, {ATTENDED},
                   CASE WHEN {attended} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS target
            FROM reg LEFT JOIN r1 USING ({pair}) LEFT JOIN r2 USING ({pair}) LEFT JOIN a3 USING ({pair}), most
            WHERE is_train
            UNION ALL
            SELECT row_id * m1 * m2, {pair}, is_train, NULL, NULL, NULL, NULL FROM reg, most WHERE NOT is_train""",
        records,
    )


SCORES = """
scores AS (
  SELECT row_id, "Patient_ID", "Health_Camp_ID", unnest(['model1', 'model2', 'model3']) AS model,
         unnest([("Patient_ID" % 1000) / 1000.0::DOUBLE, ((row_id * 7919) % 10007) / 10007.0::DOUBLE,
                 o_totalprice / (o_totalprice + 100000.0::DOUBLE)]) AS "Outcome"
  FROM reg JOIN orders ON o_orderkey = row_id)
"""

AGE = 'row_number() OVER (ORDER BY "Registration_Date" DESC NULLS LAST, row_id DESC)'


def _shapes() -> str:
    parts = [
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, "
        f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS BIGINT) AS n_columns"
        for t in TABLES
    ]
    return " UNION ALL ".join(parts)


DIM_COLUMNS = (
    'row_id, "Patient_ID", "Health_Camp_ID", "Registration_Date", "Var1", "Var2", "Var4", "Var5", '
    '"CD_Camp_Start_Date", "CD_Camp_End_Date", "CD_Category1", "CD_Category2", "CD_Category3", '
    '"PD_First_Interaction", "PD_Segment", "PD_Balance"'
)
REG_COLUMNS = 'row_id, "Patient_ID", "Health_Camp_ID", "Registration_Date", "Var1", "Var2", "Var4", "Var5"'
ATTENDED = '"F_Health_Score", "S_Health_Score", "T_Number_of_stall_visited"'
EVENT_DAYS = days("lag(ts) OVER ({0})", "ts")


def _event_since(window: str) -> str:
    return f"round(coalesce({EVENT_DAYS.format(window)}, 0.0), 6)"


HOT = """
hot AS (
  SELECT row_id, CASE WHEN row_id % 11 = 0 THEN NULL WHEN row_id % 3 = 0 THEN 5 ELSE "Patient_ID" END AS "Patient_ID",
         "Health_Camp_ID", CASE WHEN row_id % 17 <> 0 THEN "Registration_Date" END AS "Registration_Date",
         nullif("Var1", 3) AS "Var1", CASE WHEN row_id % 5 <> 0 THEN "Var2" END AS "Var2"
  FROM reg)"""
HOT_TIME = 'ORDER BY "Registration_Date" NULLS LAST, row_id'

ORACLE: dict[str, str] = {
    "hot_entity_history": _roles(
        f"""
        SELECT row_id,
          CASE WHEN "Patient_ID" IS NULL THEN 0.0::DOUBLE ELSE {_since(f'{PATIENT} {HOT_TIME}')} END AS time_since_last_visit,
          CASE WHEN "Patient_ID" IS NOT NULL THEN row_number() OVER ({PATIENT} {HOT_TIME}) - 1 END AS visits_till_now,
          CASE WHEN "Patient_ID" IS NOT NULL
               THEN row_number() OVER ({PATIENT}, "Health_Camp_ID" {HOT_TIME}) - 1 END AS number_of_visits_in_this_camp,
          CASE WHEN "Patient_ID" IS NOT NULL THEN lag("Var2", 2) OVER ({PATIENT} ORDER BY row_id) END AS var2_two_rows_ago
        FROM hot""",
        HOT.strip(),
    ),
    "hot_key_join": _roles(
        """SELECT row_id, "Patient_ID", "PD_First_Interaction" AS "First_Interaction", "PD_Segment" AS "Segment",
                  "PD_Balance" AS "Balance" FROM hot LEFT JOIN patient USING ("Patient_ID")""",
        HOT.strip(),
    ),
    "mask_with_nulls": _roles(
        "SELECT row_id, "
        + ", ".join(
            f'CASE WHEN count("{v}") OVER (PARTITION BY "{v}") = 1 THEN NULL ELSE "{v}" END AS "{v}"' for v in ("Var1", "Var2")
        )
        + " FROM hot",
        HOT.strip(),
    ),
    "scan_registrations": _roles(f"SELECT {REG_COLUMNS} FROM reg"),
    "table_shapes": _shapes(),
    "prefix_columns": _roles("SELECT * FROM a2"),
    "prefix_camps": _roles("SELECT * FROM camp"),
    "prefix_patients": _roles("SELECT * FROM patient"),
    "prefix_first": _roles("SELECT * FROM a1"),
    "prefix_third": _roles("SELECT * FROM a3"),
    "join_repeated_attendance": _repeated_attendance(),
    "people_in_camp_sketch": _roles(
        """SELECT "Health_Camp_ID", count(DISTINCT "Patient_ID") AS num_people, true AS within_bound FROM reg GROUP BY 1
           UNION ALL SELECT CAST(NULL AS BIGINT), count(DISTINCT "Patient_ID"), true FROM reg"""
    ),
    "feature_map": _feature_map("R1"),
    "union_train_test": _roles(f"SELECT row_id, is_train, target, {ATTENDED} FROM stacked"),
    "split_union": _roles("SELECT row_id, CASE WHEN is_train THEN 'train' ELSE 'test' END AS side FROM reg"),
    "join_dimensions": _roles(f"SELECT {DIM_COLUMNS} FROM dims"),
    "join_attendance": _roles(f"SELECT {REG_COLUMNS}, {ATTENDED} FROM train"),
    "derive_target": _roles(f"SELECT {DIM_COLUMNS}, {ATTENDED}, target FROM train"),
    "null_out_value": _roles(f'SELECT row_id, {CLEAN_2} AS "CD_Category2", {CLEAN_3} AS "CD_Category3" FROM dims'),
    "value_counts": "SELECT CAST(floor(value) AS BIGINT) AS v, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1",
    "mask_rare_values": """
        WITH e AS (SELECT event_id, CAST(floor(value) AS BIGINT) AS v FROM events)
        SELECT event_id, CASE WHEN count(v) OVER (PARTITION BY v) = 1 THEN NULL ELSE v END AS v FROM e""",
    "mask_rare_columns": _roles(
        "SELECT row_id, "
        + ", ".join(
            f'CASE WHEN count("{v}") OVER (PARTITION BY "{v}") = 1 THEN NULL ELSE "{v}" END AS "{v}"'
            for v in ("Var1", "Var2", "Var4", "Var5")
        )
        + " FROM reg"
    ),
    "fill_sentinel": _roles(
        "SELECT row_id, "
        + ", ".join(
            f'coalesce(CAST("{c}" AS DOUBLE), -9999.0::DOUBLE) AS "{c}"'
            for c in ("F_Health_Score", "S_Health_Score", "T_Number_of_stall_visited", "target")
        )
        + f", coalesce({CLEAN_2}, 'Is Null') AS \"CD_Category2\" FROM stacked"
    ),
    "date_parts": _roles(
        "SELECT row_id, " + ", ".join(f'{_part(c, p)} AS "{c}_{p}"' for c in DATES for p in PARTS) + " FROM dims"
    ),
    "time_deltas": _roles(
        "SELECT row_id, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in DELTAS.items()) + " FROM dims"
    ),
    "camp_time": _roles(
        f"""SELECT row_id, round({days('"CD_Camp_End_Date"', '"CD_Camp_Start_Date"')}, 6) AS camp_time,
            round({days('"CD_Camp_Start_Date"', '"CD_Camp_End_Date"')}, 6) AS camp_time_forward FROM dims"""
    ),
    "time_since_last_visit": _history("time_since_last_visit"),
    "time_since_first_visit": _history("time_since_first_visit"),
    "event_recency": f"""
        SELECT event_id,
          {_event_since('PARTITION BY user_id ORDER BY ts, event_id')} AS time_since_last_visit,
          round({days('min(ts) OVER (PARTITION BY user_id)', 'ts')}, 6) AS time_since_first_visit,
          CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS visits_till_now,
          CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS BIGINT)
            AS visits_of_this_type
        FROM events""",
    "visits_till_now": _history("visits_till_now", "number_of_camps_attended"),
    "visits_in_camp": _history("number_of_visits_in_this_camp"),
    "visits_by_category": _history(
        *[f"number_of_visits_in_this_camp_type{i}" for i in (1, 2, 3)], source="dims"
    ),
    "visits_today": _history("number_of_visits_today"),
    "last_scores": _history(
        "last1_score_camp1", "last1_score_camp2", "last2_score_camp1", "last2_score_camp2", source="stacked"
    ),
    "lag_target": _history("last_1_target", "last_2_target", source="stacked"),
    "lead_lag_target": _roles(
        f"""SELECT row_id, lag(target) OVER ({PATIENT} {BY_TIME}) AS target_lead,
            lead(target) OVER ({PATIENT} {BY_TIME}) AS target_lag FROM stacked"""
    ),
    "lead_lag_dates": _history("Registration_Date_lead", "Registration_Date_lag"),
    "global_lag_diff": _history("time_since_last_visit_in_this_camp_today"),
    "global_lag_diff_by_row": _history("time_since_last_visit_in_this_camp"),
    "global_lag_events": f"""
        SELECT event_id, {_event_since('ORDER BY user_id, event_type, ts, event_id')} AS days_since_previous
        FROM events""",
    "people_in_camp": _roles(
        'SELECT row_id, "Health_Camp_ID", n_camp AS num_people_in_camp FROM reg JOIN per_camp USING ("Health_Camp_ID")',
        NEXT,
    ),
    "people_per_day": _roles(
        """SELECT row_id, "Registration_Date", n_day AS num_people_in_camp_today
           FROM reg JOIN per_day USING ("Registration_Date")""",
        NEXT,
    ),
    "users_per_day": """
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(DISTINCT user_id) AS num_users
        FROM events GROUP BY 1""",
    "camp_bounds": _roles('SELECT "Health_Camp_ID", start_date, end_date, next_start FROM following', NEXT),
    "next_camp_in": _roles(
        f"""SELECT row_id,
              round({DELTAS['time_before_camp_ends']} + {days('end_date', 'next_start')}, 6) AS next_camp_in
            FROM dims JOIN following USING ("Health_Camp_ID")""",
        NEXT,
    ),
    "row_number_global": _roles(
        f'SELECT row_id, "Registration_Date", CAST(row_number() OVER ({BY_TIME}) - 1 AS BIGINT) AS row_number FROM reg'
    ),
    "sort_by_date": _roles(f"SELECT {REG_COLUMNS} FROM reg {BY_TIME}"),
    "holdout_last_n": _roles(
        f"""SELECT row_id, CASE WHEN age <= (SELECT count(*) // 5 FROM train) THEN 'validation' ELSE 'training' END AS side
            FROM (SELECT row_id, {AGE} AS age FROM reg WHERE is_train)"""
    ),
    "holdout_by_group": _roles(
        f"""SELECT row_id, CASE WHEN "Health_Camp_ID" IN ({', '.join(map(str, HELD_OUT_MONTHS))})
            THEN 'validation' ELSE 'training' END AS side FROM reg WHERE is_train"""
    ),
    "label_encode": """
        SELECT c_mktsegment, c_custkey,
               CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT) AS c_mktsegment_code
        FROM (SELECT c_custkey, coalesce(c_mktsegment, 'Is Null') AS c_mktsegment FROM customer)""",
    "one_hot": """
        SELECT o_orderkey, 'o_orderpriority' AS feature, o_orderpriority AS level,
               CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS position, 1.0::DOUBLE AS value
        FROM orders""",
    "feature_table": _feature_table("R1"),
    "feature_table_r4": _feature_table("R4"),
    "feature_table_r5": _feature_table("R5"),
    "feature_table_r6": _feature_table("R6"),
    "feature_table_r7": _feature_table("R7"),
    "auc_exact": _roles(
        """SELECT model, round((sum(mid_rank) FILTER (target > 0)
                     - count(*) FILTER (target > 0) * (count(*) FILTER (target > 0) + 1) / 2.0::DOUBLE)
                   / (count(*) FILTER (target > 0) * count(*) FILTER (target = 0)), 9) AS auc
           FROM ranked GROUP BY model""",
        SCORES
        + """, ranked AS (
            SELECT model, target, rank() OVER (PARTITION BY model ORDER BY "Outcome")
                     + (count(*) OVER (PARTITION BY model, "Outcome") - 1) / 2.0::DOUBLE AS mid_rank
            FROM scores JOIN train USING (row_id))""",
    ),
    "share_of_total": """
        SELECT user_id, count(*) AS fscore, round(count(*) / sum(count(*)) OVER (), 9) AS share
        FROM events GROUP BY user_id""",
    "ensemble_mean": _roles(
        """SELECT row_id, "Patient_ID", "Health_Camp_ID", round(avg("Outcome"), 9) AS "Outcome"
           FROM scores GROUP BY ALL""",
        SCORES,
    ),
}
