"""Event queries (ST3 batch, A4-A10, W3, F4-F7, J3) over ``events`` and ``orders``.

Stand-ins: the visitor is ``user_id``; the profile section an event
touched and its scroll depth come from the event's JSON ``props`` (k);
view time is the ``value`` of 'view' events, interactions are 'click',
feedback is purchase +1 / error -1.  Suggestions are ``orders``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import events as EV
from ..operators import metrics as M
from ..operators.dedup import top_bottom_n
from .base import register, table

K_SPARK = "CAST(get_json_object(props, '$.k') AS INT)"
K_DUCK = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
SECTIONS = ["experience", "education", "skills", "certifications", "summary"]
SECTION_OF_K = ("CASE CAST(k % 5 AS INT) WHEN 0 THEN 'experience' WHEN 1 THEN 'education' WHEN 2 THEN 'skills' "
                "WHEN 3 THEN 'certifications' ELSE 'summary' END")
MILESTONE_OF_K = "CASE WHEN k >= 100 THEN 100 WHEN k >= 75 THEN 75 WHEN k >= 50 THEN 50 WHEN k >= 25 THEN 25 ELSE 0 END"
GAP_US = 30 * 60 * 1_000_000
EV_CTE = f"ev AS (SELECT *, {K_DUCK} AS k FROM events), ev2 AS (SELECT *, {SECTION_OF_K} AS section FROM ev)"

SESS_CTE = f"""
ev AS (SELECT *, {K_DUCK} AS k FROM events),
ev2 AS (SELECT *, {SECTION_OF_K} AS section FROM ev),
l AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM ev2),
g AS (SELECT *, sum(CASE WHEN prev_ts IS NULL OR epoch_us(ts) - epoch_us(prev_ts) > {GAP_US} THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM l),
a AS (SELECT *, min(ts) OVER (PARTITION BY user_id, sid) AS session_start FROM g)"""
SESSIONS_DUCK = (f"WITH {SESS_CTE} SELECT user_id, session_start, max(ts) AS session_end, count(*) AS n_events, "
                 "date_sub('millisecond', session_start, max(ts)) AS duration_ms FROM a GROUP BY user_id, session_start")


def events_k(spark, d):
    ev = table(spark, d, "events").withColumn("k", F.expr(K_SPARK))
    return ev.withColumn("section", F.expr(SECTION_OF_K))


@register("sessionize", SESSIONS_DUCK)
def q_sessionize(spark, d):
    return EV.sessionize(table(spark, d, "events"), "user_id", "ts", gap_seconds=1800)


@register("scroll_depth", f"WITH {SESS_CTE} SELECT user_id, session_start, section, max({MILESTONE_OF_K}) AS max_depth "
                          "FROM a GROUP BY user_id, session_start, section")
def q_scroll_depth(spark, d):
    """A6 merged from slices: the deepest milestone per slice, then per session."""
    g = EV.session_groups(events_k(spark, d), ["section"], {"max_depth": (F.max(M.milestone("k")), F.max)}, gap_seconds=1800)
    return g.select("user_id", "session_start", "section", "max_depth")


@register("scroll_depth_plain", f"WITH {EV_CTE} SELECT section, user_id, max({MILESTONE_OF_K}) AS max_depth FROM ev2 GROUP BY section, user_id")
def q_scroll_depth_plain(spark, d):
    return M.scroll_depth(events_k(spark, d), ["section", "user_id"], "k")


@register("session_stats", f"WITH s AS ({SESSIONS_DUCK}) SELECT date_trunc('week', session_start) AS period, "
                           "count(*) AS n_sessions, avg(duration_ms) AS avg_duration_ms FROM s GROUP BY 1")
def q_session_stats(spark, d):
    s = EV.sessionize(table(spark, d, "events"), "user_id", "ts", gap_seconds=1800)
    return M.session_stats(s, "week", "session_start", "duration_ms")


REFERRER_OF_K = ("CASE CAST(k % 4 AS INT) WHEN 0 THEN 'search' WHEN 1 THEN 'social' WHEN 2 THEN 'direct' "
                 "ELSE 'email' END")


@register("top_referrers", f"""WITH {SESS_CTE},
f AS (SELECT user_id, session_start, arg_min({REFERRER_OF_K}, (ts, event_id)) AS referrer FROM a
      GROUP BY user_id, session_start)
SELECT referrer, count(*) AS n_sessions FROM f GROUP BY referrer
ORDER BY n_sessions DESC NULLS LAST, referrer ASC NULLS LAST LIMIT 10""")
def q_top_referrers(spark, d):
    """Each session's entry referrer (earliest event, merged over slices), then the top 10."""
    ev = events_k(spark, d).withColumn("referrer", F.expr(REFERRER_OF_K))
    first = F.min(F.struct("ts", "event_id", "referrer"))
    g = EV.session_groups(ev, [], {"first": (first, F.min)}, gap_seconds=1800)
    return M.top_referrers(g.select(F.col("first.referrer").alias("referrer")), "referrer", 10)


@register("bot_filter", f"""WITH {SESS_CTE},
bots AS (SELECT user_id, session_start FROM a GROUP BY user_id, session_start
         HAVING date_sub('millisecond', session_start, max(ts)) < 2000 AND max({MILESTONE_OF_K}) = 0)
SELECT event_id, user_id, session_start FROM a
WHERE NOT EXISTS (SELECT 1 FROM bots b WHERE b.user_id IS NOT DISTINCT FROM a.user_id AND b.session_start = a.session_start)""")
def q_bot_filter(spark, d):
    ev = events_k(spark, d).withColumn("depth", F.expr(MILESTONE_OF_K))
    return EV.bot_filter(ev, "depth", gap_seconds=1800).select("event_id", "user_id", "session_start")


ENGAGEMENT_DUCK = """SELECT {g}, CAST(count_if(event_type = 'view') AS BIGINT) AS views,
  CAST(coalesce(sum(CASE WHEN event_type = 'view' THEN CAST(value AS DECIMAL(28,10)) END), 0) AS DOUBLE) AS view_time,
  CAST(count_if(event_type = 'click') AS BIGINT) AS interactions,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'error' THEN -1 ELSE 0 END) AS BIGINT) AS feedback
FROM ev2 GROUP BY {g}"""


@register("section_engagement", f"WITH {EV_CTE} " + ENGAGEMENT_DUCK.format(g="section"))
def q_section_engagement(spark, d):
    return M.section_engagement(events_k(spark, d), ["section"])


@register("weighted_score", f"WITH {EV_CTE}, e AS ({ENGAGEMENT_DUCK.format(g='section')}) "
                            "SELECT *, view_time * 1.0 + interactions * 1.0 + feedback * 1.0 AS score FROM e")
def q_weighted_score(spark, d):
    return M.weighted_score(M.section_engagement(events_k(spark, d), ["section"]))


@register("top_bottom_n", f"""WITH {EV_CTE}, e AS ({ENGAGEMENT_DUCK.format(g='section, user_id')}),
s AS (SELECT section, user_id, view_time * 1.0 + interactions * 1.0 + feedback * 1.0 AS score FROM e)
SELECT * FROM (SELECT section, user_id, score, CAST(row_number() OVER (PARTITION BY section ORDER BY score DESC NULLS LAST, user_id) AS INTEGER) AS rank,
               'top' AS side FROM s) WHERE rank <= 3
UNION ALL
SELECT * FROM (SELECT section, user_id, score, CAST(row_number() OVER (PARTITION BY section ORDER BY score ASC NULLS LAST, user_id) AS INTEGER) AS rank,
               'bottom' AS side FROM s) WHERE rank <= 3""")
def q_top_bottom_n(spark, d):
    s = M.weighted_score(M.section_engagement(events_k(spark, d), ["section", "user_id"]))
    return top_bottom_n(s.select("section", "user_id", "score"), ["section"], "score", 3, tie=["user_id"])


_HEAT_COLS = ", ".join(
    f"CAST(coalesce(sum(CASE WHEN section = '{s}' THEN CAST(value AS DECIMAL(28,10)) END), 0) AS DOUBLE) AS {s}"
    for s in SECTIONS)


@register("section_heatmap", f"WITH {EV_CTE} SELECT date_trunc('day', ts) AS period, {_HEAT_COLS} FROM ev2 GROUP BY 1")
def q_section_heatmap(spark, d):
    ev = events_k(spark, d)
    return M.section_heatmap(ev, F.date_trunc("day", "ts").cast("timestamp_ntz"), "section", F.col("value"), SECTIONS)


RETENTION_AS_OF = "2024-04-20"
RETENTION_CUTOFF = (dt.date.fromisoformat(RETENTION_AS_OF) - dt.timedelta(days=90)).isoformat()


@register("retention", f"SELECT * FROM events WHERE ts >= TIMESTAMP '{RETENTION_CUTOFF} 00:00:00'")
def q_retention(spark, d):
    return EV.retention(table(spark, d, "events"), RETENTION_AS_OF, 90)


@register("cold_start_gate", f"WITH {SESS_CTE} SELECT section, count(DISTINCT (user_id, session_start)) AS n_sessions, "
                             "count(DISTINCT (user_id, session_start)) >= 50 AS ready FROM a GROUP BY section")
def q_cold_start_gate(spark, d):
    """Distinct sessions per section from the (user, session, section) groups, no per-event join."""
    g = EV.session_groups(events_k(spark, d), ["section"], {}, gap_seconds=1800)
    return M.cold_start_gate(g, ["section"])


# one rule for each section, and one section that has no events at all
SEED_RULES = [("experience", "timeline"), ("education", "list"), ("skills", "bars"), ("certifications", "cards"), ("summary", "text"),
              ("recommendations", "quotes")]
SEED_VALUES = ", ".join(f"('{s}', '{v}')" for s, v in SEED_RULES)


@register("cold_start_seed", f"""WITH {SESS_CTE},
day AS (SELECT *, CAST(date_trunc('day', session_start) AS DATE) AS day FROM a),
gate AS (SELECT section, day, count(DISTINCT (user_id, session_start)) AS n FROM day GROUP BY section, day),
busy AS (SELECT section, day FROM gate WHERE n >= 50),
kinds AS (SELECT section, day, event_type AS viz, CAST(count(*) AS BIGINT) AS n_events FROM day GROUP BY section, day, event_type),
best AS (SELECT * FROM kinds QUALIFY row_number() OVER (PARTITION BY section, day ORDER BY n_events DESC, viz) = 1),
rules AS (SELECT r.section, d.day, r.viz FROM (VALUES {SEED_VALUES}) r(section, viz), (SELECT DISTINCT day FROM day) d)
SELECT section, day, viz, n_events, 'data' AS origin FROM best SEMI JOIN busy USING (section, day)
UNION ALL SELECT section, day, viz, NULL, 'rule' FROM rules ANTI JOIN busy USING (section, day)""")
def q_cold_start_seed(spark, d):
    """A9 by section and day: where a day has 50 sessions the commonest kind of event leads, elsewhere the rule does."""
    g = EV.session_groups(events_k(spark, d), ["section", "event_type"], {"n": (F.count(F.lit(1)), F.sum)}, gap_seconds=1800)
    g = g.withColumn("day", F.col("session_start").cast("date"))
    gate = M.cold_start_gate(g, ["section", "day"], session=["user_id", "session_start"])
    kinds = g.groupBy("section", "day", F.col("event_type").alias("viz")).agg(F.sum("n").alias("n_events"))
    best = M.top_k_per(kinds, ["section", "day"], "n_events", 1, ["viz"]).drop("position")
    days = g.select("day").distinct()
    rule = F.explode(F.array(*[F.struct(F.lit(s).alias("section"), F.lit(v).alias("viz")) for s, v in SEED_RULES])).alias("r")
    return M.with_seeds(best, gate, days.select("day", rule).select("r.section", "day", "r.viz"), ["section", "day"])


@register("consent_filter", "SELECT * FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def q_consent_filter(spark, d):
    consent = table(spark, d, "customer").filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("user_id"))
    return EV.consent_filter(table(spark, d, "events"), consent, "user_id")


STATUS = "CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'accepted' ELSE 'rejected' END"
EXPIRY_AS_OF = "1998-01-01"
EXPIRY_CUTOFF = (dt.date.fromisoformat(EXPIRY_AS_OF) - dt.timedelta(days=30)).isoformat()


def suggestions(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.expr(STATUS).alias("status"),
                                            F.col("o_orderdate").alias("created_at"), "o_orderpriority")


@register("suggestion_expiry", f"SELECT o_orderkey, CASE WHEN status = 'pending' AND created_at < TIMESTAMP '{EXPIRY_CUTOFF}' "
                               "THEN 'archived' ELSE status END AS status, created_at FROM "
                               f"(SELECT o_orderkey, {STATUS} AS status, o_orderdate AS created_at FROM orders)")
def q_suggestion_expiry(spark, d):
    return EV.suggestion_expiry(suggestions(spark, d), EXPIRY_AS_OF, 30).select("o_orderkey", "status", "created_at")


KNOWN = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@register("known_viz", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ("
                       + ", ".join(f"'{v}'" for v in KNOWN) + ")")
def q_known_viz(spark, d):
    return EV.known_values(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", KNOWN)


PERIOD_SPARK = "CAST(floor(datediff(CAST(o_orderdate AS DATE), DATE '1970-01-01') / 28) AS BIGINT)"
PERIOD_DUCK = "CAST(floor(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) / 28) AS BIGINT)"


@register("acceptance_rate", f"""SELECT period, CAST(count_if(status = 'accepted') AS BIGINT) AS accepted, count(*) AS total,
  CAST(count_if(status = 'accepted') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate,
  CAST(count_if(status = 'accepted') AS DOUBLE) / CAST(count(*) AS DOUBLE) < 0.3 AS alarm
FROM (SELECT {PERIOD_DUCK} AS period, {STATUS} AS status FROM orders) GROUP BY period""")
def q_acceptance_rate(spark, d):
    s = table(spark, d, "orders").select(F.expr(PERIOD_SPARK).alias("period"), F.expr(STATUS).alias("status"))
    return M.acceptance_rate(s, [F.col("period")], "status", 0.30)
