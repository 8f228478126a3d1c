"""Joins (J), aggregations (A), windows (W), sorts and limits (S), set operations (SO)."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsmart.checks.marts import room_mart, unstamped
from opsmart.checks.prelude import HOUR_AGGS, fixed_sum, norm
from opsmart.checks.registry import check
from opsmart.functions import facility, numbers, times
from opsmart.operators.audit import key_report
from opsmart.operators.latest import latest_per_key
from opsmart.operators.lookup import attach, attach_codes, in_role
from opsmart.operators.rollup import bucketize, counted, period_rollup, with_share
from opsmart.operators.select import asc, desc, page, page_after, pivot_sum, top_k
from opsmart.plans import gold_reservations as gr
from opsmart.plans import gold_tickets as gt


# --- joins ---
@check("j_01_code_dimension", """SELECT ticket_id, t.status_code, status FROM tk t
    LEFT JOIN c_status s ON t.status_code = s.status_code""")
def _(t):
    joined = attach_codes(t.tickets, t.codes["ticket_status"], "status_code")
    return joined.select("ticket_id", F.col("status_code").cast("int"), "status")


_ROLES = """SELECT ticket_id, requester_user_id, requester_login, last_updater_user_id, last_updater_login FROM te"""


@check("j_02_role_playing", _ROLES)
def _(t):
    return _two_roles(t, salts=1)


@check("j_02_role_playing_salted", _ROLES)
def _(t):
    return _two_roles(t, salts=8)


def _two_roles(t, salts):
    fact = t.tickets.select("ticket_id", "requester_user_id", "last_updater_user_id")
    requester = in_role(t.users, gt.REQUESTER).drop("requester_full_name")
    updater = in_role(t.users, gt.UPDATER).drop("last_updater_full_name")
    out = attach(fact, requester, "requester_user_id", salts)
    return attach(out, updater, "last_updater_user_id", salts)


@check("j_03_deduplicated_dimension", """SELECT reservation_id, r.reservation_item_id, reservation_item_name FROM rs r
    LEFT JOIN (SELECT reservation_item_id, max(reservation_item_name) AS reservation_item_name FROM
      (SELECT * FROM it UNION ALL SELECT reservation_item_id, 'A' FROM it) GROUP BY 1) i
    ON r.reservation_item_id = i.reservation_item_id""")
def _(t):
    twice = t.items.unionByName(t.items.withColumn("reservation_item_name", F.lit("A")))
    fact = t.reservations.select("reservation_id", "reservation_item_id")
    return attach(fact, gr.item_names(twice), "reservation_item_id")


@check("j_04_counts_with_totals", """SELECT c.period, type_code, ticket_count, total_tickets FROM
    (SELECT strftime(created_ts, '%Y-%m') AS period, type_code, count(*) AS ticket_count FROM tk WHERE created_ts IS NOT NULL GROUP BY 1, 2) c
    JOIN (SELECT strftime(created_ts, '%Y-%m') AS period, count(*) AS total_tickets FROM tk WHERE created_ts IS NOT NULL GROUP BY 1) s USING (period)""")
def _(t):
    dated = t.tickets.where(F.col("created_ts").isNotNull())
    months = dated.groupBy(times.month_start(F.col("created_ts")).alias("_m"), "type_code")
    counts = months.agg(F.count(F.lit(1)).alias("ticket_count")).select(
        times.month_label(F.col("_m")).alias("period"), "type_code", "ticket_count"
    )
    return with_share(counts).drop("share")


@check("j_05_join_chain", """SELECT count(*) AS rows, count(category) AS categories, count(location) AS locations,
    count(status) AS statuses, count(priority) AS priorities, count(type) AS types,
    count(requester_login) AS requesters, count(last_updater_login) AS updaters FROM te""")
def _(t):
    names = {
        "categories": "category", "locations": "location", "statuses": "status",
        "priorities": "priority", "types": "type", "requesters": "requester_login",
        "updaters": "last_updater_login",
    }
    chain = gt.enriched(t.tickets, t.users, t.codes, t.run_ts)
    return chain.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(n) for n, c in names.items()])


# --- aggregations ---
@check("a_01_global", "SELECT count(*) AS tickets, min(created_ts) AS first_ts, max(created_ts) AS last_ts FROM tk")
def _(t):
    return t.tickets.agg(
        F.count(F.lit(1)).alias("tickets"),
        F.min("created_ts").alias("first_ts"),
        F.max("created_ts").alias("last_ts"),
    )


@check("a_02_grouped_count", "SELECT status_code, count(*) AS ticket_count FROM tk GROUP BY 1")
def _(t):
    return counted(t.tickets, "status_code")


@check("a_03_conditional_count", f"""SELECT site, count(*) FILTER (WHERE {norm("occupancy_status")} = 'loué') AS leased
    FROM rm GROUP BY site""")
def _(t):
    leased = facility.has_status(F.col("occupancy_status"), exactly=facility.LEASED)
    return t.rooms.groupBy("site").agg(F.count_if(leased).alias("leased"))


@check("a_04_count_distinct", """SELECT count(DISTINCT reservation_item_id) AS distinct_items,
    count(DISTINCT user_id) AS distinct_users FROM rsv""")
def _(t):
    return t.reservation_versions.agg(
        F.countDistinct("reservation_item_id").alias("distinct_items"),
        F.countDistinct("user_id").alias("distinct_users"),
    )


@check("a_05_conditional_sum", f"SELECT group_id, reserved_hours FROM (SELECT group_id, {HOUR_AGGS} FROM rsv GROUP BY 1)")
def _(t):
    kpis = t.reservation_versions.groupBy("group_id").agg(*gr.hour_aggs())
    return kpis.select("group_id", gr.hour_columns()["reserved_hours"].alias("reserved_hours"))


@check("a_06_conditional_mean", f"SELECT group_id, reservations, avg_duration_hours FROM (SELECT group_id, count(*) AS reservations, {HOUR_AGGS} FROM rsv GROUP BY 1)")
def _(t):
    kpis = t.reservation_versions.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("reservations"), *gr.hour_aggs()
    )
    mean = gr.hour_columns()["avg_duration_hours"].alias("avg_duration_hours")
    return kpis.select("group_id", "reservations", mean)


@check("a_07_max", "SELECT max(CAST(ts AS DATE)) AS newest FROM events")
def _(t):
    return t.event_days.agg(F.max("ingestion_date").alias("newest"))


@check("a_08_sum_avg", f"""SELECT site, {fixed_sum("area_m2")} AS total_area_m2,
    CAST(sum(total_capacity) AS BIGINT) AS total_capacity,
    {fixed_sum("area_m2")} / nullif(count(area_m2), 0) AS avg_area_m2 FROM rm GROUP BY site""")
def _(t):
    return t.rooms.groupBy("site").agg(
        numbers.exact_sum(F.col("area_m2")).alias("total_area_m2"),
        F.sum("total_capacity").alias("total_capacity"),
        numbers.exact_avg(F.col("area_m2")).alias("avg_area_m2"),
    )


@check("a_09_guarded_ratio", """SELECT site, CASE WHEN coalesce(sum(total_capacity), 0) <> 0
      THEN CAST(sum(employee_count) AS DOUBLE) / CAST(sum(total_capacity) AS DOUBLE) END AS null_guarded,
    CASE WHEN coalesce(sum(total_capacity), 0) = 0 THEN 0.0::DOUBLE
      ELSE CAST(sum(employee_count) AS DOUBLE) / CAST(sum(total_capacity) AS DOUBLE) END AS zero_guarded FROM rc GROUP BY site""")
def _(t):
    sums = room_mart(t).groupBy("site").agg(
        F.sum("employee_count").alias("_people"), F.sum("total_capacity").alias("_seats")
    )
    people, seats = F.col("_people"), F.col("_seats")
    return sums.select(
        "site",
        numbers.ratio(people, seats).alias("null_guarded"),
        numbers.ratio(people, seats, 0.0).alias("zero_guarded"),
    )


@check("a_10_period_rollup", "SELECT * FROM n_requester")
def _(t):
    return period_rollup(t.tickets, "created_ts", ["requester_user_id"])


@check("a_11_share", "SELECT period, category_id, ticket_count, total_tickets, share FROM m_category")
def _(t):
    return with_share(period_rollup(t.tickets, "created_ts", ["category_id"]))


@check("a_12_histogram", """SELECT CASE WHEN duration_hours < 1 THEN '<1h' WHEN duration_hours < 2 THEN '1-2h'
    WHEN duration_hours < 4 THEN '2-4h' WHEN duration_hours < 8 THEN '4-8h' WHEN duration_hours IS NOT NULL THEN '>8h' END AS bucket,
    count(*) AS rows FROM rsv GROUP BY 1""")
def _(t):
    bucket = bucketize(F.col("duration_hours"), gr.BUCKET_EDGES, gr.BUCKET_LABELS)
    return counted(t.reservation_versions, bucket.alias("bucket"), name="rows")


@check("a_13_multi_key", """SELECT entity_id, type_code, status_code, priority_code, is_deleted, count(*) AS ticket_count
    FROM tk GROUP BY 1, 2, 3, 4, 5""")
def _(t):
    return counted(t.tickets, "entity_id", "type_code", "status_code", "priority_code", "is_deleted")


@check("a_14_distinct_audit", """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys,
    CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM (SELECT count(*) AS n FROM rsv GROUP BY reservation_id)""")
def _(t):
    return key_report(t.reservation_versions, "reservation_id")


# --- window ---
@check("w_01_latest", "SELECT * FROM rs")
def _(t):
    return t.typed_reservations


# --- sorts and limits ---
@check("s_01_sorted_mart", "SELECT * FROM m_month ORDER BY period")
def _(t):
    return unstamped(gt.by_month(t.tickets)).orderBy("period")


@check("s_02_null_order", """SELECT ticket_id, created_ts FROM tk
    ORDER BY created_ts DESC NULLS FIRST, ticket_id LIMIT 500""")
def _(t):
    rows = t.tickets.select("ticket_id", "created_ts")
    return top_k(rows, [desc("created_ts"), asc("ticket_id")])


@check("s_03_top_k", """SELECT reservation_id, start_ts FROM rs ORDER BY start_ts DESC NULLS FIRST,
    reservation_id DESC LIMIT 100""")
def _(t):
    rows = t.reservations.select("reservation_id", "start_ts")
    return top_k(rows, [desc("start_ts"), desc("reservation_id")], 100)


@check("s_04_bounded_list", "SELECT room_nk, site, floor, room FROM rc ORDER BY site NULLS LAST, floor NULLS LAST, room, room_nk LIMIT 500")
def _(t):
    rows = room_mart(t).select("room_nk", "site", "floor", "room")
    return top_k(rows, [asc("site"), asc("floor"), asc("room"), asc("room_nk")])


@check("s_05_client_top_k", """SELECT category_id, ticket_count FROM n_category WHERE period = 'ALL'
    ORDER BY ticket_count DESC, category_id LIMIT 4""")
def _(t):
    rows = period_rollup(t.tickets, "created_ts", ["category_id"]).where("period = 'ALL'")
    return top_k(rows, [desc("ticket_count"), asc("category_id")], 4).drop("period")


@check("s_06_page", """SELECT ticket_id, title, created_ts FROM tk ORDER BY created_ts DESC NULLS FIRST, ticket_id
    LIMIT 50 OFFSET 100""")
def _(t):
    rows = t.tickets.select("ticket_id", "title", "created_ts")
    return page(rows, "ticket_id", 3, 50, "created_ts", "desc")


@check("s_06_seek", """SELECT ticket_id, title, created_ts FROM tk ORDER BY created_ts DESC NULLS FIRST, ticket_id
    LIMIT 50 OFFSET 350""")
def _(t):
    rows, last = t.tickets.select("ticket_id", "title", "created_ts"), None
    for _page in range(7):  # past the rows without creation time
        seen = page_after(rows, "ticket_id", last, 50, "created_ts", "desc").collect()
        last = (seen[-1].created_ts, seen[-1].ticket_id) if seen else last
    return page_after(rows, "ticket_id", last, 50, "created_ts", "desc")


@check("s_07_sample_per_location", """SELECT ticket_id, request_type_id, location_id, type_code, category_id, priority_code, status_code
    FROM tk QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY ticket_id) = 1""")
def _(t):
    return gt.sample_per_location(t.tickets)


# --- set operations ---
@check("so_01_union_by_name", "SELECT * FROM n_status")
def _(t):
    dated = t.tickets.where(F.col("created_ts").isNotNull())
    monthly = counted(dated, F.date_format("created_ts", "yyyy-MM").alias("period"), "status_code")
    return counted(t.tickets, "status_code").withColumn("period", F.lit("ALL")).unionByName(monthly)


@check("so_02_distinct", "SELECT DISTINCT user_id, reservation_item_id FROM rsv")
def _(t):
    return t.reservation_versions.select("user_id", "reservation_item_id").distinct()


@check("so_02_drop_duplicates", """SELECT user_id, max(_ingest_bronze_ts) AS newest FROM rsv GROUP BY user_id""")
def _(t):
    rows = t.reservation_versions.select("user_id", F.col("_ingest_bronze_ts").alias("newest"))
    return latest_per_key(rows, ["user_id"], ["newest"])


@check("so_03_difference", """SELECT DISTINCT CAST(ts AS DATE) AS day FROM events
    EXCEPT SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE event_type = 'error' AND value > 200""")
def _(t):
    days = t.event_days.select(F.col("ingestion_date").alias("day"))
    seen = t.event_days.where("event_type = 'error' AND value > 200")
    return days.subtract(seen.select(F.col("ingestion_date").alias("day")))


@check("so_04_pivot", """SELECT type_code, coalesce(count(*) FILTER (WHERE priority_code = 6), 0) AS major,
    coalesce(count(*) FILTER (WHERE priority_code = 2), 0) AS low,
    count(*) FILTER (WHERE priority_code IS NULL OR priority_code NOT IN (2, 6)) AS other,
    count(*) AS row_total FROM tk GROUP BY 1""")
def _(t):
    counts = counted(t.tickets, "type_code", "priority_code")
    return pivot_sum(counts, ["type_code"], "priority_code", {6: "major", 2: "low"}, "ticket_count")

