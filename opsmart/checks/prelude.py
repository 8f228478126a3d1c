"""The bindings and marts as SQL, and the assembly of a query with what it needs."""

from __future__ import annotations

import re
from collections.abc import Mapping

STAMP = "2024-02-01 00:00:00+00"
TS = "TIMESTAMP '2024-02-01 00:00:00'"
DAY = "DATE '2024-01-31'"


def number_text(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) NOT IN ('', '-', 'null') THEN replace(trim({c}), ',', '.') END"


def whole(c: str, kind: str = "INTEGER") -> str:
    return rf"try_cast(regexp_replace({number_text(c)}, '\.[0-9]*$', '') AS {kind})"


def real(c: str) -> str:
    return f"try_cast({number_text(c)} AS DOUBLE)"


def missing(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) IN ('', '-'))"


def norm(c: str) -> str:
    return f"lower(trim({c}))"


def fixed_sum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(28,10))) AS DOUBLE)"


def capital(c: str) -> str:
    return f"(upper(left({c}, 1)) || lower(substr({c}, 2)))"


# The labels of the ticket codes, written out here apart from those under test.
LABELS = {
    "ticket_status": """
        (1, 'New'), (2, 'In progress (Assigned)'), (3, 'In progress (Planned)'), (4, 'Pending'), (5, 'Solved'),
        (6, 'Closed')""",
    "ticket_priority": """
        (2, 'Low'), (3, 'Medium'), (4, 'High'), (5, 'Very high'), (6, 'Major')""",
    "ticket_type": """
        (1, 'Incident'), (2, 'Request')""",
    "ticket_category": """
        (0, NULL), (1, 'IT and Support'), (2, 'Maintenance'), (3, 'Security'), (4, 'Purchasing'), (5, 'Event'),
        (6, 'Finishing & decoration'), (7, 'Room rental'), (8, 'Electricity'), (9, 'Inventory'),
        (10, 'Daily preventive check'), (11, 'Client sales'), (12, 'Preventive'), (13, 'Hygiene'),
        (14, 'Equipment rental'), (15, 'Plumbing'), (16, 'Fluids'), (17, 'External event'), (18, 'Data analysis'),
        (19, 'External intervention')""",
    "ticket_location": """
        (0, NULL), (1, 'Medianet'), (2, 'Site'), (3, 'Externe de Site'), (4, 'Saphir Consult'),
        (6, '9ème - Coworking'), (7, 'Cilié'), (8, 'Medianet Ennaser'), (9, 'Express FM'), (11, 'Cochef'),
        (12, '1er étage'), (13, 'Salle Avant Première'), (14, 'Salle COSY'), (15, 'Salle de Stock'),
        (16, '9éme étage'), (17, 'Grand Terrasse'), (18, 'Hors Site'), (19, 'Salle 13'),
        (20, 'Salle Confidentielle'), (21, 'Salle 11'), (22, 'Salle 12'), (23, 'Dépôt-Principale'),
        (25, 'Dépôt-Technique'), (26, 'LT'), (27, 'Studio')""",
}


def codes(table: str, key: str, label: str) -> str:
    values = " ".join(LABELS[table].split())
    return f"SELECT CAST({key} AS BIGINT) AS {key}, CAST({label} AS VARCHAR) AS {label} FROM (VALUES {values}) AS v({key}, {label})"


def window_label(hour: str) -> str:
    return (
        f"(lpad(CAST({hour} AS VARCHAR), 2, '0') || ':00-' || "
        f"lpad(CAST(({hour} + 2) % 24 AS VARCHAR), 2, '0') || ':00')"
    )


def hours(start: str, end: str) -> str:
    return f"CASE WHEN {end} >= {start} THEN date_diff('second', {start}, {end}) / 3600.0::DOUBLE END"


def rollup(
    keys: str, aggs: str = "count(*) AS ticket_count", null_period: bool = False, table: str = "tk"
) -> str:
    """Both grains of a ticket mart, written as two aggregations."""
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    also = f", {keys}" if keys else ""
    where = "" if null_period else "WHERE created_ts IS NOT NULL"
    return f"""
        SELECT 'ALL' AS period, {lead}{aggs} FROM {table} {group}
        UNION ALL
        SELECT strftime(created_ts, '%Y-%m') AS period, {lead}{aggs} FROM {table} {where}
        GROUP BY strftime(created_ts, '%Y-%m'){also}"""


def shared(name: str) -> str:
    """Counts with the total and share of their period."""
    return f"""SELECT c.*, t.total_tickets, c.ticket_count / t.total_tickets::DOUBLE AS share
        FROM {name} c JOIN (SELECT period, CAST(sum(ticket_count) AS BIGINT) AS total_tickets
                            FROM {name} GROUP BY period) t USING (period)"""


_VALID = "(NOT is_invalid_duration AND duration_hours IS NOT NULL AND duration_hours >= 0)"
_SECONDS = f"CASE WHEN {_VALID} THEN date_diff('second', start_ts, end_ts) END"
HOUR_AGGS = f"""CAST(coalesce(sum({_SECONDS}), 0) AS DOUBLE) / 3600.0::DOUBLE AS reserved_hours,
    CAST(sum({_SECONDS}) AS DOUBLE) / 3600.0::DOUBLE / nullif(count({_SECONDS}), 0) AS avg_duration_hours"""

CTES: dict[str, str] = {
    # --- code tables ---
    "c_status": codes("ticket_status", "status_code", "status"),
    "c_priority": codes("ticket_priority", "priority_code", "priority"),
    "c_type": codes("ticket_type", "type_code", "type"),
    "c_category": codes("ticket_category", "category_id", "category"),
    "c_location": codes("ticket_location", "location_id", "location"),
    # --- tickets ---
    "tk_base": """
        SELECT *, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + to_hours(o_orderkey % 24) END AS created_ts,
          CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_hours(o_orderkey * 37 % 2000 - 100) END AS solved_ts,
          CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0
                 THEN o_orderdate + to_hours(o_orderkey * 37 % 2000 - 100 + o_orderkey % 72)
               WHEN o_orderstatus = 'P' AND o_orderkey % 17 = 0 THEN o_orderdate + to_hours(5) END AS closed_ts,
          CAST(o_orderkey % 6 + 1 AS INTEGER) AS status_code,
          CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 7 - CAST(left(o_orderpriority, 1) AS INTEGER) END AS priority_code,
          CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS type_code,
          CAST(o_orderkey % 40 = 0 AS INTEGER) AS deleted,
          CASE WHEN o_orderkey % 61 <> 0 THEN o_orderkey * 7 % 1700 END AS last_updater_user_id
        FROM orders""",
    "tk": f"""
        SELECT o_orderkey AS ticket_id, o_orderkey % 3 AS entity_id, o_orderkey % 21 AS category_id,
          o_orderkey % 5 AS request_type_id, o_orderkey % 29 AS location_id,
          o_custkey AS requester_user_id, last_updater_user_id, 'Ticket ' || o_orderkey AS title,
          created_ts, o_orderdate + to_hours(o_orderkey % 72) AS updated_ts, solved_ts, closed_ts,
          status_code, priority_code, type_code, deleted AS is_deleted, {DAY} AS ingestion_date,
          'orders' AS _source_file, 'glpi' AS _source_system,
          o_orderdate + to_hours(o_orderkey % 72) AS _ingest_bronze_ts, {TS} AS _ingest_silver_ts
        FROM tk_base""",
    "tkb": """
        SELECT b.*, version, CAST(o_orderdate + to_hours(o_orderkey % 72 + version) AS TIMESTAMP) AS bronze_ts,
          CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate + to_hours(o_orderkey % 72 + version) END AS updated_ts,
          CASE WHEN o_orderkey % 23 = 0 THEN '  ' ELSE ' Ticket ' || o_orderkey || ' v' || version END AS raw_name,
          CASE WHEN o_orderkey % 13 = 0 THEN 'null' WHEN o_orderkey % 17 = 0 THEN status_code || ',5'
               WHEN o_orderkey % 19 = 0 THEN 'abc' ELSE ' ' || status_code || ' ' END AS raw_status,
          o_orderkey % 9 || '.7' AS raw_solve_delay, o_orderkey % 100 || ',25' AS raw_validation
        FROM (SELECT *, 0 AS version FROM tk_base UNION ALL
              SELECT *, 1 AS version FROM tk_base WHERE o_orderkey % 4 = 0) b""",
    "tks": f"""
        SELECT CASE WHEN o_orderkey % 487 <> 0 THEN o_orderkey END AS ticket_id, o_orderkey % 3 AS entity_id,
          o_orderkey % 21 AS category_id, o_orderkey % 5 AS request_type_id, o_orderkey % 29 AS location_id,
          o_custkey AS requester_user_id, last_updater_user_id, nullif(trim(raw_name), '') AS title,
          created_ts, updated_ts, solved_ts, closed_ts, {whole("raw_status")} AS status_code,
          priority_code, type_code, deleted AS is_deleted, {DAY} AS ingestion_date,
          'orders' AS _source_file, 'glpi' AS _source_system, bronze_ts AS _ingest_bronze_ts,
          {TS} AS _ingest_silver_ts, {whole("raw_solve_delay")} AS solve_delay_sec,
          {real("raw_validation")} AS validation_percent, o_orderkey % 4 AS slas_id_ttr
        FROM tkb QUALIFY row_number() OVER (PARTITION BY o_orderkey, CASE WHEN o_orderkey % 487 = 0 THEN version END
          ORDER BY updated_ts DESC NULLS LAST, bronze_ts DESC NULLS LAST) = 1""",
    "tkm": f"""
        SELECT CASE WHEN o_orderkey % 487 <> 0 THEN o_orderkey END AS ticket_id, nullif(trim(raw_name), '') AS title,
          CASE WHEN version = 1 AND o_orderkey % 8 = 0 THEN created_ts + INTERVAL 40 DAY ELSE created_ts END AS created_ts,
          updated_ts, solved_ts, closed_ts, {whole("raw_status")} AS status_code, priority_code,
          o_orderkey % 21 AS category_id, o_orderkey % 29 AS location_id, o_custkey AS requester_user_id,
          last_updater_user_id, CAST(DATE '2024-01-29' + CAST((o_orderkey + version) % 3 AS INTEGER) AS DATE) AS ingestion_date
        FROM tkb QUALIFY row_number() OVER (PARTITION BY o_orderkey, CASE WHEN o_orderkey % 487 = 0 THEN version END
          ORDER BY updated_ts DESC NULLS LAST, (o_orderkey + version) % 3 DESC) = 1""",
    # --- users ---
    "us_base": """
        SELECT c_custkey, CASE WHEN c_custkey % 15 = 0 THEN '' WHEN c_custkey % 10 = 0 THEN 'admin' || c_custkey
            WHEN c_custkey % 7 = 0 THEN lower(c_mktsegment) || '.b' || c_custkey || '.c@x.y'
            WHEN c_custkey % 23 = 0 THEN 'user' || c_custkey || '.'
            WHEN c_custkey % 29 = 0 THEN '.doe' || c_custkey
            ELSE lower(c_mktsegment) || '.customer' || c_custkey || '@x.y' END AS raw_login
        FROM customer""",
    "us_named": f"""
        SELECT c_custkey, raw_login, user_name, first_name, last_name,
          coalesce(upper(last_name) || ' ' || {capital("first_name")}, {capital("first_name")}) AS full_name
        FROM (SELECT *, string_split(split_part(user_name, '@', 1), '.')[1] AS first_name,
                string_split(split_part(user_name, '@', 1), '.')[2] AS last_name
              FROM (SELECT *, nullif(trim(raw_login), '') AS user_name FROM us_base))""",
    "us": "SELECT c_custkey AS user_id, user_name, full_name FROM us_named",
    "uss": f"""
        SELECT CASE WHEN c_custkey % 499 <> 0 THEN c_custkey END AS user_id, user_name, first_name, last_name,
          full_name, CAST((c_custkey + version) % 2 AS INTEGER) AS is_active,
          CASE WHEN c_custkey % 31 <> 0 THEN 0 END AS is_deleted, 0 AS is_deleted_ldap,
          TIMESTAMP '2024-01-01 08:00:00' AS created_ts,
          CASE WHEN c_custkey % 9 <> 0 THEN TIMESTAMP '2024-01-01 08:00:00' + to_hours(c_custkey % 100 + version) END AS updated_ts,
          TIMESTAMP '2024-01-01 08:00:00' + to_hours(c_custkey % 500) AS last_login_ts, {DAY} AS ingestion_date,
          'customer' AS _source_file, 'glpi' AS _source_system,
          TIMESTAMP '2024-01-01 08:00:00' + to_hours(version) AS _ingest_bronze_ts, {TS} AS _ingest_silver_ts
        FROM (SELECT *, 0 AS version FROM us_named UNION ALL
              SELECT *, 1 AS version FROM us_named WHERE c_custkey % 3 = 0)
        QUALIFY row_number() OVER (PARTITION BY user_id, CASE WHEN user_id IS NULL THEN 2 * c_custkey + version END
          ORDER BY updated_ts DESC NULLS LAST,
          _ingest_bronze_ts DESC NULLS LAST, user_name DESC NULLS LAST, first_name DESC NULLS LAST,
          last_name DESC NULLS LAST, full_name DESC NULLS LAST, is_active DESC NULLS LAST) = 1""",
    # --- items ---
    "it_base": """
        SELECT *, CASE WHEN p_partkey % 37 = 0 THEN NULL
            WHEN p_partkey % 6 = 0 THEN p_name || ' (S-' || p_size || ')'
            WHEN p_partkey % 6 = 1 THEN p_name || '  (S' || p_size || ')'
            WHEN p_partkey % 6 = 2 THEN replace(p_name, ' ', '–') || ' (s ' || p_size || ') '
            WHEN p_partkey % 6 = 3 THEN replace(p_name, ' ', '-') || ' room'
            WHEN p_partkey % 6 = 4 THEN '  ' || p_name ELSE '(S' || p_size || ')' END AS raw_name
        FROM part""",
    "it_tidy": r"""
        SELECT * EXCLUDE (plain), regexp_replace(regexp_replace(plain, '(\w)-(\w)', '\1 \2', 'g'), '(\w)-(\w)', '\1 \2', 'g') AS tidy
        FROM (SELECT *, translate(regexp_replace(trim(raw_name), '\s+', ' ', 'g'), '–—−', '---') AS plain
              FROM it_base)""",
    "it_named": r"""
        SELECT * EXCLUDE (tidy, room), trim(regexp_replace(CASE WHEN room <> ''
            THEN trim(regexp_replace(tidy, '\s*\([^)]+\)\s*$', '')) || ' - Salle ' || room ELSE tidy END,
            '\s+', ' ', 'g')) AS item_name
        FROM (SELECT *, regexp_extract(upper(tidy), '\(\s*S\s*-?\s*(\d+)\s*\)\s*$', 1) AS room FROM it_tidy)""",
    "it": "SELECT p_partkey AS reservation_item_id, item_name AS reservation_item_name FROM it_named",
    "its": f"""
        SELECT p_partkey AS reservation_item_id, item_name AS reservation_item_name, p_type AS itemtype,
          p_partkey % 2 = 1 AS is_active, CASE WHEN p_partkey % 43 <> 0 THEN FALSE END AS is_deleted,
          p_partkey % 3 = 1 AS is_recursive, {DAY} AS ingestion_date, 'part' AS _source_file,
          'glpi' AS _source_system, TIMESTAMP '2024-01-31 06:00:00' AS _ingest_bronze_ts, {TS} AS _ingest_silver_ts
        FROM it_named WHERE p_partkey % 211 <> 0""",
    # --- reservations ---
    "rsv_base": """
        SELECT *, l_shipdate + to_minutes(l_orderkey % 24 * 60 + l_partkey % 60) AS opened FROM lineitem""",
    "rsv_times": """
        SELECT l_orderkey * 10 + l_linenumber AS reservation_id,
          CASE WHEN l_partkey % 101 <> 0 THEN l_suppkey END AS user_id,
          CASE WHEN l_partkey % 103 <> 0 THEN l_partkey + 1 END AS reservation_item_id,
          CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS BIGINT) END AS group_id,
          CASE WHEN l_partkey % 89 <> 0 THEN opened END AS start_ts,
          CASE WHEN l_partkey % 83 <> 0 THEN opened + to_minutes((CAST(l_quantity AS BIGINT) - 5) * 30) END AS end_ts,
          CASE WHEN l_returnflag <> 'N' THEN l_returnflag || l_linestatus END AS comment,
          l_shipdate + to_seconds(l_partkey) AS _ingest_bronze_ts
        FROM rsv_base""",
    "rsv": f"""
        SELECT reservation_id, user_id, reservation_item_id, group_id, start_ts, end_ts,
          {hours("start_ts", "end_ts")} AS duration_hours, coalesce(end_ts < start_ts, FALSE) AS is_invalid_duration,
          comment, {DAY} AS ingestion_date, 'lineitem' AS _source_file, 'glpi' AS _source_system,
          _ingest_bronze_ts, {TS} AS _ingest_silver_ts
        FROM rsv_times""",
    "rs": """
        SELECT * FROM rsv QUALIFY row_number() OVER (PARTITION BY reservation_id ORDER BY
          _ingest_bronze_ts DESC NULLS LAST, start_ts DESC NULLS LAST, end_ts DESC NULLS LAST,
          user_id DESC NULLS LAST, reservation_item_id DESC NULLS LAST) = 1""",
    "rss": """
        SELECT * EXCLUDE (n) REPLACE (CASE WHEN reservation_id % 97 <> 0 THEN reservation_id END AS reservation_id)
        FROM (SELECT *, row_number() OVER (PARTITION BY reservation_id ORDER BY _ingest_bronze_ts DESC NULLS LAST,
                start_ts DESC NULLS LAST, end_ts DESC NULLS LAST, user_id DESC NULLS LAST,
                reservation_item_id DESC NULLS LAST) AS n FROM rsv)
        WHERE n = 1 OR reservation_id % 97 = 0""",
    # --- rooms ---
    "rmb": """
        SELECT CASE WHEN p_partkey % 53 = 0 THEN '-' ELSE ' ' || p_brand || ' ' END AS viilage,
          CASE WHEN p_partkey % 5 = 4 THEN p_type WHEN p_partkey % 59 = 0 THEN NULL
               ELSE ['1èr étage', '2ème', '9ème Étage', 'RDC Nord', 'x'][CAST(p_partkey % 5 + 1 AS INTEGER)] END AS etage,
          CASE WHEN p_partkey % 41 = 0 THEN NULL
               WHEN p_partkey % 7 < 3 THEN 'Salle 2' || lpad(CAST(p_size AS VARCHAR), 2, '0')
               WHEN p_partkey % 7 = 3 THEN 'Open Space ' || p_size || 'b' WHEN p_partkey % 7 = 4 THEN 'La Grande terrasse '
               WHEN p_partkey % 7 = 5 THEN 'tesrrasse C' ELSE 'Bureau ' || p_name END AS salle,
          ['Loué', 'Non loué', 'Réservation', 'Par personne', '-', ' LOUÉ '][CAST(p_partkey % 6 + 1 AS INTEGER)] AS etat,
          CASE WHEN p_partkey % 8 = 0 THEN '-' ELSE p_name END AS nom_de_lorganisation,
          CASE WHEN p_partkey % 6 = 0 THEN 'CoStorage, Nord' WHEN p_partkey % 6 = 1 THEN '' WHEN p_partkey % 6 = 2 THEN '-'
               ELSE p_type END AS type_de_lorganisation,
          CASE WHEN p_partkey % 4 = 0 THEN '-' ELSE p_type END AS type_de_lespace,
          CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE 'says "' || p_name || '",' || chr(10) || 'then' END AS activite,
          CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN '-'
               WHEN p_partkey % 13 = 0 THEN p_partkey % 60 || ',5' ELSE CAST(p_partkey % 60 AS VARCHAR) END AS nb_employes,
          CASE WHEN p_partkey % 31 = 0 THEN '0' WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS capacite_totale,
          CASE WHEN p_partkey % 43 = 0 THEN '0' WHEN p_partkey % 47 = 0 THEN NULL
               ELSE replace(CAST(p_retailprice AS VARCHAR), '.', ',') END AS surface_m2
        FROM part""",
    "rm": f"""
        SELECT *, CASE WHEN total_capacity <> 0 THEN coalesce(employee_count, 0) / total_capacity::DOUBLE * 100.0::DOUBLE END AS occupancy_rate_pct,
          {DAY} AS _ingestion_date, 'part' AS _source_file, 'drive_csv' AS _source_system,
          'space_repartition' AS _entity, {TS} AS _ingest_ts, {TS} AS _silver_ts
        FROM (SELECT CASE WHEN {missing("viilage")} THEN NULL ELSE {norm("viilage")} END AS site,
          CASE WHEN {norm("etage")} LIKE '1èr%' THEN 'premier étage' WHEN {norm("etage")} LIKE '2ème%' THEN 'deuxième étage'
               WHEN {norm("etage")} LIKE '9ème%' THEN 'neuvième étage' WHEN {norm("etage")} LIKE 'rdc%' THEN 'rez de chaussée'
               ELSE {norm("etage")} END AS floor,
          CASE WHEN regexp_matches({norm("salle")}, '(0[1-9]|1[0-9]|2[0-4])$') THEN 'salle ' || right({norm("salle")}, 2)
               WHEN {norm("salle")} LIKE '%open space%' THEN 'open space' WHEN {norm("salle")} LIKE '%grande terrasse%' THEN 'grande terrasse'
               WHEN {norm("salle")} LIKE '%petite terrasse%' THEN 'petite terrasse' WHEN {norm("salle")} LIKE '%tesrrasse c%' THEN 'terrasse'
               ELSE {norm("salle")} END AS room,
          {norm("etat")} AS occupancy_status,
          CASE WHEN {missing("nom_de_lorganisation")} THEN 'n/a' ELSE {norm("nom_de_lorganisation")} END AS organization_name,
          CASE WHEN {norm("type_de_lorganisation")} LIKE '%costorage%' THEN 'costorage'
               WHEN {missing("type_de_lorganisation")} THEN 'n/a' ELSE {norm("type_de_lorganisation")} END AS organization_type,
          CASE WHEN {missing("type_de_lespace")} THEN {norm("etat")} ELSE {norm("type_de_lespace")} END AS space_type,
          CASE WHEN {missing("activite")} THEN 'n/a' ELSE {norm("activite")} END AS activity,
          {whole("nb_employes")} AS employee_count, {whole("capacite_totale")} AS total_capacity, {real("surface_m2")} AS area_m2
          FROM rmb WHERE salle IS NOT NULL)""",
    "rc": """
        SELECT room_nk, site, floor, room, occupancy_status, organization_name, organization_type, space_type, activity,
          employee_count, total_capacity, area_m2, occupancy_rate_pct,
          CASE WHEN area_m2 > 0 THEN coalesce(employee_count, 0) / area_m2 * 100.0::DOUBLE END AS density_emp_per_100m2,
          employee_count > total_capacity AS is_over_capacity, _ingestion_date, _source_file, _source_system, _entity
        FROM (SELECT *, coalesce(lower(trim(site)), '∅') || '|' || coalesce(lower(trim(floor)), '∅') || '|' || lower(trim(room)) AS room_nk FROM rm)
        QUALIFY row_number() OVER (PARTITION BY room_nk ORDER BY occupancy_status DESC NULLS LAST,
          organization_name DESC NULLS LAST, organization_type DESC NULLS LAST, space_type DESC NULLS LAST,
          activity DESC NULLS LAST, employee_count DESC NULLS LAST, total_capacity DESC NULLS LAST,
          area_m2 DESC NULLS LAST, occupancy_rate_pct DESC NULLS LAST) = 1""",
    # --- marts ---
    "te": f"""
        SELECT ticket_id, title, t.category_id, category, t.location_id, location, requester_user_id,
          q.user_name AS requester_login, q.full_name AS requester_full_name, last_updater_user_id,
          u.user_name AS last_updater_login, u.full_name AS last_updater_full_name, t.type_code, type,
          t.status_code, status, CAST(solved_ts IS NULL AND closed_ts IS NULL AS INTEGER) AS is_open, is_deleted,
          t.priority_code, priority, created_ts, updated_ts, solved_ts, closed_ts,
          {hours("created_ts", "solved_ts")} AS time_to_solve_hours, {hours("created_ts", "closed_ts")} AS time_to_close_hours,
          _source_file, _source_system, ingestion_date, _ingest_bronze_ts, _ingest_silver_ts, {TS} AS _ingest_gold_ts
        FROM tk t LEFT JOIN c_status s ON t.status_code = s.status_code
          LEFT JOIN c_priority p ON t.priority_code = p.priority_code LEFT JOIN c_type y ON t.type_code = y.type_code
          LEFT JOIN c_category c ON t.category_id = c.category_id LEFT JOIN c_location l ON t.location_id = l.location_id
          LEFT JOIN us q ON q.user_id = requester_user_id LEFT JOIN us u ON u.user_id = last_updater_user_id""",
    "re": f"""
        SELECT reservation_id, r.user_id, user_name AS user_login, full_name AS user_full_name, r.reservation_item_id,
          reservation_item_name, group_id, start_ts, end_ts, duration_hours, is_invalid_duration, comment,
          CAST(start_ts AS DATE) AS start_date, strftime(start_ts, '%Y-%m') AS start_month,
          CAST(year(start_ts) AS INTEGER) AS start_year, CAST(hour(start_ts) AS INTEGER) AS start_hour,
          {window_label("hour(start_ts)")} AS start_hour_2h_window, ingestion_date, _source_file, _source_system,
          _ingest_bronze_ts, _ingest_silver_ts, {TS} AS _ingest_gold_ts
        FROM rs r LEFT JOIN us u ON r.user_id = u.user_id LEFT JOIN it i ON r.reservation_item_id = i.reservation_item_id""",
    "m_cards": rollup(
        "",
        """count(*) AS total_tickets,
        count(*) FILTER (WHERE solved_ts IS NULL AND closed_ts IS NULL) AS is_open,
        count(*) FILTER (WHERE solved_ts IS NOT NULL OR closed_ts IS NOT NULL) AS is_resolved,
        count(DISTINCT last_updater_user_id) AS technicians,
        count(*) FILTER (WHERE solved_ts IS NULL AND closed_ts IS NULL) / count(*)::DOUBLE AS open_rate""",
        null_period=True,
    ),
    "n_status": rollup("status_code"),
    "m_status": "SELECT n.*, status FROM n_status n LEFT JOIN c_status USING (status_code)",
    "n_priority": rollup("priority_code"),
    "m_priority": "SELECT n.*, priority FROM n_priority n LEFT JOIN c_priority USING (priority_code)",
    "n_category": rollup("category_id"),
    "m_category": f"SELECT n.*, category FROM ({shared('n_category')}) n LEFT JOIN c_category USING (category_id)",
    "n_location": rollup("location_id"),
    "m_location": f"SELECT n.*, location FROM ({shared('n_location')}) n LEFT JOIN c_location USING (location_id)",
    "m_year": """SELECT CAST(year(created_ts) AS INTEGER) AS year, count(*) AS ticket_count FROM tk
        WHERE created_ts IS NOT NULL GROUP BY year(created_ts)""",
    "m_month": """SELECT strftime(created_ts, '%Y-%m') AS period, count(*) AS ticket_count FROM tk
        WHERE created_ts IS NOT NULL GROUP BY 1""",
    "n_technician": rollup("last_updater_user_id"),
    "m_technician": """SELECT n.*, full_name AS last_updater_full_name FROM n_technician n
        LEFT JOIN us ON user_id = last_updater_user_id""",
    "n_load": rollup("last_updater_user_id, priority_code"),
    "m_load": """SELECT n.*, full_name AS last_updater_full_name, priority FROM n_load n
        LEFT JOIN us ON user_id = last_updater_user_id LEFT JOIN c_priority USING (priority_code)""",
    "n_requester": rollup("requester_user_id"),
    "m_requester": """SELECT n.*, user_name AS requester_login, full_name AS requester_full_name FROM n_requester n
        LEFT JOIN us ON user_id = requester_user_id""",
    "r_cards": f"""SELECT count(*) AS total_reservations, {HOUR_AGGS},
        count(*) FILTER (WHERE is_invalid_duration) AS invalid_duration_count,
        count(DISTINCT reservation_item_id) AS distinct_items, count(DISTINCT user_id) AS distinct_users FROM rs""",
    "r_peak": f"""SELECT {window_label("hour(start_ts)")} AS start_hour_2h_window, count(*) AS reservations_count
        FROM rs WHERE start_ts IS NOT NULL GROUP BY 1""",
    "r_trends": f"""SELECT strftime(start_ts, '%Y-%m') AS start_month, count(*) AS reservations_count, {HOUR_AGGS},
        count(*) FILTER (WHERE is_invalid_duration) AS invalid_duration_count
        FROM rs WHERE start_ts IS NOT NULL GROUP BY 1""",
    "r_item": f"""SELECT n.*, reservation_item_name FROM (SELECT reservation_item_id, count(*) AS reservations_count,
        {HOUR_AGGS} FROM rs GROUP BY 1) n LEFT JOIN it USING (reservation_item_id)""",
    "r_user": f"""SELECT n.*, user_name AS user_login, full_name AS user_full_name FROM (SELECT user_id,
        count(*) AS reservations_count, {HOUR_AGGS} FROM rs GROUP BY 1) n LEFT JOIN us USING (user_id)""",
    "r_duration": f"""SELECT CASE WHEN duration_hours < 1 THEN '<1h' WHEN duration_hours < 2 THEN '1-2h'
        WHEN duration_hours < 4 THEN '2-4h' WHEN duration_hours < 8 THEN '4-8h' ELSE '>8h' END AS duration_bucket,
        count(*) AS reservations_count FROM rs WHERE {_VALID} GROUP BY 1""",
    "s_global": f"""SELECT count(DISTINCT site) AS villages_count, count(*) AS total_spaces,
        {fixed_sum("area_m2")} AS total_area_m2, CAST(sum(total_capacity) AS BIGINT) AS total_capacity,
        CAST(sum(employee_count) AS BIGINT) AS total_employees,
        count(*) FILTER (WHERE {norm("occupancy_status")} = 'loué') AS leased_spaces,
        count(*) FILTER (WHERE {norm("occupancy_status")} = 'non loué') AS non_leased_spaces,
        count(*) FILTER (WHERE {norm("occupancy_status")} LIKE '%réser%') AS reservation_spaces,
        count(*) FILTER (WHERE {norm("occupancy_status")} LIKE '%personne%') AS per_person_spaces,
        count(*) FILTER (WHERE occupancy_rate_pct < 40) AS underutilized_spaces_lt_40pct,
        count(*) FILTER (WHERE occupancy_rate_pct > 100) AS overoccupied_spaces_gt_100pct,
        {fixed_sum("density_emp_per_100m2")} / nullif(count(density_emp_per_100m2), 0) AS avg_density_emp_per_100m2,
        CASE WHEN sum(total_capacity) <> 0 THEN CAST(sum(employee_count) AS DOUBLE) / CAST(sum(total_capacity) AS DOUBLE) * 100.0::DOUBLE END
          AS weighted_occupancy_rate_pct FROM rc""",
    "s_site": f"""SELECT site, count(*) AS total_spaces,
        {fixed_sum("area_m2")} AS total_area_m2, CAST(sum(total_capacity) AS BIGINT) AS total_capacity,
        CAST(sum(employee_count) AS BIGINT) AS total_employees,
        count(*) FILTER (WHERE {norm("occupancy_status")} = 'loué') AS leased_spaces,
        count(*) FILTER (WHERE {norm("occupancy_status")} = 'non loué') AS non_leased_spaces,
        count(*) FILTER (WHERE occupancy_rate_pct < 40) AS underutilized_spaces_lt_40pct,
        count(*) FILTER (WHERE occupancy_rate_pct > 100) AS overoccupied_spaces_gt_100pct,
        {fixed_sum("density_emp_per_100m2")} / nullif(count(density_emp_per_100m2), 0) AS avg_density_emp_per_100m2,
        CASE WHEN sum(total_capacity) <> 0 THEN CAST(sum(employee_count) AS DOUBLE) / CAST(sum(total_capacity) AS DOUBLE) * 100.0::DOUBLE END
          AS weighted_occupancy_rate_pct FROM rc GROUP BY site""",
    "s_space_type": f"""SELECT site, space_type, count(*) AS spaces_count, {fixed_sum("area_m2")} AS sum_area_m2,
        CAST(sum(total_capacity) AS BIGINT) AS sum_capacity, CAST(sum(employee_count) AS BIGINT) AS sum_employees
        FROM rc GROUP BY site, space_type""",
    "s_org_type": f"""SELECT site, organization_type, count(*) AS spaces_count, {fixed_sum("area_m2")} AS sum_area_m2,
        CAST(sum(total_capacity) AS BIGINT) AS sum_capacity, CAST(sum(employee_count) AS BIGINT) AS sum_employees
        FROM rc GROUP BY site, organization_type""",
    "ev": "SELECT *, CAST(ts AS DATE) AS ingestion_date FROM events",
}


#: The marts' inputs as the silver builders make them of the exports.
BUILT = {
    "tk": "SELECT * FROM tks",
    "us": "SELECT user_id, user_name, full_name FROM uss",
    "it": "SELECT reservation_item_id, reservation_item_name FROM its",
    "rs": "SELECT * FROM rss",
}


def complete(sql: str, instead: Mapping[str, str] | None = None) -> str:
    """Prefix a query with the definitions it uses, each after those it needs itself; ``instead``
    replaces some of them."""
    known = CTES | dict(instead or {})
    placed: dict[str, str] = {}

    def need(text: str) -> None:
        for name in re.findall(r"\b[a-z]+(?:_[a-z]+)*\b", text):
            if name in known and name not in placed:
                need(known[name])
                placed[name] = known[name].strip()

    need(sql)
    parts = [f"{name} AS ({text})" for name, text in placed.items()]
    return f"WITH {', '.join(parts)} {sql.strip()}" if parts else sql.strip()
