"""DuckDB text for each registered query, over the same tables."""

from __future__ import annotations

from ..schemas import ISO_BY_COUNTRY

ISO_ROWS = ", ".join(f"('{country}', '{iso}')" for country, iso in ISO_BY_COUNTRY.items())

# Shared pieces; a query lists the ones it needs, in order of dependence.
PIECES = {
    "tx": """
        SELECT event_id,
               '00000000-0000-0000-0000-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS operation_id,
               user_id - 5 AS account_number_from,
               CAST(json_extract_string(props, '$.k') AS BIGINT) - 3 AS account_number_to,
               CAST(410 + 10 * (user_id % 7) AS INTEGER) AS currency_code,
               CASE user_id % 7 WHEN 0 THEN 'russia' WHEN 1 THEN 'usa' WHEN 2 THEN 'italy' WHEN 3 THEN 'china'
                    WHEN 4 THEN 'england' WHEN 5 THEN 'turkey'
                    ELSE CASE WHEN user_id % 2 = 0 THEN 'lemuria' ELSE 'atlantis' END END AS country,
               CASE event_type WHEN 'signup' THEN 'queued' WHEN 'error' THEN 'blocked' ELSE 'done' END AS status,
               event_type AS transaction_type,
               CAST(round(value * 100) AS BIGINT) * (CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END) AS amount,
               date_trunc('millisecond', ts) AS transaction_dt
        FROM events""",
    "stg_tx": """
        SELECT *, 0 AS delivery FROM tx
        UNION ALL
        SELECT *, 1 AS delivery FROM tx WHERE event_id % 10 = 0""",
    "days": "SELECT DISTINCT CAST(ts AS DATE) AS d FROM events",
    "stg_fx": """
        SELECT CAST(d AS TIMESTAMP) AS date_update, CAST(410 + 10 * n_nationkey AS INTEGER) AS currency_code,
               CAST(target AS INTEGER) AS currency_code_with,
               CAST(0.25 + 0.125 * n_nationkey AS DECIMAL(18,8)) AS currency_with_div,
               date_diff('day', DATE '2024-01-01', d) * 16 + n_nationkey * 2 + (CASE target WHEN 430 THEN 1 ELSE 0 END)
                   AS slot
        FROM days, nation, (VALUES (420), (430)) AS targets(target)
        WHERE n_nationkey < 7 AND n_nationkey <> 1 AND NOT (n_nationkey = 6 AND day(d) % 2 = 0)
        UNION ALL
        SELECT CAST(d AS TIMESTAMP) + INTERVAL 12 HOUR, 460, 420, CAST(0.9 AS DECIMAL(18,8)),
               date_diff('day', DATE '2024-01-01', d) * 16 + 14
        FROM days WHERE day(d) % 10 = 0""",
    "rec": """
        SELECT 'events' AS kafka_topic,
               CAST(CASE delivery WHEN 1 THEN 4 ELSE event_id % 3 END AS INTEGER) AS kafka_partition,
               CAST(CASE delivery WHEN 1 THEN event_id // 10 ELSE event_id // 3 END AS BIGINT) AS kafka_offset,
               '{"object_type":"TRANSACTION","payload":{"operation_id":"' || operation_id
                   || '","account_number_from":' || account_number_from || ',"account_number_to":' || account_number_to
                   || ',"currency_code":' || currency_code || ',"country":"' || country || '","status":"' || status
                   || '","transaction_type":"' || transaction_type || '","amount":' || amount
                   || ',"transaction_dt":"' || strftime(transaction_dt, '%Y-%m-%d %H:%M:%S.%g') || '"}}' AS kafka_message,
               transaction_dt AS moment, transaction_type
        FROM stg_tx
        UNION ALL
        SELECT 'events', 3, CAST(slot AS BIGINT),
               '{"object_type":"CURRENCY","payload":{"date_update":"' || strftime(date_update, '%Y-%m-%d %H:%M:%S.%g')
                   || '","currency_code":' || currency_code || ',"currency_code_with":' || currency_code_with
                   || ',"currency_with_div":' || currency_with_div || '}}',
               date_update, NULL
        FROM stg_fx""",
    "clean": """
        SELECT DISTINCT operation_id, account_number_from, account_number_to, currency_code, country, status,
               transaction_type, amount, transaction_dt, CAST(transaction_dt AS DATE) AS p_date
        FROM stg_tx WHERE account_number_from >= 0 AND account_number_to >= 0""",
    "fx": """
        SELECT DISTINCT CAST(date_update AS DATE) AS rate_date, currency_code AS currency_from,
               currency_code_with AS currency_to, currency_with_div AS currency_rate
        FROM stg_fx""",
    "usd": """
        SELECT DISTINCT rate_date, currency_from, currency_rate FROM fx WHERE currency_to = 420
        UNION ALL
        SELECT d, 420, CAST(1 AS DECIMAL(18,8)) FROM days""",
    "agg": """
        SELECT p_date AS date_update, currency_code AS currency_from,
               CAST(sum(abs(amount)) AS BIGINT) AS minor_units, count(*) AS cnt_transactions,
               count(DISTINCT account_number_from) AS cnt_accounts_make_transactions
        FROM clean WHERE status = 'done' GROUP BY 1, 2""",
    "mart": """
        SELECT date_update, currency_from,
               CAST(round(CAST(minor_units AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(2,2)) * currency_rate, 2)
                    AS DECIMAL(18,2)) AS amount_total,
               cnt_transactions,
               CASE WHEN cnt_accounts_make_transactions = 0 THEN 0.0
                    ELSE CAST(cnt_transactions AS DOUBLE) / cnt_accounts_make_transactions END
                   AS avg_transactions_per_account,
               cnt_accounts_make_transactions
        FROM agg JOIN usd USING (currency_from) WHERE usd.rate_date = agg.date_update""",
    "dim": """
        SELECT DISTINCT currency_code, country, coalesce(iso, 'UNKNOWN') AS currency_iso_code
        FROM (SELECT *, min(p_date) OVER (PARTITION BY currency_code) AS opened FROM clean)
        LEFT JOIN iso USING (country)
        WHERE p_date = opened""",
    "iso": f"SELECT * FROM (VALUES {ISO_ROWS}) AS codes(country, iso)",
    "cal": """
        SELECT d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month
        FROM days""",
    "spine": """
        SELECT date AS date_update, year, quarter, month, currency_code AS currency_from, currency_iso_code, country
        FROM cal, dim
        WHERE date BETWEEN (SELECT min(date_update) FROM mart) AND (SELECT max(date_update) FROM mart)""",
    "view_rows": """
        SELECT s.*, CAST(CAST(coalesce(m.amount_total, 0) AS DECIMAL(18,2)) AS VARCHAR) AS amount_total,
               coalesce(m.cnt_transactions, 0) AS cnt_transactions,
               coalesce(m.avg_transactions_per_account, 0.0) AS avg_transactions_per_account,
               coalesce(m.cnt_accounts_make_transactions, 0) AS cnt_accounts_make_transactions
        FROM spine s LEFT JOIN mart m USING (date_update, currency_from)""",
    "marks": """
        SELECT kafka_topic, kafka_partition, max(kafka_offset) AS high_watermark FROM rec GROUP BY 1, 2""",
    "read_before": """
        SELECT kafka_topic, kafka_partition, max(kafka_offset) AS cursor FROM rec
        WHERE moment < TIMESTAMP '2024-01-16' GROUP BY 1, 2""",
}

NEEDS = {
    "tx": [], "stg_tx": ["tx"], "days": [], "stg_fx": ["days"], "rec": ["stg_tx", "stg_fx"], "clean": ["stg_tx"],
    "fx": ["stg_fx"], "usd": ["fx", "days"], "agg": ["clean"], "mart": ["agg", "usd"], "iso": [], "dim": ["clean", "iso"],
    "cal": ["days"], "spine": ["cal", "dim", "mart"], "view_rows": ["spine", "mart"], "marks": ["rec"],
    "read_before": ["rec"],
}

TX_COLUMNS = (
    "operation_id, account_number_from, account_number_to, currency_code, country, status, transaction_type, "
    "amount, transaction_dt"
)
MART_COLUMNS = (
    "date_update, currency_from, CAST(amount_total AS VARCHAR) AS amount_total, cnt_transactions, "
    "avg_transactions_per_account, cnt_accounts_make_transactions"
)
FX_COLUMNS = "rate_date, currency_from, currency_to, CAST(currency_rate AS VARCHAR) AS currency_rate"
# Runs of 100 offsets, 40,000 apart; of three one was delivered before, one half, one not.
IN_RUNS = """
        , runs AS (
            SELECT *, kafka_offset // 100 * 40000 + kafka_offset % 100 AS o,
                   kafka_offset // 100 % 3 = 0 OR kafka_offset // 100 % 3 = 1 AND kafka_offset % 100 < 50 AS delivered
            FROM rec)"""
ISLANDS = """
        , islands AS (
            SELECT *, kafka_offset - row_number() OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY kafka_offset) AS island
            FROM held)"""
PER_PARTITION = (
    "SELECT CAST(kafka_partition AS BIGINT) AS kafka_partition, count(*) AS stored_rows, "
    "CAST(sum(kafka_offset) AS BIGINT) AS offset_sum"
)


def _text(pieces: list[str], body: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for below in NEEDS[name]:
            visit(below)
        if name not in ordered:
            ordered.append(name)

    for name in pieces:
        visit(name)
    head = ",\n".join(f"{name} AS ({PIECES[name]})" for name in ordered)
    return f"WITH {head}\n{body}" if ordered else body


def _dashboard(by: str, where: str = "TRUE") -> str:
    """Totals overall (``by`` empty) or per mart key, of the mart rows that ``where`` names."""
    key, group, join = (f"{by}, ", f"GROUP BY {by}", f"JOIN u USING ({by})") if by else ("", "", ", u")
    chosen = f"{by}, " if by else ""
    return f"""
        , picked AS (SELECT * FROM mart WHERE {where}),
        behind AS (
            SELECT p_date AS date_update, currency_code AS currency_from, account_number_from
            FROM clean c WHERE status = 'done' AND EXISTS (
                SELECT 1 FROM picked m WHERE m.date_update = c.p_date AND m.currency_from = c.currency_code)),
        u AS (SELECT {key}count(*) AS cnt_transactions, count(DISTINCT account_number_from) AS unique_users
              FROM behind {group}),
        v AS (SELECT {key}CAST(sum(amount_total) AS VARCHAR) AS amount_total FROM picked {group})
        SELECT {chosen}amount_total, cnt_transactions, unique_users,
               CAST(cnt_transactions AS DOUBLE) / unique_users AS avg_transactions_per_user
        FROM v {join}"""


# The view over the days that are ready, all but the last.
BUILT_VIEW = """
        , ready_dim AS (
            SELECT DISTINCT currency_code, country, coalesce(iso, 'UNKNOWN') AS currency_iso_code
            FROM (SELECT *, min(p_date) OVER (PARTITION BY currency_code) AS opened FROM clean
                  WHERE p_date < (SELECT max(d) FROM days))
            LEFT JOIN iso USING (country)
            WHERE p_date = opened),
        built AS (SELECT * FROM mart WHERE date_update < (SELECT max(d) FROM days))
        SELECT date AS date_update, year, quarter, month, currency_code AS currency_from, currency_iso_code, country,
               CAST(CAST(coalesce(amount_total, 0) AS DECIMAL(18,2)) AS VARCHAR) AS amount_total,
               coalesce(cnt_transactions, 0) AS cnt_transactions,
               coalesce(avg_transactions_per_account, 0.0) AS avg_transactions_per_account,
               coalesce(cnt_accounts_make_transactions, 0) AS cnt_accounts_make_transactions
        FROM cal CROSS JOIN ready_dim LEFT JOIN built ON built.date_update = date AND built.currency_from = currency_code
        WHERE date BETWEEN (SELECT min(date_update) FROM built) AND (SELECT max(date_update) FROM built)"""

SQL: dict[str, str] = {
    "raw_project": _text(["rec"], "SELECT kafka_topic, kafka_partition, kafka_offset, kafka_message FROM rec"),
    "raw_range_scan": _text(["rec"], """
        , r AS (SELECT kafka_topic, kafka_partition, min(kafka_offset) AS lo, max(kafka_offset) AS hi FROM rec
                WHERE moment >= TIMESTAMP '2024-01-16' GROUP BY 1, 2)
        SELECT kafka_topic, kafka_partition, kafka_offset * 40000 AS kafka_offset FROM rec JOIN r USING (kafka_topic, kafka_partition)
        WHERE kafka_offset BETWEEN lo AND hi"""),
    "raw_dedup": _text(["rec"], """
        SELECT kafka_topic, kafka_partition, kafka_offset, kafka_message FROM rec
        WHERE moment >= TIMESTAMP '2024-01-16'"""),
    "raw_batch_stats": _text(["rec"], """
        SELECT kafka_topic, kafka_partition, 2 * count(*) AS received,
               count(*) FILTER (moment >= TIMESTAMP '2024-01-16') AS saved,
               CAST(0 AS BIGINT) AS unreadable,
               2 * count(*) - count(*) FILTER (moment >= TIMESTAMP '2024-01-16') AS duplicates
        FROM rec GROUP BY 1, 2"""),
    "raw_append": _text(["rec"], """
        SELECT kafka_topic, CAST(kafka_partition AS BIGINT) AS kafka_partition, kafka_offset, kafka_message FROM rec"""),
    "raw_land": _text(["rec"], f"""
        {PER_PARTITION},
               (SELECT count(*) FROM rec WHERE moment < TIMESTAMP '2024-01-16') AS saved_first,
               (SELECT count(*) FROM rec WHERE moment >= TIMESTAMP '2024-01-16') AS saved_second,
               (SELECT 2 * count(*) - count(*) FILTER (moment >= TIMESTAMP '2024-01-16') FROM rec) AS duplicates_second
        FROM rec GROUP BY rec.kafka_partition"""),
    "raw_replay_noop": _text(["rec"], f"""
        {PER_PARTITION}, max(kafka_offset) AS stored_before, min(kafka_offset) AS earliest, max(kafka_offset) AS latest,
               (SELECT count(*) FROM rec) AS replay_received, CAST(0 AS BIGINT) AS replay_saved
        FROM rec GROUP BY rec.kafka_partition"""),
    "raw_ranges": _text(["rec"], f"""
        , held AS (
            SELECT DISTINCT kafka_topic, kafka_partition, kafka_offset FROM rec
            WHERE moment < TIMESTAMP '2024-01-16' OR kafka_offset % 50 < 40)
        {ISLANDS}
        SELECT kafka_topic, kafka_partition, min(kafka_offset) AS first, max(kafka_offset) AS last
        FROM islands GROUP BY kafka_topic, kafka_partition, island"""),
    "raw_holes": _text(["rec"], f"""
        {IN_RUNS}
        , held AS (SELECT DISTINCT kafka_topic, kafka_partition, o AS kafka_offset FROM runs WHERE delivered)
        , steps AS (
            SELECT *, lead(kafka_offset) OVER (PARTITION BY kafka_topic, kafka_partition ORDER BY kafka_offset) AS next FROM held)
        SELECT kafka_topic, kafka_partition, kafka_offset + 1 AS first, next - 1 AS last, next - kafka_offset - 1 AS missing
        FROM steps WHERE next > kafka_offset + 1"""),
    "raw_cells": _text(["rec"], f"""
        {IN_RUNS}
        , placed AS (
            SELECT *, o - dense_rank() OVER (PARTITION BY kafka_topic, kafka_partition, o // 32768 ORDER BY o) AS island FROM runs)
        , cells AS (
            SELECT kafka_topic, kafka_partition, o // 32768 AS cell, min(o) AS first, max(o) AS last, count(*) AS received
            FROM placed GROUP BY kafka_topic, kafka_partition, o // 32768, island)
        , met AS (
            SELECT c.*, (SELECT count(DISTINCT o) FROM runs r WHERE r.kafka_partition = c.kafka_partition AND delivered
                         AND r.o BETWEEN c.first AND c.last) AS held FROM cells c)
        SELECT kafka_topic, kafka_partition, cell, first, last, received,
               CASE held WHEN last - first + 1 THEN 'known' WHEN 0 THEN 'new' ELSE 'mixed' END AS status
        FROM met"""),
    "raw_gap_landing": _text(["rec"], f"""
        {IN_RUNS}
        , single AS (SELECT DISTINCT kafka_partition, o, delivered FROM runs)
        SELECT CAST(kafka_partition AS BIGINT) AS kafka_partition, count(*) AS stored_rows, CAST(sum(o) AS BIGINT) AS offset_sum,
               (SELECT count(*) FROM single WHERE delivered) AS saved_first,
               (SELECT count(*) FROM single WHERE NOT delivered) AS saved_second,
               (SELECT count(*) + count(*) FILTER (o % 7 = 0) FROM runs) - (SELECT count(*) FROM single WHERE NOT delivered)
                   AS duplicates_second
        FROM single GROUP BY kafka_partition"""),
    "raw_compacted": _text(["rec"], """
        SELECT CAST(kafka_partition AS BIGINT) AS kafka_partition, CAST(1 AS BIGINT) AS files, count(*) AS stored_rows,
               CAST(0 AS BIGINT) AS saved_again
        FROM rec GROUP BY kafka_partition"""),
    "raw_stream_land": _text(["rec"], f"""
        {PER_PARTITION}, (SELECT 4 * count(*) FROM rec) AS received, (SELECT count(*) FROM rec) AS saved,
               (SELECT 3 * count(*) FROM rec) AS duplicates
        FROM rec GROUP BY rec.kafka_partition"""),
    "raw_unreadable": _text(["rec"], """
        , void AS (SELECT *, transaction_type IS NOT DISTINCT FROM 'signup' AS empty FROM rec)
        SELECT CAST(kafka_partition AS BIGINT) AS kafka_partition, count(*) FILTER (NOT empty) AS stored_rows,
               CAST(sum(kafka_offset) FILTER (NOT empty) AS BIGINT) AS offset_sum,
               nullif(count(*) FILTER (empty), 0) AS rejected_rows,
               CAST(sum(kafka_offset) FILTER (empty) AS BIGINT) AS rejected_offsets,
               (SELECT 2 * count(*) FROM void) AS received, (SELECT count(*) FROM void WHERE NOT empty) AS saved,
               (SELECT count(*) FROM void WHERE NOT empty) AS duplicates
        FROM void GROUP BY void.kafka_partition"""),
    "route_by_type": _text(["rec"], """
        SELECT kafka_partition, CASE WHEN transaction_type IS NULL THEN 'currency' WHEN transaction_type = 'error' THEN 'none'
                                     ELSE 'transaction' END AS route,
               count(*) AS messages
        FROM rec GROUP BY 1, 2"""),
    "parse_transactions": _text(["stg_tx"], f"SELECT {TX_COLUMNS}, false AS had_missing FROM stg_tx"),
    "parse_currencies": _text(["stg_fx"], """
        SELECT date_update, currency_code, currency_code_with, CAST(currency_with_div AS VARCHAR) AS currency_with_div,
               false AS had_missing
        FROM stg_fx"""),
    "staged_flagged": _text(["stg_tx"], """
        SELECT CASE WHEN transaction_type = 'signup' THEN 0 ELSE currency_code END AS currency_code,
               transaction_type = 'signup' AS had_missing, count(*) AS staged_rows
        FROM stg_tx GROUP BY 1, 2"""),
    "parse_timestamps": """
        SELECT event_id, CASE WHEN event_id % 10 = 5 THEN date_trunc('second', ts)
                              WHEN event_id % 10 < 5 THEN date_trunc('millisecond', ts) END AS parsed
        FROM events""",
    "quarantine": _text(["rec"], """
        SELECT kafka_topic, kafka_partition, kafka_offset, 'transaction_dt' AS reject_reason
        FROM rec WHERE transaction_type IN ('error', 'signup')"""),
    "staging_stream": _text(["stg_tx"], """
        SELECT currency_code, status, count(*) AS staged_rows, CAST(sum(amount) AS BIGINT) AS amount_sum,
               max(transaction_dt) AS latest
        FROM stg_tx GROUP BY 1, 2"""),
    "high_watermark": _text(["marks"], "SELECT * FROM marks"),
    "top1_offset": _text(["rec"], """
        SELECT kafka_topic, kafka_partition, kafka_offset FROM rec
        ORDER BY kafka_offset DESC, kafka_topic, kafka_partition LIMIT 1"""),
    "offset_window": _text(["marks", "read_before"], """
        , w AS (SELECT kafka_topic, kafka_partition, high_watermark, coalesce(cursor, -1) AS offset_from,
                       greatest(coalesce(cursor, -1), least(coalesce(cursor, -1) + 1000, high_watermark)) AS offset_to
                FROM marks LEFT JOIN read_before USING (kafka_topic, kafka_partition))
        SELECT w.*, offset_to > offset_from AS advanced,
               (SELECT count(*) FROM rec r WHERE r.kafka_topic = w.kafka_topic
                AND r.kafka_partition = w.kafka_partition
                AND r.kafka_offset > offset_from AND r.kafka_offset <= offset_to) AS rows_in_window
        FROM w"""),
    "offset_state_advance": _text(["marks", "read_before"], """
        SELECT 'stg.transactions' AS target, kafka_topic, kafka_partition,
               greatest(coalesce(cursor, -1), least(coalesce(cursor, -1) + 1000, high_watermark)) AS cursor
        FROM marks LEFT JOIN read_before USING (kafka_topic, kafka_partition)
        UNION ALL
        SELECT 'stg.currencies', kafka_topic, kafka_partition, least(999, high_watermark) FROM marks"""),
    "stg_latest_dates": _text(["stg_tx", "stg_fx"], """
        SELECT (SELECT CAST(max(transaction_dt) AS DATE) FROM stg_tx) AS latest_transaction_date,
               (SELECT CAST(max(date_update) AS DATE) FROM stg_fx) AS latest_rate_date"""),
    "day_ready": _text(["stg_tx", "stg_fx"], """
        , latest AS (SELECT (SELECT CAST(max(transaction_dt) AS DATE) FROM stg_tx) AS t,
                            (SELECT CAST(max(date_update) AS DATE) FROM stg_fx) AS r)
        SELECT d AS process_date, t AS latest_transaction_date, r AS latest_rate_date, t > d AND r > d AS ready
        FROM days, latest"""),
    "late_days": _text(["stg_tx"], """
        , loaded AS (SELECT CAST(transaction_dt AS DATE) AS process_date, date_trunc('hour',
                            transaction_dt + to_minutes(CAST(right(operation_id, 6) AS INTEGER) % 120)) AS committed
                     FROM stg_tx)
        SELECT process_date, count(DISTINCT committed) AS late_loads FROM loaded
        WHERE committed >= CAST(process_date AS TIMESTAMP) + INTERVAL 25 HOUR GROUP BY 1"""),
    "param_scan": _text(["stg_tx"], """
        SELECT operation_id, currency_code, status, amount, transaction_dt FROM stg_tx
        WHERE transaction_dt >= TIMESTAMP '2024-01-05' AND transaction_dt < TIMESTAMP '2024-01-21'"""),
    "day_slice": _text(["stg_tx"], f"""
        SELECT {TX_COLUMNS} FROM stg_tx
        WHERE transaction_dt >= TIMESTAMP '2024-01-05' AND transaction_dt < TIMESTAMP '2024-01-21'"""),
    "day_partition_counts": _text(["stg_tx", "stg_fx"], """
        , t AS (SELECT CAST(transaction_dt AS DATE) AS p_date, count(*) AS transactions FROM stg_tx GROUP BY 1),
        r AS (SELECT CAST(date_update AS DATE) AS p_date, count(*) AS rates FROM stg_fx GROUP BY 1)
        SELECT p_date, transactions, rates FROM t FULL JOIN r USING (p_date)"""),
    "partition_id": _text(["stg_tx"], """
        SELECT CAST(strftime(transaction_dt, '%Y%m%d') AS INTEGER) AS partition_id, count(*) AS staged_rows
        FROM stg_tx GROUP BY 1"""),
    "staging_catch_up": _text(["stg_tx", "stg_fx"], """
        , t AS (SELECT CAST(transaction_dt AS DATE) AS p_date, count(*) AS transactions,
                       CAST(sum(amount) AS BIGINT) AS amount_sum FROM stg_tx GROUP BY 1),
        r AS (SELECT CAST(date_update AS DATE) AS p_date, count(*) AS rates FROM stg_fx GROUP BY 1)
        SELECT p_date, transactions, amount_sum, rates FROM t FULL JOIN r USING (p_date)"""),
    "clustered_days": _text(["clean"], "SELECT * EXCLUDE (p_date) FROM clean"),
    "clean_transactions": _text(["clean"], f"SELECT {TX_COLUMNS}, p_date FROM clean"),
    "done_only": _text(["clean"], f"SELECT {TX_COLUMNS} FROM clean WHERE status = 'done'"),
    "rates_normalize": _text(["fx"], f"SELECT {FX_COLUMNS} FROM fx"),
    "usd_rates": _text(["fx"], """
        SELECT DISTINCT rate_date, currency_from, CAST(currency_rate AS VARCHAR) AS currency_rate
        FROM fx WHERE currency_to = 420"""),
    "rates_with_usd": _text(["usd"], """
        SELECT rate_date, currency_from, CAST(currency_rate AS VARCHAR) AS currency_rate FROM usd"""),
    "dim_currency_increment": _text(["dim"], "SELECT * FROM dim"),
    "dim_currency_known": _text(["dim", "fx"], """
        SELECT * FROM dim WHERE currency_code NOT IN (SELECT currency_from FROM fx)"""),
    "dim_currency_conflicts": _text(["dim"], """
        SELECT currency_code, count(*) AS row_count, min(country) AS first_country, max(country) AS last_country
        FROM dim GROUP BY 1 HAVING count(*) > 1"""),
    "calendar_generate": """
        SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month
        FROM (SELECT unnest(generate_series(CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP),
                                            CAST(CAST(max(o_orderdate) AS DATE) AS TIMESTAMP),
                                            INTERVAL 1 DAY)) AS d FROM orders)""",
    "calendar_increment": _text(["cal", "fx"], """
        SELECT * FROM cal WHERE date NOT IN (SELECT rate_date FROM fx WHERE currency_from = 470)"""),
    "transactions_agg": _text(["agg"], """
        SELECT date_update, currency_from, CAST(CAST(CAST(minor_units AS DECIMAL(18,0)) * 0.01 AS DECIMAL(22,2)) AS VARCHAR) AS amount_in_currency,
               cnt_transactions, cnt_accounts_make_transactions
        FROM agg"""),
    "global_metrics": _text(["mart"], f"SELECT {MART_COLUMNS} FROM mart"),
    "global_metrics_latest_rate": _text(["stg_fx", "agg", "days"], """
        , last AS (SELECT CAST(date_update AS DATE) AS rate_date, currency_code AS currency_from,
                          arg_max(currency_with_div, date_update) AS currency_rate
                   FROM stg_fx WHERE currency_code_with = 420 GROUP BY 1, 2
                   UNION ALL SELECT d, 420, CAST(1 AS DECIMAL(18,8)) FROM days)
        SELECT date_update, currency_from,
               CAST(CAST(round(CAST(minor_units AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(2,2)) * currency_rate, 2)
                         AS DECIMAL(18,2)) AS VARCHAR) AS amount_total,
               cnt_transactions, CAST(cnt_transactions AS DOUBLE) / cnt_accounts_make_transactions AS avg_transactions_per_account,
               cnt_accounts_make_transactions
        FROM agg JOIN last USING (currency_from) WHERE rate_date = date_update"""),
    "mart_date_bounds": _text(["mart"], """
        SELECT min(date_update) AS first_day, max(date_update) AS last_day FROM mart"""),
    "calendar_x_currency": _text(["spine"], "SELECT * FROM spine"),
    "gap_filled_view": _text(["view_rows"], "SELECT * FROM view_rows"),
    "dashboard_totals": _text(["clean", "mart"], _dashboard("")),
    "dashboard_by_currency": _text(["clean", "mart"], _dashboard("currency_from")),
    "users_by_currency": _text(["clean", "mart", "days"], _dashboard("currency_from", "date_update < (SELECT max(d) FROM days)")),
    "users_of_slice": _text(["clean", "mart", "days"], _dashboard("", """date_update < (SELECT max(d) FROM days)
            AND date_update BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND currency_from IN (420, 430, 460)""")),
    "incremental_turnover": _text(["clean"], """
        SELECT p_date AS date_update, currency_code AS currency_from, CAST(sum(abs(amount)) AS BIGINT) AS minor_units,
               count(*) AS cnt_transactions, count(DISTINCT account_number_from) AS cnt_accounts_make_transactions
        FROM clean WHERE status = 'done' AND CAST(right(operation_id, 12) AS BIGINT) % 7 <> 0 GROUP BY 1, 2"""),
    "incremental_mart": _text(["clean", "usd"], f"""
        , agg AS (
            SELECT p_date AS date_update, currency_code AS currency_from, CAST(sum(abs(amount)) AS BIGINT) AS minor_units,
                   count(*) AS cnt_transactions, count(DISTINCT account_number_from) AS cnt_accounts_make_transactions
            FROM clean WHERE status = 'done' AND CAST(right(operation_id, 12) AS BIGINT) % 7 <> 0 GROUP BY 1, 2)
        , mart AS ({PIECES["mart"]})
        SELECT {MART_COLUMNS} FROM mart"""),
    "dashboard_slice": _text(["view_rows"], """
        SELECT * FROM view_rows WHERE date_update BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
        AND currency_from IN (420, 430, 460)"""),
    "missing_usd_rates": _text(["clean", "fx"], """
        SELECT DISTINCT p_date AS process_date, currency_code AS currency_from FROM clean c
        WHERE status = 'done' AND currency_code <> 420 AND NOT EXISTS (
            SELECT 1 FROM fx WHERE fx.rate_date = c.p_date AND fx.currency_from = c.currency_code
            AND fx.currency_to = 420)"""),
    "ambiguous_rates": _text(["fx"], """
        SELECT rate_date, currency_from, count(*) AS rate_count,
               CAST(min(currency_rate) AS VARCHAR) AS lowest_rate, CAST(max(currency_rate) AS VARCHAR) AS highest_rate
        FROM fx WHERE currency_to = 420 GROUP BY 1, 2 HAVING count(*) > 1"""),
    "day_exists": _text(["clean", "fx"], """
        , span AS (SELECT CAST(unnest(generate_series(min(d) - INTERVAL 15 DAY, max(d) + INTERVAL 15 DAY,
                                                      INTERVAL 1 DAY)) AS DATE) AS process_date FROM days)
        SELECT process_date, process_date IN (SELECT p_date FROM clean) AS has_transactions,
               process_date IN (SELECT rate_date FROM fx) AS has_currencies
        FROM span"""),
    "quality_report": _text(["clean", "fx"], """
        , unrated AS (SELECT DISTINCT p_date, currency_code FROM clean c
                      WHERE status = 'done' AND currency_code <> 420 AND NOT EXISTS (
                          SELECT 1 FROM fx WHERE fx.rate_date = c.p_date AND fx.currency_from = c.currency_code
                          AND fx.currency_to = 420))
        SELECT d AS process_date, d IN (SELECT p_date FROM clean) AS has_transactions,
               d IN (SELECT rate_date FROM fx) AS has_currencies,
               (SELECT count(*) FROM unrated WHERE p_date = d) AS missing_rates
        FROM days"""),
    "backfill_range": _text(["mart"], f"SELECT {MART_COLUMNS} FROM mart WHERE date_update < (SELECT max(d) FROM days)"),
    "backfill_resumed": _text(["clean", "fx", "mart", "days"], """
        , unrated AS (
            SELECT DISTINCT p_date FROM clean c WHERE status = 'done' AND currency_code <> 420 AND NOT EXISTS (
                SELECT 1 FROM fx WHERE fx.rate_date = c.p_date AND fx.currency_from = c.currency_code AND fx.currency_to = 420))
        , ready AS (SELECT d FROM days WHERE d < (SELECT max(d) FROM days))
        SELECT d AS process_date, layer,
               CASE WHEN layer = 'cdm' AND d IN (SELECT p_date FROM unrated) THEN 'failed' ELSE 'built' END AS status,
               CAST(1 AS BIGINT) AS times, nullif((SELECT count(*) FROM mart WHERE date_update = d), 0) AS mart_rows
        FROM ready, (VALUES ('dds'), ('cdm')) AS layers(layer)"""),
    "backfill_missing_rates": _text(["clean", "fx", "days"], """
        SELECT DISTINCT p_date AS process_date, currency_code AS currency_from FROM clean c
        WHERE status = 'done' AND currency_code <> 420 AND p_date < (SELECT max(d) FROM days) AND NOT EXISTS (
            SELECT 1 FROM fx WHERE fx.rate_date = c.p_date AND fx.currency_from = c.currency_code
            AND fx.currency_to = 420)"""),
    "backfill_view": _text(["cal", "clean", "mart", "iso"], BUILT_VIEW),
    "view_between": _text(["cal", "clean", "mart", "iso"], f"""{BUILT_VIEW}
        AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND currency_code IN (420, 430, 460)"""),
}

for _key in ("partition_replace", "partition_replace_rerun"):
    SQL[_key] = _text(["clean"], f"""
        SELECT {TX_COLUMNS} FROM clean
        WHERE day(p_date) % 2 = 1 OR (status = 'done' AND day(p_date) % 10 <> 0)""")

# Four loads, three versions kept: the first load's odd days are listed by none.
SQL["replaced_files_cleaned"] = _text(["clean"], """
    SELECT p_date, count(*) AS stored_rows, CASE WHEN day(p_date) % 2 = 1 THEN 1 ELSE 0 END::BIGINT AS removed_folders, 0::BIGINT AS left_over
    FROM clean GROUP BY p_date""")
