"""The same queries in plain SQL for another engine, over the star-schema views.

Written from the definitions, independently of the DataFrame code, as a check on it.
"""

from __future__ import annotations

from riskstream.plans.transactions import CATEGORY_ROTA
from riskstream.schema import (
    ALERT_COPIED_COLUMNS, ALERT_SERVED_COLUMNS, ONE_HOT_CATEGORIES, TRAINING_CSV_SCHEMA,
    TRANSACTION_SCHEMA,
)

_ROTA = ",".join(f"'{c}'" for c in CATEGORY_ROTA)

TRANSACTIONS = f"""
select
  concat('T', lpad(cast(e.event_id as varchar), 10, '0')) as transaction_id,
  e.ts as transaction_time,
  e.value * 2 as amount,
  cast(floor(epoch(e.ts)) as bigint) as unix_time,
  cast(hour(e.ts) as int) as hour_of_day,
  concat('4000', lpad(cast(e.user_id as varchar), 12, '0')) as cc_num,
  concat('F', cast(c.c_custkey % 100 as varchar)) as first,
  c.c_name as last,
  case c.c_custkey % 4 when 0 then 'M' when 1 then 'F' when 2 then 'female' end as gender,
  case when c.c_custkey % 17 <> 1
       then cast(date '1950-01-01' + cast((c.c_custkey * 97) % 18000 as int) as varchar) end as dob,
  c.c_mktsegment as job,
  concat(cast(c.c_custkey as varchar), ' Main St') as street,
  concat('CITY_', cast(c.c_custkey % 50 as varchar)) as city,
  case when c.c_custkey % 31 = 1 then '' when c.c_custkey % 29 <> 1 then n.n_name end as state,
  lpad(cast(c.c_custkey as varchar), 5, '0') as zip,
  cast(25 + c.c_custkey % 25 as double) as lat,
  cast(-120 + c.c_custkey % 50 as double) as long,
  case when c.c_custkey % 13 <> 1 then cast((c.c_custkey * 37) % 5000 as int) end as city_pop,
  s.s_name as merchant,
  list_extract([{_ROTA}], 1 + cast(json_extract_string(e.props, '$.k') as int) % 14) as category,
  cast(25 + c.c_custkey % 25 as double) + ((e.event_id % 21) - 10) / 10.0 as merch_lat,
  cast(-120 + c.c_custkey % 50 as double) + ((e.event_id % 13) - 6) / 10.0 as merch_long,
  case when (e.value * 2 > 400 and cast(json_extract_string(e.props, '$.k') as int) >= 40)
         or (e.value * 2 > 200 and cast(json_extract_string(e.props, '$.k') as int) >= 85)
       then 1 else 0 end as is_fraud
from events e
left join customer c on e.user_id = c.c_custkey
left join nation n on c.c_nationkey = n.n_nationkey
left join supplier s on e.event_id % (select count(*) from supplier) = s.s_suppkey
"""

AGE = ("case when dob is not null then "
       "date_sub('year', cast(dob as date), date '2024-06-30') end")
DISTANCE = """round(2 * 6371 * asin(sqrt(least(1.0,
  pow(sin(radians(merch_lat - lat) / 2), 2)
  + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin(radians(merch_long - long) / 2), 2)))), 6)"""
FEATURE = {
    "amount_log": "round(ln(1 + amount), 6)",
    "is_high_value": "cast(amount > 100 as int)",
    "is_extreme_value": "cast(amount > 500 as int)",
    "age": AGE,
    "gender_encoded": "case lower(gender) when 'm' then 1 when 'male' then 1 "
                      "when 'f' then 0 when 'female' then 0 else -1 end",
    "hour_of_day": "cast(hour(transaction_time) as int)",
    "is_weekend": "cast(dayofweek(transaction_time) in (0, 6) as int)",
    "distance_customer_merchant": DISTANCE,
    "is_out_of_state": "0",
    "amt_to_pop_ratio": "case when city_pop > 0 then amount / city_pop else 0.0 end",
    "date": "strftime(transaction_time, '%Y-%m-%d')",
}
ONE_HOT = {f"cat_{c}": f"cast(coalesce(lower(category) = '{c}', false) as int)" for c in ONE_HOT_CATEGORIES}


def _columns(parts: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in parts.items())


_ALL = {"transaction_id": "transaction_id", "amount": "amount"} | FEATURE | ONE_HOT | {"category": "category"}
FEATURE_FRAME = f"select {_columns(_ALL)} from t"
DETECTED = "transaction_time + interval 3 second"
COPIED = ", ".join(ALERT_COPIED_COLUMNS)
ALERTS = f"select {COPIED}, cast(1 as double) as is_fraud, {DETECTED} as detected_at from t where amount > 100"
SERVED = ", ".join(ALERT_SERVED_COLUMNS)
NEWEST = "order by detected_at desc, transaction_time desc, transaction_id"
WIRE = ", ".join(TRANSACTION_SCHEMA.names)
ISO = ("case when date_trunc('second', transaction_time) = transaction_time "
       "then strftime(transaction_time, '%Y-%m-%dT%H:%M:%S') "
       "else strftime(transaction_time, '%Y-%m-%dT%H:%M:%S.%f') end")
_FILE_ALIAS = {"trans_num": "transaction_id", "trans_date_trans_time": ISO, "amt": "amount"}
REPLAY_FILE = ", ".join(f"{_FILE_ALIAS.get(c, c)} as {c}" for c in TRAINING_CSV_SCHEMA.names)
# The training file has every wire field except the hour.
TRAINING = ", ".join(c for c in TRANSACTION_SCHEMA.names if c != "hour_of_day")
HASH = "substr(md5('42:' || transaction_id), 1, 8)"
CONFUSION = """select
  count(*) filter (is_fraud = 1 and amount > 100) as tp,
  count(*) filter (is_fraud <> 1 and amount > 100) as fp,
  count(*) filter (is_fraud = 1 and amount <= 100) as fn,
  count(*) filter (is_fraud <> 1 and amount <= 100) as tn from t"""
RATES = """round(tp / nullif(tp + fp, 0), 6) as precision,
  round(tp / nullif(tp + fn, 0), 6) as recall,
  round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) as f1,
  round(fp / nullif(fp + tn, 0), 6) as fpr,
  round((tp + tn) / nullif(tp + fp + fn + tn, 0), 6) as accuracy"""
SPLITS = f""", values_of as (unpivot (select transaction_id, amount, cast(hour_of_day as double) as hour_of_day,
          cast(city_pop as double) as city_pop, lat, cast(unix_time as double) as unix_time from t)
        on amount, hour_of_day, city_pop, lat, unix_time into name feature value value),
  counted as (select feature, value, count(*) filter (is_fraud = 1) as pos, count(*) filter (is_fraud <> 1) as neg
        from values_of join t using (transaction_id) where {HASH} < 'cccccccc' group by feature, value),
  running as (select *, sum(pos) over w as lp, sum(neg) over w as ln, sum(pos) over a as ap, sum(neg) over a as an
        from counted window w as (partition by feature order by value), a as (partition by feature)),
  tried as (select feature, value as threshold, cast(ap + an as bigint) as n, cast(lp + ln as bigint) as n_left,
          cast(lp as bigint) as pos_left,
          round(((lp * lp + ln * ln) / cast(lp + ln as double) + ((ap - lp) * (ap - lp) + (an - ln) * (an - ln)) / cast(ap + an - lp - ln as double)
            - (ap * ap + an * an) / cast(ap + an as double)) / (ap + an), 9) as gain
        from running where lp + ln < ap + an),
  best as (select * from tried qualify row_number() over (partition by feature order by gain desc, threshold) = 1)"""
BY_CATEGORY = "select category, count(*) as n from a group by category"
BY_STATE = "select state, count(*) as n from a where state is not null and state <> '' group by state"
COMPLETE = "amount is not null and dob is not null and lat is not null and merch_lat is not null"

# Queries over `t` (transactions) and `a` (alerts).
_BODIES: dict[str, str] = {
    "feat_amount": f"select transaction_id, {FEATURE['amount_log']} as amount_log, "
                   f"{FEATURE['is_high_value']} as is_high_value, "
                   f"{FEATURE['is_extreme_value']} as is_extreme_value from t",
    "feat_age": f"select transaction_id, {AGE} as age from t",
    "feat_gender": f"select transaction_id, {FEATURE['gender_encoded']} as gender_encoded from t",
    "feat_temporal": f"select transaction_id, {FEATURE['hour_of_day']} as hour_of_day, "
                     f"{FEATURE['is_weekend']} as is_weekend from t",
    "feat_distance": f"select transaction_id, {DISTANCE} as distance_customer_merchant from t",
    "feat_constant": "select transaction_id, 0 as is_out_of_state from t",
    "feat_category_onehot": f"select transaction_id, {_columns(ONE_HOT)} from t",
    "feat_pop_ratio": f"select transaction_id, {FEATURE['amt_to_pop_ratio']} as amt_to_pop_ratio from t",
    "feat_date": f"select transaction_id, {FEATURE['date']} as date from t",
    "feat_night": "select transaction_id, "
                  "cast(hour(transaction_time) >= 22 or hour(transaction_time) < 6 as int) as is_night from t",
    "feat_cyclic": """select transaction_id,
        round(sin(2 * pi() * hour(transaction_time) / 24), 6) + 0.0 as hour_sin,
        round(cos(2 * pi() * hour(transaction_time) / 24), 6) + 0.0 as hour_cos,
        cast(dayofweek(transaction_time) + 1 as int) as day_of_week,
        cast(day(transaction_time) as int) as day_of_month from t""",
    "feat_interactions": f"""select transaction_id,
        case when age > 0 then amount / age else 0.0 end as amt_per_age,
        case when city_pop > 0 then amount / city_pop else 0.0 end as amt_per_city_pop,
        lat * long as lat_long_interaction,
        merch_lat * merch_long as merch_lat_long_interaction,
        hour(transaction_time) * amount as hour_amt_interaction,
        cast(age * city_pop as bigint) as age_city_pop_interaction
        from (select *, {AGE} as age from t)""",
    "feat_amount_bucket": "select transaction_id, case when amount > 500 then 'extreme' "
                          "when amount > 100 then 'high' when amount is not null then 'normal' end "
                          "as amount_category from t",
    "feat_category_risk": f""", train as (select * from t where {HASH} < 'cccccccc'),
        p as (select sum(is_fraud) / count(*) as prior from train),
        r as (select lower(category) as k, (sum(is_fraud) + 100 * any_value(prior)) / (count(*) + 100) as risk
              from train, p group by 1)
        select transaction_id, round(coalesce(risk, prior), 6) as category_risk_score,
               round(coalesce(risk, prior) * amount, 6) as risk_amount_interaction
        from t left join r on lower(category) = k, p""",
    "features_all": FEATURE_FRAME,
    "archive_stream": FEATURE_FRAME,
    "archive_scan": f"{FEATURE_FRAME} where transaction_time >= date '2024-01-10' "
                    "and transaction_time < date '2024-01-20'",
    "normalize_columns": "select transaction_id, transaction_time, amount from t",
    "drop_index_column": f"select {REPLAY_FILE} from t",
    "label_cast": """select transaction_id,
        case when state = '' then 'unknown' else cast(is_fraud as varchar) end as is_fraud,
        case when state = '' then null else is_fraud end as label from t""",
    "shape_record": f"select * replace ({ISO} as transaction_time) from t",
    "to_json_records": "select * from t",
    "stream_source": "select * from t",
    "shuffle_replay": "select * from t",
    "read_csv": f"select {TRAINING} from t",
    "csv_to_parquet": f"select {REPLAY_FILE} from t",
    "alert_projection": "select * from a",
    "alert_stream": "select * from a",
    "mask_card": """select transaction_id, case when gender is null or state = '' then 'N/A'
        else right(cc_num, 4) || '****' end as card from t""",
    "format_amount": """select transaction_id, format('${:,.2f}', amount) as amount,
        format('${:,.2f}', cast(unix_time as double)) as large from t""",
    "alerts_display": """select transaction_id as "ID", transaction_time as "Time",
        format('${:,.2f}', amount) as "Amount", merchant as "Merchant", category as "Category",
        first as "First Name", last as "Last Name", state as "State", city as "City" from a""",
    "alert_stats": """select count(*) as total_alerts, round(coalesce(sum(amount), 0), 2) as total_amount,
        round(coalesce(avg(amount), 0), 2) as avg_amount from a""",
    "alerts_by_category": BY_CATEGORY,
    "alerts_by_state": BY_STATE,
    "alert_stats_maps": f""", c as ({BY_CATEGORY}), s as ({BY_STATE})
        select concat('{{"total_alerts":', (select count(*) from a),
          ',"total_amount":', (select format('{{:.15g}}', round(sum(amount), 2)) from a),
          ',"avg_amount":', (select format('{{:.15g}}', round(avg(amount), 2)) from a),
          ',"by_category":{{', (select string_agg('"' || coalesce(category, 'null') || '":' || n, ','
                                                order by coalesce(category, 'null')) from c),
          '}},"by_state":{{', (select string_agg('"' || state || '":' || n, ',' order by state) from s),
          '}}}}') as stats""",
    "alert_count": "select count(*) as count from a",
    "distinct_categories": "select distinct category from a",
    "categories_ranked": f"{BY_CATEGORY} order by n desc, category",
    "top_states": f"{BY_STATE} order by n desc, state limit 10",
    "recent_alerts": f"select {SERVED} from a {NEWEST} limit 1000",
    "latest_alerts": f"select transaction_id, amount, category, merchant, detected_at from a {NEWEST} limit 10",
    "alerts_limit_then_filter": f"select {SERVED} from (select * from a {NEWEST} limit 500) "
                                "where category = 'grocery_pos'",
    "alerts_filter_then_limit": f"select {SERVED} from a where category = 'grocery_pos' {NEWEST} limit 500",
    "alerts_filter_state": f"select {SERVED} from a where category = 'travel' and state = 'NATION_7'",
    "amount_histogram": """, f as (select x from (select case when state = '' then cast('infinity' as double)
          when amount between 300 and 420 then null else amount end as x from a) where abs(x) < cast('infinity' as double)),
        b as (select min(x) as lo, max(x) as hi, (max(x) - min(x)) / 30 as least from f),
        w as (select lo, hi, case when least > 0 then case when p >= least then p when 2 * p >= least then 2 * p
            when 5 * p >= least then 5 * p else 10 * p end else 1.0 end as w
          from (select *, pow(10.0, floor(log10(least))) as p from b)),
        e as (select unnest(range(cast(floor(lo / w) as bigint), cast(floor(hi / w) as bigint) + 1)) as k, lo, w from w),
        c as (select cast(floor(x / w) as bigint) as k, count(*) as n from f, w group by 1)
        select cast(k - floor(lo / w) as int) as bin, round(k * w, 6) as bin_start, round((k + 1) * w, 6) as bin_end,
          coalesce(n, 0) as n from e left join c using (k)""",
    "dataset_profile": """select count(*) as n, cast(sum(is_fraud) as bigint) as fraud,
        round(avg(is_fraud), 6) as fraud_rate, cast(count(*) - sum(is_fraud) as bigint) as normal from t""",
    "split_counts": f"select case when {HASH} < 'cccccccc' then 'train' else 'test' end as split, "
                    "count(*) as n from t group by 1",
    "split_train_test": f"select transaction_id, case when {HASH} < 'cccccccc' then 'train' else 'test' end "
                        "as split from t",
    "sample_hash": f"select transaction_id, amount, is_fraud from t where {HASH} < '4ccccccc'",
    "batch_progress": """, m as (select date_diff('day', date '2024-01-01', cast(transaction_time as date)) as d,
          count(*) as n, count(*) filter (is_fraud = 1) as fraud, count(*) filter (amount > 100) as alerts,
          count(*) filter (is_fraud = 1 and amount > 100) as caught from t group by 1)
        select cast(d as int) as batch_id, n, fraud, alerts, caught,
          cast(sum(n) over w as bigint) as cum_n, cast(sum(fraud) over w as bigint) as cum_fraud,
          cast(sum(alerts) over w as bigint) as cum_alerts, cast(sum(caught) over w as bigint) as cum_caught,
          round(sum(fraud) over w / sum(n) over w * 100, 4) as cum_fraud_pct
        from m window w as (order by d)""",
    "alert_upsert": f"""select {COPIED.replace('amount', 'amount * case when amount > 250 then 2 else 1 end as amount')},
        cast(1 as double) as is_fraud,
        case when amount > 250 then timestamp '2024-02-05' else timestamp '2024-02-07' end as detected_at
        from t where amount > 100""",
    "alert_retention": f"""select {COPIED.replace('amount', 'amount * 2 as amount')},
        cast(1 as double) as is_fraud, timestamp '2024-02-05' as detected_at from t where amount > 250""",
    "dedup_transactions": """select transaction_id, transaction_time,
        case when amount > 100 then amount * 1.5 else amount end as amount, 1 as batch_id from t""",
    "quarantine_bad": """select transaction_id, null::varchar as raw_value, '' as missing from t
        union all select null, props, 'transaction_id,transaction_time,amount' from events""",
    "auc_roc": """, ranked as (select is_fraud, rank() over (order by amount)
            + (count(*) over (partition by amount) - 1) / 2.0 as r from t)
        select round((sum(r) filter (is_fraud = 1) - p * (p + 1) / 2) / (p * n), 6) as auc
        from ranked, (select cast(count(*) filter (is_fraud = 1) as double) as p,
                             cast(count(*) filter (is_fraud <> 1) as double) as n from t)
        group by p, n""",
    "confusion_matrix": CONFUSION,
    "classification_metrics": f"select *, {RATES} from ({CONFUSION})",
    "threshold_sweep": f"""select *, {RATES} from (select threshold,
          count(*) filter (is_fraud = 1 and amount / 1000 >= threshold) as tp,
          count(*) filter (is_fraud <> 1 and amount / 1000 >= threshold) as fp,
          count(*) filter (is_fraud = 1 and amount / 1000 < threshold) as fn,
          count(*) filter (is_fraud <> 1 and amount / 1000 < threshold) as tn
        from t, (select i / 10 as threshold from range(1, 10) x(i)) group by threshold)""",
    "string_index": """, c as (select category, row_number() over (order by count(*) desc, category) - 1 as i
            from t group by category)
        select transaction_id, category, cast(i as double) as category_idx from t join c using (category)""",
    "assemble_skip": f"select transaction_id, amount from t where {COMPLETE}",
    "model_roundtrip": "select count(*) as scored, cast(0 as bigint) as differing from t",
    "score_facts": "select category, count(*) as scored, cast(sum(is_fraud) as bigint) as positives from t group by category",
    "split_search": f"{SPLITS} select feature, threshold, n, n_left, pos_left, round(gain, 6) as gain from best",
    "stump_metrics": f"""{SPLITS}, top as (select * from best order by gain desc, feature limit 1),
        test as (select is_fraud, v.value from values_of v join t using (transaction_id), top
                 where v.feature = top.feature and {HASH} >= 'cccccccc'),
        sides as (select avg(is_fraud) filter (value <= threshold) as l, avg(is_fraud) filter (value > threshold) as r from test, top),
        judged as (select is_fraud, (value <= threshold) = (l >= r) as alert from test, top, sides)
        select *, {RATES} from (select count(*) filter (is_fraud = 1 and alert) as tp, count(*) filter (is_fraud <> 1 and alert) as fp,
          count(*) filter (is_fraud = 1 and not alert) as fn, count(*) filter (is_fraud <> 1 and not alert) as tn from judged)""",
    "model_facts": f"""select count(distinct k) as models, cast(sum(is_fraud) / count(distinct k) as bigint) as positives,
        cast(sum(1 - is_fraud) / count(distinct k) as bigint) as negatives
        from t, (values ('decision_tree'), ('random_forest_small')) m(k) where {HASH} >= 'cccccccc'""",
    "alerts_store_filtered": f"""select {SERVED} from (
        select {COPIED.replace('amount', 'amount * case when amount > 400 then 3 else 2 end as amount')}, cast(1 as double) as is_fraud,
          case when amount > 400 then timestamp '2024-02-08' else timestamp '2024-02-05' end as detected_at
        from t where amount > 250) where category = 'travel'""",
    "alert_purge_replay": f"""select {COPIED}, cast(1 as double) as is_fraud, timestamp '2024-02-08' as detected_at
        from t where amount > 100 and amount <= 250""",
    "joint_archive": FEATURE_FRAME,
    "joint_alerts": "select transaction_id, amount, category, is_fraud from a",
    "joint_quarantine": "select props as raw_value, 'transaction_id,transaction_time,amount' as missing from events",
    "dedup_stream": "select * from t",
    "csv_bad_rows": """select transaction_id as trans_num, case when amount <= 400 then amount end as amt,
        coalesce(amount > 400, false) as is_bad, case when amount > 400 then true end as kept from t""",
    "progress_after_replay": """, m as (select case when hour(transaction_time) < 12 then 0 else 1 end as d,
          count(*) as n, count(*) filter (is_fraud = 1) as fraud, count(*) filter (amount > 100) as alerts,
          count(*) filter (is_fraud = 1 and amount > 100) as caught from t group by 1)
        select cast(d as bigint) as batch_id, n, fraud, alerts, caught,
          case when d = 1 then (select count(*) from events) else n - n end as bad,
          cast(sum(n) over w as bigint) as cum_n, cast(sum(fraud) over w as bigint) as cum_fraud,
          cast(sum(alerts) over w as bigint) as cum_alerts, cast(sum(caught) over w as bigint) as cum_caught,
          round(sum(fraud) over w / sum(n) over w * 100, 4) as cum_fraud_pct
        from m window w as (order by d)""",
}

# Queries that read a source table directly.
_DIRECT: dict[str, str] = {
    "zip_pad": """select event_id, case when length(event_id::varchar) < 5
        then lpad(event_id::varchar, 5, '0') else event_id::varchar end as zip from events""",
    "parse_json": """select cast(json_extract_string(props, '$.k') as int) as k, ts as kafka_timestamp,
        props as raw_value from events""",
}


def oracle_sql() -> dict[str, str]:
    head = f"with t as ({TRANSACTIONS}), a as ({ALERTS})"
    return {name: f"{head} {body}" for name, body in _BODIES.items()} | _DIRECT
