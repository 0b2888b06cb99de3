"""DuckDB statements that give the expected rows of the registered queries.

They compute on scaled integers where the engine uses decimals, and with recursion or correlated
text where it uses folds and windows, so an error would have to be made twice to go unseen.
"""

from __future__ import annotations

from ridewright.checks.queries import COMMANDS, END_RIDE_BODIES, LIFECYCLE_EVENTS
from ridewright.checks.views import GIVEN, with_views
from ridewright.operators.lifecycle import FLOWS

ORACLES: dict[str, str] = {}


def _given(text: str) -> str:
    return text.format(**{g: g for g in GIVEN})


def _scaled(value: str, digits: int) -> str:
    return f"cast(cast({value} as decimal(38,{digits})) * {10**digits} as hugeint)"


def _decimal(whole: str, digits: int, kind: str) -> str:
    one = "0." + "0" * (digits - 1) + "1"
    return f"cast(cast({whole} as decimal(28,0)) * cast({one} as decimal({digits},{digits})) as {kind})"


def _token_price(price: str, rate: str) -> str:
    return _decimal(f"({_scaled(price, 2)} * 1000000) // {_scaled(rate, 6)}", 2, "decimal(18,2)")


RATED = """rated as (
 select r.*, o.currency_code, o.commission_factor, o.token_share, coalesce(x.rate, 1) rate
 from rides r join owners o using (owner_id) left join rates x using (currency_code))"""

PRICED = f"""base as (
 select r.*, v.device_id, v.base_price, v.price_per_minute, v.reward_base, v.reward_factor, o.company_name,
  o.currency_code, o.commission_factor cf, o.token_share, o.commission_factor, cast(coalesce(x.rate, 1) as decimal(11,6)) rate,
  (epoch_ms(r.end_time) - epoch_ms(r.start_time)) // 60000 as minutes
 from rides r join vehicles v using (vehicle_id) join owners o on v.owner_id = o.owner_id left join rates x using (currency_code)
 where r.end_time is not null),
priced0 as (select * exclude (price, token_awarded), cast(base_price + cast(price_per_minute as decimal(38,2)) * minutes as decimal(18,2)) price from base),
priced1 as (select *, {_token_price("price", "rate")} token_price, cast(cast(price as decimal(38,2)) * cf as decimal(26,8)) commission from priced0),
priced as (select *, cast(least(
  coalesce(reward_base, 0) + coalesce(cast(token_price as decimal(38,2)) * reward_factor, 0),
  token_price - cast(token_price as decimal(38,2)) * cf) as decimal(28,8)) token_awarded from priced1)"""

# net, token part and fiat part at ten digits; the division rounds half up on integers
SPLIT = f"""split0 as (
 select *, cast(cast(price - cast(price as decimal(38,2)) * commission_factor as decimal(38,8)) * token_share as decimal(24,10)) token_part,
  cast(price - cast(price as decimal(38,2)) * commission_factor as decimal(26,8)) net from rated),
split as (
 select *, case when currency_code = 'TOK' then cast(cast(net - token_part as decimal(32,10)) * cast(rate as decimal(11,6)) as decimal(24,10))
   else cast(net - token_part as decimal(24,10)) end fiat_revenue,
  case when currency_code = 'TOK' then token_part
   else {_decimal(f"(2 * {_scaled('token_part', 10)} * 1000000 + {_scaled('rate', 6)}) // (2 * {_scaled('rate', 6)})", 10, "decimal(24,10)")} end token_revenue
 from split0)"""

DAILY = """daily as (
 select vehicle_id, effective_date as date, min_by(owner_id, (start_time, ride_id)) owner_id,
  min_by(currency_code, (start_time, ride_id)) currency_code, count(*) rides_count,
  cast(sum(fiat_revenue) as decimal(36,10)) fiat_revenue, cast(sum(token_revenue) as decimal(36,10)) token_revenue,
  count(*) filter (rating = 1) rating_1_count, count(*) filter (rating = 2) rating_2_count, count(*) filter (rating = 3) rating_3_count,
  count(*) filter (rating = 4) rating_4_count, count(*) filter (rating = 5) rating_5_count,
  coalesce(max_by(parking_image_url, (end_time, ride_id)) filter (end_time is not null), '') last_parking_image_url
 from split group by all)"""

# one row per vehicle and day up to the last day, made from the calendar instead of from gaps
DENSE = """firsts as (select vehicle_id, min(date) first_day from daily group by all),
calendar as (select vehicle_id, cast(unnest(generate_series(cast(first_day as timestamp), timestamp '2024-02-29', interval 1 day)) as date) as date from firsts),
dense as (
 select c.vehicle_id, c.date,
  last_value(d.owner_id ignore nulls) over w owner_id, last_value(d.currency_code ignore nulls) over w currency_code,
  coalesce(d.rides_count, 0) rides_count, cast(coalesce(d.fiat_revenue, 0) as decimal(36,10)) fiat_revenue,
  cast(coalesce(d.token_revenue, 0) as decimal(36,10)) token_revenue,
  coalesce(rating_1_count, 0) rating_1_count, coalesce(rating_2_count, 0) rating_2_count, coalesce(rating_3_count, 0) rating_3_count,
  coalesce(rating_4_count, 0) rating_4_count, coalesce(rating_5_count, 0) rating_5_count,
  cast(sum(d.rides_count) over w as bigint) rides_accumulate, cast(sum(d.fiat_revenue) over w as decimal(36,10)) fiat_accumulate,
  cast(sum(d.token_revenue) over w as decimal(36,10)) token_accumulate
 from calendar c left join daily d on c.vehicle_id = d.vehicle_id and c.date = d.date
 window w as (partition by c.vehicle_id order by c.date rows unbounded preceding))"""

STATS_VIEWS = ["rates", "owners", "rides"]
RIDE_VIEWS = ["rates", "owners", "vehicles", "rides"]

LEDGER = """ledger as (
 select event_id, owner_id, case transaction_type when 'OwnerToRider' then amount else -amount end amount
 from token_messages where transaction_type <> 'NetworkOperatorToRider'),
positions as (
 select o.*, cast(l.delta_cents as bigint) delta_cents, cast(coalesce(o.token_balance_base, 0) + cast(l.delta_cents as decimal(28,0)) * 0.01 as decimal(22,2)) as position
 from owners o join (select owner_id, sum(cast(amount * 100 as bigint)) delta_cents from ledger group by all) l using (owner_id))"""

# rate and currency are stored on the ride and differ from today's
PAYABLE = """payable as (
 select *, case k % 2 when 0 then 'USD' else 'ILS' end ride_currency,
  case when k % 13 > 0 then cast(0.2 + (k % 7) * 0.15 as decimal(11,6)) end ride_rate from rides where end_time >= timestamp '2024-01-15' and end_time <= timestamp '2024-03-15'
  and capture_transaction_id is null and paid_with_token is not null)"""

# the fold over the rides not paid with tokens, a ride per recursion step
FOLD = f"""due0 as (
 select p.*, p.ride_currency currency_code, q.commission_factor, q.vendor_id, q.position, cast(coalesce(p.ride_rate, 1) as decimal(11,6)) rate
 from payable p join positions q using (owner_id) where not paid_with_token),
due as (
 select *, {_scaled(_token_price("price", "rate"), 2)} price_cents,
  row_number() over (partition by owner_id order by end_time, ride_id, price) turn from due0),
fold(owner_id, ride_id, turn, price_cents, covered, left_cents) as (
 select owner_id, ride_id, turn, price_cents, price_cents <= {_scaled("position", 2)},
  {_scaled("position", 2)} - case when price_cents <= {_scaled("position", 2)} then price_cents else 0 end from due where turn = 1
 union all
 select d.owner_id, d.ride_id, d.turn, d.price_cents, d.price_cents <= f.left_cents,
  f.left_cents - case when d.price_cents <= f.left_cents then d.price_cents else 0 end
 from fold f join due d on d.owner_id = f.owner_id and d.turn = f.turn + 1)
/* recursive */"""
SETTLE_VIEWS = ["rates", "owners", "rides", "token_messages"]

WALLETS = """wallets as (
 select m.*, case transaction_type when 'NetworkOperatorToRider' then 'wallet-operator' when 'OwnerToRider' then wallet_address else 'wallet-riders' end from_address,
  case transaction_type when 'RiderToOwner' then wallet_address else 'wallet-riders' end to_address
 from token_messages m left join owners using (owner_id))"""


def _geohash(lat: str, lon: str) -> str:
    """Base-32 digits picked bit by bit from the two 30-bit cell numbers."""
    x = f"cast(floor(({lon} + 180.0) * (1073741824.0 / 360.0)) as bigint)"
    y = f"cast(floor(({lat} + 90.0) * (1073741824.0 / 180.0)) as bigint)"
    return _interleaved(x, y)


def _interleaved(x: str, y: str) -> str:
    chars = []
    for c in range(12):
        bits = []
        for b in range(5):
            n = 5 * c + b
            source, place = (x, 29 - n // 2) if n % 2 == 0 else (y, 29 - n // 2)
            bits.append(f"(({source} >> {place}) & 1) * {16 >> b}")
        chars.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', 1 + cast({' + '.join(bits)} as int), 1)")
    return "concat(" + ", ".join(chars) + ")"


def _cells(table: str, keep: str, lat: str, lon: str, out: str) -> str:
    """Two CTEs: exact cell numbers, then their geohash."""
    fix = lambda guess, value, low, span: (
        f"case when {value} < {guess} * ({span} / 1073741824.0) + {low} then {guess} - 1 "
        f"when {value} >= ({guess} + 1) * ({span} / 1073741824.0) + {low} then {guess} + 1 else {guess} end"
    )
    gx = f"cast(floor(({lon} + 180.0) * (1073741824.0 / 360.0)) as bigint)"
    gy = f"cast(floor(({lat} + 90.0) * (1073741824.0 / 180.0)) as bigint)"
    return f"""{out}0 as (select {keep}, {fix(gx, lon, "(-180.0)", "360.0")} x, {fix(gy, lat, "(-90.0)", "180.0")} y from {table}),
{out} as (select *, case when x is not null then {_interleaved("x", "y")} end gh from {out}0)"""


MESSAGE_TIME = "strftime(start_time, '%Y-%m-%dT%H:%M:%S.') || lpad(cast(epoch_ms(start_time) % 1000 as varchar), 3, '0') || 'Z'"


def _oracle(name: str, views: list[str], body: str) -> None:
    ORACLES[name] = with_views(views, body) if views else body.strip()


ORACLES["parse_messages"] = f"""
with bodies as ({_given(END_RIDE_BODIES)})
select event_id, case when json_valid(body) then json_extract_string(body, '$.riderId') end rider_id,
 case when json_valid(body) then json_extract_string(body, '$.jobId') end job_id,
 case when json_valid(body) then json_extract_string(body, '$.parkingImageUrl') end parking_image_url,
 case when json_valid(body) then cast(json_extract_string(body, '$.paymentMethodToken') as boolean) end paid_with_token,
 case when json_valid(body) then 'decoded' else 'dead letter' end outcome
from bodies where not json_valid(body) or json_extract_string(body, '$.riderId') is not null
"""

_oracle(
    "scan_effective_date",
    ["rides"],
    ", one as (select 1) select ride_id, effective_date, vehicle_id, rating, price from rides where effective_date in (date '2024-01-31', date '2024-02-29')",
)

ORACLES["latest_rates"] = """
with quotes as (
 select 'USD' currency_code, cast(value as decimal(11,6)) rate, ts from events where event_type <> 'error' and event_id % 3 <> 0
 union all
 select 'ILS', cast(cast(value + 1 as decimal(18,2)) as decimal(11,6)), ts from events where event_type <> 'error' and event_id % 3 <> 0)
select currency_code, rate, ts updated_timestamp from quotes
qualify row_number() over (partition by currency_code order by ts desc, rate desc) = 1
"""

for _name, _columns in {
    "enrich_end_ride": "ride_id, rider_id, vehicle_id, owner_id, device_id, start_time, end_time, base_price, price_per_minute, currency_code, commission_factor, company_name, rate",
    "ride_price": "ride_id, minutes, price, commission",
    "token_price_down": "ride_id, price, rate, token_price",
    "token_award": "ride_id, token_awarded",
    "ride_summary": """ride_id, rider_id, vehicle_id, owner_id, start_time, end_time, effective_date, parking_image_url, 0 rating, price, currency_code,
 rate conversion_rate, commission, commission_factor, token_share, cast(null as boolean) paid_with_token, cast(null as varchar) capture_transaction_id, token_awarded, distance,
 case when k % 6 > 0 then concat('auth-', ride_id) end auth_transaction_id, concat('from-', vehicle_id) start_geohash, concat('to-', rider_id) last_geohash""",
    "effective_date_copy": """ride_id, effective_date, rider_id, vehicle_id, owner_id, start_time, end_time, parking_image_url, 0 rating, price, currency_code,
 rate conversion_rate, commission_factor, token_share, cast(null as boolean) paid_with_token""",
}.items():
    _oracle(_name, RIDE_VIEWS, f", {PRICED}\nselect {_columns} from priced")

_oracle(
    "ride_commands",
    ["vehicles", "rides"],
    f""", full_rides as (select r.*, v.device_id, v.vendor from rides r join vehicles v using (vehicle_id))
select 'lock-vehicle' topic, concat('{{"vehicleId":', vehicle_id, ',"deviceId":"', device_id, '","vendor":"', vendor, '"}}') as value from full_rides
union all
select 'update-balance', concat('{{"riderId":', rider_id, ',"vehicleId":', vehicle_id, ',"startTime":"', {MESSAGE_TIME}, '"',
 case when paid_with_token is null then '' else concat(',"paymentMethodToken":', cast(paid_with_token as varchar)) end, '}}') from full_rides
union all
select concat('iot-commands-', vendor), concat('{{"deviceId":"', device_id, '","vendor":"', vendor, '","command":"locked"}}') from full_rides""",
)

_oracle(
    "opened_rides",
    ["vehicles"],
    f""", {_cells("vehicles", "vehicle_id, battery_percentage", "lat", "lon", "located")}
select e.user_id rider_id, vehicle_id, e.ts start_time, gh start_geohash, gh last_geohash, battery_percentage start_battery,
 battery_percentage last_battery, cast(0 as decimal(18,3)) distance, cast(null as varchar) auth_transaction_id
from events e join located on vehicle_id = e.event_id % (select count(*) from part) where event_type = 'view'""",
)

_oracle(
    "local_effective_date",
    ["vehicles", "rides"],
    f""", {_cells("vehicles", "vehicle_id, cast(floor((lon - 34.7) * 100) as int) band", "lat", "lon", "located")},
bands as (select left(gh, 5) cell, min(band) band from located group by all),
zones as (select cell, case band % 4 when 1 then 'Asia/Jerusalem' when 2 then 'Asia/Tokyo' when 3 then 'America/New_York' end tz_id from bands)
select ride_id, tz_id, case when tz_id is null then cast(start_time as date) else cast(timezone(tz_id, timezone('UTC', start_time)) as date) end effective_date
from rides join located using (vehicle_id) left join zones on cell = left(gh, 5)""",
)

_oracle(
    "auth_amount",
    ["vehicles", "riders"],
    """, requests as (select event_id, user_id rider_id, concat('qr', cast(event_id % (select count(*) from part) as varchar)) qr from events)
select event_id, vehicle_id, owner_id, device_id, payment_method_id, cast(base_price as double) + cast(price_per_minute as double) * 5.0 auth_amount
from requests join vehicles on lower(qr_code) = qr join riders using (rider_id)""",
)

_oracle(
    "auth_requests",
    ["vehicles", "riders", "owners"],
    """, requests as (select event_id, event_type, user_id rider_id, concat('qr', cast(event_id % (select count(*) from part) as varchar)) qr from events)
select event_id, concat('{"cardTransactionType":"', case event_type when 'error' then 'AUTH_REVERSAL' else 'AUTH_ONLY' end, '","vaultedShopperId":"', payment_method_id,
 '","currency":"', currency_code, '","amount":', cast(cast(base_price + price_per_minute * 5 as decimal(18,2)) as varchar), '}') request
from requests join vehicles on lower(qr_code) = qr join riders using (rider_id) join owners using (owner_id)""",
)

_oracle(
    "token_payment_allowed",
    [*STATS_VIEWS, "riders"],
    f""", {RATED}
select ride_id, coalesce(coalesce(token_balance, 0) * cast(rate as decimal(38,6)) >= price, false) token_allowed from rated left join riders using (rider_id)""",
)

_oracle(
    "unset_method_guard",
    ["rides"],
    """, stored as (
 select * from rides where line <> 7 qualify row_number() over (partition by ride_id order by start_time, vehicle_id, price) = 1)
select ride_id, r.rider_id, s.owner_id, s.price from rides r join stored s using (ride_id) where s.paid_with_token is null""",
)

_oracle(
    "rider_balance",
    [*STATS_VIEWS, "riders"],
    f""", {RATED},
changes as (
 select rider_id, case when paid_with_token then -{_decimal(f"(2 * {_scaled('price', 2)} * 1000000 + {_scaled('rate', 6)}) // (2 * {_scaled('rate', 6)})", 2, "decimal(18,2)")} else token_awarded end change
 from rated)
select rider_id, cast(coalesce(any_value(token_balance), 0) + coalesce(sum(change), 0) as decimal(38,2)) new_balance
from riders left join changes using (rider_id) group by rider_id""",
)

_oracle(
    "method_update",
    ["rides"],
    """, one as (select 1)
select ride_id, case k % 3 when 0 then true when 1 then false else paid_with_token end paid_with_token,
 case when k % 3 = 0 then cast(0 as decimal(18,2)) else token_awarded end token_awarded from rides""",
)

_oracle(
    "mark_paid",
    ["rides"],
    """, one as (select 1)
select ride_id, case when capture_transaction_id is not null then capture_transaction_id when paid_with_token then 'paid-with-token'
 when k % 5 <> 0 then concat('new-', cast(k as varchar)) end capture_transaction_id from rides""",
)

_oracle(
    "active_rides",
    ["rides"],
    """, one as (select 1)
select rider_id, ride_id, vehicle_id, start_time, distance from rides where end_time is null
qualify row_number() over (partition by rider_id order by start_time desc, ride_id desc) = 1""",
)


def _significant(value: str, scale: int) -> str:
    """Two significant digits as plain text, by trying each magnitude; 99.5 and more of one is the next."""
    units = f"cast({value} * {10**scale} as bigint)"
    arms = []
    for n in range(1, 15):
        number = f"cast(({units} + {10**n // 2}) // {10**n} * {10**n} as decimal(18,0)) * cast({10.0**-scale:.{scale}f} as decimal(4,{scale}))"
        places = max(scale - n, 0)
        arms.append(f"when {units} < {10 ** (n + 2) - 10**n // 2} then cast(cast({number} as decimal(24,{places})) as varchar)")
    whole = f"cast(cast({value} as decimal(24,{scale})) as varchar)"
    return f"case when {units} < 100 then {whole} {' '.join(arms)} end"


_oracle(
    "invoice_rows",
    ["owners", "riders", "rides"],
    f""", paid as (select *, (epoch_ms(end_time) - epoch_ms(start_time)) // 1000 secs from rides where end_time is not null and paid_with_token is not null)
select ride_id, 'Ride with ' || company_name title, strftime(end_time, '%d/%m/%y, %H:%M') printed,
 cast(secs // 60 as varchar) || ':' || cast(secs % 60 as varchar) || ' mins' duration, {_significant("distance", 3)} distance,
 case when paid_with_token then '- ' else '' end || {_significant("price", 2)} || ' ' || currency_code total,
 strftime(end_time, '%y-%m-%d_%H-%M') || '_' || cast(rider_id as varchar) || '.pdf' object_name,
 case when not paid_with_token and card is not null then lpad(cast(rider_id % 10000 as varchar), 4, '0') end card_last4,
 case when not paid_with_token then card end card_brand
from paid join owners using (owner_id) join riders using (rider_id)""",
)

ORACLES["upsert_latest"] = """
select user_id, ts, event_id, event_type, value from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1
"""

_oracle(
    "keyed_update",
    ["vehicles", "iot_updates"],
    """, newest as (select device_id, battery_percentage level from iot_updates where battery_percentage is not null or battery_voltage is not null
 qualify row_number() over (partition by device_id order by ts desc, event_id desc) = 1)
select vehicle_id, device_id, status, coalesce(level, battery_percentage) battery_percentage
from vehicles left join newest using (device_id) where device_id <> ''""",
)

_oracle(
    "keyed_delete",
    ["rides"],
    ", one as (select 1) select ride_id, rider_id, vehicle_id, start_time from rides where end_time is null",
)

ORACLES["job_state_ttl"] = """
with last as (
 select concat(cast(user_id as varchar), '@', strftime(ts, '%Y-%m-%d %H')) job_id, case event_type when 'error' then 'failed' else 'started' end state, ts
 from events qualify row_number() over (partition by user_id, date_trunc('hour', ts) order by ts desc, event_id desc) = 1)
select job_id, state, ts + interval 300 second expires_at from last where ts + interval 300 second > date_trunc('hour', ts) + interval 30 minute
"""

_oracle(
    "owner_balance_ledger",
    ["owners", "token_messages"],
    f", {LEDGER}\nselect owner_id, delta_cents, position from positions",
)

_oracle(
    "export_rides",
    STATS_VIEWS,
    f""", {RATED}, {SPLIT}
select ride_id, strftime(effective_date, '%Y-%m-%d') effective_date, strftime(start_time, '%Y-%m-%d %H:%M:%S') start_time,
 strftime(end_time, '%Y-%m-%d %H:%M:%S') end_time, price, {_decimal(f"{_scaled('token_revenue', 10)} // 10", 9, "decimal(38,9)")} token_revenue from split""",
)

_oracle(
    "payable_rides",
    ["rides"],
    f", {PAYABLE}\nselect ride_id, owner_id, end_time, paid_with_token from payable",
)

_oracle(
    "split_by_method",
    ["rides"],
    ", one as (select 1) select ride_id, case when paid_with_token is null then 'undecided' when paid_with_token then 'token' else 'fiat' end route, price from rides",
)

_oracle(
    "txn_type_filter",
    ["token_messages"],
    """, one as (select 1)
select event_id, case transaction_type when 'NetworkOperatorToRider' then 'operator' else 'owner' end branch, transaction_type, amount from token_messages""",
)

_oracle(
    "settlement_fold",
    SETTLE_VIEWS,
    f""", {LEDGER}, {PAYABLE}, {FOLD}
select owner_id, ride_id, cast(price_cents as bigint) price_cents, covered, cast(left_cents as bigint) left_cents from fold
union all select owner_id, ride_id, null, null, null from payable join positions using (owner_id) where paid_with_token""",
)

ORACLES["settlement_fold_blocks"] = ORACLES["settlement_fold"]

_oracle(
    "reward_owed",
    SETTLE_VIEWS,
    f""", {LEDGER}, {PAYABLE}, {FOLD}
select d.owner_id, cast(sum(token_awarded) as decimal(28,2)) reward_owed from due d join fold f on d.owner_id = f.owner_id and d.turn = f.turn
where covered group by all having sum(token_awarded) > 0""",
)

_oracle(
    "reward_messages",
    SETTLE_VIEWS,
    f""", {LEDGER}, {PAYABLE}, {FOLD}
select d.ride_id, end_time ts, 'NetworkOperatorToRider' transaction_type, d.owner_id, token_awarded amount
from due d join fold f on d.owner_id = f.owner_id and d.turn = f.turn where not covered and token_awarded > 0""",
)

_oracle(
    "payment_requests",
    [*SETTLE_VIEWS, "riders"],
    f""", {LEDGER}, {PAYABLE}, {FOLD},
shares as (
 select d.*, f.covered, case when f.covered then 0 else ({_scaled("token_awarded", 2)} * {_scaled("rate", 6)} * 10000000000) // ({_scaled("price", 2)} * 1000000) end share
 from due d join fold f on d.owner_id = f.owner_id and d.turn = f.turn)
select ride_id, owner_id, covered, 'AUTH_CAPTURE' card_transaction_type, payment_method_id vaulted_shopper_id, currency_code currency, price amount, vendor_id,
 cast(cast(commission_factor as decimal(28,10)) * 100 + {_decimal("share", 10, "decimal(28,10)")} * 100 as decimal(28,10)) commission_percent
from shares join riders using (rider_id)""",
)

_oracle(
    "auth_reversals",
    SETTLE_VIEWS,
    f""", {LEDGER}, {PAYABLE}
select ride_id, concat('{{"cardTransactionType":"AUTH_REVERSAL","transactionId":"auth-', ride_id, '"}}') request
from payable join positions using (owner_id) where k % 6 > 0""",
)

_oracle(
    "payments",
    [*SETTLE_VIEWS, "riders"],
    f""", {LEDGER}, {PAYABLE}, {FOLD},
shares as (
 select d.*, f.covered, case when f.covered then 0 else ({_scaled("token_awarded", 2)} * {_scaled("rate", 6)} * 10000000000) // ({_scaled("price", 2)} * 1000000) end share
 from due d join fold f on d.owner_id = f.owner_id and d.turn = f.turn)
select ride_id, owner_id, rider_id, end_time + interval 1 minute transaction_time, concat('new-', ride_id) transaction_id,
 payment_method_id vaulted_shopper_id, vendor_id, commission_factor, {_decimal("share", 10, "decimal(28,10)")} reward_commission_factor, currency_code, price amount
from shares join riders using (rider_id) where k % 4 > 0""",
)

_oracle(
    "settled_deltas",
    ["owners", "token_messages"],
    f", {LEDGER}\nselect event_id, owner_id, cast(amount as decimal(18,2)) delta from ledger",
)

_oracle(
    "txn_records",
    ["owners", "token_messages"],
    f""", {WALLETS}
select case transaction_type when 'RiderToOwner' then 'wallet-riders' else 'wallet-operator' end from_address, to_address, owner_id, amount, transaction_type, ts insertion_time from wallets""",
)

_oracle(
    "txn_wallets",
    ["owners", "token_messages"],
    f", {WALLETS}\nselect event_id, from_address, to_address, amount from wallets",
)

_oracle(
    "pending_gate",
    ["owners", "token_messages"],
    f""", {WALLETS},
busy as (select distinct from_address from wallets where ts < timestamp '2024-01-16' and owner_id % 5 = 0 and transaction_type = 'OwnerToRider' and from_address is not null)
select event_id, from_address,
 case when from_address is not null and from_address not in (select from_address from busy)
  and row_number() over (partition by from_address order by ts, event_id) = 1 then 'release' else 'defer' end gate
from wallets where ts >= timestamp '2024-01-16'""",
)

_oracle(
    "token_units",
    ["token_messages"],
    """, one as (select 1)
select event_id, cast(cast(amount * 100 as hugeint) * 10000000000000000 as varchar) units, cast(amount as decimal(22,2)) tokens,
 cast(cast(amount as decimal(38,2)) * 0.250000 as decimal(24,8)) fiat from token_messages""",
)

OPERATOR_SUM = """select time_bucket(interval '4 hours', ts) window_start, time_bucket(interval '4 hours', ts) + interval 4 hour window_end,
 'NetworkOperatorToRider' transaction_type, cast(null as bigint) owner_id, cast(sum(amount) as decimal(28,2)) amount
from token_messages where transaction_type = 'NetworkOperatorToRider' group by all"""

NETTING = """select window_start, window_start + interval 4 hour window_end, case when net > 0 then 'OwnerToRider' else 'RiderToOwner' end transaction_type,
 owner_id, abs(net) amount
from (select time_bucket(interval '4 hours', ts) window_start, owner_id,
  cast(sum(case transaction_type when 'OwnerToRider' then amount else -amount end) as decimal(28,2)) net
 from token_messages where transaction_type <> 'NetworkOperatorToRider' group by all) where net <> 0"""

_oracle(
    "operator_window_sum",
    ["token_messages"],
    f", one as (select 1) select * exclude (owner_id) from ({OPERATOR_SUM})",
)
_oracle("owner_netting", ["token_messages"], f", one as (select 1) {NETTING}")
_oracle("settlement_union", ["token_messages"], f", one as (select 1) {OPERATOR_SUM} union all {NETTING}")

_oracle(
    "owner_delta_update",
    STATS_VIEWS,
    f""", {RATED}
select owner_id, cast(sum(({_scaled("price", 2)} * 1000000) // {_scaled("rate", 6)}) as bigint) delta_cents from rated where paid_with_token group by all""",
)

_oracle(
    "revenue_split",
    STATS_VIEWS,
    f", {RATED}, {SPLIT}\nselect ride_id, fiat_revenue, token_revenue from split",
)
_oracle("daily_vehicle_stats", STATS_VIEWS, f", {RATED}, {SPLIT}, {DAILY}\nselect * from daily")
_oracle(
    "stats_backfill",
    STATS_VIEWS,
    f", {RATED}, {SPLIT}, {DAILY}, {DENSE}\nselect * exclude (currency_code) from dense",
)
_oracle(
    "daily_vehicle_accumulate",
    STATS_VIEWS,
    f""", {RATED}, {SPLIT}, {DAILY}
select vehicle_id, date, rides_count, cast(sum(rides_count) over w as bigint) rides_accumulate,
 cast(sum(fiat_revenue) over w as decimal(36,10)) fiat_accumulate, cast(sum(token_revenue) over w as decimal(36,10)) token_accumulate
from daily window w as (partition by vehicle_id order by date)""",
)
_oracle(
    "daily_vehicle_carry",
    [*STATS_VIEWS, "vehicles"],
    f""", {RATED}, {SPLIT}, {DAILY},
history as (
 select vehicle_id, sum(rides_count) r, sum(fiat_revenue) f, sum(token_revenue) t, max_by(currency_code, date) currency_code
 from daily where date < date '2024-01-31' group by vehicle_id),
today as (select * from daily where date = date '2024-01-31'),
ids as (select vehicle_id from history union select vehicle_id from today)
select vehicle_id, date '2024-01-31' as date, coalesce(d.owner_id, v.owner_id) owner_id, coalesce(d.currency_code, h.currency_code) currency_code,
 coalesce(rides_count, 0) rides_count, cast(coalesce(fiat_revenue, 0) as decimal(36,10)) fiat_revenue, cast(coalesce(token_revenue, 0) as decimal(36,10)) token_revenue,
 coalesce(rating_1_count, 0) rating_1_count, coalesce(rating_2_count, 0) rating_2_count, coalesce(rating_3_count, 0) rating_3_count,
 coalesce(rating_4_count, 0) rating_4_count, coalesce(rating_5_count, 0) rating_5_count, coalesce(last_parking_image_url, '') last_parking_image_url,
 cast(coalesce(rides_count, 0) + coalesce(r, 0) as bigint) rides_accumulate,
 cast(coalesce(fiat_revenue, 0) + coalesce(f, 0) as decimal(36,10)) fiat_accumulate,
 cast(coalesce(token_revenue, 0) + coalesce(t, 0) as decimal(36,10)) token_accumulate
from ids left join today d using (vehicle_id) left join history h using (vehicle_id) left join vehicles v using (vehicle_id)""",
)
_oracle(
    "daily_owner_stats",
    STATS_VIEWS,
    f""", {RATED}, {SPLIT}, {DAILY}, {DENSE}
select owner_id, date, min_by(currency_code, vehicle_id) currency_code, count(*) vehicles_count, cast(sum(rides_count) as bigint) rides_count,
 cast(sum(fiat_revenue) as decimal(36,10)) fiat_revenue, cast(sum(token_revenue) as decimal(36,10)) token_revenue,
 cast(sum(rides_accumulate) as bigint) rides_accumulate, cast(sum(fiat_accumulate) as decimal(36,10)) fiat_accumulate,
 cast(sum(token_accumulate) as decimal(36,10)) token_accumulate
from dense group by owner_id, date""",
)
_oracle(
    "parking_photo_update",
    STATS_VIEWS,
    f""", {RATED}, {SPLIT}, {DAILY},
photos as (select owner_id, vehicle_id, effective_date as date, max_by(parking_image_url, (end_time, ride_id)) photo
 from rides where end_time is not null and rating >= 3 group by all)
select owner_id, vehicle_id, date, coalesce(photo, last_parking_image_url) last_parking_image_url from daily left join photos using (owner_id, vehicle_id, date)""",
)

_oracle(
    "telemetry_merge",
    ["vehicles", "iot_updates"],
    f""", {_cells("vehicles", "vehicle_id", "lat", "lon", "here")}, {_cells("iot_updates", "event_id, device_id, ts", "lat", "lon", "there")},
bat as (select device_id, battery_percentage p, battery_voltage u from iot_updates where battery_percentage is not null or battery_voltage is not null qualify row_number() over (partition by device_id order by ts desc, event_id desc) = 1),
st as (select device_id, state from iot_updates where state is not null qualify row_number() over (partition by device_id order by ts desc, event_id desc) = 1),
pos as (select device_id, gh from there where gh is not null qualify row_number() over (partition by device_id order by ts desc, event_id desc) = 1),
devices as (select distinct device_id from iot_updates)
select v.vehicle_id, coalesce(p, cast(floor(least(cast(100 as float), greatest(cast(0 as float), cast(battery_alpha as float) * cast(u as float) + cast(battery_beta as float)))) as int), battery_percentage) battery_percentage,
 coalesce(state, 'locked') device_state, coalesce(pos.gh, here.gh) geo_hash
from vehicles v join devices using (device_id) join here on here.vehicle_id = v.vehicle_id left join bat using (device_id) left join st using (device_id) left join pos using (device_id)""",
)

POINTS = """points as (
 select event_id, cast((event_id * 7919 % 180000) * 0.001 - 90 as double) lat, cast((event_id * 104729 % 360000) * 0.001 - 180 as double) lon from events)"""

ORACLES["geohash_cells"] = f"""
with {POINTS},
{_cells("points", "event_id", "lat", "lon", "c")}
select event_id, gh geohash, {", ".join(f"left(gh, {k}) geo_hash_{k}" for k in range(1, 11))},
 (cast(y as double) + 0.5) * (180.0 / 1073741824.0) - 90.0 centre_lat, (cast(x as double) + 0.5) * (360.0 / 1073741824.0) - 180.0 centre_lon
from c
"""

# a 5-character cell has 13 longitude bits and 12 latitude bits
ORACLES["geohash_neighbours"] = f"""
with {POINTS},
{_cells("points", "event_id", "lat", "lon", "c")},
near as (select event_id, left(gh, 5) cell, (((x >> 17) + dx + 8192) % 8192) << 17 x, (y >> 18) + dy row_no
 from c, (values (-1), (0), (1)) a(dx), (values (-1), (0), (1)) b(dy)),
rows_left as (select event_id, cell, x, row_no << 18 y from near where row_no between 0 and 4095)
select event_id, cell, left({_interleaved("x", "y")}, 5) neighbour from rows_left
"""

# two points share an n-character prefix exactly when their cell numbers at that depth agree
_oracle(
    "proximity_search",
    ["vehicles"],
    f""", {_cells("vehicles", "vehicle_id, qr_code, battery_percentage, status, model, operator_name, base_price, price_per_minute", "lat", "lon", "spots")},
points as (select event_id, cast(4 + event_id % 3 as int) n, cast(31.9 + (event_id * 41 % 1400) * 0.0005 as double) lat, cast(34.6 + (event_id * 59 % 1400) * 0.0005 as double) lon from events),
{_cells("points", "event_id, n", "lat", "lon", "req")},
searches as (select distinct n, left(gh, n) prefix, x >> (30 - (5 * n + 1) // 2) sx, y >> (30 - 5 * n // 2) sy, 30 - (5 * n + 1) // 2 dx, 30 - 5 * n // 2 dy from req),
found as (
 select n, prefix, vehicle_id, concat('{{"qrCode":"', qr_code, '","id":', vehicle_id, ',"batteryPercentage":', battery_percentage, ',"status":"', status, '"',
  case when model is null then '' else concat(',"model":"', model, '"') end, ',"geoHash":"', gh, '","operator_name":"', operator_name, '","base_price":', base_price, ',"price_per_minute":', price_per_minute, '}}') card
 from searches join spots on status = 'available' and abs((x >> dx) - sx) <= 1 and abs((y >> dy) - sy) <= 1),
sized as (select s.n, s.prefix, vehicle_id, card, count(vehicle_id) over (partition by s.n, s.prefix) vehicles_found
 from searches s left join found f on s.n = f.n and s.prefix = f.prefix)
select n prefix_length, prefix, case when vehicles_found <= 1000 then 0
  else cast(concat('0x', left(md5(cast(vehicle_id as varchar)), 8)) as bigint) % cast(ceil(vehicles_found / 1000) as bigint) end page,
 any_value(vehicles_found) vehicles_found, concat('[', coalesce(string_agg(card, ',' order by vehicle_id), ''), ']') search_results
from sized group by 1, 2, 3""",
)

# the state at the command's instant, else the first sight of the commanded one in time
ANSWERED = """commands as (
 select event_id, ts, case when user_id % 11 = 0 then '' else concat('dev-', cast(user_id as varchar)) end device_id, case event_type when 'view' then 'unlocked' else 'locked' end command
 from events where event_type in ('view', 'click')),
states as (select device_id, ts, list(distinct state) seen from iot_updates where state is not null group by all),
now as (select c.event_id, list_contains(s.seen, c.command) done from commands c asof join states s on c.device_id = s.device_id and c.ts >= s.ts),
later as (
 select c.event_id, min(s.ts) seen from commands c join states s on c.device_id = s.device_id and list_contains(s.seen, c.command) and s.ts between c.ts and c.ts + interval 360 second group by all),
answered as (select event_id, ts, device_id, command, case when device_id = '' or now.done then ts else seen end ack_ts,
 device_id = '' or coalesce(now.done, false) or seen is not null acked
from commands left join now using (event_id) left join later using (event_id))"""

_oracle(
    "command_ack",
    ["iot_updates"],
    f", {ANSWERED}\nselect event_id, device_id, command, ack_ts, acked from answered",
)

_oracle(
    "command_sends",
    ["iot_updates"],
    f""", {ANSWERED}
select event_id, device_id, command, cast(attempt as int) attempt, ts + interval 1 minute * attempt sent_at
from answered, range(6) t(attempt)
where device_id <> '' and (attempt = 0 or ack_ts is null or ts + interval 1 minute * attempt < ack_ts)""",
)

_oracle(
    "payment_choice",
    ["rides"],
    """, one as (select 1)
select ride_id, coalesce(paid_with_token and k % 7 <> 0 and (k * 37 + line * 11) % 900 - 200 <= 400, false) by_token from rides where end_time is not null""",
)

_FLOW_ROWS = ", ".join(
    f"('{name}', '{f.required}', {'null' if f.command is None else repr(f.command)}, '{f.on_success}', '{f.on_failure or f.required}', {str(f.tracks_job).lower()})"
    for name, f in FLOWS.items()
)

# the machine, an event per recursion step
_oracle(
    "vehicle_lifecycle",
    ["vehicles"],
    f""", flows(flow, required, command, success, failure, tracked) as (values {_FLOW_ROWS}),
steps as (
 select e.*, f.* exclude (flow), row_number() over (partition by vehicle_id order by ts, event_id) turn
 from ({_given(LIFECYCLE_EVENTS)}) e join flows f using (flow) join vehicles v using (vehicle_id)),
run(vehicle_id, event_id, turn, status_before, accepted, status_after, in_transition) as (
 select vehicle_id, cast(null as bigint), cast(0 as bigint), cast(null as varchar), cast(null as boolean), status, false from vehicles
 union all
 select s.vehicle_id, s.event_id, s.turn, r.status_after,
  s.kind <> 'request' or (not r.in_transition and r.status_after = s.required),
  case when s.kind = 'success' then s.success when s.kind = 'failure' then s.failure
   when not r.in_transition and r.status_after = s.required and s.command is null then s.success else r.status_after end,
  case when s.kind <> 'request' then false when not r.in_transition and r.status_after = s.required then s.command is not null else r.in_transition end
 from run r join steps s on s.vehicle_id = r.vehicle_id and s.turn = r.turn + 1)
/* recursive */
select vehicle_id, event_id, s.ts, s.flow, s.kind, status_before, accepted, status_after, in_transition,
 case when s.tracked and (s.kind = 'failure' or not accepted) then 'failed' when s.tracked and s.kind = 'request' then 'started' end job_state,
 case when s.kind = 'request' and accepted then s.command end command, s.flow = 'lock' and s.kind = 'failure' lock_failed
from run join steps s using (vehicle_id, event_id)""",
)


_oracle(
    "plain_status",
    ["vehicles"],
    """, last as (select user_id vehicle_id, case event_type when 'view' then 'available' when 'click' then 'onmission' else 'maintenance' end changed
 from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
select vehicle_id, coalesce(changed, status) status from vehicles left join last using (vehicle_id)""",
)

# Streams: the same rows as the batch operators give.

_oracle("windowed_stream", ["token_messages"], f"\n{OPERATOR_SUM} union all {NETTING}")

_oracle(
    "command_ack_stream",
    ["iot_updates"],
    f", {ANSWERED}\nselect event_id, device_id, command, ts, ack_ts from answered",
)

ORACLES["command_sends_stream"] = ORACLES["command_sends"]

ORACLES["payment_choice_stream"] = """
with choices as (select event_id ride_id, ts + interval 1 second * cast(event_id % 1300 - 600 as int) ts, event_id % 2 = 0 by_token
 from events where event_type = 'view' and event_id % 5 <> 0)
select e.event_id ride_id, e.ts end_time, coalesce(c.by_token and c.ts <= e.ts + interval 400 second, false) by_token
from events e left join choices c on c.ride_id = e.event_id where event_type = 'view'
"""

ORACLES["vehicle_lifecycle_stream"] = ORACLES["vehicle_lifecycle"]
