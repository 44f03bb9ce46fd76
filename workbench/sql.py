"""The mapping of ``workbench/frames.py`` and ``wire.py`` as DuckDB SQL fragments.

Each constant is one common table expression; ``with_`` chains them.
"""

from __future__ import annotations

EPOCH = 1704067200
VIEW_STATES = "'0x03','0x04','0x05','0x06'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def log_time(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds})*1000000),'%Y%m%d%H%M%S')"


def day(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds})*1000000),'%Y%m%d')"


def epoch(text: str) -> str:
    return f"CAST(epoch(strptime({text},'%Y%m%d%H%M%S')) AS BIGINT)"


def pick(values, index: str) -> str:
    listed = ",".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST(({index}) % {len(values)} AS INT)+1]"


# --- fixed values, stated here a second time so that the SQL does not lean on the package:
# telecom regions with the prefixes of a user id, in rule order ...
TELECOM_RULES = """14302 ZZ LL YX CL 732 07312
14303 XT 733 07315
14307 CD 736 0736
14306 YY 730 0730
14309 IY 737 0737
14313 LD 738 0738
14331 JS 743 0743
14308 ZJ 744 0744
14312 HH 745 0745
14305 wg sn SY 739 0739
14310 CZ AR GD GY JQ JH LW RC YX 735 0735
14311 YZ DA DX JH LS NY QY SP YZ ZS 746 0746
14304 HY HN LY HS HD QD CN 734 0734"""
# ... and mobile regions with their area code.
MOBILE_RULES = """14302 07312
14303 07311
14304 07340
14305 07390
14306 07300
14307 07360
14308 07440
14309 07370
14310 07350
14311 07460
14312 07450
14313 07380
14331 07430"""


def telecom_region(user: str) -> str:
    """Constant rules, each on the first characters of the id."""
    rules = [line.split() for line in TELECOM_RULES.splitlines()]
    tests = [f"WHEN regexp_matches({user}, '^({'|'.join(prefixes)})') THEN '{region}'" for region, *prefixes in rules]
    return f"CASE {' '.join(tests)} ELSE '14301' END"


def mobile_region(code: str) -> str:
    rules = [line.split() for line in MOBILE_RULES.splitlines()]
    tests = [f"WHEN {code} IN ('{region}', '{area}') THEN '{region}'" for region, area in rules]
    return f"CASE {' '.join(tests)} ELSE '14301' END"


USER_PREFIXES = ("YX", "JH", "0736", "U", "732", "07312", "wg", "test")
AREA_CODES = (
    "07300", "07311", "07312", "07340", "07350", "07360", "07370", "07380", "07390", "07440",
    "07450", "07460", "07430", "14303", "99999", "",
)
VERSION = "'A.'||(k%4)||'.'||(k%3)||'.1'"


def user_name(number: str) -> str:
    return f"{pick(USER_PREFIXES, number)}||({number})"


EV = f"""ev AS (SELECT event_id, user_id AS uid, {user_name('user_id')} AS user_id,
  CAST(regexp_extract(props,'[0-9]+') AS INT) AS k, event_type AS type,
  epoch_us(ts)//1000000 AS real_s,
  {EPOCH}+(epoch_us(ts)//1000000-{EPOCH})//10 AS s FROM events)"""

_VIEWING = "type IN ('view','click')"
_CATEGORY = "CASE WHEN k%5=0 THEN '' WHEN k%5<=2 THEN 'UP'||(k%20) ELSE 'CAT'||(k%15) END"

LOG = f"""log AS (SELECT event_id AS rid, user_id, s AS ts, {log_time('s')} AS create_time,
  CASE WHEN {_VIEWING} THEN {pick(('0x03', '0x04', '0x05', '0x06'), 'k')}
       WHEN type='signup' THEN '0x01' WHEN type='purchase' THEN '0x09'
       WHEN k%3=0 THEN '0x11' ELSE '0x100' END AS state,
  type='view' AS play, k, uid, type,
  CASE WHEN {_VIEWING} THEN 'CH'||(k%10) ELSE '' END AS channel_id,
  CASE WHEN {_VIEWING} OR type='purchase' THEN 'M'||k ELSE '' END AS media_id,
  CASE WHEN ({_VIEWING} OR type='purchase') AND k%7<>0 THEN 'media '||k ELSE '' END AS media_name,
  CASE WHEN {_VIEWING} OR type='purchase' THEN {_CATEGORY} ELSE '' END AS category_id
  FROM ev)"""

PAGES = f"""pages_seen AS (SELECT event_id AS rid, user_id, s AS ts, {log_time('s')} AS create_time, k,
  CASE WHEN k%13=0 THEN '' ELSE 'page_'||(k%40) END AS pagename,
  CASE WHEN k%11<>0 THEN '' ELSE 'SP'||(k%5) END AS special_id
  FROM ev WHERE {_VIEWING})"""

# Starts with their candidate end, then the end by the inference rules.
SESSIONS = f"""ordered AS (SELECT *,
    lead(play) OVER w AS next_play, lead(ts) OVER w AS next_ts
  FROM log WHERE state IN ({VIEW_STATES})
  WINDOW w AS (PARTITION BY user_id, state ORDER BY ts, play, rid)),
starts AS (SELECT * EXCLUDE (next_play, next_ts),
    CASE WHEN NOT next_play THEN next_ts END AS stop_ts FROM ordered WHERE play),
hearts AS (SELECT user_id, ts FROM log WHERE state='0x100'),
inits AS (SELECT user_id, ts FROM log WHERE state='0x01'),
plays AS (SELECT DISTINCT user_id, ts FROM log WHERE play),
c1 AS (SELECT a.*, coalesce(
    (SELECT min(b.ts) FROM plays b WHERE b.user_id=a.user_id AND b.ts>a.ts),
    (SELECT max(h.ts) FROM hearts h WHERE h.user_id=a.user_id AND h.ts>a.ts)) AS e FROM starts a),
c2 AS (SELECT a.*,
    (SELECT max(i.ts) FROM inits i WHERE i.user_id=a.user_id AND i.ts<a.e) AS i1,
    (SELECT max(h.ts) FROM hearts h WHERE h.user_id=a.user_id AND h.ts<a.e) AS h0 FROM c1 a),
c3 AS (SELECT a.*, (SELECT max(h.ts) FROM hearts h WHERE h.user_id=a.user_id AND h.ts<a.i1) AS h1 FROM c2 a),
c4 AS (SELECT a.*, (SELECT max(i.ts) FROM inits i WHERE i.user_id=a.user_id AND i.ts<a.h1) AS i2 FROM c3 a),
c5 AS (SELECT a.*, (SELECT max(h.ts) FROM hearts h WHERE h.user_id=a.user_id AND h.ts<a.i2) AS h2,
    CASE WHEN state IN ('0x04','0x05') THEN 14400 ELSE 28800 END AS lim FROM c4 a),
sess AS (SELECT * EXCLUDE (e,i1,h0,h1,i2,h2), stop_ts IS NULL AS inferred, ts AS start_ts, CASE
    WHEN stop_ts IS NOT NULL THEN stop_ts
    WHEN e IS NULL THEN ts+300
    WHEN i1>ts THEN CASE WHEN coalesce(h1<=ts, true) THEN ts+300
                         WHEN i2>ts AND h2>ts THEN h2 ELSE h1 END
    WHEN h0>ts THEN CASE WHEN e-h0<=1200 THEN e ELSE h0 END
    WHEN e-ts>lim THEN ts+300 ELSE e END AS end_ts FROM c5)"""

_DAY = "20240102"
_FIRST = EPOCH + 86400
_LAST = EPOCH + 2 * 86400 - 1

DAY_SESSIONS = f"""day_kept AS (SELECT * FROM sess
  WHERE end_ts-start_ts BETWEEN 3 AND lim
    AND (({day('end_ts')}='{_DAY}' AND {day('start_ts')}<'{_DAY}')
      OR ({day('end_ts')}='{_DAY}' AND {day('start_ts')}='{_DAY}')
      OR ({day('end_ts')}>'{_DAY}' AND {day('start_ts')}='{_DAY}'))),
day_sess AS (SELECT * REPLACE (greatest(start_ts,{_FIRST}) AS start_ts, least(end_ts,{_LAST}) AS end_ts),
  {log_time(f'greatest(start_ts,{_FIRST})')} AS play_start_time,
  {log_time(f'least(end_ts,{_LAST})')} AS play_end_time FROM day_kept)"""

CHANNELS = """channels AS (SELECT CASE WHEN n_regionkey=2 THEN 'OLD' ELSE 'CH' END||n_nationkey AS channel_id,
  'CONF'||n_nationkey AS conf_channel_id, n_name AS conf_channel_name FROM nation)"""

MEDIA = """media AS (SELECT 'M'||(p_partkey%100) AS media_id, p_name AS media_name,
  'CAT'||split_part(p_brand,'#',2) AS category_id,
  'cat '||lower(p_type)||' '||split_part(p_brand,'#',2) AS category_name,
  'CHN_'||p_type AS channel_id FROM part),
media_names AS (SELECT media_id, min(media_name) AS name FROM media GROUP BY 1)"""

# Customers of one segment carry ids that no log has.
_CUSTOMER = f"CASE WHEN c_mktsegment='BUILDING' THEN 'gone'||c_custkey ELSE {user_name('c_custkey')} END"

POOL = f"""prev_pool AS (SELECT {_CUSTOMER} AS user_id,
  {telecom_region('(' + _CUSTOMER + ')')} AS regionid, '' AS status, '20231201' AS start_date,
  '' AS end_date, '20231201' AS create_date, 'B.'||(c_custkey%5)||'.0.2' AS apk_version,
  'OLDMAC'||c_custkey AS mac, 'OLDMK'||(c_custkey%4) AS manufacturers, 'OLDMD'||(c_custkey%7) AS model,
  '4.4' AS system_version, '10.1.0.'||(c_custkey%200) AS ip, 'OLDACC'||c_custkey AS user_account,
  {_CUSTOMER} AS uuid, 'android' AS os, '20240101' AS dt, 'HNYD' AS platform,
  'sdk' AS source_type FROM customer),
pool AS (SELECT * REPLACE ('{_DAY}' AS dt) FROM prev_pool)"""

ASSETS = """assets AS (SELECT CASE WHEN p_brand='Brand#3' THEN 'X' ELSE 'M' END||p_partkey AS media_id, 'UUID'||p_partkey AS uuid, p_name AS midianame,
  'YD'||p_partkey AS ydmedia, 'LT'||p_partkey AS ltmedia, 'AS'||(p_partkey%60) AS dxmedia,
  p_brand AS cp FROM part)"""

REVIEW = """review AS (SELECT CASE r_regionkey WHEN 1 THEN 'small' WHEN 2 THEN 'cat economy 1'
  ELSE lower(r_name) END AS word FROM region)"""

ONLINE = f"""online AS (SELECT DISTINCT user_id AS uuid, {pick(('14301', '14302', '14303', '14304'), 'k')} AS regionid,
  {day('real_s')} AS dt, {pick(('HNYD', 'HNLT', 'HNDX'), 'uid')} AS platform,
  CASE WHEN uid//3%2=1 THEN 'apk' WHEN uid%3=2 THEN 'c3' ELSE 'sdk' END AS source_type FROM ev)"""

# Events whose rendered device time is readable.
GOOD = "k NOT IN (17,19,34,36,51)"
