"""The same results in plain SQL, for checking the queries on another engine.

Two decimals are cut the way Spark cuts them: half up on the shortest decimal form of the double.
"""

from __future__ import annotations

from ..functions.rules import RETENTION_PATTERN
from ..operators.columns import MEASURE_WORDS, TIME_WORDS


def dec(x: str) -> str:
    return f"round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)),2)"


def r2(x: str) -> str:
    return f"CAST({dec(x)} AS DOUBLE)"


def two(x: str) -> str:
    """Text with exactly two decimals."""
    return f"CAST(CAST({dec(x)} AS DECIMAL(38,2)) AS VARCHAR)"


def rate(test: str) -> str:
    return r2(f"count(*) FILTER (WHERE {test})*100e0/count(*)")


def avg2(c: str) -> str:
    return f"coalesce({r2(f'CAST(sum({c}) AS DOUBLE)/nullif(count(*) FILTER (WHERE {c}<>0),0)')},0)"


def unset(c: str) -> str:
    return f"{c} IS NULL OR {c}='' OR lower({c})='unknown'"


def age(prefix: str, days: str, shown: str, limit: str = ">=100") -> str:
    return f"CASE WHEN {days}{limit} THEN '{prefix}100+Days' ELSE '{prefix}'||({shown})||'Days' END"


def important(kind="source_kind", q="queries", b="table_bytes", idle=20000, few=15000) -> str:
    return (
        f"(({kind}='raw_log' AND {q}>0) OR ({kind}<>'raw_log' AND {q}=0 AND {b}>={idle})"
        f" OR ({q} BETWEEN 1 AND 3 AND {b}>={few}) OR {q}>3 OR {kind}='shared_event')"
    )


SERIES = "CASE WHEN source_kind='shared_event' THEN name||'+'||event_id ELSE name END"

# metric name -> (class, SQL), per fact table
CELLS = {
    "items": {
        "row_num": ("rows", "count(*)"),
        "order_uid_num_poly2": ("uid", "count(*) FILTER (WHERE order_uid>0)"),
        "order_uid_rate_poly2": ("uid", rate("order_uid>0")),
        "part_id_num_poly3": ("num_id", "count(*) FILTER (WHERE part_id IS NULL OR part_id<=0)"),
        "part_id_rate_poly3": ("num_id", rate("part_id IS NULL OR part_id<=0")),
        "owner_id_num_poly2": ("uid", "count(*) FILTER (WHERE owner_id>0)"),
        "owner_id_rate_poly2": ("uid", rate("owner_id>0")),
        "line_cnt_sum_poly1": ("values", "coalesce(sum(line_cnt),0)"),
        "line_cnt_avg_poly1": ("values", avg2("line_cnt")),
        "quantity_num_sum_poly1": ("values", "coalesce(sum(quantity_num),0)"),
        "quantity_num_avg_poly1": ("values", avg2("quantity_num")),
        "price_sum_poly1": ("values", "coalesce(sum(price),0)"),
        "price_avg_poly1": ("values", avg2("price")),
        "off_pct_rate_poly3": ("attributes", rate("off_pct<=0")),
        "tax_rate_sum_poly1": ("values", "coalesce(sum(tax_rate),0)"),
        "tax_rate_avg_poly1": ("values", avg2("tax_rate")),
    },
    "sales": {
        "row_num": ("rows", "count(*)"),
        "order_id_num_poly3": ("num_id", "count(*) FILTER (WHERE order_id IS NULL OR order_id<=0)"),
        "order_id_rate_poly3": ("num_id", rate("order_id IS NULL OR order_id<=0")),
        "user_id_num_poly2": ("uid", "count(*) FILTER (WHERE user_id>0)"),
        "user_id_rate_poly2": ("uid", rate("user_id>0")),
        "total_amount_sum_poly1": ("values", "coalesce(sum(total_amount),0)"),
        "total_amount_avg_poly1": ("values", avg2("total_amount")),
    },
    "actions": {
        "row_num": ("rows", "count(*)"),
        "action_id_num_poly3": ("num_id", "count(*) FILTER (WHERE action_id IS NULL OR action_id<=0)"),
        "action_id_rate_poly3": ("num_id", rate("action_id IS NULL OR action_id<=0")),
        "user_id_num_poly2": ("uid", "count(*) FILTER (WHERE user_id>0)"),
        "user_id_rate_poly2": ("uid", rate("user_id>0")),
        "pay_cnt_sum_poly1": ("values", "coalesce(sum(pay_cnt),0)"),
        "pay_cnt_avg_poly1": ("values", avg2("pay_cnt")),
        "props_rate_poly3": ("attributes", rate(unset("props"))),
    },
}
DIMS = {
    "items": "'os:'||os||',region:'||region",
    "sales": "'area:'||area||',os:'||os",
    "actions": "'app:'||app",
}


CELLS["dw_sales"] = CELLS["sales"] | {f"{c}_rate_poly3": ("attributes", rate(unset(c))) for c in ("os", "area")}
DIMS["dw_sales"] = "''"


def long_profile(fact: str, by: str = "") -> str:
    cells = CELLS[fact]
    keys = f"{by}, dimension" if by else "dimension"
    wide = ", ".join(f"CAST({e} AS DOUBLE) AS {m}" for m, (_, e) in cells.items())
    each = ", ".join(
        f"{{'metric':'{m}','metric_class':'{k}','value':{m}}}" for m, (k, _) in cells.items()
    )
    return (
        f"SELECT {keys}, c.metric AS metric, c.metric_class AS metric_class, c.value AS value FROM ("
        f"SELECT {keys}, unnest([{each}]) AS c FROM ("
        f"SELECT {by + ',' if by else ''} {DIMS[fact]} AS dimension, {wide} FROM {fact} GROUP BY ALL))"
    )


def on_day(fact: str, table: str, day: str) -> str:
    return long_profile(fact).replace(f"FROM {fact} ", f"FROM {table} WHERE {day} ")


def sums(value: str, only: str, index: str = "i") -> str:
    y = f"CASE WHEN {only} THEN CAST({value} AS DOUBLE) END"
    iy = f"CASE WHEN {only} THEN CAST({index} AS DOUBLE)*CAST({value} AS DOUBLE) END"
    return (
        f"count({y}) AS n, sum({y}) AS sum_y, sum({iy}) AS sum_iy, stddev_samp({y}) AS sd, min({y}) AS min_y"
    )


def rolling(source: str, keys: str, value: str, days: int) -> str:
    """Sums over the preceding days of every row."""
    frame = (
        f"(PARTITION BY {keys} ORDER BY date_diff('day', DATE '1970-01-01', day)"
        f" RANGE BETWEEN {days} PRECEDING AND 1 PRECEDING)"
    )
    y = f"CAST({value} AS DOUBLE)"
    return f"""
      SELECT *, iy - i0*sum_y AS sum_iy FROM (
        SELECT *, count({y}) OVER {frame} AS n, sum({y}) OVER {frame} AS sum_y,
               sum(i*{y}) OVER {frame} AS iy, min(i) OVER {frame} AS i0,
               stddev_samp({y}) OVER {frame} AS sd, min({y}) OVER {frame} AS min_y
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY day) AS DOUBLE) AS i
              FROM {source}))"""


def bands(source: str, whole: bool) -> str:
    """Both bands, their union and its centre, from the sums."""
    def clip(x: str) -> str:
        low = f"{x}<=0" if whole else f"({x}<=0 AND min_y>=0)"
        return f"CASE WHEN isnan({x}) OR {low} THEN 0e0 ELSE {x} END"

    def shape(x: str) -> str:
        return f"trunc({clip(x)})" if whole else r2(clip(x))

    def one(x: str) -> str:
        return f"sum_y*{x}" if whole else r2(f"sum_y*{x}")

    def cases(many: str, single: str) -> str:
        return f"CASE WHEN n>1 THEN {shape(many)} WHEN n=1 THEN {one(single)} ELSE 0e0 END"

    lower = "least(std_lo, trend_lo)"
    lower = f"greatest({lower}, 0e0)" if whole else lower
    mid = "(band_lo+band_hi)/2"
    mid = f"CASE WHEN n>1 THEN floor({mid}) ELSE {mid} END" if whole else mid
    return f"""
      SELECT *, {mid} AS centre FROM (
      SELECT *, greatest(std_hi, trend_hi) AS band_hi, {lower} AS band_lo FROM (
      SELECT *, {cases('(mean+sd*2.5e0)', '1.7e0' if whole else '2e0')} AS std_hi,
             {cases('(mean-sd*2.5e0)', '0.3e0')} AS std_lo,
             {cases('(ahead*2e0)', '2e0')} AS trend_hi,
             {cases('(ahead*(1e0-0.7e0))', '(1e0-0.7e0)')} AS trend_lo FROM (
      SELECT *, CASE WHEN n>1 THEN sum_y/n END AS mean,
             CASE WHEN n>1 THEN (2e0*(3e0*sum_iy-(n-1)*sum_y))/(CAST(n AS DOUBLE)*(n-1)) END AS ahead
      FROM {source})))"""


def share(v: str, total: str) -> str:
    part = f"abs({r2(f'{v}*100e0/nullif({total},0)')})"
    return f"coalesce(CASE WHEN {total}<>0 THEN {part} END, 0e0)"


KIND = """CASE WHEN name='click' THEN 'shared_event' WHEN name LIKE 'purchase%' THEN 'raw_log'
          WHEN name LIKE 'signup%' THEN 'db_export' ELSE 'event' END"""

CTE = {
    "items": """SELECT l_orderkey AS order_uid, l_partkey AS part_id, l_suppkey AS owner_id,
        l_linenumber AS line_cnt, l_quantity AS quantity_num,
        CAST(round(l_extendedprice*100) AS BIGINT) AS price, l_discount AS off_pct,
        CAST(round(l_tax*100) AS BIGINT) AS tax_rate, l_returnflag AS region, l_linestatus AS os,
        CAST(l_shipdate AS DATE) AS day FROM lineitem""",
    "sales": """SELECT o_orderkey AS order_id, o_custkey AS user_id,
        CAST(round(o_totalprice*100) AS BIGINT) AS total_amount, o_orderstatus AS os,
        o_orderpriority AS area, CAST(o_orderdate AS DATE) AS day FROM orders""",
    "actions": """SELECT event_id AS action_id, user_id, event_type AS app,
        CAST(round(value*100) AS BIGINT) AS pay_cnt, props, CAST(ts AS DATE) AS day FROM events""",
    "opened": """SELECT DISTINCT CASE WHEN event_type='click' THEN 'click' ELSE event_type||'_'||user_id END AS name,
        CASE WHEN event_type='click' THEN CAST(user_id AS VARCHAR) ELSE '' END AS event_id, CAST(ts AS DATE) AS day FROM events""",
    "edays": """SELECT name, event_id, day, CAST(sum(length) AS BIGINT) AS bytes FROM (
          SELECT name, event_id, day, length FROM files UNION ALL SELECT name, event_id, day, 0 FROM opened) GROUP BY ALL""",
    "files": """SELECT *, '/logs/'||name||'/day='||strftime(ts,'%Y-%m-%d')||'/hour='||strftime(ts,'%H')
          ||CASE WHEN event_id<>'' THEN '/event_id='||event_id ELSE '' END||'/part-'||id||'.orc' AS path
        FROM (SELECT CASE WHEN event_type='click' THEN 'click' ELSE event_type||'_'||user_id END AS name,
          CASE WHEN event_type='click' THEN CAST(user_id AS VARCHAR) ELSE '' END AS event_id,
          event_id AS id, ts, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour,
          octet_length(encode(props))+CAST(round(value*100) AS BIGINT) AS length
          FROM events WHERE value IS NULL OR NOT value<0.5)""",
    "watched": f"""SELECT name, event_id, {KIND} AS source_kind, '/logs/'||name AS path,
        CASE WHEN name='click' THEN 'normal' WHEN right(name,1)='9' THEN 'EmptyTable'
          WHEN right(name,1)='8' THEN 'TaskStop4Days' WHEN right(name,1)='7' THEN 'TaskStop100+Days'
          ELSE 'normal' END AS status,
        CAST(sum(length) AS BIGINT) AS table_bytes, count(*)%9 AS queries,
        CASE WHEN name LIKE 'signup%' AND right(name,1) IN ('0','1') THEN ''
          WHEN name LIKE 'signup%' AND right(name,1) IN ('2','3') THEN 'month'
          WHEN name='click' THEN 'day,hour,event_id'
          WHEN right(name,1) IN ('0','1','2','3','4') THEN 'day,hour' ELSE 'day' END AS partition_keys
        FROM files GROUP BY name, event_id""",
    "measured": f"""SELECT name, event_id, {KIND} AS source_kind,
        CASE WHEN day(day)<4 THEN '/old/'||name ELSE '/new/'||name END AS path, file_bytes,
        CASE WHEN file_bytes<300 AND name NOT LIKE 'purchase%' THEN 'CutOff1Days' ELSE 'normal' END AS status,
        file_bytes*30 AS table_bytes, queries, 'day' AS partition_keys, day
        FROM (SELECT name, event_id, day, count(*) AS queries,
          CAST(sum(CASE WHEN length<500 THEN 0 ELSE length END) AS BIGINT) AS file_bytes
          FROM files GROUP BY name, event_id, day)""",
    "listed": f"SELECT {SERIES} AS series FROM watched WHERE queries=3",
    "moved": """SELECT name FROM measured WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
        AND source_kind='event' GROUP BY name
        HAVING bool_or(path LIKE '%/old/%') AND bool_or(path LIKE '%/new/%')""",
    "vhist": f"""SELECT name, event_id, source_kind, day, file_bytes,
        date_diff('day', DATE '1970-01-01', day)*86400 AS update_time, table_bytes, queries,
        day<DATE '2024-01-30' AS is_history,
        day<DATE '2024-01-30' AND NOT (source_kind='raw_log'
          AND date_diff('day', day, DATE '2024-01-30')>3 AND file_bytes=0) AS is_sample
        FROM measured WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' AND status='normal'
        AND NOT regexp_matches(name,'error_3') AND {SERIES} NOT IN (SELECT series FROM listed)
        AND NOT (name IN (SELECT name FROM moved) AND path LIKE '%/old/%')""",
    "vsums": f"""SELECT name, event_id, source_kind,
        max(CASE WHEN NOT is_history THEN file_bytes END) AS file_bytes,
        max(CASE WHEN NOT is_history THEN table_bytes END) AS table_bytes,
        max(CASE WHEN NOT is_history THEN queries END) AS queries,
        count(*) FILTER (WHERE is_history) AS history_days,
        arg_min(table_bytes, day) FILTER (WHERE is_sample) AS first_bytes, {sums('file_bytes','is_sample')}
        FROM (SELECT *, row_number() OVER (PARTITION BY name, event_id, source_kind
                ORDER BY is_sample DESC, day)-1 AS i FROM vhist)
        GROUP BY name, event_id, source_kind""",
    "vscored": bands("vsums", True),
    "vflagged": """SELECT *, CASE
        WHEN file_bytes IS NOT NULL AND history_days>0 AND (file_bytes<band_lo OR file_bytes>band_hi
          OR (file_bytes=0 AND centre>1000)) THEN 'changed'
        WHEN file_bytes IS NULL AND (CASE WHEN n>1 THEN floor((trend_lo+trend_hi)/2)
          ELSE (trend_lo+trend_hi)/2 END)>1000 THEN 'missing' END AS flag FROM vscored""",
    "vevidence": f"""SELECT {SERIES} AS name, source_kind, flag,
          CASE WHEN flag='missing' THEN 0 ELSE file_bytes END AS file_bytes, 1706572800 AS update_time,
          CASE WHEN flag='missing' THEN first_bytes ELSE table_bytes END AS table_bytes,
          CASE WHEN flag='missing' THEN 0 ELSE queries END AS queries, DATE '2024-01-30' AS day
        FROM vflagged WHERE flag IS NOT NULL
        UNION ALL
        SELECT CASE WHEN f.source_kind='shared_event' THEN f.name||'+'||f.event_id ELSE f.name END,
          f.source_kind, flag, h.file_bytes, h.update_time,
          CASE WHEN flag='missing' THEN h.table_bytes ELSE f.table_bytes END,
          CASE WHEN flag='missing' THEN h.queries ELSE f.queries END, DATE '2024-01-30'
        FROM vflagged f JOIN vhist h ON f.name=h.name AND f.event_id=h.event_id
          AND f.source_kind=h.source_kind AND h.is_sample WHERE flag IS NOT NULL""",
    "cutrows": f"""SELECT {SERIES} AS name, source_kind, status, table_bytes*50 AS table_bytes, queries, day
        FROM measured WHERE status<>'normal'""",
    "report": f"""SELECT f.*, CASE WHEN f.source_kind='raw_log' THEN '/logs/'||f.name ELSE w.path END AS path,
          w.table_bytes, w.queries, coalesce(t.topic,'') AS topic
        FROM (SELECT 'cutoff' AS flag, source_kind, name, status AS detail, day FROM cutrows
            WHERE day BETWEEN DATE '2024-01-29' AND DATE '2024-01-30' AND {important()}
          UNION ALL
          SELECT 'fluctuation', source_kind, name,
            CAST(max(CASE WHEN update_time=1706572800 THEN file_bytes ELSE 0 END) AS VARCHAR), max(day)
          FROM vevidence WHERE name NOT IN (SELECT name FROM cutrows WHERE day=DATE '2024-01-30')
          GROUP BY source_kind, name) f
        JOIN (SELECT source_kind, {SERIES} AS name, path, table_bytes, queries FROM watched
              WHERE {important()}) w USING (source_kind, name)
        LEFT JOIN (SELECT DISTINCT event_type||'_'||user_id AS name, 'topic_'||(event_id%2) AS topic
              FROM events) t ON f.name=t.name""",
    "odays": """SELECT 'nation_'||c_nationkey AS name, o_orderpriority AS event_id,
        CAST(o_orderdate AS DATE) AS day,
        CAST(sum(CASE WHEN o_totalprice>=250000 THEN CAST(round(o_totalprice*100) AS BIGINT) ELSE 0 END) AS BIGINT) AS bytes
        FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY ALL""",
    "gaps": f"""SELECT name, event_id, file_bytes, total_bytes, empty_since, last_day,
        CASE WHEN file_bytes>0 THEN 'normal'
          WHEN empty_since IS NOT NULL THEN {age('CutOff', "date_diff('day', empty_since, DATE '2001-07-20')", "date_diff('day', empty_since, DATE '2001-07-20')+1")}
          WHEN last_day<DATE '2001-07-20' THEN {age('TaskStop', "date_diff('day', last_day, DATE '2001-07-20')", "date_diff('day', last_day, DATE '2001-07-20')+1")}
          ELSE 'normal' END AS status
        FROM (SELECT name, event_id,
            CAST(sum(CASE WHEN day=DATE '2001-07-20' THEN bytes ELSE 0 END) AS BIGINT) AS file_bytes,
            CAST(sum(bytes) AS BIGINT) AS total_bytes,
            min(CASE WHEN bytes=0 AND (lastfull IS NULL OR day>lastfull) THEN day END) AS empty_since,
            max(day) AS last_day
          FROM (SELECT *, max(CASE WHEN bytes>0 THEN day END) OVER (PARTITION BY name, event_id) AS lastfull
                FROM odays WHERE day<=DATE '2001-07-20') GROUP BY name, event_id)""",
    "egaps": f"""SELECT name, event_id, file_bytes, total_bytes, empty_since,
        CASE WHEN file_bytes>0 THEN 'normal'
          WHEN empty_since IS NOT NULL THEN {age('CutOff', "date_diff('day', empty_since, DATE '2024-01-30')", "date_diff('day', empty_since, DATE '2024-01-30')+1")}
          WHEN last_day<DATE '2024-01-30' THEN {age('TaskStop', "date_diff('day', last_day, DATE '2024-01-30')", "date_diff('day', last_day, DATE '2024-01-30')+1")}
          ELSE 'normal' END AS status
        FROM (SELECT name, event_id,
            CAST(sum(CASE WHEN day=DATE '2024-01-30' THEN bytes ELSE 0 END) AS BIGINT) AS file_bytes,
            CAST(sum(bytes) AS BIGINT) AS total_bytes,
            min(CASE WHEN bytes=0 AND (lastfull IS NULL OR day>lastfull) THEN day END) AS empty_since,
            max(day) AS last_day
          FROM (SELECT *, max(CASE WHEN bytes>0 THEN day END) OVER (PARTITION BY name, event_id) AS lastfull
                FROM edays WHERE day<=DATE '2024-01-30') GROUP BY name, event_id)""",
    "fresh": f"""SELECT name, event_id, file_bytes, CASE WHEN a>=100 THEN 'CutOff100+Days'
          WHEN a>0 OR (a=0 AND strftime(written,'%H:%M')<='09:00') THEN 'CutOff'||(a+1)||'Days'
          ELSE 'normal' END AS status
        FROM (SELECT name, event_id, CAST(sum(length) AS BIGINT) AS file_bytes, max(ts) AS written,
          date_diff('day', CAST(max(ts) AS DATE), DATE 'ASOF') AS a FROM files GROUP BY name, event_id)""",
    "daily": """SELECT name, event_id, source_kind,
          CASE WHEN measured AND NOT unpart AND NOT monthly AND shown IS NOT NULL
            THEN path||'/day='||CAST(shown AS VARCHAR) ELSE path END AS path,
          file_bytes, CASE WHEN NOT measured THEN status WHEN unpart THEN coalesce(fstatus,'PartitionNotExists')
            WHEN monthly THEN 'MonthPartition' ELSE coalesce(gstatus,'PartitionNotExists') END AS status,
          CASE WHEN source_kind='shared_event' THEN coalesce(total_bytes,0) ELSE table_bytes END AS table_bytes,
          queries, partition_keys, DATE '2024-01-30' AS day
        FROM (SELECT *, CASE WHEN file_bytes>0 THEN DATE '2024-01-30' ELSE empty_since END AS shown
        FROM (SELECT *, coalesce(CASE WHEN measured AND unpart THEN fbytes
            WHEN measured AND NOT monthly THEN gbytes END, 0) AS file_bytes
        FROM (SELECT w.*, g.file_bytes AS gbytes, g.total_bytes, g.empty_since, g.status AS gstatus,
            f.file_bytes AS fbytes, f.status AS fstatus,
            (w.status IN ('normal','TaskStop4Days') OR source_kind='raw_log') AS measured,
            (source_kind='db_export' AND partition_keys='') AS unpart,
            (source_kind='db_export' AND partition_keys LIKE '%mon%') AS monthly
          FROM watched w LEFT JOIN egaps g USING (name, event_id) LEFT JOIN fresh f USING (name, event_id))))""",
    "parts": """SELECT p_partkey, brand||'.'||bare AS name, bare, p_brand AS owner,
          CASE WHEN p_size=50 THEN '' ELSE 'g'||p_partkey END AS guid,
          CASE WHEN p_size=49 THEN 0 ELSE CAST(round(p_retailprice*100) AS BIGINT)*CAST(pow(8,p_size%7) AS BIGINT) END AS bytes,
          p_partkey%6 AS queries, 1000000000000-((p_partkey*7)%3000)*3600000 AS updated_ms,
          CASE WHEN p_size%3=0 THEN '' ELSE p_name END AS real_owner,
          '/warehouse/'||brand||'/'||CASE WHEN p_size%5=0 THEN 'build_tmp1' ELSE bare END AS location,
          CASE p_size%4 WHEN 0 THEN '' WHEN 1 THEN 'day' WHEN 2 THEN 'Day,Hour' ELSE 'month' END AS partition_keys,
          '/warehouse/'||brand||'/'||bare AS repaired
        FROM (SELECT *, replace(lower(p_brand),'#','_') AS brand,
          CASE WHEN p_size%10=0 THEN 'tmp_' ELSE 't_' END||lower(p_type)||'_'||p_partkey AS bare FROM part)""",
    "edges": """SELECT name, 'app.s'||l_suppkey AS target_name,
          CASE WHEN s_nationkey=0 THEN '' ELSE 'Team'||s_nationkey END AS owner,
          CASE WHEN l_linenumber>5 THEN 2 ELSE 1 END AS depth, CAST(l_shipdate AS DATE) AS updated
        FROM lineitem JOIN supplier ON l_suppkey=s_suppkey JOIN parts ON l_partkey=p_partkey""",
    "trend": """SELECT name, CAST(l_shipdate AS DATE) AS day,
          CAST(sum(CAST(round(l_extendedprice*100) AS BIGINT)) AS BIGINT) AS bytes
        FROM lineitem JOIN parts ON l_partkey=p_partkey GROUP BY ALL""",
    "pcolumns": """SELECT DISTINCT name, lower(l_returnflag)||CASE l_linenumber WHEN 1 THEN '_uid' WHEN 2 THEN '_id'
            WHEN 3 THEN '_cnt' WHEN 4 THEN '_day' ELSE '_name' END AS column_name,
          CASE WHEN l_linestatus='O' THEN 'string' ELSE 'bigint' END AS column_type
        FROM lineitem JOIN parts ON l_partkey=p_partkey""",
    "exports": """SELECT 'db'||lower(o_orderstatus)||'. cust_'||o_custkey AS name, o_orderpriority AS topic_name
        FROM orders WHERE left(o_orderpriority,1)='3' AND o_orderstatus='F'""",
    "configs": """SELECT trim(lower(p_brand||'.'||p_type||'_'||p_size)) AS name, p_name AS final_topic
        FROM part WHERE p_size<>1 AND p_type<>'PROMO'""",
    "store": f"""SELECT 'shop.sales_'||lower(right(dimension,1)) AS name, *
        FROM ({long_profile('sales', 'day')})""",
    "launched": """SELECT * FROM store UNION ALL
        SELECT name, day, dimension, 'launch_sum_poly1', 'values', value FROM store
        WHERE metric='row_num' AND day=DATE '2001-07-26'""",
    "hours": f"""SELECT 'event' AS source_kind, name, file_bytes, day, hour,
          date_diff('day', DATE '1970-01-01', day)*86400+hour*3600 AS update_time
        FROM (SELECT *, sum(file_bytes) OVER (PARTITION BY name)/count(*) OVER (PARTITION BY name) AS usual
          FROM (SELECT split_part(name,'_',1) AS name, day, hour, CAST(sum(length) AS BIGINT) AS file_bytes
                FROM files GROUP BY ALL)) WHERE file_bytes>usual""",
    "returns": """SELECT day, 'users_re'||lag||'_sum_poly1' AS metric, count(*) AS value FROM (
          SELECT a.user_id, a.day, l.lag FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events) a
          JOIN (VALUES (1),(3),(7)) l(lag) ON true
          JOIN (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events) b
            ON a.user_id=b.user_id AND b.day=a.day+CAST(l.lag AS INTEGER)) GROUP BY day, lag
        UNION ALL SELECT CAST(ts AS DATE), 'row_num', count(DISTINCT user_id) FROM events GROUP BY 1""",
}


def median(c: str) -> str:
    """Half of the lower plus half of the upper middle value of the history."""
    y = f"list_sort(list({c}) FILTER (WHERE NOT now AND {c} IS NOT NULL))"
    k = f"count({c}) FILTER (WHERE NOT now)"
    return f"(0.5e0*{y}[({k}+1)//2]+0.5e0*{y}[{k}//2+1])"


def shared_metrics(source: str) -> dict[str, str]:
    """Steps from a metric store to flagged series."""
    return {
        "shares": f"""SELECT *, {share('value','total_value')} AS value_share, {share('row_num','total_rows')} AS row_share
            FROM (SELECT *, sum(value) OVER (PARTITION BY day, name, metric) AS total_value,
              max(CASE WHEN metric='row_num' THEN value END) OVER (PARTITION BY day, dimension) AS row_num,
              sum(CASE WHEN metric='row_num' THEN value END) OVER (PARTITION BY day, name) AS total_rows
              FROM {source})""",
        "kept": """SELECT * FROM shares WHERE day<=DATE '2001-07-26' AND dimension IN (
              SELECT dimension FROM shares WHERE day<=DATE '2001-07-26' GROUP BY dimension
              HAVING count(DISTINCT day)>=5)
            AND name IN (SELECT name FROM shares WHERE day=DATE '2001-07-26')""",
        "msums": f"""SELECT name, dimension, metric,
              max(CASE WHEN now THEN value END) AS value, max(CASE WHEN now THEN value_share END) AS value_share,
              max(CASE WHEN now THEN row_share END) AS row_share, max(CASE WHEN now THEN row_num END) AS row_num,
              {r2(median('value_share'))} AS usual_value_share,
              {r2(median('row_share'))} AS usual_row_share,
              max(metric_class) AS metric_class, {sums('value', 'NOT now')}
            FROM (SELECT *, day=DATE '2001-07-26' AS now,
              row_number() OVER (PARTITION BY dimension, metric ORDER BY day)-1 AS i FROM kept)
            GROUP BY name, dimension, metric""",
        "mscored": bands("msums", False),
        "mflagged": """SELECT * FROM (SELECT *, CASE
              WHEN gated AND n>0 AND (value<band_lo OR value>band_hi) THEN 'out_of_band'
              WHEN gated AND n=0 AND value<>0 THEN 'new'
              WHEN value IS NULL AND n>0 AND centre<>0 THEN 'missing' END AS flag
            FROM (SELECT *, coalesce(value IS NOT NULL AND value_share>3
              AND NOT (metric LIKE '%rate\\_poly3%' ESCAPE '\\' AND value<0.5)
              AND NOT (metric LIKE '%num\\_poly3%' ESCAPE '\\' AND value<1), false) AS gated FROM mscored))
            WHERE flag IS NOT NULL""",
        "mevidence": """SELECT name, dimension, metric, metric_class, flag, DATE '2001-07-26' AS at_day,
              CASE WHEN flag='missing' THEN 0 ELSE value END AS value FROM mflagged
            UNION ALL SELECT name, dimension, metric, metric_class, flag, DATE '2001-07-26'-CAST(b AS INTEGER), 0
              FROM mflagged, range(1,31) r(b) WHERE flag='new'
            UNION ALL SELECT f.name, f.dimension, f.metric, f.metric_class, flag, k.day, k.value
              FROM mflagged f JOIN kept k ON f.dimension=k.dimension AND f.metric=k.metric
              AND k.day<DATE '2001-07-26'""",
    }


def sql(body: str, *ctes: str, extra: dict[str, str] | None = None) -> str:
    parts = {c: CTE[c] for c in ctes} | (extra or {})
    head = ",\n".join(f"{k} AS ({v})" for k, v in parts.items())
    return f"WITH {head}\n{body}" if parts else body


def _column_class() -> str:
    t = "column_type"
    num = f"{t} IN ('float','int','bigint','double')"
    return f"""CASE
      WHEN (ends_with(column_name,'day') AND {t}='string') OR column_name IN ('days','time')
        OR regexp_matches(column_name,'{TIME_WORDS}') OR regexp_matches({t},'array|map|struct') THEN 'not_monitor'
      WHEN app_name<>'dw' AND {t}='string'
        AND column_name IN ('os','fin_region','region','area','op_area','app','app_name') THEN 'main_dimension'
      WHEN column_name IN ('user_id','owner_id','author_id','creator','uid64')
        OR (ends_with(column_name,'uid') AND column_name<>'guid') THEN 'uid'
      WHEN ends_with(column_name,'id') THEN CASE WHEN {t}='string' THEN 'string_id' ELSE 'num_id' END
      WHEN {num} AND (regexp_matches(column_name,'{MEASURE_WORDS}') OR ends_with(column_name,'stay_time')
        OR ends_with(column_name,'staytime') OR ends_with(column_name,'times')) THEN 'values'
      ELSE 'attributes' END"""


def _fmt_number(v: str) -> str:
    return f"""CASE WHEN {v}>=1e8 THEN {two(f'{v}/1e8')}||'亿' WHEN {v}>=1e4 THEN {two(f'{v}/1e4')}||'万'
      ELSE regexp_replace({two(v)},'\\.00$','') END"""


def _fmt_bytes(b: str) -> str:
    return f"""CASE WHEN {b}>=1099511627776 THEN {two(f'{b}/1099511627776e0')}||'Tb'
      WHEN {b}>=1073741824 THEN {two(f'{b}/1073741824e0')}||'Gb'
      WHEN {b}>=1048576 THEN {two(f'{b}/1048576e0')}||'Mb' ELSE {two(f'{b}/1024e0')}||'Kb' END"""


def _fmt_file(b: str) -> str:
    def unit(scale: str, name: str) -> str:
        return f"CAST({r2(f'{b}/{scale}')} AS VARCHAR)||'{name}'"

    return f"""CASE WHEN {b}>=1073741824 THEN {unit('1073741824e0','Gb')}
      WHEN {b}>=1048576 THEN {unit('1048576e0','Mb')} ELSE {unit('1024e0','kb')} END"""


VOL = ("files", "watched", "measured", "listed", "moved", "vhist")
SCORED = (*VOL, "vsums", "vscored")
FLAGGED = (*SCORED, "vflagged")
REPORT = (*FLAGGED, "vevidence", "cutrows", "report")
LAUNCH = shared_metrics("launched")
STORE = shared_metrics("store")
DAILY_FRESH = {"fresh": CTE["fresh"].replace("ASOF", "2024-01-30"), "daily": CTE["daily"]}

RERUNS = sql(
    """SELECT day, dimension, CASE WHEN run_flag='else' THEN value+1 WHEN year(day)=1995 THEN value*2 ELSE value END AS value,
         run_flag, RUN_DAY AS run_day
       FROM store, (SELECT unnest(['early','else']) AS run_flag) WHERE metric='row_num' AND NOT (run_flag='else' AND year(day)=1996)""",
    "sales", "store")

ORACLE: dict[str, str] = {
    "norm_name": """SELECT p_partkey, trim(lower(p_brand||'.'||p_type)) AS name, trim(lower(p_name)) AS bare FROM part""",
    "exclude_names": sql(
        """SELECT p_partkey, name FROM parts WHERE split_part(name,'.',1) NOT IN ('brand_1','brand_7')
           AND name NOT LIKE '%promo%'""", "parts"),
    "series_identity": sql(f"SELECT {SERIES} AS series, source_kind FROM watched", "files", "watched"),
    "repaired_paths": sql("SELECT name, repaired AS path FROM parts", "parts"),
    "path_parts": sql("SELECT path, name, event_id, day, hour, length FROM files", "files"),
    "important_tables": sql(
        f"SELECT source_kind, {SERIES} AS name, path, table_bytes, queries FROM watched WHERE {important()}",
        "files", "watched"),
    "run_split": sql(
        """SELECT name, update_clock, CASE WHEN update_clock<'07:00:00' OR lower(partition_keys) LIKE '%hour%'
             THEN 'early' ELSE 'else' END AS run_flag
           FROM (SELECT name, partition_keys, strftime(epoch_ms(updated_ms),'%H:%M:%S') AS update_clock FROM parts)""",
        "parts"),
    "catalog_admission": sql(
        """SELECT name, bytes, queries FROM parts WHERE regexp_matches(split_part(name,'.',1),'brand_[1-9]')
           AND NOT regexp_matches(bare,'temp|tmp') AND bytes>0 AND queries>0
           AND date_diff('day', CAST(epoch_ms(updated_ms) AS DATE), DATE '2001-09-09')<=60""", "parts"),
    "inventory_sources": sql(
        """SELECT * FROM (SELECT DISTINCT name, 'db_export' AS source_kind, '' AS event_id FROM exports
           UNION SELECT DISTINCT name, 'event', '' FROM configs
           UNION SELECT DISTINCT lower(l_returnflag)||'.'||lower(l_linestatus), 'shared_event', CAST(l_suppkey AS VARCHAR) FROM lineitem)
           WHERE split_part(name,'.',1) NOT IN ('brand#3','brand#21') AND name NOT LIKE '%promo%'""",
        "exports", "configs"),
    "catalog_status": sql(
        f"""SELECT name, '' AS event_id, 'event' AS source_kind, repaired AS path,
            CASE WHEN guid='' THEN 'NotFound' WHEN bytes<=0 THEN 'EmptyTable'
              WHEN a>=2 THEN {age('TaskStop', 'a', 'a', '>100')} ELSE 'normal' END AS status,
            bytes AS table_bytes, queries, partition_keys
          FROM (SELECT *, date_diff('day', CAST(epoch_ms(updated_ms) AS DATE), DATE '2001-09-09') AS a FROM parts)
          UNION ALL SELECT DISTINCT lower(l_returnflag)||'.'||lower(l_linestatus), '', 'event', '', 'NotFound', 0, 0, ''
          FROM lineitem""", "parts"),
    "usage_by_path": """WITH audit AS (
          SELECT '/data/logs/'||split_part(url,'/',3) AS directory, 'application_170_'||lpad(CAST(page_id%997 AS VARCHAR),4,'0') AS app_id,
            CASE WHEN url LIKE 'https%' THEN DATE '2024-01-02' ELSE DATE '2024-01-03' END AS day FROM pages)
        SELECT split_part(directory,'/',-1) AS name, count(DISTINCT app_id) AS queries FROM audit
        WHERE app_id NOT IN (SELECT 'application_170_'||lpad(CAST(doc_id%997 AS VARCHAR),4,'0') FROM labels WHERE toxic=1)
        GROUP BY 1""",
    "usage_two_logs": """WITH audit AS (
          SELECT split_part(url,'/',3) AS name, page_id, page_id%997 AS app,
            CASE WHEN url LIKE 'https%' THEN DATE '2024-01-02' ELSE DATE '2024-01-03' END AS day FROM pages)
        SELECT name, count(DISTINCT app) AS queries FROM audit WHERE (page_id%10<>1 OR day=DATE '2024-01-02')
          AND app NOT IN (SELECT doc_id%997 FROM labels WHERE toxic=1 AND doc_id%997%10=0) GROUP BY name""",
    "usage_windows": """WITH audit AS (
          SELECT split_part(url,'/',3) AS name, page_id%997 AS app,
            CASE WHEN url LIKE 'https%' THEN DATE '2024-01-02' ELSE DATE '2024-01-03' END
              - CAST(length('/data/logs/'||split_part(url,'/',3)||'/day=2024-01-01/part-'||page_id)%4 AS INTEGER) AS day FROM pages),
        ends AS (SELECT DISTINCT a.name, a.day + CAST(i AS INTEGER) AS day, d AS days
          FROM audit a, range(0,3) r(i), range(1,4) s(d) WHERE i<d)
        SELECT e.name, e.day, CAST(e.days AS INTEGER) AS days, count(DISTINCT a.app) AS queries FROM ends e
        JOIN audit a ON a.name=e.name AND a.day>e.day-CAST(e.days AS INTEGER) AND a.day<=e.day
        WHERE e.day<=DATE '2024-01-03' GROUP BY ALL""",
    "recent_usage": sql(
        """SELECT name, CAST(max(queries) AS BIGINT) AS queries FROM (
             SELECT name, sum(queries) AS queries FROM measured WHERE source_kind='raw_log' AND day=DATE '2024-01-30' GROUP BY name
             UNION ALL SELECT DISTINCT name, 0 FROM measured WHERE source_kind='raw_log' AND queries>2
               AND day<DATE '2024-01-30') GROUP BY name""",
        "files", "measured"),
    "usage_admission": sql(
        """SELECT name, 'raw_log' AS source_kind, '/logs/'||name AS path, 'normal' AS status, table_bytes,
             CASE WHEN used THEN 5 ELSE 0 END AS queries, 'day' AS partition_keys
           FROM (SELECT name, CAST(sum(length) AS BIGINT) AS table_bytes, name IN (SELECT name FROM measured
               WHERE source_kind='raw_log' AND queries>2 AND day<DATE '2024-01-30') AS used FROM files GROUP BY name)
           WHERE used OR table_bytes>=120000""", "files", "measured"),
    "table_mentions": r"""WITH words AS (SELECT DISTINCT unnest(string_split_regex(lower(text),'[^a-z]+')) AS name FROM benchmark),
        tokens AS (SELECT DISTINCT unnest(string_split(regexp_replace(regexp_replace(lower(text),'--.*?\n',' ','g'),'(\n|\t)',' ','g'),' ')) AS name
          FROM documents WHERE lang<>'de' AND source NOT IN ('src3','src7'))
        SELECT name FROM tokens WHERE name<>'' AND name IN (SELECT name FROM words)""",
    "prefer_source": """WITH r AS (
          SELECT 'dw' AS app_name, lower(CASE WHEN p_size%3=0 THEN '' ELSE p_name END) AS name, 'dw' AS table_source, 1 AS prefer FROM part
          UNION ALL SELECT lower(p_brand), p_name, lower(p_type), 2 FROM part)
        SELECT app_name, name, table_source FROM (SELECT *, row_number() OVER (PARTITION BY name
            ORDER BY prefer DESC, app_name DESC, table_source DESC) AS rn FROM r
          WHERE name<>'' AND name NOT IN (SELECT p_name FROM part WHERE p_name LIKE 'hot %')) WHERE rn=1""",
    "downstream_owners": sql(
        """SELECT name, string_agg(owner, ',' ORDER BY owner) AS downstream FROM (SELECT DISTINCT name, lower(owner) AS owner
           FROM edges WHERE depth=1 AND owner<>'' AND updated>=DATE '1998-06-13' AND updated<>DATE '1970-01-01') GROUP BY name""",
        "parts", "edges"),
    "downstream_counts": sql(
        """SELECT name, count(DISTINCT target_name) AS downstream_tables FROM edges
           WHERE depth=1 AND updated>=DATE '1998-06-13' GROUP BY name""", "parts", "edges"),
    "avg_day_bytes": sql(
        """SELECT name, p.bytes AS table_bytes, partition_keys, CASE WHEN t.n>0 THEN CAST(floor(t.s/t.n) AS BIGINT)
             WHEN partition_keys LIKE '%day%' THEN coalesce(y.s,0) ELSE p.bytes END AS day_bytes
           FROM parts p
           LEFT JOIN (SELECT name, CAST(sum(bytes) AS DOUBLE) AS s, count(*) AS n FROM trend
             WHERE day BETWEEN DATE '2001-07-01'-2500 AND DATE '2001-07-01' GROUP BY name) t USING (name)
           LEFT JOIN (SELECT name, CAST(sum(bytes) AS BIGINT) AS s FROM trend WHERE day=DATE '2001-06-30' GROUP BY name) y USING (name)""",
        "parts", "trend"),
    "effective_day": sql(
        """SELECT name, partition_keys, CASE WHEN partition_keys='day' AND date_diff('day', d, DATE '2001-07-01')>1
             THEN DATE '2001-06-30' ELSE DATE '2001-07-01' END AS read_day
           FROM parts LEFT JOIN (SELECT name, max(day) AS d FROM trend
             WHERE day BETWEEN DATE '2001-05-31' AND DATE '2001-07-01' GROUP BY name) USING (name)""",
        "parts", "trend"),
    "column_catalog": sql(
        """SELECT b.name, app_name, 'listed' AS table_source, owner, update_clock, b.partition_keys, table_bytes, queries,
             day_bytes, read_day, downstream, column_name, column_type, '' AS column_comment, DATE '2001-09-09' AS day
           FROM (SELECT p.name, CASE WHEN p_partkey%2=0 THEN 'dw' ELSE 'shop' END AS app_name,
               CASE WHEN real_owner<>'' THEN real_owner ELSE p.owner END AS owner,
               strftime(epoch_ms(updated_ms),'%H:%M:%S') AS update_clock, lower(partition_keys) AS partition_keys,
               p.bytes AS table_bytes, queries,
               CASE WHEN t.n>0 THEN CAST(floor(t.s/t.n) AS BIGINT) WHEN lower(partition_keys) LIKE '%day%' THEN coalesce(y.s,0)
                 ELSE p.bytes END AS day_bytes,
               CASE WHEN lower(partition_keys)='day' AND date_diff('day', l.d, DATE '2001-09-09')>1 THEN DATE '2001-09-08'
                 ELSE DATE '2001-09-09' END AS read_day, coalesce(o.downstream,'') AS downstream
             FROM parts p
             LEFT JOIN (SELECT name, CAST(sum(bytes) AS DOUBLE) AS s, count(*) AS n FROM trend
               WHERE day BETWEEN DATE '2001-09-02' AND DATE '2001-09-09' GROUP BY name) t USING (name)
             LEFT JOIN (SELECT name, CAST(sum(bytes) AS BIGINT) AS s FROM trend WHERE day=DATE '2001-09-08' GROUP BY name) y USING (name)
             LEFT JOIN (SELECT name, max(day) AS d FROM trend WHERE day BETWEEN DATE '2001-08-09' AND DATE '2001-09-09' GROUP BY name) l USING (name)
             LEFT JOIN (SELECT name, string_agg(owner, ',' ORDER BY owner) AS downstream FROM (SELECT DISTINCT name, lower(owner) AS owner
               FROM edges WHERE depth=1 AND owner<>'' AND updated>=DATE '2001-09-09'-60) GROUP BY name) o USING (name)
             WHERE date_diff('day', CAST(epoch_ms(updated_ms) AS DATE), DATE '2001-09-09')<=60) b
           JOIN pcolumns c ON b.name=c.name
           WHERE NOT (app_name='dw' AND downstream='') AND day_bytes>0""",
        "parts", "edges", "trend", "pcolumns"),
    "classify_columns": f"""WITH w AS (SELECT DISTINCT lang, unnest(string_split_regex(lower(text),'[^a-z0-9_]+')) AS column_name FROM documents),
        t AS (SELECT *, CASE length(column_name)%5 WHEN 0 THEN 'string' WHEN 1 THEN 'bigint' WHEN 2 THEN 'double'
            WHEN 3 THEN 'array<int>' ELSE 'decimal(10,2)' END AS column_type,
            CASE WHEN lang='en' THEN 'dw' ELSE 'shop' END AS app_name FROM w WHERE column_name<>'')
        SELECT lang, column_name, column_type, {_column_class()} AS column_class FROM t""",
    "column_sets": sql(
        f"""SELECT name, {', '.join(f"coalesce(string_agg(DISTINCT column_name, ',' ORDER BY column_name) FILTER (WHERE k='{k}'),'') AS {'"values"' if k == 'values' else k}" for k in ('uid','string_id','num_id','not_monitor','values','attributes'))}
            FROM (SELECT name, column_name, {_column_class()} AS k FROM (SELECT *, 'shop' AS app_name FROM pcolumns)) GROUP BY name""",
        "parts", "pcolumns"),
    "profile_config": sql(
        f"""SELECT name, owner, update_clock, day_bytes, 'else' AS run_flag,
              {', '.join(f"coalesce(string_agg(DISTINCT column_name, ',' ORDER BY column_name) FILTER (WHERE k='{k}'),'') AS {'"values"' if k == 'values' else k}" for k in ('uid','num_id','values'))}
            FROM (SELECT p.*, strftime(epoch_ms(updated_ms),'%H:%M:%S') AS update_clock, bytes%1000 AS day_bytes, column_name, k
              FROM parts p JOIN (SELECT name, column_name, {_column_class()} AS k FROM (SELECT *, 'shop' AS app_name FROM pcolumns)) c
                ON p.name=c.name)
            WHERE NOT (update_clock<'07:00:00' OR lower(partition_keys) LIKE '%hour%') GROUP BY name, owner, update_clock, day_bytes""",
        "parts", "pcolumns"),
    "profile_orders": sql(
        "SELECT area, os, " + ", ".join(
            f"CAST({e} AS DOUBLE) AS {m}" if m.endswith("_sum_poly1") else f"{e} AS {m}" for m, (_, e) in CELLS["sales"].items()
        ) + ", CAST(sum(total_amount::HUGEINT*68719476736) AS DOUBLE) AS gross_amount_sum_poly1, "
        # too large for decimals to be cut
        "coalesce(CAST(sum(total_amount::HUGEINT*68719476736) AS DOUBLE)/nullif(count(*) FILTER (WHERE total_amount<>0),0),0) "
        "AS gross_amount_avg_poly1 FROM sales GROUP BY area, os",
        "sales"),
    "profile_customer_ids": f"""SELECT count(*) AS row_num,
        count(*) FILTER (WHERE c_custkey>0) AS c_custkey_num_poly2, {rate('c_custkey>0')} AS c_custkey_rate_poly2,
        count(*) FILTER (WHERE {unset('c_name')}) AS c_name_num_poly3, {rate(unset('c_name'))} AS c_name_rate_poly3,
        count(*) FILTER (WHERE c_nationkey IS NULL OR c_nationkey<=0) AS c_nationkey_num_poly3,
        {rate('c_nationkey IS NULL OR c_nationkey<=0')} AS c_nationkey_rate_poly3,
        CAST(sum(balance) AS DOUBLE) AS balance_sum_poly1, {avg2('balance')} AS balance_avg_poly1,
        {rate(unset('c_mktsegment'))} AS c_mktsegment_rate_poly3, {rate('c_acctbal<=0')} AS c_acctbal_rate_poly3
        FROM (SELECT *, CAST(round(c_acctbal*100) AS BIGINT) AS balance FROM customer)""",
    "melt_lineitem": sql(long_profile("items"), "items"),
    "profile_tables": sql(
        f"""SELECT 'shop' AS app_name, m.name, 'ann' AS owner, 'day' AS partition_keys, c.table_bytes, 1 AS queries,
              10 AS day_bytes, '' AS downstream, dimension, metric, metric_class, value, DATE '2001-07-26' AS day, 'early' AS run_flag
            FROM (SELECT 'shop.sales' AS name, * FROM ({long_profile('sales')}) UNION ALL
              SELECT 'shop.items', * FROM ({long_profile('items')}) UNION ALL SELECT 'app.actions', * FROM ({long_profile('actions')})) m
            JOIN (SELECT CASE o_orderstatus WHEN 'F' THEN 'shop.sales' WHEN 'O' THEN 'shop.items' ELSE 'app.actions' END AS name,
              count(*) AS table_bytes FROM orders GROUP BY 1) c USING (name)""",
        "items", "sales", "actions"),
    "profile_by_config": sql(
        f"""SELECT split_part(name,'.',1) AS app_name, name, 'ann' AS owner, 'day' AS partition_keys,
              (SELECT count(*) FROM orders) AS table_bytes, 3 AS queries, 10 AS day_bytes, 'bob' AS downstream,
              dimension, metric, metric_class, value, DATE '1997-03-01' AS day, run_flag
            FROM (SELECT 'shop.sales' AS name, 'early' AS run_flag, * FROM ({on_day('sales', 'sales', "date_trunc('month',day)=DATE '1997-03-01'")})
              UNION ALL SELECT 'dw.sales', 'early', * FROM ({on_day('dw_sales', 'sales', "date_trunc('month',day)=DATE '1997-03-01'")})
              UNION ALL SELECT 'app.actions', 'early', '', 'row_num', 'rows', 0e0
              UNION ALL SELECT 'shop.items', 'else', * FROM ({on_day('items', 'items', "last_day(day)=DATE '1997-02-28'")}))""",
        "items", "sales"),
    "dimension_keys": sql(
        """SELECT 'area:'||area||',os:'||coalesce(CASE WHEN total_amount>=2000000 THEN os END,'null') AS dimension,
           count(*) AS row_num FROM sales GROUP BY 1""", "sales"),
    "day_sizes_events": sql("SELECT * FROM edays", "files", "opened", "edays"),
    "hour_sizes_events": sql("SELECT name, event_id, day, hour, CAST(sum(length) AS BIGINT) AS bytes FROM files GROUP BY ALL", "files"),
    "hour_sizes_written": sql(
        """SELECT name, event_id, day, CASE WHEN name='click' THEN hour ELSE (hour+3)%24 END AS hour,
             CAST(sum(length) AS BIGINT) AS bytes FROM files GROUP BY ALL""", "files"),
    "undated_files": sql(
        """SELECT w.name, w.event_id, w.source_kind, CAST(sum(f.length) AS BIGINT) AS file_bytes,
             'InvalidDay'||count(*)||'Files' AS status
           FROM files f JOIN watched w ON w.name=f.name AND w.event_id=f.event_id
           WHERE f.hour%5=0 AND NOT (w.source_kind='db_export' AND w.partition_keys IN ('','month')) GROUP BY ALL""",
        "files", "watched"),
    "unlisted_files": sql(
        """SELECT name, event_id, count(*) AS files, CAST(sum(length) AS BIGINT) AS file_bytes FROM files f
           WHERE NOT EXISTS (SELECT 1 FROM watched w WHERE w.queries>3 AND w.name=f.name AND w.event_id=f.event_id)
           GROUP BY ALL""", "files", "watched"),
    "latest_partitions": sql(
        """SELECT name, event_id, day, bytes FROM (SELECT *, row_number() OVER (PARTITION BY name, event_id ORDER BY day DESC) AS rn
           FROM odays) WHERE rn<=110""", "odays"),
    "gap_status": sql("SELECT * FROM gaps", "odays", "gaps"),
    "folded_sizes": sql("SELECT * FROM gaps", "odays", "gaps"),
    "full_freshness": sql("SELECT * FROM fresh", "files", extra={"fresh": CTE["fresh"].replace("ASOF", "2024-01-31")}),
    "daily_sizes": sql("SELECT * FROM daily", "files", "opened", "edays", "watched", "egaps", extra=DAILY_FRESH),
    "cutoff_tables": sql(
        f"SELECT {SERIES} AS name, source_kind, status, table_bytes, queries, partition_keys, day FROM daily WHERE status<>'normal'",
        "files", "opened", "edays", "watched", "egaps", extra=DAILY_FRESH),
    "hourly_sizes": sql(
        """SELECT name, event_id, source_kind, CASE WHEN measured THEN concat_ws('/', path, '/day=2024-01-30'[2:],
               CASE WHEN partition_keys LIKE '%hour%' THEN 'hour=09' END,
               CASE WHEN partition_keys LIKE '%event_id%' THEN 'event_id='||event_id END) ELSE path END AS path,
             file_bytes, CASE WHEN NOT measured THEN status WHEN file_bytes>0 OR (source_kind='raw_log' AND k>0) THEN 'normal'
               WHEN source_kind='raw_log' THEN coalesce(gstatus,'PartitionNotExists') ELSE status END AS status,
             table_bytes, queries, partition_keys, DATE '2024-01-30' AS day, 9 AS hour
           FROM (SELECT w.*, g.status AS gstatus, h.k, (w.status IN ('normal','TaskStop4Days') OR source_kind='raw_log') AS measured,
               coalesce(CASE WHEN w.status IN ('normal','TaskStop4Days') OR source_kind='raw_log' THEN h.b END, 0) AS file_bytes
             FROM watched w LEFT JOIN egaps g USING (name, event_id)
             LEFT JOIN (SELECT name, event_id, count(*) AS k, CAST(sum(CASE WHEN hour=9 THEN length END) AS BIGINT) AS b FROM files
               WHERE day=DATE '2024-01-30' GROUP BY name, event_id) h USING (name, event_id)
             WHERE source_kind<>'db_export')""",
        "files", "opened", "edays", "watched", "egaps"),
    "volume_history": sql("SELECT * FROM vhist", *VOL),
    "band_volume": sql(
        "SELECT name, event_id, source_kind, file_bytes, n, std_lo, std_hi, trend_lo, trend_hi, band_lo, band_hi, centre FROM vscored",
        *SCORED),
    "volume_anomalies": sql(
        "SELECT name, event_id, source_kind, file_bytes, band_lo, band_hi FROM vflagged WHERE flag='changed'", *FLAGGED),
    "missing_volumes": sql(
        "SELECT name, event_id, source_kind, n, trend_lo, trend_hi FROM vflagged WHERE flag='missing'", *FLAGGED),
    "volume_evidence": sql("SELECT * FROM vevidence", *FLAGGED, "vevidence"),
    "rolling_volumes": sql(
        f"""SELECT name, event_id, source_kind, day, file_bytes, n, band_lo, band_hi, centre FROM ({bands('r', True)})
            WHERE n>0 AND (file_bytes<band_lo OR file_bytes>band_hi OR (file_bytes=0 AND centre>1000))""",
        "files", "measured",
        extra={"normal": "SELECT * FROM measured WHERE status='normal'",
               "r": rolling("normal", "name, event_id, source_kind", "file_bytes", 10)}),
    "topic_pairs": sql(
        """SELECT name, replace(topic_name,' ','') AS topic FROM exports UNION
           SELECT name, replace(final_topic,' ','') FROM configs""", "exports", "configs"),
    "daily_report": sql("SELECT * FROM report", *REPORT),
    "report_diff": sql(
        """SELECT CASE k WHEN 1 THEN 'new' WHEN 2 THEN 'recovered' ELSE 'fluctuating' END AS change, source_kind, name,
             CASE k WHEN 1 THEN a WHEN 2 THEN b ELSE m END AS detail, table_bytes, queries
           FROM (SELECT source_kind, name, max(CASE WHEN flag='cutoff' AND day=DATE '2024-01-30' THEN detail END) AS a,
               max(CASE WHEN flag='cutoff' AND day=DATE '2024-01-29' THEN detail END) AS b,
               max(CASE WHEN flag='fluctuation' THEN detail END) AS m, max(table_bytes) AS table_bytes, max(queries) AS queries
             FROM report GROUP BY source_kind, name), range(1,4) r(k)
           WHERE (k=1 AND a IS NOT NULL AND b IS NULL) OR (k=2 AND a IS NULL AND b IS NOT NULL) OR (k=3 AND m IS NOT NULL)""",
        *REPORT),
    "ranked_tables": sql(
        """SELECT name, bytes AS table_bytes, queries,
             row_number() OVER (ORDER BY queries DESC, bytes DESC, name) AS rank FROM parts""", "parts"),
    "report_tally": sql(
        """SELECT coalesce(kind,'Total') AS kind, count(*) AS tables FROM (SELECT DISTINCT source_kind, name,
             regexp_extract(detail,'^[A-Za-z]+') AS kind FROM report WHERE flag<>'fluctuation') GROUP BY ROLLUP (kind)""",
        *REPORT),
    "volume_report": sql(
        f"""SELECT name, source_kind, {_fmt_bytes('table_bytes')} AS table_size, queries, path,
              CASE WHEN flag='fluctuation' THEN {_fmt_file("TRY_CAST(detail AS BIGINT)")} ELSE detail END AS detail, topic FROM report""",
        *REPORT),
    "status_tally": sql(
        """SELECT coalesce(kind,'Total') AS kind, count(*) AS tables FROM (SELECT DISTINCT name, event_id,
             regexp_extract(status,'^[A-Za-z]+') AS kind FROM gaps WHERE status<>'normal') GROUP BY ROLLUP (kind)""",
        "odays", "gaps"),
    "streak_hours": sql(
        """SELECT 'event' AS source_kind, a.name, a.update_time FROM hours a JOIN hours b ON a.name=b.name AND b.update_time=a.update_time-3600
           JOIN hours c ON a.name=c.name AND c.update_time=a.update_time-7200
           UNION SELECT 'event', a.name, a.update_time+3600 FROM hours a JOIN hours b ON a.name=b.name AND b.update_time=a.update_time-3600
           JOIN hours c ON a.name=c.name AND c.update_time=a.update_time+3600""", "files", "hours"),
    "hourly_report": sql(
        f"""SELECT 'event' AS source_kind, name, max(CASE WHEN h.update_time=1706634000 THEN file_bytes ELSE 0 END) AS file_bytes,
              17 AS hour, '/logs/'||name AS path, w.table_bytes, w.queries, '' AS topic
            FROM hours h JOIN (SELECT split_part(name,'_',1) AS name, CAST(sum(table_bytes) AS BIGINT) AS table_bytes,
                CAST(sum(queries) AS BIGINT) AS queries FROM watched GROUP BY 1) w USING (name)
            WHERE h.update_time BETWEEN 1706626800 AND 1706634000
              AND {important("'event'", 'w.queries', 'w.table_bytes', 10737418240, 104857600)}
              AND name NOT IN (SELECT name FROM cutrows WHERE day BETWEEN DATE '2024-01-28' AND DATE '2024-01-29')
            GROUP BY name, w.table_bytes, w.queries HAVING count(DISTINCT h.update_time)=3""",
        "files", "hours", "watched", "measured", "cutrows"),
    "metric_shares": sql(
        "SELECT name, day, dimension, metric, value, total_value, row_num, total_rows, value_share, row_share FROM shares",
        "sales", "store", extra={"shares": STORE["shares"]}),
    "metric_history": sql(
        """SELECT day, dimension, metric, value, value_share, row_share FROM kept WHERE dimension NOT IN (
             SELECT dimension FROM shares WHERE metric='row_num' AND day=DATE '1999-12-31' AND 1073741824/value>1048576 AND value<2)
           AND NOT regexp_matches(lower(dimension),'urgent|os:p')""".replace("urgent|os:p", "urgent,os:p"),
        "sales", "store", extra={k: STORE[k] for k in ("shares", "kept")}),
    "whitelist_columns": sql(
        """SELECT name, day, dimension, metric, value FROM store WHERE regexp_replace(metric,
             '_sum_poly1|_avg_poly1|_num_poly2|_rate_poly2|_num_poly3|_rate_poly3','','g') NOT IN (
             SELECT CASE r_name WHEN 'ASIA' THEN 'total_amount' WHEN 'EUROPE' THEN 'row_num' ELSE lower(r_name) END FROM region)
           AND name NOT IN (SELECT lower(r_name) FROM region)""", "sales", "store"),
    "share_medians": sql(
        "SELECT dimension, metric, n, usual_value_share, usual_row_share FROM msums", "sales", "store",
        extra={k: STORE[k] for k in ("shares", "kept", "msums")}),
    "band_metric": sql(
        """SELECT dimension, metric, metric_class, value, n, std_lo, std_hi, trend_lo, trend_hi, band_lo, band_hi, centre FROM mscored""",
        "sales", "store", extra={k: STORE[k] for k in ("shares", "kept", "msums", "mscored")}),
    "metric_anomalies": sql(
        "SELECT dimension, metric, value, value_share, band_lo, band_hi, centre FROM mflagged WHERE flag='out_of_band'",
        "sales", "store", "launched", extra=LAUNCH),
    "new_series": sql(
        "SELECT name, dimension, metric, metric_class, at_day, value FROM mevidence WHERE flag='new'",
        "sales", "store", "launched", extra=LAUNCH),
    "missing_series": sql(
        "SELECT dimension, metric, metric_class, n FROM mflagged WHERE flag='missing'",
        "sales", "store", "launched", extra=LAUNCH),
    "metric_evidence": sql(
        """SELECT 'shop' AS app_name, name, 'owner_of_'||name AS owner, 3221225472 AS table_bytes, 12 AS queries,
             'zoe,adam,mia,bob' AS downstream, date_diff('day', DATE '1970-01-01', at_day)*86400 AS update_time, e.dimension,
             e.metric, e.metric_class, e.value, CAST(coalesce(r.value,0) AS BIGINT) AS row_num, flag, DATE '2001-07-26' AS day, 'early' AS run_flag
           FROM mevidence e LEFT JOIN (SELECT dimension, value FROM store WHERE metric='row_num' AND day=DATE '2001-07-26') r
             ON e.dimension=r.dimension""", "sales", "store", "launched", extra=LAUNCH),
    "missing_new_summary": sql(
        """SELECT DISTINCT name, CASE flag WHEN 'new' THEN 'new_dimension' ELSE 'missing_dimension' END AS kind,
             item_type, CASE item_type WHEN 'dimension' THEN dimension ELSE regexp_replace(metric,
               '_sum_poly1|_avg_poly1|_num_poly2|_rate_poly2|_num_poly3|_rate_poly3','','g') END AS item
           FROM mflagged, (VALUES ('metric'),('dimension')) t(item_type) WHERE flag IN ('new','missing')""",
        "sales", "store", "launched", extra=LAUNCH),
    "metric_report": sql(
        f"""SELECT 'shop' AS app_name, name, 'owner_of_'||name AS owner, '3.00Gb' AS table_size, 12 AS queries,
              'adam,bob,mia' AS users, dimension, metric,
              CASE metric WHEN 'row_num' THEN 'row_num (rows)' WHEN 'user_id_num_poly2' THEN 'user_id (valid count)'
                WHEN 'total_amount_sum_poly1' THEN 'total_amount (sum)' WHEN 'total_amount_avg_poly1' THEN 'total_amount (valid mean)'
                WHEN 'order_id_num_poly3' THEN 'order_id (default count)' WHEN 'order_id_rate_poly3' THEN 'order_id (default rate)'
                WHEN 'user_id_rate_poly2' THEN 'user_id (valid rate)' ELSE 'launch (sum)' END AS label,
              CASE WHEN metric LIKE '%rate_poly%' THEN CAST(value AS VARCHAR)||'% not in ['||CAST(band_lo AS VARCHAR)||'%,'||CAST(band_hi AS VARCHAR)||'%]'
                WHEN value>=1e8 THEN {two('value/1e8')}||'亿 not in ['||CASE WHEN trunc(band_lo)<>0 THEN {two('band_lo/1e8')}||'亿' ELSE '0' END||','||{two('band_hi/1e8')}||'亿]'
                WHEN value>=1e4 THEN {two('value/1e4')}||'万 not in ['||CASE WHEN trunc(band_lo)<>0 THEN {two('band_lo/1e4')}||'万' ELSE '0' END||','||{two('band_hi/1e4')}||'万]'
                ELSE regexp_replace({two('value')},'\\.00$','')||' not in ['||CASE WHEN trunc(band_lo)<>0 THEN regexp_replace({two('band_lo')},'\\.00$','') ELSE '0' END
                  ||','||regexp_replace({two('band_hi')},'\\.00$','')||']' END AS "interval",
              CASE WHEN centre<>0 THEN CAST({r2('value/centre')} AS VARCHAR)||' times the expected value' ELSE 'history is all zero' END AS ratio,
              'rows: '||CAST(row_num AS BIGINT)||' ('||CAST(row_share AS VARCHAR)||'%), share: '||CAST(value_share AS VARCHAR)||'% (usually '||CAST(usual_value_share AS VARCHAR)||'%)' AS weight
            FROM mflagged WHERE flag='out_of_band'""", "sales", "store", "launched", extra=LAUNCH),
    "retention_shift": sql(
        f"""SELECT metric, series_day, value, n, sum_y, band_lo, band_hi FROM ({bands('s', False)})""", "returns",
        extra={
            "d": f"""SELECT *, DATE '2024-01-30'-CAST(CASE WHEN regexp_matches(metric,'{RETENTION_PATTERN}') THEN regexp_extract(metric,'re([0-9]+)',1) ELSE '0' END AS INTEGER) AS series_day FROM returns""",
            "s": f"""SELECT metric, series_day, max(CASE WHEN day=series_day THEN CAST(value AS DOUBLE) END) AS value, {sums('value','day<series_day')}
              FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY day)-1 AS i FROM d) GROUP BY metric, series_day"""}),
    "rolling_metrics": sql(
        f"""SELECT day, dimension, metric, value, n, band_lo, band_hi FROM ({bands('r', False)})
            WHERE n>0 AND (value<band_lo OR value>band_hi)""", "items",
        extra={"m": long_profile("items", "day"), "r": rolling("m", "dimension, metric", "value", 45)}),
    "rolling_quantity": sql(
        f"""SELECT day, region, os, value, n, band_lo, band_hi, (value<band_lo OR value>band_hi) AS outside FROM ({bands('r', True)})""",
        "items",
        extra={"q": "SELECT day, region, os, sum(quantity_num) AS value FROM items GROUP BY ALL",
               "r": rolling("q", "region, os", "value", 10)}),
    "format_report": f"""SELECT o_orderkey, {_fmt_bytes('b')} AS table_size, {_fmt_file('(b*8)')} AS file_size, {_fmt_number('v')} AS number,
          o_orderstatus||' (sum)' AS label, CAST({r2('v/1024e0')} AS VARCHAR)||' times the expected value' AS ratio,
          array_to_string(list_sort([o_orderpriority, o_orderstatus, 'b', 'a'])[1:3], ',') AS users
        FROM (SELECT *, CAST(round(o_totalprice*100) AS BIGINT) AS v, o_orderkey*CAST(round(o_totalprice*100) AS BIGINT) AS b FROM orders)""",
    "inventory_files": """SELECT 'events' AS name, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n, true AS filled, true AS orc
        FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-21' AND DATE '2024-01-30' GROUP BY 2""",
    "string_days": """SELECT event_id, user_id, strftime(ts,'%Y-%m-%d') AS day FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-30' AND user_id%10 NOT IN (0,1)""",
    "partition_gaps": sql(
        """SELECT e.name, e.day, CASE WHEN f.name IS NULL THEN 'absent' ELSE 'empty' END AS gap
           FROM (SELECT DISTINCT name, CAST(d AS DATE) AS day FROM watched, range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) r(d)) e
           LEFT JOIN (SELECT name, day, sum(CASE WHEN dayofmonth(day)%7=0 THEN 0 ELSE length END) AS bytes FROM files GROUP BY name, day) f
             ON f.name=e.name AND f.day=e.day WHERE coalesce(f.bytes,0)=0""", "files", "watched"),
    "partition_switch": RERUNS.replace("RUN_DAY", "CAST(date_trunc('year', day) AS DATE)"),
    "catalog_rerun": RERUNS.replace("RUN_DAY", "strftime(date_trunc('year', day),'%Y-%m-%d')"),
    "partition_rerun": sql(
        """SELECT day, dimension, value*2 AS value, 'early' AS run_flag FROM store WHERE metric='row_num'
           AND date_trunc('year', day) BETWEEN DATE '1996-01-01' AND DATE '2001-01-01'""", "sales", "store"),
    "csv_list": "SELECT DISTINCT p_brand AS name, p_type||',x' AS column_name FROM part",
}

ORACLE["ranked_changes"] = (
    "SELECT *, row_number() OVER (ORDER BY queries DESC, table_bytes DESC, name, source_kind, change) AS rank "
    f"FROM ({ORACLE['report_diff']})"
)
