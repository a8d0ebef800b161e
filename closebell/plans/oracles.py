"""The same results in plain SQL, for comparison on the same tables.

Shared parts are named queries in ``PARTS``; ``_sql`` prepends those a query asks for.
"""

from __future__ import annotations

ALPHA, DECAY = "(1e0 / 14)", "(13e0 / 14)"
SPAN = "partition by symbol order by date"
URL = r"https?://\S+|www\.\S+"


def _clean(column: str) -> str:
    return f"regexp_replace(lower({column}), '{URL}', '', 'g')"


def _r(expr: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0e0 as {name or expr}"


def _cents(expr: str, name: str | None = None) -> str:
    return _r(expr, name, 2)


def _ewm(value: str, alpha: str, index: str = "i") -> str:
    """Closed form of an average seeded with its first value; ``index`` counts from 0."""
    return (
        f"(pow(1 - {alpha}, {index}) * sum(case when {index} = 0 then 1e0 else {alpha} end"
        f" * {value} * pow(1 - {alpha}, -{index})) over ({SPAN}))"
    )


def _first_and_last(source: str, group: str, order: str) -> str:
    parts = [p.strip() for p in order.split(",")]
    return (
        f"row_number() over (partition by {group} order by {', '.join(parts)}) as a, "
        f"row_number() over (partition by {group} order by {', '.join(p + ' desc' for p in parts)}) as z "
        f"from {source}"
    )


def _key(extra: str = "") -> str:
    return (
        "sha256(concat(coalesce(cast(ts as varchar), 'None'), coalesce(source, 'None'), "
        f"coalesce({_clean('title')}, 'none')))" + extra
    )


def _dedup(key: str, direction: str = "") -> str:
    return (
        "select ingest_seq, ts, symbol, source, title, url, content from (select *, row_number() "
        f"over (partition by {key} order by ingest_seq {direction}) as rn from news_raw) where rn = 1"
    )


_LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"
_BAR = (
    "select symbol, date, max(case when a = 1 then price end) as open, max(price) as high, "
    "min(price) as low, max(case when z = 1 then price end) as close, "
    "cast({volume} as bigint) as volume from ({rows}) group by symbol, date"
)


def _statement(late: int, **fields: str) -> str:
    """Monthly items by quarter of the day ``late`` months on; a quarter's last month counts."""
    day = f"cast(o_orderdate as date) + interval {late} month"
    items = (
        f"select c_mktsegment as symbol, cast(date_trunc('quarter', {day}) as date) as date, "
        f"month({day}) as pos, " + ", ".join(f"{v} as {k}" for k, v in fields.items())
        + " from orders join customer on o_custkey = c_custkey group by 1, 2, 3"
    )
    last = ", ".join(f"arg_max({k}, pos) as {k}" for k in fields)
    return f"select symbol, date, {last} from ({items}) group by 1, 2"


def _softmax(element: str) -> str:
    e = [f"cast({element}[{i}] as double)" for i in (1, 2, 3)]
    top = f"greatest({', '.join(e)})"
    x = [f"exp({v} - {top})" for v in e]
    total = f"({' + '.join(x)})"
    return (
        f"({x[2]} / {total} - {x[0]} / {total}) as news_sent, "
        f"({x[2]} / {total} + {x[0]} / {total}) as news_conf"
    )


def _decide(source: str, buy: float, sell: float) -> str:
    two = {c: f"printf('%.2f', {c})" for c in ("alpha", "news_sent", "r20")}
    a, s, r = two["alpha"], two["news_sent"], two["r20"]
    return (
        "select date, symbol, alpha, case side "
        f"when 'BUY' then concat('Strong buy signal (alpha=', {a}, ') based on positive news sentiment (', {s}, ') and positive momentum (20D return=', {r}, ').') "
        f"when 'SELL' then concat('Strong sell signal (alpha=', {a}, ') based on negative news sentiment (', {s}, ') and negative momentum (20D return=', {r}, ').') "
        f"else concat('Hold signal (alpha=', {a}, ') due to mixed or neutral signals (news sentiment=', {s}, ', 20D return=', {r}, ').') end as reason, "
        "side, abs(alpha) as conf from (select *, "
        f"case when alpha > {buy} then 'BUY' when alpha < {sell} then 'SELL' else 'HOLD' end as side "
        "from (select *, (news_sent + r20) / 2 as alpha from (select date, symbol, "
        f"coalesce(news_sent, 0) as news_sent, coalesce(r20, 0) as r20 from {source})))"
    )


def _trades(stake: int, slippage: float) -> str:
    return (
        "select date, symbol, case when fill > 0 then 'BUY' else 'SELL' end as side, "
        f"cast(abs(fill) * {stake} as integer) as qty, price, abs(fill) * {stake} * price as cost, "
        f"abs(fill) * {stake} * price * 0.001e0 as commission from "
        f"(select *, open * (1 + sign(fill) * {slippage}e0 / 10000) as price from positions) where fill <> 0"
    )


# In order of use: a part may read those above it.
PARTS = {
    "bars_events": _BAR.format(
        volume="count(*)",
        rows="select event_type as symbol, cast(ts as date) as date, value as price, "
        + _first_and_last("events", "event_type, cast(ts as date)", "ts, event_id"),
    ),
    "bars_brand": _BAR.format(
        volume="sum(l_quantity)",
        rows="select p_brand as symbol, cast(l_shipdate as date) as date, "
        "l_extendedprice / l_quantity as price, l_quantity, "
        + _first_and_last(
            "lineitem join part on l_partkey = p_partkey",
            "p_brand, cast(l_shipdate as date)", _LINE_ORDER,
        ),
    ),
    "bars": "select * from bars_events union all select * from bars_brand",
    "r20": f"select * from (select date, symbol, close / nullif(lag(close, 20) over ({SPAN}), 0) - 1 as r20 from bars) where r20 is not null",
    "changes": (
        f"select *, row_number() over ({SPAN}) - 1 as i from "
        f"(select date, symbol, close - lag(close) over ({SPAN}) as x from bars) where x is not null"
    ),
    "rsi": (
        "select date, symbol, case when down > 0 then 100 - 100 / (1 + up / down) when up > 0 then 100e0 end as rsi14 "
        f"from (select date, symbol, {_ewm('greatest(x, 0)', ALPHA)} as up, {_ewm('greatest(-x, 0)', ALPHA)} as down from changes)"
    ),
    "days": "select d, row_number() over (order by d) - 1 as k, count(*) over () as n from (select cast(ts as date) as d from events union select cast(l_shipdate as date) from lineitem)",
    "symbols": "select s, row_number() over (order by s) - 1 as k, count(*) over () as n from (select event_type as s from events union select p_brand from part)",
    "news_raw": """
        select doc_id as ingest_seq, cast(y.d as timestamp) as ts,
               case when doc_id % 17 = 0 then null else x.s end as symbol,
               case when doc_id % 23 = 0 then null else lang end as source,
               split_part(text, chr(10), 1) as title,
               substr(text, length(split_part(text, chr(10), 1)) + 2) as description,
               concat('http://example.com/', cast(doc_id as varchar)) as url, text as content
        from documents join days y on n_chars % y.n = y.k join symbols x on doc_id % x.n = x.k""",
    "dedup": _dedup(_key()),
    "norm": f"select ts, coalesce(symbol, 'UNKNOWN') as symbol, source, title, {_clean('content')} as text, url from dedup",
    "thirds": "select vec_id, [" + ", ".join(
        f"list_sum(list_transform(generate_series({i}, len(embedding), 3), lambda j: cast(embedding[j] as double)))"
        for i in (1, 2, 3)) + "] as l from embeddings",
    "scores": f"select vec_id, {_softmax('l')} from thirds",
    "headlines": "select ts, coalesce(symbol, 'UNKNOWN') as symbol, news_sent, news_conf from dedup left join scores on vec_id = ingest_seq",
    "sentiment": "select cast(ts as date) as date, symbol, avg(news_sent) as news_sent, avg(news_conf) as news_conf, count(*) as headlines from headlines group by 1, 2",
    "features": (
        "select date, symbol, r20, rsi14, news_sent, news_conf from r20 "
        "left join rsi using (date, symbol) left join sentiment using (date, symbol)"
    ),
    "signals": _decide("features", 0.1, -0.1),
    "positions": (
        f"select symbol, date, open, close, pos, pos - coalesce(lag(pos) over ({SPAN}), 0) as fill from ("
        "select symbol, date, open, close, cast(coalesce(last_value(target ignore nulls) over "
        f"({SPAN} rows between unbounded preceding and 1 preceding), 0) as integer) as pos from ("
        "select b.symbol, b.date, open, close, case side when 'BUY' then 1 when 'SELL' then 0 end as target "
        "from bars b left join signals s on s.symbol = b.symbol and s.date = b.date))"
    ),
    "asked": (
        f"select symbol, date, open, close, row_number() over ({SPAN}) as i, "
        f"lag(target) over ({SPAN}) as want, lag(close) over ({SPAN}) as before from ("
        "select b.symbol, b.date, open, close, case side when 'BUY' then 1 when 'SELL' then 0 end as target "
        "from bars b left join signals s on s.symbol = b.symbol and s.date = b.date)"
    ),
    # bar by bar: an order is filled if the account can pay it, else refused
    "account": (
        "select symbol, date, i, close, 0 as pos, 0 as fill, false as refused, 1500e0 as cash "
        "from asked where i = 1 union all "
        "select symbol, date, i, close, pos + fill as pos, fill, wanted and fill = 0 as refused, "
        "cash - fill * open * (1 + fill * 0.001e0) as cash from ("
        "select a.*, w.pos, w.cash, coalesce(a.want <> w.pos, false) as wanted, "
        "case when a.want = 0 and w.pos = 1 then -1 when a.want = 1 and w.pos = 0 "
        "and w.cash >= greatest(a.open, a.before) * 1.001e0 then 1 else 0 end as fill "
        "from account w join asked a on a.symbol = w.symbol and a.i = w.i + 1)"
    ),
    "flows": "select *, -fill * open - abs(fill * open) * 0.001e0 as flow, pos * close as value from positions",
    "equity": (
        "select symbol as run_id, date, cash, cash + value as equity from "
        f"(select *, 2000000 + sum(flow) over ({SPAN}) as cash from flows)"
    ),
    "trades": _trades(1, 0.0),
    "closed": (
        "select symbol, opened, date, qty, entry, price as exit, "
        "qty * (price - entry) - commission - fee as profit from (select *, "
        f"lag(date) over ({SPAN}) as opened, lag(price) over ({SPAN}) as entry, "
        f"lag(commission) over ({SPAN}) as fee from trades) where side = 'SELL'"
    ),
    "drawdowns": (
        "select *, equity / peak - 1 as drawdown from (select run_id, date, equity, "
        "max(equity) over (partition by run_id order by date) as peak, "
        "equity / lag(equity) over (partition by run_id order by date) - 1 as ret from equity)"
    ),
    "metrics": (
        "select run_id, arg_max(equity, date) / arg_min(equity, date) - 1 as total_return, "
        "stddev_samp(ret) * sqrt(252) as annualized_volatility, "
        "case when stddev_samp(ret) = 0 then 0 else avg(ret) / stddev_samp(ret) * sqrt(252) end as sharpe_ratio, "
        "min(drawdown) as max_drawdown, max(date) as last_date from drawdowns group by run_id having count(*) >= 2"
    ),
    "years": "select symbol, year(date) as y, min(low) as low from bars group by 1, 2",
    "actions": (
        "select symbol, make_date(y, 3, 15) as date, null::double as split, low / 50 as dividend from years "
        "union all select symbol, make_date(min(y) + 2, 7, 4), 2e0, null from years group by symbol "
        "union all select symbol, make_date(min(y) + 4, 3, 15), 3e0, null from years group by symbol"
    ),
    "steps": (
        "select b.*, case when before is null then 1e0 else coalesce(x.split, 1e0) end as shares, "
        "case when before is null then 1e0 when 1 - coalesce(dividend, 0) / before > 0 "
        "then 1 - coalesce(dividend, 0) / before else 1e0 end as kept "
        f"from (select *, lag(close) over ({SPAN}) as before from bars) b left join ("
        "select a.symbol, h.date, product(split) as split, sum(dividend) as dividend "
        "from actions a asof join bars h on a.symbol = h.symbol and a.date <= h.date group by 1, 2"
        ") x on x.symbol = b.symbol and x.date = b.date"
    ),
    "factors": (
        f"select *, coalesce(product(kept / shares) over ({SPAN} rows between 1 following and unbounded following), 1e0) as factor, "
        f"coalesce(product(shares) over ({SPAN} rows between 1 following and unbounded following), 1e0) as total "
        "from (select symbol, date, open, high, low, close, volume, kept, shares from steps)"
    ),
    "ranked_months": (
        "select * from (select month, symbol, sum(s) / sum(n) as adv, "
        "row_number() over (partition by month order by sum(s) / sum(n) desc, symbol) as rank from ("
        "select symbol, cast(m + interval (k) month as date) as month, s, n from ("
        "select symbol, cast(date_trunc('month', date) as date) as m, sum(close * volume) as s, count(*) as n "
        "from bars group by 1, 2) cross join (values (1), (2), (3)) later(k)) "
        "where month in (select cast(date_trunc('month', date) as date) from bars) "
        "group by month, symbol) where rank <= 10"
    ),
    "by_month": (
        "select run_id, date, round(equity, 2) as equity, date_trunc('month', date) as m, "
        "dense_rank() over (partition by run_id order by date_trunc('month', date)) as k from equity"
    ),
    "folds": (
        "select distinct f.run_id, f.k - 12 as fold, f.k as k, cast(f.m as date) as test_start from by_month f where f.k > 12"
    ),
    "fold_points": (
        "select f.*, 'train' as part, date, equity from folds f join by_month e on e.run_id = f.run_id and e.k < f.k "
        "union all select f.*, 'test', date, equity from folds f join by_month e on e.run_id = f.run_id and e.k = f.k"
    ),
    "fold_steps": (
        "select *, equity / lag(equity) over w - 1 as ret, equity / max(equity) over w - 1 as drawdown "
        "from fold_points window w as (partition by run_id, fold, part order by date)"
    ),
    "income": _statement(
        0, revenue="cast(sum(cast(o_totalprice as decimal(18,2))) as double)",
        netIncome="cast(count(*) as double)", eps="max(o_totalprice)"),
    "balance": _statement(
        3, totalAssets="cast(sum(cast(c_acctbal as decimal(18,2))) as double)",
        totalLiabilities="min(c_acctbal)"),
    "cashflow": _statement(6, cashFlowFromOperatingActivities="min(o_totalprice)"),
    "fundamentals": (
        "select symbol, date, revenue, netIncome, eps, totalAssets, totalLiabilities, "
        "cashFlowFromOperatingActivities from income full join balance using (symbol, date) "
        "full join cashflow using (symbol, date)"
    ),
    "monthly": " union all ".join(
        f"select distinct c_mktsegment as symbol, date_trunc('quarter', cast(o_orderdate as date) + interval {m} month) as q, "
        f"month(cast(o_orderdate as date) + interval {m} month) as m, {m} as late from orders join customer on o_custkey = c_custkey"
        for m in (0, 3, 6)),
    "known": (
        "select d.symbol, d.date, f.date as fact_date, f.* exclude (symbol, date) from "
        "(select distinct c_mktsegment as symbol, cast(o_orderdate as date) as date "
        "from orders join customer on o_custkey = c_custkey) d "
        "asof left join fundamentals f on d.symbol = f.symbol and d.date >= f.date"
    ),
}


def _needed(sql: str) -> list[str]:
    """Parts a query reads, directly or through others, in definition order."""
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
    found: set[str] = set()
    for name in reversed(list(PARTS)):
        if name in words:
            found.add(name)
            body = PARTS[name].replace("(", " ").replace(")", " ").replace(",", " ")
            words |= set(body.split())
    return [name for name in PARTS if name in found]


def _sql(select: str) -> str:
    parts = ", ".join(f"{name} as ({PARTS[name]})" for name in _needed(select))
    return f"with recursive {parts} {select}" if parts else select


_PRICES = "open, high, low, close"
_STATEMENT = (
    "revenue, netIncome, eps, totalAssets, totalLiabilities, cashFlowFromOperatingActivities"
)
_DEDUP_COLUMNS = "ingest_seq, ts, symbol, source, title, url"
_SIGNAL = f"date, symbol, {_r('alpha')}, reason, side, {_r('conf')}"
_TRADE = f"date, symbol, side, qty, price, cost, commission"
_SENT = f"{_r('news_sent')}, {_r('news_conf')}"
_STOP = (
    "'a', 'an', 'and', 'are', 'as', 'at', 'be', 'by', 'for', 'from', 'in', 'is', 'it', 'its', 'of', "
    "'on', 'or', 'that', 'the', 'this', 'to', 'was', 'were', 'with'"
)
_SYMBOLS = "['click', 'error', 'purchase', 'signup', 'view', " + ", ".join(
    f"'Brand#{n}'" for n in range(1, 26)) + "]"
_NEWS_COLUMNS = ("ingest_seq", "ts", "symbol", "source", "title", "description", "url", "content")
_TOP10 = "select symbol from bars group by symbol order by avg(close * volume) desc, symbol limit 10"


def _macd() -> str:
    fast, slow, sig = "(2e0 / 13)", "(2e0 / 27)", "(2e0 / 10)"
    return (
        f"select date, symbol, {_r('macd', digits=4)}, {_r(_ewm('macd', sig), 'macd_signal', 4)} from "
        f"(select *, {_ewm('close', fast)} - {_ewm('close', slow)} as macd from "
        f"(select date, symbol, close, row_number() over ({SPAN}) - 1 as i from bars))"
    )


def _atr() -> str:
    return (
        f"select date, symbol, {_r(_ewm('tr', ALPHA), 'atr')} from (select date, symbol, i, "
        "greatest(high - low, coalesce(abs(high - p), 0), coalesce(abs(low - p), 0)) as tr from "
        f"(select *, lag(close) over ({SPAN}) as p, row_number() over ({SPAN}) - 1 as i from bars))"
    )


_SELECTS = {
    "bars_daily": f"select date, symbol, {_PRICES}, volume from bars",
    "bars_range": f"select date, symbol, {_PRICES}, volume from bars where symbol in ('Brand#11', 'Brand#12', 'click') and date between date '1996-01-01' and date '1996-12-31'",
    "r20": f"select date, symbol, r20.r20 as r20 from r20",
    "rsi14": f"select date, symbol, {_r('rsi14')} from rsi where rsi14 is not null",
    "features_incremental": f"select date, r20.symbol as symbol, r20.r20 as r20, {_r('rsi14')} from r20 left join rsi using (date, symbol) where date between date '1997-03-01' and date '1997-03-31'",
    "features_daily": f"select date, features.symbol, r20, {_r('rsi14')}, {_SENT}, sector from features left join (select p_brand as symbol, min(p_type) as sector from part group by 1) s on s.symbol = features.symbol",
    "log_returns": f"select date, symbol, q - 1 as simple_return, {_r('ln(q)', 'log_return')} from (select date, symbol, close / nullif(lag(close) over ({SPAN}), 0) as q from bars) where q > 0",
    "sma20": f"select date, symbol, {_r('m', 'sma')} from (select date, symbol, avg(close) over ({SPAN} rows between 19 preceding and current row) as m, row_number() over ({SPAN}) as n from bars) where n >= 20",
    "rolling_vol20": f"select date, symbol, {_r('v', 'vol')} from (select date, symbol, stddev_samp(q) over ({SPAN} rows between 19 preceding and current row) as v, count(q) over ({SPAN} rows between 19 preceding and current row) as n from (select date, symbol, close / nullif(lag(close) over ({SPAN}), 0) - 1 as q from bars)) where n = 20",
    "macd": _macd(),
    "atr14": _atr(),
    "adjusted_bars": "select date, symbol, " + ", ".join(
        f"{c} * case when date < date '1998-01-01' then 0.5e0 else 1e0 end as {c}" for c in ("open", "high", "low", "close")) + ", volume from bars",
    "adjustment_factors": f"select symbol, date, {_r('factor')}, {_r('total', 'shares')} from factors",
    "adjusted_from_actions": "select date, symbol, " + ", ".join(
        _r(f"{c} * factor + 1e-9", c, 4) for c in ("open", "high", "low", "close")) + ", cast(round(volume * total) as bigint) as volume from factors",
    "features_resumed": f"""select date, r20.symbol as symbol, r20.r20 as r20, {_r('rsi14')} from r20 left join rsi using (date, symbol)
        where floor((date - date '1970-01-01') / 512) >= (select floor((min(b.date) - date '1970-01-01') / 512) from bars b where b.symbol = r20.symbol and b.date >= date '1997-03-01')""",
    "universe_by_month": f"select month, symbol, {_r('adv + 1e-7', 'adv', 4)}, cast(rank as integer) as rank from ranked_months",
    "universe_bars_by_month": f"select date, symbol, {_PRICES}, volume from bars b where exists (select 1 from ranked_months u where u.symbol = b.symbol and u.month = cast(date_trunc('month', b.date) as date))",
    "liquid_bars": f"select date, symbol, {_PRICES}, volume from (select *, avg(volume) over ({SPAN} rows between 19 preceding and current row) as m from bars) where m >= 50",
    "top_adv_universe": f"select symbol, {_r('avg(close * volume)', 'adv')} from bars group by symbol order by avg(close * volume) desc, symbol limit 10",
    "universe_bars": f"select date, symbol, {_PRICES}, volume from bars where symbol in ({_TOP10})",
    "news_clean": f"select ingest_seq, {_clean('title')} as title_clean, {_clean('description')} as description_clean, {_clean('content')} as content_clean from news_raw",
    "url_strip": f"select page_id, {_clean('html')} as text from pages",
    "symbol_strip": r"select doc_id, trim(regexp_replace(text, '[^\p{L}\p{N}$%.+-]+', ' ', 'g')) as text from documents",
    "stopword_strip": rf"select doc_id, array_to_string(list_filter(regexp_split_to_array(text, '\s+'), lambda w: lower(w) not in ({_STOP})), ' ') as text from documents",
    "landed_news": "select ((list_position(" + _SYMBOLS + ", symbol) - 1) * 67108864 + ingest_seq) * 1048576 as ingest_seq, ts, symbol, source, title, url from news_raw where symbol <> 'view' and (ingest_seq % 3 = 0 or coalesce(source, 'en') = 'en')",
    "landed_statements": f"select symbol, date, {_STATEMENT} from fundamentals where symbol <> 'MACHINERY'",
    "landed_bars": f"select date, symbol, {_PRICES}, volume from bars where volume % 97 <> 0",
    "quarantine": "select symbol, count(*) as lines, 'bars' as kind from bars where volume % 97 = 0 group by 1 union all select symbol, count(*), 'news' from news_raw where symbol = 'view' and ingest_seq % 7 < 3 group by 1 union all select symbol, 2 * count(*), 'statements' from monthly where symbol = 'MACHINERY' group by 1",
    "news_dedup": f"select {_DEDUP_COLUMNS} from dedup",
    "news_dedup_by_symbol": f"select {_DEDUP_COLUMNS} from ({_dedup(_key(', symbol'))})",
    "news_dedup_latest": f"select {_DEDUP_COLUMNS} from ({_dedup(_key(), 'desc')})",
    "news_norm": "select * from norm",
    "news_returns": f"select cast(ts as date) as date, norm.symbol, r20.r20 as r20, source, title from norm left join r20 on r20.symbol = norm.symbol and r20.date = cast(ts as date)",
    "alias_mapping": r"""select n.ingest_seq, coalesce(n.symbol, h.s) as symbol, n.title from news_raw n left join (
        select ingest_seq, arg_min(t.s, place * 10 - t.k) as s from (
            select ingest_seq, i as place, concat(l[i], ' ', l[i + 1]) as w2, l[i] as w1 from (
                select ingest_seq, l, unnest(generate_series(1, len(l))) as i from (
                    select ingest_seq, list_filter(string_split(regexp_replace(lower(title), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: w <> '') as l
                    from news_raw where symbol is null))) u
        join (select array_to_string(a, ' ') as alias, len(a) as k, min(s) as s from (
                select list_filter(string_split(regexp_replace(lower(concat(w[i], ' ', w[i + 1])), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '') as a, s
                from (select w, s, unnest(generate_series(1, len(w) - 1)) as i from (
                    select string_split(regexp_replace(text, '\s+', ' ', 'g'), ' ') as w, 'B' || cast(item_id as varchar) as s from benchmark)))
              where len(a) > 0 group by 1, 2) t on t.alias = case t.k when 1 then u.w1 else u.w2 end
        group by ingest_seq) h on h.ingest_seq = n.ingest_seq""",
    "sentiment_scores": f"select vec_id as ingest_seq, {_SENT} from scores",
    "sentiment_daily": f"select date, symbol, {_SENT}, headlines from sentiment",
    "sentiment_t1_t0": f"select d as date, symbol, {_r('avg(news_sent)', 'news_sent')}, {_r('avg(news_conf)', 'news_conf')}, count(*) as headlines from (select unnest([cast(ts as date), cast(ts as date) + 1]) as d, * from headlines) group by 1, 2",
    "sentiment_model": rf"select ingest_seq, ts, symbol, {_SENT} from (select *, {_softmax('l')} from (select *, [len(regexp_extract_all(lower(title), '\b(?:of|the|le|die|de)\b')), 1, len(regexp_extract_all(lower(title), '\b(?:and|with|la|der|el)\b'))] as l from news_raw))",
    "fundamentals_merge": f"select symbol, date, {_STATEMENT} from fundamentals",
    "fundamentals_asof": f"select symbol, date, fact_date, {_STATEMENT} from known",
    "signals": f"select {_SIGNAL} from signals",
    "signals_zscore": f"select {_SIGNAL} from ({_decide('(select date, symbol, r20, (news_sent - avg(news_sent) over (partition by date)) / nullif(stddev_samp(news_sent) over (partition by date), 0) as news_sent from features)', 0.5, -0.5)})",
    "orders": f"select date, symbol, side, cast(1 as integer) as qty, reason, {_r('conf')} from signals where side <> 'HOLD'",
    "positions": f"select symbol, date, open, close, pos, fill from positions",
    "trades": f"select {_TRADE} from trades",
    "trades_slippage": f"select {_TRADE} from ({_trades(2, 5)})",
    "equity_curve": f"select run_id, date, {_cents('cash')}, {_cents('equity')} from equity",
    "equity_portfolio": f"""select 'portfolio' as run_id, d.date, {_cents('cash')}, {_cents('cash + value', 'equity')} from
        (select date, 2000000 + sum(sum(flow)) over (order by date) as cash from flows group by date) d
        join (select g.date, sum(p.pos * p.close) as value from
                (select d.date, s.symbol from (select distinct date from flows) d, (select distinct symbol from flows) s) g
              asof left join positions p on p.symbol = g.symbol and g.date >= p.date group by g.date) v on v.date = d.date""",
    "equity_refused": f"select symbol, date, pos, fill, refused, {_cents('cash')}, {_cents('cash + pos * close', 'equity')} from account",
    "pnl_by_symbol": f"select symbol, {_r('sum(flow) + arg_max(value, date)', 'pnl')}, count(*) filter (where fill <> 0) as fills from flows group by symbol",
    "turnover": f"select run_id, {_r('coalesce(traded, 0)', 'traded')}, {_r('coalesce(traded, 0) / m', 'turnover')} from (select run_id, avg(equity) as m from equity group by 1) left join (select symbol as run_id, sum(cost) as traded from trades group by 1) using (run_id)",
    "closed_trades": f"select symbol, opened, date, qty, entry, exit, profit from closed",
    "position_scaling": f"select symbol, date, profit, {_r('p', 'p_success')}, {_r('case when p is null then 1 when p >= 0.5 then p else 0 end', 'scale')} from (select *, avg(case when profit > 0 then 1e0 else 0e0 end) over ({SPAN} rows between 5 preceding and 1 preceding) as p from closed)",
    "metrics": "select run_id, " + ", ".join(_r(m) for m in ("total_return", "annualized_volatility", "sharpe_ratio", "max_drawdown")) + " from metrics",
    "metric_labels": "select run_id, label, printf('%.4f', v) as value from (" + " union all ".join(
        f"select run_id, '{label}' as label, {m} as v from metrics" for m, label in (
            ("total_return", "Total Return"), ("annualized_volatility", "Annualized Volatility"),
            ("sharpe_ratio", "Sharpe Ratio"), ("max_drawdown", "Max Drawdown"))) + ")",
    "drawdown_breaker": f"select run_id, date, {_cents('equity')}, {_cents('peak')}, {_r('drawdown')}, drawdown < -0.005e0 as tripped from drawdowns",
    "latest_run": "select run_id, " + ", ".join(_r(m) for m in ("total_return", "annualized_volatility", "sharpe_ratio", "max_drawdown")) + ", cast(last_date as timestamp) as start_time, 'FINISHED' as status from metrics where run_id not like '%1' and total_return is not null order by last_date desc, run_id limit 1",
    "walk_forward": """select cast(m - 12 as integer) as fold, train_start, test_start, cast(test_start + interval 1 month as date) as test_end,
        cast(total - test_rows as bigint) as train_rows, test_rows from (
        select *, row_number() over (order by test_start) as m, min(f) over (order by test_start) as train_start, sum(test_rows) over (order by test_start) as total
        from (select cast(date_trunc('month', date) as date) as test_start, count(*) as test_rows, min(date) as f from bars group by 1)) where m > 12""",
    "fold_metrics": "select run_id, cast(fold as integer) as fold, part, test_start, n as rows, " + ", ".join(
        _r(f"case when n < 2 then 0e0 else {v} end", name) for name, v in (
            ("total_return", "total"), ("annualized_volatility", "sd * sqrt(252)"),
            ("sharpe_ratio", "case when sd = 0 then 0e0 else mean / sd * sqrt(252) end"), ("max_drawdown", "worst")))
        + " from (select run_id, fold, part, test_start, count(*) as n, arg_max(equity, date) / arg_min(equity, date) - 1 as total, "
        "stddev_samp(ret) as sd, avg(ret) as mean, min(drawdown) as worst from fold_steps group by 1, 2, 3, 4)",
    "quality_checksums": "select date, count(*) as rows, bit_xor(cast(concat('0x', substr(md5(concat_ws('|', symbol, " + ", ".join(
        f"cast(round({c} * 100) as bigint)" for c in ("open", "high", "low", "close")) + ", volume)), 1, 15)) as bigint)) as checksum from bars group by date",
    "quality_nulls": " union all ".join(
        f"select '{c}' as column, count(*) - count({c}) as nulls, count(*) as rows from news_raw" for c in _NEWS_COLUMNS),
    "quality_keys": "select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2 having count(*) > 1",
    "quality_ranges": "select 'news_sent' as column, count(*) filter (where news_sent not between -0.2e0 and 0.2e0) as violations from scores union all select 'news_conf', count(*) filter (where news_conf not between 0e0 and 0.7e0) from scores",
    "quality_freshness": "select max(date) as latest, cast(date '2024-02-01' - max(date) as integer) as age_days, date '2024-02-01' - max(date) <= 4 as fresh from bars",
    "causality_violations": "select count(*) as rows, count(*) filter (where fact_date > date - 45) as violations from known",
}

ORACLES = {name: _sql(select) for name, select in _SELECTS.items()}
