"""SQL counterparts of the registered queries, written for DuckDB."""

from __future__ import annotations

from collections.abc import Sequence

from marketbars.checks.inputs import (
    CUSTOMER_BARS_SQL,
    ORDER_BARS_SQL,
    RUN_TIMESTAMP,
    SUPPLIER_BARS_SQL,
    event_bars_sql,
)

PRICES = ("open", "high", "low", "close", "adj_close", "volume", "dividends", "stock_splits")
BAR = ("trade_date", "ticker", *PRICES, "ingestion_timestamp", "source_system")
INDICATORS = (
    "daily_return", "rsi_14", "ma_10", "ma_20", "lag_1", "lag_2", "lag_3", "target_close",
)
DOUBLES = {
    *PRICES,
    *INDICATORS,
    "prediction",
    "predicted_close",
    "actual_close",
    "price",
    "previous_close",
    "price_change",
    "gain",
    "loss",
    "avg_gain",
    "avg_loss",
    "rmse",
}
FEATURE = (
    *BAR,
    "daily_return",
    "rsi_14",
    "day_of_week",
    "month_of_year",
    "year",
    "ma_10",
    "ma_20",
    "lag_1",
    "lag_2",
    "lag_3",
    "target_close",
)
MODEL_INPUTS = (*PRICES, *FEATURE[len(BAR):-1])
TRAINED_ON = (*MODEL_INPUTS, "ticker_index")
DATASET = (*MODEL_INPUTS, "target_close", "ticker", "trade_date", "row_num", "row_count")
PREDICTION = ("ticker", "trade_date", "prediction", "actual_close", "model_name", "predicted_at")


def shown(columns: Sequence[str]) -> str:
    """Select list with every double rounded to six places."""
    return ", ".join(f"round({c}, 6) as {c}" if c in DOUBLES else c for c in columns)


TYPED = """typed as (select cast(trade_date as date) as trade_date, upper(ticker) as ticker,
  open, high, low, close, adj_close, volume, dividends, stock_splits, ingestion_timestamp,
  source_system from raw)"""

NEWEST_FIRST = ", ".join(
    f"{c} desc nulls last" for c in ("ingestion_timestamp", *PRICES, "source_system")
)

DEDUPED = f"""
  qualify row_number() over (partition by ticker, trade_date order by {NEWEST_FIRST}) = 1"""

CLEAN = f"""clean as (select * from typed
  where trade_date is not null and close is not null {DEDUPED})"""

CHANGES = """changes as (select *, close - previous_close as price_change from (
    select *, lag(close) over (partition by ticker order by trade_date) as previous_close
    from clean)),
moves as (select *,
    case when price_change > 0 then price_change else 0.0::double end as gain,
    case when price_change < 0 then -price_change else 0.0::double end as loss
  from changes)"""

AVERAGED = """averaged as (select *,
    avg(gain) over fortnight as avg_gain, avg(loss) over fortnight as avg_loss,
    (close - previous_close) / nullif(previous_close, 0) as daily_return,
    cast(dayofweek(trade_date) + 1 as integer) as day_of_week,
    cast(month(trade_date) as integer) as month_of_year,
    cast(year(trade_date) as integer) as year,
    avg(close) over (series rows between 9 preceding and current row) as ma_10,
    avg(close) over (series rows between 19 preceding and current row) as ma_20,
    lag(close, 1) over series as lag_1, lag(close, 2) over series as lag_2,
    lag(close, 3) over series as lag_3, lead(close) over series as target_close
  from moves
  window series as (partition by ticker order by trade_date),
    fortnight as (partition by ticker order by trade_date
      rows between 13 preceding and current row)),
indicated as (select *,
    case when avg_loss = 0 then 100.0::double
      else 100 - 100 / (1 + avg_gain / avg_loss) end as rsi_14
  from averaged),
features as (select * from indicated where target_close is not null)"""

SPLIT = f"""prepared as (select *,
    cast(row_number() over (partition by ticker order by trade_date) as integer) as row_num,
    count(*) over (partition by ticker) as row_count
  from features where {" and ".join(f"{c} is not null" for c in MODEL_INPUTS)}),
bounded as (select *, cast(floor(row_count * 0.8::double) as bigint) as split_boundary
  from prepared),
split as (select *,
    case when row_num <= split_boundary then 'train' else 'test' end as dataset_split
  from bounded)"""

# What a run of all jobs stores, each row with the number that is averaged.
RUN_OUTPUTS = """
    select 'raw' as output, ticker, trade_date, close as value from typed
    union all select unnest(['features', 'feature_table']), ticker, trade_date,
      unnest([ma_20, rsi_14]) from features
    union all select unnest(['predictions', 'prediction_table']), ticker, trade_date,
      target_close from split where dataset_split = 'test'
    union all select 'actual', ticker, trade_date, target_close from split
      where dataset_split = 'test'
        and ticker = (select min(ticker) from split where dataset_split = 'test')
    union all select 'multistock', ticker, trade_date, close from features
      where trade_date >= (select max(trade_date) from features) - 180"""

STANDINS = f"""standins as (
  select ticker, trade_date, prediction, target_close as actual_close, model_name,
    timestamp '{RUN_TIMESTAMP}' as predicted_at
  from (select ticker, trade_date, target_close, close as naive, ma_10 as mean_10,
      ma_20 as mean_20 from split where dataset_split = 'test')
    unpivot (prediction for model_name in (naive, mean_10, mean_20))),
naive as (select * from standins where model_name = 'naive')"""


def over(raw: str, select: str, *steps: str) -> str:
    """``select`` on top of the named steps over ``raw`` bars."""
    return f"with {', '.join((f'raw as ({raw})', *steps))} {select}"


def on_clean(raw: str, select: str) -> str:
    return over(raw, select, TYPED, CLEAN)


def on_features(raw: str, select: str) -> str:
    return over(raw, select, TYPED, CLEAN, CHANGES, AVERAGED)


def on_split(select: str) -> str:
    return over(SUPPLIER_BARS_SQL, select, TYPED, CLEAN, CHANGES, AVERAGED, SPLIT)


def on_standins(select: str) -> str:
    return over(
        SUPPLIER_BARS_SQL, select, TYPED, CLEAN, CHANGES, AVERAGED, SPLIT, STANDINS
    )


def oracle_sql() -> dict[str, str]:
    orders, suppliers = ORDER_BARS_SQL, SUPPLIER_BARS_SQL
    key = ("ticker", "trade_date")
    features = f"select {shown(FEATURE)} from features"
    naive = f"select {shown(PREDICTION)} from naive"
    board = """select model_name, round(sqrt(avg((prediction - actual_close) ** 2)), 6) as rmse
      from standins group by model_name"""
    latest = """select ticker, strftime(trade_date, '%Y-%m-%d') as trade_date, model_name,
        round(prediction, 6) as predicted_close, round(actual_close, 6) as actual_close,
        predicted_at
      from naive qualify row_number() over (partition by ticker order by trade_date desc) = 1"""
    recent = f"""select ticker, strftime(trade_date, '%Y-%m-%d') as trade_date,
        {shown(("close", "ma_10", "ma_20", "rsi_14"))}
      from (select * from features {{where}}
        order by ticker desc, trade_date desc limit {{limit}})"""
    manifest = """select 'market_bars' as project, 'F,O,P' as tickers,
        count(*) as record_count, min(cast(trade_date as date)) as min_trade_date,
        max(cast(trade_date as date)) as max_trade_date
      from raw where upper(ticker) in ('F', 'O', 'P')"""
    daily = event_bars_sql("cast(ts as date)", "bar_start")
    ingested = f"""select * replace (timestamp '{RUN_TIMESTAMP}' as ingestion_timestamp,
        'file' as source_system) from ({orders})"""
    unnumbered = event_bars_sql("cast(ts as date)", "bar_start", tie="value")
    hourly = event_bars_sql("date_trunc('hour', ts)", "bar_start")
    weekly = event_bars_sql("date_trunc('week', ts)", "cast(bar_start as date)")

    return {
        # Sources
        "read_bars_range": over(
            orders,
            f"""select {shown(BAR)} from typed where ticker in ('F', 'O')
              and trade_date >= date '1996-01-01' and trade_date < date '1999-01-01'""",
            TYPED,
        ),
        "missing_tickers": f"""select t as ticker from (values ('F'), ('O'), ('P'), ('X')) v(t)
          where t not in (select upper(ticker) from ({orders}))""",
        "bars_from_ticks": f"select {shown(BAR)} from ({daily})",
        "bars_from_ticks_hourly": f"select {shown(BAR)} from ({hourly})",
        "bars_from_ticks_weekly": f"select {shown(BAR)} from ({weekly})",
        "bars_from_ticks_no_sequence": f"select {shown(BAR)} from ({unnumbered})",
        "bars_from_merged_ticks": f"select {shown(BAR)} from ({daily})",
        "bars_by_customer": f"select {shown(BAR)} from ({CUSTOMER_BARS_SQL})",
        "normalize_columns": """select o_orderstatus as ticker,
          cast(o_orderdate as date) as trade_date, o_totalprice as close,
          round(o_totalprice * 0.98::double, 6) as adj_close, o_custkey as stock_splits
          from orders""",
        "stamp_provenance": over(
            orders,
            f"""select upper(ticker) as ticker, trade_date, close,
              timestamp '{RUN_TIMESTAMP}' as ingestion_timestamp, 'vendor' as source_system
              from raw""",
        ),
        "sql_select_features": on_features(
            orders, features
        ),
        # Sinks
        "roundtrip_raw_partitioned": over(orders, f"select {shown(BAR)} from typed", TYPED),
        "roundtrip_raw_bucketed": over(orders, f"select {shown(BAR)} from typed", TYPED),
        "roundtrip_features_parquet": on_features(orders, features),
        "roundtrip_table": on_features(suppliers, features),
        "roundtrip_predictions": on_standins(naive),
        "roundtrip_metrics": on_standins(board),
        "roundtrip_metrics_json": on_standins(
            f"""select cast(count(*) as integer) as models, arg_min(model_name, rmse) as best_model
              from ({board})"""
        ),
        "roundtrip_manifest": over(orders, manifest),
        # Cleaning
        "clean_projection": over(orders, f"select {shown(BAR)} from typed", TYPED),
        "dedup_bars": over(
            orders, f"select {shown(BAR)} from typed {DEDUPED}", TYPED
        ),
        "clean_raw_prices": on_clean(orders, f"select {shown(BAR)} from clean"),
        "clean_raw_prices_supplier": on_clean(suppliers, f"select {shown(BAR)} from clean"),
        # Features
        "price_change": over(
            suppliers,
            f"select {shown((*key, 'close', 'previous_close', 'price_change'))} from moves",
            TYPED, CLEAN, CHANGES,
        ),
        "gain_loss": over(
            suppliers,
            f"select {shown((*key, 'gain', 'loss'))} from moves",
            TYPED, CLEAN, CHANGES,
        ),
        "daily_return": on_features(
            suppliers, f"select {shown((*key, 'daily_return'))} from indicated"
        ),
        "rsi_14": on_features(suppliers, f"select {shown((*key, 'rsi_14'))} from indicated"),
        "calendar_parts": on_features(
            suppliers, "select ticker, trade_date, day_of_week, month_of_year, year from indicated"
        ),
        "moving_averages": on_features(
            suppliers, f"select {shown((*key, 'ma_10', 'ma_20'))} from indicated"
        ),
        "lags": on_features(
            suppliers, f"select {shown((*key, 'lag_1', 'lag_2', 'lag_3'))} from indicated"
        ),
        "target_close": on_features(
            suppliers, f"select {shown((*key, 'close', 'target_close'))} from features"
        ),
        "technical_features": on_features(orders, features),
        "technical_features_supplier": on_features(suppliers, features),
        "technical_features_customer": on_features(CUSTOMER_BARS_SQL, features),
        "technical_features_hourly": over(
            hourly, features, TYPED.replace("as date", "as timestamp"), CLEAN, CHANGES, AVERAGED
        ),
        "technical_features_sliced": on_features(orders, features),
        "technical_features_sliced_supplier": on_features(suppliers, features),
        "technical_features_sliced_hourly": over(
            hourly, features, TYPED.replace("as date", "as timestamp"), CLEAN, CHANGES, AVERAGED
        ),
        "features_after_changes": on_features(suppliers, features),
        "ordered_features": on_features(orders, f"{features} order by ticker, trade_date"),
        "ordered_features_places": on_features(
            orders,
            """select ticker, trade_date,
              row_number() over (order by ticker, trade_date) as place from features""",
        ),
        # Aggregates, set operations
        "etl_summary": on_features(
            suppliers,
            """select count(*) as record_count, min(trade_date) as min_trade_date,
              max(trade_date) as max_trade_date from features""",
        ),
        "etl_summary_footers": on_features(
            suppliers,
            """select count(*) as record_count, min(trade_date) as min_trade_date,
              max(trade_date) as max_trade_date from features""",
        ),
        "ingest_manifest": over(orders, manifest),
        "available_tickers": over(
            suppliers, "select distinct upper(ticker) as ticker from raw order by ticker"
        ),
        "default_ticker": over(suppliers, "select min(upper(ticker)) as ticker from raw"),
        "union_frames": f"""select ticker, cast(trade_date as date) as trade_date,
            round(close, 6) as close, source_system, round(adj_close, 6) as adj_close
            from ({orders})
          union all select ticker, cast(trade_date as date), round(close, 6), source_system, null
            from ({suppliers})""",
        # Training rows
        "training_dataset": on_split(f"select {shown(DATASET)} from prepared"),
        "split_flag": on_split(
            """select ticker, trade_date, row_num, row_count, split_boundary, dataset_split
              from split"""
        ),
        "split_flag_sliced": on_split(
            """select ticker, trade_date, row_num, row_count, split_boundary, dataset_split
              from split"""
        ),
        "train_rows": on_split(
            f"""select {shown((*key, 'close', 'target_close'))}, row_num from split
              where dataset_split = 'train'"""
        ),
        "test_rows": on_split(
            f"""select {shown((*key, 'close', 'target_close'))}, row_num from split
              where dataset_split = 'test'"""
        ),
        "ticker_index": on_split(
            """select s.ticker, s.trade_date, s.dataset_split,
              cast(coalesce(r.place - 1, (select count(distinct ticker) from split
                where dataset_split = 'train')) as double) as ticker_index
              from split s left join (
                select ticker, row_number() over (order by count(*) desc, ticker) as place
                from split where dataset_split = 'train' group by ticker) r using (ticker)"""
        ),
        "ticker_hash": on_split(
            """select count(distinct ticker) as tickers, count(distinct ticker) as numbers
              from split"""
        ),
        "sparse_ticker_checks": over(
            CUSTOMER_BARS_SQL,
            f"""select count(distinct ticker) as tickers,
              count(*) filter (dataset_split = 'test') as test_rows, count(*) as predicted,
              {len(MODEL_INPUTS) + 256} as inputs, 32 as bins from split""",
            TYPED, CLEAN, CHANGES, AVERAGED, SPLIT,
        ),
        # What must hold for fitted models
        "linear_fit_checks": on_split(
            f"""select unnest(['one', {", ".join(f"'{c}'" for c in TRAINED_ON)}]) as input,
              count(*) as train_rows, true as orthogonal
              from split where dataset_split = 'train'"""
        ),
        "forest_fit_checks": on_split(
            """select count(*) as test_rows, count(*) as inside from split
              where dataset_split = 'test'"""
        ),
        "gbt_fit_checks": on_split(
            """select count(*) as train_rows, true as beats_mean from split
              where dataset_split = 'train'"""
        ),
        "leaderboard_checks": on_split(
            """select count(*) as test_rows, 3 as models, true as in_order,
              true as best_is_first, true as score_is_its_own from split
              where dataset_split = 'test'"""
        ),
        "saved_model_checks": on_split(
            """select count(*) as test_rows, 0.0::double as largest_difference from split
              where dataset_split = 'test'"""
        ),
        # Jobs
        "job_ingest": over(ingested, f"select {shown(BAR)} from typed", TYPED),
        "job_features": on_features(ingested, features),
        "job_train": over(
            ingested,
            f"""select ticker, trade_date, round(target_close, 6) as actual_close,
              timestamp '{RUN_TIMESTAMP}' as predicted_at
              from split where dataset_split = 'test'""",
            TYPED, CLEAN, CHANGES, AVERAGED, SPLIT,
        ),
        "job_train_checks": over(
            ingested,
            """select count(*) as test_rows, 0.0::double as largest_difference,
              true as best_predicts, true as best_is_first, 3 as models
              from split where dataset_split = 'test'""",
            TYPED, CLEAN, CHANGES, AVERAGED, SPLIT,
        ),
        "job_run_all": over(
            ingested,
            f"""select output, count(*) as row_count, count(distinct ticker) as tickers,
              min(trade_date) as first_day, max(trade_date) as last_day,
              round(avg(value), 3) as mean_value
              from ({RUN_OUTPUTS}) group by output""",
            TYPED, CLEAN, CHANGES, AVERAGED, SPLIT,
        ),
        # Predictions and serving
        "prediction_export": on_standins(naive),
        "rmse_overall": on_standins(board),
        "rmse_by_ticker": on_standins(
            """select model_name, ticker,
              round(sqrt(avg((prediction - actual_close) ** 2)), 6) as rmse
              from standins group by model_name, ticker"""
        ),
        "latest_prediction": on_standins(latest),
        "latest_prediction_ticker": on_standins(
            f"select * from ({latest}) where ticker = 'S1'"
        ),
        "market_data_all": on_features(suppliers, recent.format(where="", limit=200)),
        "market_data_walk": on_features(suppliers, recent.format(where="", limit=200)),
        "market_data_ticker": on_features(
            suppliers, recent.format(where="where ticker = 'S1'", limit=50)
        ),
        "actual_vs_predicted": on_standins(
            """select ticker, trade_date, series, round(price, 6) as price from (
                select ticker, trade_date, 'Actual Close' as series, actual_close as price
                from naive
                union all
                select ticker, trade_date, 'Predicted Close', prediction from naive)
              where ticker = 'S1'"""
        ),
        "multistock_lookback": on_features(
            suppliers,
            """select ticker, trade_date, round(close, 6) as close from features
              where trade_date >= (select max(trade_date) from features) - 180""",
        ),
    }
