"""These must equal the source project's for the same results."""

# --- Fixed values ---------------------------------------------------------------
# Default asset universe requested when no universe list is landed (in order).
DEFAULT_UNIVERSE = (
    "bitcoin", "ethereum", "tether", "binancecoin", "usd-coin", "ripple", "solana", "tron",
    "figure-heloc", "hyperliquid", "dogecoin", "usds", "leo-token", "rain", "zcash", "stellar",
    "canton-network", "cardano", "monero", "chainlink", "whitebit-coin", "the-open-network",
    "usd1-wlfi", "ethena-usd", "dai", "bitcoin-cash", "memecore", "hedera-hashgraph",
    "labra-finance", "litecoin", "sui", "hashnote-usd", "avalanche-2", "near-protocol",
    "paypal-usd", "shiba-inu", "crypto-com-chain", "tether-gold", "global-dollar-stablecoin-gds",
    "blackrock-usd-institutional-digital-liquidity-fund", "ondo-us-dollar-yield", "bittensor",
    "pax-gold", "ondo-finance", "mantle", "world-liberty-financial", "worldcoin", "ripple-usd",
    "polkadot", "aster-2", "htx-dao", "uniswap", "okb", "falcon-financial", "pi-network", "usdd",
    "sky", "bfusd", "internet-computer", "bitget-token", "audiera", "pepe", "morpho",
    "ethereum-classic", "dexe", "usdtb", "eutbl", "united-states-dollar", "quant-network",
    "blockchain-capital", "aave", "superstate", "cosmos", "siren-2", "kaspa",
    "janus-henderson-anemoy-treasury-fund", "kucoin-shares", "render-token", "algorand",
    "polygon-ecosystem", "nexo", "ethena", "stable-2", "venice-token", "just", "bianrensheng",
    "gatechain-token", "xdce-crowd", "beldex", "flare-network", "filecoin", "gho",
    "injective-protocol", "usual-usd", "aptos", "pump-fun", "ylds", "hash-2", "midnight-3",
    "jupiter-exchange",
)
# History window requested per asset, in days.
DEFAULT_CHART_DAYS = 90
# Market snapshot: one page of the top assets by market cap.
SNAPSHOT_PAGE_SIZE = 100
# Prices, caps, volumes, changes and averages are rounded to this scale.
PRICE_SCALE = 2
# Moving average over the current and the 6 preceding rows (7 rows).
MOVING_AVERAGE_ROWS = 7
# Missing text becomes this value in the staged snapshot.
UNKNOWN_TEXT = "Unknown"
# Source freshness: (warn after, error after) in hours.
FRESHNESS_HOURS = {
    "coin_markets": (12, 24),
    "coin_price_history": (12, 24),
    "coins_categories": (72, 168),
}
# Staged snapshot: (output column, raw column, rule) in output order.
SNAPSHOT_RULES = [
    ("name_id", "id", "text"),
    ("symbol_name", "symbol", "text"),
    ("name_of_coin", "name", "text"),
    ("coin_image", "image", "text"),
    ("current_price", "current_price", "round"),
    ("market_cap", "market_cap", "round"),
    ("market_cap_rank", "market_cap_rank", "number"),
    ("fully_diluted_valuation", "fully_diluted_valuation", "round"),
    ("total_volume", "total_volume", "number"),
    ("high_24h", "high_24h", "round"),
    ("low_24h", "low_24h", "round"),
    ("price_change_24h", "price_change_24h", "round"),
    ("market_cap_change_24h", "market_cap_change_24h", "round"),
    ("circulating_supply", "circulating_supply", "round"),
    ("total_supply", "total_supply", "round"),
    ("max_supply", "max_supply", "round"),
    ("all_time_high", "ath", "round"),
    ("all_time_high_change_percentage", "ath_change_percentage", "round"),
    ("all_time_high_date", "ath_date", "date"),
    ("all_time_low", "atl", "round"),
    ("all_time_low_change_percentage", "atl_change_percentage", "round"),
    # The source derives this from ath_date (a defect); atl_date is used here.
    ("all_time_low_date", "atl_date", "date"),
    ("return_on_investment_times", "roi_times", "round"),
    ("return_on_investment_currency", "roi_currency", "text"),
    ("return_on_investment_percentage", "roi_percentage", "round"),
    ("last_updated", "last_updated", "timestamp"),
    ("ingested_at", "_ingested_at", "timestamp"),
]
# Daily fact: metrics column -> fact column, in output order.
FACT_COLUMNS = {
    "coin_id": "coin_id",
    "name_of_coin": "name_of_coin",
    "date_stamp": "trade_date",
    "open_price": "open_price_usd",
    "high_price": "high_price_usd",
    "low_price": "low_price_usd",
    "close_price": "close_price_usd",
    "close_total_volume": "volume",
    "close_market_cap": "market_cap",
    "daily_price_change_pcg": "daily_price_change_pct",
    "moving_avg_7d": "moving_avg_7d_price",
}
# Layer (schema) of every table.
LAYERS = {
    "coin_markets": "raw", "coin_price_history": "raw", "coins_categories": "raw",
    "stg_coin_markets": "staging", "stg_coin_categories": "staging",
    "stg_coin_price_history": "staging", "int_coin_daily_metrics": "intermediate",
    "int_coin_categories": "intermediate", "dim_coins": "marts",
    "fct_daily_coin_performance": "marts", "fct_market_summary": "marts",
    "dim_coins_snapshot": "snapshots", "quality_report": "audit", "source_freshness": "audit",
    "pending_bar_changes": "audit", "load_audit": "audit", "rejected_input": "audit",
    "asset_state": "audit", "table_fingerprints": "audit",
    "quality_ledger": "audit", "merged_batches": "audit",
    "missing_assets": "audit",
}
# --------------------------------------------------------------------------------
