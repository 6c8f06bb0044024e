"""Rule table and classification of crypto assets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import _c, squeeze

# coins in the order they are tried: symbol, then words besides CRYPTO:<symbol> that give it away
COINS = [("BTC", "Bitcoin", "WBTC"), ("ETH", "Ethereum", "ETHER", "WETH"), ("SOL", "Solana"), ("XRP", "Ripple"), ("ADA", "Cardano"), ("DOGE", "Dogecoin"), ("LTC", "Litecoin"), ("DOT", "Polkadot"), ("AVAX", "Avalanche"), ("LINK", "Chainlink")]
_FUNDS = "ARKB ARK 21Shares Bitcoin ETF|BITB Bitwise Bitcoin ETF|BRRR Valkyrie Bitcoin Fund|BTCO Invesco Galaxy Bitcoin ETF|BTCW WisdomTree Bitcoin Fund|ETHA iShares Ethereum Trust ETF|ETHE Grayscale Ethereum Trust|ETHW Bitwise Ethereum ETF|EZBC Franklin Bitcoin ETF|FBTC Fidelity Wise Origin Bitcoin Fund|FETH Fidelity Ethereum Fund|GBTC Grayscale Bitcoin Trust|HODL VanEck Bitcoin Trust|IBIT iShares Bitcoin Trust ETF"
_FIRMS = "BITF Bitfarms|BTBT Bit Digital|CIFR Cipher Mining|CLSK CleanSpark|COIN Coinbase Global|CORZ Core Scientific|HIVE Hive Digital Technologies|HOOD Robinhood Markets|HUT Hut 8|IREN IREN|MARA MARA Holdings|MSTR MicroStrategy|RIOT Riot Platforms|WULF TeraWulf"
FUNDS, FIRMS = (dict(x.split(" ", 1) for x in t.split("|")) for t in (_FUNDS, _FIRMS))
ASSET_TYPES = {"direct_crypto": "Cryptocurrency", "crypto_etf": "Crypto ETF", "crypto_equity": "Crypto-Adjacent Equity"}


def _named(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))


def classify(ticker: Column | str, description: Column | str) -> Column:
    """struct(symbol, name, kind, matched_by, confidence): the first rule that holds.

    Fund tickers, firm tickers, coins (ticker, or a word of theirs anywhere in ticker and description), then funds'
    and firms' names; unrelated otherwise.
    """
    t = F.nullif(F.upper(F.trim(F.coalesce(_c(ticker), F.lit("")))), F.lit(""))
    d = squeeze(F.coalesce(_c(description), F.lit("")))
    text = F.trim(F.upper(F.concat_ws(" ", F.coalesce(t, F.lit("")), d)))

    def hit(symbol, name, kind: str, by: str | None, confidence: float) -> Column:
        lit = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.struct(lit(symbol).cast("string").alias("symbol"), lit(name).cast("string").alias("name"), F.lit(kind).alias("kind"), F.lit(by).cast("string").alias("matched_by"), F.lit(confidence).alias("confidence"))

    chain = F.when(t.isin(*FUNDS), hit(t, _named(FUNDS)[t], "crypto_etf", "ticker", 0.98)).when(t.isin(*FIRMS), hit(t, _named(FIRMS)[t], "crypto_equity", "ticker", 0.97))
    for symbol, name, *more in COINS:
        words = "|".join([name.upper(), f"CRYPTO:{symbol}", *more])
        chain = chain.when(t == symbol, hit(symbol, name, "direct_crypto", "ticker", 0.99)).when(text.rlike(words), hit(symbol, name, "direct_crypto", "description", 0.94))
    for table, kind, confidence in ((FUNDS, "crypto_etf", 0.92), (FIRMS, "crypto_equity", 0.90)):
        for symbol, name in table.items():
            chain = chain.when(text.contains(name.upper()), hit(symbol, name, kind, "description", confidence))
    return chain.otherwise(hit(t, F.coalesce(F.nullif(d, F.lit("")), t), "unrelated", None, 0.0))


def asset_type(kind: Column, otherwise: Column) -> Column:
    """The site's label for a crypto kind, else the asset type there was."""
    return F.coalesce(_named(ASSET_TYPES)[kind], otherwise)
