"""Names that every operator shares.

Canonical events have the book's key (market, trading_day, symbol), channel, seq (native order), kind
(A add, C cancel, T trade, S status), ord_type, side, flag, status, bid_no, ask_no (null or 0: absent),
price (units of 0.0001), qty and quote_ms. Extra columns are carried or left behind, never read.
"""

BOOK = ["market", "trading_day", "symbol"]
ORDER = [*BOOK, "order_side", "order_no"]
LEVEL = [*BOOK, "order_side", "price"]
EVENT = "market string, trading_day int, symbol string, channel int, seq bigint, kind string, ord_type string, side string, flag string, status string, bid_no bigint, ask_no bigint, price bigint, qty bigint, quote_ms bigint"
