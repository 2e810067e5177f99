"""Physical layouts of the two member families and the canonical field map."""

from __future__ import annotations

# Field order of the legacy layout and the kind of each typed field.
LEGACY = (
    ("SYMBOL", "text"), ("SERIES", "text"), ("OPEN", "decimal"), ("HIGH", "decimal"), ("LOW", "decimal"), ("CLOSE", "decimal"), ("LAST", "decimal"),
    ("PREVCLOSE", "decimal"), ("TOTTRDQTY", "integer"), ("TOTTRDVAL", "decimal"), ("TIMESTAMP", "stamp"), ("TOTALTRADES", "integer"), ("ISIN", "text"),
)
# Field order of the modern layout and the kind of each typed field.
UDIFF = (
    ("TradDt", "iso"), ("BizDt", "text"), ("Sgmt", "text"), ("Src", "text"), ("FinInstrmTp", "text"), ("FinInstrmId", "text"), ("ISIN", "text"), ("TckrSymb", "text"),
    ("SctySrs", "text"), ("XpryDt", "text"), ("FininstrmActlXpryDt", "text"), ("StrkPric", "text"), ("OptnTp", "text"), ("FinInstrmNm", "text"),
    ("OpnPric", "decimal"), ("HghPric", "decimal"), ("LwPric", "decimal"), ("ClsPric", "decimal"), ("LastPric", "decimal"), ("PrvsClsgPric", "decimal"),
    ("UndrlygPric", "text"), ("SttlmPric", "text"), ("OpnIntrst", "text"), ("ChngInOpnIntrst", "text"), ("TtlTradgVol", "integer"), ("TtlTrfVal", "decimal"),
    ("TtlNbOfTxsExctd", "integer"), ("SsnId", "text"), ("NewBrdLotQty", "text"), ("Rmks", "text"), ("Rsvd1", "text"), ("Rsvd2", "text"), ("Rsvd3", "text"), ("Rsvd4", "text"),
)
LAYOUTS = {"legacy13": LEGACY, "udiff34": UDIFF}

# Canonical name, legacy column, modern column. A field that one family lacks is null
# there. The business date is the day that its column states, all other fields keep their text.
FIELD_MAP = (
    ("security_isin", "ISIN", "ISIN"),
    ("listing_symbol", "SYMBOL", "FinInstrmId"),
    ("series", "SERIES", "SctySrs"),
    ("security_name", None, "FinInstrmNm"),
    ("business_date", "TIMESTAMP", "TradDt"),
    ("raw_biz_dt", "TIMESTAMP", "BizDt"),
    ("price_open", "OPEN", "OpnPric"),
    ("price_high", "HIGH", "HghPric"),
    ("price_low", "LOW", "LwPric"),
    ("price_close", "CLOSE", "ClsPric"),
    ("price_last", "LAST", "LastPric"),
    ("price_prev_close", "PREVCLOSE", "PrvsClsgPric"),
    ("traded_quantity", "TOTTRDQTY", "TtlTradgVol"),
    ("traded_value", "TOTTRDVAL", "TtlTrfVal"),
    ("trades_count", "TOTALTRADES", "TtlNbOfTxsExctd"),
    ("lot_size", None, "NewBrdLotQty"),
    ("remarks", None, "Rmks"),
    ("segment", None, "Sgmt"),
    ("source", None, "Src"),
    ("instrument_type", None, "FinInstrmTp"),
    ("underlying_symbol", None, "TckrSymb"),
    ("expiry", None, "XpryDt"),
    ("actual_expiry", None, "FininstrmActlXpryDt"),
    ("strike", None, "StrkPric"),
    ("option_type", None, "OptnTp"),
    ("underlying_price", None, "UndrlygPric"),
    ("settlement_price", None, "SttlmPric"),
    ("open_interest", None, "OpnIntrst"),
    ("open_interest_change", None, "ChngInOpnIntrst"),
    ("session_id", None, "SsnId"),
    ("rsvd1", None, "Rsvd1"),
    ("rsvd2", None, "Rsvd2"),
    ("rsvd3", None, "Rsvd3"),
    ("rsvd4", None, "Rsvd4"),
)

# Series tokens of overlay rows, matched verbatim.
OVERLAY_SERIES = ("BL", "BO", "T0", "IT", "IL")
