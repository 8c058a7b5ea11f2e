"""Default values. Every operator takes them as parameters."""

# The symbols a run expects, in manifest order.
EQUITY_SYMBOLS = (
    "CBA.AX",
    "WBC.AX",
    "NAB.AX",
    "ANZ.AX",
    "MQG.AX",
    "BHP.AX",
    "RIO.AX",
    "FMG.AX",
    "MIN.AX",
    "S32.AX",
    "WDS.AX",
    "STO.AX",
    "CSL.AX",
    "RMD.AX",
    "COH.AX",
    "SHL.AX",
    "WOW.AX",
    "COL.AX",
    "WES.AX",
    "JBH.AX",
    "XRO.AX",
    "REA.AX",
    "CAR.AX",
    "TLS.AX",
    "TCL.AX",
    "QAN.AX",
    "ALL.AX",
    "VAS.AX",
    "A200.AX",
    "VGS.AX",
)
CRYPTO_SYMBOLS = (
    "BTCUSDT",
    "ETHUSDT",
    "BNBUSDT",
    "XRPUSDT",
    "SOLUSDT",
    "ADAUSDT",
    "DOGEUSDT",
    "TRXUSDT",
    "AVAXUSDT",
    "LINKUSDT",
    "DOTUSDT",
    "NEARUSDT",
    "ATOMUSDT",
    "SUIUSDT",
    "APTUSDT",
    "ARBUSDT",
    "OPUSDT",
    "POLUSDT",
    "UNIUSDT",
    "AAVEUSDT",
    "MKRUSDT",
    "LDOUSDT",
    "INJUSDT",
    "FILUSDT",
    "ICPUSDT",
    "GRTUSDT",
    "LTCUSDT",
    "BCHUSDT",
    "ETCUSDT",
    "XLMUSDT",
)
FX_SYMBOL = "AUDUSD=X"

# Portfolios and weights.
FIXED_PORTFOLIO_NAME = "fixed_demo"
OPTIMIZED_PORTFOLIO_NAME = "max_sharpe_calendar"
# What readers of the portfolio dimension find as descriptions.
FIXED_PORTFOLIO_DESCRIPTION = "Fixed demo portfolio used for dashboard performance analysis."
OPTIMIZED_PORTFOLIO_DESCRIPTION = "Historical max-Sharpe portfolio generated by the optimizer."
FIXED_PORTFOLIO_WEIGHTS = {
    "VAS.AX": 0.40,
    "CBA.AX": 0.25,
    "BHP.AX": 0.15,
    "BTCUSDT": 0.10,
    "ETHUSDT": 0.10,
}

# Thresholds and rates.
VALIDATION_FAILURE_THRESHOLD = 0.25
CALENDAR_DAYS_PER_YEAR = 365
MIN_ANNUALIZATION_OBSERVATIONS = 30
RISK_FREE_RATE = 0.0435
COMPLETE_WEIGHT = 0.999999
MAX_SINGLE_ASSET_WEIGHT = 0.60
MAX_CRYPTO_TOTAL_WEIGHT = 0.25
MAX_CRYPTO_ASSET_WEIGHT = 0.15
WEIGHT_TOLERANCE = 1e-6
CONSTRAINT_SET_NAME = "personal_mvp"
OPTIMIZER_METHOD = "pairwise_moves_max_sharpe"
