"""Keys and layouts of the known change-captured tables.

All values below are fixed values.
"""

# Ledger lines: key, operation code and time of the change.
LEDGER_KEYS = [
    "SourceLedger",
    "CompanyCode",
    "FiscalYear",
    "AccountingDocument",
    "LedgerGLLineItem",
]
LEDGER_OPERATION = "/1DH/OPERATION"
LEDGER_CHANGED_AT = "LASTCHANGEDATETIME"

# Versioned fact tables: the latest version per key is the one with the
# greatest modification time; all rows sharing it count.
FACT_ORDER = "dtemod"
FACT_KEYS = {
    "anomalies": [
        "promoid", "promoproductanomid", "timeid", "idaction", "salesorgcode", "uniquekey",
    ],
    "claims": [
        "customerid", "timeid", "promoid", "productid", "promoproductmechid", "amountid",
        "document", "salesorgcode", "aging", "documentrow",
    ],
    "funds": ["timeid", "customerid", "productid", "funddetailid", "fundid", "salesorgcode"],
    "fund details": [
        "timeid", "promoid", "funddetailid", "fundid", "reason", "salesorgcode",
        "fundmovementid",
    ],
    "promo sales": [
        "customerid", "timeid", "promoproductid", "promoid", "productid", "versioncode",
    ],
    "targets": ["timeid", "customerid", "productid", "salesorgcode", "scenariocode", "dim3"],
    "total sales": [
        "timeid", "customerid", "productid", "salesorgcode", "scenariocode", "dim3",
    ],
}
