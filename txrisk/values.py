"""The vocabularies, thresholds, weights and texts every result depends on."""

# Category vocabularies.
LOCATIONS = ("NY", "CA", "TX", "FL", "NJ", "WA", "IL", "MA")
DEVICES = ("Mobile", "Web", "ATM", "POS")
MERCHANTS = ("Grocery", "Electronics", "Travel", "Clothing", "Restaurants", "Fuel")

# What counts as risky.
HIGH_AMOUNT = 7000
RAISED_AMOUNT = 3000
RISKY_DEVICES = ("Mobile", "ATM")
RISKY_MERCHANTS = ("Electronics", "Travel")
RISKY_LOCATIONS = ("TX", "FL")

# Rule score.
BASE_RISK = 0.05
HIGH_AMOUNT_RISK = 0.20
RAISED_AMOUNT_RISK = 0.10
DEVICE_RISK = 0.15
MERCHANT_RISK = 0.15
LOCATION_RISK = 0.05
MAX_RISK = 0.85

# Reason codes.
REASON_HIGH_AMOUNT = "HighAmount"
REASON_DEVICE = "RiskyDevice"
REASON_MERCHANT = "RiskyMerchant"
REASON_LOCATION = "RiskyLocation"
REASON_MODEL = "ModelDetected"
REASON_NORMAL = "Normal"

# Alert texts (transaction, user, amount, reason).
ALERT_SUBJECT = "Fraud Alert!"
ALERT_BODY = "Fraud detected! Transaction: %s, User: %s, Amount: %s, Reason: %s"

# Serving table and model settings.
PREDICTIONS_TABLE = "transaction_predictions"
CATEGORIES = ("location", "device", "merchant")
TRAIN_SHARE = 0.8
SPLIT_SEED = 42
MAX_ITER = 100
MAX_DEPTH = 5
STEP_SIZE = 0.1
SUBSAMPLING_RATE = 0.8
TOP_RANK = 3
CONSOLE_ROWS = 20
